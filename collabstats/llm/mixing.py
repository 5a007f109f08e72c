"""Mixing sources to target weights, in DataFrame operations only.

The words of a source, its documents in order of a hash bucket (of id and text) and then id, are packed into blocks of fixed length.  Targets follow the
sources' weights; a target stops at ``LIMIT`` times its source's size and the excess is shared again by weight.  A
source's target becomes a number of block slots; dealing the slots independently to the output shards is one
multinomial draw of the source's counts per shard, conditional on its total, so the totals meet the targets.  Slot
``k`` of a source reads block ``perm(k mod blocks)`` of epoch ``k div blocks``, where every epoch of every source has
a pseudorandom permutation of its own (a swap-or-not shuffle, a bijection for any number of blocks).  Picked blocks
then join the texts' packed blocks by index; the joined rows, each with the slots that read it, are the mix, written to
the shared folder, and what it takes of a document is counted in them.

Scale: offsets inside a source come from about sqrt(rows) buckets of its documents (running sums inside buckets and
over buckets), so no task holds a source; slots are made in chunks; the only rows in one task are one row per source.
Texts are shuffled once, to their bucket, where the picks of the bucket's blocks meet them.

Edge cases: a null source is a source, the last; a null or blank text has size 0 and takes 0; equal rows are placed
one after the other and each gets its share; with no words at all every target is 0; an empty table gives an empty
table.  Input columns other than id, source and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from collabstats.llm.common import WORD, materialize, partitions

WEIGHTS, LIMIT, SEED = (1, 2, 3), 3, 20
#: Words in a block; a source below BLOCK * BLOCK words gets shorter blocks, at least about BLOCK of them.
BLOCK = 64
#: Rounds of the swap-or-not shuffle; slots made at once; slots of an output shard, on average.
ROUNDS, CHUNK, SHARD = 16, 1024, 4096
#: ``remix`` rounds a row by itself where it has more than 1 / LONG of its source's words.
LONG = 1024


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``source``, ``skey`` (never null), ``size`` in words, ``print`` (a hash of the text) and ``text`` of every row."""
    return docs.select("doc_id", "source", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("skey"),
                       F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"), F.xxhash64(text).alias("print"), F.col(text).alias("text"))


def targets(totals: DataFrame) -> DataFrame:
    """``totals`` (one row per source: ``source``, ``skey``, ``source_size``) with ``weight`` and ``target``.

    Levels: sorted by size over weight, the sources before a row are at their limit and the rest shares what is left
    by weight; the first row whose limit is not below its share fixes the share of one weight unit.
    """
    place = F.row_number().over(W.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((place - 1) % len(WEIGHTS) + 1).cast("int")).cast("bigint")
    every = W.partitionBy(F.lit(0))
    before = W.orderBy(F.col("source_size") / F.col("weight"), "skey").rowsBetween(W.unboundedPreceding, -1)
    big = "decimal(38,0)"
    limit = F.col("source_size") * LIMIT
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    units = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (totals.withColumn("weight", weight).withColumn("left", left).withColumn("units", units)
             .withColumn("unit", F.when(F.col("left").cast(big) * F.col("weight") <= limit.cast(big) * F.col("units"), F.col("left") / F.col("units")))
             .withColumn("unit", F.first("unit", ignorenulls=True).over(W.orderBy(F.col("source_size") / F.col("weight"), "skey").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))))
    target = F.least(limit.cast("double"), F.col("unit") * F.col("weight"))
    return level.withColumn("target", F.coalesce(target, F.lit(0.0))).drop("left", "units", "unit")


def permuted(i: Column, n: Column, *key: Column) -> Column:
    """Place of ``i`` in a keyed pseudorandom permutation of 0..n-1: swap-or-not rounds."""
    def turn(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        swap = F.xxhash64(*key, r, F.greatest(x, other)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), i, turn)


def slots(sources: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per slot: ``skey``, ``shard``, ``slot`` and the ``block`` that it reads.

    ``sources`` has ``skey``, ``blocks`` and ``slots`` of each source.
    """
    shards = F.greatest(F.ceil(F.sum("slots").over(W.partitionBy(F.lit(0))) / SHARD), F.lit(1))
    chunks = (sources.withColumn("shards", shards).where("slots > 0")
              .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("slots") - 1) / CHUNK))))
              .repartition(partitions(sources.sparkSession), "skey", "chunk"))
    k = F.col("slot")
    made = chunks.withColumn("slot", F.explode(F.sequence(F.col("chunk") * CHUNK, F.least("slots", (F.col("chunk") + 1) * CHUNK) - 1)))
    epoch = F.floor(k / F.col("blocks"))
    return made.select(
        "skey", F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "skey", k), F.col("shards")).alias("shard"), "slot",
        permuted(k % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("skey"), epoch).alias("block"))


def plan(docs: DataFrame, seed: int = SEED, block: int = BLOCK) -> tuple[DataFrame, DataFrame, Column, DataFrame]:
    """Documents with their place in their source; the sources' buckets in order, with what their source has; the bucket
    of a row of ``sizes``; and the slots."""
    rows = materialize(sizes(docs).drop("text"), "mix-sizes")
    buckets = max(1, isqrt(rows.count()))
    bucket = F.pmod(F.xxhash64("doc_id", "print"), F.lit(buckets))
    rows = rows.withColumn("bucket", bucket)
    parts = materialize(rows.groupBy("skey", "bucket").agg(F.sum("size").alias("words"), F.first("source").alias("source")), "mix-buckets")
    totals = parts.groupBy("skey").agg(F.sum("words").alias("source_size"), F.first("source").alias("source"))
    length = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.col("source_size") / block))).cast("bigint")
    sources = targets(totals).withColumn("length", length).withColumn("blocks", F.ceil(F.col("source_size") / F.col("length")))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = materialize(sources.withColumn("slots", F.round(share * F.col("blocks")).cast("bigint")), "mix-sources")
    earlier = F.sum("words").over(W.partitionBy("skey").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = (parts.withColumn("offset", F.coalesce(earlier, F.lit(0))).drop("source")
               .join(sources.select("skey", "source", "source_size", "target", "length"), "skey"))
    placed = place(rows.drop("source"), offsets).select("doc_id", "source", "skey", "size", "print", "source_size", "target", "length", "start")
    return placed, offsets, bucket, slots(sources, seed)


def place(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """``rows`` of ``sizes`` with their bucket's columns and ``start``, the number of words of their source before them."""
    within = F.sum("size").over(W.partitionBy("skey", "bucket").orderBy("doc_id", "size", "print").rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    return rows.withColumn("within", within).join(offsets, ["skey", "bucket"]).withColumn("start", F.col("offset") + F.col("within"))


def pieces(placed: DataFrame) -> tuple[DataFrame, Column, Callable[[Column], Column], Callable[[Column], Column]]:
    """Rows with words, the numbers of a row's blocks, and where a block's words of the row begin and end in the source."""
    end = F.col("start") + F.col("size")
    first, last = F.floor(F.col("start") / F.col("length")), F.floor((end - 1) / F.col("length"))
    return placed.where("size > 0"), F.sequence(first, last), lambda b: F.greatest(b * F.col("length"), "start"), lambda b: F.least((b + 1) * F.col("length"), end)


def picks(offsets: DataFrame, dealt: DataFrame) -> DataFrame:
    """One row per bucket and picked block that has words in it: ``skey``, ``bucket``, ``block``, ``slots`` (``slot`` and ``shard``
    of each, at most ``LIMIT`` and one) and ``whole``, whether no other bucket has words of the block."""
    length, end = F.col("length"), F.col("offset") + F.col("words")
    held = offsets.where("words > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("offset") / length), F.floor((end - 1) / length))))
    whole = (F.col("block") * length >= F.col("offset")) & (F.least((F.col("block") + 1) * length, "source_size") <= end)
    of_block = dealt.groupBy("skey", "block").agg(F.collect_list(F.struct("slot", "shard")).alias("slots"))
    # sizes after explode are not estimated: without the hint a small-looking side would be broadcast
    return held.select("skey", "bucket", "block", whole.alias("whole")).join(of_block.hint("merge"), ["skey", "block"])


def pack(docs: DataFrame, seed: int = SEED, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Documents with their place, and the picked blocks: ``skey``, ``block``, ``source``, ``slots``, ``words`` (as a text, by single
    spaces) and ``parts``, in order: the documents' ``doc_id``, ``start`` (place of the document in its source), ``first``
    (place of the part) and ``n`` words.

    Texts and picks meet in their bucket, by the one shuffle of the texts: there rows are placed, cut and packed.  Only
    the blocks that a bucket shares with the next ones are put together from their written halves.
    """
    placed, offsets, bucket, dealt = plan(docs, seed, block)
    texts = sizes(docs).where("size > 0").withColumn("bucket", bucket).drop("source")
    met = place(texts.unionByName(picks(offsets, dealt).withColumn("size", F.lit(0).cast("bigint")), allowMissingColumns=True), offsets)
    _, numbers, begin, end = pieces(met)

    def part(b: Column, words: Column) -> Column:
        n = end(b) - begin(b)
        cut = F.slice(words, (begin(b) - F.col("start") + 1).cast("int"), n.cast("int"))
        return F.struct(b.alias("block"), F.struct(begin(b).alias("first"), "doc_id", "start", n.alias("n"), F.array_join(cut, " ").alias("words")).alias("part"))

    # the text is cut into words once, as the only element of an array, not once per block
    cut = F.flatten(F.transform(F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))), lambda words: F.transform(numbers, lambda b: part(b, words))))
    pick = F.array(F.struct("block", F.lit(None).alias("part")))
    cuts = met.select("skey", "bucket", "source", "slots", "whole", F.explode(F.when(F.col("size") > 0, cut).otherwise(pick)).alias("cut"))
    packed = (cuts.groupBy("skey", "bucket", "cut.block")
              .agg(F.first("source").alias("source"), F.first("slots", ignorenulls=True).alias("slots"), F.first("whole", ignorenulls=True).alias("whole"),
                   F.sort_array(F.collect_list("cut.part")).alias("parts")).where("slots is not null"))
    told = F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["start"].alias("start"), p["first"].alias("first"), p["n"].alias("n")))
    own = ["skey", "block", "source", "slots"]
    written = materialize(packed.select(*own, "whole", F.array_join("parts.words", " ").alias("words"), told.alias("parts")), "mix-blocks")
    halves = F.sort_array(F.collect_list(F.struct(F.col("parts")[0]["first"].alias("first"), "words", "parts")))
    shared = (written.where("not whole").groupBy("skey", "block")
              .agg(F.first("source").alias("source"), F.first("slots").alias("slots"), halves.alias("halves"))
              .select(*own, F.array_join("halves.words", " ").alias("words"), F.flatten("halves.parts").alias("parts")))
    return placed, written.where("whole").drop("whole").unionByName(materialize(shared, "mix-shared"))


def blocks(docs: DataFrame, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """The mix itself, one row per slot: ``shard``, ``slot`` (its number in its source), ``skey``, ``source``, ``block``,
    ``words`` and ``parts`` (as of ``pack``)."""
    dealt = pack(docs, seed, block)[1].withColumn("own", F.explode("slots"))
    return dealt.select("own.shard", "own.slot", "skey", "source", "block", "words", "parts")


def mix(docs: DataFrame, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` (words that the mix takes) of every row,
    counted in the written blocks, each as often as slots read it."""
    placed, packed = pack(docs, seed, block)
    parts = packed.select("skey", F.size("slots").alias("times"), F.explode("parts").alias("part"))
    taken = parts.groupBy("skey", F.col("part.start").alias("start")).agg(F.sum(F.col("part.n") * F.col("times")).alias("taken"))
    out = ["doc_id", "source", "size", "source_size", "target"]
    found = placed.where("size > 0").join(taken.hint("merge"), ["skey", "start"], "left").select(*out, F.coalesce("taken", F.lit(0)).alias("taken"))
    return found.unionByName(placed.where("size = 0").select(*out, F.lit(0).cast("bigint").alias("taken")))


def takings(docs: DataFrame, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """What ``mix`` counts, of every row with words, told by block numbers alone, without the texts; with ``skey`` and ``print``."""
    placed, _, _, dealt = plan(docs, seed, block)
    times = dealt.groupBy("skey", "block").agg(F.count("*").alias("times"))
    rows, numbers, begin, end = pieces(placed)
    cuts = rows.withColumn("block", F.explode(numbers)).withColumn("words", end(F.col("block")) - begin(F.col("block")))
    row = ["skey", "start", "doc_id", "source", "size", "print", "source_size", "target"]
    return (cuts.join(times.hint("merge"), ["skey", "block"], "left")
            .groupBy(*row).agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken")))


def remix(docs: DataFrame, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """``docs`` as the mix takes them: whole rows, each as often as its taken words fill it, so that a source's words
    meet what the mix takes of it.

    A row's taken words over its size, between 0 and ``LIMIT``, is rounded up or down.  A source's long rows (fewer
    than ``LONG``) are rounded from the longest on, each so that the error so far stays smallest; its other rows are
    ordered by a hash less their fraction, and as many of them are rounded up as fill what is left, to within half a
    row.  Rows that are equal in id, source and text share what they take; rows without words go.
    """
    own = ["id", "skey", "size", "print"]
    rows = (takings(docs, seed, block).withColumnRenamed("doc_id", "id")
            .groupBy(*own, "source_size").agg(F.sum("taken").alias("taken"), F.count("*").alias("n")))
    low = F.floor(F.col("taken") / F.col("size"))
    rows = materialize(rows.withColumn("low", low).withColumn("part", F.col("taken") - F.col("low") * F.col("size")), "mix-shares")
    open_ = rows.where("part > 0")
    long = F.col("size") * LONG > F.col("source_size")

    def step(done: Column, row: Column) -> Column:
        up = F.abs(done["error"] + row["size"] - row["part"]) <= F.abs(done["error"] - row["part"])
        return F.struct((done["error"] - row["part"] + F.when(up, row["size"]).otherwise(0)).alias("error"),
                        F.when(up, F.concat(done["rows"], F.array(F.struct(row["id"].alias("id"), row["size"].alias("size"), row["print"].alias("print")))))
                        .otherwise(done["rows"]).alias("rows"))

    longest = F.sort_array(F.collect_list(F.struct("size", "print", "id", "part")), asc=False)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    none = F.struct(F.lit(0).cast("bigint").alias("error"), F.array().cast(f"array<struct<id:{id_type},size:bigint,print:bigint>>").alias("rows"))
    firsts = materialize(open_.where(long).groupBy("skey").agg(longest.alias("all")).select("skey", F.aggregate("all", none, step).alias("done")), "mix-long")
    # the other rows: running sums inside buckets of the order and over buckets
    buckets = max(1, isqrt(rows.count()))
    chance = F.pmod(F.xxhash64(F.lit(seed), *own), F.lit(1 << 30)) / float(1 << 30)
    rest = (open_.where(~long).withColumn("key", chance - F.col("part") / F.col("size"))
            .withColumn("bucket", F.floor((F.col("key") + 1) / 2 * buckets)))
    sums = materialize(rest.groupBy("skey", "bucket").agg(F.sum("size").alias("words"), F.sum("part").alias("part")), "mix-rest")
    before = F.coalesce(F.sum("words").over(W.partitionBy("skey").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    wanted = sums.groupBy("skey").agg(F.sum("part").alias("wanted")).join(firsts, "skey", "left")
    wanted = wanted.select("skey", (F.col("wanted") - F.coalesce("done.error", F.lit(0))).alias("wanted"))
    offsets = sums.withColumn("before", before).select("skey", "bucket", "before").join(wanted, "skey")
    inside = F.sum("size").over(W.partitionBy("skey", "bucket").orderBy("key", "print", "id").rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    shorts = (rest.withColumn("inside", inside).join(offsets, ["skey", "bucket"])
              .where(F.col("before") + F.col("inside") + F.col("size") / 2 <= F.col("wanted")).select(*own))
    ups = firsts.select("skey", F.explode("done.rows").alias("row")).select("row.id", "skey", "row.size", "row.print").unionByName(shorts)
    copies = (rows.select(*own, "n", F.col("low").alias("copies")).unionByName(ups.withColumns({"n": F.lit(0).cast("bigint"), "copies": F.lit(1).cast("bigint")}))
              .groupBy(*own).agg(F.max("n").alias("n"), F.sum("copies").alias("copies")).where("copies > 0")
              .select(*(F.col(c).alias(f"__{c}") for c in (*own, "n", "copies"))))
    source = F.coalesce(F.concat(F.lit("="), F.col("__row.source").cast("string")), F.lit(""))
    sized = docs.select(F.struct(*docs.columns).alias("__row")).select(
        "__row", F.col("__row.doc_id").alias("own_id"), source.alias("own_skey"),
        F.coalesce(F.regexp_count("__row.text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("own_size"), F.xxhash64("__row.text").alias("own_print"))
    joined = sized.join(copies.hint("merge"), F.col("own_id").eqNullSafe(F.col("__id")) & (F.col("own_skey") == F.col("__skey"))
                        & (F.col("own_size") == F.col("__size")) & (F.col("own_print") == F.col("__print")))
    # equal rows are told apart by number only where there are several
    equal = joined.where("__n > 1").withColumn("__number", F.row_number().over(W.partitionBy("own_id", "own_skey", "own_size", "own_print").orderBy(F.lit(0))))
    every = joined.where("__n = 1").withColumn("__number", F.lit(1)).unionByName(equal)
    share = F.floor(F.col("__copies") / F.col("__n")) + (F.col("__number") <= F.col("__copies") % F.col("__n")).cast("bigint")
    return every.withColumn("__own", share).where("__own > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "__own"))).select("__row.*")
