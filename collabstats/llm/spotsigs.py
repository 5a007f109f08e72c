"""SpotSigs document fingerprints.

Every anchor of a text and the ``CHAIN`` content words that follow it form a signature.  Anchors are the common words
of four languages and, for texts that have none of these, every word that a hash picks (one of ``EVERY``); the start of
the text is an anchor as well, so every text has one.  Where no anchor comes for ``GAP`` words (few words, often
repeated), every ``GAP``-th content word starts a chain too, so no longer stretch of a text is without signatures.  The set of a text's signatures (32-bit hashes) is its
fingerprint, and two texts are as alike as the Jaccard coefficient of their sets.  Sets whose sizes differ by more
than the wanted likeness allows are never compared: sets are partitioned by length, and a set meets only its own and
the next partition.

Edge cases: null and empty texts have the one signature of an empty start; equal texts have equal fingerprints;
documents are ordered by id descending (null ids last), then by text; a document without a next one is next to the
first (with one row only: itself).  An empty table gives an empty table.  Input columns other than id and text are
ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collabstats.llm.common import materialize, partitions
from collabstats.llm.components import connected_components, smallest_of

CHAIN = 2
#: Words remembered per task; characters fingerprinted together.
WORDS, BLOCK_CHARS = 400_000, 4_000_000
WORD = re.compile(r"\w+")
#: One of EVERY words is an anchor by its hash; a stretch of GAP words without an anchor has one of its own.
EVERY, GAP = 4, 512


class _Anchors(frozenset):
    """The words given, and one of ``EVERY`` other words by its hash."""

    def __contains__(self, word: str) -> bool:
        from xxhash import xxh64_intdigest

        return super().__contains__(word) or xxh64_intdigest(word.encode(), 4) % EVERY == 0


#: Common words of English, French, German and Spanish (fixed values), and words by hash.
ANCHORS = _Anchors("""
a an the and or but of to in on at by for from with as is are was were be been it its this that these those he she they we you i not no
le la les un une des du de et ou mais dans sur par pour avec est sont que qui ce cette ces il elle ils nous vous ne pas plus au aux en
der die das ein eine und oder aber von zu im in auf mit für ist sind war nicht es sie er wir ich den dem des als auch
el los las una unos unas y o pero del al con por para es son fue que se su sus no lo como más
""".split())


class _Words(dict):
    """Hashes of words; the lowest bit tells an anchor."""

    def __missing__(self, word: str) -> int:
        from xxhash import xxh64_intdigest

        value = self[word] = (xxh64_intdigest(word.encode(), 3) & ~1) | (word in ANCHORS)
        return value


def signatures(texts: list[str], words: _Words) -> list[np.ndarray]:
    """The sorted distinct signatures of each text."""
    if len(words) > WORDS:
        words.clear()
    cut = [WORD.findall(t.lower()) for t in texts]
    # each text is led by its start: an anchor of its own
    sizes = np.fromiter((len(c) + 1 for c in cut), np.int64, len(cut))
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    hashes = np.ones(total, np.uint64)
    body = np.ones(total, bool)
    body[ends - sizes] = False
    hashes[body] = np.fromiter((words[w] for c in cut for w in c), np.uint64, total - len(cut))
    own = np.repeat(np.arange(len(cut)), sizes)
    anchor = (hashes & np.uint64(1)).astype(bool)
    spots, content = np.flatnonzero(anchor), np.flatnonzero(~anchor)
    # long stretches without an anchor; every text starts with one, so the last anchor is of the same text
    since = content - spots[np.searchsorted(spots, content) - 1] if len(content) else content
    spots = np.union1d(spots, content[since % GAP == 0])
    mixer = np.uint64(0x9E3779B97F4A7C15)
    found = hashes[spots] * mixer
    follow = np.searchsorted(content, spots, side="right")
    for step in range(CHAIN):
        at = follow + step
        place = content[np.minimum(at, len(content) - 1)] if len(content) else np.zeros_like(at)
        inside = (at < len(content)) & (own[place] == own[spots]) if len(content) else np.zeros(len(at), bool)
        found = (found ^ (found >> np.uint64(29))) * mixer + np.where(inside, hashes[place], np.uint64(7))
    found = ((found ^ (found >> np.uint64(32))) * mixer) >> np.uint64(32)
    both = np.unique(own[spots].astype(np.uint64) << np.uint64(32) | found)
    bounds = np.searchsorted(both >> np.uint64(32), np.arange(len(cut) + 1))
    plain = both.astype(np.uint32)
    return [plain[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def pack(found: np.ndarray) -> str:
    return base64.b64encode(found.astype("<u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard coefficient of two sorted sets; 0 without a comparison where the sizes alone rule out ``least``."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common) if len(a) or len(b) else 1.0


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fingerprint`` (base64 of the sorted signatures, 4 bytes each) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            found: list[str] = []
            for block in _blocks(batch.column(batch.num_columns - 1).to_pylist()):
                found += map(pack, signatures(block, words))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string())], names=[*batch.schema.names[:-1], "fingerprint"])

    chosen = docs.select(*keep, F.col(text).alias("__text"))
    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields[:-1], T.StructField("fingerprint", T.StringType())]))


def _blocks(texts: list[str | None]) -> Iterator[list[str]]:
    block: list[str] = []
    chars = 0
    for text in texts:
        block.append(text or "")
        chars += len(block[-1])
        if chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def with_next(docs: DataFrame, run, schema: T.StructType | str, text: str = "text") -> DataFrame:
    """Apply ``run`` to sorted partitions of ``bucket, tail, doc_id, text``: by id descending, then text.

    Ids are cut at quantiles.  A row whose id is the largest of its bucket also goes, as a ``tail`` row, to the end
    of the bucket before it, so every document of a bucket has its next one at hand: one shuffle, no global sort.
    """
    spark = docs.sparkSession
    chosen = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    count = 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    cuts = chosen.agg(F.percentile_approx("doc_id", [i / count for i in range(1, count + 1)], 10 * count)).first()[0]
    tops = sorted(set(cuts or [0]))  # one id per bucket, never more than ``count``; 0 where all ids are null
    heads = F.array(*(F.lit(t).cast("bigint") for t in tops))
    # bucket 0 has the largest ids; null ids belong to the last bucket
    last = len(tops) - 1
    bucket = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(F.lit(last) - _below(heads, F.col("doc_id"), len(tops)))
    placed = chosen.withColumn("bucket", bucket.cast("int"))
    head = F.array_contains(heads, F.col("doc_id")) if cuts else F.col("doc_id").isNull()
    before = F.when(F.col("bucket") == 0, F.lit(last)).otherwise(F.col("bucket") - 1)
    row = lambda b, tail: F.struct(b.cast("int").alias("bucket"), F.lit(tail).alias("tail"))
    dealt = placed.withColumn("to", F.explode(F.when(head, F.array(row(F.col("bucket"), False), row(before, True))).otherwise(F.array(row(F.col("bucket"), False)))))
    dealt = dealt.select("to.bucket", "to.tail", "doc_id", "text")
    return (dealt.repartition("bucket").sortWithinPartitions("bucket", "tail", F.col("doc_id").desc_nulls_last(), "text")
            .mapInArrow(run, schema))


def _below(sorted_values: Column, value: Column, count: int) -> Column:
    """How many of a sorted array's values are below ``value``, by binary search."""
    low = F.lit(0)
    step = 1 << max(0, count.bit_length() - 1)
    return F.aggregate(
        F.array(*(F.lit(step >> i) for i in range(step.bit_length()))), low,
        lambda at, jump: F.when((at + jump <= count) & (F.element_at(sorted_values, F.least(at + jump, F.lit(count))) < value), at + jump).otherwise(at))


def edited_neighbours(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every text's fingerprint beside that of its edited text and of the next document.

    The edited text has its last floor(n / 2) code points replaced by as many of the next document's first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        words = _Words()
        id_type = None

        def done(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
            edited = [t[:len(t) - len(t) // 2] + f[:len(t) // 2] for t, f in zip(texts, following, strict=True)]
            own, changed = signatures(texts, words), signatures(edited, words)
            after = [*own[1:], *signatures(following[-1:], words)]
            for i, f in enumerate(following[:-1]):
                if f is not texts[i + 1]:
                    after[i] = signatures([f], words)[0]
            return pa.RecordBatch.from_arrays([
                pa.array(ids, id_type), pa.array(list(map(len, texts)), pa.int64()), pa.array([sha256(e.encode()).hexdigest() for e in edited]),
                pa.array(list(map(pack, own))), pa.array(list(map(pack, changed))),
                pa.array([likeness(a, b) for a, b in zip(own, changed, strict=True)]), pa.array([likeness(a, b) for a, b in zip(own, after, strict=True)])],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        ids, texts, following = [], [], []
        chars = 0
        waiting = None  # bucket, id and text of a row whose next row is still to come
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for bucket, tail, doc_id, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if waiting is not None:
                    # a bucket's first tail row is next to its last own row
                    ids.append(waiting[1])
                    texts.append(waiting[2])
                    following.append(content)
                    chars += len(waiting[2])
                waiting = None if tail else (bucket, doc_id, content)
                if chars >= BLOCK_CHARS:
                    yield done(ids, texts, following)
                    ids, texts, following, chars = [], [], [], 0
        if ids:
            yield done(ids, texts, following)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return with_next(docs, run, f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double", text)


#: Members of a candidate group that are compared in one piece.
GROUP = 256


def _sets(prints: DataFrame) -> DataFrame:
    """``fid`` and ``sig``: the signatures of every distinct fingerprint, one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fid, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.frombuffer(base64.b64decode(packed), "<u4").astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), fid)), pa.array(found)], names=["fid", "sig"])

    return prints.mapInArrow(run, "fid long, sig long")


def near_duplicates(docs: DataFrame, threshold: float = 0.8, text: str = "text") -> DataFrame:
    """``doc_id`` and ``class_id`` (smallest id reachable over texts at least ``threshold`` alike) of every row.

    Equal fingerprints are one set.  A set's partition is the level of its length on a scale of steps 1 / threshold;
    it meets sets of its own level and of the next.  Two alike sets share one of the rarest signatures of each (as
    many as they may differ in), so these are the join key; candidates are verified by their whole sets.  A key's
    candidates yield a spanning forest of their links, not their pairs, and a key with more than ``GROUP`` of them is
    compared in pairs of blocks.
    """
    spark = docs.sparkSession
    prints = materialize(fingerprints(docs, text), "spotsigs")
    distinct = materialize(prints.select("fingerprint").distinct().withColumn("fid", F.monotonically_increasing_id()), "spotsigs-distinct")
    sets = _sets(distinct.select("fid", "fingerprint"))
    often = sets.groupBy("sig").agg(F.count("*").alias("often"))
    ordered = sets.join(often.hint("merge"), "sig").withColumn("place", F.row_number().over(W.partitionBy("fid").orderBy("often", "sig")))
    ordered = ordered.withColumn("size", F.count("*").over(W.partitionBy("fid")))
    leading = F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1
    level = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(1 / threshold)) + 1e-9)
    posts = (ordered.where((F.col("place") <= leading) & (F.col("often") > 1))
             .withColumn("level", F.explode(F.array(level, level + 1))).select("fid", "sig", "level"))
    groups = posts.groupBy("sig", "level").agg(F.count("*").alias("n")).where("n > 1")
    pieces = F.ceil(F.col("n") / GROUP).cast("int")
    own = F.pmod(F.xxhash64("fid"), pieces).cast("int")
    dealt = (posts.join(groups.hint("merge"), ["sig", "level"]).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), pieces - 1)))
             .select("sig", "level", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fid"))
    names = ["sig", "level", "i", "j"]
    whole = dealt.join(distinct.hint("merge"), "fid").repartition(partitions(spark), *names).sortWithinPartitions(*names, "fid")
    edges = whole.mapInArrow(_forests(threshold), "a long, b long").distinct()
    roots = connected_components(edges, "spotsigs-links").withColumnRenamed("node", "fid")
    classes = distinct.join(roots.hint("merge"), "fid", "left").select("fingerprint", F.coalesce("root", "fid").alias("root"))
    joined = prints.join(classes.hint("merge"), "fingerprint").select("doc_id", "root")
    return smallest_of(joined, "doc_id", "class_id").select("doc_id", "class_id")


def _forests(threshold: float):
    """Links of groups (rows sorted by key), as spanning forests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, {}

        def done() -> pa.RecordBatch:
            a, b = [], []
            left = dict(members)
            while left:
                queue = [left.popitem()]
                while queue and left:
                    fid, own = queue.pop()
                    near = [f for f, x in left.items() if likeness(own, x, threshold) >= threshold - 1e-12]
                    for f in near:
                        a.append(min(fid, f))
                        b.append(max(fid, f))
                        queue.append((f, left.pop(f)))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for sig, level, i, j, fid, packed in zip(*(batch.column(c).to_pylist() for c in ("sig", "level", "i", "j", "fid", "fingerprint")), strict=True):
                if (sig, level, i, j) != key:
                    if len(members) > 1:
                        yield done()
                    key, members = (sig, level, i, j), {}
                members[fid] = np.frombuffer(base64.b64decode(packed), "<u4")
        if len(members) > 1:
            yield done()

    return run
