"""SimHash near-duplicates through deletion-variant signatures.

Fingerprints of 64 bits that differ in at most ``distance`` bits are cut into ``distance // 2 + 1`` segments: by the
pigeonhole principle one segment of such a pair differs in at most one bit.  Every segment is indexed under all of
its one-wildcard variants (one bit left out), so such a pair shares a variant; an equality join on the variants
finds it and the whole fingerprints are compared.

Rows are reduced to distinct fingerprints first, so exact copies never meet in a bucket.  A bucket does not emit its
pairs: it emits a spanning forest of its verified links, which connects exactly what all the pairs would connect.
Buckets above ``BUCKET`` members are cut into blocks, and every pair of blocks is compared in a group of its own, so
no task holds a whole hot bucket and no pair is left out.

Edge cases: null and empty texts have fingerprint zero and link like any other; a text below ``words`` words is one
shingle; repeated rows and ties share a fingerprint and a component; an empty table gives an empty table; null ids
count as larger than every id, and a component of null ids only has a null ``component_id``.  Input columns other
than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collabstats.llm.common import materialize, partitions, small_batches
from collabstats.llm.components import connected_components, smallest_of

WORDS, DISTANCE, SEED = 3, 3, 42
#: Members of a variant bucket that are compared in one group.
BUCKET = 4096
#: Buckets up to this size are compared by array offsets, larger ones breadth-first.
SMALL = 16
#: Shingles hashed at once; a longer text is counted in several rounds.
ROUND = 1 << 16


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The SimHash of one whole text, as a signed 64-bit integer."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z change, and space and TAB to CR separate
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(parts) - words + 1)
    first, last = starts[:n].tolist(), (ends[words - 1:] if len(parts) >= words else ends[-1:]).tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, ROUND):
        hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(first[at:at + ROUND], last[at:at + ROUND], strict=True)], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, text: str = "text", seed: int = SEED, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``simhash`` (signed 64-bit) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, words, seed) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], names=[*batch.schema.names[:-1], "simhash"])

    small_batches(docs.sparkSession)
    chosen = docs.select(*keep, F.col(text).alias("__text"))
    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields[:-1], T.StructField("simhash", T.LongType())]))


def segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    count = distance // 2 + 1
    cuts = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def variants(simhash: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each fingerprint, for each segment and bit of it: the variant's name, and the segment without that bit."""
    names, values = [], []
    for number, (low, width) in enumerate(segments(distance)):
        part = (simhash.view(np.uint64) >> np.uint64(low)) & np.uint64((1 << width) - 1 if width < 64 else 2**64 - 1)
        for bit in range(width):
            names.append(np.full(len(part), number * 64 + bit, np.int16))
            values.append((part & ~np.uint64(1 << bit)).view(np.int64))
    return np.concatenate(names), np.concatenate(values)


def _forest(members: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints, found breadth-first."""
    left = members.view(np.uint64).copy()
    a, b = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= distance
            if near.any():
                found = left[near]
                left = left[~near]
                a.append(np.full(len(found), x))
                b.append(found)
                queue += list(found)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]).view(np.int64), np.concatenate([none, *b]).view(np.int64)


def bucket_links(group: np.ndarray, simhash: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of rows sorted by group, without any group's full set of pairs."""
    if not len(group):
        return simhash, simhash
    begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(begins, len(group)))
    a, b = [], []
    small = np.repeat(sizes <= SMALL, sizes)
    for step in range(1, min(SMALL, sizes.max())):
        i = np.flatnonzero((group[step:] == group[:-step]) & small[step:])
        i = i[np.bitwise_count((simhash[i] ^ simhash[i + step]).view(np.uint64)) <= distance]
        a.append(simhash[i])
        b.append(simhash[i + step])
    for begin, size in zip(begins[sizes > SMALL], sizes[sizes > SMALL]):
        x, y = _forest(np.unique(simhash[begin:begin + size]), distance)
        a.append(x)
        b.append(y)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def links(prints: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints (column ``simhash``) that connect all pairs within ``distance``."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(own), 4096):
                part = own[at:at + 4096]
                names, values = variants(part, distance)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(values), pa.array(np.tile(part, len(names) // max(1, len(part))))], names=["variant", "rest", "simhash"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> pa.RecordBatch:
            v, r, i, j, s = (table.column(c).to_numpy() for c in ("variant", "rest", "i", "j", "simhash"))
            change = (v[1:] != v[:-1]) | (r[1:] != r[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            x, y = bucket_links(np.concatenate([[0], np.cumsum(change)]) if len(s) else s, s, distance)
            low, high = np.minimum(x, y), np.maximum(x, y)
            edges = np.unique(np.stack([low, high], 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["a", "b"])

        key = None
        for batch in batches:  # sorted: the last group of a batch may go on in the next
            if not batch.num_rows:
                continue
            last = [batch.column(c)[batch.num_rows - 1].as_py() for c in ("variant", "rest", "i", "j")]
            held.append(batch)
            if last != key and sum(b.num_rows for b in held) >= 200_000:
                table = pa.Table.from_batches(held)
                cut = table.num_rows - 1
                names = ("variant", "rest", "i", "j")
                columns = [table.column(c).to_numpy() for c in names]
                same = np.logical_and.reduce([c == value for c, value in zip(columns, last)])
                cut = int(np.argmax(same))
                if cut:
                    yield done(table.slice(0, cut))
                held = table.slice(cut).to_batches()
            key = last
        if held:
            yield done(pa.Table.from_batches(held))

    distinct = prints.select("simhash").distinct()
    # each row becomes 64; by a key of its own, or Spark would take distinct's few coalesced partitions for these
    spread = distinct.repartition(partitions(prints.sparkSession), F.xxhash64("simhash"))
    keyed = spread.mapInArrow(expand, "variant short, rest long, simhash long")
    sizes = keyed.groupBy("variant", "rest").agg(F.count("*").alias("n")).where("n > 1")
    pieces = F.ceil(F.col("n") / bucket).cast("int")
    member = F.pmod(F.xxhash64("simhash"), F.col("pieces")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    blocks = (keyed.join(sizes.hint("merge"), ["variant", "rest"]).withColumn("pieces", pieces).withColumn("own", member).withColumn("other", other)
              .select("variant", "rest", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "simhash"))
    names = ["variant", "rest", "i", "j"]
    return (blocks.repartition(*names).sortWithinPartitions(*names, "simhash")
            .mapInArrow(compare, "a long, b long").distinct())


def _classes(prints: DataFrame, distance: int) -> DataFrame:
    """``simhash``, ``root`` and ``smallest`` (id) of every distinct fingerprint."""
    found = connected_components(links(prints, distance), "simhash-links")
    own = prints.groupBy("simhash").agg(F.min("doc_id").alias("smallest"))
    return own.join(found.withColumnRenamed("node", "simhash"), "simhash", "left").withColumn("root", F.coalesce("root", "simhash"))


def components(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``simhash`` and ``component_id`` (smallest id reachable) of every row."""
    prints = materialize(fingerprints(docs, words), "simhash")
    joined = _classes(prints, distance)
    labels = smallest_of(joined.select("simhash", "root", "smallest"), "smallest", "component_id").select("simhash", "component_id")
    return prints.join(labels.hint("merge"), "simhash").select("doc_id", "simhash", "component_id")


def deduplicate(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, then fingerprint, then values.

    A component of null ids keeps a row with a null id.
    """
    joined = _classes(materialize(fingerprints(docs, words), "simhash"), distance)
    kept = joined.groupBy("root").agg(F.min(F.struct(F.col("smallest").isNull().alias("none"), F.col("smallest").alias("id"), F.col("simhash").alias("print"))).alias("k")).select("k.id", "k.print")
    own = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    marked = fingerprints(own, words, keep=("row", "doc_id"))
    first = marked.join(kept.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("simhash") == F.col("print"))).groupBy("id", "print").agg(F.min("row").alias("row"))
    return first.select("row.*")


def hex_print(column: str = "simhash") -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))
