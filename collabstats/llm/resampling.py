"""Importance resampling towards the benchmark's word distribution, drawn by parallel sorting with regular samples.

* Weights.  Words fall into hashed buckets.  One pass over each table counts the buckets (an array per task, summed by bucket),
  and a bucket's gain, the scaled log ratio of both tables' shares, is an array that every task holds: a document's weight is a
  sum of array places.  Noise that depends on the id alone turns weights into scores, so the highest scores are a
  sample without repeats by weight.
* Sorting.  The pass that scores also sorts: each task emits sorted runs, numbered by position, and they are written.
  Regular positions of the runs give regular splitters; each row's segment follows from them, and segments are
  counted.  Prefix sums of these counts are the rank before each segment.  Only segments that begin within the draw are
  exchanged: each is merged by itself, and position in it plus the ranks before it is the exact rank.

The sort key ends in the row's place in the written runs, so no two keys are equal: segments stay even although scores, ids or
whole rows repeat, whatever a third of all rows may share.  To the driver come the buckets' counts, the regular samples (about
``SEGMENTS`` x ``OVER`` and one of each run) and the segments' counts.

Edge cases: null and empty texts have no features, weight 0 and no rank.  A null doc_id is hashed as an empty one and comes last
among equal scores.  Repeated rows each have a rank of their own.  Without benchmark words the gains lean to rare buckets only by
the add-one rule; empty documents give no rows.  Columns other than id and text are dropped first.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from collabstats.llm.common import materialize, partitions
from collabstats.llm.words import pieces, split

#: Words in a row that make a feature, buckets, and the seed of the noise.
WORDS, BUCKETS, SEED = 1, 10_000, 2024
#: Words that a document must have to be drawn, and the percentage drawn of those.
LEAST, PERCENT = 20, 10
#: Rows of a sorted run, most segments, and regular samples for each segment.
RUN, SEGMENTS, OVER = 500_000, 4096, 32

SCORED = "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint, pos bigint"


def features(words: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every feature, one text after another, and the number of features of each text.  Each distinct feature of the
    batch is hashed once."""
    if WORDS == 1:
        coded = words.dictionary_encode()
        bucket = np.fromiter((zlib.crc32(w.encode()) % BUCKETS for w in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        return bucket[coded.indices.to_numpy()], counts
    own, found, ends = words.to_pylist(), [], np.cumsum(counts)
    number = np.zeros(len(counts), np.int64)
    for i, (n, end) in enumerate(zip(counts.tolist(), ends.tolist(), strict=True)):
        for size in range(1, WORDS + 1):
            found += [zlib.crc32(" ".join(own[at:at + size]).encode()) % BUCKETS for at in range(end - n, end - size + 1)]
            number[i] += max(n - size + 1, 0)
    return np.array(found, np.int64), number


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS, np.int64)
        for batch in pieces(batches):
            held += np.bincount(features(*split(batch.column(0)))[0], minlength=BUCKETS)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at], pa.int64())], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in texts.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n")).collect():   # at most BUCKETS rows
        out[bucket] = n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket; counts of documents and of the target texts."""
    s, t = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(b) + 1) * (s + BUCKETS) / ((float(a) + 1) * (t + BUCKETS)))) for a, b in zip(source, target, strict=True)], np.int64)


def noise(doc_id: int | None) -> int:
    """Noise of a document, by its id alone."""
    h = int(hashlib.sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored_runs(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """Scored documents as sorted runs of at most ``RUN`` rows; ``pos`` is the position in the run."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, held, rows = sent.value, [], 0
        for batch in pieces(batches):
            words, counts = split(batch.column("text"))
            buckets, number = features(words, counts)
            upto = np.r_[0, np.cumsum(gain[buckets])]
            ends = np.cumsum(number)
            weight = upto[ends] - upto[ends - number]
            score = weight + np.array([noise(i) for i in batch.column("doc_id").to_pylist()], np.int64)
            held.append(pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (counts, number, weight, score))],
                                                   names=["doc_id", "n_words", "n_features", "weight", "score"]))
            rows += batch.num_rows
            if rows >= RUN:
                yield from ordered(held)
                held, rows = [], 0
        if held:
            yield from ordered(held)

    def ordered(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held).sort_by([("score", "descending"), ("doc_id", "ascending")])   # nulls last
        yield from whole.append_column("pos", pa.array(np.arange(len(whole)), pa.int64())).to_batches(max_chunksize=10_000)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SCORED)


def _keys(table: pa.Table | pa.RecordBatch) -> list[np.ndarray]:
    """Sort keys for ``lexsort``, the last one first: score from high to low, id with null last, place."""
    ids = table["doc_id"]
    return [np.asarray(table["place"]), np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), -np.asarray(table["score"])]


def splitters(samples: pa.Table, segments: int) -> pa.Table:
    """The regular samples that part all rows into about ``segments`` even segments."""
    order = np.lexsort(_keys(samples))
    step = max(1, math.ceil(len(order) / segments))
    return samples.take(order[step::step])


def with_segment(rows: DataFrame, cuts: pa.Table) -> DataFrame:
    """``rows`` with ``segment``: how many splitters come before the row, or are it."""
    sent = rows.sparkSession.sparkContext.broadcast(cuts.to_pydict())
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("score", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64())])
        first = pa.Table.from_pydict(sent.value, schema=kinds)
        for batch in batches:
            order = np.lexsort([np.concatenate(pair) for pair in zip(_keys(first), _keys(batch), strict=True)])
            segment = np.empty(len(order), np.int32)
            segment[order] = np.cumsum(order < len(first))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment[len(first):])], names=[*names, "segment"])

    schema = ", ".join(f"{c} {k}" for c, k in rows.dtypes)
    return rows.mapInArrow(run, f"{schema}, segment int")


def draw(rows: DataFrame, count: int, wanted: int) -> DataFrame:
    """``rows`` (``count`` of them, written, with ``score``, ``doc_id``, ``pos``, ``place``) with ``rank``: 1 to ``wanted`` by
    score from high to low, then id, then place; null for the rest."""
    segments = min(SEGMENTS, 4 * partitions(rows.sparkSession))
    stride = max(1, count // (segments * OVER))
    samples = rows.where(F.pmod("pos", F.lit(stride)) == 0).select("score", "doc_id", "place").toArrow()   # about SEGMENTS * OVER rows, and one of each run
    dealt = with_segment(rows, splitters(samples, segments))
    counts = sorted(tuple(r) for r in dealt.groupBy("segment").count().collect())       # at most SEGMENTS rows
    before, total = {}, 0
    for segment, n in counts:
        before[segment] = total
        total += n
    within = [s for s in before if before[s] < wanted]
    none = F.lit(None).cast("bigint")
    if not within:
        return dealt.withColumn("rank", none)
    last = max(within)
    start = F.element_at(F.create_map(*(F.lit(x) for s in within for x in (s, before[s]))), F.col("segment"))
    order = Window.partitionBy("segment").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "place")
    merged = dealt.where(F.col("segment") <= last).withColumn("rank", (F.row_number().over(order) + start).cast("bigint"))
    return merged.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).unionByName(
        dealt.where(F.col("segment") > last).withColumn("rank", none))


def resample(docs: DataFrame, target: DataFrame, least: int = LEAST, percent: int = PERCENT) -> DataFrame:
    """Every document's ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn)."""
    gain = bucket_gains(bucket_counts(docs), bucket_counts(target))
    runs = materialize(scored_runs(docs, gain).withColumn("place", F.monotonically_increasing_id()), "runs")
    able = runs.where(F.col("n_words") >= least)
    count = able.count()
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    rest = runs.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("bigint"))
    return draw(able, count, count * percent // 100).select(*columns).unionByName(rest.select(*columns))
