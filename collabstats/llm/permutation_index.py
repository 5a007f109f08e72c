"""Approximate nearest neighbours (largest cosine) from a permutation index.

``PIVOTS`` vectors, chosen by a hash of their id, order every vector's view of the space: a vector is represented by
the order of the pivots, nearest first.  It is posted in the inverted files of its ``POSTED`` nearest pivots; a query
reads the files of its ``READ`` nearest.  A file's vectors are ranked by the footrule distance between their order and
the query's, and the nearest ``SHARE`` of them is reranked by the exact cosine of the original vectors.

Equal vectors are represented once, by their smallest ids (as many as a result can hold), and equal queries are
answered once, so a vector shared by a third of the rows is one entry.  Large files are cut into blocks, and the queries
that read a file too, so a task holds a bounded part of each; only the best rows of a block leave it.  A query for which the files hold fewer rows than it needs is answered exactly, against all
rows in blocks.

Measured recall is in the README, with the part of all vectors that a query ranks.  Edge cases: vectors that are null,
zero, hold a null or a value that is not finite, or have another length than most (of equally common lengths the
smallest) take no part, as do rows without id; rows with the query's own id are
the query's own; ties go to the smaller id; with fewer candidates than wanted all are returned; an empty table gives
an empty table.  Input columns other than id and vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from collabstats.llm.common import materialize

#: Bounded sample that the index is fitted on; files that a vector is posted in, and that a query reads.
PIVOTS, POSTED, READ = 256, 10, 20
#: Part of a file's block that is reranked, and its least number of vectors; vectors and queries in a block.
SHARE, LEAST, BLOCK, ASKED = 0.25, 64, 8192, 32_768
#: Cosines closer than this are compared by the exact formula.
SLACK = 1e-9


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vec`` (array of doubles) of the rows that take part."""
    chosen = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return chosen.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda x: x != 0))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, width)


def _ranks(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pivots in order of nearness, and the place of each pivot in it."""
    order = np.argsort(-(_unit(rows) @ pivots.T), axis=1, kind="stable").astype(np.int16)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1], dtype=np.int16)[None].repeat(len(order), 0), 1)
    return order, place


def cosine(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines, each from its own row only, so equal rows get equal values."""
    return (rows * query).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def _best(query: np.ndarray, rows: np.ndarray, unit: np.ndarray, ids: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` nearest rows: largest cosine, then smallest id."""
    rough = unit @ (query / np.linalg.norm(query))
    if len(rough) > wanted:
        near = np.flatnonzero(rough >= np.partition(rough, len(rough) - wanted)[len(rough) - wanted] - SLACK)
    else:
        near = np.arange(len(rough))
    exact = cosine(query, rows[near])
    order = np.lexsort((ids[near], -exact))[:wanted]
    return near[order], exact[order]


def search(vectors: DataFrame, every: int = 50, wanted: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``wanted`` nearest rows to each row whose id is a multiple of ``every``."""
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, vector)
    common = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = common["size"]
    rows = rows.where(F.size("vec") == width)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()  # bounded by PIVOTS
    pivots = _unit(np.array([r["vec"] for r in sample]))
    shared = spark.sparkContext.broadcast(pivots)
    depth = wanted + 1  # a query may find itself

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy()
            matrix = flat.reshape(-1, width)
            near = _ranks(matrix, shared.value)[0][:, :READ] if len(matrix) else np.zeros((0, READ), np.int16)
            packed = matrix.astype("<f8").tobytes()
            step = 8 * width
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([packed[i:i + step] for i in range(0, len(packed), step)], pa.binary()), pa.array(near.tolist(), pa.list_(pa.int16()))], names=["vec_id", "vec", "near"])

    ordered = materialize(rows.mapInArrow(order, "vec_id long, vec binary, near array<short>"), "ann-order")
    place = F.row_number().over(W.partitionBy("vec").orderBy("vec_id"))
    entries = materialize(ordered.withColumn("place", place).where(F.col("place") <= depth).select("vec_id", "vec", "near"), "ann-entries")
    asked = ordered.where(F.pmod("vec_id", F.lit(every)) == 0)
    queries = materialize(asked.select("vec", "near").distinct().withColumn("query", F.monotonically_increasing_id()), "ann-queries")

    posts = entries.select("vec_id", "vec", F.explode(F.slice("near", 1, POSTED)).alias("pivot"))
    sizes = {r["pivot"]: -(-r["n"] // BLOCK) for r in posts.groupBy("pivot").agg(F.count("*").alias("n")).collect()}  # a row per pivot
    blocks = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (int(k), n))), F.col("pivot").cast("int")), F.lit(0))
    # a file's queries come in blocks of about ASKED, each of which meets the file's vectors by itself
    parts = max(1, -(-queries.count() * READ // (ASKED * len(pivots))))
    members = (posts.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks).cast("int"))
               .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    reads = (queries.select("query", "vec", F.explode(F.slice("near", 1, READ)).alias("pivot")).withColumn("blocks", blocks).where("blocks > 0")
             .select("query", "vec", "pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                     F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int").alias("part")))

    def rank(key: tuple, own: pa.Table, asking: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if own.num_rows and asking.num_rows:
            data, ids = _matrix(own.column("vec"), width), own.column("vec_id").to_numpy()
            unit = _unit(data)
            _, place = _ranks(data, shared.value)
            wants = _matrix(asking.column("vec"), width)
            orders, places = _ranks(wants, shared.value)
            pivot = key[0].as_py()
            for number, query, near, own_place in zip(asking.column("query").to_pylist(), wants, orders, places, strict=True):
                # a vector that stands in a file that the query reads earlier is ranked there
                earlier = near[:int(own_place[pivot])]
                left = np.flatnonzero(~(place[:, earlier] < POSTED).any(axis=1))
                if not len(left):
                    continue
                footrule = np.abs(place[left] - own_place).sum(axis=1, dtype=np.int64)
                keep = min(len(left), max(LEAST, int(SHARE * len(left))))
                left = left[footrule <= np.partition(footrule, keep - 1)[keep - 1]]
                at, scores = _best(query, data[left], unit[left], ids[left], depth)
                found += [(number, int(i), float(s)) for i, s in zip(ids[left[at]], scores)]
        return _found(found)

    def exact(_: tuple, own: pa.Table, asking: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if own.num_rows and asking.num_rows:
            data, ids = _matrix(own.column("vec"), width), own.column("vec_id").to_numpy()
            unit = _unit(data)
            for number, query in zip(asking.column("query").to_pylist(), _matrix(asking.column("vec"), width), strict=True):
                at, scores = _best(query, data, unit, ids, depth)
                found += [(number, int(i), float(s)) for i, s in zip(ids[at], scores)]
        return _found(found)

    schema = "query long, vec_id long, score double"
    key = ("pivot", "block", "part")
    ranked = materialize(members.select(*key, "vec_id", "vec").groupBy(*key).cogroup(reads.groupBy(*key)).applyInArrow(rank, schema), "ann-found")
    total = entries.count()
    enough = ranked.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") >= min(depth, total))
    short = materialize(queries.join(enough, "query", "left_anti").select("query", "vec"), "ann-short")
    if short.limit(1).count():
        cut, dealt = -(-total // BLOCK), max(1, -(-short.count() // ASKED))
        everything = entries.select("vec_id", "vec", F.pmod(F.xxhash64("vec_id"), F.lit(cut)).alias("block"),
                                    F.explode(F.sequence(F.lit(0), F.lit(dealt - 1))).alias("part"))
        again = short.select("query", "vec", F.explode(F.sequence(F.lit(0), F.lit(cut - 1))).cast("bigint").alias("block"),
                             F.pmod(F.xxhash64("query"), F.lit(dealt)).cast("int").alias("part"))
        ranked = ranked.join(short, "query", "left_anti").unionByName(
            everything.groupBy("block", "part").cogroup(again.groupBy("block", "part")).applyInArrow(exact, schema))

    best = W.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    top = ranked.withColumn("place", F.row_number().over(best)).where(F.col("place") <= depth)
    named = asked.select(F.col("vec_id").alias("query_id"), "vec").distinct().join(queries.select("query", "vec"), "vec").select("query", "query_id")
    answers = named.join(top.drop("place"), "query").where("vec_id <> query_id")
    by_query = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return answers.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= wanted).select("query_id", "rank", "vec_id", "score")


def _found(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
    return pa.table({"query": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})
