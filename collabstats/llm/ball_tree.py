"""Ranked lexical search: exact inner products over sparse documents, pruned by ball trees.

* Vectors.  A document becomes the sparse vector of its term gains: along the axis of a term of the items it has
  weight(term) * gain(tf, length), all in 64-bit integers.  An item is a set S of terms, and its score is the inner product of
  the set's 0/1 vector with the document's.
* Trees.  Each task gathers its documents in blocks and grows a ball tree over each: a node has the centroid of its documents,
  the radius around it, and how far its documents reach along each axis; documents are halved along the line between two
  that lie far apart.  Halving by position ends for copies, too.
* Search.  No document of a node scores above centroid . S + radius * sqrt(axes of S that the node reaches), nor above the sum
  of its reaches along S.  Bounds are rounded up by more than any error of double arithmetic.  Nodes are opened best bound
  first; a subtree goes once its bound is below the item's worst kept score, or equals it and its smallest id
  comes later.  Leaves are scored exactly in integers.  An item's kept list passes from block to block of a task, so later
  blocks are pruned from the start; a task hands on at most ``top`` rows per item, from which a window picks the best.

Size.  Terms and sets of the items are broadcast; their number is counted first, and beyond ``PAIRS`` the items are dealt to
several groups by hash, each searched against all documents.  Memory of a task is bounded by ``ROWS`` and ``ENTRIES`` of a
block and ``CELLS`` of a tree.  Copies are equal points of a tree and need no special care; no step gathers a key's rows but
the last, which holds ``top`` rows of an item from each task.

Edge cases: null, empty or wordless texts count nowhere and are never found.  Rows that share an item_id (null included) are
one item with all their terms; items without terms, or whose terms no document holds, give no rows.  Repeated document rows
are ranked one after another; a null doc_id comes last among equal scores.  Empty tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from collabstats.llm.common import materialize
from collabstats.llm.words import pieces, split, words_of

#: Documents returned for an item.
TOP = 50
#: (item, term) pairs of one group of items.
PAIRS = 400_000
#: Documents and vector entries of a block, documents of a leaf, and cells (nodes x terms) of a tree.
ROWS, ENTRIES, LEAF, CELLS = 8192, 2_000_000, 64, 4_000_000
#: Part by which bounds are rounded up: far above the error of a sum of doubles of one sign, of any length met here.
SAFE = 1e-9


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id`` and ``term`` of every item, without repeats."""
    return items.select("item_id", F.explode(F.array_distinct(words_of(F.col("text")))).alias("term")).distinct()


def term_vectors(docs: DataFrame, terms: pa.Array) -> DataFrame:
    """``doc_id``, ``n`` (terms of the text with repeats), and those of ``terms`` (by number) that it holds, with their counts.
    Documents without any term go."""
    sent = docs.sparkSession.sparkContext.broadcast(terms.to_pylist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(sent.value, pa.string())
        for batch in pieces(batches):
            words, counts = split(batch.column("text"))
            codes = pc.index_in(words, value_set=known)
            held = pc.is_valid(codes).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(counts)), counts)[held]
            code = pc.drop_null(codes).to_numpy().astype(np.int64)
            keys, times = np.unique(row * max(len(known), 1) + code, return_counts=True)
            per_row = np.bincount(keys // max(len(known), 1), minlength=len(counts))
            offsets = pa.array(np.r_[0, np.cumsum(per_row)], pa.int32())
            out = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(keys % max(len(known), 1), pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))], names=["doc_id", "n", "terms", "times"])
            yield out.filter(pa.array(counts > 0))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, times array<int>")


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """Weight of each term from the number of documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def gains(times: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Gain of a term's occurrences in a document of ``n`` terms; integers only."""
    m = 100 - 50 + (50 * n * documents) // total
    return (1_000_000_000 * times) // (1000 * times + 20 * m)


class Points:
    """Rows of sparse integer vectors: entries ``ptr[i]:ptr[i + 1]`` belong to row i, which has at least one."""

    def __init__(self, ids: np.ndarray, ptr: np.ndarray, axis: np.ndarray, value: np.ndarray):
        self.ids, self.ptr, self.axis, self.value = ids, ptr, axis, value

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, rows: np.ndarray) -> Points:
        sizes = np.diff(self.ptr)[rows]
        ptr = np.r_[0, np.cumsum(sizes)]
        at = np.repeat(self.ptr[rows] - ptr[:-1], sizes) + np.arange(ptr[-1])
        return Points(self.ids[rows], ptr, self.axis[at], self.value[at])

    def products(self, dense: np.ndarray) -> np.ndarray:
        """Inner product of every row with a dense vector."""
        return np.add.reduceat(dense[self.axis] * self.value, self.ptr[:-1])


class BallTree:
    """Nodes by number, 0 the root: inner ones have two children, leaves their points."""

    def __init__(self, points: Points, axes: int, leaf: int):
        self.children: dict[int, tuple[int, int]] = {}
        self.leaves: dict[int, Points] = {}
        self.first_id: list[int] = []
        centroids, reaches, radii = [], [], []
        waiting = [(points, -1)]
        while waiting:
            here, parent = waiting.pop()
            node = len(centroids)
            if parent >= 0:
                self.children[parent] = (*self.children.get(parent, ()), node)
            centre = np.bincount(here.axis, weights=here.value, minlength=axes) / len(here)
            reach = np.zeros(axes)
            np.maximum.at(reach, here.axis, here.value.astype(np.float64))
            squares = np.add.reduceat(here.value.astype(np.float64) ** 2, here.ptr[:-1])
            own = centre @ centre
            far = squares - 2 * here.products(centre) + own
            radii.append(math.sqrt(max(float(np.max(far + SAFE * (squares + own))), 0.0)))   # differences of near numbers: rounded up by their size
            centroids.append(centre)
            reaches.append(reach)
            self.first_id.append(int(here.ids.min()))
            if len(here) <= leaf:
                self.leaves[node] = here
                continue
            halves = self._halve(here, squares, int(np.argmax(far)), axes)
            waiting.extend((half, node) for half in halves)
        self.centroids, self.reaches, self.radii = np.array(centroids).T, np.array(reaches).T, np.array(radii)

    @staticmethod
    def _halve(points: Points, squares: np.ndarray, start: int, axes: int) -> tuple[Points, Points]:
        def dense(row: int) -> np.ndarray:
            out = np.zeros(axes)
            out[points.axis[points.ptr[row]:points.ptr[row + 1]]] = points.value[points.ptr[row]:points.ptr[row + 1]]
            return out

        one = dense(start)
        other = dense(int(np.argmax(squares - 2 * points.products(one))))
        order = np.argsort(points.products(other - one), kind="stable")
        return points.take(np.sort(order[:len(order) // 2])), points.take(np.sort(order[len(order) // 2:]))

    def bounds(self, terms: np.ndarray) -> np.ndarray:
        """What no document of a node scores above, for every node."""
        reach = self.reaches[terms]
        ball = (self.centroids[terms].sum(axis=0) + np.sqrt((reach > 0).sum(axis=0)) * self.radii) * (1 + SAFE) + 1
        return np.minimum(ball, reach.sum(axis=0))    # the reaches are whole numbers below 2 ** 53: their sum is exact


class Best:
    """The best ``top`` documents of an item so far, best first; ids are the order among equal scores."""

    def __init__(self, top: int):
        self.top, self.scores, self.ids = top, np.empty(0, np.int64), np.empty(0, np.int64)

    def worst(self) -> tuple[int, int]:
        """(score, id) that a document has to beat: by score, or by id at an equal score."""
        return (int(self.scores[-1]), int(self.ids[-1])) if len(self.scores) == self.top else (0, -1)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        score, last = self.worst()
        better = (scores > score) | ((scores == score) & (ids < last))
        if better.any():
            scores, ids = np.r_[self.scores, scores[better]], np.r_[self.ids, ids[better]]
            order = np.lexsort((ids, -scores))[:self.top]
            self.scores, self.ids = scores[order], ids[order]


def search(tree: BallTree, terms: np.ndarray, axes: int, best: Best) -> int:
    """Adds the tree's documents that belong to the item's best; returns how many leaves were scored."""
    bounds = tree.bounds(terms)
    wanted = np.zeros(axes, np.int64)
    wanted[terms] = 1
    opened, scored = [(-bounds[0], 0)], 0
    while opened:
        bound, node = heapq.heappop(opened)
        score, last = best.worst()
        if -bound < max(score, 1):
            break                                    # every node left has a bound no higher
        if -bound < score + 1 and tree.first_id[node] > last:
            continue                                 # at most ties, all of later ids
        if node in tree.leaves:
            points = tree.leaves[node]
            best.add(points.products(wanted), points.ids)
            scored += 1
        else:
            for child in tree.children[node]:
                heapq.heappush(opened, (-bounds[child], child))
    return scored


#: The order of a null id: after all others.
NO_ID = np.iinfo(np.int64).max


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in blocks of at most about ``ROWS`` rows and ``ENTRIES`` entries."""
    held, rows, entries = [], 0, 0
    for batch in pieces(batches, ROWS // 8):
        held.append(batch)
        rows += batch.num_rows
        entries += len(batch.column("terms").flatten())
        if rows >= ROWS or entries >= ENTRIES:
            yield pa.Table.from_batches(held)
            held, rows, entries = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _points(block: pa.Table, weight: np.ndarray, documents: int, total: int) -> Points:
    ids = pc.fill_null(block["doc_id"], int(NO_ID)).to_numpy()
    lists = block["terms"].combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    axis = lists.flatten().to_numpy().astype(np.int64)
    times = block["times"].combine_chunks().flatten().to_numpy().astype(np.int64)
    value = weight[axis] * gains(times, np.repeat(block["n"].to_numpy(), sizes), documents, total)
    row = np.repeat(np.arange(len(ids)), sizes)[value > 0]
    kept = np.unique(row)
    ptr = np.r_[0, np.cumsum(np.bincount(row, minlength=len(ids))[kept])]
    return Points(ids[kept], ptr, axis[value > 0], value[value > 0])


def _best(vectors: DataFrame, items: list[np.ndarray], names: list[int | None], weight: np.ndarray, documents: int, total: int, top: int) -> DataFrame:
    """``item_id``, ``score``, ``doc_id`` of each task's best documents of each item."""
    sent = vectors.sparkSession.sparkContext.broadcast((items, names, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, names, weight = sent.value
        best = [Best(top) for _ in items]
        for block in _blocks(batches):
            points = _points(block, weight, documents, total)
            if len(points):
                tree = BallTree(points, len(weight), max(LEAF, -(-2 * len(points) * len(weight) // CELLS)))
                for terms, found in zip(items, best, strict=True):
                    search(tree, terms, len(weight), found)
        for first in range(0, len(items), 1000):
            part, ids = best[first:first + 1000], names[first:first + 1000]
            doc = np.concatenate([b.ids for b in part])
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, b in zip(ids, part, strict=True) for _ in b.ids], pa.int64()),
                 pa.array(np.concatenate([b.scores for b in part]), pa.int64()), pa.array(doc, pa.int64(), mask=doc == NO_ID)],
                names=["item_id", "score", "doc_id"])

    return vectors.select("doc_id", "n", "terms", "times").mapInArrow(run, "item_id bigint, score bigint, doc_id bigint")


def rank(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: the ``top`` best documents of each item with a score above 0."""
    pairs = materialize(item_terms(items.select(F.col("item_id").cast("bigint").alias("item_id"), "text")), "item-terms")
    groups = max(1, math.ceil(pairs.count() / PAIRS))
    found = None
    for g in range(groups):
        held = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).toArrow()
        terms = pc.unique(held["term"])
        numbers = pc.index_in(held["term"], value_set=terms).to_numpy()
        sets: dict[int | None, list[int]] = {}
        for item, number in zip(held["item_id"].to_pylist(), numbers, strict=True):
            sets.setdefault(item, []).append(number)
        vectors = materialize(term_vectors(docs.select("doc_id", "text"), terms), "term-vectors")
        documents, total = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(terms), np.int64)
        for number, count in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():   # as many rows as the items have terms
            df[number] = count
        names = sorted(sets, key=lambda i: (i is None, i))
        own = _best(vectors, [np.array(sorted(sets[i])) for i in names], names, weights(df, documents), documents, total, top)
        found = own if found is None else found.unionByName(own)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
