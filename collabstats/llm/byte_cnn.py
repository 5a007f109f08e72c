"""A byte-level convolutional quality classifier in numpy.

The bytes of a whole text pass through ``FILTERS`` learned filters (``WIDTH`` bytes, every ``STRIDE`` bytes).  The
responses are max-pooled over overlapping chunks that cover the document (``2 * HALF`` filter places, half of them
shared with the next chunk); mean, largest and smallest of the chunks' values go through one hidden layer to one
probability.  A filter over one-hot bytes is a table lookup per byte, so the convolution adds up rows of a table.

The network is fitted with Adam in one task, on at most ``SAMPLE`` labelled rows with the smallest hashes of their
ids, together of at most ``SAMPLE_BYTES``, none longer than ``LONGEST``; the weights have a fixed size.  Scoring is
one pass over the documents without a shuffle, ``ROWS`` texts at a time.

Edge cases: null and empty texts are one chunk of padding; a text of any length is scored whole, in pieces; without
labels every score is 0.5, with one label only it is that label's smoothed share; several labels of one id count by
their mean; repeated rows get equal scores; an empty table gives an empty table.  Input columns other than id and
text are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collabstats.llm.words import pieces

SAMPLE, EPOCHS, BATCH, RATE = 4000, 10, 64, 0.01
#: Bytes of the texts that the network is fitted on, and of one of them.
SAMPLE_BYTES, LONGEST = 64 << 20, 8 << 20
#: Texts that are turned into Python objects at once.
ROWS = 1000
FILTERS, WIDTH, STRIDE, HALF, HIDDEN = 24, 8, 4, 32, 16
#: Bytes of a half chunk, and bytes that are convolved at once.
_HALF_BYTES = HALF * STRIDE
PIECE = 1 << 19


def halves(text: bytes) -> np.ndarray:
    """The text's bytes, padded with zeros to whole half chunks (one row each, with the bytes that its last place sees)."""
    count = max(1, -(-len(text) // _HALF_BYTES))
    data = np.zeros(count * _HALF_BYTES + WIDTH - STRIDE, np.uint8)
    data[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, _HALF_BYTES + WIDTH - STRIDE)[::_HALF_BYTES]


def convolve(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Filter responses of half chunks: half, place, filter."""
    out = table[0][rows[:, 0:_HALF_BYTES:STRIDE]]
    for w in range(1, WIDTH):
        out += table[w][rows[:, w:w + _HALF_BYTES:STRIDE]]
    return out


def _chunks(owner: np.ndarray) -> np.ndarray:
    """Of each half chunk, the second half of its chunk: the next one of its document, or itself in the last chunk."""
    n = len(owner)
    following = np.minimum(np.arange(n) + 1, n - 1)
    return np.where(owner[following] == owner, following, np.arange(n))


def _pool(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    counts = np.diff(np.append(begins, len(values)))[:, None]
    return np.concatenate([np.add.reduceat(values, begins) / counts, np.maximum.reduceat(values, begins), np.minimum.reduceat(values, begins)], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(texts: list[bytes], labels: np.ndarray, seed: int = 5) -> dict:
    """Weights from labelled texts."""
    share = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else 0.5
    if len(labels) == 0 or labels.min() == labels.max():
        return {"share": float(share)}
    rng = np.random.default_rng(seed)
    w = {
        "table": rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32), "bias": np.zeros(FILTERS, np.float32),
        "hidden": rng.normal(0, (3 * FILTERS) ** -0.5, (3 * FILTERS, HIDDEN)).astype(np.float32), "hidden_bias": np.zeros(HIDDEN, np.float32),
        "out": rng.normal(0, HIDDEN ** -0.5, HIDDEN).astype(np.float32), "out_bias": np.full(1, np.log(share / (1 - share)), np.float32),
    }
    w["table"][:, 0] = 0
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    rows = [halves(t) for t in texts]
    # documents of like length share a batch; the batches come in random order
    order = np.argsort([len(r) for r in rows], kind="stable")
    batches = [order[i:i + BATCH] for i in range(0, len(order), BATCH)]
    step = 0
    total = EPOCHS * len(batches)
    for _ in range(EPOCHS):
        for number in rng.permutation(len(batches)):
            pick = batches[number]
            step += 1
            grads = _gradients(w, [rows[i] for i in pick], labels[pick])
            rate = RATE * min(1.0, 1.5 * (1 - step / (total + 1)))
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                w[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
            w["table"][:, 0] = 0
    return w


def _gradients(w: dict, batch: list[np.ndarray], labels: np.ndarray) -> dict:
    sizes = np.array([len(r) for r in batch])
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(batch)), sizes)
    best, at = [], []
    for rows in batch:
        for i in range(0, len(rows), PIECE // _HALF_BYTES):
            response = convolve(rows[i:i + PIECE // _HALF_BYTES], w["table"])
            place = response.argmax(axis=1)
            at.append(place)
            best.append(np.take_along_axis(response, place[:, None], 1)[:, 0])
    best, at = np.concatenate(best), np.concatenate(at)
    after = _chunks(owner)
    second = best[after] > best
    chunk = np.tanh(np.where(second, best[after], best) + w["bias"])
    counts = sizes[:, None].astype(np.float32)
    mean, high, low = np.split(_pool(chunk, begins), 3, axis=1)
    pooled = np.concatenate([mean, high, low], axis=1)
    hidden = np.tanh(pooled @ w["hidden"] + w["hidden_bias"])
    error = (_sigmoid(hidden @ w["out"] + w["out_bias"]) - labels) / len(labels)
    back = np.outer(error, w["out"]) * (1 - hidden ** 2)
    into = back @ w["hidden"].T
    of_mean, of_high, of_low = np.split(into, 3, axis=1)
    # neighbouring chunks often share a largest response: its gradient is shared out among them
    d_chunk = (of_mean / counts)[owner]
    for into_one, value in ((of_high, high), (of_low, low)):
        tied = chunk == value[owner]
        d_chunk = d_chunk + (into_one / np.add.reduceat(tied, begins, dtype=np.int64))[owner] * tied
    d_chunk *= 1 - chunk ** 2
    # the gradient goes to the place of each chunk's largest response
    half = np.where(second, after[:, None], np.arange(len(owner))[:, None])
    filters = np.broadcast_to(np.arange(FILTERS), half.shape)
    place = at[half, filters]
    stacked = np.concatenate(batch)
    d_table = np.zeros((WIDTH, 256, FILTERS), np.float32)
    for i in range(WIDTH):
        cell = stacked[half, place * STRIDE + i].astype(np.int64) * FILTERS + filters
        d_table[i] = np.bincount(cell.ravel(), weights=d_chunk.ravel(), minlength=256 * FILTERS).reshape(256, FILTERS)
    return {
        "table": d_table + 1e-5 * w["table"], "bias": d_chunk.sum(axis=0), "hidden": pooled.T @ back + 1e-4 * w["hidden"], "hidden_bias": back.sum(axis=0),
        "out": hidden.T @ error, "out_bias": np.array([error.sum()], np.float32),
    }


def probability(w: dict, texts: list[bytes]) -> np.ndarray:
    """One probability per text."""
    if "table" not in w:
        return np.full(len(texts), w["share"])
    pooled = np.zeros((len(texts), 3 * FILTERS))
    rows = [halves(t) for t in texts]
    i = 0
    while i < len(rows):  # documents side by side up to a piece, a longer one by itself in several
        j, size = i, 0
        while j < len(rows) and (j == i or size + len(rows[j]) <= PIECE // _HALF_BYTES):
            size += len(rows[j])
            j += 1
        sizes = np.array([len(r) for r in rows[i:j]])
        stacked = np.concatenate(rows[i:j]) if j - i > 1 else rows[i]
        best = np.concatenate([convolve(stacked[a:a + PIECE // _HALF_BYTES], w["table"]).max(axis=1) for a in range(0, len(stacked), PIECE // _HALF_BYTES)])
        owner = np.repeat(np.arange(j - i), sizes)
        chunk = np.tanh(np.maximum(best, best[_chunks(owner)]) + w["bias"])
        pooled[i:j] = _pool(chunk, np.cumsum(sizes) - sizes)
        i = j
    hidden = np.tanh(pooled @ w["hidden"] + w["hidden_bias"])
    return _sigmoid(hidden @ w["out"] + w["out_bias"]).astype(np.float64)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", sample: int = SAMPLE) -> dict:
    """Weights fitted on at most ``sample`` rows of ``docs`` with a label, the ones with the smallest hashes of their ids."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("double").alias("__label"))
    ids = docs.select("doc_id").distinct().join(known, "doc_id").orderBy(F.xxhash64("doc_id", F.lit(6)), "doc_id").limit(sample)
    texts = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("__text")).join(F.broadcast(ids), "doc_id")  # at most ``sample`` ids
    short = texts.where(F.octet_length("__text") <= LONGEST)
    each = short.groupBy("doc_id").agg(F.min("__text").alias("__text"), F.first("__label").alias("__label"))
    # the at most ``sample`` rows meet in the one task that fits them, in the order of their hashes
    so_far = W.orderBy(F.xxhash64("doc_id", F.lit(6)), "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    chosen = each.withColumn("__bytes", F.sum(F.octet_length("__text").cast("bigint")).over(so_far)).where(F.col("__bytes") <= SAMPLE_BYTES).drop("__bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["doc_id"], r["__text"], r["__label"]) for b in batches for r in b.to_pylist())
        w = fit([t.encode("utf-8") for _, t, _ in rows], np.array([x for _, _, x in rows]))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(w)], pa.binary())], names=["weights"])

    found = chosen.mapInArrow(run, "weights binary").collect()
    return pickle.loads(found[0]["weights"]) if found and found[0]["weights"] else fit([], np.zeros(0))


def predict(docs: DataFrame, weights: dict, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, ROWS):
            scores: list[np.ndarray] = [np.zeros(0)]
            part: list[bytes] = []
            held = 0
            for content in batch.column(batch.num_columns - 1).to_pylist():
                part.append((content or "").encode("utf-8"))
                held += len(part[-1])
                if held >= 4 * PIECE:
                    scores.append(probability(shared.value, part))
                    part, held = [], 0
            if part:
                scores.append(probability(shared.value, part))
            found = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found), pa.array((found >= 0.5).astype(np.int32))], names=[*batch.schema.names[:-1], "score", "predicted"])

    chosen = docs.select(*keep, F.col(text).alias("__text"))
    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
