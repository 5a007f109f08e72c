"""Language-model scores of whole texts from a subword lattice.

A text is lower-cased (A-Z) and cut into words; every word is a lattice whose arcs are the pieces of an existing
vocabulary and, for words of the training corpus, the whole word with the weight that it earned there.  No unigram
vocabulary with probabilities of its own is installed, and none is trained: a BPE vocabulary stands in, whose scores
are merge ranks, read as Zipf weights 1 / (rank + 2.7).  A forward recursion in log space sums over all segmentations, so a word has its
marginal probability, and a text the product over its words and one end.  Unseen words share the mass
V / (N + V) of the pieces (Witten and Bell's estimate); N counts training tokens, V their kinds.

Scale: documents are cut into blocks, bounded in distinct words, documents and bytes, whose distinct words are listed
once; only (block, word) rows meet the corpus
counts, so a word in every document is one row per block and no key is hot; texts are read and tokenized once, and
their packed word numbers go back to their block.  Nothing but N, V and the number of training texts reaches the
driver.

Edge cases: a null text is empty and has its end only; a training set without rows gives N = 0 and scores from the
pieces alone; rows with equal ids are separate rows; a null id trains; an empty table gives an empty table.  Input
columns other than id and text are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collabstats.llm.common import crc_is_one, materialize, small_batches

#: Distinct words, documents, or bytes of word numbers and counts at which a block of documents is closed.
BLOCK_WORDS, BLOCK_DOCS, BLOCK_BYTES = 200_000, 10_000, 24 << 20
#: Rows of a block that are handed on at once.
OUT_ROWS = 20_000
START = "▁"  # stands before each word in the vocabulary


def load_pieces(path: str) -> tuple[dict[str, float], list[float], float]:
    """Log probabilities of the vocabulary's pieces, of its 256 byte pieces, and of the end.

    The scores are ranks below 0; as probabilities they follow Zipf's law over the rank.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces, single = {}, [0.0] * 256
    last = 0.0
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[model.id_to_piece(i)] = -math.log(2.7 - model.get_score(i))
            last = min(last, pieces[model.id_to_piece(i)])
    total = math.log(sum(map(math.exp, pieces.values())) + 257 * math.exp(last))
    return {p: s - total for p, s in pieces.items()}, [last - total] * 256, last - total


def forward(word: str, pieces: dict[str, float], single: list[float], longest: int) -> float:
    """Log of the sum over all segmentations of a word."""
    marked = START + word
    n = len(marked)
    reach: list[list[float]] = [[] for _ in range(n + 1)]
    reach[0].append(0.0)
    get, exp, log = pieces.get, math.exp, math.log
    for i in range(n):
        terms = reach[i]
        if not terms:
            continue
        if len(terms) == 1:
            here = terms[0]
        else:
            top = max(terms)
            here = top + log(sum([exp(t - top) for t in terms]))
        for j in range(i + 1, min(n, i + longest) + 1):
            weight = get(marked[i:j])
            if weight is not None:
                reach[j].append(here + weight)
            elif j == i + 1:  # a character outside the vocabulary is its bytes
                reach[j].append(here + sum(single[b] for b in marked[i].encode()))
    top = max(reach[n])
    return top + log(sum(exp(t - top) for t in reach[n]))


def _pack(numbers: np.ndarray, size: int) -> bytes:
    """Numbers below ``size`` in as few bytes as all of them need: 2, 3 or 4 each."""
    width = 2 if size <= 1 << 16 else 3 if size <= 1 << 24 else 4
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def _unpack(packed: bytes, size: int) -> np.ndarray:
    width = 2 if size <= 1 << 16 else 3 if size <= 1 << 24 else 4
    out = np.zeros((len(packed) // width, 4), np.uint8)
    out[:, :width] = np.frombuffer(packed, np.uint8).reshape(-1, width)
    return out.view("<u4")[:, 0]


_COUNTED = "kind string, block long, doc_id {id}, held_out boolean, n long, word binary, number int, trained long, numbers binary, times binary"


def _count(docs: DataFrame, text: str) -> DataFrame:
    """Per block: a row for each distinct word with its training count, a row for each document with packed words."""
    chosen = docs.select("doc_id", crc_is_one(F.col("doc_id"), 5).alias("held_out"), F.col(text).alias("__text"))
    id_type = chosen.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        held = 0
        ids, outs, totals, numbers, times = [], [], [], [], []

        def close(schema: pa.DataType) -> Iterator[pa.RecordBatch]:
            block = uuid.uuid4().int >> 65
            trained = np.zeros(len(number), np.int64)
            for out, own, n in zip(outs, numbers, times, strict=True):
                if not out:
                    trained[own] += n
            w, d = len(number), len(ids)
            both = {
                "kind": pa.array(["word"] * w + ["doc"] * d), "block": pa.array([block] * (w + d), pa.int64()),
                "doc_id": pa.array([None] * w + ids, schema), "held_out": pa.array([None] * w + outs, pa.bool_()),
                "n": pa.array([None] * w + totals, pa.int64()), "word": pa.array([*number, *[None] * d], pa.binary()),
                "number": pa.array([*range(w), *[None] * d], pa.int32()), "trained": pa.array([*trained.tolist(), *[None] * d], pa.int64()),
                "numbers": pa.array([None] * w + [_pack(x, w) for x in numbers], pa.binary()),
                "times": pa.array([None] * w + [x.astype("<u4").tobytes() if len(x) and x.max() > 255 else x.astype("u1").tobytes() for x in times], pa.binary())}
            whole = pa.RecordBatch.from_arrays(list(both.values()), names=list(both))
            yield from (whole.slice(at, OUT_ROWS) for at in range(0, w + d, OUT_ROWS))
            number.clear()
            for kept in (ids, outs, totals, numbers, times):
                kept.clear()

        schema = None
        for batch in batches:
            schema = batch.schema.field(0).type
            for doc_id, out, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (content or "").encode("utf-8").lower().split()
                count = Counter(words)
                ids.append(doc_id)
                outs.append(out)
                totals.append(len(words) + 1)
                numbers.append(np.fromiter((number.setdefault(w, len(number)) for w in count), np.int32, len(count)))
                times.append(np.fromiter(count.values(), np.int32, len(count)))
                held += 8 * len(count)
                if len(number) >= BLOCK_WORDS or len(ids) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                    yield from close(schema)
                    held = 0
        if ids:
            yield from close(schema)

    return chosen.mapInArrow(run, _COUNTED.format(id=id_type.simpleString()))


def score(docs: DataFrame, vocabulary: tuple[dict[str, float], list[float], float], text: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10) of every row.

    ``vocabulary`` is what ``load_pieces`` returns: its size is fixed by the vocabulary file.
    """
    spark = docs.sparkSession
    small_batches(spark)
    counted = materialize(_count(docs, text), "lm-blocks")
    shared = spark.sparkContext.broadcast(vocabulary)

    def marginal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, single, _ = shared.value
        longest = max(map(len, pieces))
        last, value = None, 0.0
        for batch in batches:  # sorted by word
            values, first = [], []
            for word in batch.column(0).to_pylist():
                first.append(word != last)
                if word != last:
                    last, value = word, forward(word.decode("utf-8"), pieces, single, longest)
                values.append(value)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(values, pa.float64()), pa.array(first)], names=[*batch.schema.names[1:], "marginal", "first"])

    by_word = W.partitionBy("word")
    words = counted.where("kind = 'word'").select("word", "block", "number", F.sum("trained").over(by_word).alias("c"))
    looked = materialize(words.mapInArrow(marginal, "block long, number int, c long, marginal double, first boolean"), "lm-words")
    texts = counted.where("kind = 'doc'")
    ends, trained = texts.agg(F.count(F.when(~F.col("held_out"), 1)), F.sum(F.when(~F.col("held_out"), F.col("n")))).first()
    kinds = looked.where("first and c > 0").count() + (1 if ends else 0)
    total = trained or 0
    unseen = kinds / (total + kinds) if total else 1.0

    def finish(_: tuple, own: pa.Table, found: pa.Table) -> pa.Table:
        size = found.num_rows
        order = found.column("number").to_numpy()
        c, lattice = np.empty(size), np.empty(size)
        c[order], lattice[order] = found.column("c").to_numpy(), found.column("marginal").to_numpy()
        scale = total + 0.5 * (kinds + 1)
        base = np.log10((c + 0.5) / scale)
        full = np.logaddexp(np.log(np.maximum(c, 1e-300) / max(total, 1)) + math.log1p(-unseen) if unseen < 1 else np.full(size, -np.inf), lattice + math.log(unseen)) / math.log(10)
        end_base = math.log10((ends + 0.5) / scale)
        end_full = np.logaddexp(math.log(ends / total) + math.log1p(-unseen) if ends and unseen < 1 else -np.inf, shared.value[2] + math.log(unseen)) / math.log(10)
        known, bases, fulls = [], [], []
        for packed, counts in zip(own.column("numbers").to_pylist(), own.column("times").to_pylist(), strict=True):
            at = _unpack(packed, size)
            n = np.frombuffer(counts, "u1" if len(counts) == len(at) else "<u4").astype(np.float64)
            known.append(int(n[c[at] > 0].sum()) + (1 if ends else 0))
            bases.append(float(n @ base[at]) + end_base)
            fulls.append(float(n @ full[at]) + float(end_full))
        return pa.table({"doc_id": own.column("doc_id"), "held_out": own.column("held_out"), "n_tokens": own.column("n"), "n_known": pa.array(known, pa.int64()),
                         "train_tokens": pa.array([total] * own.num_rows, pa.int64()), "base_score": pa.array(bases, pa.float64()), "score": pa.array(fulls, pa.float64())})

    id_type = counted.schema["doc_id"].dataType.simpleString()
    return (texts.select("block", "doc_id", "held_out", "n", "numbers", "times").groupBy("block")
            .cogroup(looked.select("block", "number", "c", "marginal").groupBy("block"))
            .applyInArrow(finish, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
