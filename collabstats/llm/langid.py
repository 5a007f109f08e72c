"""Language ID of mixed-language texts.

Scripts narrow the candidates of each word (the languages that were learned with words of that script), per-word
scores come from hashed character n-grams, and Viterbi with a switching penalty labels the words of a text, so a text
is cut into spans of one language each.  A text's language is the one with most letters; its score is that
language's share of the letters.

The model is fitted on at most about ``PER_LANGUAGE`` labelled texts of each language, chosen by a hash of the row;
its counts are added up by Spark, and its size is ``BUCKETS`` numbers per language and script, whatever the input.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; with nothing to learn from every text is;
ties go to the language that sorts first; repeated rows give equal rows; an empty table gives an empty table.  Texts
are labelled whole, in blocks of documents.  Input columns other than id, text and language are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collabstats.llm.common import small_batches

PER_LANGUAGE, BUCKETS = 2000, 1 << 15
#: Natural logarithm that a change of language costs; share of a language's words that a script needs to count.
SWITCH, SHARE = 6.0, 0.001
UNKNOWN = "und"
#: Words remembered per task; characters labelled together.
WORDS, BLOCK_CHARS = 150_000, 6_000_000

#: First code point of each range and its script (fixed values of the Unicode charts; 0: any other).
SCRIPTS = ((0x0, 1), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6), (0x700, 0), (0x900, 7), (0x980, 8), (0xA00, 0), (0xB80, 9),
           (0xC00, 0), (0xE00, 10), (0xE80, 0), (0x10A0, 11), (0x1100, 12), (0x1200, 13), (0x13A0, 0), (0x1E00, 1), (0x1F00, 2),
           (0x2000, 0), (0x2C60, 1), (0x2C80, 0), (0x3040, 14), (0x3100, 0), (0x3400, 15), (0xA000, 0), (0xAC00, 12), (0xD7B0, 0),
           (0xF900, 15), (0xFB00, 1), (0xFB13, 0), (0xFB50, 6), (0xFE00, 0), (0x20000, 15))
_STARTS = [start for start, _ in SCRIPTS]
WORD = re.compile(r"[^\W\d_]+")


def script(word: str) -> int:
    return SCRIPTS[bisect_right(_STARTS, ord(word[0])) - 1][1]


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams (1 to 4 characters, word ends marked) of all words, and where each word's begin."""
    points = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    own = np.repeat(np.arange(len(words)), lengths)
    mixer = np.uint64(0x9E3779B97F4A7C15)
    columns, places = [], []
    grams = np.zeros(len(points), np.uint64)
    for n in range(1, 5):
        if len(points) < n:
            break
        grams = (grams[:len(points) - n + 1] * np.uint64(1_000_003)) + points[n - 1:] + np.uint64(n)
        inside = np.flatnonzero(own[:len(grams)] == own[n - 1:])
        columns.append(((grams[inside] * mixer) >> np.uint64(64 - 15)).astype(np.int64))
        places.append(own[inside])
    place, bucket = np.concatenate(places), np.concatenate(columns)
    order = np.argsort(place, kind="stable")
    return bucket[order], np.searchsorted(place[order], np.arange(len(ends)))


def _ngrams_of(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``ngrams`` of a few thousand words at a time: its arrays take about a kilobyte per word."""
    for i in range(0, len(words), 8192):
        yield ngrams(words[i:i + 8192])


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # bucket, language: log probabilities
    allowed: np.ndarray  # script, language: whether the language was learned with the script
    known: dict[str, int] = field(default_factory=dict)
    scores: list[np.ndarray] = field(default_factory=list)
    letters: list[int] = field(default_factory=list)

    def learn(self, words: set[str]) -> None:
        """Score the words that are new; words without a letter stay out of every text."""
        if len(self.known) + len(words) > WORDS:
            self.known, self.scores, self.letters = {}, [], []
        fresh = [w for w in words if w not in self.known]
        self.known.update((w, -1) for w in fresh)
        fresh = [w for w in fresh if any(map(str.isalpha, w))]
        if not fresh:
            return
        found = np.concatenate([np.add.reduceat(self.grams[buckets], begins) for buckets, begins in _ngrams_of(fresh)])
        may = self.allowed[[script(w) for w in fresh]]
        found = np.where(may | ~may.any(axis=1, keepdims=True), found, -1e4)
        at = len(self.letters)
        self.known.update(zip(fresh, range(at, at + len(fresh)), strict=True))
        self.scores.append(found)
        self.letters += [sum(map(str.isalpha, w)) for w in fresh]


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Labels of the words of several texts, one after the other in ``scores``; texts advance side by side."""
    order = np.argsort(-lengths, kind="stable")
    offsets = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # texts longer than t
    labels = scores.shape[1]
    best = np.zeros((len(lengths), labels))
    back = np.empty((len(scores), labels), np.int16)
    own = np.arange(labels, dtype=np.int16)
    for t in range(longest):
        m = active[t]
        at = offsets[:m] + t
        now = best[:m]
        top = now.argmax(axis=1)
        change = (now[np.arange(m), top] - switch)[:, None]
        stay = now >= change
        back[at] = np.where(stay, own, top[:, None])
        best[:m] = np.where(stay, now, change) + scores[at]
    path = np.empty(len(scores), np.int16)
    state = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        m = active[t]
        at = offsets[:m] + t
        path[at] = state[:m]
        state[:m] = back[at, state[:m]]
    return path


def _blocks(texts: list[str | None]) -> Iterator[list[str | None]]:
    block: list[str | None] = []
    chars = 0
    for text in texts:
        block.append(text)
        chars += len(text or "")
        if chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    yield block


def label(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths in words of all texts, and each word's label and letters."""
    cut = [WORD.findall((t or "").lower()) for t in texts]
    model.learn(set().union(*cut))
    known = model.known
    found = [[i for i in map(known.__getitem__, words) if i >= 0] for words in cut]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    flat = np.fromiter((i for ids in found for i in ids), np.int64, int(lengths.sum()))
    if not len(flat):
        return lengths, flat, flat
    if len(model.scores) > 1:
        model.scores = [np.concatenate(model.scores)]
    return lengths, viterbi(model.scores[0][flat], lengths), np.asarray(model.letters)[flat]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, n-gram log probabilities and script table, from rows of ``docs`` whose language is not null."""
    small_batches(docs.sparkSession)
    labelled = docs.select("doc_id", F.col(lang).alias("__lang"), F.col(text).alias("__text")).where("__lang is not null and __text is not null")
    totals = {r["__lang"]: r["n"] for r in labelled.groupBy("__lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    if not totals:
        return [], np.zeros((BUCKETS, 0)), np.zeros((16, 0), bool)
    share = F.element_at(F.create_map(*(F.lit(x) for k, n in totals.items() for x in (k, min(1.0, per_language / n)))), F.col("__lang"))
    # by id and text, so that copies of one text do not come in or stay out together
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id", "__text", F.lit(9)), F.lit(1 << 20)) < share * (1 << 20)).drop("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        scripts: Counter = Counter()
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = WORD.findall(content.lower())
                if words:
                    scripts.update((name, script(w)) for w in words)
                    own = counts.setdefault(name, np.zeros(BUCKETS, np.int64))
                    for buckets, _ in _ngrams_of(words):
                        own += np.bincount(buckets, minlength=BUCKETS)
        for name, own in counts.items():
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array(some), pa.array(own[some])], names=["lang", "bucket", "n"])
        if scripts:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in scripts]), pa.array([-1 - k[1] for k in scripts], pa.int64()), pa.array(list(scripts.values()), pa.int64())], names=["lang", "bucket", "n"])

    table = chosen.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(totals)
    number = {name: i for i, name in enumerate(languages)}
    counts, scripts = np.zeros((BUCKETS, len(languages))), np.zeros((16, len(languages)))
    at = np.array([number[x] for x in table.column("lang").to_pylist()], np.int64)
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    counts[bucket[bucket >= 0], at[bucket >= 0]] = n[bucket >= 0]
    scripts[-1 - bucket[bucket < 0], at[bucket < 0]] = n[bucket < 0]
    grams = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * BUCKETS))
    return languages, grams, scripts > SHARE * scripts.sum(axis=0)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score`` and ``spans`` (label, first word, words) of every row."""
    languages = model[0]
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            names, scores, spans = [], [], []
            for block in _blocks(batch.column(batch.num_columns - 1).to_pylist()):
                if not languages:
                    names += [UNKNOWN] * len(block)
                    scores += [0.0] * len(block)
                    spans += [[]] * len(block)
                    continue
                lengths, path, letters = label(own, block)
                end = 0
                for size in lengths.tolist():
                    begin, end = end, end + size
                    if not size:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        spans.append([])
                        continue
                    part = path[begin:end]
                    weight = np.bincount(part, weights=letters[begin:end], minlength=len(languages))
                    top = int(weight.argmax())
                    names.append(languages[top])
                    scores.append(float(weight[top] / weight.sum()))
                    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                    sizes = np.diff(np.append(first, size))
                    spans.append([{"lang": languages[part[i]], "first_word": int(i), "words": int(w)} for i, w in zip(first, sizes)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, SPANS)],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "spans"])

    chosen = docs.select(*keep, F.col(text).alias("__text"))
    spans = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("first_word", T.LongType()), T.StructField("words", T.LongType())]))
    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", spans)]))


SPANS = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("words", pa.int64())]))


def accepted(name: Column, score: Column, least: float = 0.34) -> Column:
    """What a language filter keeps: texts with a known language that holds at least ``least`` of their letters."""
    return (name != UNKNOWN) & (score >= least)


def learned_share(text: Column, model: tuple[list[str], np.ndarray, np.ndarray]) -> Column:
    """Part of a text's letters whose script some language was learned with; 0 for a null text or one without letters."""
    ends = [start for start, _ in SCRIPTS[1:]] + [0x110000]
    learned = model[2].any(axis=1)
    ranges = "".join(f"\\x{{{start:X}}}-\\x{{{end - 1:X}}}" for (start, s), end in zip(SCRIPTS, ends, strict=True) if learned[s])
    if not ranges:
        return F.lit(0.0)
    letters, own = F.regexp_count(text, F.lit(r"\p{L}")), F.regexp_count(text, F.lit(rf"[\p{{L}}&&[{ranges}]]"))
    return F.coalesce(own / F.nullif(letters, F.lit(0)), F.lit(0.0))
