"""Benchmark decontamination: one Aho-Corasick automaton over the word windows of all benchmark items.

* Windows.  Items are cut into windows of ten consecutive normalised words (``words``); a shorter item is one window.
* Automaton.  The windows' words are numbered and every number is written in a fixed count of symbols, the first of them
  from an alphabet of its own, so a match can only begin where a word begins.  A word that no window holds is one symbol
  that leads back to the root.  The automaton is built once in each Python worker.
* Scan.  The words of a batch of whole texts are numbered by one Arrow lookup and scanned once.  A match ends at a symbol,
  whose word is found from the words' first symbols; only texts with a match are then cut again, to map the hit words to
  code points of the original text.

Size.  The broadcast windows are bounded: their number and bytes are counted first, and beyond ``PAIRS`` or ``BYTES`` they
are dealt to several automata by hash.  The texts then run through one after another, each adding to the hits of those before.
Documents are never shuffled, so no hot document or copy matters; work on a text is linear in its length and its matches.

Edge cases: a null or empty text, or one without words, has no words and no hits.  Items without words have no window.  Rows
that share an item_id are one item, listed once.  A row with a null item_id takes part in the hits but cannot be listed.
Repeated document rows each give a row.  An empty benchmark hits nothing; no documents give no rows.  Columns other than
those named are dropped first, so their names cannot clash.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collabstats.llm.common import materialize
from collabstats.llm.words import pieces, split, words_of

#: Words of a window.
LENGTH = 10
#: Window and item pairs, and bytes of them, that one automaton holds.
PAIRS, BYTES = 200_000, 32_000_000
#: Symbols of one place of a word's number.  Children of a node are searched one by one, so the alphabet is kept small.
BASE = 32
FIRST, NEXT, OTHER = 0x80, 0x40, 0x20

RUN = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
RUN_SQL = "struct<first:bigint,last:bigint,start:bigint,end:bigint>"
_ORIGINAL = re.compile(r"[0-9A-Za-z\u0080-\U0010FFFF]+")


def windows(items: DataFrame, length: int = LENGTH) -> DataFrame:
    """``item`` (its id as text, maybe null) and ``window`` (words joined by a space) of every window, without repeats."""
    n = F.size("w")
    cut = F.when(n >= length, F.transform(F.sequence(F.lit(1), F.greatest(n - (length - 1), F.lit(1))), lambda i: F.array_join(F.slice("w", i, length), " "))).when(
        n > 0, F.array(F.array_join("w", " ")))
    parted = items.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w"))
    return parted.select("item", F.explode(cut).alias("window")).distinct()


class Automaton:
    """The automaton over windows, and what a match of it means."""

    def __init__(self, table: pa.Table):
        texts = pc.unique(table["window"])
        self.items: list[set[str]] = [set() for _ in range(len(texts))]
        for place, item in zip(pc.index_in(table["window"], value_set=texts).to_pylist(), table["item"].to_pylist(), strict=True):
            if item is not None:
                self.items[place].add(item)
        parted = [w.split(" ") for w in texts.to_pylist()]
        self.words = pa.array(sorted({w for ws in parted for w in ws}), pa.string())
        self.places = 1
        while BASE ** self.places < len(self.words):
            self.places += 1
        number = {w: i for i, w in enumerate(self.words.to_pylist())}
        self.trie = ahocorasick.Automaton()
        for place, ws in enumerate(parted):
            codes = np.array([number[w] for w in ws])
            self.trie.add_word(self.symbols(codes)[0], (place, len(ws)))
        if parted:
            self.trie.make_automaton()

    def symbols(self, codes: np.ndarray) -> tuple[str, np.ndarray]:
        """Word numbers (below 0: unknown) as one string, and the place of each word's first symbol."""
        known = codes >= 0
        lengths = np.where(known, self.places, 1)
        starts = np.cumsum(lengths) - lengths
        out = np.full(int(lengths.sum()), OTHER, np.uint8)
        at, rest = starts[known], codes[known]
        for place in reversed(range(self.places)):
            rest, digit = np.divmod(rest, BASE)
            out[at + place] = digit + (FIRST if place == 0 else NEXT)
        return out.tobytes().decode("latin-1"), starts

    def hits(self, codes: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of hit words (first, last) in order, not touching, and the ids of the items whose windows occur."""
        if len(self.words) == 0 or not len(codes):
            return [], set()
        text, starts = self.symbols(codes)
        ends, found = [], []
        for end, what in self.trie.iter(text):
            ends.append(end)
            found.append(what)
        if not ends:
            return [], set()
        last = np.searchsorted(starts, ends, side="right") - 1
        first = last - np.array([length for _, length in found]) + 1
        items: set[str] = set().union(*(self.items[place] for place in {place for place, _ in found}))
        return merged(first, last), items


def merged(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Intervals of whole numbers as fewest intervals, in order."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    opens = np.flatnonzero(np.r_[True, first[1:] > reach[:-1] + 1])
    closes = np.r_[opens[1:] - 1, len(first) - 1]
    return list(zip(first[opens].tolist(), reach[closes].tolist(), strict=True))


_BUILT: dict[str, Automaton] = {}


def _automaton(name: str, sent) -> Automaton:
    """This worker's automaton of that name; another one that it held before is let go."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Automaton(pa.ipc.open_stream(sent.value).read_all())
    return _BUILT[name]


def _scan(docs: DataFrame, table: pa.Table, keep: tuple[str, ...], first: bool) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``items``, to which the windows of ``table`` add theirs."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    sent, name = docs.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes()), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, sent)
        for batch in pieces(batches):
            texts = batch.column("__text")
            words, counts = split(texts)
            codes = pc.fill_null(pc.index_in(words, value_set=automaton.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = np.r_[0, np.cumsum(counts)]
            runs = [[] for _ in counts] if first else batch.column("runs").to_pylist()
            items = [[] for _ in counts] if first else batch.column("items").to_pylist()
            for i in range(len(counts)):
                now, named = automaton.hits(codes[bounds[i]:bounds[i + 1]])
                if now:
                    both = np.array(now + [(r["first"], r["last"]) for r in runs[i]])
                    spans = [m.span() for m in _ORIGINAL.finditer(texts[i].as_py())]
                    runs[i] = [{"first": a, "last": b, "start": spans[a][0], "end": spans[b][1]} for a, b in merged(both[:, 0], both[:, 1])]
                    items[i] = sorted(named.union(items[i]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), texts, pa.array(counts, pa.int64()), pa.array(runs, pa.list_(RUN)), pa.array(items, pa.list_(pa.string()))],
                names=[*keep, "__text", "n_words", "runs", "items"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "__text string", "n_words bigint", f"runs array<{RUN_SQL}>", "items array<string>"])
    return docs.mapInArrow(run, schema)


def find(docs: DataFrame, items: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), length: int = LENGTH) -> DataFrame:
    """Per document: ``keep``, the text as ``__text``, ``n_words``, ``runs`` of hit words (first and last word; start and end in
    code points of the original text, end exclusive) and ``items``, the ids whose windows occur, sorted as text."""
    pairs = materialize(windows(items, length), "windows")
    count, size = pairs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window") + F.coalesce(F.octet_length("item"), F.lit(0))), F.lit(0))).first()
    groups = max(1, math.ceil(count / PAIRS), math.ceil(size / BYTES))
    found = docs.select(*keep, F.col(text).alias("__text"))
    for g in range(groups):
        part = pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(groups)) == g)
        if g:
            found = materialize(found, "scanned")
        found = _scan(found, part.toArrow(), keep, first=g == 0)
    return found


def remove(found: DataFrame, text: str = "text") -> DataFrame:
    """The documents of ``find`` as ``text`` without the hit stretches; texts without hits stay as they are."""
    kept = F.aggregate(
        "runs", F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at")),
        lambda a, r: F.struct(F.concat(a["done"], F.substring("__text", a["at"] + 1, r["start"] - a["at"])).alias("done"), r["end"].alias("at")),
        lambda a: F.concat(a["done"], F.substring("__text", a["at"] + 1, F.length("__text"))))
    rest = [c for c in found.columns if c not in ("__text", "n_words", "runs", "items")]
    return found.select(*rest, F.when(F.size("runs") > 0, kept).otherwise(F.col("__text")).alias(text))
