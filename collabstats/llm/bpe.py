"""Byte-level BPE by corpus-level merge replay.

A block of documents is cut into pieces by the tokenizer's pattern; the block's distinct pieces that are not yet
known are laid out as one sequence of byte tokens, and an inverted index maps the rank of every mergeable token
pair to the positions where it stands.  Merges are replayed in rank order over all pieces at once; each merge looks
at its two neighbours only.  The resulting piece table turns every text of the block into ids.

Ids are carried as packed little-endian unsigned 32-bit integers (``ids``, binary).  Documents never meet: the
work is one pass without a shuffle, and a lost executor repeats only its own input splits.

Edge cases: null and empty texts give zero tokens and empty bytes; repeated rows give equal rows; any text length is
encoded whole; an empty table gives an empty table.  Input columns other than the key and the text are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collabstats.llm.common import small_batches

#: Pieces kept per task; beyond it the table starts anew, so a task's memory stays bounded.
PIECES = 120_000


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file: one base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Merges:
    """The vocabulary's merges: the token that two adjacent tokens become, whose id is also the merge's rank."""

    def __init__(self, ranks: dict[bytes, int]):
        found = [(ranks[t[:i]] << 20 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        table = np.array(sorted(found), np.int64).reshape(-1, 2)
        self.keys, self.becomes = np.append(table[:, 0], np.iinfo(np.int64).max), np.append(table[:, 1], -1)
        self.pair = dict(found)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a << 20 | b
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.becomes[at], -1)


def replay_one(piece: bytes, merges: Merges) -> list[int]:
    """Token ids of one piece: always the lowest rank, from left to right among equals."""
    sym = merges.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
    following = [*range(1, len(sym)), -1]
    before = list(range(-1, len(sym) - 1))
    pair = merges.pair
    current = [-1] * len(sym)
    queue = []
    for i in range(len(sym) - 1):
        if (r := pair.get(sym[i] << 20 | sym[i + 1], -1)) >= 0:
            current[i] = r
            queue.append((r, i))
    heapify(queue)
    while queue:
        r, i = heappop(queue)
        if current[i] != r:
            continue
        j = following[i]
        k = following[j]
        sym[i], following[i], current[j], current[i] = r, k, -1, -1
        if k >= 0:
            before[k] = i
            if (q := pair.get(r << 20 | sym[k], -1)) >= 0:
                current[i] = q
                heappush(queue, (q, i))
        h = before[i]
        if h >= 0:
            current[h] = q = pair.get(sym[h] << 20 | r, -1)
            if q >= 0:
                heappush(queue, (q, h))
    ids = []
    i = 0
    while i >= 0:
        ids.append(sym[i])
        i = following[i]
    return ids


def replay(pieces: list[bytes], merges: Merges) -> list[bytes]:
    """Packed token ids of each piece, by replaying the merges over all pieces at once in rank order.

    The index holds, for every rank, the positions where a pair of that rank stands.  A piece in which a merge
    overlaps itself, or makes a pair of an earlier rank, does not follow the common order: it is replayed by itself.
    """
    if not pieces:
        return []
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    n = int(sizes.sum())
    if n >= 1 << 28:  # positions fit 32 bits with room to spare; a longer block goes in two
        half = max(1, len(pieces) // 2)
        return replay(pieces[:half], merges) + replay(pieces[half:], merges) if len(pieces) > 1 else [np.array(replay_one(pieces[0], merges), "<u4").tobytes()]
    sym = np.append(merges.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)], 0)
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
    starts = np.cumsum(sizes) - sizes
    following, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    following[starts + sizes - 1] = n  # the last slot stands for "none"
    before[starts] = n
    alive = np.ones(n, bool)
    alone = np.zeros(len(pieces), bool)
    current = np.full(n + 1, -1, np.int32)
    inside = np.flatnonzero(following[:n] < n)
    current[inside] = merges.of(sym[inside], sym[inside + 1])
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def post(places: np.ndarray) -> None:
        ranks = current[places]
        places, ranks = places[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(ranks)] if len(ranks) else []
        for r, a, b in zip(ranks[bounds[:-1]].tolist(), bounds, bounds[1:]):
            if r in index:
                index[r].append(places[a:b])
            else:
                index[r] = [places[a:b]]
                heappush(queue, r)

    post(np.arange(n))
    while queue:
        r = heappop(queue)
        stacked = index.pop(r)
        i = stacked[0] if len(stacked) == 1 else np.unique(np.concatenate(stacked))
        i = i[current[i] == r]
        j = following[i]
        overlap = current[j] == r
        if overlap.any():
            alone[piece[i[overlap]]] = True
            keep = ~alone[piece[i]]
            i, j = i[keep], j[keep]
        if not len(i):
            continue
        k = following[j]
        sym[i] = r
        following[i] = k
        before[k] = i
        alive[j] = False
        current[j] = -1
        h = before[i]
        current[i] = np.where(k < n, merges.of(sym[i], sym[k]), -1)
        some = h < n
        h, own = h[some], i[some]
        current[h] = merges.of(sym[h], sym[own])
        touched = np.concatenate([i, h])
        early = (current[touched] >= 0) & (current[touched] <= r)
        if early.any():
            alone[piece[touched[early]]] = True
            touched = touched[~alone[piece[touched]]]
        post(touched)
    packed = sym[:n][alive].astype("<u4").tobytes()
    ends = (np.cumsum(np.bincount(piece[alive], minlength=len(pieces))) * 4).tolist()
    out = [packed[a:b] for a, b in zip([0, *ends[:-1]], ends)]
    for at in np.flatnonzero(alone).tolist():
        out[at] = np.array(replay_one(pieces[at], merges), "<u4").tobytes()
    return out


class PieceTable:
    """Packed ids of pieces, filled block by block."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.merges = Merges(ranks)
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        if len(self.known) + len(pieces) > PIECES:
            self.known.clear()
        fresh, raws = [], []
        for piece in pieces:
            if piece not in self.known:
                raw = piece.encode()
                if (i := self.ranks.get(raw)) is not None:
                    self.known[piece] = i.to_bytes(4, "little")
                else:
                    fresh.append(piece)
                    raws.append(raw)
        self.known.update(zip(fresh, replay(raws, self.merges), strict=True))


#: Characters whose pieces are looked up together.
BLOCK_CHARS = 3_000_000


def _blocks(texts: list[str | None]) -> Iterator[list[str]]:
    block: list[str] = []
    chars = 0
    for text in texts:
        block.append(text or "")
        chars += len(block[-1])
        if chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    yield block


#: Letters, numbers and white space below code point 256 (fixed values), for the pattern's classes there.
_LETTERS, _NUMBERS, _SPACES = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The pattern's pieces of a text; Latin-1 texts go through an equal pattern with the classes written out."""
    import regex

    whole = regex.compile(pattern).findall
    spelled = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{_SPACES}{_LETTERS}{_NUMBERS}]").replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", f"[{_NUMBERS}]")
    spelled = spelled.replace(r"\S", f"[^{_SPACES}]").replace(r"\s", f"[{_SPACES}]")
    if "\\" in re.sub(r"\\\\", "", spelled):  # a class that has no spelling here
        return whole
    low = re.compile(spelled).findall

    def find(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return whole(text)
        return low(text)

    return find


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decoded: bool = False) -> DataFrame:
    """``keep`` columns, ``ids`` (packed) and ``n_tokens`` of every row; with ``decoded`` also the bytes that the ids
    stand for, as ``decode`` gives them, from the same pass.

    ``ranks`` is the vocabulary file's content: its size is fixed by that file, not by the data.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = splitter(pattern)
        table = PieceTable(shared.value)
        tokens = _tokens(shared.value) if decoded else []
        for batch in batches:
            ids: list[bytes] = []
            for block in _blocks(batch.column(batch.num_columns - 1).to_pylist()):
                cut = [find(t) for t in block]
                table.learn(set().union(*cut))
                known = table.known
                ids += [b"".join([known[p] for p in pieces]) for pieces in cut]
            columns = [*batch.columns[:-1], pa.array(ids, pa.binary())]
            names = [*batch.schema.names[:-1], "ids"]
            if decoded:
                columns.append(pa.array([_decoded(p, tokens) for p in ids], pa.binary()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    chosen = docs.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([*(f for f in chosen.schema.fields[:-1]), T.StructField("ids", T.BinaryType())])
    if decoded:
        schema = schema.add("decoded", T.BinaryType())
    return chosen.mapInArrow(run, schema).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def _tokens(ranks: dict[bytes, int]) -> list[bytes]:
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return tokens


def _decoded(ids: bytes, tokens: list[bytes]) -> bytes:
    return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes that its ``ids`` stand for."""
    small_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(shared.value)
        for batch in batches:
            packed = batch.column(batch.schema.get_field_index("ids")).to_pylist()
            decoded = [None if p is None else _decoded(p, tokens) for p in packed]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))


def sha256(column: str) -> Column:
    return F.sha2(F.col(column), 256)
