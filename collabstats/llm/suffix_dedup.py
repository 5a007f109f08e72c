"""Removal of repeated byte strings: every byte inside a string of ``LENGTH`` bytes that also starts earlier.

A column-wise construction sorts the suffixes of a collection of strings: each round inserts one symbol of every
string (from its end) and brings the collection's Burrows-Wheeler transform and its common-prefix array up to date.
Suffixes whose common prefix reaches ``LENGTH`` start with the same string; all but the earliest are repeated.

Most of a corpus repeats nowhere and its long documents would need as many rounds as they have bytes, so the
collections are cut from the text first, without losing a repeated string:

1.  Every string of ``LENGTH`` bytes is named by the smallest hash among its ``GRAM``-byte substrings (the leftmost
    of equals); equal strings have equal names.  Neighbouring starts with one name form a block, about
    ``LENGTH - GRAM`` / 2 starts long.  Names that occur once in the corpus are done.
2.  Equal blocks (equal names and bytes) collapse to the earliest one: later copies are repeated as a whole.
3.  A name with several kinds of block leaves strings to compare: the blocks' bytes are fetched and dealt by the name
    and the bytes beside it, and the construction runs over these collections of short strings, task by task.  Its
    rounds read sorted shuffle files one after the other and never hold more than a bounded collection.
4.  A name beside which more than ``HOT`` kinds of block stand is dealt out by whole strings instead, so no task holds
    a hot group.

Rows are ordered by id (null ids last) and then by text; rows equal in both are separate documents in any order.
Edge cases: a null text is empty; texts below ``LENGTH`` bytes lose nothing; an empty table gives an empty table;
input columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from collabstats.llm.common import materialize

LENGTH, GRAM = 100, 24
#: Bytes named at once; bytes of a collection; kinds of block beside one name that are compared in one collection.
NAMED, COLLECTION, HOT = 1 << 20, 1 << 20, 20_000
_POSITION = np.uint64((1 << 21) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)


class _Powers:
    """Powers of an odd base modulo 2^64, of its inverse, and random values of the 256 bytes."""

    def __init__(self, size: int):
        self.up = self._powers(_BASE, size)
        self.down = self._powers(pow(_BASE, -1, 1 << 64), size)
        self.byte = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.ones(size, np.uint64)
        done = 1
        while done < size:
            more = min(done, size - done)
            out[done:done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
            done += more
        return out


def names(data: np.ndarray, powers: _Powers, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Of every start in ``data``: the place of its string's name, and the hash of every ``gram``-byte substring."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(powers.byte[data] * powers.up[:len(data)], dtype=np.uint64)])
    grams = (total[gram:] - total[:-gram]) * powers.down[:len(data) - gram + 1]
    grams ^= grams >> np.uint64(32)
    grams *= _MIX
    grams ^= grams >> np.uint64(29)
    grams *= _MIX
    grams ^= grams >> np.uint64(32)
    key = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
    span, width = length - gram + 1, 1
    least = key
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = span - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return (least & _POSITION).astype(np.int64), grams


def construct(strings: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a collection in sorted order, built column by column.

    Returns the start of each suffix in the concatenated strings and its common prefix with the one before it.
    """
    m = len(strings)
    sizes = np.fromiter(map(len, strings), np.int64, m)
    data = np.frombuffer(b"".join(strings), np.uint8).astype(np.int16) + 1  # 0: a string's beginning is reached
    starts = np.cumsum(sizes) - sizes
    # round 0: the empty suffixes, in the order of the strings
    bwt = np.where(sizes > 0, data[np.maximum(starts + sizes - 1, 0)] if len(data) else 0, 0).astype(np.int16)
    common = np.zeros(m, np.int16)
    place = starts + sizes
    owner = np.arange(m)
    column = np.arange(m)  # positions of the suffixes that the last round inserted
    while True:
        column = column[bwt[column] > 0]
        if not len(column):
            break
        # extensions sort as (preceding symbol, suffix): a stable sort of the transform is the order to come
        order = np.argsort(bwt, kind="stable")
        order = order[np.searchsorted(bwt[order], 1):]
        fresh = np.zeros(len(bwt), bool)
        fresh[column] = True
        new = np.flatnonzero(fresh[order])
        source = order[new]
        # common prefixes of the new suffixes and of those right behind them
        touched = np.union1d(new, new[new + 1 < len(order)] + 1)
        before = order[np.maximum(touched - 1, 0)]
        here = order[touched]
        same = (touched > 0) & (bwt[before] == bwt[here])
        bounds = np.stack([before[same] + 1, here[same] + 1], 1).ravel()
        prefix = np.zeros(len(touched), np.int16)
        if len(bounds):
            prefix[same] = np.minimum.reduceat(np.append(common, np.int16(0)), bounds)[::2] + 1
        suffix = place[source] - 1
        symbol = np.where(suffix > starts[owner[source]], data[np.maximum(suffix - 1, 0)], 0)
        # the sequence of suffixes: the empty ones, then the extensions in order
        old = np.ones(len(order), bool)
        old[new] = False
        longer = np.concatenate([np.ones(m, bool), old])
        merged = []
        for array, added in ((bwt, symbol), (common, np.zeros(len(new))), (place, suffix), (owner, owner[source])):
            whole = np.empty(len(longer), array.dtype)
            whole[longer] = array
            whole[m + new] = added
            merged.append(whole)
        bwt, common, place, owner = merged
        common[m + touched] = prefix
        column = m + new
    return place, common


def repeated_starts(strings: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Starts (in the concatenated strings) whose ``length`` bytes also start at an earlier place."""
    place, common = construct(strings, length)
    run = np.flatnonzero(common < length)
    first = np.minimum.reduceat(place, run)
    sizes = np.diff(np.append(run, len(place)))
    return np.sort(place[place != np.repeat(first, sizes)])


def _row_ids(docs: DataFrame, text: str) -> DataFrame:
    """``rid`` (in document order), ``doc_id`` and ``body`` (compressed bytes) of every row."""
    chosen = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = chosen.select("doc_id").agg(F.count("*"), F.count_distinct("doc_id")).first()
    if counts[0] == counts[1] and dict(chosen.dtypes)["doc_id"] in ("bigint", "int"):
        keyed = chosen.withColumn("rid", F.col("doc_id").cast("bigint"))
    else:  # ids that are null or not unique: number the rows in order; written, so the numbers stay
        keyed = materialize(chosen.orderBy(F.col("doc_id").asc_nulls_last(), "text").withColumn("rid", F.monotonically_increasing_id()), "suffix-rows")
    return keyed.select("rid", "doc_id", "text")


def _blocks(rows: DataFrame) -> DataFrame:
    """Blocks of equal name: ``name``, ``kind`` (hash of the bytes), ``rid``, ``start``, ``size`` (starts) and ``at`` (of the name, from ``start``).

    A row without ``kind`` stands for neighbouring blocks that are copies of earlier ones in the same stretch of text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        powers = _Powers(2 * NAMED)

        def name(parts: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
            raw = b"".join(p for _, _, p in parts)
            data = np.frombuffer(raw, np.uint8)
            sizes = np.fromiter((len(p) for _, _, p in parts), np.int64, len(parts))
            begins = np.cumsum(sizes) - sizes
            place, grams = names(data, powers)
            own = np.repeat(np.arange(len(parts)), sizes)[:len(place)]
            valid = np.flatnonzero(np.arange(len(place)) + LENGTH <= (begins + sizes)[own])
            named, part = place[valid], own[valid]
            change = np.flatnonzero(np.concatenate([[True], (named[1:] != named[:-1]) | (part[1:] != part[:-1])]))
            first, last = valid[change], valid[np.append(change[1:], len(valid)) - 1]
            part, at = part[change], named[change]
            hashes = grams[at].view(np.int64)
            view = memoryview(raw)
            kinds = np.array([xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), (last + LENGTH).tolist())], np.uint64).view(np.int64)
            rids = np.fromiter((r for r, _, _ in parts), np.int64, len(parts))[part]
            starts = first - begins[part] + np.fromiter((o for _, o, _ in parts), np.int64, len(parts))[part]
            # earliest of equal blocks first
            order = np.lexsort((starts, rids, kinds, hashes))
            again = np.zeros(len(order), bool)
            again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (kinds[order][1:] == kinds[order][:-1])
            copy = np.zeros(len(order), bool)
            copy[order] = again
            sizes = last - first + 1
            # copies of earlier blocks, joined where they touch
            i = np.flatnonzero(copy)
            joined = np.flatnonzero(np.concatenate([[True], (rids[i][1:] != rids[i][:-1]) | (starts[i][1:] != starts[i][:-1] + sizes[i][:-1])])) if len(i) else i
            head, tail = i[joined], i[np.append(joined[1:], len(i)) - 1] if len(i) else i
            own = np.flatnonzero(~copy)
            none = np.zeros(len(head), np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([hashes[own], hashes[head]])), pa.array(np.concatenate([kinds[own], none]), mask=np.concatenate([np.zeros(len(own), bool), none == 0])),
                pa.array(np.concatenate([rids[own], rids[head]])), pa.array(np.concatenate([starts[own], starts[head]]).astype(np.int32)),
                pa.array(np.concatenate([sizes[own], starts[tail] + sizes[tail] - starts[head]]).astype(np.int32)), pa.array(np.concatenate([(at - first)[own], none]).astype(np.int16))],
                names=["name", "kind", "rid", "start", "size", "at"])

        held: list[tuple[int, int, bytes]] = []
        bytes_held = 0
        for batch in batches:
            for rid, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = content.encode("utf-8")
                if len(raw) < LENGTH:
                    continue
                for offset in range(0, len(raw) - LENGTH + 1, NAMED):
                    piece = raw[offset:offset + NAMED + LENGTH - 1]
                    if bytes_held + len(piece) > 2 * NAMED:
                        yield name(held)
                        held, bytes_held = [], 0
                    held.append((rid, offset, piece))
                    bytes_held += len(piece)
                if bytes_held >= NAMED:
                    yield name(held)
                    held, bytes_held = [], 0
        if held:
            yield name(held)

    return rows.select("rid", "text").mapInArrow(run, "name long, kind long, rid long, start int, size int, at short")


def _packed(rows: DataFrame) -> DataFrame:
    """``rid``, ``doc_id`` and ``body``, the text's compressed bytes: what a shuffle has to carry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor

        pack = ZstdCompressor(level=1).compress
        for batch in batches:
            bodies = [pack(t.encode("utf-8")) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bodies, pa.binary())], names=["rid", "doc_id", "body"])

    return rows.mapInArrow(run, f"rid long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, body binary")


def _unpack(body: bytes) -> bytes:
    from zstandard import ZstdDecompressor

    return ZstdDecompressor().decompress(body) if body else b""


def _fetch(blocks: DataFrame, packed: DataFrame) -> DataFrame:
    """Strings to compare: blocks in two halves by the side on which more of the name's neighbourhood is inside.

    ``key`` joins the name and the bytes that every string of the half has beside it.
    """
    half = (LENGTH - GRAM) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        rid_now, raw = None, b""
        for batch in batches:  # sorted: a row's text before its blocks
            out: list[tuple] = []
            for rid, body, start, size, at in zip(*(batch.column(c).to_pylist() for c in ("rid", "body", "start", "size", "at")), strict=True):
                if body is not None:
                    rid_now, raw = rid, body
                    unpacked = False
                    continue
                if not unpacked:
                    raw, unpacked = _unpack(raw), True
                place = start + at
                for side, a, b in ((0, start, min(start + size, place - half)), (1, max(start, place - half), start + size)):
                    if a < b:  # strings that start from a to b - 1
                        context = raw[place - half:place + GRAM] if side == 0 else raw[place:place + GRAM + half]
                        key = xxh3_64_intdigest(context, side) - (1 << 63)
                        out.append((key, rid_now, a, raw[a:b - 1 + LENGTH]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int32()), pa.array([o[3] for o in out], pa.binary())],
                names=["key", "rid", "start", "bytes"])

    texts = packed.selectExpr("rid", "0 as turn", "body", "cast(null as int) start", "cast(null as int) size", "cast(null as smallint) at")
    asked = blocks.selectExpr("rid", "1 as turn", "cast(null as binary) body", "start", "size", "at")
    return texts.unionByName(asked).repartition("rid").sortWithinPartitions("rid", "turn", "start").mapInArrow(run, "key long, rid long, start int, bytes binary")


_MARKS = "rid long, start int, end int"


def _compare(strings: DataFrame) -> DataFrame:
    """Repeated stretches among strings sorted by key, row and start: whole keys make up a collection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, list[tuple[int, int, bytes]]] = {}
        held = 0

        def done() -> pa.RecordBatch:
            # equal strings of a key: the later ones are repeated whole, and only one goes into the construction
            members, copies = [], []
            for group in groups.values():
                first: dict[bytes, tuple[int, int, bytes]] = {}
                for x in sorted(group, key=lambda x: x[:2]):
                    if first.setdefault(x[2], x) is not x:
                        copies.append(x)
                if len(first) > 1:
                    members += first.values()
            members.sort(key=lambda x: x[:2])
            whole = [np.fromiter((f(x) for x in copies), np.int64, len(copies)) for f in (lambda x: x[0], lambda x: x[1], lambda x: x[1] + len(x[2]))]
            rids, begins, ends = ([w] for w in whole)
            if members:
                sizes = np.fromiter((len(x[2]) for x in members), np.int64, len(members))
                marks = repeated_starts([x[2] for x in members])
                offsets = np.cumsum(sizes) - sizes
                own = np.searchsorted(offsets, marks, side="right") - 1
                rid = np.fromiter((x[0] for x in members), np.int64, len(members))
                start = np.fromiter((x[1] for x in members), np.int64, len(members))
                if len(marks):
                    at = marks - offsets[own] + start[own]
                    cut = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)]))
                    last = np.append(cut[1:], len(at)) - 1
                    rids.append(rid[own[cut]])
                    begins.append(at[cut])
                    ends.append(at[last] + LENGTH)
            rids, begins, ends = (np.concatenate(x) for x in (rids, begins, ends))
            return pa.RecordBatch.from_arrays([pa.array(rids), pa.array(begins.astype(np.int32)), pa.array(ends.astype(np.int32))], names=["rid", "start", "end"])

        for batch in batches:
            for key, rid, start, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key not in groups and held >= COLLECTION:
                    yield done()
                    groups.clear()
                    held = 0
                groups.setdefault(key, []).append((rid, start, content))
                held += len(content)
        if groups:
            yield done()

    return strings.select("key", "rid", "start", "bytes").repartition("key").sortWithinPartitions("key").mapInArrow(run, _MARKS)


def _by_string(strings: DataFrame) -> DataFrame:
    """The same for hot keys: every string by itself, named by 128 bits, against the earliest of its name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            for rid, start, content in zip(*(batch.column(c).to_pylist() for c in ("rid", "start", "bytes")), strict=True):
                n = len(content) - LENGTH + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([xxh3_128_digest(content[i:i + LENGTH]) for i in range(n)], pa.binary()), pa.array([rid] * n, pa.int64()), pa.array(range(start, start + n), pa.int32())], names=["string", "rid", "start"])

    every = strings.mapInArrow(run, "string binary, rid long, start int")
    earliest = every.groupBy("string").agg(F.min(F.struct("rid", "start")).alias("first"))
    return every.join(earliest.hint("merge"), "string").where(F.struct("rid", "start") != F.col("first")).select("rid", "start", (F.col("start") + LENGTH).alias("end"))


def remove_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (start and end of each removed run) and ``kept`` (bytes) of every row."""
    rows = _row_ids(docs, text)
    same_name = W.partitionBy("name")
    in_order = same_name.orderBy("kind", "rid", "start")
    several = (_blocks(rows)
               .withColumn("again", F.coalesce(F.lag("kind").over(in_order) == F.col("kind"), F.lit(False)))
               .withColumn("kinds", F.sum(F.when(F.col("again") | F.col("kind").isNull(), 0).otherwise(1)).over(same_name))
               .where("kind is null or again or kinds > 1"))
    several = materialize(several.select("rid", "start", "size", "at", (F.col("again") | F.col("kind").isNull()).alias("again")), "suffix-names")
    copies = several.where("again").select("rid", "start", (F.col("start") + F.col("size") - 1 + LENGTH).cast("int").alias("end"))
    packed = _packed(rows)
    strings = materialize(_fetch(several.where("not again").select("rid", "start", "size", "at"), packed), "suffix-strings")
    members = strings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = strings.join(members.hint("merge"), "key")
    compared = _compare(shared.where(F.col("n") <= HOT)).unionByName(_by_string(shared.where(F.col("n") > HOT)))
    return _apply(packed, copies.unionByName(compared))


def _apply(packed: DataFrame, marks: DataFrame) -> DataFrame:
    """Cut the marked stretches out of every row."""
    id_field = packed.schema["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, begins, ends = None, [], []
        for batch in batches:  # sorted: a row's marks before its text
            out: list[tuple] = []
            for rid, doc_id, body, start, end in zip(*(batch.column(c).to_pylist() for c in ("rid", "doc_id", "body", "start", "end")), strict=True):
                if rid != own:
                    own, begins, ends = rid, [], []
                if body is None:
                    if ends and start <= ends[-1]:
                        ends[-1] = max(ends[-1], end)
                    else:
                        begins.append(start)
                        ends.append(end)
                    continue
                raw = _unpack(body)
                kept = b"".join(raw[a:b] for a, b in zip([0, *ends], [*begins, len(raw)], strict=True)) if begins else raw
                out.append((doc_id, len(raw), len(raw) - len(kept), len(begins), [{"start": a, "end": b} for a, b in zip(begins, ends, strict=True)], kept))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            types = (batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    id_type = id_field.dataType.simpleString()
    texts = packed.selectExpr("rid", "1 as turn", "doc_id", "body", "cast(null as int) start", "cast(null as int) end")
    stretches = marks.selectExpr("rid", "0 as turn", f"cast(null as {id_type}) doc_id", "cast(null as binary) body", "start", "end")
    return (texts.unionByName(stretches).repartition("rid").sortWithinPartitions("rid", "turn", "start")
            .mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, spans array<struct<start:bigint,end:bigint>>, kept binary"))
