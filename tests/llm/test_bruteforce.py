"""Queries on the smallest tables against plain versions of their definitions."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from collabstats.llm import bpe, byte_cnn, langid, lattice_lm, mixing, pii, simhash, spotsigs, suffix_dedup
from collabstats.llm import queries as Q
from tests.llm.conftest import SMALL, documents, edge_rows

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, SMALL)


def _rows(spark, name, folder=SMALL):
    return {r["doc_id"]: r for r in Q.queries()[name](spark, folder).collect()}


# --- PII ---------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _base_spans(text):
    def valid(kind, found):
        digits = [int(c) for c in found if c.isdigit()]
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
            return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind != "phone" or 10 <= len(digits) <= 15

    return [(m.start(), place, m.end(), kind) for place, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if valid(kind, m.group())]


def test_pii_base_spans(spark, docs):
    rng = random.Random(5)
    bits = ["a@b.co", "_x@c.d", "1.2.3.4", "256.1.1.1", "0255.1.1.1", ".5.6", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-2345", "+", "1", " ", "-", ".", "é", "\U0001F600", "@", "x",
            "000000000000000000", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "ssn 123-45-6789", "123-45-6789", "iban "]
    made = [(10_000 + i, "".join(rng.choice(bits) for _ in range(rng.randint(1, 200)))) for i in range(300)]
    made.append((20_000, "1.1." * 20_000 + "a." * 20_000 + "9" * 20_000 + "z" * 50_000))
    texts = {d[0]: d[1] or "" for d in docs} | dict(made)
    table = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for r in pii.find_pii(table).select("doc_id", "pii").collect():
        want = sorted(_base_spans(texts[r.doc_id]))
        got = [(s.start, s.place, s.end, s.kind) for s in r.pii if s.base]
        assert got == want, texts[r.doc_id][:300]
        for s in r.pii:
            assert texts[r.doc_id][s.start:s.end] == s.value and 0 <= s.score <= 1


def test_pii_validators_and_context(spark):
    texts = ["iban GB82 WEST 1234 5698 7654 32.", "GB83 WEST 1234 5698 7654 32", "my ssn 123-45-6789", "part 123-45-6789", "ssn 666-45-6789"]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).orderBy("doc_id").collect()
    kinds = [[s.kind for s in r.pii if not s.base] for r in rows]
    assert kinds == [["iban"], [], ["ssn"], [], []]
    near, far = pii.find_pii(spark.createDataFrame([(1, "server 10.1.2.3"), (2, "version 10.1.2.3")], "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert near.pii[0].score == 0.9 and far.pii[0].score == 0.3


# --- language model ----------------------------------------------------------------------------

def test_language_model_counts_and_base(spark, docs):
    found = _rows(spark, "op2_lattice_lm")
    tokens = {d[0]: [*WORD.findall((d[1] or "").encode().lower()), None] for d in docs}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    count = collections.Counter(w for i, t in tokens.items() if not out[i] for w in t)
    total, kinds = sum(count.values()), len(count)
    for i, own in tokens.items():
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], len(own), sum(count[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and -math.inf < r.score < 0


def test_lattice_sums_all_segmentations():
    rng = random.Random(6)
    pieces = {p: math.log(rng.uniform(0.01, 0.2)) for p in ("▁", "▁a", "▁ab", "a", "b", "ab", "ba", "aba", "c")}

    def every(text):
        if not text:
            return 1.0
        return sum(math.exp(pieces[text[:n]]) * every(text[n:]) for n in range(1, len(text) + 1) if text[:n] in pieces)

    for _ in range(50):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 8)))
        assert lattice_lm.forward(word, pieces, [-9.0] * 256, 4) == pytest.approx(math.log(every("▁" + word)))
    assert lattice_lm.forward("é", pieces, [-9.0] * 256, 4) == pytest.approx(pieces["▁"] - 18)


def test_model_score_is_the_mixture(spark):
    """Whole words and pieces share the probability as the docstring says."""
    import public_tokenizers

    vocabulary = lattice_lm.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert sum(map(math.exp, vocabulary[0].values())) + 257 * math.exp(vocabulary[2]) == pytest.approx(1)
    rows = [(i, "one two two unheard" if i == 2 else "One two") for i in range(6)]
    out = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 1}
    count = collections.Counter(w for i, t in rows if i not in out for w in [*t.lower().split(), None])
    total, kinds = sum(count.values()), len(count)
    unseen = kinds / (total + kinds)
    longest = max(map(len, vocabulary[0]))

    def p(w):
        lattice = vocabulary[2] if w is None else lattice_lm.forward(w, vocabulary[0], vocabulary[1], longest)
        return math.log10((1 - unseen) * count[w] / total + unseen * math.exp(lattice))

    for r in lattice_lm.score(spark.createDataFrame(rows, "doc_id bigint, text string"), vocabulary).collect():
        assert r.score == pytest.approx(sum(p(w) for w in [*dict(rows)[r.doc_id].lower().split(), None]))


# --- SpotSigs ----------------------------------------------------------------------------------

def _signatures(text):
    words = spotsigs._Words()
    cut = [(1, True), *((words[w], w in spotsigs.ANCHORS) for w in re.findall(r"\w+", text.lower()))]
    mask, mixer = 2**64 - 1, 0x9E3779B97F4A7C15
    found = set()
    for i, (h, anchor) in enumerate(cut):
        if anchor:
            follow = [x for x, a in cut[i + 1:] if not a][:spotsigs.CHAIN]
            value = h * mixer & mask
            for x in [*follow, *[7] * (spotsigs.CHAIN - len(follow))]:
                value = (((value ^ (value >> 29)) * mixer & mask) + x) & mask
            found.add(((value ^ (value >> 32)) * mixer & mask) >> 32)
    return found


def _unpacked(text):
    return set(np.frombuffer(base64.b64decode(text), "<u4").tolist())


def test_fingerprints_of_edited_texts(spark, docs):
    found = _rows(spark, "op3_spotsigs")
    order = sorted(docs, reverse=True, key=lambda d: d[0])[:]
    for k, d in enumerate(order):
        text, after = d[1], order[(k + 1) % len(order)][1]
        edited = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        r = found[d[0]]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = _signatures(text), _signatures(edited), _signatures(after)
        assert _unpacked(r.fingerprint) == a and _unpacked(r.edited_fingerprint) == b
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b)) and r.near_next == pytest.approx(len(a & c) / len(a | c))


def test_texts_without_common_words_are_fingerprinted_whole(spark):
    rng = random.Random(9)
    greek = ["".join(rng.choice("αβγδεζηθικλμνξοπρστυφχψω") for _ in range(rng.randint(3, 9))) for _ in range(300)]
    tables = {1: lambda: rng.choice(greek), 2: lambda: str(rng.randint(0, 9999)), 3: lambda: f"{rng.choice('qxzkvw')}{rng.randint(10, 99)}"}
    lead = "same first words of these texts "
    rows = [(10 * kind + k, lead + " ".join(word() for _ in range(160))) for kind, word in tables.items() for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in spotsigs.edited_neighbours(docs).collect()}
    for r in found.values():
        assert len(_unpacked(r.fingerprint)) >= 20 and 0.2 < r.near_edited < 0.7 and r.near_next < 0.3
    assert len({r.class_id for r in spotsigs.near_duplicates(docs).collect()}) == len(rows)
    # few words, none of them an anchor: a chain starts within every GAP words
    plain = [w for w in greek if w not in spotsigs.ANCHORS][:8]
    long = [plain[0], plain[1], *(rng.choice(plain) for _ in range(6000))]
    other = [plain[0], plain[1], *(rng.choice(plain[2:]) for _ in range(6000))]
    a, b = spotsigs.signatures([" ".join(long), " ".join(other)], spotsigs._Words())
    assert len(a) >= 8 and len(b) >= 8 and spotsigs.likeness(a, b) < 0.8


def test_near_duplicate_classes_match_all_pairs(spark, docs):
    rng = random.Random(8)
    rows = [(d[0], d[1]) for d in docs][:80]
    for i, text in list(rows)[:40]:
        words = text.split(" ")
        for n in range(3):
            words[rng.randrange(len(words))] = "changed"
            rows.append((1000 + 10 * i + n, " ".join(words)))
    rows += [(5000, None), (5001, ""), (5002, rows[3][1])]
    sets = {i: _signatures(t or "") for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = collections.Counter()
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
                links[i] += 1
                links[j] += 1
    got = {r.doc_id: r.class_id for r in spotsigs.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: find(i) for i in ids}
    assert len(set(got.values())) < len(got) - 60


# --- SimHash -----------------------------------------------------------------------------------

def _simhash(text):
    from xxhash import xxh64_intdigest

    words = WORD.findall(text.encode().lower())
    if not words:
        return 0
    hashes = [xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_fingerprints_and_components(spark, docs):
    found = _rows(spark, "op4_simhash")
    prints = {d[0]: _simhash(d[1]) for d in docs}
    assert {i: f"{p:016x}" for i, p in prints.items()} == {i: r.fingerprint for i, r in found.items()}
    _check_components(prints, {i: r.component_id for i, r in found.items()})


def _check_components(prints, got):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in ids}


@pytest.mark.parametrize("bucket", [4096, 8])
def test_links_connect_what_all_pairs_connect(spark, bucket):
    """Also with a dense group, whose variant buckets are cut into blocks of 8."""
    rng = random.Random(9)
    center = rng.getrandbits(64)
    values = {center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)} | {rng.getrandbits(64) for _ in range(60)}
    values |= {v ^ 0b111 << rng.randrange(61) for v in list(values)[:30]}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    edges = simhash.links(spark.createDataFrame(signed, "simhash bigint"), bucket=bucket).collect()
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    want = dict(root)
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = {v: find(v) for v in values}
    root.update({v: v for v in values})
    for e in edges:
        a, b = e.a % (1 << 64), e.b % (1 << 64)
        assert (a ^ b).bit_count() <= 3
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {v: find(v) for v in values} == want


# --- neighbours --------------------------------------------------------------------------------

def test_neighbours_recall(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    data = np.array([r.embedding for r in rows])
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    hits = total = 0
    found = collections.defaultdict(list)
    for r in Q.queries()["op5_permutation_index"](spark, SMALL).collect():
        found[r.query_id].append(r)
    assert set(found) == {i for i in ids.tolist() if i % 50 == 0}
    for q, own in found.items():
        near = data @ data[np.flatnonzero(ids == q)[0]]
        order = [i for i in np.lexsort((ids, -near)) if ids[i] != q][:5]
        hits += len({int(ids[i]) for i in order} & {r.vec_id for r in own})
        total += 5
        for r in own:
            assert r.score == pytest.approx(near[np.flatnonzero(ids == r.vec_id)[0]], abs=1e-12)
    assert hits >= 0.9 * total


# --- classifier, language ----------------------------------------------------------------------

def test_network_gradient_matches_differences():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 110, n, dtype=np.uint8)) for n in (5, 200, 700, 1500)]
    labels = np.array([0.0, 1.0, 1.0, 0.0])
    w = byte_cnn.fit(texts, labels)
    w = {k: v.astype(np.float64) for k, v in w.items()}
    rows = [byte_cnn.halves(t) for t in texts]
    grads = byte_cnn._gradients(w, rows, labels)

    def loss():
        p = byte_cnn.probability(w, texts)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for name, spots in (("out", [0, 3]), ("hidden", [(0, 1), (30, 2)]), ("table", [(2, 100, 3), (5, 104, 10)]), ("bias", [1, 7])):
        for spot in spots:
            old = w[name][spot]
            w[name][spot] = old + 1e-6
            up = loss()
            w[name][spot] = old - 1e-6
            down = loss()
            w[name][spot] = old
            decay = 1e-4 * old if name == "hidden" else 1e-5 * old if name == "table" else 0
            assert grads[name][spot] - decay == pytest.approx((up - down) / 2e-6, abs=2e-5)


def test_quality_of_held_out_texts(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in _rows(spark, "op6_byte_cnn", folder).values() if r.held_out and r.doc_id in labels]
    good = [r.score for r in rows if labels[r.doc_id] == 1]
    bad = [r.score for r in rows if labels[r.doc_id] == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.9
    assert np.mean([(r.score >= 0.5) == labels[r.doc_id] for r in rows]) > 0.9 and all(r.predicted == (r.score >= 0.5) for r in rows)


def test_language_of_held_out_texts(spark, docs):
    rows = _rows(spark, "op9_language")
    held = [(rows[d[0]].lang_pred, d[2]) for d in docs if rows[d[0]].held_out and d[2]]
    assert len(held) > 30 and np.mean([a == b for a, b in held]) > 0.95


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(2)
    for lengths in ([4], [1, 5, 0, 3]):
        scores = rng.normal(0, 3, (sum(lengths), 3))
        path = langid.viterbi(scores, np.array(lengths), 2.0)
        at = 0
        for n in lengths:
            part = scores[at:at + n]
            best = max(np.ndindex(*[3] * n), key=lambda p: sum(part[t, l] for t, l in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))) if n else ()
            assert tuple(path[at:at + n]) == tuple(best)
            at += n


def test_mixed_texts_are_cut_into_spans(spark):
    rows = [(i, t, lang) for i in range(60) for t, lang in (("the house and the garden with of was", "en"), ("der hund und die katze nicht wir", "de"), ("Привет мир это", "ru"))]
    table = spark.createDataFrame([(n, t, lang) for n, (_, t, lang) in enumerate(rows)], "doc_id bigint, text string, lang string")
    model = langid.train(table)
    text = " ".join(["the house and the garden"] * 3 + ["der hund und die katze"] * 3 + ["мир привет"])
    r = langid.predict(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model).first()
    assert [(s.lang, s.words) for s in r.spans] == [("en", 15), ("de", 15), ("ru", 2)] and r.lang_pred == "en"


# --- mixing ------------------------------------------------------------------------------------

def test_mixing_targets_and_takings(spark, docs):
    rows = _rows(spark, "op7_mixing")
    size = {d[0]: len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or "")) for d in docs}
    sources = sorted({d[3] for d in docs}, key=lambda s: (s is None, s))
    total = {s: sum(size[d[0]] for d in docs if d[3] == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    full = set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in full)
        units = sum(weight[s] for s in sources if s not in full)
        target = {s: 3.0 * total[s] if s in full else left * weight[s] / units for s in sources}
        more = {s for s in sources if target[s] > 3 * total[s]}
        if not more:
            break
        full |= more
    for d in docs:
        r = rows[d[0]]
        assert (r["size"], r.source_size) == (size[d[0]], total[d[3]]) and r.target == pytest.approx(target[d[3]])
        assert 0 <= r.taken <= 3 * r["size"]
    for s in sources:
        taken = sum(rows[d[0]].taken for d in docs if d[3] == s)
        assert taken == pytest.approx(target[s], rel=0.03)


def test_permutation_is_a_bijection(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 1000):
        rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(1), F.lit("x")).alias("p")).collect()
        assert sorted(r.p for r in rows) == list(range(n))
        assert n < 1000 or [r.p for r in rows] != list(range(n))


def test_capped_sources_meet_their_limit(spark):
    rows = [(i, "w " * 50, "a") for i in range(4)] + [(100 + i, "w " * 500, "b") for i in range(20)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    small = [r for r in got if r.source == "a"]
    assert {r.target for r in small} == {600.0} and [r.taken for r in small] == [150] * 4


def test_remixed_sources_meet_their_targets(spark):
    rng = random.Random(5)
    rows = []
    for source, n in (("a", 150), ("b", 400), ("c", 60), ("d", 250)):
        rows += [(len(rows), " ".join(f"{source}{i}x{j}" for j in range(rng.randint(1, 400))), source) for i in range(n)]
        rows.append((len(rows), f"{source} " * 4000, source))
    rows += [(9000, "equal words here", "a")] * 5 + [(None, "no id", None)] * 4 + [(9001, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    told = mixing.mix(docs).collect()
    got = collections.Counter()
    for r in mixing.remix(docs).collect():
        got[r.source] += len(r.text.split())
    for source in "abcd":
        want = next(r.target for r in told if r.source == source)
        assert got[source] == pytest.approx(want, rel=0.01)
        assert abs(got[source] - sum(r.taken for r in told if r.source == source)) <= 200   # half of the longest other text
    assert got[None] in (sum(r.taken for r in told if r.source is None) + d for d in (-1, 0, 1))


def test_mixed_blocks_are_dealt_to_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD", 40)
    rng = random.Random(6)
    rows = [(i, " \t".join(f"d{i}w{j}" for j in range(rng.randint(0, 300))), rng.choice(["a", "a", "b", None])) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    made = mixing.blocks(docs).collect()
    stream = {}
    for i, text, source in rows:
        stream.setdefault(source, {}).setdefault(i, text.split())
    sizes = {s: sum(map(len, d.values())) for s, d in stream.items()}
    taken, shards, seen = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for r in made:
        words, length = r.words.split(" "), max(1, min(mixing.BLOCK, sizes[r.source] // mixing.BLOCK))
        assert len(words) == min(length, sizes[r.source] - r.block * length) == sum(p.n for p in r.parts)
        assert [p.first for p in r.parts] == sorted(p.first for p in r.parts) and r.parts[0].first == r.block * length
        want = [w for p in r.parts for w in stream[r.source][p.doc_id][p.first - p.start:p.first - p.start + p.n]]
        assert words == want   # the block is cut from its documents, in order
        for p in r.parts:
            taken[p.doc_id] += p.n
        shards[r.source, r.shard] += 1
        assert r.slot not in seen[r.source]
        seen[r.source].add(r.slot)
    assert all(s == set(range(len(s))) for s in seen.values())
    total = {s: len(n) for s, n in seen.items()}
    count = math.ceil(sum(total.values()) / 40)
    assert count > 3 and {k for _, k in shards} <= set(range(count))
    for s, n in total.items():   # counts per shard are multinomial: within five deviations of their mean
        assert all(abs(shards[s, k] - n / count) <= 5 * math.sqrt(n / count) for k in range(count))
        assert abs(sum(taken[i] for i in stream[s]) - next(r.target for r in mixing.mix(docs).collect() if r.source == s)) <= mixing.BLOCK
    assert {r.doc_id: r.taken for r in mixing.mix(docs).collect()} == {i: taken[i] for i, _, _ in rows}
    assert {r.doc_id: r.taken for r in mixing.takings(docs).collect()} == {i: taken[i] for i, t, _ in rows if t}


# --- BPE ---------------------------------------------------------------------------------------

def test_bpe_equals_tiktoken(spark, docs):
    import tiktoken

    ranks, pattern = Q.vocabulary()
    told = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    bits = ["a", "b", "é", "ß", "漢", "字", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "᠎", "'s", "'", "1", "²", "½", "!", "-", "---", "\U0001F600", "́", "Я", "ж", "aaa", "the", "   ", "____", "tion", "<|endoftext|>"]
    rows = [(d[0], d[1] or "") for d in docs] + [(10_000 + i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(3000)] + [(r[0], r[1] or "") for r in edge_rows() if r[0] in (9, 11)]
    coded = bpe.decode(bpe.encode(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id bigint, text string"), ranks, pattern), ranks)
    for r in coded.collect():
        text = rows[r.doc_id][1]
        ids = told.encode_ordinary(text)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids) and bytes(r.decoded) == text.encode()


def test_long_pieces_and_small_piece_tables(monkeypatch):
    import tiktoken

    ranks, pattern = Q.vocabulary()
    told = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "PIECES", 5)
    table = bpe.PieceTable(ranks)
    for text in ("x" * 3000, "ab" * 2000, "the quick brown fox", "aaaa aaa aa"):
        pieces = bpe.splitter(pattern)(text)
        table.learn(set(pieces))
        assert np.frombuffer(b"".join(table.known[p] for p in pieces), "<u4").tolist() == told.encode_ordinary(text)


# --- repeated strings --------------------------------------------------------------------------

def _cut(texts, length):
    seen, out = set(), []
    for raw in texts:
        spans = []
        for i in range(len(raw) - length + 1):
            part = raw[i:i + length]
            if part in seen:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
            seen.add(part)
        kept, at = b"", 0
        for a, b in spans:
            kept += raw[at:a]
            at = b
        out.append((len(raw), len(spans), kept + raw[at:]))
    return out


def test_repeated_bytes_are_cut(spark, docs):
    found = _rows(spark, "op10_suffix_dedup")
    order = sorted(docs)
    for d, (n, spans, kept) in zip(order, _cut([(d[1] or "").encode() for d in order], 100), strict=True):
        r = found[d[0]]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, n - len(kept), spans, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeated_bytes_of_made_texts(spark, monkeypatch, hot):
    """Periodic, shifted and nested repeats, null and repeated ids; also with every key taken as hot."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(12)
    base = "".join(rng.choice("abcdefgh ") for _ in range(900))
    texts = [base, base[100:420], "x" * 350, "xy" * 180, base[:130] + "Q" + base[131:600], "é" * 120, "".join(rng.choice("ab") for _ in range(700)), base[50:149], base[50:150], ""]
    texts += [base[a:a + rng.randint(90, 250)] + "".join(rng.choice("ijkl") for _ in range(rng.randint(0, 90))) + base[b:b + rng.randint(90, 140)] for a, b in ((rng.randrange(800), rng.randrange(800)) for _ in range(25))]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    want = _cut([t.encode() for t in texts], 100)
    for r in got:
        assert (r.n_bytes, r.n_spans, bytes(r.kept)) == want[r.doc_id], r.doc_id
    # equal and null ids: ordered by id (null last), then text
    rows = [(1, texts[1]), (1, texts[0]), (1, texts[0]), (None, texts[4]), (None, None), (0, texts[8])]
    order = sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = [(i, *w) for (i, _), w in zip(order, _cut([(t or "").encode() for _, t in order], 100), strict=True)]
    assert sorted(map(str, ((r.doc_id, r.n_bytes, r.n_spans, bytes(r.kept)) for r in got))) == sorted(map(str, want))


def test_construction_sorts_suffixes():
    rng = random.Random(2)
    for trial in range(120):
        length = rng.choice([2, 3, 5])
        strings = [bytes(rng.choice(b"ab" if trial % 2 else b"abcdef") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 9))]
        place, common = suffix_dedup.construct(strings, length)
        whole = b"".join(strings)
        ends, suffixes = np.cumsum([len(s) for s in strings]), []
        for s, end in zip(strings, ends):
            suffixes += [(whole[i:end], i) for i in range(end - len(s), end)]
        filled = [(int(p), int(c)) for p, c in zip(place, common)][len(strings):]
        text = dict((i, s) for s, i in suffixes)
        assert [text[p] for p, _ in filled] == sorted(text.values())
        for (p, _), (q, c) in zip(filled, filled[1:]):
            shared = 0
            while shared < min(len(text[p]), len(text[q])) and text[p][shared] == text[q][shared]:
                shared += 1
            assert c == shared


# --- pipeline ----------------------------------------------------------------------------------

def test_pipeline_stages_against_plain_versions(spark, docs):
    import corpus_pipeline
    import tiktoken

    kept = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    languages = _rows(spark, "op9_language")
    told = stages[0](spark, kept, SMALL).cache()
    assert {r.doc_id for r in told.collect()} == {i for i, r in languages.items() if r.lang_pred != "und" and r.score >= 0.34}

    prints = {r.doc_id: _simhash(r.text) for r in told.collect()}
    root = {i: i for i in prints}
    for i in sorted(prints):
        for j in sorted(prints):
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 3:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = {k: new if v == old else v for k, v in root.items()}
    single = stages[1](spark, told, SMALL).cache()
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(root.values()))

    hidden = stages[2](spark, single, SMALL).cache()
    before = {r.doc_id: r.text for r in single.collect()}
    for r in hidden.collect():
        want, spans = before[r.doc_id], sorted(_base_spans(before[r.doc_id]))
        if not any(b[0] < a[2] for a, b in zip(spans, spans[1:])):
            for start, _, end, kind in reversed(spans):
                want = want[:start] + f"[{kind.upper()}]" + want[end:]
            assert r.text == want and r.n_chars == len(want)

    mixed = stages[3](spark, hidden, SMALL).cache()
    shares = {r.doc_id: r.taken / r["size"] for r in mixing.mix(hidden).collect() if r["size"]}
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    assert all(math.floor(s) <= copies[i] <= math.ceil(s) for i, s in shares.items())
    texts = {r.doc_id: r.text for r in hidden.collect()}
    assert all(r.text == texts[r.doc_id] for r in mixed.collect())

    ranks, pattern = Q.vocabulary()
    encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    coded = stages[4](spark, mixed, SMALL).collect()
    assert len(coded) == sum(copies.values())
    for r in coded:
        assert np.frombuffer(r.ids, "<u4").tolist() == encode(texts[r.doc_id])
