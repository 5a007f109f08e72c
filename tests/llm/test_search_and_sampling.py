"""Decontamination, ranked search and importance resampling against plain versions of their definitions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from collabstats.llm import ball_tree, contamination, resampling
from collabstats.llm import queries as Q
from collabstats.llm.words import split, words_of
from tests.llm.conftest import SMALL, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def items(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]


TEXTS = ["", None, " ", "a", "A b", "\x00x\x7fY", "É é ÀB1c-2 漢字漢\U0001F600z", "a b　c d", "x" * 70_000, "a b " * 5000, "...", "\ta\n\nb "]


def test_words_of_arrow_and_spark_agree(spark):
    for texts in (TEXTS, TEXTS[3:4], [None, ""], []):
        flat, counts = split(pa.array(texts, pa.string()))
        assert counts.tolist() == [len(words(t)) for t in texts]
        assert flat.to_pylist() == [w for t in texts for w in words(t)]
    whole = pa.array(["zz zz", *TEXTS], pa.large_string())
    assert split(whole.slice(1))[0].to_pylist() == [w for t in TEXTS for w in words(t)]
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string").select("i", words_of(F.col("text")).alias("w")).collect()
    assert {r.i: r.w for r in rows} == {i: words(t) for i, t in enumerate(TEXTS)}


# --- decontamination ---------------------------------------------------------------------------

def contaminated(docs, bench):
    windows = collections.defaultdict(set)
    for item, text in bench:
        w = words(text)
        for i in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[i:i + 10])].add(item)
    lengths = {len(w) for w in windows}
    for doc_id, text, *_ in docs:
        w, hit, named = words(text), set(), set()
        for k in lengths:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit.update(range(i, i + k))
                    named |= {str(x) for x in windows[tuple(w[i:i + k])] if x is not None}
        yield doc_id, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("several", [False, True])
@pytest.mark.parametrize("table", ["small", "edge"])
def test_contamination_by_hand(spark, edge, table, several, monkeypatch):
    folder = SMALL if table == "small" else edge
    if several:
        monkeypatch.setattr(contamination, "PAIRS", 150)
    rows = Q.queries()["op11_contamination"](spark, folder).collect()
    got = collections.Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows)
    assert got == collections.Counter(contaminated(documents(spark, folder), items(spark, folder)))
    assert any(r.contaminated for r in rows)


def test_hits_map_to_the_original_text(spark):
    bench = spark.createDataFrame([(1, "One two, THREE four five six seven eight nine ten eleven"), (2, "é ü")], "item_id int, text string")
    text = "Zero\U0001F600 ... ONE--two three FOUR five six seven eight nine ten  eleven! É ü é; Ü"
    docs = spark.createDataFrame([(1, text), (2, "one two three"), (3, "é ü"), (4, "é ü é ü x")], "doc_id int, text string")
    found = contamination.find(docs, bench)
    got = {r.doc_id: r for r in found.collect()}
    assert [text[r["start"]:r["end"]] for r in got[1].runs] == ["ONE--two three FOUR five six seven eight nine ten  eleven"]
    assert [(r["first"], r["last"]) for r in got[1].runs] == [(1, 11)] and got[1]["items"] == ["1"]
    assert got[2].runs == [] and got[3]["items"] == ["2"] and [(r["first"], r["last"]) for r in got[4].runs] == [(0, 3)]
    left = {r.doc_id: r.text for r in contamination.remove(found).collect()}
    assert left[1] == "Zero\U0001F600 ... ! É ü é; Ü" and left[2] == "one two three" and left[3] == "" and left[4] == " x"


def test_numbers_of_words_never_run_into_each_other():
    """More words than one place of a number holds, and windows of which one ends another."""
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(1200)]
    windows = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 10]))] for _ in range(300)]
    table = pa.table({"window": [" ".join(w) for w in windows], "item": [str(i) for i in range(300)]})
    automaton = contamination.Automaton(table)
    assert automaton.places == 2
    number = {w: i for i, w in enumerate(automaton.words.to_pylist())}
    text = [rng.choice(vocabulary) for _ in range(500)] + windows[0] + windows[1] + ["unknown"] + windows[2]
    runs, named = automaton.hits(np.array([number.get(w, -1) for w in text]))
    hit = {p for w in windows for i in range(len(text)) if text[i:i + len(w)] == w for p in range(i, i + len(w))}
    assert {p for a, b in runs for p in range(a, b + 1)} == hit
    assert named == {str(n) for n, w in enumerate(windows) if any(text[i:i + len(w)] == w for i in range(len(text)))}


# --- ranked search -----------------------------------------------------------------------------

def ranked(docs, bench, top=50):
    held = [(d[0], collections.Counter(words(d[1]))) for d in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    many, total = len(held), sum(n for _, _, n in held)
    df = collections.Counter(w for _, c, _ in held for w in c)
    sets = collections.defaultdict(set)
    for item, text in bench:
        sets[item] |= set(words(text))
    for item, terms in sets.items():
        scores = []
        for i, c, n in held:
            m = 50 + (50 * n * many) // total
            score = sum(math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        for place, (score, none, i) in enumerate(sorted(scores)[:top], 1):
            yield item, place, None if none else i, -score


@pytest.mark.parametrize("several", [False, True])
@pytest.mark.parametrize("table", ["small", "edge"])
def test_ranking_by_hand(spark, edge, table, several, monkeypatch):
    folder = SMALL if table == "small" else edge
    if several:
        monkeypatch.setattr(ball_tree, "PAIRS", 40)
    rows = [tuple(r) for r in Q.queries()["op12_ball_tree"](spark, folder).select("item_id", "rank", "doc_id", "score").collect()]
    assert collections.Counter(rows) == collections.Counter(ranked(documents(spark, folder), items(spark, folder)))


def _points(rng, rows, axes, copies=0):
    """Rows of four kinds of texts with axes of their own, and copies of the first row."""
    built = []
    for _ in range(rows):
        kind = rng.randrange(4)
        own = sorted({kind * (axes // 4) + min(int(rng.expovariate(0.1)), axes // 4 - 1) for _ in range(12)})
        built.append([(a, rng.randrange(1, 10 ** 9) * (1 + a % 30)) for a in own])
    built += [built[0]] * copies
    ptr = np.r_[0, np.cumsum([len(b) for b in built])]
    flat = [e for b in built for e in b]
    return ball_tree.Points(np.arange(len(built)), ptr, np.array([a for a, _ in flat]), np.array([v for _, v in flat]))


@pytest.mark.parametrize("seed", range(4))
def test_tree_search_is_exact_and_prunes(seed):
    rng = random.Random(seed)
    axes = 200
    points = _points(rng, 3000, axes, copies=1000 if seed % 2 else 0)
    tree = ball_tree.BallTree(points, axes, 32)
    assert sum(len(p) for p in tree.leaves.values()) == len(points)
    scored = 0
    for _ in range(20):
        kind = rng.randrange(4)
        terms = np.array(sorted({kind * 50 + rng.randrange(50) for _ in range(8)}))
        wanted = np.zeros(axes, np.int64)
        wanted[terms] = 1
        every = points.products(wanted)
        for node, leaf in tree.leaves.items():
            assert leaf.products(wanted).max() <= tree.bounds(terms)[node]
        best = ball_tree.Best(10)
        scored += ball_tree.search(tree, terms, axes, best)
        order = np.lexsort((points.ids, -every))[:10]
        order = order[every[order] > 0]
        assert best.scores.tolist() == every[order].tolist() and best.ids.tolist() == points.ids[order].tolist()
    assert scored < 0.5 * 20 * len(tree.leaves)


def test_equal_points_all_round(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(300)] + [(1000 + i, "other text") for i in range(400)], "doc_id int, text string").repartition(5)
    rows = ball_tree.rank(docs, spark.createDataFrame([(1, "Same, same!")], "item_id int, text string")).collect()
    assert sorted((r["rank"], r.doc_id) for r in rows) == [(i + 1, i) for i in range(50)]


# --- importance resampling ---------------------------------------------------------------------

def resampled(docs, bench, least=20, percent=10):
    def bucket(word):
        return zlib.crc32(word.encode()) % 10_000

    held = [(d[0], [bucket(w) for w in words(d[1])]) for d in docs]
    source = collections.Counter(b for _, f in held for b in f)
    target = collections.Counter(bucket(w) for _, t in bench for w in words(t))
    s, t = sum(source.values()), sum(target.values())
    gain = {b: math.floor(1000 * math.log((target[b] + 1) * (s + 10_000) / ((source[b] + 1) * (t + 10_000)))) for b in source}
    out = []
    for i, f in held:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[:len(able) * percent // 100], 1):
        r[4] = place
    return out


@pytest.mark.parametrize("table", ["small", "edge"])
def test_resampling_by_hand(spark, edge, table):
    folder = SMALL if table == "small" else edge
    rows = Q.queries()["op13_resampling"](spark, folder).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(str(tuple(r)) for r in rows) == sorted(str(tuple(r)) for r in resampled(documents(spark, folder), items(spark, folder)))


@pytest.mark.parametrize("wanted", [0, 1, 777, 2600, 3000])
def test_ranks_of_tied_rows_in_many_runs(spark, monkeypatch, wanted):
    """A third of the rows are one row again and again; runs and segments are short."""
    monkeypatch.setattr(resampling, "OVER", 4)
    rng = random.Random(8)
    rows = [(5, 0)] * 1000 + [(rng.randrange(4000), rng.randrange(-20, 20)) for _ in range(1999)] + [(None, 19)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id bigint, score bigint").repartition(9).withColumn("place", F.monotonically_increasing_id())
    runs = spark.createDataFrame([(*r, n % 50) for n, r in enumerate(sorted(table.collect(), key=lambda r: (-r.score, r.doc_id is None, r.doc_id or 0, r.place)))],
                                 "doc_id bigint, score bigint, place bigint, pos bigint").repartition(7)
    drawn = resampling.draw(runs, 3000, wanted).collect()
    assert len(drawn) == 3000
    order = sorted(drawn, key=lambda r: (-r.score, r.doc_id is None, r.doc_id or 0, r.place))
    assert [r["rank"] for r in order] == [n + 1 if n < wanted else None for n in range(3000)]
    sizes = collections.Counter(r.segment for r in drawn)
    assert len(sizes) > 10 and max(sizes.values()) < 600     # the row that repeats is parted


def test_longer_features(monkeypatch):
    monkeypatch.setattr(resampling, "WORDS", 2)
    texts = ["a b a", "", "x", "a b"]
    buckets, number = resampling.features(*split(pa.array(texts)))
    want = [[w for k in (1, 2) for w in (" ".join(t.split()[i:i + k]) for i in range(len(t.split()) - k + 1))] for t in texts]
    assert number.tolist() == [len(w) for w in want]
    assert buckets.tolist() == [zlib.crc32(w.encode()) % 10_000 for ws in want for w in ws]
