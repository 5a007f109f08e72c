"""Blocks, samples and batches at sizes small enough to see them close."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from collabstats.llm import byte_cnn, langid, lattice_lm, mixing, permutation_index, simhash, suffix_dedup
from collabstats.llm import queries as Q
from tests.llm.conftest import SMALL


def _vectors(spark, lengths):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(n)]) for i, n in lengths]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), rows


def _nearest(rows, width, every=50, wanted=5):
    rows = [(i, np.array(v)) for i, v in rows if len(v) == width]
    for q, v in rows:
        if q % every == 0:
            near = sorted((-float(w @ v / np.linalg.norm(w) / np.linalg.norm(v)), i) for i, w in rows if i != q)
            yield q, [i for _, i in near[:wanted]]


def test_one_vector_of_another_length_takes_nothing_away(spark):
    """Whichever vector it is: also the one with the smallest hash, which is first among the pivots."""
    for odd in (7, 100, 150):
        table, rows = _vectors(spark, [(i, 5 if i == odd else 8) for i in range(200)])
        found = collections.defaultdict(list)
        for r in permutation_index.search(table).orderBy("query_id", "rank").collect():
            found[r.query_id].append(r.vec_id)
        want = dict(_nearest(rows, 8))
        assert set(found) == set(want) and all(len(v) == 5 for v in found.values())
        assert sum(len(set(found[q]) & set(want[q])) for q in want) >= 0.9 * 5 * len(want)
    smallest = spark.range(200).selectExpr("id", "xxhash64(id) AS h").orderBy("h").first().id
    table, _ = _vectors(spark, [(i, 5 if i == smallest else 8) for i in range(200)])
    assert permutation_index.search(table).count() == 20 - (5 if smallest % 50 == 0 else 0)


def test_equally_common_lengths_go_to_the_smaller(spark):
    table, rows = _vectors(spark, [(i, 8 if i % 100 < 50 else 5) for i in range(200)])
    found = {r.query_id for r in permutation_index.search(table).collect()}
    assert found == {i for i, v in rows if len(v) == 5 and i % 50 == 0}


def test_queries_in_blocks_find_the_same(spark, monkeypatch):
    table, _ = _vectors(spark, [(i, 8) for i in range(600)])
    whole = sorted(map(tuple, permutation_index.search(table, every=3).collect()))
    monkeypatch.setattr(permutation_index, "ASKED", 5)
    assert sorted(map(tuple, permutation_index.search(table, every=3).collect())) == whole
    monkeypatch.setattr(permutation_index, "LEAST", 1)       # short of rows: the exact way, in blocks too
    monkeypatch.setattr(permutation_index, "SHARE", 1e-9)
    exact = collections.defaultdict(list)
    for r in permutation_index.search(table, every=3).collect():
        exact[r.query_id].append(r.vec_id)
    assert all(len(v) == 5 for v in exact.values()) and len(exact) == 200


def test_language_model_blocks_of_any_size(spark, monkeypatch):
    def rows():
        return sorted((r.doc_id, r.n_known, round(r.base_score, 9), round(r.score, 9)) for r in Q.queries()["op2_lattice_lm"](spark, SMALL).collect())

    whole = rows()
    for name, value in (("BLOCK_DOCS", 7), ("BLOCK_BYTES", 2000), ("OUT_ROWS", 11)):
        monkeypatch.setattr(lattice_lm, name, value)
    assert rows() == whole


def _plain_probability(w, text):
    """The network, place by place."""
    half, width, stride = byte_cnn.HALF, byte_cnn.WIDTH, byte_cnn.STRIDE
    step = half * stride
    count = max(1, -(-len(text) // step))
    data = list(text) + [0] * (count * step + width - stride - len(text))
    halves = []
    for h in range(count):
        places = [sum(w["table"][i][data[h * step + p * stride + i]] for i in range(width)) for p in range(half)]
        halves.append(np.max(places, axis=0))
    chunks = np.array([np.tanh(np.maximum(halves[h], halves[min(h + 1, count - 1)]) + w["bias"]) for h in range(count)])
    pooled = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0), chunks.min(axis=0)])
    hidden = np.tanh(pooled @ w["hidden"] + w["hidden_bias"])
    return 1 / (1 + np.exp(-(hidden @ w["out"] + w["out_bias"][0])))


@pytest.mark.parametrize("rows", [1, 1000])
def test_quality_scores_are_the_networks(spark, monkeypatch, rows):
    monkeypatch.setattr(byte_cnn, "ROWS", rows)
    rng = random.Random(4)
    texts = ["", "a", "x" * 128, "y" * 129, "é" * 300, *["".join(rng.choice("abc de.\n") for _ in range(rng.randrange(1, 900))) for _ in range(40)]]
    w = byte_cnn.fit([t.encode() for t in texts], np.array([float(i % 2) for i in range(len(texts))]))
    docs = spark.createDataFrame([*enumerate(texts), (1000, None)], "doc_id bigint, text string").repartition(3)
    for r in byte_cnn.predict(docs, w).collect():
        text = texts[r.doc_id] if r.doc_id < 1000 else ""
        assert r.score == pytest.approx(_plain_probability(w, text.encode()), abs=1e-5)
        assert r.predicted == int(r.score >= 0.5)


def test_quality_sample_is_bounded_in_bytes(spark, monkeypatch):
    seen = []
    docs = spark.createDataFrame([(i, ("z" if i % 10 == 0 else "ab") * (500 if i % 10 == 0 else 20)) for i in range(100)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id bigint, quality int")
    monkeypatch.setattr(byte_cnn, "LONGEST", 100)
    monkeypatch.setattr(byte_cnn, "SAMPLE_BYTES", 400)
    monkeypatch.setattr(byte_cnn, "fit", lambda texts, marks, seed=5: {"share": float(len(texts)), "bytes": sum(map(len, texts))})
    seen.append(byte_cnn.train(docs, labels))
    assert seen[0] == {"share": 10.0, "bytes": 400}
    monkeypatch.setattr(byte_cnn, "LONGEST", 1)
    assert byte_cnn.train(docs, labels)["share"] == 0.0


def test_fingerprints_expand_in_all_partitions(spark):
    from pyspark.sql import functions as F

    prints = spark.range(500).select(F.xxhash64("id").alias("simhash"))
    plan = simhash.links(prints)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "hashpartitioning(xxhash64(simhash" in plan


def test_equal_strings_of_a_key_are_removed_whole(spark):
    """Passages that meet again with equal and with other surroundings, against every string by itself."""
    rng = random.Random(9)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, tail = some(260), some(150)
    texts = [some(90) + passage + some(70), passage + tail, some(40) + passage + tail, passage + tail, passage, some(99) + passage[50:200] + tail, tail * 3]
    seen, want = set(), {}
    for i, t in enumerate(texts):
        covered = set()
        for a in range(len(t) - 99):
            if t[a:a + 100] in seen:
                covered.update(range(a, a + 100))
            seen.add(t[a:a + 100])
        want[i] = "".join(c for k, c in enumerate(t) if k not in covered)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    assert {r.doc_id: r.kept.decode() for r in suffix_dedup.remove_repeats(docs).collect()} == want


def test_language_filter_rejects_scripts_that_were_not_learned(spark):
    rows = [(i, t, lang, "a", None) for i, (t, lang) in enumerate([("the house and the garden", "en"), ("der hund und die katze", "de")] * 30)]
    made = ["мир и привет всем людям", "漢字仮名交じり文", "η γάτα και ο σκύλος", "the house and the γάτα", "der hund мир привет всем людям и и и", None, "12 34"]
    docs = spark.createDataFrame(rows + [(1000 + i, t, None, "b", None) for i, t in enumerate(made)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r.doc_id: r.lang for r in corpus_pipeline.languages(spark, docs, "").collect()}
    assert set(range(60)) <= set(kept) and {i: v for i, v in kept.items() if i >= 1000} == {1003: "en"}


def test_letters_of_learned_scripts(spark):
    learned = np.zeros((16, 2), bool)
    learned[1, 0] = learned[3, 1] = True   # Latin and Cyrillic
    rows = spark.createDataFrame([("ab мир",), ("ab \u00e9 γ",), ("漢字",), ("1 2",), (None,), ("\U0001F600 x",)], "text string")
    model = (["en", "ru"], None, learned)
    assert [r[0] for r in rows.select(langid.learned_share(F.col("text"), model)).collect()] == [1.0, 0.75, 0.0, 0.0, 0.0, 1.0]
    none = (["en"], None, np.zeros((16, 1), bool))
    assert {r[0] for r in rows.select(langid.learned_share(F.col("text"), none)).collect()} == {0.0}


def test_rows_without_ids_lie_in_many_buckets_of_the_mix(spark):
    rows = [(None, f"w{i} " * 20, "a") for i in range(400)] + [(7, f"v{i} " * 20, "a") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    _, offsets, _, _ = mixing.plan(docs)
    assert offsets.count() > 20 and offsets.agg(F.max("words")).first()[0] < 16000 // 4
    told = mixing.mix(docs).collect()
    assert len(told) == 800 and sum(r.taken for r in told) == pytest.approx(16000, rel=0.01)
