"""Every query on the edge tables (nulls, blanks, long texts, ties, copies, clashing columns) and on empty tables."""

import hashlib
import re
import zlib

import pytest

import corpus_pipeline
from collabstats.llm import queries as Q
from tests.llm.conftest import documents

NAMES = sorted(Q.queries())


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables_give_empty_results(spark, empty, name):
    assert Q.queries()[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", [n for n in NAMES if n not in ("pipeline", "op5_permutation_index", "op12_ball_tree")])
def test_one_result_per_row(spark, edge, name):
    rows = Q.queries()[name](spark, edge).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(d[0]) for d in documents(spark, edge))
    again = Q.queries()[name](spark, edge).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def _by_text(spark, edge, name):
    """Result rows by id, where the id is unique."""
    counts = {}
    for d in documents(spark, edge):
        counts[d[0]] = counts.get(d[0], 0) + 1
    return {r["doc_id"]: r for r in Q.queries()[name](spark, edge).collect() if counts[r["doc_id"]] == 1}


def test_pii_of_blank_and_full_rows(spark, edge):
    found = _by_text(spark, edge, "op1_pii")
    assert (found[1].n_email, found[1].n_ip, found[1].n_card, found[1].n_phone) == (1, 1, 1, 1)
    for blank in (2, 3, 4):
        assert found[blank].spans == "" and found[blank].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_language_of_texts_without_letters(spark, edge):
    found = _by_text(spark, edge, "op9_language")
    for blank in (2, 3, 4, 8):
        assert found[blank].lang_pred == "und" and found[blank].score == 0
    assert all(0 <= r.score <= 1 for r in found.values())


def test_held_out_split(spark, edge):
    for name, mod in (("op2_lattice_lm", 5), ("op6_byte_cnn", 3), ("op9_language", 3)):
        for doc_id, r in _by_text(spark, edge, name).items():
            assert r.held_out == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % mod == 1)


def test_copies_share_fingerprints_and_components(spark, edge):
    found = _by_text(spark, edge, "op4_simhash")
    assert found[5].fingerprint == found[6].fingerprint and found[6].component_id == 5
    assert found[2].fingerprint == found[3].fingerprint == found[4].fingerprint == "0" * 16
    assert {found[i].component_id for i in (2, 3, 4)} == {2}


def test_mixing_sizes_and_limits(spark, edge):
    rows = Q.queries()["op7_mixing"](spark, edge).collect()
    sizes = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or "")) for d in documents(spark, edge))
    assert sorted(r["size"] for r in rows) == sizes
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    total = sum(sizes)
    targets = {(r.source_size, r.target) for r in rows}
    assert sum(t for _, t in targets) == pytest.approx(total)


def test_neighbours_of_edge_vectors(spark, edge):
    rows = Q.queries()["op5_permutation_index"](spark, edge).collect()
    by_query = {}
    for r in rows:
        by_query.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(by_query) == {0, 50, 100, 450}   # null, zero and non-finite vectors take no part
    for q, found in by_query.items():
        assert [f[0] for f in sorted(found)] == [1, 2, 3, 4, 5] and q not in {f[1] for f in found}
    ties = sorted(by_query[450])
    assert [t[1] for t in ties[:3]] == [451, 451, 452] and ties[0][2] == ties[1][2]


def test_pipeline_stages_on_edge_rows(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, edge)
        assert tuple(out.columns) == corpus_pipeline.COLUMNS, name
        assert out.dtypes == [(c, t) for c, t in docs.dtypes if c in corpus_pipeline.COLUMNS]
        assert out.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, edge).count() == before


def test_pipeline_stage_decisions(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = {r.doc_id for r in stages["language ID"](spark, docs, edge).collect()}
    assert not kept & {2, 3, 4, 8} and {1, 5, 6, 7} <= kept
    single = stages["SimHash near-dedup"](spark, docs, edge).collect()
    ids = [r.doc_id for r in single]
    assert {1, 2, 5} <= set(ids) and not {3, 4, 6} & set(ids)   # 3 and 4 are blank as 2 is, 6 copies 5
    assert len(ids) == len(set(ids)) + ids.count(13) - 1   # two different texts share the id 13
    hidden = {r.doc_id: r for r in stages["PII"](spark, docs.where("doc_id in (1, 2, 3)"), edge).collect()}
    assert hidden[1].text == "Call [PHONE] or mail [EMAIL], card [CARD], host [IP]." and hidden[1].n_chars == len(hidden[1].text)
    assert hidden[2].text is None and hidden[3].text == ""


def test_pipeline_runs_and_decodes(spark, edge):
    rows = corpus_pipeline.run(spark, edge).collect()
    assert rows and all(r.n_tokens * 4 == len(r.ids) for r in rows)
