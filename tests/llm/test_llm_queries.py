"""The registered queries: SQL where there is any, contracts, and the pipeline
stage by stage against plain versions."""

import hashlib
import os
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quire.llm import pack, quality_model, quality_rules, queries, simhash
from quire.llm.common import read_table
from quire.session import stage
from test_llm_decontaminate import slow_scan
from test_llm_periodic import slow_collapsed, slow_runs
from test_llm_simhash import slow_classes, slow_fingerprint
from tools import check_oracles

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name, monkeypatch):
    monkeypatch.setattr(check_oracles, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(check_oracles, "ORACLES", queries.ORACLES)
    res = check_oracles.compare(spark, check_oracles.oracle_connection(SF), SF, name)
    assert res["status"] == "match" and "types" not in res, res


def test_all_operators_are_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name,columns,rows", [
    ("op3_quality_classifier", ["doc_id", "held_out", "score", "predicted"], "documents"),
    ("op4_html_extraction", ["page_id", "url", "text", "n_chars"], "pages"),
    ("op5_token_counts", ["doc_id", "n_bytes", "n_tokens", "over_limit"], "documents"),
    ("op7_license_scan", ["doc_id", "n_matches", "licenses", "coverage", "matched_words"], "documents"),
    ("op8_sharding", ["doc_id", "slot", "shard"], "documents"),
    ("op9_simhash", ["doc_id", "fingerprint", "component_id"], "documents"),
    ("op11_periodic_runs", ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                            "collapsed_sha256"], "documents"),
])
def test_one_row_for_each_input_row(spark, name, columns, rows):
    got = queries.QUERIES[name](spark, SF)
    assert got.columns == columns and got.count() == read_table(spark, SF, rows).count()


def test_periodic_query_equals_brute_force(spark, docs):
    want = []
    for d, t in docs.items():
        w = (t or "").encode().split()
        h, n = zlib.crc32(str(d).encode()), len(w)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = slow_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda r: (r[0], r[2])))
        want.append((d, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     hashlib.sha256(lines.encode()).hexdigest(),
                     hashlib.sha256(b" ".join(slow_collapsed(w, runs))).hexdigest()))
    got = sorted(map(tuple, queries.op11_periodic_runs(spark, SF).collect()))
    assert got == sorted(want) and sum(r[1] > 0 for r in got) > 10


def test_repeated_tails_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a  b"), (3, None), (4, ""), (10, " \t")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in queries.repeated_tails(df).collect()} == {None: "a  b", 3: None, 4: "", 10: " \t"}


def test_simhash_query_equals_brute_force(spark, docs):
    fps = {d: slow_fingerprint(t) for d, t in docs.items()}
    root = slow_classes(fps.values())
    least = {}
    for d, f in fps.items():
        least[root[f]] = min(d, least.get(root[f], d))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op9_simhash(spark, SF).collect()}
    assert got == {d: (f"{f:016x}", least[root[f]]) for d, f in fps.items()}


def test_packing_query_holds_every_id(spark, docs):
    tok = pack.Tokenizer()
    pieces = {}
    for r in queries.op10_packing(spark, SF).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == docs.keys()
    for d, parts in pieces.items():
        ids, at = tok.ids(docs[d]), 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].astype("<u4").tobytes())
            at += r.length
        assert at == len(ids)


def test_pipeline_stages_equal_plain_versions(spark, docs):
    d = read_table(spark, SF, "documents")
    names, left = d.columns, dict(docs)
    model = quality_model.fit(d, read_table(spark, SF, "labels"))
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]

    def rules(texts):
        keep = {r.doc_id for r in quality_rules.score(d, read_table(spark, SF, "labels")).where("kept").collect()}
        return {k: t for k, t in texts.items() if k in keep}

    def classifier(texts):
        ok = {r.doc_id for r in quality_model.score(d, model).where("score >= 0.3").collect()}
        return {k: t for k, t in texts.items() if k in ok}

    def dedup(texts):
        fps = {k: slow_fingerprint(t) for k, t in texts.items()}
        root = slow_classes(fps.values())
        first = {}
        for k in sorted(texts):
            first.setdefault(root[fps[k]], k)
        return {k: texts[k] for k in first.values()}

    def clean(texts):
        return {k: t for k, t in texts.items() if not slow_scan(t, items)[1]}

    for (name, apply), plain in zip(corpus_pipeline.STAGES[:-1], (rules, classifier, dedup, clean)):
        before = len(left)
        d2 = stage(apply(spark, d, SF), "test")
        left = plain(left)
        assert d2.columns == names
        assert {r.doc_id: r.text for r in d2.collect()} == left and 0 < len(left) <= before, name
        d = d2
    packed = corpus_pipeline.STAGES[-1][1](spark, d, SF)
    assert packed.agg(F.sum("length")).first()[0] == sum(len(pack.Tokenizer().ids(t)) for t in left.values())
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect()) == \
        sorted((r.doc_id, r.start, r.ids_crc32) for r in packed.collect())


def test_stages_take_odd_documents(spark):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 2), (2, "w " * 60, None, None, None, 3),
            (2, "w " * 60, None, None, None, 3), (3, "long text " * 100_000, "en", "s", 5, 4)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
    for name, apply in corpus_pipeline.STAGES:
        for df in (odd, odd.limit(0)):
            got = apply(spark, df, SF)
            assert got.collect() is not None
            if apply is not corpus_pipeline.packing:
                assert got.columns == odd.columns, name


def test_sha256_is_of_sorted_joined_items(spark):
    for r in queries.op2_decontamination(spark, SF).where("n_items = 0").limit(1).collect():
        assert r.items_sha256 == hashlib.sha256(b"").hexdigest()


def test_simhash_of_keys(spark):
    assert simhash.MAX_BITS == 3 and simhash.SHINGLE_WORDS == 3
