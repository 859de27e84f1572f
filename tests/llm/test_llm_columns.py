"""Extra columns of any name: every operator and pipeline stage returns them as
they are, and none of them changes its result."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quire.llm import (
    decontaminate, html_extract, license_scan, pack, periodic, quality_model, quality_rules, scaled_sketch, sharding,
    simhash, token_count,
)
from quire.llm.common import read_table
from quire.session import stage

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")

ODD = ["x.y", "row", "key", "found", "grams", "fp", "number", "scan0", "spans.x", "at", "part", "k", "t", "a`b",
       "__row", "__fp", "__count", "__stats", "__quality", "__doc", "__text", "__scan0", "N_Words.z", "files", "tile"]


@pytest.fixture(scope="module")
def docs(spark):
    return stage(read_table(spark, SF, "documents").where("doc_id % 4 = 0"))


@pytest.fixture(scope="module")
def odd(docs):
    return docs.select("*", *[F.concat(F.lit(f"{i}/"), F.col("doc_id").cast("string")).alias(c) for i, c in enumerate(ODD)])


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def whole(spark, name):
    return read_table(spark, SF, name)


@pytest.mark.parametrize("name,run,added", [
    ("scan", lambda s, d: decontaminate.scan(d, whole(s, "benchmark")), ["n_words", "n_hit", "items"]),
    ("clean", lambda s, d: decontaminate.clean(d, whole(s, "benchmark")), []),
    ("clean spans", lambda s, d: decontaminate.clean(d, whole(s, "benchmark"), mode="spans"), []),
    ("scan in blocks", lambda s, d: decontaminate.scan(d, whole(s, "benchmark"), block_bytes=4000), ["n_hit"]),
    ("tokens", lambda s, d: token_count.count_tokens(d), ["n_bytes", "n_tokens"]),
    ("shards", lambda s, d: sharding.place(d, "doc_id", ["a", "b", "c"]), ["slot", "shard"]),
    ("keep one", lambda s, d: simhash.keep_one(d), []),
    ("rules", lambda s, d: quality_rules.filter_documents(d, whole(s, "labels")), []),
    ("model", lambda s, d: quality_model.score(d, quality_model.fit(d, whole(s, "labels"))), ["score"]),
    ("licenses", lambda s, d: license_scan.scan(d), ["matches"]),
    ("html", lambda s, d: html_extract.extract(d.withColumn("html", F.col("text"))), ["blocks"]),
])
def test_operators_return_any_column(spark, docs, odd, name, run, added):
    plain, clashing = run(spark, docs), run(spark, odd)
    assert clashing.columns == plain.columns[:len(plain.columns) - len(added)] + ODD + plain.columns[len(plain.columns) - len(added):] \
        or set(clashing.columns) == set(plain.columns) | set(ODD)
    assert rows_of(clashing, plain.columns) == rows_of(plain, plain.columns)
    for r in clashing.collect():
        assert [r[c] for c in ODD] == [f"{i}/{r['doc_id']}" for i in range(len(ODD))]


@pytest.mark.parametrize("run", [
    lambda d: pack.pack(d), lambda d: simhash.near_duplicates(d), lambda d: periodic.find_runs(d),
    lambda d: scaled_sketch.against_next(d)])
def test_operators_ignore_any_column(docs, odd, run):
    plain, clashing = run(docs), run(odd)
    columns = [c for c in plain.columns if c not in ("sequence_id", "offset")]
    assert clashing.columns == plain.columns and rows_of(clashing, columns) == rows_of(plain, columns)


def test_shards_of_odd_columns_are_written(spark, odd, tmp_path):
    named = odd.select(*[F.col(f"`{c.replace('`', '``')}`") for c in odd.columns if c not in ("a`b",)])
    sharding.write(named, "doc_id", str(tmp_path / "out"), ["a", "b"])
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == odd.count() and "x.y" in back.columns and "files" in back.columns


@pytest.mark.parametrize("stage_of", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_pipeline_stages_return_any_column(spark, docs, odd, stage_of):
    _, apply = stage_of
    plain, clashing = apply(spark, docs, SF), apply(spark, odd, SF)
    assert clashing.columns == odd.columns
    assert rows_of(clashing, docs.columns) == rows_of(plain, docs.columns)
    for r in clashing.collect():
        assert [r[c] for c in ODD] == [f"{i}/{r['doc_id']}" for i in range(len(ODD))]
