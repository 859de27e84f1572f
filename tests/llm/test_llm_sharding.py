"""Sharding: the table against a literal turn-taking fill, balance, movement, files."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm import sharding as S


def slow_table(shards, size):
    orders = []
    for s in shards:
        offset = xxhash.xxh64_intdigest(s.encode(), 1) % size
        step = xxhash.xxh64_intdigest(s.encode(), 2) % (size - 1) + 1
        orders.append([(offset + k * step) % size for k in range(size)])
    table = {}
    while len(table) < size:
        for k, order in enumerate(orders):
            free = next((x for x in order if x not in table), None)
            if free is not None:
                table[free] = k
    return [table[k] for k in range(size)]


@pytest.mark.parametrize("n,size", [(1, 7), (3, 31), (5, 101), (7, 7)])
def test_table_equals_turn_taking(n, size):
    shards = [f"s{k}" for k in range(n)]
    assert S.lookup_table(shards, size).tolist() == slow_table(shards, size)


def test_balance_and_little_movement():
    shards = [f"s{k}" for k in range(64)]
    table = S.lookup_table(shards)
    sizes = np.bincount(table)
    assert sizes.max() - sizes.min() <= 1
    fewer = S.lookup_table(shards[:-1])
    assert (table != fewer).mean() < 3 / 64
    assert np.bincount(S.lookup_table(["a", "b"], 101, [3, 1])).tolist() in ([76, 25], [75, 26])
    for bad in (dict(shards=["a"], size=10), dict(shards=["a", "a"]), dict(shards=[]),
                dict(shards=["a"], weights=[0])):
        with pytest.raises(ValueError):
            S.lookup_table(**bad)


def test_rows(spark):
    rows = [(k % 40, "x", "old") for k in range(200)] + [(None, None, None)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, SHARD string")
    shards = ["a", "b", "c"]
    got = S.place(df, "doc_id", shards, 101)
    assert got.columns == ["doc_id", "text", "slot", "shard"] and got.count() == 205
    table = S.lookup_table(shards, 101)
    for r in got.withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(101))).collect():
        assert r.slot == r.h and r["shard"] == shards[table[r.slot]]
    assert got.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0
    assert S.place(df.limit(0), "doc_id", shards, 101).collect() == []


def test_written_files_hold_every_row_and_split_a_hot_shard(spark, tmp_path):
    df = spark.range(600).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id")).alias("doc_id"),
                                 F.col("id").alias("v"))
    path = str(tmp_path / "shards")
    S.write(df, "doc_id", path, ["a", "b"], 101, rows_per_file=100)
    back = spark.read.parquet(path)
    assert sorted(r.v for r in back.collect()) == list(range(600))
    hot = S.place(df.limit(1), "doc_id", ["a", "b"], 101).first()["shard"]
    assert len(list((tmp_path / "shards" / f"shard={hot}").glob("*.parquet"))) > 1
