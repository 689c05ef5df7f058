"""Sharding: near-equal loads, whole groups, gapless slots."""

import random

import numpy as np
from pyspark.sql import functions as F

from docketloom.llm import sharding


def rows(n, seed, hot=0):
    rnd = random.Random(seed)
    out = [(i, " ".join("wörd" * rnd.randint(1, 3) for _ in range(rnd.randint(0, 60)))) for i in range(n)]
    return out + [(n + i, "hot text " * 20) for i in range(hot)] + [(None, None), (3, ""), (3, ""), (3, None)]


def test_balanced_whole_and_gapless(spark):
    src = rows(4000, 1)
    out = sharding.shard(spark.createDataFrame(src, "doc_id long, text string").repartition(5)).toPandas()
    assert len(out) == len(src)
    assert (out["size"] == [8 + len((t or "").encode()) for t in out["text"]]).all()
    per = out.groupby("shard").agg(n=("slot", "count"), top=("slot", "max"), low=("slot", "min"), b=("size", "sum"))
    assert list(per.index) == list(range(24)) and (per["top"] == per["n"] - 1).all() and (per["low"] == 0).all()
    assert not out.duplicated(["shard", "slot"]).any()
    assert per["b"].max() / per["b"].min() < 1.01 and per["n"].max() / per["n"].min() < 1.3  # the empty texts are one group
    per_text = out.assign(t=out["text"].fillna("")).groupby("t")["shard"].nunique()
    assert (per_text.drop("") == 1).all()  # the empty texts are over a quarter of a shard


def test_hot_group_is_split(spark):
    out = sharding.shard(spark.createDataFrame(rows(2000, 2, hot=1500), "doc_id long, text string")).toPandas()
    per = out.groupby("shard").agg(n=("slot", "count"), b=("size", "sum"))
    assert len(per) == 24 and per["b"].max() / per["b"].min() < 1.03
    assert out[out["text"].fillna("").str.startswith("hot")]["shard"].nunique() > 8


def test_edges(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = sharding.shard(spark.createDataFrame([(1, "a", 5), (2, "a", 6)], "doc_id long, text string, shard int").withColumn("a", F.lit(1)))
    assert got.columns == ["doc_id", "text", "shard", "a", "size", "shard_1", "slot"] and got.count() == 2


def test_pack_against_brute_force():
    rnd = np.random.default_rng(2)
    for _ in range(30):
        loads, bins = rnd.integers(0, 20, (rnd.integers(1, 40), 3)).astype(float), int(rnd.integers(1, 6))
        unit = [max(sum(x[j] for x in loads) / bins, 0) or 1 for j in range(3)]
        left, w = [[1.0] * 3 for _ in range(bins)], (256.0, 1.0, 1.0)
        scaled = [[x[j] / unit[j] for j in range(3)] for x in loads]
        want = [0] * len(loads)
        for i in sorted(range(len(loads)), key=lambda i: -sum(w[j] * scaled[i][j] for j in range(3))):
            best = max(range(bins), key=lambda k: (round(sum(left[k][j] * w[j] * scaled[i][j] for j in range(3)), 9), -k))
            want[i], left[best] = best, [left[best][j] - scaled[i][j] for j in range(3)]
        got = sharding.pack(loads, bins).tolist()
        sums = lambda of: sorted(sum(x[0] for x, k in zip(loads, of, strict=True) if k == b) for b in range(bins))  # noqa: B023, E731
        assert sums(got) == sums(want)


def test_slots_are_gapless_in_any_partitioning(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id % 7 AS INT) AS shard").repartition(9)
    out = sharding.numbered(df, "shard", "slot").toPandas()
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in out.groupby("shard")) and len(out) == 1000


def test_long_texts_and_a_hot_group_without_ids(spark):
    rows = [(None, "same")] * 900 + [(i, f"t{i} " * 50) for i in range(300)] + [(7, "long " * 40_000), (None, None)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=3).toPandas()
    assert len(out) == len(rows) and sorted(out["shard"].unique()) == [0, 1, 2]
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in out.groupby("shard"))


def test_pack_prefers_the_highest_dot_product():
    assert sharding.pack(np.array([[4.0, 1, 1], [3, 1, 1], [2, 1, 1], [1, 1, 1]]), 2).tolist() == [0, 1, 1, 0]
    assert sharding.pack(np.zeros((0, 3)), 3).tolist() == []
