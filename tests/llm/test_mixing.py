"""Mixing: targets, the dual and the rounding."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketloom.llm import mixing


def brute_targets(totals, weights=(1, 2, 3), most=3):
    """By bisection on the water level."""
    order = sorted(s for s in totals if s is not None) + [None] * (None in totals)
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    low, high, every = 0.0, 1e12, sum(totals.values())
    for _ in range(300):
        mid = (low + high) / 2
        if sum(min(mid * w[s], most * totals[s]) for s in order) < every:
            low = mid
        else:
            high = mid
    return {s: min(high * w[s], most * totals[s]) for s in order}


@pytest.mark.parametrize("totals", [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 10, "c": 5, None: 7}, {"é": 5, "z": 50, "Z": 0}, {"a": 9}, {"a": 0}])
def test_targets(totals):
    got, want = mixing.source_targets(totals), brute_targets(totals)
    assert got == pytest.approx(want, rel=1e-6, abs=1e-6)


def sample(spark, n=3000, seed=1):
    rnd = np.random.default_rng(seed)
    src = rnd.choice(["s1", "s2", "s3", "s4", None], n, p=[0.4, 0.1, 0.3, 0.15, 0.05])
    size = np.maximum(1, rnd.lognormal(5, 1.2, n).astype(int))
    rows = [(int(i), None if s is None else str(s), int(x)) for i, (s, x) in enumerate(zip(src, size, strict=True))]
    return spark.createDataFrame([*rows, (None, "s1", 0), (7, "s1", 9), (7, "s1", 9)], "doc_id long, source string, size long")


def test_taken_is_near_targets_and_bounded(spark):
    out = mixing.mix(sample(spark)).toPandas()
    assert (out["taken"] == out["size"] * out["copies"]).all() and out["copies"].between(0, 3).all()
    per = out.assign(source=out["source"].fillna("~")).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"), source_size=("source_size", "first"))
    assert (per["size"] == per["source_size"]).all()
    assert (abs(per["taken"] - per["target"]) <= 0.005 * per["target"]).all()
    assert abs(per["target"].sum() - per["size"].sum()) < 1e-3
    # exponential tilt: within a source the log of an unbounded rate is proportional to the size
    one = out[(out["source"] == "s1") & (out["rate"] < 3) & (out["size"] > 0)]
    ratio = np.log(one["rate"]) / one["size"]
    assert ratio.max() - ratio.min() < 1e-9 + 1e-6 * abs(ratio.mean())
    again = mixing.mix(sample(spark).repartition(7)).toPandas()
    key = ["doc_id", "size", "copies"]
    assert sorted(map(str, out[key].values.tolist())) == sorted(map(str, again[key].values.tolist()))


def test_rates_against_bisection(spark):
    """Each source's multiplier by bisection on the words that its rates take."""
    out = mixing.mix(sample(spark, 800, 4)).toPandas()
    totals = out.assign(source=out["source"].fillna("~")).groupby("source")["size"].sum().to_dict()
    targets = brute_targets({None if s == "~" else s: n for s, n in totals.items()})
    for source, target in targets.items():
        mine = out[out["source"].isna() if source is None else out["source"] == source]
        sizes, low, high = mine["size"].to_numpy(float), -1.0, 1.0
        rates = lambda tilt: np.minimum(3.0, np.exp(np.minimum(tilt * sizes, 50)))  # noqa: B023, E731
        if target < 3 * sizes.sum() * (1 - 1e-9):
            for _ in range(200):
                mid = (low + high) / 2
                low, high = (mid, high) if (rates(mid) * sizes).sum() < target else (low, mid)
            assert mine["rate"].to_numpy() == pytest.approx(rates(high), rel=1e-4)
        else:
            assert (mine["rate"][mine["size"] > 0] == 3).all()
        assert mine["target"].iloc[0] == pytest.approx(target)


def test_rounding_against_the_definition(spark):
    """Within a group the words owed are carried on from the largest document down."""
    out = mixing.mix(sample(spark, 200, 6), group_rows=10_000).toPandas()
    for _, part in out.assign(source=out["source"].fillna("~")).groupby("source"):
        owed, want = 0.0, []
        for size, rate in part.sort_values("size", ascending=False)[["size", "rate"]].itertuples(index=False):
            whole = int(rate + 1e-12)
            owed += max(rate - whole, 0) * size
            more = rate - whole > 1e-12 and owed >= size / 2
            owed -= size * more
            want.append((size, whole + more))
        assert sorted(want) == sorted(part[["size", "copies"]].itertuples(index=False, name=None))


def test_newton_that_does_not_end_is_an_error(spark):
    with pytest.raises(RuntimeError, match="miss their targets"):
        mixing.mix(sample(spark), rounds=1)


def test_many_rows_without_an_id_are_spread(spark):
    df = spark.range(9000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'s' AS source", "5L AS size").union(spark.range(900).selectExpr("id", "'t'", "id % 50 + 1"))
    out = mixing.mix(df, group_rows=16).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert len(out) == 2 and all(abs(r["taken"] - r["target"]) <= 0.01 * r["target"] for r in out)


def test_edges(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, source string, size long")).count() == 0
    out = mixing.mix(spark.createDataFrame([(1, None, 0, 5)], "doc_id long, source string, size long, target int"))
    assert out.columns == ["doc_id", "source", "size", "target", "source_size", "target_1", "rate", "copies", "taken"]
    assert out.first()["taken"] == 0
    one = mixing.mix(spark.createDataFrame([(1, "a", 10), (2, "b", 1000)], "doc_id long, source string, size long")).toPandas().set_index("source")
    assert one.loc["a", "copies"] == 3 and one.loc["a", "target"] == 30
    assert mixing.repeated(mixing.mix(sample(spark)), ["doc_id", "size"]).agg(F.sum("size")).first()[0] == mixing.mix(sample(spark)).agg(F.sum("taken")).first()[0]


def test_words_of_a_text(spark):
    df = spark.createDataFrame([(None,), ("",), (" \t\n\x0b\x0c\r ",), ("a b c\x1cd é",)], "text string")
    assert [r[0] for r in df.select(mixing.word_count(F.col("text"))).collect()] == [0, 0, 0, 3]
