"""The two classifiers: held-out accuracy, parts against brute force, edges."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketloom.llm import quality, toxicity
from docketloom.llm.common import crc_mod

DIR = "/root/testdata/sf0.1"


def auc(y, p):
    order = np.argsort(p)
    rank = np.empty(len(p))
    rank[order] = np.arange(1, len(p) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize(("score", "label", "mod", "fold"), [(quality.score_quality, "quality", 5, 0), (toxicity.score_toxicity, "toxic", 4, 2)])
def test_held_out_accuracy(spark, score, label, mod, fold):
    docs, labels = spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")
    out = score(docs, labels, crc_mod("doc_id", mod) != fold).where(crc_mod("doc_id", mod) == fold).join(labels, "doc_id").select("score", "predicted", F.col(label).alias("y")).toPandas()
    assert len(out) > 600 and auc(out["y"].to_numpy(), out["score"].to_numpy()) > 0.97
    assert (out["predicted"] == out["y"]).mean() > 0.97


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_edges(spark, score):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, " \n", 5), (None, "a b", 5), (4, "word " * 50_000, 5), (4, "x", 5)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, 0), (4, 0, 1), (4, 1, 1), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.where("false")):
        out = score(docs, known, F.lit(True)).collect()
        assert len(out) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    assert score(docs.where("false"), labels, F.lit(True)).count() == 0


def brute_segments(s):
    """All maximal scoring segments by the recursive definition."""
    best, at = 0.0, None
    for i in range(len(s)):
        for j in range(i + 1, len(s) + 1):
            v = sum(s[i:j])
            if v > best + 1e-9 or (at and abs(v - best) <= 1e-9 and j - i < at[1] - at[0]):
                best, at = v, (i, j)
    if not at:
        return []
    i, j = at
    return [*brute_segments(s[:i]), (i, j, best), *[(a + j, b + j, v) for a, b, v in brute_segments(s[j:])]]


def test_segments_match_the_definition():
    rnd = random.Random(5)
    for _ in range(200):
        s = [rnd.choice([-3, -2, -1, -0.5, 1, 2, 2.5]) + rnd.random() / 100 for _ in range(rnd.randint(0, 14))]
        got = toxicity.segments(np.array(s))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute_segments(s)]


def test_passages_of_words_that_occurred_before_are_found():
    model = toxicity.ToxicModel(table={"bad": 3.0, "worse": 4.0})
    text = " ".join(["bad"] + ["calm"] * 100 + (["worse", "bad", "worse", "bad"] + ["calm"] * 100) * 3)
    assert [(a, b) for a, b, _ in model.passages(text)] == [(101, 105), (205, 209), (309, 313)]


def test_evidence_counts_every_segment():
    model = toxicity.ToxicModel(table={"bad": 4.5, "worse": 4.5}, decay=0.9, constant=0.25)
    text = lambda n: " ".join((["worse", "bad"] + ["calm"] * 600) * n + ["calm"] * 602 * (30 - n))
    each = math.log(1 + model.level / (0.25 * 602 * 30 * math.exp(-0.9 * 9)))
    for n in (0, 1, 4, 5, 8, 30):
        assert model.evidence(text(n)) == pytest.approx(n * each)


def test_evidence_against_brute_force():
    rnd = random.Random(7)
    model = toxicity.ToxicModel(table={"x": 2.5, "y": 1.75}, decay=1.2, constant=0.5)
    for _ in range(60):
        words = rnd.choices("xyabc", k=rnd.randint(0, 16))
        found = brute_segments([model.table.get(w, model.drift) for w in words])
        want = sum(math.log(1 + model.level / (0.5 * len(words) * math.exp(-1.2 * s))) for _, _, s in found)
        assert model.evidence(" ".join(words)) == pytest.approx(want)
        assert [(a, b) for a, b, _ in model.passages(" ".join(words), 0.2)] == [(a, b) for a, b, s in found if 0.5 * len(words) * math.exp(-1.2 * s) <= 0.2]


def test_fit_against_brute_force(spark):
    """Counts, log-odds, decay and constant of the fit, each worked out from the definitions."""
    rnd = random.Random(11)
    rows = [(i, " ".join(rnd.choices(["slur", "vile"] if i % 4 == 0 and rnd.random() < 0.6 else ["calm", "tree", "sea", "slur", "sun"], weights=None, k=1) + rnd.choices(["calm", "tree", "sea", "sun"], k=6)), int(i % 4 == 0)) for i in range(400)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels, "toxic", F.lit(True), least=0.5)
    counts = {}
    for _, text, toxic in rows:
        for key in {k for t in text.split() for k in [t, *(t[:n] + "*" for n in (6, 5, 4) if len(t) > n)]}:
            counts.setdefault(key, [0, 0])[toxic] += 1
    n0, n1 = (sum(c[j] for c in counts.values()) for j in (0, 1))
    want = {}
    for key, (clean, toxic) in counts.items():
        prior, whole = 0.5 + 500 * (clean + toxic) / (n0 + n1), 0.5 * len(counts) + 500
        delta = math.log((toxic + prior) / (n1 + whole - toxic - prior)) - math.log((clean + prior) / (n0 + whole - clean - prior))
        low = delta - 1.28 * math.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
        if low >= 0.5:
            want[key] = low
    assert model.table == pytest.approx(want) and want
    clean = [[model.table.get(t, model.drift) for t in text.split()] for _, text, toxic in rows if not toxic]
    found = [s for c in clean for _, _, s in brute_segments(c)]
    assert model.constant == pytest.approx((len(found) + 0.5) * math.exp(model.decay * min(want.values())) / sum(map(len, clean)))
    flat = [round(x, 2) for c in clean for x in c]
    values = {model.drift, *(round(x, 2) for x in want.values())}
    weights = {v: flat.count(v) + 0.5 for v in values}
    assert sum(w * math.exp(model.decay * v) for v, w in weights.items()) == pytest.approx(sum(weights.values()), rel=1e-6)


@pytest.mark.parametrize(("score", "label"), [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_sample_is_bounded_and_columns_stay(spark, score, label):
    docs = spark.range(5000).selectExpr("id % 3 AS doc_id", "concat('text ', id) AS text", "7.5D AS score", "'mine' AS PREDICTED")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1)], f"doc_id long, {label} int")
    out = score(docs, labels, F.lit(True), bound=2)
    assert out.columns == ["doc_id", "text", "score", "PREDICTED", "score_1", "predicted_1"]
    assert out.where("score = 7.5 and PREDICTED = 'mine' and score_1 between 0 and 1").count() == 5000
    sample = quality.labelled_sample(docs, labels, label, F.lit(True), 2, F.min("text")).collect()
    assert len(sample) == 2 and {r["value"] for r in sample} <= {"text 0", "text 1", "text 2", "text 10", "text 1000", "text 100"}


def test_segments_take_linear_time():
    found = toxicity.segments(np.tile([1.0] + [-0.5] * 9, 100_000))
    assert len(found) == 100_000 and found[-1] == (999_990, 999_991, 1.0)


def test_additive_model_learns_an_interaction():
    rnd = np.random.default_rng(1)
    x = rnd.uniform(-1, 1, (4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.fit_additive(x, y)
    assert auc(y, model.score(x)) > 0.97 and {model.pairs[0][0], model.pairs[0][1]} == {0, 1}
