"""The pipeline's stages against brute force on what each was given."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from docketloom.llm import simhash
from docketloom.llm.common import staged, table

DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    out = [table(spark, DIR, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], DIR), "test"))
    return [d.toPandas() for d in out]


def test_columns_and_subset(stages):
    assert [len(corpus_pipeline.STAGES)] + [list(d.columns) for d in stages[:-1]] == [5] + [COLUMNS] * 5
    for before, after in zip(stages, stages[1:], strict=False):
        assert set(after["doc_id"]) <= set(before["doc_id"])
    assert list(stages[-1].columns) == [*COLUMNS, "size", "shard", "slot"]


def test_quality_keeps_good_documents(spark, stages):
    labels = table(spark, DIR, "labels").toPandas()
    good = set(labels[labels["quality"] == 1]["doc_id"])
    assert len(good & set(stages[1]["doc_id"])) >= 0.97 * len(good)
    assert len(stages[1]) < len(stages[0])


def test_near_duplicates_leave_one_of_each_group(stages):
    rows = stages[1]
    fps = [simhash.fingerprint(t) for t in rows["text"]]
    ids, root = rows["doc_id"].tolist(), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    assert sorted(stages[2]["doc_id"]) == sorted(least.values())


def test_contaminated_documents_go(spark, stages):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))

    windows = {tuple(w[s : s + 13]) for t in table(spark, DIR, "benchmark").toPandas()["text"] for w in [words(t)] for s in range(len(w) - 12)}
    kept = []
    for d, t in zip(stages[2]["doc_id"], stages[2]["text"], strict=True):
        w = words(t)
        hit = {p for s in range(len(w) - 12) if tuple(w[s : s + 13]) in windows for p in range(s, s + 13)}
        if not hit or 20 * len(hit) < len(w):
            kept.append(d)
    assert sorted(stages[3]["doc_id"]) == sorted(kept)


def test_mixing_repeats_rows_and_sharding_places_them(stages):
    times = Counter(stages[4]["doc_id"])
    assert max(times.values()) <= 3 and stages[4].drop_duplicates().shape[0] == len(times)
    assert Counter(stages[5]["doc_id"]) == times
    per = stages[5].groupby("shard")["slot"]
    assert (per.max() + 1 == per.count()).all() and not stages[5].duplicated(["shard", "slot"]).any()


def test_run_equals_the_stages(spark, stages):
    out = corpus_pipeline.run(spark, DIR).toPandas()
    assert sorted(map(tuple, out[["doc_id", "shard", "slot"]].values.tolist())) == sorted(map(tuple, stages[5][["doc_id", "shard", "slot"]].values.tolist()))


def test_decontamination_decides_by_row(spark):
    bad = table(spark, DIR, "benchmark").where("length(text) > 200").orderBy("item_id").first()["text"]
    rows = [(None, bad), (None, "clean one"), (None, None), (2, bad), (2, "clean two"), (3, bad), (4, "clean two"), (4, "clean two")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.decontamination_stage(spark, docs, DIR).collect())
    assert kept == Counter((i, t) for i, t in rows if t != bad)


def test_near_duplicates_leave_one_row_of_null_and_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{w}{n}" for n in range(30)) for w in "abcd")
    rows = [(None, a), (1, a), (None, b), (None, b), (2, c), (2, c), (3, c), (3, d), (None, d)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicate_stage(spark, docs, DIR).collect())
    assert kept == Counter([(1, a), (None, b), (2, c), (3, d)])


def test_columns_with_clashing_names_come_through(spark):
    bad = table(spark, DIR, "benchmark").where("length(text) > 200").orderBy("item_id").first()["text"]
    names = ["row", "score", "predicted", "bad_id", "bad_key", "copies", "size", "shard", "slot", "id", "key", "bytes", "tokens", "a", "h", "hash", "words"]
    rows = [(1, bad, "a"), (2, "some clean words " * 40, "b"), (2, "some clean words " * 40, "b"), (3, "other quite long text " * 5_000, None)]
    docs = spark.createDataFrame([(i, t, None, s, None) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({n: F.concat(F.lit(n), F.substring("text", 1, 9)) for n in names})
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DIR).toPandas()
        assert list(out.columns[: len(docs.columns)]) == docs.columns
        assert all((out[n] == n + out["text"].str[:9]).all() for n in names)


def test_stages_take_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (2, "a b c", None, "s", 5), (2, "a b c", None, "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert set(COLUMNS) <= set(stage(spark, docs, DIR).columns)
        assert stage(spark, docs, DIR).count() <= 12
        assert stage(spark, docs.where("false"), DIR).count() == 0
