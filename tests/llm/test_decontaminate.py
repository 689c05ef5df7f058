"""Decontamination and components against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from docketloom.llm import decontaminate, graph


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))


def brute(docs, items, window=13):
    known = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[s : s + n]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in known}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in known:
                    hit |= set(range(s, s + n))
                    found |= known[tuple(w[s : s + n])]
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def got(spark, docs, items, **options):
    out = decontaminate.overlap(spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("hashes", F.lit("x")), spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(2)), **options)
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in out.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    vocab = ["alpha", "BETA", "g1", "δέλτα", "É", "ÜBER", "x", "ΑΣ"]
    items = [(k, rnd.choice([" ", ", ", "-"]).join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 3, 12, 13, 14, 30])))) for k in range(12)] + [(None, "only here " * 8), (3, None), (99, "aΣ βΣ " * 9), (100, items_text := "q w e r t y u i o p a s d f g h j k l"), (100, items_text)]
    docs = []
    for k in range(40):
        parts = [rnd.choice(items)[1] or "" if rnd.random() < 0.5 else " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 40))) for _ in range(rnd.randint(0, 4))]
        text = rnd.choice([" ", "\n"]).join(parts)
        docs.append((k, text.upper() if rnd.random() < 0.2 and text.isascii() else text))
    docs += [(None, "q w e r t y u i o p a s d f"), (7, None), (8, ""), (9, "!!"), (1, docs[1][1]), (50, "alpha " * 30_000)]
    assert got(spark, docs, items) == brute(docs, items)


def test_other_windows_and_empty_tables(spark):
    docs, items = [(1, "a b c d e f g h"), (2, "z z z z z z z z z")], [(1, "b c d e f"), (2, "z z z z z z")]
    for window in (1, 2, 5, 6, 8):
        assert got(spark, docs, items, window=window) == brute(docs, items, window)
    assert got(spark, docs, []) == brute(docs, []) and got(spark, [], items) == []


def test_contaminated_at_a_twentieth(spark):
    df = spark.createDataFrame([(0, 0), (1, 20), (1, 21), (13, 260), (0, 5)], "n_hit long, n_words long")
    assert [r[0] for r in df.select(decontaminate.contaminated()).collect()] == [False, True, False, True, False]


def test_components_of_random_graphs_and_long_paths(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2000 + i) for i in range(1, 50)] + [(5, 5), (None, 3), (4, None), (-9, 2**62)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    df = spark.createDataFrame(edges, "u long, v long")
    assert {(r["node"], r["root"]) for r in graph.connected_components(df).collect()} == {(x, find(x)) for x in list(root)}
    assert graph.connected_components(df.where("false")).count() == 0
