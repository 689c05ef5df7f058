"""SimHash near-duplicates against brute force."""

import random
import re

import pytest
import xxhash

from docketloom.llm import graph, simhash


def brute_fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, radius=3):
    fps = [brute_fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, f"{fps[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows))


def got(df):
    return sorted((r["doc_id"], r["f"], r["component_id"]) for r in df.select("doc_id", simhash.as_hex("fp").alias("f"), "component_id").collect())


def corpus(n, seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["Éa", "ÀB", "x y", "QU"]
    rows, texts = [], []
    for i in range(n):
        kind = rnd.random()
        if texts and kind < 0.2:
            t = rnd.choice(texts)
        elif texts and kind < 0.6:
            w = rnd.choice(texts).split(" ")
            for _ in range(rnd.randint(1, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            t = " ".join(w)
        else:
            t = " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 300)))
        texts.append(t)
        rows.append((i * 3, t))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(160, seed) + [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "Two words"), (9005, "two WORDS"), (9006, "x " * 30_000)]
    assert got(simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_components(rows)


def test_deeper_tree_finds_the_same_links():
    import numpy as np

    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 2**63, 1500, dtype=np.int64).view(np.uint64)
    near = base[:700] ^ (np.uint64(1) << rnd.integers(0, 64, 700).astype(np.uint64)) ^ (np.uint64(1) << rnd.integers(0, 64, 700).astype(np.uint64))
    fps = np.unique(np.concatenate([base, near]))
    found, brute = simhash.Forest(len(fps)), simhash.Forest(len(fps))
    every = np.arange(len(fps))
    simhash.link_close(fps, every, every, 3, found)
    simhash._compare(fps, every, every, 3, brute)
    assert (found.root == brute.root).all() and (found.root != every).sum() > 500


def test_three_vantage_points_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    rows = corpus(60, 5)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("root", F.lit(1)).withColumn("id", F.lit(0))
    assert got(simhash.near_duplicates(df)) == brute_components(rows)
    fps = simhash.with_fingerprint(df.drop("fp"), "text").select("fp").distinct()
    edges = {(r.u, r.v) for r in simhash.close_edges(fps, vantages=3).collect()}
    assert edges and all((u ^ v) & (2**64 - 1) for u, v in edges)


@pytest.mark.parametrize("hot", [5, 40])
def test_full_shards_in_blocks_find_the_same_links(spark, hot):
    rows = corpus(150, 8)
    fps = simhash.with_fingerprint(spark.createDataFrame(rows, "doc_id long, text string")).select("fp").distinct()
    linked = lambda edges: {frozenset((r["node"], r["root"])) for r in graph.connected_components(edges).collect()}
    # one vantage point makes the shards full
    assert linked(simhash.close_edges(fps, vantages=1, hot=hot)) == linked(simhash.close_edges(fps)) != set()


def test_empty_table_nulls_and_repeated_rows(spark):
    assert got(simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))) == []
    out = simhash.near_duplicates(spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c")], "doc_id long, text string")).collect()
    assert len(out) == 3 and {r["component_id"] for r in out} == {4}
