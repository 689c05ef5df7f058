"""Embedding near-duplicates against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketloom.llm import embeddings


def brute(rows, least=0.9):
    ok = {}
    for k, (_, v) in enumerate(rows):
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[k] = np.array(v, float) / np.linalg.norm(v)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ok:
        for j in ok:
            if i < j and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= least:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, links[i], low[find(i)]) for i, (d, _) in enumerate(rows))


def rows(n, dims, seed, hot=0):
    rnd = np.random.default_rng(seed)
    base = rnd.standard_normal((n, dims))
    near = base[: n // 3] + rnd.standard_normal((n // 3, dims)) * rnd.uniform(0.05, 0.6, (n // 3, 1))
    far = base[:1] + rnd.standard_normal((hot, dims)) * 0.1
    x = np.concatenate([base, near, base[:5], 2 * base[:3], far]).astype(np.float32)
    return [(int(i), [float(c) for c in v]) for i, v in enumerate(x)]


def got(spark, src, **options):
    out = embeddings.similar(spark.createDataFrame(src, "vec_id long, embedding array<float>"), **options).collect()
    return sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out)


def test_recall_and_no_false_links(spark):
    src = rows(900, 32, 1)
    have, want = got(spark, src), brute(src)
    assert all(h[1] <= w[1] for h, w in zip(have, want, strict=True))
    assert sum(h[1] for h in have) >= 0.99 * sum(w[1] for w in want)


@pytest.mark.parametrize("hot_at", [40, 2048])
def test_hot_cluster_counts_every_link_once(spark, monkeypatch, hot_at):
    monkeypatch.setattr(embeddings, "HOT", hot_at)
    src = rows(60, 16, 2, hot=150)
    assert got(spark, src, shared=40.0) == brute(src)


def test_bad_vectors_and_edges(spark):
    nan, inf = float("nan"), float("inf")
    src = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [1.0, -0.0]), (9, [2.0, 0.0]), (9, [2.0, 0.0]), (10, [1.0]), (11, [-1.0])]
    assert got(spark, src) == brute(src)
    assert got(spark, []) == []
    assert got(spark, [(5, [1.0, 2.0])]) == [(5, 0, 5)]


def test_columns_with_clashing_names_play_no_part(spark):
    src = [*rows(20, 8, 3), (None, [1.0] * 8), (99, [1.0] * 8)]
    plain = spark.createDataFrame(src, "vec_id long, embedding array<float>")
    taken = ("id", "v", "n", "class", "least", "links", "root", "shard", "n_links", "component_id", "known_v")
    more = plain.select("*", *[F.lit(7 if k % 2 else None).alias(c) for k, c in enumerate(taken)])
    found = [sorted(map(tuple, embeddings.similar(df).select("vec_id", "n_links", "component_id").collect()), key=str) for df in (plain, more)]
    assert found[0] == found[1] and found[0][-1] == (None, 1, 99)


def test_list_decoding_finds_exactly_the_exceeding_filters():
    caps = embeddings.Caps(10, 9, 0.35, fewest=1)
    x = np.random.default_rng(4).standard_normal((50, 10))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = caps.books()
    for v, found in zip(x, caps.decode(x), strict=True):
        inner = (v[:5] @ a.T)[:, None] + (v[5:] @ b.T)[None, :]
        want = np.flatnonzero(inner.ravel() >= 0.35)
        assert found.tolist() == (want.tolist() if len(want) else found.tolist()) and len(found) >= 1
    sparse = embeddings.Caps(10, 9, 0.6)
    for v, found in zip(x, sparse.decode(x), strict=True):
        inner = ((v[:5] @ a.T)[:, None] + (v[5:] @ b.T)[None, :]).ravel()
        others = np.setdiff1d(np.arange(81), found)
        assert len(found) >= 8 and inner[found].min() >= inner[others].max(initial=-1)
