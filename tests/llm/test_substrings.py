"""Substring deduplication against counting every window."""

import hashlib
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketloom.llm import substrings


def brute(rows, window=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    counts = Counter(tuple(w[s : s + window]) for w in words for s in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = {p for s in range(len(w) - window + 1) if counts[tuple(w[s : s + window])] > 1 for p in range(s, s + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **options):
    df = substrings.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), **options)
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()), key=str)


def corpus(seed, n=60, vocab=30):
    rnd = random.Random(seed)
    passages = [[f"p{rnd.randrange(vocab)}" for _ in range(rnd.randint(20, 90))] for _ in range(6)]
    rows, texts = [], []
    for i in range(n):
        w = []
        for _ in range(rnd.randint(0, 4)):
            kind = rnd.random()
            if kind < 0.4:
                p = rnd.choice(passages)
                a = rnd.randrange(len(p))
                w += p[a : a + rnd.randint(1, 90)]
            elif kind < 0.6 and texts:
                t = rnd.choice(texts)
                a = rnd.randrange(len(t) + 1)
                w += t[a : a + rnd.randint(1, 200)]
            elif kind < 0.7:
                w += [rnd.choice(["aé", "b"])] * rnd.randint(1, 80)
            elif kind < 0.8:
                w += ["x", "y", "z"] * rnd.randint(1, 40)
            else:
                w += [f"v{rnd.randrange(500)}" for _ in range(rnd.randint(1, 120))]
        texts.append(w)
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(w)))
    return rows + [(n, rows[3][1]), (n + 1, rows[4][1]), (n + 1, rows[4][1]), (n + 2, None), (n + 3, ""), (None, " "), (n + 4, "q r " * 20_000)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_counting_every_window(spark, seed):
    rows = corpus(seed)
    assert got(spark, rows) == brute(rows)


def test_hot_passage_with_other_neighbours(spark):
    rnd = random.Random(9)
    hot = [f"h{i}" for i in range(50)]
    rows = [(i, " ".join([f"a{rnd.randrange(3)}" for _ in range(40)] + hot + [f"b{rnd.randrange(3)}" for _ in range(40)])) for i in range(200)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows[:40], window=20, gram=4) == brute(rows[:40], window=20)


@pytest.mark.parametrize("block", [1, 3, 20])
def test_anchors_of_several_blocks(spark, block):
    rows = corpus(4)
    assert got(spark, rows, block=block) == brute(rows)


def test_factors_cover_the_repeated_windows_and_are_long():
    rnd = random.Random(2)
    for _ in range(200):
        bodies = list({" ".join(rnd.choices("abc", k=rnd.randint(6, 16))).encode() for _ in range(rnd.randint(1, 6))})
        slid = lambda b: [tuple(b.split()[s : s + 6]) for s in range(len(b.split()) - 5)]
        bodies = [b for b in bodies if len(set(slid(b))) == len(slid(b))]  # stretches hold no window twice
        block, windows = substrings.Block(bodies, 6), list(map(slid, bodies))
        for k, mine in enumerate(windows):
            others = {w for j, x in enumerate(windows) if j != k for w in x}
            factors = block.factors(k)
            assert {s for a, b in factors for s in range(a, b - 5)} == {s for s, w in enumerate(mine) if w in others}
            text = bodies[k].split()
            assert all(any(b" ".join(text[a:b]) in x for j, x in enumerate(bodies) if j != k) for a, b in factors)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
def test_every_window_has_one_anchor_inside_it(words):
    window, gram = 9, 3
    _, places, firsts, ends = substrings.stretches(words, window, gram)
    served = [s for a, b in zip(firsts.tolist(), ends.tolist(), strict=True) for s in range(a, b - window + 1)]
    assert served == list(range(max(0, len(words) - window + 1)))
    assert all(b - window <= p <= a + window - gram for p, a, b in zip(places.tolist(), firsts.tolist(), ends.tolist(), strict=True))


def test_kept_text_and_edges(spark):
    assert got(spark, []) == []
    rows = [(1, " ".join(f"w{i}" for i in range(60))), (2, "x  y " + " ".join(f"w{i}" for i in range(10, 50)) + " end"), (3, "short text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("uid", F.lit(1)).withColumn("n", F.lit("a"))
    out = substrings.repeated_spans(df).join(df, "doc_id").select("doc_id", substrings.kept_text(F.col("text"), F.col("spans")).alias("t")).collect()
    kept = {r["doc_id"]: r["t"] for r in out}
    assert kept[2] == "x y end" and kept[3] == "short text" and kept[1].startswith("w0 w1") and "w10" not in kept[1].split()
