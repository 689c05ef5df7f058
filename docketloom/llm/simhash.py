"""SimHash near-duplicates: fingerprints of word shingles, linked exactly with vantage-point trees.

Linking never compares all pairs. The top of the tree has fixed vantage points: a fingerprint lives in the shard of its
Hamming distances to them, and because a distance changes by at most ``radius`` between linked fingerprints (the
triangle bound), it visits only the shards whose distances lie that close, on one side, and whose parity fits. Within a
shard the tree goes on with vantage points of its own until the rest is small enough to compare.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, bounded_batches, lower_az, small, staged
from .graph import connected_components

_hash = partial(xxhash.xxh64_intdigest, seed=42)
#: Rows of hashes whose bits are counted at a time.
_ROWS = 1 << 16
#: Fingerprints of a shard beyond which it is cut into blocks that meet pairwise, each pair in a task of its own.
HOT = 65_536
#: Pairs of fingerprints below which a branch is compared rather than split, and the most compared at a time.
_FEW = 1 << 18
_BLOCK = 1 << 20


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half of the shingles' XXH64 (seed 42); 0 if there are no words."""
    words = WORD_BYTES.findall(lower_az(text)) if text else []
    n = len(words)
    if not n:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if n >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(_hash, shingles), np.uint64, max(1, n - shingle + 1))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _ROWS):
        ones += np.unpackbits(hashes[k : k + _ROWS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", out_col: str = "fp", shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint of each whole text as a signed long. Null, empty and blank texts get 0."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return bounded_batches(docs).withColumn(out_col, of(F.col(text_col)))


def vantage_points(n: int) -> list[int]:
    """Fixed points to measure distances from, as signed longs."""
    return [int(np.uint64(_hash(b"vantage %d" % k)).view(np.int64)) for k in range(n)]


def vantages_for(n: int) -> int:
    """How many fixed vantage points ``n`` fingerprints take. One more makes about five times as many shards and about four
    times as many visits, so that shards get a little smaller and the pairs left to compare much fewer."""
    return 2 + (n > 2e7) + (n > 2e9)


class Forest:
    """Union of the nodes 0..n-1 by arrays of pairs; a root is the least node of its tree."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def _compare(fps: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int, forest: Forest) -> None:
    rows = max(1, _BLOCK // max(1, len(b)))
    for k in range(0, len(a), rows):
        part = a[k : k + rows]
        i, j = np.nonzero(np.bitwise_count(fps[part][:, None] ^ fps[b][None, :]) <= radius)
        forest.link(part[i], b[j])


def link_close(fps: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int, forest: Forest, depth: int = 0) -> None:
    """Link every pair of ``a`` x ``b`` (indices into ``fps``) at ``radius`` or fewer bits: a vantage point splits both
    sides into shells by distance, and a shell meets only those that the triangle bound leaves."""
    if not len(a) or not len(b):
        return
    if len(a) * len(b) <= _FEW or depth >= 12:
        return _compare(fps, a, b, radius, forest)
    point = fps[a[(len(a) * 7 + depth) // 13 % len(a)]]
    da, db = np.bitwise_count(fps[a] ^ point), np.bitwise_count(fps[b] ^ point)
    a, b = a[oa := np.argsort(da, kind="stable")], b[ob := np.argsort(db, kind="stable")]
    da, db = da[oa].astype(int), db[ob].astype(int)
    for d in np.unique(da):
        mine = a[np.searchsorted(da, d) : np.searchsorted(da, d, "right")]
        theirs = b[np.searchsorted(db, d - radius) : np.searchsorted(db, d + radius, "right")]
        if len(mine) * len(theirs) > 0.7 * len(a) * len(b):
            _compare(fps, mine, theirs, radius, forest)
        else:
            link_close(fps, mine, theirs, radius, forest, depth + 1)


def close_edges(distinct_fps: DataFrame, radius: int = 3, vantages: int = 2, hot: int = HOT) -> DataFrame:
    """Edges ``(u, v)`` that span the components of distinct fingerprints ``fp`` linked at ``radius`` or fewer bits.

    A task returns one edge for each fingerprint that has a link there, however many links it has, so that a group of n
    near copies never makes more than n edges in a task. A task has at most about ``2 * hot`` fingerprints: fuller shards are
    cut into blocks, whose pairs are dealt out.
    """
    points = vantage_points(vantages)
    dist = F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))) for p in points])
    # the difference of two distances has the parity of the distance between the fingerprints, so all of a visit's agree
    visits = [v for v in product(range(-radius, radius + 1), repeat=vantages) if v > (0,) * vantages and len({x % 2 for x in v}) == 1]
    offsets = F.array(*[F.array(*[F.lit(x) for x in v]) for v in [(0,) * vantages, *visits]])
    moved = distinct_fps.select("fp", dist.alias("d")).select("fp", F.explode(F.transform(offsets, lambda o: F.struct(F.zip_with("d", o, lambda x, y: x - y).alias("shard"), (F.aggregate(o, F.lit(0), lambda s, x: s + F.abs(x)) == 0).alias("home")))).alias("s"))
    placed = moved.where(F.forall("s.shard", lambda x: (x >= 0) & (x <= 64))).select("fp", F.col("s.shard").alias("shard"), F.col("s.home").alias("home"))

    full = small(staged(placed.groupBy("shard").count().where(F.col("count") > hot).select("shard", F.ceil(F.col("count") / hot).cast("int").alias("blocks")), "full_shards"))
    blocks = F.coalesce("blocks", F.lit(1))
    cut = placed.join(full, "shard", "left").select("fp", "shard", "home", F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block"), F.sequence(F.lit(0), blocks.cast("int") - 1).alias("all"))
    # the row's block is visited by every block, and if the shard is the row's home it visits every block
    meets = F.concat(F.transform("all", lambda i: F.struct(i.alias("left"), F.col("block").alias("right"))), F.when(F.col("home"), F.transform(F.filter("all", lambda i: i != F.col("block")), lambda i: F.struct(F.col("block").alias("left"), i.alias("right")))).otherwise(F.array()))
    dealt = cut.select("fp", "shard", "home", "block", F.explode(meets).alias("m")).select("fp", "shard", "home", "block", "m.left", "m.right")

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        order = part.sort_values("fp")
        fps, block = order["fp"].to_numpy(np.int64).view(np.uint64), order["block"].to_numpy()
        visiting = np.flatnonzero(order["home"].to_numpy(bool) & (block == part["left"].iloc[0]))
        visited = np.flatnonzero(block == part["right"].iloc[0])
        forest = Forest(len(fps))
        link_close(fps, visiting, visited, radius, forest)
        linked = np.flatnonzero(forest.root != np.arange(len(fps)))
        return pd.DataFrame({"u": fps[linked].view(np.int64), "v": fps[forest.root[linked]].view(np.int64)})

    return dealt.groupBy("shard", "left", "right").applyInPandas(meet, "u long, v long")


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row for each row of ``docs``: ``id_col``, ``fp`` and ``component_id``, the least id that links reach.

    Links join fingerprints at ``radius`` or fewer differing bits, exactly. Null, empty and blank texts have fingerprint
    0, which links like any other. A null id is never a component's name unless all its ids are null; repeated rows stay.
    An empty table gives an empty one; other columns are ignored, whatever their names.
    """
    marked = staged(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), "t", "fp", shingle).select("id", "fp"), "fingerprints")
    least = staged(marked.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = connected_components(staged(close_edges(least.select("fp"), radius, vantages_for(least.count())), "close"))
    joined = least.join(roots, least["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    names = joined.join(named, "root").select("fp", "component_id")
    return marked.join(names, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def as_hex(fp: str) -> Column:
    """16 lower-case hexadecimal digits of a signed long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
