"""Embedding near-duplicates by spherical caps.

Filters are directions made of a structured random code: a direction joins one word of the first codebook with one of
the second, each covering half of the dimensions. A vector passes a filter if their inner product exceeds a threshold;
since the product is a sum over the halves, the passed filters are list-decoded from two sorted lists of inner products
without visiting the rest. Vectors that share a filter are compared exactly. Codebook size and threshold follow from the
number of vectors and the wanted chance of finding a pair at the least similarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .graph import connected_components
from .simhash import Forest

#: Vectors compared with so many others at a time.
_BLOCK = 512
#: Members of a shard beyond which it is cut into blocks that meet pairwise. Shards are planned to have about half as many.
HOT = 8_192


def _tail(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2))


def _both(x: float, rho: float) -> float:
    """Chance that two standard normal variables of correlation ``rho`` both exceed ``x``."""
    t = np.linspace(0, 10, 4001)
    inner = np.array([_tail((x - rho * (x + s)) / math.sqrt(1 - rho * rho)) for s in t])
    return float(np.trapezoid(inner * np.exp(-((x + t) ** 2) / 2) / math.sqrt(2 * math.pi), t))


@dataclass(frozen=True)
class Caps:
    """Two codebooks of ``words`` unit vectors for the halves of ``dims`` dimensions, and the threshold."""

    dims: int
    words: int
    threshold: float
    groups: int = 1
    fewest: int = 8
    seed: int = 17

    def books(self) -> tuple[np.ndarray, np.ndarray]:
        rnd = np.random.default_rng(self.seed)
        half = (self.dims + 1) // 2
        out = []
        for d in (half, max(1, self.dims - half)):
            c = rnd.standard_normal((self.words, d))
            out.append(c / np.linalg.norm(c, axis=1, keepdims=True) / math.sqrt(2))
        return out[0], out[1]

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """The filters that each unit vector passes, ascending. For one that passes fewer than ``fewest`` the threshold falls in
        steps until it has as many (or all there are): where directions are sparse, neighbours then still share some."""
        a, b = self.books()
        half = (self.dims + 1) // 2
        first = x[:, :half] @ a.T
        second = x[:, half:] @ b.T if self.dims > half else np.zeros((len(x), self.words))
        order = np.argsort(-second, axis=1, kind="stable")
        ranked = np.take_along_axis(second, order, 1)
        out = []
        for i in range(len(x)):
            # for each word of the first book, the words of the second that lift the sum over the threshold lead its sorted list
            threshold, want = self.threshold, min(self.fewest, self.words * self.words)
            lead = np.searchsorted(-ranked[i], first[i] - threshold, side="right")
            while lead.sum() < want:
                threshold -= 0.02
                lead = np.searchsorted(-ranked[i], first[i] - threshold, side="right")
            rows = np.repeat(np.arange(self.words), lead)
            at = np.arange(len(rows)) - np.repeat(np.cumsum(lead) - lead, lead)
            out.append(np.sort(rows * self.words + order[i][at]))
        return out


def plan_caps(n: int, dims: int, least: float = 0.9, shared: float = 16.0, per_filter: int = 8) -> Caps:
    """About ``n / per_filter`` filters, and the threshold at which a pair at similarity ``least`` is expected to share ``shared``
    of them (a miss is then about as likely as exp(-shared))."""
    words = max(8, math.ceil(math.sqrt(max(1, n) / per_filter)))
    count = words * words
    low, high = 0.0, 6.0
    for _ in range(40):
        mid = (low + high) / 2
        low, high = (mid, high) if count * _both(mid, least) > shared else (low, mid)
    firsts = 0.3 * count * _tail(low)  # a vector's filters have about so many first words
    return Caps(dims, words, low / math.sqrt(dims), math.ceil(n * firsts / words / (HOT / 2)) or 1)


def similar(vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", shared: float = 16.0) -> DataFrame:
    """One row for each row of ``vectors``: its id, ``n_links`` (other rows linked with it) and ``component_id`` (the least id
    that links reach). Rows link if a shared filter brings them together and their cosine, in double precision, is ``least`` or more.

    Equal vectors are one class with a count, linked among themselves and not compared. Vectors that are null, empty, zero or
    hold a null or a value that is not finite link with nothing, and vectors of different lengths don't link. Repeated rows
    count as rows; a null id never names a component that has another. An empty table gives an empty one; other columns play no part.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    good = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0)).alias("v"))
    classes = staged(rows.where(F.coalesce(good, F.lit(False))).groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("n")).select(F.monotonically_increasing_id().alias("class"), "v", "least", "n"), "classes")
    sizes = classes.groupBy(F.size("v").alias("dims")).count().collect()  # a row for each length of vector
    shards = None
    for dims, n in sorted((r["dims"], r["count"]) for r in sizes):
        part = _shards(classes.where(F.size("v") == dims), plan_caps(n, dims, least, shared), least)
        shards = part if shards is None else shards.union(part)
    if shards is None:
        links = spark.createDataFrame([], "class long, links long, root long")
    else:
        links = staged(shards, "links")
    counted = links.groupBy("class").agg(F.sum("links").alias("links"))
    roots = connected_components(links.where("root != class").select(F.col("class").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "class")
    known = classes.join(counted, "class", "left").join(roots, "class", "left").select("v", "least", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "class").alias("root"))
    known = staged(known, "known")
    named = known.groupBy("root").agg(F.min("least").alias("component_id"))
    final = known.join(named, "root").select(F.col("v").alias("known_v"), "n_links", "component_id")
    joined = rows.join(final, F.col("v") == F.col("known_v"), "left")
    return joined.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def _shards(classes: DataFrame, caps: Caps, least: float) -> DataFrame:
    """``class``, ``links`` (rows in other classes it is first found linked with) and ``root``, for each class and shard.

    A shard is the filters that begin with one word of the first codebook and end with one of a group of the second's words,
    the fewer the more vectors there are. A linked pair counts in the first filter the
    two share and nowhere else, so that counts add up. Hot shards are cut into blocks; each pair of blocks is a task.
    """
    dims, words, groups = caps.dims, caps.words, caps.groups

    def shard_of(p: np.ndarray) -> np.ndarray:
        return p // words * groups + p % words % groups

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if not len(part):
                continue
            x = np.array(part["v"].tolist(), float)
            x /= np.abs(x).max(1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            passed = caps.decode(x)
            shards = [np.unique(shard_of(p)) for p in passed]
            at = np.repeat(np.arange(len(part)), [len(s) for s in shards])
            yield pd.DataFrame({"shard": np.concatenate(shards), "class": part["class"].to_numpy()[at], "n": part["n"].to_numpy()[at], "x": [x[i].tobytes() for i in at], "filters": [passed[i].astype(np.int32).tobytes() for i in at]})

    decoded = staged(classes.select("class", "v", "n").mapInPandas(decode, "shard int, class long, n long, x binary, filters binary"), "caps")
    sizes = decoded.groupBy("shard").count().where(F.col("count") > HOT).select("shard", F.ceil(F.col("count") / HOT).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    # each member meets every block: as the first of the pair from its own block on, as the second before it
    dealt = decoded.join(F.broadcast(sizes), "shard", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", block)  # at most a row for each word
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("class")
        shard, low, high = int(part["shard"].iloc[0]), int(part["low"].iloc[0]), int(part["high"].iloc[0])
        ids, n, of = part["class"].to_numpy(), part["n"].to_numpy(np.int64), part["block"].to_numpy()
        x = np.frombuffer(b"".join(part["x"]), float).reshape(len(part), dims)
        passed = [np.frombuffer(f, np.int32) for f in part["filters"]]
        forest, links = Forest(len(part)), np.zeros(len(part), np.int64)
        here = [p[shard_of(p) == shard] for p in passed]
        rows, cols = np.repeat(np.arange(len(part)), [len(h) for h in here]), np.concatenate(here)
        order = np.argsort(cols, kind="stable")
        rows, cols = rows[order], cols[order]
        # one bit for each filter that two members pass tells whether a pair has met before; no more than the members' own
        every, counts = np.unique(np.concatenate(passed), return_counts=True)
        known = every[counts > 1]
        bits = np.zeros((len(part), len(known) // 8 + 1), np.uint8)
        for i, p in enumerate(passed):
            at = np.searchsorted(known, p)
            at = at[(at < len(known)) & (known[np.minimum(at, len(known) - 1)] == p)] if len(known) else at[:0]
            np.bitwise_or.at(bits[i], at >> 3, (1 << (at & 7)).astype(np.uint8))
        for c in np.unique(cols):
            own = rows[np.searchsorted(cols, c) : np.searchsorted(cols, c, "right")]
            left, right = own[of[own] == low], own[of[own] == high]
            before = int(np.searchsorted(known, int(c)))
            mask = np.zeros(bits.shape[1], np.uint8)
            mask[: before >> 3] = 255
            if before & 7:
                mask[before >> 3] = (1 << (before & 7)) - 1
            for k in range(0, len(left), _BLOCK):
                some = left[k : k + _BLOCK]
                i, j = np.nonzero(x[some] @ x[right].T >= least - 1e-9)
                i, j = some[i], right[j]
                keep = i < j if low == high else i != j
                i, j = i[keep], j[keep]
                for m in range(0, len(i), 4096):
                    a, b = i[m : m + 4096], j[m : m + 4096]
                    sure = np.einsum("ij,ij->i", x[a], x[b]) >= least
                    new = sure & ~((bits[a] & bits[b] & mask).any(1))
                    np.add.at(links, a[new], n[b[new]])
                    np.add.at(links, b[new], n[a[new]])
                    forest.link(a[new], b[new])
        keep = (links > 0) | (forest.root != np.arange(len(part)))
        return pd.DataFrame({"class": ids[keep], "links": links[keep], "root": ids[forest.root[keep]]})

    return dealt.groupBy("shard", "low", "high").applyInPandas(compare, "class long, links long, root long")
