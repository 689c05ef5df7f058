"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Groups of equal texts are the items. Each goes where the dot product of its (bytes, tokens, rows) with the shards'
residual capacities is highest, larger items first. Items are packed twice: within buckets of the groups' hashes, in
parallel, into a few bundles for each shard, and then the bundles, whose number is bounded, into the shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, free_name, small, staged
from .mixing import word_count

#: A group beyond this part of a shard, in bytes, tokens or rows, is split; one beyond the second part is packed by itself.
SPLIT, HEAVY = 1 / 4, 1 / 64
MOST_BUCKETS, BUCKET_GROUPS = 4096, 1024
_LOADS = ("bytes", "tokens", "rows")


def pack(loads: np.ndarray, bins: int, weights: tuple[float, ...] = (256.0, 1.0, 1.0)) -> np.ndarray:
    """The bin of each item, largest first, by the highest dot product with the residual capacities (an equal share each)."""
    unit = loads.sum(0) / bins
    x = loads / np.where(unit > 0, unit, 1)
    left, w, out = np.ones((bins, x.shape[1])), np.array(weights), np.zeros(len(x), np.int64)
    for i in np.argsort(-(x * w).sum(1), kind="stable"):
        k = int(np.argmax(left @ (w * x[i])))
        out[i] = k
        left[k] -= x[i]
    return out


def shard(docs: DataFrame, shards: int = 24, text_col: str = "text", id_col: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (the columns ``keep``, all by default) with ``size`` (UTF-8 bytes of the text plus 8), ``shard`` (0 to ``shards`` - 1) and ``slot`` (0, 1, ... in
    its shard); a taken name gets a suffix.

    Shards have nearly equal bytes, and tokens and rows as near as the same packing leaves them. Equal texts share a
    shard, unless they make up more than a quarter of one; such groups are cut into quarters or less by the id's hash.
    ``docs`` is read once; what is kept of it is written and moved, so that whole texts had better stay out of ``keep``.
    A null text has no bytes and no tokens; null texts are equal texts. Null and repeated ids and repeated rows are rows
    like any other. An empty table gives an empty one.
    """
    spark = bounded_batches(docs).sparkSession
    keep = docs.columns if keep is None else keep
    new = [free_name(keep, c) for c in ("size", "shard", "slot")]
    text = F.col(text_col)
    sized = staged(
        docs.select(
            F.struct(*keep).alias("row"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("bytes"), word_count(text).alias("tokens"),
            F.xxhash64(F.coalesce(text, F.lit(""))).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"), F.xxhash64(F.lit("piece"), F.col(id_col)).alias("h"),
        ),
        "sized",
    )
    sums = [F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    groups = staged(sized.groupBy("a", "b").agg(*sums), "groups")
    total = groups.agg(F.count("*").alias("groups"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _LOADS]).first()

    def over(part: float) -> F.Column:
        return F.greatest(*[F.col(c) / max(1.0, total[c] * part / shards) for c in _LOADS])

    # a group over the part p of a shard in one of three loads: there are 3 * shards / p at most
    heavy = groups.where(over(HEAVY) > 1)
    pieces = [(r["a"], r["b"], int(np.ceil(r["pieces"]))) for r in heavy.where(over(SPLIT) > 1).select("a", "b", over(SPLIT).alias("pieces")).collect()]
    cut = F.broadcast(spark.createDataFrame(pieces, "a long, b long, pieces int"))
    piece = F.pmod("h", F.coalesce("pieces", F.lit(1))).cast("int").alias("piece")
    if pieces:
        parts = sized.select("a", "b", "h", "bytes", "tokens").join(cut, ["a", "b"]).withColumn("piece", piece).groupBy("a", "b", "piece").agg(*sums)
        alone = heavy.join(cut, ["a", "b"], "left_anti").select("a", "b", F.lit(0).alias("piece"), *_LOADS).union(parts.select("a", "b", "piece", *_LOADS))
    else:
        alone = heavy.select("a", "b", F.lit(0).alias("piece"), *_LOADS)
    alone = sorted(alone.collect())
    buckets = int(min(MOST_BUCKETS, max(1, total["groups"] // BUCKET_GROUPS)))

    per_bucket = shards * max(1, min(64, MOST_BUCKETS // 8 // buckets))

    def bundle(part: pd.DataFrame) -> pd.DataFrame:
        # the smallest groups, a sixteenth of the bytes, make bundles of their own: small items that even out the rest
        part = part.sort_values(["bytes", "a", "b"], ascending=[False, True, True])
        large = (part["bytes"].cumsum() <= part["bytes"].sum() * (15 / 16)).to_numpy()
        loads, of = part[list(_LOADS)].to_numpy(float), np.zeros(len(part), np.int64)
        of[large] = pack(loads[large], per_bucket)
        of[~large] = per_bucket + pack(loads[~large], per_bucket)
        return part.assign(bundle=of)

    light = groups.where(over(HEAVY) <= 1).withColumn("bucket", F.pmod(F.xxhash64("a", "b"), F.lit(buckets)).cast("int"))
    bundled = staged(light.groupBy("bucket").applyInPandas(bundle, "a long, b long, bytes long, tokens long, rows long, bucket int, bundle int"), "bundles")
    bundles = sorted(bundled.groupBy("bucket", "bundle").agg(*[F.sum(c).alias(c) for c in _LOADS]).collect())  # 2 * MOST_BUCKETS * shards at most
    items = np.array([r[3:] for r in alone] + [r[2:] for r in bundles], float).reshape(-1, 3)
    of = pack(items, shards).tolist()
    place = F.broadcast(spark.createDataFrame([(r[0], r[1], k) for r, k in zip(bundles, of[len(alone) :], strict=True)], "bucket int, bundle int, shard int"))
    # heavy groups and their pieces, a few thousand whatever the input, find their shards by broadcast; no key of the shuffle is heavy
    fixed = F.broadcast(spark.createDataFrame([(*r[:3], k) for r, k in zip(alone, of, strict=False)], "a long, b long, piece int, shard int"))
    where = bundled.join(place, ["bucket", "bundle"]).select("a", "b", "shard")
    by_broadcast = sized.join(cut, ["a", "b"], "left").withColumn("piece", piece).join(fixed, ["a", "b", "piece"]).select("row", "bytes", "shard")
    by_shuffle = sized.join(fixed.select("a", "b").distinct(), ["a", "b"], "left_anti").join(where, ["a", "b"]).select("row", "bytes", "shard")
    return numbered(by_broadcast.union(by_shuffle), "shard", "slot").select("row.*", F.col("bytes").alias(new[0]), F.col("shard").alias(new[1]), F.col("slot").alias(new[2]))


def numbered(df: DataFrame, key: str, out_col: str) -> DataFrame:
    """``df`` with a gapless number from 0 within each value of ``key``, an int of few values. Tasks count as rows stream
    through; what earlier tasks have counted (a row for each task and value, summed up on the executors) is added on reading."""
    schema = T.StructType([*df.schema.fields, T.StructField("__task", T.IntegerType()), T.StructField("__rank", T.LongType())])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, seen = TaskContext.get().partitionId(), pd.Series(dtype="int64")
        for part in batches:
            rank = part.groupby(key).cumcount() + part[key].map(seen).fillna(0)
            seen = seen.add(part[key].value_counts(), fill_value=0).astype("int64")
            yield part.assign(__task=task, __rank=rank.astype("int64"))

    kept = staged(df.mapInPandas(count, schema), "numbered")
    counts = kept.groupBy("__task", key).count()
    before = F.sum("count").over(Window.partitionBy(key).orderBy("__task")) - F.col("count")
    offsets = small(staged(counts.select(F.col("__task").alias("__t"), F.col(key).alias("__k"), before.alias("__before")), "offsets"))
    joined = kept.join(offsets, (F.col("__task") == F.col("__t")) & (F.col(key) == F.col("__k")))
    return joined.select(*df.columns, (F.col("__rank") + F.col("__before")).alias(out_col))
