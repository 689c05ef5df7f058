"""Mixing sources to target weights by entropy balancing.

The rates of the documents minimise relative entropy to "each document once" under one token constraint for each
source and an upper bound. In the dual, a document of size x in source s has the rate min(bound, exp(lambda_s * x)):
an exponential tilt. Newton's method finds all multipliers together, each iteration being one aggregate over the
counts of (source, size); the rates are then rounded into whole copies so that each source keeps its tokens.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, free_name, small, staged

#: Sources are a catalogue; their totals are read by the driver, and more than this is an error. Tables of a row for each
#: source are broadcast up to the second number.
MOST_SOURCES, BROADCAST_SOURCES = 1_000_000, 100_000
#: The part of a target that a source may miss once Newton's method ends; more is an error.
_MISS = 1e-6


def word_count(text: Column) -> Column:
    """Words in a whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: dict[str | None, int], weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> dict[str | None, float]:
    """Tokens wanted of each source. In code-point order, null last, sources weigh ``weights``, repeating, and share all
    tokens; a target stops at ``most`` times its source's tokens, and the excess is shared again by weight."""
    order = sorted((s for s in totals if s is not None)) + [None] * (None in totals)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, open_, left = {}, list(order), float(sum(totals.values()))
    while open_:
        per = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if per * weight[s] > most * totals[s]]
        if not over:
            target |= {s: per * weight[s] for s in open_}
            break
        for s in over:
            target[s] = float(most * totals[s])
            left -= target[s]
        open_ = [s for s in open_ if s not in target]
    return target


class _Dual:
    """One source's multiplier, by Newton steps kept inside a bracket."""

    def __init__(self, target: float, total: float, most: float) -> None:
        self.target, self.low, self.high, self.at, self.gap = target, -math.inf, math.inf, 0.0, math.inf
        self.done = total == 0 or target <= 0 or target >= most * total * (1 - 1e-12)
        if self.done:
            self.at = math.inf if target > 0 else (-math.inf if total else 0.0)

    def step(self, tokens: float, slope: float) -> None:
        gap = self.gap = self.target - tokens
        if abs(gap) <= 1e-9 * self.target:
            self.done = True
            return
        if gap > 0:
            self.low = self.at
        else:
            self.high = self.at
        to = self.at + gap / slope if slope > 0 else math.inf
        if not self.low < to < self.high or not math.isfinite(to):
            low, high = self.low, self.high
            to = (low + high) / 2 if math.isfinite(low) and math.isfinite(high) else (max(1.0, 2 * low) if math.isfinite(low) else min(-1.0, 2 * high))
        self.done = to == self.at
        self.at = to


def _rate(size: Column, scale: Column, tilt: Column, most: float) -> Column:
    return F.when(tilt == math.inf, F.lit(most)).when(tilt == -math.inf, F.lit(0.0)).otherwise(F.exp(F.least(tilt * size / scale, F.lit(math.log(most)))))


def _multipliers(cells: DataFrame, stats: dict[str | None, dict], targets: dict[str | None, float], most: float, rounds: int) -> dict[str | None, float]:
    """Newton's method for all sources at once over ``cells(source, size, n)``."""
    spark = cells.sparkSession
    dual = {s: _Dual(targets[s], x["tokens"], most) for s, x in stats.items()}
    for _ in range(rounds):
        todo = [(s, stats[s]["scale"], d.at) for s, d in dual.items() if not d.done]
        if not todo:
            break
        at = _per_source(spark.createDataFrame(todo, "s string, scale double, tilt double"), len(todo))
        rate = _rate(F.col("size"), F.col("scale"), F.col("tilt"), most)
        found = cells.join(at, F.col("source").eqNullSafe(F.col("s"))).withColumn("r", rate).groupBy("s").agg(F.sum(F.col("n") * F.col("r") * F.col("size")).alias("tokens"), F.sum(F.when(F.col("r") < most, F.col("n") * F.col("r") * F.col("size") * F.col("size") / F.col("scale")).otherwise(0.0)).alias("slope"))
        for r in found.collect():
            dual[r["s"]].step(r["tokens"], r["slope"])
    far = [s for s, d in dual.items() if not d.done and abs(d.gap) > _MISS * d.target]
    if far:
        raise RuntimeError(f"{len(far)} sources miss their targets after {rounds} rounds, {far[0]!r} among them")
    return {s: d.at for s, d in dual.items()}


def _per_source(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_SOURCES else df


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = 3, source_col: str = "source", id_col: str = "doc_id", size_col: str = "size", group_rows: int = 256, rounds: int = 80) -> DataFrame:
    """``docs``, which must have the tokens of each document in the long column ``size_col``, with ``source_size``,
    ``target``, ``rate``, ``copies`` and ``taken`` (copies times size) added; a taken name gets a suffix.

    ``docs`` should be narrow, without the texts: it is written once and then read for each step. ``copies`` is 0 to
    ``most``. It depends on the rows alone, so reruns agree. A null source is a source of its own; documents without tokens
    have a rate of 1 and take nothing; null ids are allowed; repeated rows are documents of their own. An empty table gives
    an empty one. Rounding works in groups of about ``group_rows`` rows of a source, dealt by the hash of id and size, so
    that a source of any size is spread over many tasks; many rows that are equal in all three are dealt out by their
    places. From the largest document down, the tokens owed are carried on, so that small documents even out what large
    ones leave.
    """
    spark = docs.sparkSession
    docs = staged(docs, "mixed")
    new = [free_name(docs.columns, c) for c in ("source_size", "target", "rate", "copies", "taken")]
    cells = staged(docs.groupBy(F.col(source_col).alias("source"), F.col(size_col).alias("size")).agg(F.count("*").alias("n")), "sizes")
    rows = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("tokens"), F.sum("n").alias("rows"), F.sum(F.col("size").cast("double") * F.col("size") * F.col("n")).alias("squares")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    stats = {r["source"]: {"tokens": r["tokens"], "rows": r["rows"], "scale": r["squares"] / r["tokens"] if r["tokens"] else 1.0} for r in sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))}
    targets = source_targets({s: x["tokens"] for s, x in stats.items()}, weights, most)
    tilts = _multipliers(cells, stats, targets, float(most), rounds)
    plan = [(s, x["tokens"], targets[s], x["scale"], tilts[s], math.ceil(x["rows"] / group_rows)) for s, x in stats.items()]
    plan_df = _per_source(spark.createDataFrame(plan, "__s string, __total long, __target double, __scale double, __tilt double, __groups int"), len(plan))
    joined = docs.join(plan_df, docs[source_col].eqNullSafe(F.col("__s")))
    hashed = F.xxhash64(F.lit("copies"), docs[id_col], docs[size_col])
    ready = joined.select(
        *[docs[c] for c in docs.columns], F.col("__total").alias(new[0]), F.col("__target").alias(new[1]), _rate(docs[size_col], F.col("__scale"), F.col("__tilt"), float(most)).alias(new[2]),
        F.col("__s"), hashed.alias("__hash"), F.pmod(hashed, F.col("__groups")).alias("__group"),
    )
    full = ready.groupBy("__s", "__group").count().where(F.col("count") > 16 * group_rows)
    full = small(staged(full.select(F.col("__s").alias("__fs"), F.col("__group").alias("__fg"), F.ceil(F.col("count") / (4 * group_rows)).alias("__parts")), "full_groups"))
    part = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("__parts")), F.lit(0)).alias("__part")
    ready = ready.join(full, F.col("__s").eqNullSafe(F.col("__fs")) & (F.col("__group") == F.col("__fg")), "left").select(*ready.columns, part)
    out = T.StructType([*docs.schema.fields, T.StructField(new[0], T.LongType()), T.StructField(new[1], T.DoubleType()), T.StructField(new[2], T.DoubleType()), T.StructField(new[3], T.LongType()), T.StructField(new[4], T.LongType())])

    def round_group(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([size_col, "__hash"], ascending=[False, True], kind="stable")
        size, rate = part[size_col].to_numpy(float), part[new[2]].to_numpy(float)
        copies = np.floor(rate + 1e-12).astype(np.int64)
        more = np.maximum(rate - copies, 0.0)
        owed = 0.0
        for k in np.flatnonzero(more > 1e-12):
            owed += more[k] * size[k]
            if owed >= size[k] / 2:
                copies[k] += 1
                owed -= size[k]
        return part.assign(**{new[3]: copies, new[4]: copies * part[size_col].to_numpy(np.int64)})[out.names]

    return ready.groupBy("__s", "__group", "__part").applyInPandas(round_group, out)


def repeated(mixed: DataFrame, columns: list[str], copies: str = "copies") -> DataFrame:
    """Each row as often as ``copies`` says."""
    return mixed.where(F.col(copies) > 0).select(*columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(free_name(columns, "__copy"))).select(*columns)
