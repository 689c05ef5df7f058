"""Accounts of collection runs: totals, success rates, failure streaks, retries.

Input: ``run_id, seq, case_number, outcome``, the outcome being success, failed or skipped, or a word for "no record".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _by_run(*, until_now: bool = False):
    w = Window.partitionBy("run_id").orderBy("seq")
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow) if until_now else w


def run_totals(events: DataFrame) -> DataFrame:
    """For each run: first and last number, and how many in all, succeeded, were skipped, had no record, failed."""
    of = lambda k: F.count_if(F.col("outcome") == k)
    return events.groupBy("run_id").agg(
        F.min_by("case_number", "seq").alias("first_case"), F.max_by("case_number", "seq").alias("last_case"), F.count("*").alias("total"),
        of("success").alias("success"), of("skipped").alias("skipped"), of("no_record").alias("no_record"), of("failed").alias("failed"),
    )


def batch_audit(events: DataFrame, export_path: str | None = None) -> DataFrame:
    """For each run its totals, how many different numbers were skipped, the first of them, and where the export went."""
    skipped = F.when(F.col("outcome") == "skipped", F.col("case_number"))
    return events.groupBy("run_id").agg(
        F.count_if(F.col("outcome") == "success").alias("scraped_count"), F.count(skipped).alias("skipped_count"), F.count_distinct(skipped).alias("skipped_numbers"), F.min(skipped).alias("first_skipped"),
        F.lit(export_path).cast("string").alias("export_path"),
    )


def skipped_numbers(events: DataFrame) -> DataFrame:
    """The list that goes with a batch's audit: every number that a run skipped, a row each."""
    return events.where("outcome = 'skipped'").select("run_id", "case_number").distinct()


def success_rate(events: DataFrame, every: int = 10) -> DataFrame:
    """The share of successes so far, in percent to one decimal, at every ``every``-th processed case; skipped cases aren't processed."""
    done = events.where("outcome != 'skipped'")
    w = _by_run(until_now=True)
    rows = done.select("run_id", "seq", F.count("*").over(w).alias("processed"), F.sum((F.col("outcome") == "success").cast("int")).over(w).alias("successes"))
    return rows.where(F.col("processed") % every == 0).withColumn("rate", F.round(F.col("successes") * 100 / F.col("processed"), 1))


def failure_streaks(events: DataFrame) -> DataFrame:
    """Each processed case with the length of the streak of failures that ends there: 0 at a success; skipped cases are neutral."""
    done = events.where("outcome != 'skipped'").withColumn("ok", (F.col("outcome") == "success").cast("int"))
    grouped = done.withColumn("grp", F.sum("ok").over(_by_run(until_now=True)))
    row = F.row_number().over(Window.partitionBy("run_id", "grp").orderBy("seq"))
    return grouped.withColumn("streak", row - F.when(F.col("grp") > 0, 1).otherwise(0)).select("run_id", "seq", "case_number", "outcome", "streak")


def emergency_stops(events: DataFrame, threshold: int = 10) -> DataFrame:
    """For each run the longest streak, where it stops for good (null if it doesn't), and how many cases are processed by then."""
    streaks = failure_streaks(events)
    stop = streaks.groupBy("run_id").agg(F.max("streak").alias("longest"), F.min(F.when((F.col("outcome") != "success") & (F.col("streak") >= threshold), F.col("seq"))).alias("stop_seq"))
    done = streaks.join(stop, "run_id").where("stop_seq is null or seq <= stop_seq").groupBy("run_id").agg(F.count("*").alias("processed"))
    return stop.join(done, "run_id")


def exhausted(events: DataFrame, threshold: int = 100) -> DataFrame:
    """For each run, whether its longest streak says that the year has no more cases."""
    return failure_streaks(events).groupBy("run_id").agg((F.max("streak") >= threshold).alias("exhausted"))


def capped(events: DataFrame, most: int) -> DataFrame:
    """The cases that a run gets to before it has ``most`` successes, the last success included."""
    before = F.coalesce(F.sum((F.col("outcome") == "success").cast("int")).over(Window.partitionBy("run_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return events.withColumn("__before", before).where(F.col("__before") < most).drop("__before")


def retry_candidates(events: DataFrame, done: tuple[str, ...] = ("success", "no_record", "skipped")) -> DataFrame:
    """Numbers whose last outcome is none of ``done``, with that outcome."""
    last = events.groupBy("case_number").agg(F.max_by("outcome", F.struct("seq")).alias("outcome"), F.max("seq").alias("seq"))
    return last.where(~F.col("outcome").isin(*done))


def run_log(events: DataFrame) -> DataFrame:
    """The log of a run as lines of JSON, nulls kept: a start record, one for each case, a finish record with the totals."""
    one = lambda kind, seq, *fields: (F.lit(seq).cast("long").alias("seq"), F.to_json(F.struct(F.lit(kind).alias("event"), *fields), {"ignoreNullFields": "false"}).alias("value"))
    start = events.groupBy("run_id").agg(F.count("*").alias("n")).select("run_id", *one("start", -1, F.col("run_id").cast("string").alias("run_id")))
    lines = events.select("run_id", "seq", F.to_json(F.struct("case_number", "outcome"), {"ignoreNullFields": "false"}).alias("value"))
    totals = run_totals(events)
    finish = totals.select("run_id", *one("finish", 2**62, *[F.col(c) for c in ("total", "success", "skipped", "failed")]))
    return start.unionByName(lines).unionByName(finish)
