"""Look-ups over the cases: existence, years, resume points, recent cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids


def case_count(cases: DataFrame) -> DataFrame:
    return cases.agg(F.count("*").alias("total_cases"))


def year_stats(cases: DataFrame, year: int) -> DataFrame:
    """Count and last scraping time of the cases of a year, by the last two digits of the number; 0 and null if there are none."""
    return cases.where(ids.like_year("case_id", year)).agg(F.lit(year).alias("year"), F.count("*").alias("total_cases"), F.max("scraped_at").alias("last_scraped"))


def stats_by_year(cases: DataFrame) -> DataFrame:
    """The same for every year that the numbers name."""
    return cases.groupBy(ids.suffix_year("case_id").alias("year")).agg(F.count("*").alias("total_cases"), F.max("scraped_at").alias("last_scraped"))


def exists(candidates: DataFrame, cases: DataFrame) -> DataFrame:
    """The candidate ids with a flag that tells whether they are stored."""
    known = cases.select("case_id", F.lit(True).alias("known")).distinct()
    return candidates.select("case_id").join(known, "case_id", "left").select("case_id", F.coalesce("known", F.lit(False)).alias("is_stored"))


def last_case(cases: DataFrame, year: int, order: str = "numeric") -> DataFrame:
    """The last case of a year: by its sequence, or by its text (``order="lexical"``). No row if the year has none."""
    mine = cases.where(ids.like_year("case_id", year)).select("case_id", ids.sequence_of("case_id").alias("sequence"))
    by = [F.desc_nulls_last("sequence"), F.desc("case_id")] if order == "numeric" else [F.desc("case_id")]
    return mine.orderBy(*by).limit(1)


def cases_of_year(cases: DataFrame, year: int, by: str = "digits") -> DataFrame:
    """Cases of a year in the order of their numbers: by two digits, or exactly by the number's suffix (``by="suffix"``)."""
    cond: Column = ids.like_year("case_id", year) if by == "digits" else ids.suffix_year("case_id") == year
    return cases.where(cond).orderBy("case_id")


def recent_cases(cases: DataFrame, limit: int = 10, year: int | None = None) -> DataFrame:
    """The last scraped cases, unknown times last, ties by number."""
    mine = cases if year is None else cases.where(ids.like_year("case_id", year))
    return mine.orderBy(F.desc_nulls_last("scraped_at"), "case_id").limit(limit).select("case_id", "case_type", "office", "filing_date", "scraped_at")


def past_newest(df: DataFrame, keep: int, time_col: str, tie_col: str) -> DataFrame:
    """All rows but the ``keep`` newest; times that are null are the oldest. Only the newest are sorted out in one task, the
    rest stays where it is. Rows equal in both columns go together."""
    newest = df.select(F.col(time_col).alias("__time"), F.col(tie_col).alias("__tie")).orderBy(F.desc_nulls_last("__time"), "__tie").limit(keep)
    return df.join(F.broadcast(newest), F.col(time_col).eqNullSafe(F.col("__time")) & F.col(tie_col).eqNullSafe(F.col("__tie")), "left_anti")
