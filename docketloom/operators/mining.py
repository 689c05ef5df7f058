"""Analytics over cases and their entries: types, outcomes, durations, trends, distributions.

The rules are keyword rules; keywords, visa offices and the date "today" are parameters.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The words of the rules.
MANDAMUS = "mandamus|compel|delay"
OUTCOMES = {"Discontinued": "notice of discontinuance", "Granted": "granted|allowed", "Dismissed": "dismissed"}
RULE_9 = "rule 9"
LEAVE = "leave granted"
JUDGE = r"(?i)before (?:the honourable )?(?:mr\.|madam|mme)?\s*justice ([A-Z][\w'-]+)"
#: What packing dates into longs takes: the date of undated entries, an offset that makes days positive, the most offices.
_NO_DATE, _SHIFT, _OFFICES = "9999-12-31", 1_000_000, 63
VISA_OFFICES = ["Beijing", "Ankara", "New Delhi", "Lagos"]


def _says(text: str | Column, words: str) -> Column:
    """Whether a text matches a pattern in any case; mere alternatives of ASCII words are looked for without one, which is faster."""
    t = F.col(text) if isinstance(text, str) else text
    if re.fullmatch(r"[A-Za-z0-9 ]+(\|[A-Za-z0-9 ]+)*", words):
        low = F.lower(t)
        return F.coalesce(reduce(lambda a, b: a | b, [F.contains(low, F.lit(w.lower())) for w in words.split("|")]), F.lit(False))
    return F.coalesce(t.rlike(f"(?i){words}"), F.lit(False))


def clean(cases: DataFrame, drop: bool = True) -> DataFrame:
    """Cases with a filing date; or all, with the flag ``no_filing_date``."""
    return cases.where("filing_date is not null") if drop else cases.withColumn("no_filing_date", F.col("filing_date").isNull())


def facts(cases: DataFrame, entries: DataFrame, mandamus: str = MANDAMUS, outcomes: dict[str, str] = OUTCOMES, offices: list[str] = VISA_OFFICES) -> DataFrame:
    """One row for each case: its type, status and outcome date, visa office, judge, Rule 9 date and whether leave was granted.

    The status of highest rank wins, and the outcome is dated by the earliest entry with that status; an undated entry still
    gives the status. The visa office and the judge are those of the earliest entry that names one; undated entries come last.

    One hash aggregate over the entries, combined before the shuffle, gathers all marks but the judge's: rank and date, and
    date, ordinal and office, are packed into longs whose least value is wanted, so that no sort is needed. Entries that name
    a judge are few and are gathered by themselves."""
    if len(offices) > _OFFICES:
        raise ValueError(f"more than {_OFFICES} visa offices")
    rank, office = F.lit(None).cast("long"), F.lit(None).cast("long")
    for k, words in reversed(list(enumerate(outcomes.values(), 1))):
        rank = F.when(_says("summary", words), F.lit(k).cast("long")).otherwise(rank)
    names = sorted(offices)
    for k, name in reversed(list(enumerate(names))):
        office = F.when(F.contains(F.lower("summary"), F.lit(name.lower())) & _says("summary", rf"\b\Q{name}\E\b"), F.lit(k).cast("long")).otherwise(office)
    days = (F.datediff(F.coalesce("entry_date", F.to_date(F.lit(_NO_DATE))), F.to_date(F.lit("1970-01-01"))) + _SHIFT).cast("long")
    ordinal = F.greatest(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**31 - 1)), F.lit(0))
    marked = entries.select("case_id", "entry_date", (rank * 2**32 + days).alias("outcome"), ((days * 2**31 + ordinal) * (_OFFICES + 1) + office).alias("visa"), _says("summary", mandamus).alias("mandamus"), _says("summary", RULE_9).alias("rule9"), _says("summary", LEAVE).alias("leave"))
    per = marked.groupBy("case_id").agg(F.min("outcome").alias("outcome"), F.min("visa").alias("visa"), F.max("mandamus").alias("in_entries"), F.min(F.when(F.col("rule9"), F.col("entry_date"))).alias("rule9_date"), F.max("leave").alias("leave_granted"))
    named = entries.select("case_id", "entry_date", "doc_id", F.regexp_extract("summary", JUDGE, 1).alias("judge")).where("judge != ''")
    ruled = named.groupBy("case_id").agg(F.min(F.struct(F.coalesce("entry_date", F.to_date(F.lit(_NO_DATE))).alias("at"), "doc_id", "judge")).alias("ruling"))
    status = F.lit("Ongoing")
    for k, name in enumerate(outcomes, 1):
        status = F.when(F.floor(F.col("outcome") / 2**32) == k, name).otherwise(status)
    at = F.date_add(F.to_date(F.lit("1970-01-01")), (F.col("outcome") % 2**32 - _SHIFT).cast("int"))
    visa = F.get(F.array(*map(F.lit, names)), (F.col("visa") % (_OFFICES + 1)).cast("int")) if names else F.lit(None).cast("string")
    joined = cases.select("case_id", "style_of_cause", "filing_date", F.col("office").alias("court_office")).join(per, "case_id", "left").join(ruled, "case_id", "left")
    return joined.select(
        "case_id", "style_of_cause", "filing_date", "court_office", visa.alias("visa_office"),
        F.when(_says("style_of_cause", mandamus) | F.coalesce("in_entries", F.lit(False)), "Mandamus").otherwise("Other").alias("case_type"),
        status.alias("status"), F.nullif(at, F.to_date(F.lit(_NO_DATE))).alias("outcome_date"), F.col("ruling.judge").alias("judge"), "rule9_date", F.coalesce("leave_granted", F.lit(False)).alias("leave_granted"),
    )


def details(f: DataFrame, as_of: str) -> DataFrame:
    """The report of all cases. The duration is filing to outcome for closed cases and filing to ``as_of`` for others, in days."""
    days = F.when(F.col("status") == "Ongoing", F.datediff(F.to_date(F.lit(as_of)), "filing_date")).otherwise(F.datediff("outcome_date", "filing_date"))
    return f.select("case_id", F.col("style_of_cause").alias("title"), "filing_date", "court_office", "visa_office", F.col("case_type").alias("type"), "status", "outcome_date", days.cast("long").alias("duration_days"), "judge")


def durations(f: DataFrame, as_of: str) -> DataFrame:
    """(case_id, case_type, court_office, visa_office, metric, days) for time_to_close, age and rule9_wait. Dates out of order
    give negative days, which stay in."""
    metrics = {"time_to_close": F.when(F.col("status") != "Ongoing", F.datediff("outcome_date", "filing_date")), "age": F.when(F.col("status") == "Ongoing", F.datediff(F.to_date(F.lit(as_of)), "filing_date")), "rule9_wait": F.datediff("rule9_date", "filing_date")}
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("long").alias("days")) for k, v in metrics.items()]))
    return f.select("case_id", "case_type", "court_office", "visa_office", pairs.alias("m")).select("case_id", "case_type", "court_office", "visa_office", "m.*").where("days is not null")


def duration_stats(d: DataFrame, *by: str) -> DataFrame:
    """Number, mean, median, greatest and least days of each metric, by the columns given."""
    return d.groupBy("metric", *by).agg(F.count("*").alias("n"), F.round(F.avg("days"), 4).alias("mean_days"), F.round(F.median("days"), 4).alias("median_days"), F.max("days").alias("max_days"), F.min("days").alias("min_days"))


def quartiles(d: DataFrame, by: str = "case_type", metric: str = "time_to_close") -> DataFrame:
    """Box-plot numbers: quartiles, and how many lie more than one and a half interquartile ranges outside."""
    mine = d.where(F.col("metric") == metric)
    q = mine.groupBy(by).agg(F.percentile("days", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.count("*").alias("n"))
    q = q.select(by, "n", *[F.get("q", F.lit(i)).alias(k) for i, k in enumerate(("q1", "q2", "q3"))]).withColumn("reach", 1.5 * (F.col("q3") - F.col("q1")))
    out = mine.join(F.broadcast(q) if by == "case_type" else q, by)  # two types
    low, high = F.col("q1") - F.col("reach"), F.col("q3") + F.col("reach")
    return out.groupBy(by, "n", "q1", "q2", "q3").agg(F.count_if((F.col("days") < low) | (F.col("days") > high)).alias("outliers"))


def outliers(d: DataFrame, by: str = "case_type", metric: str = "time_to_close") -> DataFrame:
    """The cases beyond the whiskers."""
    mine = d.where(F.col("metric") == metric)
    q = mine.groupBy(F.col(by).alias("__by")).agg(F.percentile("days", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    q = q.select("__by", (F.get("q", F.lit(0)) - 1.5 * (F.get("q", F.lit(1)) - F.get("q", F.lit(0)))).alias("low"), (F.get("q", F.lit(1)) + 1.5 * (F.get("q", F.lit(1)) - F.get("q", F.lit(0)))).alias("high"))
    return mine.join(q, mine[by].eqNullSafe(F.col("__by"))).where("days < low or days > high").select("case_id", by, "days")


def monthly_trend(f: DataFrame) -> DataFrame:
    return f.where("filing_date is not null").groupBy(F.date_format("filing_date", "yyyy-MM").alias("month"), "case_type").agg(F.count("*").alias("n"))


def monthly_volume(f: DataFrame) -> DataFrame:
    """Filings of a month, with a column for each type and for open and closed."""
    of = lambda c: F.count_if(c)
    return f.where("filing_date is not null").groupBy(F.date_format("filing_date", "yyyy-MM").alias("month")).agg(of(F.col("case_type") == "Mandamus").alias("mandamus"), of(F.col("case_type") == "Other").alias("other"), of(F.col("status") == "Ongoing").alias("ongoing"), of(F.col("status") != "Ongoing").alias("closed"))


def monthly_flow(f: DataFrame) -> DataFrame:
    """Cases filed and cases closed in each month, from one pass over both dates."""
    both = F.explode(F.array(F.struct(F.col("filing_date").alias("d"), F.lit(1).alias("filed"), F.lit(0).alias("closed")), F.struct(F.col("outcome_date").alias("d"), F.lit(0).alias("filed"), F.lit(1).alias("closed"))))
    return f.select(both.alias("x")).where("x.d is not null").groupBy(F.date_format("x.d", "yyyy-MM").alias("month")).agg(F.sum("x.filed").alias("filed"), F.sum("x.closed").alias("closed"))


def distribution(f: DataFrame, by: str) -> DataFrame:
    """Cases by a column, null included."""
    return f.groupBy(by).agg(F.count("*").alias("n"))


def outcome_distribution(f: DataFrame) -> DataFrame:
    counts = f.groupBy("status").agg(F.count("*").alias("n"))
    return counts.select("status", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("share"))  # a row for each status


def implicit_success(f: DataFrame) -> DataFrame:
    """The share of discontinued cases among those of type Mandamus; null if there are none."""
    m = f.where("case_type = 'Mandamus'")
    return m.agg(F.count("*").alias("mandamus_cases"), F.count_if(F.col("status") == "Discontinued").alias("discontinued"), F.round(F.avg((F.col("status") == "Discontinued").cast("double")), 6).alias("rate"))


def leave_rate(f: DataFrame) -> DataFrame:
    """The share of cases that reach the merits."""
    return f.agg(F.count("*").alias("cases"), F.count_if("leave_granted").alias("granted"), F.round(F.avg(F.col("leave_granted").cast("double")), 6).alias("rate"))


def office_heatmap(f: DataFrame, by: str = "court_office") -> DataFrame:
    """Mean days to close and number of closed cases by office."""
    closed = f.where("status != 'Ongoing' and outcome_date is not null")
    return closed.groupBy(by).agg(F.round(F.avg(F.datediff("outcome_date", "filing_date")), 4).alias("mean_close_days"), F.count("*").alias("closed_cases"))


def summary(f: DataFrame, as_of: str) -> DataFrame:
    """One row: cases in all, open, closed; mean days to close of each type; mean age of the open ones."""
    close, open_ = F.datediff("outcome_date", "filing_date"), F.col("status") == "Ongoing"
    return f.agg(
        F.count("*").alias("total"), F.count_if(open_).alias("ongoing"), F.count_if(~open_).alias("closed"),
        F.round(F.avg(F.when(~open_ & (F.col("case_type") == "Mandamus"), close)), 4).alias("mandamus_close_days"), F.round(F.avg(F.when(~open_ & (F.col("case_type") == "Other"), close)), 4).alias("other_close_days"),
        F.round(F.avg(F.when(open_, F.datediff(F.to_date(F.lit(as_of)), "filing_date"))), 4).alias("mean_age_days"),
    )


def mean_age_by(f: DataFrame, as_of: str, by: str = "visa_office") -> DataFrame:
    return f.where("status = 'Ongoing'").groupBy(by).agg(F.count("*").alias("n"), F.round(F.avg(F.datediff(F.to_date(F.lit(as_of)), "filing_date")), 4).alias("mean_age_days"))


def still_to_enrich(cases: DataFrame, enriched: DataFrame) -> DataFrame:
    """Cases without enrichment yet, so that an interrupted run goes on where it stopped."""
    return cases.join(enriched.select("case_id"), "case_id", "left_anti")
