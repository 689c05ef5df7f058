"""Checks: export rules, the field rules of the specification, the JSON contract, page addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _filled(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))


def check_export(cases: DataFrame, strict: bool = False) -> DataFrame:
    """Cases with ``valid`` (there is an id) and ``warning`` (the id has not the usual form). ``strict`` fails on invalid ones."""
    usual = F.coalesce(F.col("case_id").startswith("IMM-") & (F.size(F.split("case_id", "-")) == 3), F.lit(False))
    valid = F.when(_filled("case_id"), F.lit(True)).otherwise(F.raise_error(F.lit("case without an id")).cast("boolean") if strict else F.lit(False))
    return cases.withColumn("valid", valid).withColumn("warning", F.when(_filled("case_id") & ~usual, F.concat(F.lit("unusual case number: "), F.col("case_id"))))


def _list(*rules: tuple[Column, str]) -> Column:
    """The names of the rules that fail; a rule that can't be decided fails."""
    return F.filter(F.array(*[F.when(F.coalesce(ok, F.lit(False)), F.lit(None).cast("string")).otherwise(F.lit(name)) for ok, name in rules]), lambda x: x.isNotNull())


def case_violations(cases: DataFrame, first: str = "2020-01-01", last: str = "2025-12-31") -> DataFrame:
    """What the specification finds wrong with a case's number and filing date."""
    return cases.select("case_id", _list((F.contains(F.col("case_id"), F.lit("IMM-")), "case_id"), (F.col("filing_date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))), "filing_date")).alias("violations"))


def entry_violations(entries: DataFrame, cases: DataFrame) -> DataFrame:
    """What it finds wrong with entries: no such case, an ordinal below one, no summary, a repeated (case, ordinal)."""
    known = cases.select("case_id", F.lit(True).alias("known")).distinct()
    joined = entries.withColumn("__same", F.count("*").over(Window.partitionBy("case_id", "doc_id"))).join(known, "case_id", "left")
    return joined.select("case_id", "doc_id", _list((F.col("known"), "case"), (F.col("doc_id") >= 1, "doc_id"), (_filled("summary"), "summary"), (F.col("__same") == 1, "unique")).alias("violations"))


def contract_violations(cases: DataFrame) -> DataFrame:
    """What the JSON contract finds wrong: fields that must be there, and the form of the number."""
    rules = [(_filled(c), c) for c in ("url", "case_id", "html_content", "scraped_at") if c in cases.columns]
    rules += [(F.lit(False), c) for c in ("url", "case_id", "html_content", "scraped_at") if c not in cases.columns]
    return cases.select("case_id", _list(*rules, (F.col("case_id").rlike("^IMM-.*"), "pattern")).alias("violations"))


#: Hosts and path of the case pages.
HOSTS = ["www.fct-cf.ca", "fct-cf.ca"]
PAGES = "/en/court-files-and-decisions"


def valid_url(url: Column | str, hosts: list[str] = HOSTS, path: str = PAGES) -> Column:
    """An http or https address of a case page, not of a login or an electronic filing; false for null."""
    u = F.col(url) if isinstance(url, str) else url
    part = lambda k: F.coalesce(F.try_parse_url(u, F.lit(k)), F.lit(""))
    return F.coalesce(F.lower(part("PROTOCOL")).isin("http", "https") & F.lower(part("HOST")).isin(*hosts) & F.contains(part("PATH"), F.lit(path)) & ~F.lower(part("PATH")).rlike("login|efiling"), F.lit(False))
