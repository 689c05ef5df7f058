"""Purging a year: what goes, what stays, and the account of it."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids

#: Names under which tables hold the number, the filing date and the scraping time.
NUMBER_NAMES = ["court_file_no", "case_number", "case_id"]
FILING_NAMES = ["filing_date", "case_date", "date"]
SCRAPED_NAMES = ["scraped_at", "crawled_at", "scrape_timestamp"]


def _pick(df: DataFrame, names: list[str]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def year_predicate(df: DataFrame, year: int, by: str = "any") -> Column:
    """Whether a row belongs to the year: by its filing year, or by the year in its number. The scraping year decides only
    where the table has no filing date and no year can be read from the number. ``by="id"`` looks at numbers alone."""
    number, filing, scraped = _pick(df, NUMBER_NAMES), _pick(df, FILING_NAMES), _pick(df, SCRAPED_NAMES)
    id_year = ids.suffix_year(number) if number else F.lit(None).cast("int")
    cond = id_year == year
    if by == "id":
        return F.coalesce(cond, F.lit(False))
    if filing:
        cond = (ids.year_of(filing) == year) | F.coalesce(cond, F.lit(False))
    elif scraped:
        cond = F.coalesce(cond, F.lit(False)) | (id_year.isNull() & (ids.year_of(scraped) == year))
    return F.coalesce(cond, F.lit(False))


def doomed(cases: DataFrame, year: int, by: str = "any") -> DataFrame:
    """The cases that a purge of the year removes; a dry run shows just these."""
    return cases.where(year_predicate(cases, year, by))


def kept_cases(cases: DataFrame, year: int, by: str = "any") -> DataFrame:
    return cases.where(~year_predicate(cases, year, by))


def split_entries(entries: DataFrame, cases: DataFrame, year: int, key: str = "case_id", by: str = "any") -> tuple[DataFrame, DataFrame]:
    """(kept, removed) entries: those of removed cases are removed."""
    gone = doomed(cases, year, by).select(key)
    return entries.join(gone, key, "left_anti"), entries.join(gone, key, "left_semi")


def audit(cases: DataFrame, entries: DataFrame, year: int, key: str = "case_id", files: DataFrame | None = None, dry_run: bool = False, sample: int = 10) -> DataFrame:
    """One row: counts of what goes, the first ids, and the first paths of each kind of file. Nothing to purge gives zeros.

    The sample comes from a bounded top-k, not from a list of all ids."""
    gone = doomed(cases, year)
    key_of_year = F.lit(year).alias("year")  # the parts have one row each and meet on it
    out = gone.agg(key_of_year, F.lit(dry_run).alias("dry_run"), F.count("*").alias("cases_deleted"))
    parts = [entries.select(key).join(gone.select(key), key, "left_semi").agg(key_of_year, F.count("*").alias("entries_deleted"))]
    parts.append(gone.select(key).orderBy(key).limit(sample).agg(key_of_year, F.array_sort(F.collect_list(key)).alias("first_case_ids")))
    for kind in ("output", "modal_html") if files is not None else ():
        mine = files.where(F.col("kind") == kind)
        parts.append(mine.agg(key_of_year, F.count("*").alias(f"{kind}_files")))
        parts.append(mine.orderBy("path").limit(sample).agg(key_of_year, F.array_sort(F.collect_list("path")).alias(f"first_{kind}")))
    for part in parts:
        out = out.join(part, "year")
    return out


def purge(cases: DataFrame, entries: DataFrame, year: int, files: DataFrame | None = None, *, dry_run: bool = True, files_only: bool = False, db_only: bool = False) -> dict[str, DataFrame]:
    """``cases`` and ``entries`` as they will be, and the ``audit``. A dry run, or ``files_only``, leaves the tables as they are."""
    if files_only and db_only:
        raise ValueError("files_only and db_only exclude each other")
    account = audit(cases, entries, year, files=None if db_only else files, dry_run=dry_run)
    if dry_run or files_only:
        return {"cases": cases, "entries": entries, "audit": account}
    return {"cases": kept_cases(cases, year), "entries": split_entries(entries, cases, year)[0], "audit": account}


def execute(spark: SparkSession, year: int, *, cases_path: str | None = None, entries_path: str | None = None, output_root: str, logs_root: str, audit_path: str, backup: str | None = None, dry_run: bool = True, files_only: bool = False, db_only: bool = False, strict: bool = False, force_files: bool = False) -> dict:
    """Carry a purge out: account, backup of the year's files (if ``backup`` names a folder), tables, files, audit record.

    The tables are Parquet folders, replaced as wholes, entries before cases, so that a run that stops in between can be
    repeated. If they can't be purged, files go all the same, as the audit says; with ``strict`` they stay unless
    ``force_files`` is set. A dry run changes nothing but writes its audit record too: one JSON object at ``audit_path``."""
    from ..sources import readers, sinks

    if files_only and db_only:
        raise ValueError("files_only and db_only exclude each other")
    files = readers.year_artifacts(spark, output_root, year), readers.year_html_logs(spark, logs_root, year)
    out: dict = {"year": year, "dry_run": dry_run, "backup": backup, "notes": [], "errors": []}
    if not db_only:
        for kind, found in zip(("output", "modal_html"), files, strict=True):
            out[f"{kind}_files"], out[f"first_{kind}"] = found.count(), [r["path"] for r in found.select("path").orderBy("path").limit(10).collect()]
    if backup and not dry_run and not db_only:
        out["backed_up"] = sinks.backup_year(spark, output_root, year, backup)
    failed = False
    if cases_path and entries_path and not files_only:
        try:
            cases, entries = spark.read.parquet(cases_path), spark.read.parquet(entries_path)
            out |= {k: v for k, v in audit(cases, entries, year, dry_run=dry_run).first().asDict().items() if k != "year"}
            if not dry_run:
                sinks.swap(split_entries(entries, cases, year)[0], entries_path)
                sinks.swap(kept_cases(cases, year), cases_path)
        except Exception as e:  # whatever the store says ends up in the audit record
            failed = True
            out["errors"].append(f"tables: {str(e).splitlines()[0]}")
    if force_files:
        out["notes"].append("file purge forced")
    if not dry_run and not db_only:
        if failed and strict and not force_files:
            out["errors"].append("files kept: the tables could not be purged")
        else:
            if failed:
                out["notes"].append("tables could not be purged; files went all the same")
            removed = [sinks.remove_year(spark, root, year) for root in (output_root, f"{output_root.rstrip('/')}/json")]
            out["output_removed"] = {k: sum(r[k] for r in removed) for k in removed[0]}
            out["modal_html_removed"] = sinks.remove_files(files[1])
    sinks.write_text(spark, audit_path, json.dumps(out, default=str, sort_keys=True))
    return out
