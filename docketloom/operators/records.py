"""Projections between the forms of a record: legacy names, search rows, free text, pages, and combined exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, html, ids
from ..schema import ENTRY_ALIASES, ENTRY_DDL, first_filled, resolve_aliases
from . import store, validate

#: The header fields that a collected case may carry.
ALLOWED = ["case_type", "action_type", "nature_of_proceeding", "filing_date", "office", "style_of_cause", "language", "url"]
#: Words in the headings of the search results' columns.
SEARCH_HEADINGS = {"case_id": ["court file", "court number", "court no"], "style_of_cause": ["style"], "nature_of_proceeding": ["nature"]}


def entries_from_records(df: DataFrame) -> DataFrame:
    """Entries from loosely typed records under any known names: a date that is not ISO becomes null, a missing or unreadable
    ordinal 0, other unreadable numbers null."""
    texts = resolve_aliases(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]), ENTRY_ALIASES, ", ".join(f"{p.split()[0]} string" for p in ENTRY_DDL.split(", ")))
    return texts.select(F.col("id").try_cast("int").alias("id"), "case_id", F.coalesce(F.col("doc_id").try_cast("int"), F.lit(0)).alias("doc_id"), dates.iso_date("entry_date").alias("entry_date"), "entry_office", "summary")


def legacy_names(cases: DataFrame) -> DataFrame:
    """The case under its older names; a missing title or court is an empty text."""
    return cases.select(F.col("case_id").alias("court_file_no"), F.coalesce("style_of_cause", F.lit("")).alias("title"), F.coalesce("office", F.lit("")).alias("court"))


def allowed(df: DataFrame) -> DataFrame:
    """The id and the header fields that may be kept, as far as there are any."""
    return df.select("case_id", *[c for c in ALLOWED if c in df.columns])


def fill_from(header: DataFrame, search: DataFrame, fields: tuple[str, ...] = ("style_of_cause", "nature_of_proceeding")) -> DataFrame:
    """Header fields, with empty ones filled from the row that the search found for the same number."""
    found = search.select(F.col("case_id").alias("__id"), *[F.col(f).alias(f"__{f}") for f in fields])
    joined = header.join(found, F.col("case_id") == F.col("__id"), "left")
    return joined.select(*[first_filled(c, f"__{c}").alias(c) if c in fields else F.col(c) for c in header.columns])


def cases_from_pages(pages: DataFrame, number: Column, title: Column, court: Column, filed: Column) -> DataFrame:
    """Cases from addresses and pages, the other fields given as columns."""
    return pages.select(number.alias("case_id"), title.alias("style_of_cause"), court.alias("office"), filed.cast("date").alias("filing_date"), F.col("url"), F.col("html").alias("html_content"))


def search_row(headings: Column | str, cells: Column | str) -> Column:
    """Number, style and nature of a row of search results: by words in the headings, else the first three cells."""
    h, c = (F.col(x) if isinstance(x, str) else x for x in (headings, cells))
    low, texts = F.transform(h, lambda x: F.lower(F.trim(x))), F.transform(c, lambda x: F.trim(x))
    out = []
    for place, (field, words) in enumerate(SEARCH_HEADINGS.items()):
        by_word = [F.get(texts, (F.nullif(F.array_position(F.transform(low, html.holds(w)), True), F.lit(0)) - 1).cast("int")) for w in words]
        out.append(first_filled(*by_word, F.get(texts, F.lit(place))).alias(field))
    return F.struct(*out)


def free_text_fields(text: Column | str) -> Column:
    """Style and nature out of a paragraph: after their labels; a style without a label is what stands between the number
    and the label of the nature."""
    t = F.col(text) if isinstance(text, str) else text
    number = html.id_in_title(t)
    begin, end = F.position(number, t) + F.length(number), F.locate("nature of proceeding", F.lower(t))
    between = F.when(end > begin, F.nullif(F.regexp_replace(F.substr(t, begin, end - begin), r"^[\s:-]+|[\s:-]+$", ""), F.lit("")))
    style = F.coalesce(html.after_label(t, "style of cause"), between)
    return F.struct(number.alias("case_id"), style.alias("style_of_cause"), html.after_label(t, "nature of proceeding").alias("nature_of_proceeding"))


def longest_and_shortest(cells: Column | str) -> Column:
    """The longest and the two shortest non-empty texts of a row, the first of equal ones."""
    c = F.col(cells) if isinstance(cells, str) else cells
    ranked = F.array_sort(F.filter(F.transform(c, lambda x, i: F.struct(F.length(x).alias("n"), i.alias("i"), x.alias("x"))), lambda e: e["x"] != ""))
    down = F.array_sort(F.transform(ranked, lambda e: F.struct((-e["n"]).alias("n"), e["i"].alias("i"), e["x"].alias("x"))))
    return F.struct(F.get(down, F.lit(0))["x"].alias("longest"), F.get(ranked, F.lit(0))["x"].alias("shortest"), F.get(ranked, F.lit(1))["x"].alias("second"))


def export_plan(cases: DataFrame, stored: DataFrame, at: Column) -> dict[str, DataFrame]:
    """What a combined export does: the cases that may go out and the rejected ones, the new state of the stored cases, each
    case's status, the totals, and the name of the export file."""
    checked = validate.check_export(cases)
    good = checked.where("valid").select(cases.columns)
    status = store.upsert_status(stored, cases)
    return {
        "export": good, "rejected": checked.where("not valid"), "cases": store.upsert(stored, good, order=["scraped_at"] if "scraped_at" in cases.columns else None), "per_case": status, "totals": store.save_totals(status),
        "file": cases.sparkSession.range(1).select(F.concat(F.lit("cases_export_"), ids.stamp(at), F.lit(".json")).alias("name")),
    }
