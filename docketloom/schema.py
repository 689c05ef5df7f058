"""Schemas of cases, docket entries and run events, and the names that other systems give to their fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(k, T._parse_datatype_string(v)) for k, v in fields.items()])


CASE_COLUMNS = ["case_id", "case_type", "action_type", "nature_of_proceeding", "filing_date", "office", "style_of_cause", "language", "url", "html_content", "scraped_at"]
ENTRY_COLUMNS = ["id", "case_id", "doc_id", "entry_date", "entry_office", "summary"]

CASE_DDL = "case_id string, case_type string, action_type string, nature_of_proceeding string, filing_date date, office string, style_of_cause string, language string, url string, html_content string, scraped_at timestamp_ntz"
ENTRY_DDL = "id int, case_id string, doc_id int, entry_date date, entry_office string, summary string"
RUN_EVENT_DDL = "run_id string, seq long, ts timestamp_ntz, case_number string, outcome string, reason string, case_id string, message string"
#: Nested form of an exported case file.
PAYLOAD_DDL = f"case struct<{', '.join(f'{c.split()[0]}:{c.split()[1]}' for c in CASE_DDL.split(', '))}>, docket_entries array<struct<id:int, case_id:string, doc_id:int, entry_date:date, entry_office:string, summary:string>>, scraped_at timestamp"

#: Canonical field, then the names under which other tables and files hold it, in order of preference.
ALIASES = {
    "case_id": ["case_id", "court_file_no", "case_number", "caseId", "court_number"],
    "case_type": ["case_type"],
    "action_type": ["action_type", "type_of_action"],
    "nature_of_proceeding": ["nature_of_proceeding", "nature_of_processing"],
    "filing_date": ["filing_date", "case_date", "date"],
    "office": ["office", "court_name", "court"],
    "style_of_cause": ["style_of_cause", "case_title", "title"],
    "language": ["language"],
    "url": ["url"],
    "html_content": ["html_content"],
    "scraped_at": ["scraped_at", "crawled_at", "scrape_timestamp"],
}
ENTRY_ALIASES = {
    "id": ["id"],
    "case_id": ["case_id", "court_file_no", "case_number"],
    "doc_id": ["doc_id", "id_from_table"],
    "entry_date": ["entry_date", "date_filed"],
    "entry_office": ["entry_office", "office"],
    "summary": ["summary", "recorded_entry_summary"],
}


def first_filled(*columns: Column | str) -> Column:
    """The first value that is neither null nor an empty text; null if there is none. Empty texts count as missing."""
    return F.coalesce(*[F.when(c != "", c) if isinstance(c, Column) else F.when(F.col(c).cast("string") != "", F.col(c)) for c in columns])


def resolve_aliases(df: DataFrame, aliases: dict[str, list[str]] = ALIASES, ddl: str = CASE_DDL, keep_missing: bool = True) -> DataFrame:
    """Canonical columns from whichever known names ``df`` has, chosen from its columns when the plan is made; an empty text
    gives way to the next name. Fields without any source become null columns, or are left out."""
    types, out = dict(part.split(" ", 1) for part in ddl.split(", ")), []
    for name, known in aliases.items():
        have = [k for k in known if k in df.columns]
        if have:
            out.append(first_filled(*[F.col(h).cast(types[name]) for h in have] if types[name] == "string" else have).cast(types[name]).alias(name))
        elif keep_missing:
            out.append(F.lit(None).cast(types[name]).alias(name))
    return df.select(*out)
