"""The registered queries over the test tables, and each one's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, html, ids
from ..operators import lookup, mining, purge, records, runs, store, validate
from ..schema import resolve_aliases
from ..sources import readers, sinks
from . import adapters
from .adapters import SQL_CASES, SQL_ENTRIES, SQL_OUTCOMES, cases, entries, outcomes, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
AS_OF = "2002-01-01"


def query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


C, E, O, CE = f"WITH {SQL_CASES} ", f"WITH {SQL_ENTRIES} ", f"WITH {SQL_OUTCOMES} ", f"WITH {SQL_CASES}, {SQL_ENTRIES} "
_SUFFIX = "CASE WHEN regexp_matches({0}, '-\\d{{4}}$') THEN CAST(regexp_extract({0}, '-(\\d{{4}})$', 1) AS INT) WHEN regexp_matches({0}, '-\\d{{2}}$') THEN 2000 + CAST(regexp_extract({0}, '-(\\d{{2}})$', 1) AS INT) END"


def _sequence(c: str) -> str:
    return f"CAST(regexp_extract({c}, '^IMM-(\\d+)-', 1) AS BIGINT)"


# --- look-ups -----------------------------------------------------------------------------------------------------


@query(C + "SELECT count(*) AS total_cases FROM cases")
def case_count(s, d):
    return lookup.case_count(cases(s, d))


@query(C + "SELECT 1997 AS year, count(*) AS total_cases, max(scraped_at) AS last_scraped FROM cases WHERE case_id LIKE 'IMM-%-97'")
def case_year_stats(s, d):
    return lookup.year_stats(cases(s, d), 1997)


@query(C + f"SELECT {_SUFFIX.format('case_id')} AS year, count(*) AS total_cases, max(scraped_at) AS last_scraped FROM cases GROUP BY 1")
def case_stats_by_year(s, d):
    return lookup.stats_by_year(cases(s, d))


@query(C + ", w AS (SELECT 'IMM-' || i || '-97' AS case_id FROM range(1, 2001) t(i)) SELECT case_id, case_id IN (SELECT case_id FROM cases) AS is_stored FROM w")
def case_exists(s, d):
    return lookup.exists(readers.numbers(s, 1997, 1, 2000), cases(s, d))


@query(C + f"SELECT case_id, {_sequence('case_id')} AS sequence FROM cases WHERE case_id LIKE 'IMM-%-97' ORDER BY 2 DESC, 1 DESC LIMIT 1")
def last_case_numeric(s, d):
    return lookup.last_case(cases(s, d), 1997)


@query(C + f"SELECT case_id, {_sequence('case_id')} AS sequence FROM cases WHERE case_id LIKE 'IMM-%-97' ORDER BY 1 DESC LIMIT 1")
def last_case_lexical(s, d):
    return lookup.last_case(cases(s, d), 1997, "lexical")


_SHIFTED = SQL_CASES.replace("year(o_orderdate)", "year(o_orderdate + INTERVAL 360 MONTH)").replace("CAST(o_orderdate AS DATE)", "CAST(o_orderdate + INTERVAL 360 MONTH AS DATE)")


@query(f"WITH {_SHIFTED} SELECT case_id, filing_date, office FROM cases WHERE {_SUFFIX.format('case_id')} = 2027")
def cases_by_suffix_year(s, d):
    return lookup.cases_of_year(cases(s, d, 360), 2027, "suffix").select("case_id", "filing_date", "office")


@query(C + "SELECT case_id, case_type, office, filing_date FROM cases WHERE case_id LIKE 'IMM-%-96'")
def cases_of_year(s, d):
    return lookup.cases_of_year(cases(s, d), 1996).select("case_id", "case_type", "office", "filing_date")


@query(C + "SELECT case_id, case_type, office, filing_date, scraped_at FROM cases ORDER BY scraped_at DESC NULLS LAST, case_id LIMIT 10")
def recent_cases(s, d):
    return lookup.recent_cases(cases(s, d))


@query(C + "SELECT case_id, scraped_at FROM cases ORDER BY scraped_at DESC, case_id OFFSET 100")
def cases_past_newest(s, d):
    return lookup.past_newest(cases(s, d).select("case_id", "scraped_at"), 100, "scraped_at", "case_id")


@query(C + f"SELECT case_id, {_sequence('case_id')} AS sequence, {_SUFFIX.format('case_id')} AS suffix_year, year(filing_date)::INT AS filing_year, 'IMM-' || {_sequence('case_id')} || '-' || lpad(CAST(({_SUFFIX.format('case_id')}) % 100 AS VARCHAR), 2, '0') AS rebuilt FROM cases")
def case_id_parts(s, d):
    return cases(s, d).select("case_id", ids.sequence_of("case_id").alias("sequence"), ids.suffix_year("case_id").alias("suffix_year"), ids.year_of("filing_date").alias("filing_year"), ids.format_number(ids.sequence_of("case_id"), ids.suffix_year("case_id")).alias("rebuilt"))


@query(C + f", l AS (SELECT max({_sequence('case_id')}) AS last FROM cases WHERE case_id LIKE 'IMM-%-97') SELECT last + i AS sequence, 'IMM-' || (last + i) || '-97' AS case_id FROM l, range(1, 1001) t(i)")
def next_case_numbers(s, d):
    return readers.next_numbers(cases(s, d), 1997)


@query(C + ", w AS (SELECT i AS sequence, 'IMM-' || i || '-98' AS case_id FROM range(1, 10001) t(i)) SELECT sequence, case_id FROM w WHERE NOT EXISTS (SELECT 1 FROM cases c WHERE c.case_id = w.case_id)")
def numbers_to_collect(s, d):
    return store.to_collect(readers.numbers(s, 1998), cases(s, d)).select("sequence", "case_id")


# --- store ----------------------------------------------------------------------------------------------------------

_SEQ3 = _sequence("case_id")
_STORE = C + """, target AS (SELECT case_id, office, scraped_at FROM cases WHERE filing_date < DATE '1997-01-01'),
source AS (SELECT case_id, upper(office) AS office, scraped_at + INTERVAL 1 DAY AS scraped_at FROM cases WHERE filing_date >= DATE '1995-01-01' UNION ALL SELECT case_id, lower(office), scraped_at FROM cases WHERE action_type = 'F'),
clean AS (SELECT case_id, office, scraped_at FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY scraped_at DESC, office DESC) AS r FROM source) WHERE r = 1) """


def _store(s, d):
    """What was stored by a day, and what is collected since two years before, finished cases a second time."""
    c = cases(s, d)
    source = c.where("filing_date >= DATE '1995-01-01'").select("case_id", F.upper("office").alias("office"), (F.col("scraped_at") + F.expr("INTERVAL 1 DAY")).alias("scraped_at"))
    return c.where("filing_date < DATE '1997-01-01'").select("case_id", "office", "scraped_at"), source.union(c.where("action_type = 'F'").select("case_id", F.lower("office"), "scraped_at"))


@query(_STORE + "SELECT coalesce(c.case_id, t.case_id) AS case_id, CASE WHEN c.case_id IS NULL THEN t.office ELSE c.office END AS office, CASE WHEN c.case_id IS NULL THEN t.scraped_at ELSE c.scraped_at END AS scraped_at FROM target t FULL JOIN clean c ON t.case_id = c.case_id")
def upsert_cases(s, d):
    target, source = _store(s, d)
    return store.upsert(target, source, order=["scraped_at"])


@query(_STORE + ", st AS (SELECT CASE WHEN case_id IN (SELECT case_id FROM target) THEN 'updated' ELSE 'new' END AS status FROM source) SELECT count(*) FILTER (status <> 'failed') AS successful, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'new') AS new, count(*) FILTER (status = 'updated') AS updated FROM st")
def upsert_status_counts(s, d):
    return store.save_totals(store.upsert_status(*_store(s, d)))


_IGNORE = E + """, first AS (SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY case_id, doc_id ORDER BY entry_date, entry_office, summary) AS r FROM entries) WHERE r = 1),
target AS (SELECT case_id, doc_id, entry_date, entry_office, 'old ' || summary AS summary FROM first WHERE doc_id <= 2) """


def _entry_store(s, d):
    e = entries(s, d)
    target = store.insert_entries(e.where("false"), e).where("doc_id <= 2")
    return target.withColumn("summary", F.concat(F.lit("old "), "summary")), e


@query(_IGNORE + "SELECT * FROM target UNION ALL SELECT * FROM first f WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.case_id = f.case_id AND t.doc_id = f.doc_id)")
def insert_ignore_entries(s, d):
    return store.insert_entries(*_entry_store(s, d))


@query(_IGNORE + "SELECT * FROM first UNION ALL SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM first f WHERE t.case_id = f.case_id AND t.doc_id = f.doc_id)")
def insert_update_entries(s, d):
    return store.insert_entries(*_entry_store(s, d), on_conflict="update")


@query(CE + "SELECT c.case_id, count(e.doc_id) AS n_entries, md5(coalesce(string_agg(e.doc_id || '|' || e.entry_date || '|' || e.summary, ';' ORDER BY e.doc_id, e.entry_date, e.entry_office, e.summary), '')) AS checksum FROM cases c LEFT JOIN entries e ON c.case_id = e.case_id GROUP BY c.case_id")
def nested_cases(s, d):
    nested = store.nest(cases(s, d).select("case_id"), entries(s, d))
    text = F.array_join(F.transform("docket_entries", lambda e: F.concat_ws("|", e["doc_id"].cast("string"), e["entry_date"].cast("string"), e["summary"])), ";")
    return nested.select("case_id", F.size("docket_entries").cast("long").alias("n_entries"), F.md5(text.cast("binary")).alias("checksum"))


@query(CE + "SELECT case_id, CAST(row_number() OVER (PARTITION BY case_id ORDER BY doc_id, entry_date, entry_office, summary) - 1 AS INT) AS position, doc_id, entry_date, entry_office, summary FROM entries SEMI JOIN cases USING (case_id)")
def unnested_entries(s, d):
    return store.unnest(store.nest(cases(s, d).select("case_id"), entries(s, d)))


@query(CE + ", open AS (SELECT * FROM cases WHERE action_type <> 'F') SELECT case_id, doc_id, entry_date, summary FROM entries e WHERE NOT EXISTS (SELECT 1 FROM open c WHERE c.case_id = e.case_id)")
def orphan_entries(s, d):
    return store.orphans(entries(s, d), cases(s, d).where("action_type != 'F'")).select("case_id", "doc_id", "entry_date", "summary")


@query(CE + "SELECT case_id, filing_date FROM cases c WHERE NOT EXISTS (SELECT 1 FROM entries e WHERE c.case_id = e.case_id)")
def cases_without_entries(s, d):
    return store.without_entries(cases(s, d), entries(s, d)).select("case_id", "filing_date")


@query(CE + """SELECT case_id, case_type, action_type, CAST(NULL AS VARCHAR) AS nature_of_proceeding, filing_date, office, style_of_cause, language, CAST(NULL AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS html_content, scraped_at, case_id AS case_number,
  style_of_cause AS title, office AS court, filing_date AS date, (SELECT coalesce(string_agg(doc_id || ' ' || summary, ';' ORDER BY doc_id, entry_date, entry_office, summary), '') FROM entries e WHERE e.case_id = c.case_id) AS docket_entries FROM cases c""")
def case_dict(s, d):
    nested = store.nest(cases(s, d), entries(s, d))
    return sinks.case_dict(nested).withColumn("docket_entries", F.array_join(F.transform("docket_entries", lambda e: F.concat_ws(" ", e["doc_id"].cast("string"), e["summary"])), ";"))


@query(C + "SELECT case_id, case_id AS case_number, coalesce(style_of_cause, '') AS title, coalesce(office, '') AS court, coalesce(CAST(filing_date AS VARCHAR), '') AS date, '' AS html_content, coalesce(CAST(scraped_at AS VARCHAR), '') AS scraped_at FROM cases")
def csv_row(s, d):
    return sinks.csv_row(cases(s, d))


@query(E + "SELECT CAST(NULL AS INT) AS id, case_id, coalesce(doc_id, 0) AS doc_id, entry_date, entry_office, summary FROM entries")
def entry_dict(s, d):
    return sinks.entry_dict(entries(s, d))


@query(C + "SELECT CASE WHEN substr(case_id, 5, 1) = '1' THEN office ELSE style_of_cause END AS office, case_id, filing_date FROM cases")
def alias_resolved(s, d):
    legacy = cases(s, d).select(F.col("case_id").alias("court_file_no"), F.when(F.substring("case_id", 5, 1) == "1", F.col("office")).otherwise("").alias("office"), F.col("style_of_cause").alias("court_name"), F.col("filing_date").alias("case_date"))
    return resolve_aliases(legacy, keep_missing=False)


@query(E + "SELECT CAST(NULL AS INT) AS id, case_id, coalesce(CASE WHEN doc_id % 3 <> 0 THEN doc_id END, 0) AS doc_id, CASE WHEN doc_id % 2 = 0 THEN entry_date END AS entry_date, entry_office, summary FROM entries")
def entries_from_records(s, d):
    loose = entries(s, d).select(F.col("case_id").alias("court_file_no"), F.when(F.col("doc_id") % 3 != 0, F.col("doc_id").cast("string")).otherwise("").alias("id_from_table"), F.when(F.col("doc_id") % 2 == 0, F.date_format("entry_date", "yyyyMMdd")).otherwise(F.date_format("entry_date", "dd.MM.yyyy")).alias("date_filed"), F.col("entry_office").alias("office"), F.col("summary").alias("recorded_entry_summary"))
    return records.entries_from_records(loose)


@query(C + "SELECT case_id AS court_file_no, style_of_cause AS title, office AS court FROM cases")
def legacy_names(s, d):
    return records.legacy_names(cases(s, d))


@query(C + "SELECT case_id, style_of_cause, office AS nature_of_proceeding FROM cases")
def search_rows(s, d):
    cells = F.array(F.lit("1"), F.concat(F.lit(" "), "style_of_cause"), "case_id", "office")
    headings = F.array(*map(F.lit, ("#", "Style of Cause", "Court File No.", "Nature of Proceeding")))
    return cases(s, d).select(records.search_row(headings, cells).alias("r")).select("r.*")


@query(C + "SELECT case_id, style_of_cause, case_type AS nature_of_proceeding FROM cases")
def free_text_fields(s, d):
    text = F.concat(F.lit("Court file "), "case_id", F.lit(" - Style of Cause: "), "style_of_cause", F.lit("  Nature of Proceeding: "), "case_type")
    return cases(s, d).select(records.free_text_fields(text).alias("r")).select("r.*")


@query(C + f"SELECT case_id, coalesce(nullif(CASE WHEN {_SEQ3} % 2 = 0 THEN office ELSE '' END, ''), style_of_cause) AS style_of_cause FROM cases")
def filled_headers(s, d):
    c = cases(s, d)
    header = c.select("case_id", F.when(ids.sequence_of("case_id") % 2 == 0, F.col("office")).otherwise("").alias("style_of_cause"))
    return records.fill_from(header, c.select("case_id", "style_of_cause"), ("style_of_cause",))


# --- purge ----------------------------------------------------------------------------------------------------------

_GONE = "(year(filing_date) = 2027 OR " + _SUFFIX.format("case_id") + " = 2027)"
_PURGE = f"WITH {_SHIFTED}, {SQL_ENTRIES.replace('year(o_orderdate)', 'year(o_orderdate + INTERVAL 360 MONTH)')} "


def _purged(s, d):
    return cases(s, d, 360), entries(s, d, 360)


@query(_PURGE + f"SELECT case_id, filing_date, office FROM cases WHERE NOT {_GONE}")
def purge_kept_cases(s, d):
    return purge.kept_cases(_purged(s, d)[0], 2027).select("case_id", "filing_date", "office")


@query(_PURGE + f"SELECT case_id, doc_id, entry_date, summary FROM entries WHERE case_id NOT IN (SELECT case_id FROM cases WHERE {_GONE})")
def purge_kept_entries(s, d):
    c, e = _purged(s, d)
    return purge.split_entries(e, c, 2027)[0].select("case_id", "doc_id", "entry_date", "summary")


@query(_PURGE + f", g AS (SELECT case_id FROM cases WHERE {_GONE}) SELECT 2027 AS year, false AS dry_run, (SELECT count(*) FROM g) AS cases_deleted, (SELECT count(*) FROM entries WHERE case_id IN (SELECT case_id FROM g)) AS entries_deleted, (SELECT string_agg(case_id, ',' ORDER BY case_id) FROM (SELECT case_id FROM g ORDER BY case_id LIMIT 10)) AS first_case_ids")
def purge_audit(s, d):
    return purge.audit(*_purged(s, d), 2027).withColumn("first_case_ids", F.array_join("first_case_ids", ","))


@query(_PURGE + f"SELECT case_id, filing_date FROM cases WHERE {_GONE}")
def purge_dry_run(s, d):
    return purge.doomed(_purged(s, d)[0], 2027).select("case_id", "filing_date")


# --- runs -----------------------------------------------------------------------------------------------------------


@query(O + "SELECT run_id, arg_min(case_number, seq) AS first_case, arg_max(case_number, seq) AS last_case, count(*) AS total, count(*) FILTER (outcome = 'success') AS success, count(*) FILTER (outcome = 'skipped') AS skipped, count(*) FILTER (outcome = 'no_record') AS no_record, count(*) FILTER (outcome = 'failed') AS failed FROM outcomes GROUP BY run_id")
def run_totals(s, d):
    return runs.run_totals(outcomes(s, d))


@query(O + "SELECT run_id, count(*) FILTER (outcome = 'success') AS scraped_count, count(*) FILTER (outcome = 'skipped') AS skipped_count, count(DISTINCT case_number) FILTER (outcome = 'skipped') AS skipped_numbers, min(case_number) FILTER (outcome = 'skipped') AS first_skipped, 'cases.json' AS export_path FROM outcomes GROUP BY run_id")
def batch_audit(s, d):
    return runs.batch_audit(outcomes(s, d), "cases.json")


@query(O + "SELECT DISTINCT run_id, case_number FROM outcomes WHERE outcome = 'skipped'")
def skipped_numbers(s, d):
    return runs.skipped_numbers(outcomes(s, d))


_DONE = O + ", done AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY seq) AS processed, sum(CASE WHEN outcome = 'success' THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY seq) AS successes FROM outcomes WHERE outcome <> 'skipped')"
_STREAK = _DONE + ", streaks AS (SELECT run_id, seq, case_number, outcome, row_number() OVER (PARTITION BY run_id, successes ORDER BY seq) - CASE WHEN successes > 0 THEN 1 ELSE 0 END AS streak FROM done)"


@query(_DONE + " SELECT run_id, seq, processed, CAST(successes AS BIGINT) AS successes, round(successes * 100.0 / processed, 1) AS rate FROM done WHERE processed % 10 = 0")
def running_success_rate(s, d):
    return runs.success_rate(outcomes(s, d))


@query(_STREAK + " SELECT run_id, seq, case_number, outcome, CAST(streak AS INT) AS streak FROM streaks")
def failure_streaks(s, d):
    return runs.failure_streaks(outcomes(s, d))


@query(_STREAK + ", stop AS (SELECT run_id, max(streak)::INT AS longest, min(seq) FILTER (outcome <> 'success' AND streak >= 10) AS stop_seq FROM streaks GROUP BY run_id) SELECT s.run_id, longest, stop_seq, count(*) AS processed FROM streaks s JOIN stop t ON s.run_id = t.run_id WHERE stop_seq IS NULL OR seq <= stop_seq GROUP BY ALL")
def emergency_stops(s, d):
    return runs.emergency_stops(outcomes(s, d))


@query(_STREAK + " SELECT run_id, max(streak) >= 20 AS exhausted FROM streaks GROUP BY run_id")
def exhausted_runs(s, d):
    return runs.exhausted(outcomes(s, d), 20)


@query(O + ", b AS (SELECT *, coalesce(sum(CASE WHEN outcome = 'success' THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM outcomes) SELECT run_id, seq, case_number, outcome FROM b WHERE before < 25")
def capped_runs(s, d):
    return runs.capped(outcomes(s, d), 25).select("run_id", "seq", "case_number", "outcome")


@query(O + "SELECT case_number, arg_max(outcome, seq) AS outcome, max(seq) AS seq FROM outcomes GROUP BY case_number HAVING arg_max(outcome, seq) = 'failed'")
def retry_candidates(s, d):
    return runs.retry_candidates(outcomes(s, d))


@query(O + """SELECT run_id, seq, '{"case_number":"' || case_number || '","outcome":"' || outcome || '"}' AS value FROM outcomes
UNION ALL SELECT DISTINCT run_id, CAST(-1 AS BIGINT), '{"event":"start","run_id":"' || run_id || '"}' FROM outcomes
UNION ALL SELECT run_id, 4611686018427387904, '{"event":"finish","total":' || count(*) || ',"success":' || count(*) FILTER (outcome = 'success') || ',"skipped":' || count(*) FILTER (outcome = 'skipped') || ',"failed":' || count(*) FILTER (outcome = 'failed') || '}' FROM outcomes GROUP BY run_id""")
def run_log_lines(s, d):
    return runs.run_log(outcomes(s, d)).select("run_id", "seq", "value")


# --- texts, dates, HTML -----------------------------------------------------------------------------------------------

_TITLE = r"trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '[\s\x{00A0}]+', ' ', 'g'))"
_STRIP = r"trim(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>', '', 'g'), '(?is)<style.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '(?s)<[^>]+>', '', 'g'), '&nbsp;', ' '), '[\s\x{00A0}]+', ' ', 'g'))"


@query(f"SELECT page_id, {_TITLE} AS title FROM pages")
def page_title(s, d):
    return table(s, d, "pages").select("page_id", html.page_title("html").alias("title"))


@query(f"SELECT page_id, {_STRIP} AS text FROM pages")
def page_text(s, d):
    return table(s, d, "pages").select("page_id", html.strip_tags("html").alias("text"))


#: Hosts and path of the pages that ``page_urls`` takes as case pages.
_HOSTS = ["blog.tionsh.example.net", "thther.example.org", "blog.ththan.example.net", "blog.tiontion.example.com", "m.ththth.example.net", "www.ththhe.example.com", "ththed.example.org", "blog.ththon.example.net"]


@query(f"""SELECT page_id, coalesce(regexp_extract(url, '^https?://([^/?#]*)', 1) IN ({", ".join(f"'{h}'" for h in _HOSTS)}) AND position('/en/' IN regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)) > 0 AND NOT regexp_matches(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '(?i)login|efiling'), false) AS valid FROM pages""")
def page_urls(s, d):
    return table(s, d, "pages").select("page_id", validate.valid_url("url", hosts=_HOSTS, path="/en/").alias("valid"))


def _as_html(e: DataFrame) -> DataFrame:
    row = F.concat(*[x for c in ("doc_id", "entry_date", "entry_office", "summary") for x in (F.lit("<td>"), F.col(c).cast("string"), F.lit("</td>"))])
    rows = e.groupBy("case_id").agg(F.array_sort(F.collect_list(F.concat(F.lit("<tr>"), row, F.lit("</tr>")))).alias("r"))
    return rows.select("case_id", F.concat(F.lit("<p>x<br><table><tbody><tr><td>#</td><td>YYYY-MM-DD</td></tr></tbody></table><table><tbody><tr><td>ID</td><td>Date</td></tr>\n"), F.array_join("r", "\n"), F.lit("</tbody></table>")).alias("html"))


@query(E + "SELECT case_id, CAST(doc_id AS VARCHAR) AS doc_id, entry_date, entry_office, summary FROM entries")
def html_entries_roundtrip(s, d):
    found = _as_html(entries(s, d)).select("case_id", F.explode(html.table_entries("html")).alias("e")).select("case_id", "e.*")
    return found.withColumn("entry_date", dates.entry_date("entry_date"))


@query(C + "SELECT case_id, case_type, action_type, filing_date, office, style_of_cause, language FROM cases")
def html_header_roundtrip(s, d):
    parts = [("Court File Number", F.col("case_id")), ("Type", F.col("case_type")), ("Type of Action", F.col("action_type")), ("Filing Date", F.date_format("filing_date", "d MMMM yyyy")), ("Office", F.concat_ws(" ", "office", "language")), ("Style of Cause", F.col("style_of_cause"))]
    bold = [x for label, v in parts[:3] for x in (F.lit(f"<p><strong>{label} :</strong> "), v, F.lit("</p>\n"))]
    dl = [x for label, v in parts[3:5] for x in (F.lit(f"<dt>{label}:</dt><dd>"), v, F.lit("</dd>"))]
    td = [x for label, v in parts[5:] for x in (F.lit(f"<table><tr><td>{label}</td><td>"), v, F.lit("</td></tr></table>"))]
    pages = cases(s, d).select(F.concat(F.lit("<h4 class='modal-title'>x</h4><br>"), *bold, F.lit("<dl>"), *dl, F.lit("</dl>"), *td).alias("html"))
    found = pages.select(html.header_fields("html").alias("h")).select("h.*")
    both = html.office_and_language("office", "language")
    return found.select("case_id", "case_type", "action_type", dates.header_date("filing_date").alias("filing_date"), both["office"].alias("office"), "style_of_cause", both["language"].alias("language"))


@query(C + "SELECT case_id, action_type, office, language FROM cases")
def label_values(s, d):
    page = F.concat(F.lit("<div><strong>Type of Action :</strong> "), "action_type", F.lit("<br>\nOffice: "), "office", F.lit("<br>\n<strong>Language:</strong>&nbsp;"), "language", F.lit("</div>"))
    return cases(s, d).select("case_id", page.alias("h")).select("case_id", html.label_value("h", "Type of Action").alias("action_type"), html.label_value("h", "Office").alias("office"), html.label_value("h", "Language").alias("language"))


@query(E + ", c AS (SELECT case_id, CAST(row_number() OVER (PARTITION BY case_id ORDER BY doc_id, entry_date, entry_office, summary) AS INT) AS doc_id, entry_date, entry_office, summary FROM entries) SELECT * FROM c")
def table_selection(s, d):
    rows = entries(s, d).groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("doc_id", "entry_date", "entry_office", "summary"))).alias("r"))
    real = F.struct(F.array(*map(F.lit, ("ID", "Date Filed", "Office", "Recorded Entry Summary"))).alias("headers"), F.transform("r", lambda e: F.array(e["doc_id"].cast("string"), F.upper(F.date_format(e["entry_date"], "dd-MMM-yyyy")), e["entry_office"], e["summary"])).alias("rows"), F.array(F.lit("Court file")).alias("captions"))
    template = F.struct(F.array(F.lit("#"), F.lit("Date")).alias("headers"), F.array(F.array(F.lit("#"), F.lit("YYYY-MM-DD"))).alias("rows"), F.array().cast("array<string>").alias("captions"))
    return rows.select("case_id", html.best_table(F.array(template, real)).alias("t")).select("case_id", F.explode(html.mapped_entries("t")).alias("e")).select("case_id", "e.*")


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed FROM orders")
def header_dates(s, d):
    formats = ["yyyy-MM-dd", "yyyyMMdd", "dd-MM-yyyy", "d/M/yyyy", "MMMM d, yyyy", "d MMMM yyyy", "yyyy/MM/dd"]
    text = F.lit(None).cast("string")
    for k, f in enumerate(formats):
        text = F.when(F.col("o_orderkey") % len(formats) == k, F.date_format("o_orderdate", f)).otherwise(text)
    return table(s, d, "orders").select("o_orderkey", dates.header_date(F.concat(F.lit(" "), text, F.lit(" "))).alias("parsed"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 6 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders")
def entry_dates(s, d):
    at = F.col("o_orderdate")
    texts = [F.date_format(at, "MMM d, yyyy"), F.date_format(at, "d MMM yyyy"), F.date_format(at, "d MMMM, yyyy"), F.concat(F.lit("filed on "), F.upper(F.date_format(at, "dd-MMM-yyyy")), F.lit(" at noon")), F.concat(F.lit("received "), F.date_format(at, "dd/MM/yyyy")), F.concat(F.lit("x "), F.date_format(at, "yyyy-MM-dd"), F.lit(".")), F.lit("no date: 31-FEB-2024")]
    text = F.lit(None).cast("string")
    for k, t in enumerate(texts):
        text = F.when(F.col("o_orderkey") % len(texts) == k, t).otherwise(text)
    return table(s, d, "orders").select("o_orderkey", dates.entry_date(text).alias("parsed"))


@query(r"SELECT p_partkey, coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(trim(p_name || ' ## ' || p_type || '/_'), '[^A-Za-z0-9._-]+', '-', 'g'), '-{2,}', '-', 'g'), '^[-_]+|[-_]+$', '', 'g'), ''), 'case') AS safe, regexp_replace(p_name || ' ## ' || p_type || '/_', '[^A-Za-z0-9._-]', '_', 'g') AS plain FROM part")
def sanitized_names(s, d):
    name = F.concat("p_name", F.lit(" ## "), "p_type", F.lit("/_"))
    return table(s, d, "part").select("p_partkey", ids.safe_name(name).alias("safe"), ids.plain_name(name).alias("plain"))


@query(C + f"SELECT case_id, 2000 + CAST(regexp_extract(case_id, '(\\d{{2}})$', 1) AS INT) AS year, case_id || '-' || (2000 + CAST(regexp_extract(case_id, '(\\d{{2}})$', 1) AS INT)) || '0101' AS stem FROM cases")
def file_stems(s, d):
    today = F.to_date(F.lit(AS_OF))
    return cases(s, d).select("case_id", ids.export_year("case_id", "filing_date", "scraped_at", today).alias("year"), ids.file_stem("case_id", "filing_date", "scraped_at", today).alias("stem"))


@query(C + ", n AS (SELECT case_id, office AS stem, row_number() OVER (PARTITION BY office ORDER BY case_id) + CASE WHEN office < 'K' THEN 2 ELSE 0 END AS r FROM cases) SELECT case_id, stem, CASE WHEN r = 1 THEN stem WHEN r <= 101 THEN stem || '-' || (r - 1) END AS unique_stem FROM n")
def unique_stems(s, d):
    c = cases(s, d).select("case_id", F.col("office").alias("stem"))
    there = table(s, d, "nation").where("n_name < 'K'").select(F.col("n_name").alias("stem"))
    return store.unique_stems(c, there.union(there.select(F.concat("stem", F.lit("-1")))))


@query(C + "SELECT case_id, office, language FROM cases")
def office_language(s, d):
    both = html.office_and_language(F.concat_ws("  ", "office", "language"), F.lit(None).cast("string"))
    return cases(s, d).select("case_id", both["office"].alias("office"), both["language"].alias("language"))


# --- validation -------------------------------------------------------------------------------------------------------


@query(C + ", x AS (SELECT CASE WHEN case_id LIKE '%7-97' THEN '' WHEN case_id LIKE '%8-97' THEN replace(case_id, '-', '_') ELSE case_id END AS case_id FROM cases) SELECT case_id, case_id <> '' AS valid, CASE WHEN case_id LIKE '%\\_%' ESCAPE '\\' THEN 'unusual case number: ' || case_id END AS warning FROM x")
def export_validation(s, d):
    x = F.when(F.col("case_id").like("%7-97"), "").when(F.col("case_id").like("%8-97"), F.replace("case_id", F.lit("-"), F.lit("_"))).otherwise(F.col("case_id"))
    return validate.check_export(cases(s, d).select(x.alias("case_id")))


@query(C + "SELECT case_id, CASE WHEN filing_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' THEN '' ELSE 'filing_date' END AS violations FROM cases")
def case_violations(s, d):
    return validate.case_violations(cases(s, d), "1996-01-01", "1999-12-31").withColumn("violations", F.array_join("violations", ","))


@query(CE + ", open AS (SELECT case_id FROM cases WHERE action_type <> 'F') SELECT case_id, doc_id, concat_ws(',', CASE WHEN case_id NOT IN (SELECT case_id FROM open) THEN 'case' END, CASE WHEN count(*) OVER (PARTITION BY case_id, doc_id) > 1 THEN 'unique' END) AS violations FROM entries")
def entry_violations(s, d):
    return validate.entry_violations(entries(s, d), cases(s, d).where("action_type != 'F'")).withColumn("violations", F.array_join("violations", ","))


@query(C + "SELECT case_id, concat_ws(',', CASE WHEN language = 'French' THEN 'url' END, CASE WHEN action_type = 'P' THEN 'case_id' END, CASE WHEN case_type NOT LIKE '1%' THEN 'html_content' END, CASE WHEN action_type = 'P' THEN 'pattern' END) AS violations FROM (SELECT * REPLACE (CASE WHEN action_type = 'P' THEN '' ELSE case_id END AS case_id) FROM cases)")
def contract_violations(s, d):
    c = cases(s, d).withColumns({"case_id": F.when(F.col("action_type") == "P", "").otherwise(F.col("case_id")), "url": F.when(F.col("language") == "English", "https://x"), "html_content": F.when(F.col("case_type").like("1%"), "<p>").otherwise(" ")})
    return validate.contract_violations(c).withColumn("violations", F.array_join("violations", ","))


# --- analytics --------------------------------------------------------------------------------------------------------

_RANK = "CASE WHEN regexp_matches(summary, '(?i)notice of discontinuance') THEN 1 WHEN regexp_matches(summary, '(?i)granted|allowed') THEN 2 WHEN regexp_matches(summary, '(?i)dismissed') THEN 3 END"
_FACTS = CE + f""", m AS (SELECT *, {_RANK} AS rank, nullif(regexp_extract(summary, '\\b(Beijing|Ankara|New Delhi|Lagos)\\b', 1), '') AS vo FROM entries),
per AS (SELECT case_id, min(rank) AS rank, bool_or(regexp_matches(summary, '(?i)mandamus|compel|delay')) AS man, min(entry_date) FILTER (regexp_matches(summary, '(?i)rule 9')) AS rule9_date,
  bool_or(regexp_matches(summary, '(?i)leave granted')) AS leave_granted, min(struct_pack(a := entry_date, b := doc_id, c := vo)) FILTER (vo IS NOT NULL) AS visa FROM m GROUP BY case_id),
dated AS (SELECT per.case_id, min(entry_date) AS outcome_date FROM m JOIN per ON m.case_id = per.case_id AND m.rank = per.rank GROUP BY per.case_id),
facts AS (SELECT c.case_id, c.style_of_cause, c.filing_date, c.office AS court_office, visa.c AS visa_office,
  CASE WHEN coalesce(man, false) OR regexp_matches(style_of_cause, '(?i)mandamus|compel|delay') THEN 'Mandamus' ELSE 'Other' END AS case_type,
  CASE rank WHEN 1 THEN 'Discontinued' WHEN 2 THEN 'Granted' WHEN 3 THEN 'Dismissed' ELSE 'Ongoing' END AS status, outcome_date, CAST(NULL AS VARCHAR) AS judge, rule9_date, coalesce(leave_granted, false) AS leave_granted
  FROM cases c LEFT JOIN per ON c.case_id = per.case_id LEFT JOIN dated ON c.case_id = dated.case_id),
durations AS (SELECT case_id, case_type, court_office, visa_office, 'time_to_close' AS metric, outcome_date - filing_date AS days FROM facts WHERE status <> 'Ongoing'
  UNION ALL SELECT case_id, case_type, court_office, visa_office, 'age', DATE '{AS_OF}' - filing_date FROM facts WHERE status = 'Ongoing'
  UNION ALL SELECT case_id, case_type, court_office, visa_office, 'rule9_wait', rule9_date - filing_date FROM facts WHERE rule9_date IS NOT NULL) """


def _facts(s, d):
    return mining.facts(cases(s, d), entries(s, d), offices=list(adapters.OFFICES.values()))


def _durations(s, d):
    return mining.durations(_facts(s, d), AS_OF)


@query(_FACTS + "SELECT case_id, case_type FROM facts")
def case_type(s, d):
    return _facts(s, d).select("case_id", "case_type")


@query(_FACTS + "SELECT case_id, status, outcome_date, rule9_date, leave_granted, judge FROM facts")
def case_status(s, d):
    return _facts(s, d).select("case_id", "status", "outcome_date", "rule9_date", "leave_granted", "judge")


@query(_FACTS + f"SELECT case_id, style_of_cause AS title, filing_date, court_office, visa_office, case_type AS type, status, outcome_date, CASE WHEN status = 'Ongoing' THEN DATE '{AS_OF}' - filing_date ELSE outcome_date - filing_date END AS duration_days, judge FROM facts")
def case_details(s, d):
    return mining.details(_facts(s, d), AS_OF)


_STATS = "count(*) AS n, round(avg(days), 4) AS mean_days, round(median(days), 4) AS median_days, max(days) AS max_days, min(days) AS min_days"


@query(_FACTS + f"SELECT metric, case_type, {_STATS} FROM durations GROUP BY metric, case_type")
def duration_stats(s, d):
    return mining.duration_stats(_durations(s, d), "case_type")


@query(_FACTS + f"SELECT metric, visa_office, {_STATS} FROM durations GROUP BY metric, visa_office")
def duration_stats_by_visa_office(s, d):
    return mining.duration_stats(_durations(s, d), "visa_office")


_Q = "q AS (SELECT case_type, count(*) AS n, quantile_cont(days, 0.25) AS q1, quantile_cont(days, 0.5) AS q2, quantile_cont(days, 0.75) AS q3 FROM durations WHERE metric = 'time_to_close' GROUP BY case_type)"


@query(_FACTS + f", {_Q} SELECT d.case_type, n, q1, q2, q3, count(*) FILTER (days < q1 - 1.5 * (q3 - q1) OR days > q3 + 1.5 * (q3 - q1)) AS outliers FROM durations d JOIN q ON d.case_type = q.case_type WHERE metric = 'time_to_close' GROUP BY ALL")
def duration_quartiles(s, d):
    return mining.quartiles(_durations(s, d))


@query(_FACTS + f", {_Q} SELECT case_id, d.case_type, days FROM durations d JOIN q ON d.case_type = q.case_type WHERE metric = 'time_to_close' AND (days < q1 - 1.5 * (q3 - q1) OR days > q3 + 1.5 * (q3 - q1))")
def duration_outliers(s, d):
    return mining.outliers(_durations(s, d))


@query(_FACTS + "SELECT strftime(filing_date, '%Y-%m') AS month, case_type, count(*) AS n FROM facts GROUP BY ALL")
def monthly_trend(s, d):
    return mining.monthly_trend(_facts(s, d))


@query(_FACTS + "SELECT strftime(filing_date, '%Y-%m') AS month, count(*) FILTER (case_type = 'Mandamus') AS mandamus, count(*) FILTER (case_type = 'Other') AS other, count(*) FILTER (status = 'Ongoing') AS ongoing, count(*) FILTER (status <> 'Ongoing') AS closed FROM facts GROUP BY ALL")
def monthly_volume(s, d):
    return mining.monthly_volume(_facts(s, d))


@query(_FACTS + ", x AS (SELECT filing_date AS d, 1 AS f, 0 AS c FROM facts UNION ALL SELECT outcome_date, 0, 1 FROM facts WHERE outcome_date IS NOT NULL) SELECT strftime(d, '%Y-%m') AS month, CAST(sum(f) AS BIGINT) AS filed, CAST(sum(c) AS BIGINT) AS closed FROM x GROUP BY 1")
def monthly_flow(s, d):
    return mining.monthly_flow(_facts(s, d))


@query(C + "SELECT office, count(*) AS n FROM cases GROUP BY office")
def office_distribution(s, d):
    return mining.distribution(cases(s, d), "office")


@query(_FACTS + "SELECT visa_office, count(*) AS n FROM facts GROUP BY visa_office")
def visa_office_distribution(s, d):
    return mining.distribution(_facts(s, d), "visa_office")


@query(_FACTS + "SELECT status, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM facts GROUP BY status")
def outcome_distribution(s, d):
    return mining.outcome_distribution(_facts(s, d))


@query(_FACTS + "SELECT count(*) AS mandamus_cases, count(*) FILTER (status = 'Discontinued') AS discontinued, round(avg(CASE WHEN status = 'Discontinued' THEN 1.0 ELSE 0.0 END), 6) AS rate FROM facts WHERE case_type = 'Mandamus'")
def implicit_success_rate(s, d):
    return mining.implicit_success(_facts(s, d))


@query(_FACTS + "SELECT count(*) AS cases, count(*) FILTER (leave_granted) AS granted, round(avg(CASE WHEN leave_granted THEN 1.0 ELSE 0.0 END), 6) AS rate FROM facts")
def leave_grant_rate(s, d):
    return mining.leave_rate(_facts(s, d))


@query(_FACTS + "SELECT court_office, round(avg(outcome_date - filing_date), 4) AS mean_close_days, count(*) AS closed_cases FROM facts WHERE status <> 'Ongoing' GROUP BY court_office")
def office_heatmap(s, d):
    return mining.office_heatmap(_facts(s, d))


@query(_FACTS + f"SELECT count(*) AS total, count(*) FILTER (status = 'Ongoing') AS ongoing, count(*) FILTER (status <> 'Ongoing') AS closed, round(avg(outcome_date - filing_date) FILTER (status <> 'Ongoing' AND case_type = 'Mandamus'), 4) AS mandamus_close_days, round(avg(outcome_date - filing_date) FILTER (status <> 'Ongoing' AND case_type = 'Other'), 4) AS other_close_days, round(avg(DATE '{AS_OF}' - filing_date) FILTER (status = 'Ongoing'), 4) AS mean_age_days FROM facts")
def summary_report(s, d):
    return mining.summary(_facts(s, d), AS_OF)


@query(_FACTS + f"SELECT visa_office, count(*) AS n, round(avg(DATE '{AS_OF}' - filing_date), 4) AS mean_age_days FROM facts WHERE status = 'Ongoing' GROUP BY visa_office")
def mean_age_by_visa_office(s, d):
    return mining.mean_age_by(_facts(s, d), AS_OF)


@query(C + "SELECT case_id, filing_date FROM cases WHERE case_type <> '1-URGENT'")
def still_to_enrich(s, d):
    c = cases(s, d)
    return mining.still_to_enrich(c.select("case_id", "filing_date"), c.where("case_type = '1-URGENT'").select("case_id", "filing_date"))


# --- projections, exports, clean-up -------------------------------------------------------------------------------------

_UNDATED = "SELECT * REPLACE (CASE WHEN case_type LIKE '5%' THEN NULL ELSE filing_date END AS filing_date) FROM cases"


def _undated(s, d):
    return cases(s, d).withColumn("filing_date", F.when(~F.col("case_type").like("5%"), F.col("filing_date")))


@query(C + f"SELECT case_id, filing_date FROM ({_UNDATED}) WHERE filing_date IS NOT NULL")
def clean_cases(s, d):
    return mining.clean(_undated(s, d)).select("case_id", "filing_date")


@query(C + f"SELECT case_id, filing_date IS NULL AS no_filing_date FROM ({_UNDATED})")
def flagged_cases(s, d):
    return mining.clean(_undated(s, d), drop=False).select("case_id", "no_filing_date")


@query(C + "SELECT case_id, CASE WHEN language = 'English' THEN 'HTML ' || office ELSE office END AS office, language FROM cases")
def header_or_html(s, d):
    page = F.when(F.col("language") == "English", F.concat(F.lit("<p><strong>Office:</strong> HTML "), "office", F.lit("</p>"))).otherwise("<p>nothing</p>")
    found = cases(s, d).select("case_id", html.cleaned_header(page, {"office": F.col("office"), "language": F.col("language")}).alias("h"))
    return found.select("case_id", "h.*")


@query(C + ", x AS (SELECT case_id, [style_of_cause, '', office, language] AS c FROM cases), y AS (SELECT case_id, unnest(c) AS t, unnest([1, 2, 3, 4]) AS i FROM x), z AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY length(t), i) AS up, row_number() OVER (PARTITION BY case_id ORDER BY length(t) DESC, i) AS down FROM y WHERE t <> '') SELECT case_id, max(t) FILTER (down = 1) AS longest, max(t) FILTER (up = 1) AS shortest, max(t) FILTER (up = 2) AS second FROM z GROUP BY case_id")
def longest_and_shortest(s, d):
    return cases(s, d).select("case_id", records.longest_and_shortest(F.array("style_of_cause", F.lit(""), "office", "language")).alias("r")).select("case_id", "r.*")


@query(C + "SELECT case_id, case_type, action_type, filing_date, office, style_of_cause, language FROM cases")
def allowed_fields(s, d):
    return records.allowed(cases(s, d).withColumn("secret", F.lit(1)))


@query(CE + "SELECT c.case_id, c.office, count(e.doc_id) AS n_entries, '2025-01-02 03:04:05' AS stamped FROM cases c LEFT JOIN entries e ON e.case_id = c.case_id GROUP BY ALL")
def case_payload(s, d):
    made = sinks.payload(store.nest(cases(s, d), entries(s, d)), F.lit("2025-01-02 03:04:05").cast("timestamp_ntz"))
    return made.select("case.case_id", "case.office", F.size("docket_entries").cast("long").alias("n_entries"), F.col("scraped_at").cast("string").alias("stamped"))


@query("SELECT p_partkey, replace(p_name || '/' || p_type, '/', '_') AS safe FROM part")
def path_safe_names(s, d):
    return table(s, d, "part").select("p_partkey", ids.path_safe(F.concat("p_name", F.lit("/"), "p_type")).alias("safe"))


@query(C + "SELECT case_id, strftime(scraped_at, '%Y%m%d_%H%M%S') AS stamp FROM cases")
def time_stamps(s, d):
    return cases(s, d).select("case_id", ids.stamp(F.col("scraped_at")).alias("stamp"))


@query(f"SELECT 'IMM-' || page_id || '-25' AS case_id, {_TITLE} AS style_of_cause, 'Web' AS office, DATE '2025-01-01' AS filing_date, url, md5(html) AS html_content FROM pages")
def pages_as_cases(s, d):
    made = records.cases_from_pages(table(s, d, "pages"), ids.format_number("page_id", 2025), html.page_title("html"), F.lit("Web"), F.lit("2025-01-01"))
    return made.withColumn("html_content", F.md5(F.col("html_content").cast("binary")))


@query(C + "SELECT case_id FROM (SELECT case_id, row_number() OVER (ORDER BY scraped_at DESC, case_id) AS r FROM cases) WHERE r > 25")
def exports_beyond_newest(s, d):
    files = cases(s, d).select(F.col("case_id").alias("path"), F.col("scraped_at").alias("modificationTime"))
    return sinks.beyond_newest(files, 25).select(F.col("path").alias("case_id"))


@query(_STORE + "SELECT count(*) AS successful, 0 AS failed, count(*) FILTER (case_id NOT IN (SELECT case_id FROM target)) AS new, count(*) FILTER (case_id IN (SELECT case_id FROM target)) AS updated FROM source")
def export_totals(s, d):
    target, source = _store(s, d)
    return records.export_plan(source, target, F.lit("2025-01-02 03:04:05").cast("timestamp"))["totals"]


@query(_STORE + "SELECT coalesce(c.case_id, t.case_id) AS case_id, coalesce(c.office, t.office) AS office FROM target t FULL JOIN clean c ON t.case_id = c.case_id")
def export_new_state(s, d):
    target, source = _store(s, d)
    return records.export_plan(source, target, F.lit("2025-01-02 03:04:05").cast("timestamp"))["cases"].select("case_id", "office")


@query(_PURGE + f"SELECT case_id FROM cases WHERE {_SUFFIX.format('case_id')} = 2026")
def purge_by_number(s, d):
    return purge.doomed(_purged(s, d)[0], 2026, by="id").select("case_id")


@query(_PURGE + f", g AS (SELECT case_id FROM cases WHERE {_GONE}), f AS (SELECT p_name AS path, CASE WHEN p_size < 25 THEN 'output' ELSE 'modal_html' END AS kind FROM part) SELECT 2027 AS year, true AS dry_run, (SELECT count(*) FROM g) AS cases_deleted, (SELECT count(*) FROM f WHERE kind = 'output') AS output_files, (SELECT count(*) FROM f WHERE kind = 'modal_html') AS modal_html_files, (SELECT min(path) FROM f WHERE kind = 'output') AS first_output")
def purge_file_audit(s, d):
    c, e = _purged(s, d)
    files = table(s, d, "part").select(F.col("p_name").alias("path"), F.when(F.col("p_size") < 25, "output").otherwise("modal_html").alias("kind"))
    return purge.audit(c, e, 2027, files=files, dry_run=True).select("year", "dry_run", "cases_deleted", "output_files", "modal_html_files", F.get("first_output", F.lit(0)).alias("first_output"))


#: Dates and times of the results, which are handed out as ISO texts so that every reader compares them alike.
TIMES = {
    "case_year_stats": ["last_scraped"],
    "case_stats_by_year": ["last_scraped"],
    "cases_by_suffix_year": ["filing_date"],
    "cases_of_year": ["filing_date"],
    "recent_cases": ["filing_date", "scraped_at"],
    "cases_past_newest": ["scraped_at"],
    "upsert_cases": ["scraped_at"],
    "insert_ignore_entries": ["entry_date"],
    "insert_update_entries": ["entry_date"],
    "unnested_entries": ["entry_date"],
    "orphan_entries": ["entry_date"],
    "cases_without_entries": ["filing_date"],
    "case_dict": ["date", "filing_date", "scraped_at"],
    "skipped_numbers": ["run_id"],
    "clean_cases": ["filing_date"],
    "allowed_fields": ["filing_date"],
    "pages_as_cases": ["filing_date"],
    "entry_dict": ["entry_date"],
    "entries_from_records": ["entry_date"],
    "alias_resolved": ["filing_date"],
    "purge_kept_cases": ["filing_date"],
    "purge_kept_entries": ["entry_date"],
    "purge_dry_run": ["filing_date"],
    "run_totals": ["run_id"],
    "batch_audit": ["run_id"],
    "running_success_rate": ["run_id"],
    "failure_streaks": ["run_id"],
    "emergency_stops": ["run_id"],
    "exhausted_runs": ["run_id"],
    "capped_runs": ["run_id"],
    "run_log_lines": ["run_id"],
    "html_entries_roundtrip": ["entry_date"],
    "html_header_roundtrip": ["filing_date"],
    "table_selection": ["entry_date"],
    "header_dates": ["parsed"],
    "entry_dates": ["parsed"],
    "case_status": ["outcome_date", "rule9_date"],
    "case_details": ["filing_date", "outcome_date"],
    "still_to_enrich": ["filing_date"],
}


def _as_text(f: Callable[[SparkSession, str], DataFrame], names: list[str]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda s, d: f(s, d).withColumns({c: F.col(c).cast("string") for c in names})


for _name, _columns in TIMES.items():
    QUERIES[_name] = _as_text(QUERIES[_name], _columns)
    ORACLES[_name] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _columns)}) FROM ({ORACLES[_name]})"
