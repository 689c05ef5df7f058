"""Look-ups, store, purge, runs, analytics and checks on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from docketloom.operators import lookup, mining, purge, runs, store, validate
from docketloom.sources import readers


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def cases(spark):
    data = [("IMM-998-25", date(2025, 1, 1), datetime(2025, 2, 1)), ("IMM-1000-25", date(2025, 3, 1), None), ("IMM-5-24", date(2025, 1, 5), datetime(2024, 1, 1)), ("IMM-7-2025", None, datetime(2023, 1, 1)), ("odd", None, datetime(2025, 5, 5)), (None, None, datetime(2025, 6, 6)), ("IMM-9-1925", date(1925, 1, 1), None)]
    return spark.createDataFrame(data, "case_id string, filing_date date, scraped_at timestamp_ntz")


def test_last_case_by_number_and_by_text(cases):
    assert lookup.last_case(cases, 2025).first()["case_id"] == "IMM-1000-25"
    assert lookup.last_case(cases, 2025, "lexical").first()["case_id"] == "IMM-998-25"
    assert lookup.last_case(cases, 2030).count() == 0
    assert tuple(lookup.year_stats(cases, 2030).first()) == (2030, 0, None)


def test_next_numbers(spark, cases):
    assert [r["case_id"] for r in readers.next_numbers(cases, 2025, 3).orderBy("sequence").collect()] == ["IMM-1001-25", "IMM-1002-25", "IMM-1003-25"]
    assert [r["case_id"] for r in readers.next_numbers(cases.where("false"), 2025, 3).orderBy("sequence").collect()] == ["IMM-1-25", "IMM-2-25", "IMM-3-25"]
    assert [r["case_id"] for r in readers.numbers(spark, 2025, 30, 50).orderBy("sequence").collect()][-1] == "IMM-79-25"


def test_recent_cases_put_unknown_times_last(cases):
    got = [r["case_id"] for r in lookup.recent_cases(cases.withColumns({"case_type": F.lit(""), "office": F.lit("")}), 7).collect()]
    assert got[:3] == [None, "odd", "IMM-998-25"] and set(got[-2:]) == {"IMM-1000-25", "IMM-9-1925"}


def test_year_predicate_branches(spark, cases):
    assert {r["case_id"] for r in purge.doomed(cases, 2025).collect()} == {"IMM-998-25", "IMM-1000-25", "IMM-5-24", "IMM-7-2025"}
    assert {r["case_id"] for r in purge.doomed(cases, 2025, by="id").collect()} == {"IMM-998-25", "IMM-1000-25", "IMM-7-2025"}
    bare = cases.drop("filing_date")
    assert {r["case_id"] for r in purge.doomed(bare, 2025).collect()} == {"IMM-998-25", "IMM-1000-25", "IMM-7-2025", "odd", None}
    only_times = spark.createDataFrame([("1", "2025-01-01"), ("2", "2025-02-02"), ("3", "2024-03-03"), ("4", None)], "id string, scraped_at string")
    assert rows(purge.doomed(only_times, 2025).select("id")) == [("1",), ("2",)]


def test_purge_cascade_and_dry_run(spark):
    c = spark.createDataFrame([("IMM-1-22", "2022-05-01T00:00:00"), ("IMM-2-23", "2023-06-01T00:00:00")], "case_id string, scraped_at string")
    e = spark.createDataFrame([("IMM-1-22", 1), ("IMM-2-23", 1), ("IMM-2-23", 2)], "case_id string, doc_id int")
    out = purge.purge(c, e, 2023, dry_run=False)
    assert rows(out["cases"].select("case_id")) == [("IMM-1-22",)] and rows(out["entries"]) == [("IMM-1-22", 1)]
    a = out["audit"].first()
    assert (a["cases_deleted"], a["entries_deleted"], a["first_case_ids"]) == (1, 2, ["IMM-2-23"])
    assert purge.purge(c, e, 2023)["cases"].count() == 2
    none = purge.purge(c, e, 1999, dry_run=False)["audit"].first()
    assert (none["cases_deleted"], none["entries_deleted"], none["first_case_ids"]) == (0, 0, [])
    with pytest.raises(ValueError, match="exclude"):
        purge.purge(c, e, 2023, files_only=True, db_only=True)


def test_upsert_and_status(spark):
    target = spark.createDataFrame([("a", "old", 1), ("b", "old", 1)], "case_id string, office string, t int")
    source = spark.createDataFrame([("b", "new", 2), ("c", "first", 1), ("c", "last", 3), (None, "x", 9), ("c", "mid", 2)], "case_id string, office string, t int")
    assert rows(store.upsert(target, source, order=["t"])) == [("a", "old", 1), ("b", "new", 2), ("c", "last", 3)]
    assert tuple(store.save_totals(store.upsert_status(target, source)).first()) == (4, 1, 3, 1)
    assert rows(store.upsert(target, source.where("false"))) == rows(target)


def test_insert_ignore_and_update(spark):
    ddl = "case_id string, doc_id int, summary string"
    target, source = spark.createDataFrame([("a", 1, "old")], ddl), spark.createDataFrame([("a", 1, "new"), ("a", 2, "y"), ("a", 2, "x"), ("b", None, "z")], ddl)
    assert rows(store.insert_entries(target, source)) == [("a", 1, "old"), ("a", 2, "x")]
    assert rows(store.insert_entries(target, source, "update")) == [("a", 1, "new"), ("a", 2, "x")]


def test_nest_and_unnest(spark):
    c = spark.createDataFrame([("a",), ("b",)], "case_id string")
    e = spark.createDataFrame([("a", 2, "y"), ("a", 1, None)], "case_id string, doc_id int, summary string")
    nested = store.nest(c, e)
    assert {r["case_id"]: len(r["docket_entries"]) for r in nested.collect()} == {"a": 2, "b": 0}
    assert [(r["position"], r["doc_id"]) for r in store.unnest(nested).orderBy("position").collect()] == [(0, 1), (1, 2)]
    assert store.orphans(e, c.where("case_id = 'b'")).count() == 2 and rows(store.without_entries(c, e)) == [("b",)]


def test_unique_stems(spark):
    new = spark.createDataFrame([("1", "s"), ("2", "s"), ("3", "t")], "case_id string, stem string")
    have = spark.createDataFrame([("s",), ("s-1",)], "stem string")
    assert rows(store.unique_stems(new, have).select("case_id", "unique_stem")) == [("1", "s-2"), ("2", "s-3"), ("3", "t")]


def test_streaks_stop_and_retries(spark):
    word = {"s": "success", "f": "failed", "k": "skipped"}
    text = "ffsf" + "fk" * 10 + "sf"
    e = spark.createDataFrame([("r", i, f"IMM-{i % 20}-25", word[c]) for i, c in enumerate(text)], "run_id string, seq long, case_number string, outcome string")
    streak = worst = 0
    stop = None
    for i, c in enumerate(text):
        streak = streak + 1 if c == "f" else streak if c == "k" else 0
        worst = max(worst, streak)
        if c == "f" and streak >= 10 and stop is None:
            stop = i
    got = runs.emergency_stops(e).first()
    assert (got["longest"], got["stop_seq"]) == (worst, stop)
    last = {f"IMM-{i % 20}-25": word[c] for i, c in enumerate(text)}
    assert {r["case_number"] for r in runs.retry_candidates(e).collect()} == {k for k, v in last.items() if v == "failed"}
    assert runs.capped(e, 1).count() == 3
    assert [r["rate"] for r in runs.success_rate(e, 4).orderBy("seq").collect()][0] == 25.0
    lines = [r["value"] for r in runs.run_log(e).orderBy("seq").collect()]
    assert lines[0].startswith('{"event":"start"') and lines[1] == '{"case_number":"IMM-0-25","outcome":"failed"}' and '"total":26' in lines[-1]


def test_case_facts(spark):
    c = spark.createDataFrame([("a", "X v Y", date(2024, 1, 1), "Ottawa"), ("b", "to Compel", date(2024, 1, 1), "Toronto"), ("c", None, None, None)], "case_id string, style_of_cause string, filing_date date, office string")
    e = spark.createDataFrame(
        [("a", 1, date(2024, 3, 1), "Dismissed"), ("a", 2, date(2024, 5, 1), "Application granted before Justice Smith"), ("a", 3, date(2024, 4, 1), "Leave GRANTED, file from New Delhi"), ("a", 4, None, "from Ankara"), ("b", 1, None, "NOTICE OF DISCONTINUANCE"), ("b", 2, date(2024, 2, 1), "Rule 9 received"), ("c", 1, None, None)],
        "case_id string, doc_id int, entry_date date, summary string",
    )
    f = mining.facts(c, e)
    got = {r["case_id"]: r for r in f.collect()}
    assert (got["a"]["status"], got["a"]["outcome_date"], got["a"]["visa_office"], got["a"]["judge"], got["a"]["case_type"], got["a"]["leave_granted"]) == ("Granted", date(2024, 4, 1), "New Delhi", "Smith", "Other", True)
    assert (got["b"]["status"], got["b"]["outcome_date"], got["b"]["case_type"], got["b"]["rule9_date"]) == ("Discontinued", None, "Mandamus", date(2024, 2, 1))
    assert (got["c"]["status"], got["c"]["visa_office"]) == ("Ongoing", None)
    assert rows(mining.durations(f, "2024-06-01").select("case_id", "metric", "days")) == [("a", "time_to_close", 91), ("b", "rule9_wait", 31)]
    assert mining.implicit_success(f).first()["rate"] == 1.0 and mining.clean(c).count() == 2 and mining.clean(c, drop=False).count() == 3
    assert mining.implicit_success(f.where("false")).first()["rate"] is None


def test_checks(spark):
    c = spark.createDataFrame([("IMM-1-25",), ("",), (None,), ("T-1",)], "case_id string")
    assert [(r["valid"], r["warning"] is not None) for r in validate.check_export(c).collect()] == [(True, False), (False, False), (False, False), (True, True)]
    with pytest.raises(Exception, match="without an id"):
        validate.check_export(c, strict=True).collect()
    urls = [("https://www.fct-cf.ca/en/court-files-and-decisions/IMM-1-22", True), ("", False), ("not-a-url", False), ("https://example.com/en/court-files-and-decisions", False), ("https://www.fct-cf.ca/efiling/login", False), ("https://www.fct-cf.ca/en/court-files-and-decisions/login", False), (None, False), ("http://[bad", False)]
    got = spark.createDataFrame([(u,) for u, _ in urls], "url string").select(validate.valid_url("url").alias("v")).collect()
    assert [r["v"] for r in got] == [v for _, v in urls]


def test_records(spark):
    from docketloom.operators import records

    loose = spark.createDataFrame([("7", "IMM-1-25", "3", "2025-01-02", "O", "s"), (None, "IMM-1-25", "", "02/01/2025", None, None), ("x", "IMM-1-25", "y", None, "", "t")], "id string, court_file_no string, id_from_table string, date_filed string, office string, recorded_entry_summary string")
    assert [tuple(r) for r in records.entries_from_records(loose).collect()] == [(7, "IMM-1-25", 3, date(2025, 1, 2), "O", "s"), (None, "IMM-1-25", 0, None, None, None), (None, "IMM-1-25", 0, None, None, "t")]
    head = spark.createDataFrame([("a", "", None, "x"), ("b", "own", "n", "y")], "case_id string, style_of_cause string, nature_of_proceeding string, secret string")
    found = spark.createDataFrame([("a", "from search", "nature"), ("b", "other", "other")], "case_id string, style_of_cause string, nature_of_proceeding string")
    assert rows(records.allowed(records.fill_from(head, found))) == [("a", "nature", "from search"), ("b", "n", "own")]
    assert rows(records.legacy_names(head.withColumn("office", F.lit(None).cast("string")))) == [("a", "", ""), ("b", "own", "")]
    row = spark.createDataFrame([(["Style of Cause", "Court File No.", "X"], ["A v B", "IMM-1-25", "appeal"]), ([], ["IMM-2-25", "C v D"])], "h array<string>, c array<string>").select(records.search_row("h", "c").alias("r"), records.longest_and_shortest("c").alias("l")).collect()
    assert tuple(row[0]["r"]) == ("IMM-1-25", "A v B", "appeal") and tuple(row[1]["r"]) == ("IMM-2-25", "C v D", None)
    assert tuple(row[0]["l"]) == ("IMM-1-25", "A v B", "appeal")
    texts = [("IMM-5-25 Style of Cause: X v Y  Nature of Proceeding: review", ("IMM-5-25", "X v Y", "review")), ("IMM-5-25 - X v Y nature of proceeding - review", ("IMM-5-25", "X v Y", "review")), ("nothing", (None, None, None))]
    assert [tuple(r[0]) for r in spark.createDataFrame([(t,) for t, _ in texts], "t string").select(records.free_text_fields("t")).collect()] == [w for _, w in texts]
    pages = spark.createDataFrame([("u", "<p>")], "url string, html string")
    assert rows(records.cases_from_pages(pages, F.lit("IMM-1-25"), F.lit("t"), F.lit("c"), F.lit("2025-01-01"))) == [("IMM-1-25", "t", "c", date(2025, 1, 1), "u", "<p>")]
    stored = spark.createDataFrame([("a", "old")], "case_id string, office string")
    plan = records.export_plan(spark.createDataFrame([("a", "new"), ("", "bad"), ("b", "x")], "case_id string, office string"), stored, F.lit("2025-01-02 03:04:05").cast("timestamp"))
    assert rows(plan["cases"]) == [("a", "new"), ("b", "x")] and plan["rejected"].count() == 1 and tuple(plan["totals"].first()) == (2, 1, 1, 1) and plan["file"].first()["name"] == "cases_export_20250102_030405.json"
