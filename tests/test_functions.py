"""Case numbers, names, dates and HTML on hand-made rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from docketloom.functions import dates, html, ids
from docketloom.schema import resolve_aliases


def one(spark, expr, **values):
    ddl = ", ".join(f"{k} {'string' if not isinstance(v, int) else 'long'}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], ddl).select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize(("n", "year", "want"), [(1, 2025, "IMM-1-25"), (12345, 2003, "IMM-12345-03"), (7, 2100, "IMM-7-00")])
def test_format(spark, n, year, want):
    assert one(spark, ids.format_number("n", year), n=n) == want


@pytest.mark.parametrize(("text", "sequence", "year", "strict"), [("IMM-9998-97", 9998, 2097, 2097), ("IMM-1-2024", 1, 2024, None), ("IMM-x-25", None, 2025, None), ("T-5-25", None, 2025, None), ("IMM-5", None, None, None), ("", None, None, None), (None, None, None, None), ("IMM-1-2-25", None, 2025, None)])
def test_parts(spark, text, sequence, year, strict):
    assert one(spark, ids.sequence_of("t"), t=text) == sequence
    assert one(spark, ids.suffix_year("t"), t=text) == year
    assert one(spark, ids.strict_year("t"), t=text) == strict


@pytest.mark.parametrize(("text", "safe", "plain"), [("IMM-1/25", "IMM-1-25", "IMM-1_25"), ("  weird ## name  ", "weird-name", "__weird____name__"), ("", "case", ""), ("__-", "case", "__-"), ("a--b", "a-b", "a--b"), ("é.x", ".x", "_.x")])
def test_names(spark, text, safe, plain):
    assert one(spark, ids.safe_name("t"), t=text) == safe
    assert one(spark, ids.plain_name("t"), t=text) == plain


@pytest.mark.parametrize(
    ("text", "header", "entry"),
    [
        ("2025-01-02", date(2025, 1, 2), date(2025, 1, 2)), ("20250102", date(2025, 1, 2), date(2025, 1, 2)), ("2025-1-2", date(2025, 1, 2), date(2025, 1, 2)), ("03-04-2025", date(2025, 4, 3), date(2025, 4, 3)), ("3/4/2025", date(2025, 4, 3), date(2025, 4, 3)),
        ("January 5, 2024", date(2024, 1, 5), date(2024, 1, 5)), ("5 January 2024", date(2024, 1, 5), date(2024, 1, 5)), ("2024/2/9", date(2024, 2, 9), date(2024, 2, 9)), ("Jan 5, 2024", None, date(2024, 1, 5)), ("5 Jan 2024", None, date(2024, 1, 5)),
        ("06-AUG-2025", None, date(2025, 8, 6)), ("filed 21-MAR-2025 in Ottawa", None, date(2025, 3, 21)), ("on 10/11/2025.", None, date(2025, 11, 10)), ("2025", None, None), ("2025-13-01", None, None), ("30-02-2025", None, None), ("", None, None), (None, None, None), ("no date", None, None),
    ],
)
def test_dates(spark, text, header, entry):
    assert one(spark, dates.header_date("t"), t=text) == header
    assert one(spark, dates.entry_date("t"), t=text) == entry


def test_strip_tags_and_title(spark):
    page = "<html><title>A\n B</title><script>var x='<b>';</script><style>p{}</style><!-- c --><p>one<br>two&nbsp; three </p>"
    assert one(spark, html.strip_tags("h"), h=page) == "A Bonetwo three"
    assert one(spark, html.page_title("h"), h=page) == "A B"
    assert one(spark, html.strip_tags("h"), h=None) is None


def test_label_is_not_an_attribute(spark):
    assert one(spark, html.label_value("h", "Type"), h='<input type="text"><p><strong>Type&nbsp;:</strong>&nbsp;Immigration</p>'.replace("&nbsp;:", " :")) == "Immigration"
    assert one(spark, html.label_value("h", "Type"), h='<input type="text">') is None


def test_header_precedence(spark):
    page = "<h5 class='modal-title'>Case IMM-7-25</h5><table><tr><td>Type of Action</td><td>from table</td></tr><tr><td>Court File Number</td><td>IMM-1-25</td></tr><tr><td>Office</td><td>Ottawa</td></tr></table><dl><dt>Type of Action</dt><dd>from list</dd><dt>Type</dt><dd>Immigration</dd></dl><p><strong>Office :</strong> Toronto</p>"
    got = one(spark, html.header_fields("h"), h=page).asDict()
    assert (got["case_id"], got["action_type"], got["case_type"], got["office"], got["language"]) == ("IMM-7-25", "from list", "Immigration", "Toronto", None)


@pytest.mark.parametrize(("office", "language", "want"), [("Toronto English", None, ("Toronto", "English")), ("Toronto", "Toronto English", ("Toronto", "English")), (None, "Quebec City French", ("Quebec City", "French")), ("English", None, ("English", None)), ("New  York\nen", "", ("New York", "en")), (None, None, (None, None)), ("Toronto English", "French", ("Toronto", "French"))])
def test_office_and_language(spark, office, language, want):
    assert tuple(one(spark, html.office_and_language("o", "g"), o=office, g=language)) == want


def test_the_real_table_is_selected(spark):
    template = (["#", "Date"], [["#", "YYYY-MM-DD"]], [])
    real = (["ID", "Document Date", "Office", "Summary"], [["1", "06-AUG-2025", "Ottawa", "Real entry A"], ["", " ", "", ""], ["2", "21-MAR-2025", "Ottawa", "Real entry B"], ["3", "21-MAR-2025", "Ottawa", "Real entry C"]], [])
    df = spark.createDataFrame([([template, real],)], f"tables array<{html.TABLE}>")
    got = df.select(html.best_table("tables").alias("t")).select(F.explode(html.mapped_entries("t")).alias("e")).select("e.*").collect()
    assert [(r.doc_id, r.entry_date, r.entry_office, r.summary) for r in got] == [(1, date(2025, 8, 6), "Ottawa", "Real entry A"), (3, date(2025, 3, 21), "Ottawa", "Real entry B"), (4, date(2025, 3, 21), "Ottawa", "Real entry C")]


def test_rows_without_known_headers_are_guessed(spark):
    t = ([], [["#", "some long text about a case", "7-JAN-2024", "Ottawa"], ["1", "x", "no date here at all", "Montreal"]], [])
    got = spark.createDataFrame([(t,)], f"t {html.TABLE}").select(F.explode(html.mapped_entries("t")).alias("e")).select("e.*").collect()
    assert [(r.entry_date, r.entry_office, r.summary) for r in got] == [(date(2024, 1, 7), "Ottawa", "some long text about a case"), (None, "x", "no date here at all")]


def test_entries_of_the_largest_body(spark):
    page = "<table><tbody><tr><td>9</td></tr></tbody></table><TABLE><tbody class=x><TR><th>no cells</th></TR><tr><td></td><td>2024-01-01</td><td>Ottawa</td><td>A <b>b</b></td></tr><tr><td>ID</td><td>d</td></tr><tr><td>5</td><td>x</td><td></td></tr></tbody></TABLE>"
    assert [tuple(e) for e in one(spark, html.table_entries("h"), h=page)] == [("2", "2024-01-01", "Ottawa", "A b"), ("5", "x", "", "x")]
    assert one(spark, html.table_entries("h"), h="<p>none<br>") == []


def test_empty_text_counts_as_missing(spark):
    df = spark.createDataFrame([("", "IMM-1-25", "a"), (None, "IMM-2-25", ""), ("IMM-3-25", "x", None)], "case_id string, court_file_no string, title string")
    assert [tuple(r) for r in resolve_aliases(df, keep_missing=False).collect()] == [("IMM-1-25", "a"), ("IMM-2-25", None), ("IMM-3-25", None)]


def test_columns_go_by_equal_headers_then_by_longest_words(spark):
    def at(headers, keys):
        df = spark.createDataFrame([(headers,)], "h array<string>")
        return df.select(html.column_of(F.col("h"), keys).alias("v")).first()["v"]

    assert at(["Recorded on", "Document Date", "Date"], html.DATE_KEYS) == 1
    assert at(["#", "The court office here", "Office"], html.OFFICE_KEYS) == 2
    assert at(["#", "x", "Their registry or office"], html.OFFICE_KEYS) == 2
    assert at(["#", "x"], html.OFFICE_KEYS) is None


def test_bold_paragraphs_outrank_later_sources_of_the_same_field(spark):
    page = "<p><strong>Language :</strong> French</p><dl><dt>Office</dt><dd>Toronto</dd><dt>Language</dt><dd>English</dd></dl><table><tr><td>Office</td><td>Ottawa</td></tr></table>"
    got = one(spark, html.header_fields("h"), h=page)
    assert (got["office"], got["language"]) == ("Toronto", "French")
