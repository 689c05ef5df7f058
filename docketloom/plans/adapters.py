"""The test tables as cases, docket entries and run outcomes, and the same as SQL for oracles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entry texts by l_partkey modulo 20; other remainders get a neutral text.
PHRASES = {
    0: "Notice of Discontinuance filed",
    1: "Leave Granted by the Court",
    2: "Application Dismissed",
    3: "Application for mandamus",
    4: "Rule 9 reasons received",
    5: "Motion to compel a decision",
}
#: Visa offices by l_suppkey modulo 8; other remainders name none.
OFFICES = {0: "Beijing", 1: "Ankara", 2: "New Delhi", 3: "Lagos"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(date: str = "o_orderdate") -> Column:
    return F.concat(F.lit("IMM-"), F.col("o_orderkey").cast("string"), F.lit("-"), F.substring(F.year(date).cast("string"), 3, 2))


def cases(spark: SparkSession, sf_dir: str, shift_months: int = 0) -> DataFrame:
    """Cases from orders, customers and nations. ``shift_months`` moves the dates, and with them the ids."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", F.add_months(F.col("o_orderdate").cast("date"), shift_months).alias("filing_date"), "o_orderdate")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey").join(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    return orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        _id("filing_date").alias("case_id"), F.col("o_orderpriority").alias("case_type"), F.col("o_orderstatus").alias("action_type"), "filing_date", F.col("n_name").alias("office"), F.col("c_name").alias("style_of_cause"),
        F.when(F.col("c_nationkey") % 2 == 0, "English").otherwise("French").alias("language"), F.col("o_orderdate").alias("scraped_at"),
    )


def _mapped(key: Column, values: dict[int, str], default: Column | None) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for k, v in values.items():
        out = out.when(key == k, F.lit(v))
    return out if default is None else out.otherwise(default)


def entries(spark: SparkSession, sf_dir: str, shift_months: int = 0) -> DataFrame:
    """Docket entries from line items. (case_id, doc_id) is not unique. ``shift_months`` moves the dates in the ids, as in ``cases``."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_shipdate")
    ids = table(spark, sf_dir, "orders").select("o_orderkey", F.add_months(F.col("o_orderdate").cast("date"), shift_months).alias("filed")).select("o_orderkey", _id("filed").alias("case_id"))
    plain = F.concat(F.lit("Entry "), F.col("l_returnflag"), F.lit(" "), F.col("l_partkey").cast("string"))
    office = F.coalesce(F.concat(F.lit(" from "), _mapped(F.col("l_suppkey") % 8, OFFICES, None)), F.lit(""))
    return lines.join(ids, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "case_id", F.col("l_linenumber").alias("doc_id"), F.col("l_shipdate").cast("date").alias("entry_date"), F.col("l_linestatus").alias("entry_office"), F.concat(_mapped(F.col("l_partkey") % 20, PHRASES, plain), office).alias("summary"),
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of collection runs, one run a day, from events."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    outcome = F.when(F.col("event_type") == "purchase", "success").when(F.col("event_type") == "signup", "skipped").otherwise("failed")
    return e.select(F.col("ts").cast("date").alias("run_id"), F.col("event_id").alias("seq"), "ts", F.concat(F.lit("IMM-"), F.col("user_id").cast("string"), F.lit("-25")).alias("case_number"), outcome.alias("outcome"))


def _sql_map(key: str, values: dict[int, str], default: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in values.items()) + f" ELSE {default} END"


SQL_CASES = """cases AS (SELECT 'IMM-' || o_orderkey || '-' || right(CAST(year(o_orderdate) AS VARCHAR), 2) AS case_id, o_orderpriority AS case_type, o_orderstatus AS action_type,
  CAST(o_orderdate AS DATE) AS filing_date, n_name AS office, c_name AS style_of_cause, CASE WHEN c_nationkey % 2 = 0 THEN 'English' ELSE 'French' END AS language, o_orderdate AS scraped_at
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
SQL_ENTRIES = f"""entries AS (SELECT 'IMM-' || o_orderkey || '-' || right(CAST(year(o_orderdate) AS VARCHAR), 2) AS case_id, l_linenumber AS doc_id, CAST(l_shipdate AS DATE) AS entry_date, l_linestatus AS entry_office,
  {_sql_map("l_partkey % 20", PHRASES, "'Entry ' || l_returnflag || ' ' || l_partkey")} || {_sql_map("l_suppkey % 8", {k: f" from {v}" for k, v in OFFICES.items()}, "''")} AS summary
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
SQL_OUTCOMES = """outcomes AS (SELECT CAST(ts AS DATE) AS run_id, event_id AS seq, ts, 'IMM-' || user_id || '-25' AS case_number,
  CASE event_type WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'skipped' ELSE 'failed' END AS outcome FROM events)"""
