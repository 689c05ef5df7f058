"""Sources: exported files, lists, listings of artifacts, databases, number generators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..schema import CASE_DDL, ENTRY_DDL, RUN_EVENT_DDL


def read_case_array(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    """An exported file that holds one JSON array of cases, with nested entries; dates in ISO form."""
    entry = ENTRY_DDL.replace(" ", ":").replace(",:", ",")
    return spark.read.schema(ddl or f"{CASE_DDL}, case_number string, title string, court string, date date, docket_entries array<struct<{entry}>>").option("multiLine", True).json(path)


def read_case_files(spark: SparkSession, path: str) -> DataFrame:
    """The files of single cases under their year folders; the folder is the column ``year``."""
    entry = ENTRY_DDL.replace(" ", ":").replace(",:", ",")
    return spark.read.schema(f"{CASE_DDL}, docket_entries array<struct<{entry}>>, year int").json(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """A run log, one JSON record to a line."""
    return spark.read.schema(f"event string, {RUN_EVENT_DDL}").json(path)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """A list of addresses: blank lines and lines that start with a number sign are left out, the rest is trimmed."""
    lines = spark.read.text(path)
    return lines.where(~F.col("value").startswith("#") & (F.trim(F.regexp_replace("value", r"\s+", " ")) != "")).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("url"))


def _listed(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "modificationTime", "length")


def export_files(spark: SparkSession, root: str) -> DataFrame:
    """JSON files right in the output folder, by path; the contents are not read."""
    depth = len(root.rstrip("/").split("://")[-1].split(":")[-1].split("/")) + 1
    return _listed(spark, root, "*.json").where(F.size(F.split(F.regexp_replace("path", r"^\w+:/*", "/"), "/")) == depth).orderBy("path")


def year_artifacts(spark: SparkSession, root: str, year: int) -> DataFrame:
    """Files under ``root/<year>`` and ``root/<folder>/<year>``."""
    inside = F.substring_index(F.col("path"), root.rstrip("/") + "/", -1)
    parts = F.split(inside, "/")
    return _listed(spark, root, "*").where((F.get(parts, F.lit(0)) == str(year)) | ((F.get(parts, F.lit(1)) == str(year)) & (F.size(parts) > 2))).withColumn("kind", F.lit("output"))


def year_html_logs(spark: SparkSession, root: str, year: int) -> DataFrame:
    """HTML files right in the log folder whose name holds the year."""
    name = F.element_at(F.split("path", "/"), -1)
    inside = F.substring_index(F.col("path"), root.rstrip("/") + "/", -1)
    return _listed(spark, root, "*").where(F.contains(name, F.lit(str(year))) & F.lower(name).rlike(r"\.html?$") & ~F.contains(inside, F.lit("/"))).withColumn("kind", F.lit("modal_html"))


def read_database(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query against a database; filters and columns are pushed down. Large tables take ``partitionColumn``, its bounds and
    ``numPartitions``, so that many tasks read them; for that the query goes in as a derived table."""
    return spark.read.format("jdbc").options(url=url, dbtable=f"({query}) t", **options).load()


def numbers(spark: SparkSession, year: int, start: int = 1, count: int = 10_000) -> DataFrame:
    """``count`` case numbers of a year, from ``start`` on."""
    return spark.range(start, start + count).select(F.col("id").alias("sequence"), ids.format_number("id", year).alias("case_id"))


def next_numbers(cases: DataFrame, year: int, count: int = 1_000) -> DataFrame:
    """``count`` case numbers after the last stored one of the year; from 1 if there is none. Nothing is collected: the last
    sequence, one row, joins the offsets."""
    spark = cases.sparkSession
    last = cases.where(ids.like_year("case_id", year)).agg(F.coalesce(F.max(ids.sequence_of("case_id")), F.lit(0)).alias("last"), F.lit(0).alias("one"))
    offsets = spark.range(1, count + 1).select(F.col("id"), F.lit(0).alias("one"))
    return offsets.join(F.broadcast(last), "one").select((F.col("last") + F.col("id")).alias("sequence"), ids.format_number(F.col("last") + F.col("id"), year).alias("case_id"))
