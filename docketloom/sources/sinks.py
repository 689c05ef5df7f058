"""Sinks: exports as JSON and CSV, payloads, logs, and the replacement of stored tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids

CASE_KEYS = ["case_id", "case_type", "action_type", "nature_of_proceeding", "filing_date", "office", "style_of_cause", "language", "url", "html_content", "scraped_at"]
_OPTIONS = {"ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd"}


def case_dict(cases: DataFrame) -> DataFrame:
    """The fifteen scalar fields of an exported case, legacy names included, and its entries, an empty list if it has none."""
    have = [F.col(c) if c in cases.columns else F.lit(None).cast("string").alias(c) for c in CASE_KEYS]
    legacy = [F.col(new).alias(old) for old, new in (("case_number", "case_id"), ("title", "style_of_cause"), ("court", "office"), ("date", "filing_date"))]
    entries = F.coalesce("docket_entries", F.array().cast(cases.schema["docket_entries"].dataType)).alias("docket_entries") if "docket_entries" in cases.columns else F.array().cast("array<string>").alias("docket_entries")
    return cases.select(*have, *legacy, entries)


def csv_row(cases: DataFrame) -> DataFrame:
    """The seven columns of the legacy CSV, as texts, empty for null."""
    source = {"case_id": "case_id", "case_number": "case_id", "title": "style_of_cause", "court": "office", "date": "filing_date", "html_content": "html_content", "scraped_at": "scraped_at"}
    return cases.select(*[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in cases.columns else F.lit("")).alias(k) for k, c in source.items()])


def entry_dict(entries: DataFrame) -> DataFrame:
    """The six fields of an exported entry; a missing ordinal is 0."""
    return entries.select((F.col("id") if "id" in entries.columns else F.lit(None)).cast("int").alias("id"), "case_id", F.coalesce(F.col("doc_id").cast("int"), F.lit(0)).alias("doc_id"), F.col("entry_date").cast("date").alias("entry_date"), "entry_office", "summary")


def payload(nested: DataFrame, at: Column) -> DataFrame:
    """``{case, docket_entries, scraped_at}``."""
    return nested.select(F.struct(*[c for c in nested.columns if c != "docket_entries"]).alias("case"), "docket_entries", at.alias("scraped_at"))


def require_rows(cases: DataFrame) -> DataFrame:
    if cases.isEmpty():
        raise ValueError("nothing to export")
    return cases


def write_json(cases: DataFrame, path: str) -> None:
    """Lines of JSON, one a case, nulls kept. The form for large exports."""
    require_rows(cases).write.mode("overwrite").options(**_OPTIONS).json(path)


def write_json_array(cases: DataFrame, path: str, most: int = 100_000) -> None:
    """One document, a JSON array, for exports of ``most`` cases at most: it passes through a single task."""
    rows = require_rows(cases).limit(most + 1)
    lines = rows.select(F.to_json(F.struct("*"), _OPTIONS).alias("j"))
    whole = lines.agg(F.when(F.count("*") > most, F.raise_error(F.lit(f"more than {most} cases: use write_json"))).otherwise(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("j")), ",\n"), F.lit("]"))).cast("string").alias("value"))
    whole.write.mode("overwrite").text(path)


def write_case_files(nested: DataFrame, path: str, today: Column, mode: str = "overwrite") -> None:
    """Cases in bulk under a folder for each year, which is replaced if it is there; other years stay as they are. Years are
    spread over tasks as the rows come, so no year waits for one task. ``write_each_case`` writes a file for each case."""
    year = ids.export_year("case_id", "filing_date", "scraped_at", today)
    stem = ids.file_stem("case_id", "filing_date", "scraped_at", today)
    nested.withColumn("file_stem", stem).withColumn("year", year).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("year").options(**_OPTIONS).json(path)


def write_each_case(nested: DataFrame, path: str, today: Column, suffixes: bool = False) -> int:
    """One JSON file for each case, ``<path>/<year>/<stem>.json``; how many. A file of that name is replaced; with ``suffixes``
    it stays and the new one gets ``-1``, ``-2``, ... Each file is written beside its place and then moved there by the task that
    has the case, so that a repeated task leaves the same files."""
    from ..operators import store

    spark = nested.sparkSession
    year, stem = ids.export_year("case_id", "filing_date", "scraped_at", today), ids.file_stem("case_id", "filing_date", "scraped_at", today)
    named = nested.select("case_id", F.concat_ws("/", year.cast("string"), stem).alias("stem"), F.to_json(F.struct("*"), _OPTIONS).alias("text"))
    if suffixes:
        there = [f"{f.getParent().getName()}/{f.getName().removesuffix('.json')}" for f in _glob(spark, f"{path}/*/*.json")]
        named = store.unique_stems(named, spark.createDataFrame([(x,) for x in there], "stem string")).withColumn("stem", F.coalesce("unique_stem", F.raise_error(F.lit("no free name for a case"))))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as files

        fs, root = files.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        for part in batches:
            for name, text in zip(part["stem"], part["text"], strict=True):
                fs.create_dir(f"{root}/{name.split('/')[0]}")
                beside = f"{root}/{name}.{uuid.uuid4().hex}.tmp"
                with fs.open_output_stream(beside) as out:
                    out.write(text.encode("utf-8"))
                if fs.type_name != "local" and fs.get_file_info(f"{root}/{name}.json").type != files.FileType.NotFound:
                    fs.delete_file(f"{root}/{name}.json")
                fs.move(beside, f"{root}/{name}.json")
            yield pd.DataFrame({"n": [len(part)]})

    return named.select("stem", "text").mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _glob(spark: SparkSession, pattern: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return [s.getPath() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, audits for instance, written whole from the driver."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def write_clean_csv(cases: DataFrame, entries: DataFrame, path: str) -> None:
    """The cleaned cases and entries as two CSV folders, null as empty."""
    for name, df in (("cases", cases), ("docket_entries", entries)):
        texts = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
        texts.write.mode("overwrite").options(header=True, escape='"', quoteAll=True, multiLine=True).csv(f"{path}/{name}")


def write_run_log(log: DataFrame, path: str) -> None:
    """A run log's lines, a file for each task, in the order of the run within a file."""
    log.repartition("run_id").sortWithinPartitions("run_id", "seq").select("value").write.mode("append").text(path)


def beyond_newest(files: DataFrame, keep: int = 10) -> DataFrame:
    """Export files that a clean-up removes: all but the ``keep`` newest. Only the newest pass through one task."""
    newest = files.orderBy(F.desc("modificationTime"), "path").limit(keep).select("path")
    return files.join(F.broadcast(newest), "path", "left_anti")


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"can't move {source} to {target}")


def recover(spark: SparkSession, path: str) -> None:
    """Put a table back that a ``swap`` had moved aside when it was cut off, and clear what such a swap left."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for old in sorted(_glob(spark, f"{path}.old-*"), key=lambda p: fs.getFileStatus(p).getModificationTime(), reverse=True):
        if fs.exists(place):
            fs.delete(old, True)
        else:
            _move(fs, old, place)


def swap(df: DataFrame, path: str) -> None:
    """Replace the table at ``path`` by ``df``, which may read it: write beside it, then move the old one aside and the new one
    in. If a step fails, the old table is put back; if the driver is lost in between, ``recover`` does that."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    new, old, place = hadoop.Path(f"{path}.new-{uuid.uuid4().hex}"), hadoop.Path(f"{path}.old-{uuid.uuid4().hex}"), hadoop.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.parquet(new.toString())
        there = fs.exists(place)
        if there:
            _move(fs, place, old)
        try:
            _move(fs, new, place)
        except Exception:
            if there:
                _move(fs, old, place)
            raise
    except Exception:
        fs.delete(new, True)
        raise
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def remove_year(spark: SparkSession, root: str, year: int) -> dict[str, int]:
    """Remove the folder of a year: it is moved out of the way first, so that nobody sees it half gone. Counts of files and folders."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place, gone = hadoop.Path(f"{root}/{year}"), hadoop.Path(f"{root}/{year}_to_delete_{uuid.uuid4().hex}")
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return {"removed_files": 0, "removed_dirs": 0}
    _move(fs, place, gone)
    found = fs.getContentSummary(gone)
    out = {"removed_files": found.getFileCount(), "removed_dirs": found.getDirectoryCount() - 1}
    fs.delete(gone, True)
    return out


def remove_files(files: DataFrame) -> dict[str, int]:
    """Delete listed files, in the executors' stead, one path at a time as they stream in; counts of removed and missing ones."""
    spark, done = files.sparkSession, {"removed": 0, "skipped": 0}
    for row in files.select("path").toLocalIterator():
        p = spark._jvm.org.apache.hadoop.fs.Path(row["path"])
        done["removed" if p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False) else "skipped"] += 1
    return done


def backup_year(spark, root: str, year: int, target: str) -> int:
    """Copy a year's files, of the root and of its folders, before anything is purged; the number of files."""
    from .readers import year_artifacts

    jvm, conf, n = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    for row in year_artifacts(spark, root, year).select("path").toLocalIterator():
        source = jvm.org.apache.hadoop.fs.Path(row["path"])
        to = jvm.org.apache.hadoop.fs.Path(f"{target}/{row['path'].split(root.rstrip('/') + '/')[-1]}")
        jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, to.getFileSystem(conf), to, False, conf)
        n += 1
    return n
