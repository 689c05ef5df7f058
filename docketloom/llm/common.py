"""Helpers the training-data operators share: table access, staged tables, words and hashes."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of anything but ASCII white space, as a Java and as a Python pattern.
WORD = r"[^\x20\x09-\x0D]+"
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
WORD_TEXT = re.compile(r"[^\x20\x09-\x0D]+")

_own_root: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of text that go to a Python worker at a time, and bytes where Spark can bound them.
BATCH_ROWS, BATCH_BYTES = 1_000, 8 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches kept small enough for long texts; lower settings stay as they are."""
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = conf.get(name, None)
        if now is not None and not 0 < int(now.rstrip("bB")) <= most:
            conf.set(name, str(most))
    return df


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``); a temporary one only where none is set and all runs in one
    process, as in tests. A cluster without the setting is an error, as its executors share no local folder."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_root:
        _own_root.append("file://" + tempfile.mkdtemp(prefix="docketloom-"))
    return _own_root[0]


def staged(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: what follows starts from files, whichever executors are lost."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    (df if partitions is None else df.coalesce(partitions)).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._docketloom_path = path  # type: ignore[attr-defined]
    return out


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_docketloom_path", None)
        if path:
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame, most: int = 8_000_000) -> DataFrame:
    """A staged table, to be broadcast if its files have ``most`` bytes or fewer; else as it is, for a shuffled join."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._docketloom_path)
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return F.broadcast(df) if size <= most else df


def lower_az(text: str) -> bytes:
    """UTF-8 of the text with A-Z, and no other letters, in lower case."""
    return text.encode("utf-8", "replace").lower()


def crc_mod(col: str, mod: int) -> Column:
    """crc32 of the column as text, modulo ``mod``; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def free_name(columns: list[str], wish: str) -> str:
    """``wish``, or the first variant of it that no column has (names compare without case)."""
    taken, name, n = {c.lower() for c in columns}, wish, 1
    while name.lower() in taken:
        name, n = f"{wish}_{n}", n + 1
    return name


def objects(values: list) -> pd.Series:
    """A column of Python objects, whatever pandas would infer."""
    out = np.empty(len(values), object)
    out[:] = values
    return pd.Series(out, dtype=object)
