"""Following a folder of exported cases. A micro-batch costs what it holds and not what is stored: its rows go into a folder of
their own under ``<store>/log``, and reading takes the newest row of each case. Once the log is large against ``<store>/base``
it is folded into it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.store import newest
from ..schema import CASE_DDL
from ..sources.sinks import recover, swap

_STORED = f"{CASE_DDL}, seq long"
#: The log is folded into the base at this part of its bytes; so many folders of the log are made one.
FOLD, MOST_FOLDERS = 0.5, 64


class CaseStore:
    """Stored cases at ``path``. Every row keeps ``seq``, the number of the batch that brought it, so that what a fold cut off
    by a lost driver leaves behind changes no answer."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.base, self.log = spark, f"{path}/base", f"{path}/log"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _folders(self) -> list[str]:
        """Complete folders of the log, by number. One that is being written is none yet."""
        found = self._fs.globStatus(self._path(f"{self.log}/n*"))
        names = sorted(s.getPath().getName() for s in found or [])
        for name in {n.split(".")[0] for n in names if ".old-" in n}:
            recover(self.spark, f"{self.log}/{name}")
        return sorted({n.split(".")[0] for n in names if "." not in n or ".old-" in n})

    def _bytes(self, *paths: str) -> int:
        return sum(self._fs.getContentSummary(self._path(p)).getLength() for p in paths)

    def _rows(self, *paths: str) -> DataFrame:
        return newest(self.spark.read.schema(_STORED).parquet(*paths), ["case_id"], ["seq"])

    def _bases(self) -> list[str]:
        recover(self.spark, self.base)
        return [self.base] if self._fs.exists(self._path(self.base)) else []

    def cases(self) -> DataFrame:
        """The stored cases, one row to a number; no row if nothing is stored."""
        paths = [*self._bases(), *[f"{self.log}/{n}" for n in self._folders()]]
        rows = self._rows(*paths) if paths else self.spark.createDataFrame([], _STORED)
        return rows.drop("seq")

    def put(self, batch: DataFrame, order: list[str]) -> None:
        """Store a batch; of several rows for a number the last by ``order`` counts, and rows without one are left out. A batch
        that comes again at once changes nothing."""
        have = self._folders()
        seq = int(have[-1][1:]) + 1 if have else 0
        rows = newest(batch.where("case_id is not null"), ["case_id"], order).withColumn("seq", F.lit(seq).cast("long"))
        swap(rows, f"{self.log}/n{seq:012d}")
        have = self._folders()
        base, log = self._bytes(*self._bases()), self._bytes(*[f"{self.log}/{n}" for n in have])
        if log > FOLD * base:
            self.fold()
        elif len(have) > MOST_FOLDERS:
            last = f"{self.log}/{have[-1]}"
            swap(self._rows(*[f"{self.log}/{n}" for n in have]), last)
            self._clear(have[:-1])

    def fold(self) -> None:
        """Bring the log into the base. The log's last folder stays, as the next number follows from it."""
        have = self._folders()
        if have:
            swap(self._rows(*self._bases(), *[f"{self.log}/{n}" for n in have]), self.base)
            self._clear(have[:-1])

    def _clear(self, folders: list[str]) -> None:
        for n in folders:
            self._fs.delete(self._path(f"{self.log}/{n}"), True)


def follow_cases(spark: SparkSession, folder: str, store: str, order: list[str] | None = None) -> DataStreamWriter:
    """A stream that puts new files' cases, one JSON record to a line, into the ``CaseStore`` at ``store``; the last by ``order``
    wins in a batch, and a later batch over an earlier one. Repeating a batch changes nothing, so a restart from the
    checkpoint is safe."""
    cases = CaseStore(spark, store)
    writer = spark.readStream.schema(CASE_DDL).json(folder).writeStream
    return writer.foreachBatch(lambda batch, _: cases.put(batch, order or ["scraped_at"]))
