"""A pluggable source of cases: any class that can fetch a case and its entries becomes a Spark data source."""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "case_number string, found boolean, case map<string,string>, entries array<map<string,string>>"


def load_class(spec: str) -> type:
    """The class that ``package.module.Class`` or ``file.py:Class`` names."""
    if ":" in spec:
        path, name = spec.rsplit(":", 1)
        found = importlib.util.spec_from_file_location("plugged", path)
        module = importlib.util.module_from_spec(found)
        found.loader.exec_module(module)
    else:
        path, name = spec.rsplit(".", 1)
        module = importlib.import_module(path)
    return getattr(module, name)


class CaseReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.service, self.wanted, self.parts = options["service"], [n for n in options.get("cases", "").split(",") if n], int(options.get("partitions", "4"))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.wanted[k :: self.parts]) for k in range(min(self.parts, len(self.wanted)) or 1)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        service = load_class(self.service)()
        text = lambda d: {k: None if v is None else str(v) for k, v in d.items()}
        for number in partition.value:
            case, entries = service.fetch_case_and_docket(number, True)
            yield number, case is not None, text(case or {}), [text(e) for e in entries or []]


class CaseSource(DataSource):
    """``spark.read.format("cases").option("service", "module.Class").option("cases", "IMM-1-25,IMM-2-25").load()``"""

    @classmethod
    def name(cls) -> str:
        return "cases"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return CaseReader(self.options)
