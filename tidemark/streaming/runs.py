"""What is kept beside a log table: folders of Parquet rows, each with the list of the batches that it describes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame

from tidemark.tables import Tables


class Runs:
    def __init__(self, tables: Tables, path: str, ddl: str):
        self.tables, self.path, self.ddl = tables, path, ddl

    def described(self) -> dict[str, list[str]]:
        """The batches of each folder. One without its list, as after a crash, counts for nothing."""
        files = self.tables.files
        at = lambda r: f"{self.path}/{r}/_batches.json"
        return {r: json.loads(files.read_text(at(r))) for r in files.names(self.path) if files.exists(at(r))}

    def write(self, rows: DataFrame, batches: list[str], name: str | None = None) -> str:
        """Rows first, then the list: until that is there, what was before stands."""
        name = name or uuid.uuid4().hex
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{name}")
        self.tables.files.write_text(f"{self.path}/{name}/_batches.json", json.dumps(batches))
        return name

    def read(self, names: Iterable[str]) -> DataFrame:
        paths = [f"{self.path}/{n}" for n in names]
        return self.tables.spark.read.schema(self.ddl).parquet(*paths) if paths else self.tables.spark.createDataFrame([], self.ddl)

    def drop(self, names: Iterable[str]) -> None:
        for n in names:
            self.tables.files.delete(f"{self.path}/{n}")

    def replace(self, old: dict[str, list[str]], rows: DataFrame) -> str:
        """One folder in place of several. After a crash in between, both are there, which those who read must stand."""
        new = self.write(rows, sorted({b for bs in old.values() for b in bs}))
        self.drop(old)
        return new
