"""From a key of a source table to the batches of raw events that hold it: an inverted index beside the raw event table.

Each batch has its postings (source table, key name, key, batch), sorted by key; `merge` puts those of many batches together into files by ranges of
the key, whose ends Parquet keeps, so a few keys are looked up in a few of them. Lineage asks the postings which batches hold what it
wants, and reads these alone. Postings only choose what is read: they may name a batch too many, and a batch without any
(put there by other means, or after a crash) is always read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.streaming.runs import Runs
from tidemark.tables import Tables

POSTINGS = "source_table STRING, key_name STRING, entity_key STRING, batch STRING"
KEY = ["source_table", "key_name", "entity_key"]


class Postings:
    """pairs: (source table, key name) of the keys that are kept."""

    def __init__(self, tables: Tables, pairs: set[tuple[str, str]], table: str = "bronze_change_events"):
        self.tables, self.pairs, self.table = tables, pairs, table
        self.runs = Runs(tables, f"{tables.path(table)}__keys", POSTINGS)

    def forget(self, batch: int | str) -> None:
        """To be called before a batch is written anew."""
        self.runs.drop([f"of-{batch}"])

    def add(self, batch: int | str) -> None:
        """Writes the postings of a batch that is stored now."""
        keys = quality.named_keys(self.tables.read(self.table, only=[f"batch={batch}"]), self.pairs).select(*KEY).distinct()
        one = 1 + self.tables.files.size(f"{self.tables.path(self.table)}/batch={batch}") // (1 << 30)
        self.runs.write(keys.withColumn("batch", F.lit(f"batch={batch}")).repartitionByRange(one, *KEY).sortWithinPartitions(*KEY), [f"batch={batch}"], f"of-{batch}")

    def merge(self, files: int | None = None) -> None:
        """One set of postings in place of all there are, in so many ranges of the key."""
        have = self.runs.described()
        if len(have) < 2:
            return
        n = files or int(self.tables.spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs.replace(have, self.runs.read(have).distinct().repartitionByRange(n, *KEY).sortWithinPartitions(*KEY))

    def holding(self, wanted: DataFrame) -> list[str]:
        """Folders of the batches that may hold the wanted (source_table, key_name, entity_key); their names reach the driver."""
        have, stored = self.runs.described(), self.tables.folders(self.table)
        described = {b for bs in have.values() for b in bs}
        held = {r["batch"] for r in self.runs.read(have).join(wanted.select(*KEY).distinct(), KEY, "left_semi").select("batch").distinct().collect()}
        return [f for f in stored if f in held or f not in described]

    def lineage(self, alerts: DataFrame, sources: dict[str, tuple[str, str]]) -> DataFrame:
        """As quality.lineage, over the batches that hold evidence alone."""
        return quality.lineage(alerts, self.tables.read(self.table, only=self.holding(quality.evidence(alerts, sources))), sources)
