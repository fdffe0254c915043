"""Which batches of a log table may hold the ids of a new one: a file of fingerprints beside each batch.

A fingerprint is 64 bits of hash, eight bytes for an id of 64 characters. A batch of m ids is asked for at once, so a Bloom filter would have to be wrong
for far less than one id in m to spare a batch its reading; at the 40 bits an id that this takes, fingerprints are not much larger, and Spark
joins them as it joins any column. They only choose what is read: the ids themselves decide. A batch without a file (put there by other means, or
after a crash) counts as one that may hold any id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.tables import Tables


class StoredIds:
    def __init__(self, tables: Tables, table: str, key: str = "event_id"):
        self.tables, self.table, self.key = tables, table, key
        self.path = f"{tables.path(table)}__ids"

    def forget(self, batch: int | str) -> None:
        """To be called before a batch is written, as the file must not outlive what it describes."""
        self.tables.files.delete(f"{self.path}/batch={batch}")

    def add(self, batch: int | str) -> None:
        """Writes the file of a batch that is stored now."""
        ids = self.tables.read(self.table, only=[f"batch={batch}"]).select(F.xxhash64(self.key).alias("h"))
        ids.coalesce(1 + self.tables.files.size(f"{self.tables.path(self.table)}/batch={batch}") // (1 << 30)).sortWithinPartitions("h").write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/batch={batch}")

    def may_hold(self, ids: DataFrame, but_batch: int | str | None = None) -> list[str]:
        """Folders of the stored batches, but for one, that may hold any of the ids. Names of batches reach the driver, as they do for each read."""
        stored = [f for f in self.tables.folders(self.table) if f != f"batch={but_batch}"]
        described = set(self.tables.files.names(self.path)) & set(stored)
        if not described:
            return stored
        prints = self.tables.spark.read.schema("h LONG").parquet(*[f"{self.path}/{f}" for f in sorted(described)])
        prints = prints.select("h", F.regexp_extract(F.col("_metadata.file_path"), r"(batch=[^/]+)/[^/]+$", 1).alias("batch"))
        hit = prints.join(ids.select(F.xxhash64(self.key).alias("h")), "h", "left_semi").select("batch").distinct()
        held = {r["batch"] for r in hit.collect()}
        return [f for f in stored if f in held or f not in described]

    def known(self, ids: DataFrame, but_batch: int | str | None = None) -> DataFrame:
        """The stored rows among which those with any of the ids are."""
        return self.tables.read(self.table, only=self.may_hold(ids, but_batch))
