"""Tables as Parquet folders. Spark alone cannot merge into Parquet, and nothing here needs it to.

Log tables only grow: each batch is a folder of its own, written anew if the batch is repeated. State tables lie in buckets by
a hash of their keys. A merge reads the buckets that its rows fall into, writes these beside the old ones and puts the next manifest
in place, a small file that names the folder of each bucket; buckets without news stay where they are. Folders that a merge replaces stay
for readers that began on them and go with the next one. Buckets double in number as they grow.

Writers of one table, in whatever process, can't undo each other's merges: manifests are numbered, and one is put in place by a rename that fails if
its number is taken. Who loses looks at the manifest that won: if it left the loser's buckets as they were, the loser's follow upon it, else
the merge is made anew of what is there now.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.files import Files
from tidemark.operators import fold
from tidemark.types import QUEUE, TABLES, schema

STATE_TABLES = {"cdc_control", "gold_fraud_alerts", "alert_queue"}
#: One row for each source.
SINGLE = {"cdc_control"}
#: Buckets of a new state table, and the mean size of those written from which on there are more.
BUCKETS = 8
BUCKET_BYTES = 64 << 20
#: Manifests that stay, so that no writer finds the number after the one it began with free again.
KEPT = 64


class Tables:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)
        self.buckets, self.bucket_bytes = buckets, bucket_bytes
        self.ddl = TABLES | {"alert_queue": QUEUE}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def ensure(self) -> list[str]:
        """Creates what is missing, empty, and returns its names."""
        made = [n for n in self.ddl if not self.files.exists(f"{self.path(n)}/_table.json")]
        for n in made:
            self.files.write_text(f"{self.path(n)}/_table.json", json.dumps({"columns": self.ddl[n], "kind": "state" if n in STATE_TABLES else "log"}))
        return made

    def _manifest(self, name: str) -> dict[str, Any] | None:
        """Of a state table: version, columns, number of buckets, folder of each bucket, mean bytes of those last written, and
        the folders that its last change replaced."""
        at = f"{self.path(name)}/_manifests"
        versions = self.files.names(at)
        return json.loads(self.files.read_text(f"{at}/{versions[-1]}/manifest.json")) if versions else None

    def is_log(self, name: str) -> bool:
        return name in TABLES and name not in STATE_TABLES

    def exists(self, name: str) -> bool:
        return bool(self.folders(name)) if self.is_log(name) else self._manifest(name) is not None

    def folders(self, name: str) -> list[str]:
        return [n for n in self.files.names(self.path(name)) if n.startswith("batch=")]

    def read(self, name: str, but_batch: int | None = None, only: list[str] | None = None) -> DataFrame:
        """The rows; of a log table without those of one batch, or those of some folders only, if asked."""
        empty = lambda: self.spark.createDataFrame([], self.ddl[name])
        if self.is_log(name):
            folders = [f for f in (self.folders(name) if only is None else only) if f != f"batch={but_batch}"]
            return self.spark.read.schema(self.ddl[name]).parquet(*[f"{self.path(name)}/{f}" for f in folders]) if folders else empty()
        m = self._manifest(name)
        return empty() if m is None else self._at(name, m, m["at"].values())

    def append(self, name: str, rows: DataFrame, batch: int | str | None = None) -> None:
        """Adds a batch to a log table, cast to its columns. The same batch again takes the place of the first."""
        want = schema(self.ddl[name])
        cast = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in want])
        cast.write.mode("overwrite").parquet(f"{self.path(name)}/batch={uuid.uuid4().hex if batch is None else batch}")

    def _at(self, name: str, manifest: dict[str, Any], folders) -> DataFrame:
        kind, paths = StructType.fromJson(manifest["columns"]), [f"{self.path(name)}/{f}" for f in folders]
        return self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)

    def _bucket(self, manifest: dict[str, Any] | None, keys: list[str], n: int) -> Column:
        """The bucket of a row, its keys taken in the types the table has."""
        kinds = {f.name: f.dataType for f in StructType.fromJson(manifest["columns"])} if manifest else {}
        cast = [F.col(f"`{k}`").cast(kinds[k]) if k in kinds else F.col(f"`{k}`") for k in keys]
        return F.pmod(F.xxhash64(*cast), F.lit(n)).cast("int")

    def _touched(self, manifest: dict[str, Any] | None, rows: DataFrame, keys: list[str], n: int) -> list[str]:
        return sorted(str(r["b"]) for r in rows.select(self._bucket(manifest, keys, n).alias("b")).distinct().collect())

    def _written(self, name: str, old: dict[str, Any] | None, rows: DataFrame, keys: list[str], n: int) -> dict[str, Any]:
        """Writes the rows by bucket into a folder of their own."""
        folder = f"v={old['version'] + 1 if old else 0}-{uuid.uuid4().hex[:12]}"
        dealt = rows.withColumn("__bucket", self._bucket(old, keys, n)).hint("rebalance", F.col("__bucket"))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("__bucket").parquet(f"{self.path(name)}/{folder}")
        new = {f.split("=")[1]: f"{folder}/{f}" for f in self.files.names(f"{self.path(name)}/{folder}") if f.startswith("__bucket=")}
        size = self.files.size(f"{self.path(name)}/{folder}")
        return {"folder": folder, "at": new, "columns": json.loads(rows.schema.json()), "keys": keys, "buckets": n, "mean_bytes": size // len(new) if new else 0}

    def _committed(self, name: str, old: dict[str, Any] | None, new: dict[str, Any], stay: dict[str, str]) -> bool:
        """Puts in place the manifest that follows `old`, of what was written and the buckets that stay; False if another writer was first."""
        v = old["version"] + 1 if old else 0
        at = stay | new["at"]
        gone = sorted(set(old["at"].values()) - set(at.values())) if old else []
        manifest = {k: new[k] for k in ("columns", "keys", "buckets", "mean_bytes")} | {"version": v, "at": at, "before": gone}
        beside = f"{self.path(name)}/_new-{uuid.uuid4().hex}"
        self.files.write_text(f"{beside}/manifest.json", json.dumps(manifest))
        latest = self._manifest(name)
        if (latest or {}).get("version") != (old or {}).get("version") or not self.files.rename(beside, f"{self.path(name)}/_manifests/{v:012}"):
            self.files.delete(beside)
            return False
        used, had = {f.split("/")[0] for f in [*at.values(), *gone]}, old["before"] if old else []
        for f in {f if f.split("/")[0] in used else f.split("/")[0] for f in had}:
            self.files.delete(f"{self.path(name)}/{f}")
        for f in self.files.names(f"{self.path(name)}/_manifests")[:-KEPT]:
            self.files.delete(f"{self.path(name)}/_manifests/{f}")
        return True

    def replace(self, name: str, rows: DataFrame, keys: list[str]) -> None:
        """All rows of a state table anew."""
        m = self._manifest(name)
        new = self._written(name, m, rows, keys, m["buckets"] if m else self._first(name))
        while not self._committed(name, m, new, {}):
            m = self._manifest(name)

    def _first(self, name: str) -> int:
        return 1 if name in SINGLE else self.buckets

    def merge(self, name: str, rows: DataFrame, keys: list[str], how: Callable[[DataFrame | None, DataFrame], DataFrame]) -> None:
        """`how` makes the new rows of the buckets that `rows` fall into of the old ones there (None: no table yet) and `rows`.

        It must leave keys as they are. Without rows nothing is written. Rows are read more than once.
        """
        while not self._merged(name, rows, keys, how):
            pass

    def _merged(self, name: str, rows: DataFrame, keys: list[str], how: Callable[[DataFrame | None, DataFrame], DataFrame]) -> bool:
        """Tries a merge; False if another writer changed the buckets meanwhile."""
        m = self._manifest(name)
        n = m["buckets"] if m else self._first(name)
        touched = set(self._touched(m, rows, keys, n))
        if not touched:
            return True
        while m and name not in SINGLE and m["mean_bytes"] * m["buckets"] > self.bucket_bytes * n:
            n *= 2
        if m and n > m["buckets"]:  # every row may change its bucket
            touched = set(m["at"]) | {str(b) for b in range(n)}
        else:  # read again, rows may have come in other buckets
            rows = rows.where(self._bucket(m, keys, n).isin([int(b) for b in touched]))
        old = self._at(name, m, [f for b, f in m["at"].items() if b in touched]) if m else self.read(name) if name in self.ddl else None
        try:
            new = self._written(name, m, how(old, rows), keys, n)
        except Exception:  # the files that it read may have gone with two merges of others
            if self._manifest(name) == m:
                raise
            return False
        while not self._committed(name, m, new, {b: f for b, f in m["at"].items() if b not in touched} if m else {}):
            now = self._manifest(name)
            if not self._stands(name, m, now, n, touched):
                self.files.delete(f"{self.path(name)}/{new['folder']}")
                return False
            m = now
        return True

    @staticmethod
    def _stands(name: str, m: dict[str, Any] | None, now: dict[str, Any] | None, n: int, touched: set[str]) -> bool:
        """Whether the touched buckets are the same in a later manifest."""
        if m is None or now is None:
            return m is now
        return now["buckets"] == m["buckets"] == n and now["columns"] == m["columns"] and all(now["at"].get(b) == m["at"].get(b) for b in touched)

    def lookup(self, name: str, rows: DataFrame, keys: list[str]) -> DataFrame:
        """The rows of those buckets of a state table in which the keys of `rows` are, if they are in it."""
        m = self._manifest(name)
        if m is None:
            return self.read(name)
        touched = self._touched(m, rows, keys, m["buckets"])
        return self._at(name, m, [f for b, f in m["at"].items() if b in touched])

    def stable(self, name: str, read: Callable[[], Any]) -> Any:
        """What `read` gives of a state table; it reads again if merges of others took files away meanwhile."""
        while True:
            before = self._manifest(name)
            try:
                return read()
            except Exception:
                if self._manifest(name) == before:
                    raise

    def upsert(self, name: str, rows: DataFrame, keys: list[str], keep: list[str] | None = None) -> None:
        """Rows replace those with equal keys, but for the columns in `keep`."""
        want = schema(self.ddl[name])
        new = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in want])
        self.merge(name, new, keys, lambda old, new: fold.upsert(old, new, keys, keep))

    def files_of(self, rows: DataFrame, path: str) -> DataFrame:
        """The rows, written down to be read more than once. A cache of a large batch would take the executors' storage memory; readers of
        files also take the columns they need alone."""
        kind = rows.schema
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        return self.spark.read.schema(kind).parquet(path)

    def stream(self, name: str, ddl: str) -> DataFrame:
        """A log table as a stream of the batches that come."""
        self.files.write_text(f"{self.path(name)}/_table.json", json.dumps({"columns": ddl, "kind": "log"}))
        return self.spark.readStream.schema(ddl).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(self.path(name))
