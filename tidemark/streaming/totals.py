"""Row counts and sums of latest state, kept by what each batch changes: minus each row as it was, plus each row as it is.

A batch's difference is written before its state, under its name; if the batch is given again, the first one stands, as by then the state may
have it. So a total is a sum over small rows, whatever the size of the state; `counted` scans the state for comparison. Decimals are added as decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.streaming import slabs
from tidemark.streaming.runs import Runs
from tidemark.streaming.silver import Entity, view
from tidemark.tables import Tables

DELTA = "tag STRING, n LONG, balance DECIMAL(38,2)"
#: Folders of differences that are read; beyond, they become one.
FOLDERS = 64


class Totals:
    """For run_silver, as `before`. column: what is added up, where an entity has it."""

    def __init__(self, tables: Tables, entities: list[Entity], column: str = "balance"):
        self.tables, self.entities, self.column = tables, entities, column

    def _runs(self, e: Entity) -> Runs:
        return Runs(self.tables, f"{self.tables.path(e.silver_table)}__totals", DELTA)

    def before(self, batch: DataFrame, tag: str) -> None:
        for e in self.entities:
            runs = self._runs(e)
            if not any(tag in tags for tags in runs.described().values()):
                runs.write(self._delta(batch, e, tag).coalesce(1), [tag])

    def _delta(self, batch: DataFrame, e: Entity, tag: str) -> DataFrame:
        changed = slabs.changes(self.tables, batch, e)
        live = lambda side: F.col(side).isNotNull() & ~F.coalesce(F.col(f"{side}._is_deleted"), F.lit(False))
        value = lambda side: F.when(live(side), F.col(f"{side}.`{self.column}`").cast("decimal(38,2)"))
        added = F.coalesce(F.sum(value("now")), F.lit(0)) - F.coalesce(F.sum(value("was")), F.lit(0)) if self.column in e.names else F.lit(None)
        return changed.agg(F.lit(tag).alias("tag"), (F.count_if(live("now")) - F.count_if(live("was"))).alias("n"), added.cast("decimal(38,2)").alias("balance"))

    def read(self, e: Entity) -> dict:
        """rows and balance (None where the entity has no such column) of the live rows."""
        runs = self._runs(e)
        have = runs.described()
        rows = runs.read(have).dropDuplicates(["tag"])  # a tag is in two folders after a crash between writing one and dropping others
        if len(have) > FOLDERS:
            runs.replace(have, rows.coalesce(1))
            return self.read(e)
        n, balance = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.sum("balance").cast("decimal(38,2)")).first()
        return {"rows": n, "balance": balance}

    def counted(self, e: Entity) -> dict:
        """The same by a scan of the state."""
        live = view(self.tables, e).where("not _is_deleted")
        balance = F.sum(F.col(self.column).cast("decimal(38,2)")) if self.column in e.names else F.lit(None)
        n, total = live.agg(F.count("*"), balance.cast("decimal(38,2)")).first()
        return {"rows": n, "balance": total}
