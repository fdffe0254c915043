"""A change log as a stream: positions of the log are the stream's offsets, so its checkpoint is the watermark.

A client reads the log: bounds() gives the oldest and the newest position kept (None: the log is empty), rows(after, upto) record batches of the changes
with after < lsn <= upto (after None: from the beginning), with the columns of the stream. A micro-batch covers what came since the last one and is cut into
ranges of positions, which executors read beside each other; both rows of an update have one position, so no range parts them.
A stream whose last position is older than the oldest one kept stops: what lies between is lost, and a snapshot is due.

Source and client are sent by value, executors need not have this package.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

WIDTH = 10  # bytes of a position


def log_source(client: Any, ddl: str, name: str = "change_log", ranges: int = 8) -> type[DataSource]:
    """A data source to register: spark.dataSource.register(...), then spark.readStream.format(name)."""
    width = WIDTH

    class Range(InputPartition):
        def __init__(self, after, upto):
            self.after, self.upto = after, upto

    class Reader(DataSourceStreamReader):
        def initialOffset(self):
            return {"lsn": ""}  # before the first change, whichever that is

        def latestOffset(self):
            bounds = client.bounds()
            return {"lsn": bounds[1].hex() if bounds else ""}

        def partitions(self, start, end):
            bounds = client.bounds()
            if not end["lsn"] or not bounds:
                return []
            oldest, upto = int.from_bytes(bounds[0], "big"), int(end["lsn"], 16)
            if start["lsn"] and int(start["lsn"], 16) < oldest:
                raise RuntimeError(f"GapError: the last position read, 0x{start['lsn']}, is older than the oldest one kept, 0x{bounds[0].hex()}; take a new snapshot")
            after = int(start["lsn"], 16) if start["lsn"] else oldest - 1
            step = max(1, -(-(upto - after) // ranges))
            cuts = [*range(after, upto, step), upto] if upto > after else []
            place = lambda n: max(n, 0).to_bytes(width, "big")
            return [Range(None if lo < 0 else place(lo), place(hi)) for lo, hi in zip(cuts, cuts[1:])]

        def read(self, partition):
            yield from client.rows(partition.after, partition.upto)

        def commit(self, end):
            pass

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return ddl

        def streamReader(self, schema):
            return Reader()

    return Source


def parquet_log(uri: str, columns: list[str], oldest: bytes | None = None) -> Any:
    """A client of a log that lies in Parquet files with a column lsn; bounds come from their footers, and ranges reach the row groups. oldest: the oldest
    position that counts as kept."""

    class Log:
        def _data(self):
            import pyarrow.dataset
            import pyarrow.fs

            fs, path = pyarrow.fs.FileSystem.from_uri(uri)
            if fs.get_file_info(path).type == pyarrow.fs.FileType.NotFound:
                return None
            return pyarrow.dataset.dataset(path, filesystem=fs, format="parquet", exclude_invalid_files=False)

        def bounds(self):
            least = most = None
            for fragment in self._data().get_fragments() if self._data() else ():
                at = fragment.physical_schema.get_field_index("lsn")
                for i in range(fragment.metadata.num_row_groups):
                    s = fragment.metadata.row_group(i).column(at).statistics
                    if s is not None and s.has_min_max:
                        least, most = min(least or s.min, s.min), max(most or s.max, s.max)
            if most is None:
                return None
            return (max(oldest, least) if oldest else least), most

        def rows(self, after, upto):
            import pyarrow.dataset

            lsn = pyarrow.dataset.field("lsn")
            some = (lsn <= upto) & (lsn >= (oldest or b""))
            if after is not None:
                some &= lsn > after
            yield from (b for b in self._data().to_batches(columns=columns, filter=some) if b.num_rows)

    return Log()
