"""File arrival: new and changed files of a folder, one event for each valid row, refused rows with their reason.

A folder is listed and read by Spark, so any file system Spark reads will do; a share with a client of its own is listed and read by
that. Files are read as lines and parsed in pieces of whole records, so a file may be of any size; a record, a line and the rest of a
file after a quote that isn't closed must fit a task's memory. A file is known by its name and its version (modification time and
size, or the share's own tag).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import checks, identity
from tidemark.sources import text_pieces
from tidemark.sources.base import Capture, to_events

# Fixed values.
TRANSFER_COLUMNS = ["transfer_id", "value_date", "booking_ts", "debtor_iban", "creditor_iban", "amount", "currency", "reference"]


def csv_rows(files: DataFrame, content: str, columns: list[str], header: str | None = None, first: str | None = None) -> DataFrame:
    """Every CSV record after the header: the file's columns, line (records count from 2) and row, a struct of texts.

    Fields are found by the header's names. A quote at the start of a field opens a quoted one, which may hold commas, line ends and doubled quotes; what
    stands between its closing quote and the next comma belongs to it as it is, and so do quotes further on in a field. A record with more fields
    than the header, or whose quote isn't closed before the file ends, has row null. header, first: columns with the header and the number of the first
    record, of texts that begin after the header.
    """
    text = F.col(content) if header else F.regexp_replace(F.regexp_replace(F.col(content), "^﻿", ""), "\r\n?", "\n")
    # every repetition is possessive: the matcher neither goes back nor nests, however long a field is
    field = r'(?:"(?:[^"]++|"")*+"?+[^,\n]*+|[^",\n][^,\n]*+|)'
    records = F.filter(F.regexp_extract_all(text, F.lit(rf"({field}(?:,{field})*+)(?:\n|\z)"), 1), lambda x: x != "")
    parts = lambda rec: F.regexp_extract_all(F.concat(rec, F.lit(",")), F.lit(f"({field}),"), 1)
    inner, rest = (lambda f, i=i: F.regexp_extract(f, r'(?s)^"((?:[^"]++|"")*+)"(.*+)$', i) for i in (1, 2))
    plain = lambda f: F.when(f.startswith('"'), F.concat(F.replace(inner(f), F.lit('""'), F.lit('"')), rest(f))).otherwise(f)
    fields = lambda rec: F.transform(parts(rec), plain)
    whole = files.withColumn("__records", records).withColumn("__header", fields(F.col(header) if header else F.get("__records", F.lit(0))))
    whole = whole.withColumn("__places", F.array(*[F.array_position("__header", c).cast("int") - 1 for c in columns]))
    rest_of = F.col("__records") if header else F.slice("__records", F.lit(2), F.greatest(F.size("__records") - 1, F.lit(0)))

    def checked(r):
        raw, got = r["raw"], r["parts"]
        # a quote that isn't closed takes the comma put behind the record too, and is in no part
        good = (F.size(got) <= F.size("__header")) & (F.array_join(got, ",") == raw)
        return F.struct(raw.alias("raw"), F.when(good, F.transform(got, plain)).alias("fields"))

    def named(r):
        row = F.struct(*[F.get(r["fields"], F.get("__places", F.lit(i))).alias(c) for i, c in enumerate(columns)])
        return F.struct(r["raw"].alias("raw"), F.when(r["fields"].isNotNull(), row).alias("row"))

    # records are split and checked within the array, each step once a record: what comes after the explode reads columns
    entries = F.transform(F.transform(F.transform(rest_of, lambda r: F.struct(r.alias("raw"), parts(r).alias("parts"))), checked), named)
    out = whole.select("*", F.posexplode(entries).alias("__at", "__entry"))
    out = out.withColumn("line", F.col("__at") + (F.col(first) if first else F.lit(2))).withColumn("row", F.col("__entry.row")).withColumn("raw", F.col("__entry.raw"))
    return out.drop("__records", "__header", "__places", "__at", "__entry")


class Folder:
    """A share that Spark reads itself: any Hadoop path, mounted Azure Files among them."""

    def __init__(self, spark: SparkSession, path: str, suffix: str = ".csv"):
        self.spark, self.path, self.suffix = spark, path.rstrip("/"), suffix

    def _all(self) -> DataFrame:
        return self.spark.read.format("binaryFile").option("pathGlobFilter", f"*{self.suffix}").load(self.path)

    def listing(self) -> DataFrame:
        """name, etag, size, last_modified of every file with the suffix. Contents aren't read."""
        m = F.date_format("modificationTime", identity.ISO_MICROS)
        etag = F.concat_ws("-", F.unix_micros("modificationTime").cast("string"), F.col("length").cast("string"))
        return self._all().select(F.element_at(F.split("path", "/"), -1).alias("name"), etag.alias("etag"), F.col("length").alias("size"), m.alias("last_modified"))

    def lines(self, names: list[str]) -> DataFrame:
        """The lines of these files, see text_pieces."""
        rows = self.spark.read.option("lineSep", "\n").text([f"{self.path}/{n}" for n in names])
        name = text_pieces.file_name(F.col("_metadata.file_name"))
        return rows.select(name.alias("name"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("line"))


class RemoteShare:
    """A share behind a client of its own, such as the Azure Files SDK's directory client.

    connect: makes the client, on the driver and on executors alike. It has list_directories_and_files(), giving items
    with name and is_directory, and get_file_client(name), which has get_file_properties() (etag, size, last_modified) and
    download_file(), of which chunks() is read, or readall() where there is none. Directories and other suffixes are passed over;
    files are downloaded by executors.
    """

    def __init__(self, spark: SparkSession, connect: Callable[[], Any], suffix: str = ".csv"):
        self.spark, self.connect, self.suffix = spark, connect, suffix

    def listing(self) -> DataFrame:
        client, rows = self.connect(), []
        for item in client.list_directories_and_files():
            if item["is_directory"] or not item["name"].endswith(self.suffix):
                continue
            p = client.get_file_client(item["name"]).get_file_properties()
            rows.append((item["name"], p.etag.strip('"'), p.size, p.last_modified.strftime("%Y-%m-%dT%H:%M:%S.%f")))
        return self.spark.createDataFrame(sorted(rows), "name STRING, etag STRING, size LONG, last_modified STRING")

    def lines(self, names: list[str]) -> DataFrame:
        """The lines of these files, see text_pieces."""
        connect, mark = self.connect, text_pieces.MARK

        def download(batches):
            client = connect()
            for b in batches:
                for name in b.column("name").to_pylist():
                    stream, at, rest = client.get_file_client(name).download_file(), 0, []
                    for data in stream.chunks() if hasattr(stream, "chunks") else [stream.readall()]:
                        cut = data.rfind(b"\n") + 1
                        if cut:
                            yield lines(name, at, b"".join([*rest, data[:cut]]))
                            at, rest = at + 1, []
                        rest.append(data[cut:])
                    if last := b"".join(rest):
                        yield lines(name, at, last + b"\n")

        def lines(name, at, data):
            data = data.removeprefix(mark) if at == 0 else data
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([0], pa.int64()), pa.array([at], pa.int64()), pa.array([data], pa.binary())], names=["name", "block", "at", "line"])

        wanted = self.spark.createDataFrame([(n,) for n in names], "name STRING")
        return wanted.repartition(max(1, min(len(names), int(self.spark.conf.get("spark.sql.shuffle.partitions"))))).mapInArrow(download, text_pieces.LINES)


class FileDropSource:
    """manifest: the rows (file_name, etag) of the files that earlier runs took, or None. It is the state: what is listed there with
    the same version is left alone. Only names of new files reach the driver. ids: the ids that earlier runs gave and that are kept by file, or None; with them
    the source's own statistics read no file twice."""

    system = "azure_fileshare"
    table = "partner_transfers"

    def __init__(self, spark: SparkSession, folder: str | Folder | RemoteShare, name: str = "partner_fileshare", share: str = "partner-drop", manifest: Callable[[], DataFrame | None] = lambda: None, ids: Callable[[], DataFrame | None] = lambda: None):
        self.spark, self.name, self.share, self.manifest, self.ids = spark, name, share, manifest, ids
        self.files = Folder(spark, folder) if isinstance(folder, str) else folder

    def arrivals(self) -> DataFrame:
        """Listed files that are new or changed, and `again`: whether an earlier version was taken."""
        found, seen = self.files.listing(), self.manifest()
        if seen is None:
            return found.withColumn("again", F.lit(False))
        fresh = found.join(seen.select(F.col("file_name").alias("name"), "etag"), ["name", "etag"], "left_anti")
        earlier = seen.select(F.col("file_name").alias("name")).distinct().withColumn("again", F.lit(True))
        return fresh.join(earlier, "name", "left").withColumn("again", F.coalesce("again", F.lit(False)))

    def capture(self, watermark: dict[str, Any] | None, trace_id: str) -> Capture:
        new = self.arrivals().select("name", "etag", "last_modified", "again", "size").collect()
        if not new:
            return Capture(None, watermark or {"files": 0})
        files, rows = self._read(new)
        rows = rows.withColumn("position", F.concat(F.col("name"), F.lit(":"), F.col("line").cast("string"), F.lit("@"), F.substring("sha256", 1, 12)))
        good, bad = rows.where("fault is null"), rows.where("fault is not null")
        unread = files.where("not valid").select(F.lit(self.system).alias("source_system"), F.concat(F.col("name"), F.lit(":1@"), F.substring("sha256", 1, 12)).alias("position"), F.lit("not valid UTF-8").alias("reason"), F.col("name").alias("raw"))
        rejects = bad.select(F.lit(self.system).alias("source_system"), "position", F.col("fault").alias("reason"), "raw").unionByName(unread)
        null = F.lit(None).cast("string")
        flat = good.select("*", F.to_json(F.struct(F.col("row.transfer_id").alias("transfer_id"))).alias("key_json"), F.to_json("row", {"ignoreNullFields": "false"}).alias("after"), F.when(F.col("again"), "u").otherwise("c").alias("op"))
        sequence = F.concat_ws("|", "last_modified", "name", F.lpad(F.col("line").cast("string"), 9, "0"))
        events = to_events(flat, self.system, self.share, self.table, ["transfer_id"], F.col("key_json"), F.col("op"), null, F.col("after"), F.col("position"), F.col("last_modified"), sequence, trace_id, "row.")
        per = rows.groupBy("name").agg(F.count_if(F.col("fault").isNull()).alias("rows"), F.count_if(F.col("fault").isNotNull()).alias("rejected"))
        manifest = files.join(per, "name", "left").select(F.col("name").alias("file_name"), "etag", "size", "sha256", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.coalesce("rejected", F.lit(0)).cast("long").alias("rejected"), F.lit(trace_id).alias("trace_id"))
        own = files.select(F.col("name").alias("file_name"), "etag", null.alias("id")).unionByName(good.select(F.col("name").alias("file_name"), "etag", F.col("row.transfer_id").alias("id")).distinct())
        return Capture(events, {"files": (watermark or {}).get("files", 0) + len(new)}, rejects, manifest, own)

    def stats(self) -> dict[str, dict[str, Any]]:
        """Distinct valid transfers over all files that are there: of those whose ids are kept from them, of others by reading them."""
        listed, kept = self.files.listing().select("name", "etag", "last_modified", F.lit(False).alias("again"), "size"), self.ids()
        ids = None
        if kept is not None:
            place = [F.col("file_name").alias("name"), "etag"]
            ids = kept.where("id is not null").select(*place, "id").join(listed, ["name", "etag"], "left_semi").select("id")
            listed = listed.join(kept.select(*place).distinct(), ["name", "etag"], "left_anti").select(*listed.columns)
        if found := listed.collect():
            read = self._read(found)[1].where("fault is null").select(F.col("row.transfer_id").alias("id"))
            ids = read if ids is None else ids.unionByName(read)
        return {self.table: {"rows": ids.agg(F.count_distinct("id")).first()[0] if ids is not None else 0}}

    def _read(self, found: list) -> tuple[DataFrame, DataFrame]:
        """The listed files with sha256 and valid (whether they are UTF-8), and the records of the valid ones with their fault. Files are read once
        here, for their hashes, and again with the records."""
        names = sorted(f["name"] for f in found)
        digests = {d["name"]: d for d in text_pieces.digests(self.files.lines(names)).collect()}
        marks = []
        for f in found:
            d = digests.get(f["name"])
            if (sha := text_pieces.sha256(d, f["size"])) is None:
                raise OSError(f"{f['name']} changed while it was read: {f['size']} bytes listed, {d['bytes'] if d else 0} read in lines")
            marks.append((f["name"], f["etag"], f["last_modified"], f["again"], f["size"], *sha, d is None or d["valid"]))
        files = self.spark.createDataFrame(marks, "name STRING, etag STRING, last_modified STRING, again BOOLEAN, size LONG, sha256 STRING, cut_off BOOLEAN, valid BOOLEAN")
        valid = [n for n in names if n in digests and digests[n]["valid"]]
        pieces = text_pieces.pieces(self.files.lines(valid)) if valid else self.spark.createDataFrame([], text_pieces.PIECES)
        text = F.when(F.col("unclosed") & F.col("cut_off"), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
        pieces = pieces.join(F.broadcast(files), "name").withColumn("text", text)
        rows = csv_rows(pieces, "text", TRANSFER_COLUMNS, "header", "first")
        return files, rows.withColumn("fault", F.when(F.col("row").isNull(), F.lit("malformed record")).otherwise(checks.transfer_fault("row.")))
