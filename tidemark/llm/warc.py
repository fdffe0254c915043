"""WARC archives with revisit records: written deduplicated, read back record by record.

1. Payload digests and sizes are computed where the pages lie; headers (id, uri, digest, size) are shuffled by digest.
2. Per digest the smallest id is the response (partial aggregation; a payload that a third of all pages share makes one
   row a task); headers of digests that occur again are joined with it, and payloads of at least `min_bytes` that aren't
   it become revisit records. Those carry no payload, so they are written from the headers alone.
3. Pages whose digest occurs once are response records, written where they lie: a filter of 2^FILTER_BITS bits, fixed in size,
   tells which digests may occur again. Of the rest, pages that a second such filter takes for responses are joined with the
   exact verdict and written: about one payload for each repeated digest is shuffled, and no other. Filters that fill up
   send more pages that way, and change no record.
4. Each task writes gzip-member-per-record archives of at most `archive_bytes` (a single larger record is an archive of its own)
   into the shared folder, with fresh headers. The manifest lists what the tasks that succeeded wrote, so a retried or
   speculative task leaves only an orphan file.

Archives are written and read through pyarrow's file systems (local, HDFS, S3, Azure, Google, mounted DBFS, under Spark's names for
them); for any other a function from URI to (file system, path) is given. Reading streams each archive record by record.

Nulls, ties, repeats: a null html has an empty payload; a null url is written as urn:page:<id>; pages with the same id
and digest are response records alike (rows with the smallest id), and one with a null id sorts after all others and has
no id header; an empty table gives no archive and no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from io import BytesIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bit_filter, dropped, narrow, new_path, ship, written

#: An archive is closed once it holds so many bytes.
ARCHIVE_BYTES = 32 << 20
#: Bits of the filters of digests and of responses, as a power of two (a multiple of four).
FILTER_BITS = 24
CRLF = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A made-up capture time: archives of the same pages are the same bytes.
DATE = "2020-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, url) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}')}>"


def record(page_id, url: str | None, payload: bytes | int, digest: str, kind: str, refers_to=None, refers_uri: str | None = None) -> bytes:
    """One WARC/1.1 record (not compressed). payload: of a revisit, its length."""
    uri = url or f"urn:page:{page_id}"
    size = len(payload) if kind == "response" else payload
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, uri)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_line(uri)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        ref = refers_uri or f"urn:page:{refers_to}"
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, ref)}", f"WARC-Refers-To-Target-URI: {_line(ref)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return CRLF.join(x.encode() for x in head) + CRLF + CRLF + block + CRLF + CRLF


def _line(value: str) -> str:
    """A header value may not hold line ends."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def member(data: bytes) -> bytes:
    """A gzip member of its own."""
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parse(stream):
    """Records of an uncompressed WARC byte stream: (headers, block) one by one."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("the archive ends inside a record")
        yield headers, block


def _sha():
    return F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")).alias("sha")


def open_store(uri: str):
    """The file system of a URI as Spark writes it, and the path in it."""
    from urllib.parse import urlsplit

    from pyarrow import fs

    u = urlsplit(uri)
    inside = f"{u.netloc}{u.path}"
    if u.scheme in ("", "file"):
        return fs.LocalFileSystem(), u.path
    if u.scheme == "dbfs":
        return fs.LocalFileSystem(), f"/dbfs{u.path}"
    if u.scheme in ("s3", "s3a", "s3n"):
        return fs.S3FileSystem(), inside
    if u.scheme == "gs":
        return fs.GcsFileSystem(), inside
    if u.scheme in ("abfs", "abfss", "wasb", "wasbs"):
        container, _, host = u.netloc.partition("@")
        return fs.AzureFileSystem(account_name=host.split(".")[0]), f"{container}{u.path}"
    if u.scheme in ("hdfs", "viewfs"):
        return fs.FileSystem.from_uri(uri)
    raise ValueError(f"no file system is known for {u.scheme}:// ; give one by `store`")


def _row_place():
    return F.pmod(F.xxhash64("page_id", "sha"), F.lit(1 << FILTER_BITS)).cast("int").alias("place")


def _digest_place():
    return F.conv(F.substring("sha", 1, FILTER_BITS // 4), 16, 10).cast("int").alias("place")


def _member(bits):
    import numpy as np

    return np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)


def _hits(bits):
    def run(batches):
        member = _member(bits.value)
        for b in batches:
            yield b.filter(pa.array(member[b.column("place").to_numpy()]))

    return run


class _Archives:
    """Records of one task, written one after the other into archives."""

    def __init__(self, folder: str, limit: int, store):
        from pyspark import TaskContext

        self.folder, self.limit, self.ctx = folder, limit, TaskContext.get()
        self.fs, self.root = store(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.out, self.done = None, []

    def add(self, data: bytes) -> None:
        if self.out is not None and self.done[-1][1] + len(data) > self.limit:
            self.close()
        if self.out is None:
            name = f"part-{self.ctx.partitionId():06d}-{self.ctx.taskAttemptId()}-{len(self.done):05d}.warc.gz"
            self.done.append([f"{self.folder}/{name}", 0, 0])
            self.out = self.fs.open_output_stream(f"{self.root}/{name}", compression=None)
        self.out.write(data)
        self.done[-1][1] += len(data)
        self.done[-1][2] += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None

    def manifest(self) -> pa.RecordBatch:
        self.close()
        cols = list(zip(*self.done)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["path", "bytes", "records"])


MANIFEST = "path string, bytes long, records long"
PAGE = "page_id long, url string, html string, sha string"


def _base32(sha: str) -> str:
    return base64.b32encode(bytes.fromhex(sha)).decode()


def _response(r: dict) -> bytes:
    return member(record(r["page_id"], r["url"], (r["html"] or "").encode(), _base32(r["sha"]), "response"))


def _write_responses(folder: str, limit: int, store):
    def run(batches):
        archives = _Archives(folder, limit, store)
        for b in batches:
            for r in b.to_pylist():
                archives.add(_response(r))
        yield archives.manifest()

    return run


def _write_revisits(folder: str, limit: int, store):
    def run(batches):
        archives = _Archives(folder, limit, store)
        for b in batches:
            for r in b.to_pylist():
                archives.add(member(record(r["page_id"], r["url"], r["bytes"], _base32(r["sha"]), "revisit", r["refers_to"], r["refers_uri"])))
        yield archives.manifest()

    return run


def _write_first(folder: str, limit: int, store, again, responses):
    """Writes pages whose digest occurs once; passes on those that the filters take for responses of digests that may occur again."""

    def run(batches):
        archives = _Archives(folder, limit, store)
        seen, first = _member(again.value), _member(responses.value)
        names = ["page_id", "url", "html", "sha"]
        for b in batches:
            once = ~seen[b.column("place").to_numpy()]
            for r in b.filter(pa.array(once)).to_pylist():
                archives.add(_response(r))
            on = b.filter(pa.array(~once & first[b.column("row_place").to_numpy()]))
            nulls = [pa.nulls(on.num_rows, t) for t in (pa.string(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*nulls, *[on.column(c) for c in names]], names=["path", "bytes", "records", *names])
        m = archives.manifest()
        nulls = [pa.nulls(m.num_rows, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string())]
        yield pa.RecordBatch.from_arrays([*m.columns, *nulls], names=["path", "bytes", "records", *names])

    return run


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, store=open_store) -> DataFrame:
    """Writes the archives and returns their manifest: path, bytes, records. store: from a URI to (pyarrow file system, path)."""
    spark = pages.sparkSession
    ship(spark)
    folder = folder or new_path(spark, "warc")
    store(folder)  # fails here rather than in a task
    slim = narrow(pages, page_id=id_col, url=url_col, html=html_col).withColumn("page_id", F.col("page_id").cast("long"))
    headers = written(slim.select("page_id", "url", _sha(), F.coalesce(F.octet_length("html"), F.lit(0)).cast("long").alias("bytes")), "warc-headers")
    groups = headers.where(F.col("bytes") >= min_bytes).groupBy(F.col("sha").alias("d")).agg(F.min("page_id").alias("first_id"), F.min_by("url", "page_id").alias("first_uri"), F.count("*").alias("n"))
    groups = written(groups.where("n > 1 and first_id is not null"), "warc-groups")
    again = spark.sparkContext.broadcast(bit_filter(groups.select(F.col("d").alias("sha")).select(_digest_place()), FILTER_BITS))

    revisit = F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id"))
    later = headers.join(groups, F.col("sha") == F.col("d")).where(revisit)
    later = later.select("page_id", "url", "bytes", "sha", F.col("first_id").alias("refers_to"), F.col("first_uri").alias("refers_uri"))
    revisits = written(later.mapInArrow(_write_revisits(folder, archive_bytes, store), MANIFEST), "warc-manifest")

    # the exact verdict on all that the first filter holds back
    keys = headers.select("page_id", "sha", _digest_place())
    back = keys.mapInArrow(_hits(again), "page_id long, sha string, place int").drop("place")
    first = back.join(groups, F.col("sha") == F.col("d"), "left").where(F.col("d").isNull() | ~revisit).select("page_id", "sha").distinct()
    first = written(first, "warc-first")
    responses = spark.sparkContext.broadcast(bit_filter(first.select(_row_place()), FILTER_BITS))

    rows = slim.select("page_id", "url", "html", _sha()).select("*", _digest_place(), _row_place().alias("row_place"))
    passed = written(rows.mapInArrow(_write_first(folder, archive_bytes, store, again, responses), f"{MANIFEST}, {PAGE}"), "warc-once")
    due = passed.where("sha is not null").select("page_id", "url", "html", "sha")
    verdict = first.select(F.col("page_id").alias("v_id"), F.col("sha").alias("v_sha"))
    due = due.join(verdict, F.col("page_id").eqNullSafe(F.col("v_id")) & (F.col("sha") == F.col("v_sha"))).select("page_id", "url", "html", "sha")
    rest = written(due.mapInArrow(_write_responses(folder, archive_bytes, store), MANIFEST), "warc-manifest")
    for table in (headers, groups, first):
        dropped(table)
    return passed.where("path is not null").select("path", "bytes", "records").unionByName(rest).unionByName(revisits)


class _Members:
    """A gzip stream of many members as a plain byte stream, read as far as asked for."""

    def __init__(self, source, chunk: int = 1 << 20):
        self.source, self.chunk, self.z, self.buffer, self.rest = source, chunk, zlib.decompressobj(31), BytesIO(), b""

    def _more(self) -> bool:
        while True:
            data = self.rest or self.source.read(self.chunk)
            self.rest = b""
            if not data:
                return False
            if self.z.eof:
                self.z = zlib.decompressobj(31)
            out = self.z.decompress(data)
            self.rest = self.z.unused_data
            if out:
                self.buffer = BytesIO(self.buffer.read() + out)
                return True

    def readline(self) -> bytes:
        while True:
            at = self.buffer.tell()
            line = self.buffer.readline()
            if line.endswith(b"\n"):
                return line
            self.buffer.seek(at)
            if not self._more():
                return self.buffer.read()

    def read(self, n: int) -> bytes:
        parts, have = [], 0
        while have < n:
            data = self.buffer.read(n - have)
            parts.append(data)
            have += len(data)
            if have < n and not self._more():
                break
        return b"".join(parts)


def _reader(check: bool, store):
    def run(batches):
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for b in batches:
            for path in b.column("path").to_pylist():
                files, root = store(path)
                rows, held = [], 0
                with files.open_input_stream(root, compression=None) as f:
                    for h, block in parse(_Members(f)):
                        payload = block.partition(CRLF + CRLF)[2]
                        digest = h["warc-payload-digest"].removeprefix("sha1:")
                        kind = h["warc-type"]
                        if check and kind == "response" and (payload_digest(payload) != digest or len(payload) != int(h["x-payload-length"])):
                            raise ValueError(f"{path}: payload of {h['warc-record-id']} does not match its digest")
                        page, ref = h.get("x-page-id"), h.get("x-refers-to-page-id")
                        rows.append((int(page) if page else None, h["warc-target-uri"], int(h["x-payload-length"]), digest, kind, int(ref) if ref else None, payload.decode() if kind == "response" else None))
                        held += len(payload) + 200
                        if held > 4 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    return run


def read_archives(manifest: DataFrame, check: bool = True, store=open_store) -> DataFrame:
    """Every record of the archives in a manifest; payloads of responses are checked against their digests."""
    ship(manifest.sparkSession)
    paths = manifest.select("path")
    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return paths.repartition(n).mapInArrow(_reader(check, store), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string")
