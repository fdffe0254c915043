"""Shared folder, written intermediates and column handling for the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import threading
import uuid
import zipfile
import zlib
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step works on; bounds the memory of a Python worker (a single longer text is one step).
STEP_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset and all runs in this process (tests), a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isDefined():
            path = found.get()
        elif spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:
            path = "file://" + tempfile.mkdtemp(prefix="shared-")
            spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


_scopes = threading.local()


@contextmanager
def intermediates(spark: SparkSession):
    """Whatever operators write into the shared folder inside this block is deleted at its end.

    Results are lazy and may read it: write or collect them inside.
    """
    stack = _scopes.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield stack[-1]
    finally:
        for path in stack.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if stack := _scopes.__dict__.get("stack"):
        stack[-1].append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_path = path
    return back


def dropped(df: DataFrame) -> None:
    """Removes what written() made, once nothing will read it again."""
    if path := getattr(df, "_written_path", None):
        _delete(df.sparkSession, path)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors unless their Python path has it already."""
    root = Path(__file__).resolve().parents[2]
    path = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if any(p and Path(p).resolve() == root for p in path) or getattr(spark.sparkContext, "_tidemark_shipped", False):
        return
    archive = Path(tempfile.mkdtemp()) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted((root / "tidemark").rglob("*.py")):
            z.write(f, f.relative_to(root))
        if (root / "corpus_pipeline.py").exists():
            z.write(root / "corpus_pipeline.py", "corpus_pipeline.py")
    spark.sparkContext.addPyFile(str(archive))
    spark.sparkContext._tidemark_shipped = True


def bit_filter(places: DataFrame, bits: int) -> bytes:
    """2^bits bits, packed, of which those at the places (column `place`) are set. What reaches the driver has a fixed size."""
    import numpy as np

    schema = "bits binary"
    row = lambda x: pa.RecordBatch.from_arrays([pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())], names=["bits"])

    def mark(batches):
        seen = np.zeros(1 << bits, dtype=bool)
        for b in batches:
            seen[b.column("place").to_numpy()] = True
        if seen.any():
            yield row(np.packbits(seen))

    def merge(batches):
        total = np.zeros(1 << bits - 3, dtype=np.uint8)
        for b in batches:
            for z in b.column("bits").to_pylist():
                total |= np.frombuffer(zlib.decompress(z), np.uint8)
        if total.any():
            yield row(total)

    total = np.zeros(1 << bits - 3, dtype=np.uint8)
    for r in places.select("place").mapInArrow(mark, schema).repartition(16).mapInArrow(merge, schema).collect():
        total |= np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return total.tobytes()


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that have ended (it waits for garbage collection)."""
    gc.collect()
    spark._jvm.System.gc()


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns asked for, under our names; others, whatever they are called, don't clash."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])


def packed(df: DataFrame, name: str = "row"):
    """All columns of df as one struct: beside it, ours can have any name."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def unpacked(df: DataFrame, columns: list[str], name: str = "row") -> DataFrame:
    """The columns of a packed row again."""
    return df.select(*[F.col(name).getField(c).alias(c) for c in columns])


def lean(run):
    """A mapInArrow function whose task, at its end, gives memory that it has freed back to the system.

    Spark takes its idle Python workers in turn, so that each of them, not only those at work, would go on holding what the
    largest task needed.
    """

    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone keeps freed pages, and has this
                trim(0)

    return task


def steps(batch: pa.RecordBatch, column: str | int = "text", limit: int = STEP_BYTES):
    """Slices of a batch whose texts have at most `limit` bytes together (or hold a single row)."""
    import numpy as np
    import pyarrow.compute as pc

    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
