"""Helpers shared by the operators: Arrow text buffers, batching, hashing and written tables."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache, wraps
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes that count as white space in every word rule of this subpackage.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
#: Lower-casing of A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local one is set only where that is unset and all run on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.gettempdir()}/quillgraph-checkpoints"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def keep(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: it cuts lineage and outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/quillgraph/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete a table that keep() wrote and nothing will read again."""
    spark = df.sparkSession
    for path in {p.rpartition("/")[0] for p in df.inputFiles()}:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


#: Rows of a few numbers that are broadcast at most, some dozen MB as a table.
FEW = 1 << 20


def within(df: DataFrame, most: int = FEW) -> DataFrame:
    """df, a written table of narrow rows, to be broadcast if it has at most so many; else joins shuffle it."""
    return F.broadcast(df) if df.count() <= most else df


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


@cache
def _trim() -> Callable[[int], int] | None:
    """The C library's malloc_trim, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives memory that is free back to the system: Arrow's pool and the C library hold on to it, as long as a worker lives."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def lean(run: Run) -> Run:
    """run for mapInArrow; a Python worker that idles after it, beside steps that need none, holds no free memory."""

    @wraps(run)
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return out


def groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows of each value of column, a number, as one table; batches are sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        key = batch.column(column).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)] if len(key) else []
        for a, b in pairwise(edges):
            if held and held[0].column(column)[0].as_py() != key[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


#: Rows and bytes of a table that a Python worker gathers before it writes them.
_GROUP_ROWS, _GROUP_BYTES = 1 << 17, 8 << 20


def keep_mapped(df: DataFrame, run: Run | None = None, schema: str = "") -> DataFrame:
    """keep() of df.mapInArrow(run, schema), or of df without run, with no process started by the executors' JVMs.

    In a folder of local files Spark's writer calls chmod three times a file, and until each call is another program its
    process counts with all memory of its executor once more. So the Python workers write there, what run gives without
    a way through the JVM. The table is the files that finished tasks have named; in any other folder keep() writes it."""
    spark = df.sparkSession
    fields = StructType.fromDDL(schema) if run else df.schema
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/quillgraph/{uuid.uuid4().hex}")
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        return keep(df.mapInArrow(run, fields) if run else df)
    path, target = folder.toUri().getPath(), to_arrow_schema(fields)

    @lean
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held, rows, size, out = uuid.uuid4().hex, [], 0, 0, None
        for batch in chain(run(batches) if run else batches, [None]):
            if batch is not None and batch.num_rows:
                held.append(batch.select(target.names))
                rows, size = rows + batch.num_rows, size + batch.nbytes
            if held and (batch is None or rows >= _GROUP_ROWS or size >= _GROUP_BYTES):
                out = out or pq.ParquetWriter(f"{path}/.{name}", target)
                out.write_table(pa.Table.from_batches(held).cast(target))
                held, rows, size = [], 0, 0
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"name": [name]})

    os.makedirs(path)
    done = [r.name for r in df.mapInArrow(write, "name string").collect()]
    for name in done:  # Spark overlooks the others, hidden files of tasks that failed or ran twice
        os.rename(f"{path}/.{name}", f"{path}/{name}.parquet")
    return spark.read.schema(fields).parquet(folder.toString()) if done else spark.createDataFrame([], fields)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated UTF-8 bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    if len(at) == 0:
        at = np.zeros(1, np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int):
    """Row ranges (i, j) of at most limit bytes each, or of a single longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd 64-bit base and of its inverse, at least n of them."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, int(n).bit_length())
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
            out.append(p)
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


class Words:
    """Words of one batch of texts: their document, start, end and 64-bit hash, all as arrays.

    Text is lower-cased (A-Z) and cut at ASCII white space; no word crosses documents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = LOWER[data]
        n = len(data)
        word = np.ones(n + 1, bool)
        word[:n] = ~SPACES[data]
        word[n] = False
        first = np.zeros(n + 1, bool)
        first[offsets[:-1]] = True
        before = np.zeros(n + 1, bool)
        before[1:] = word[:n]
        self.start = np.flatnonzero(word & (~before | first))
        ends = np.flatnonzero(before & (~word | first))
        self.end = ends
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        power, inverse = powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
        value = (sums[self.end] - sums[self.start]) * inverse[self.start]
        self.hash = mix(value + (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        self.count = np.bincount(self.doc, minlength=len(offsets) - 1)


def doc_key(text: str = "text", doc_id: str = "doc_id"):
    """A 64-bit key of (doc_id, text): rows that share it are interchangeable."""
    return F.xxhash64(F.col(doc_id), F.col(text))
