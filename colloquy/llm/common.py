"""What the operators of this subpackage share: table access, shared scratch space, Arrow helpers, word rules."""

from __future__ import annotations

import atexit
import ctypes
import gc
import io
import math
import pathlib
import re
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: a run of anything but space and U+0009 to U+000D.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A to Z to a to z, nothing else.
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def words(text: str | None) -> list[str]:
    """The words of a text; null gives none.  str.split is the same and faster where no other white space occurs."""
    if not text:
        return []
    return WORD.findall(text) if _ODD_SPACE.search(text) else text.split()


#: Arrow batches: what is set for a session that has Spark's own values, as texts are longer than most columns.
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application: they need not have it installed.

    The archive lies in the shared scratch space.
    """
    for key, (usual, most) in _BATCHES.items():
        if spark.conf.get(key) == usual:
            spark.conf.set(key, most)
    context, package = spark.sparkContext, pathlib.Path(__file__).resolve().parents[1]
    if getattr(context, "_colloquy_shipped", False) or not package.is_dir():
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    path = context._jvm.org.apache.hadoop.fs.Path(f"{scratch(spark)}-package.zip")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    out.write(data.getvalue())
    out.close()
    context.addPyFile(str(path.toString()))
    context._colloquy_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of the column's value written as text (null: ''), modulo divisor: the contracts' folds."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % F.lit(divisor)


def scratch(spark: SparkSession) -> str:
    """A new folder name under the shared checkpoint folder.  Where none is configured a local master takes a temporary one (tests);
    on a cluster that folder would not be shared, so there it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="colloquy-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/colloquy-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANUP_LOCK, _CLEANUP_USERS = threading.Lock(), []


@contextmanager
def _shuffle_files_go(spark: SparkSession) -> Iterator[None]:
    """Queries inside delete their shuffle files when done; the setting comes back when the last of several users leaves."""
    with _CLEANUP_LOCK:
        _CLEANUP_USERS.append(spark.conf.get(_CLEANUP, "false") if not _CLEANUP_USERS else _CLEANUP_USERS[0])
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _CLEANUP_LOCK:
            before = _CLEANUP_USERS.pop()
            if not _CLEANUP_USERS:
                spark.conf.set(_CLEANUP, before)


class _Held:
    """What one piece of work has stored or broadcast and not let go of yet."""

    def __init__(self):
        self.things: dict[object, Callable[[], None]] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        """df's files outlive this piece of work; the one around it is responsible for them."""
        release = self.things.pop(df._stored_at)
        _held(self).things[df._stored_at] = release
        return df

    def let_go(self) -> None:
        while self.things:
            self.things.popitem()[1]()
        gc.collect()
        give_back()


_OUTERMOST, _WORK = _Held(), threading.local()
#: Results stored in one piece of work, after so many of which the driver hands memory back; near duplicates store some forty.
SHRINK_EVERY = 6


def _held(inside: _Held | None = None) -> _Held:
    """The piece of work under way, or the one around another."""
    stack = [_OUTERMOST, *getattr(_WORK, "stack", [])]
    return stack[stack.index(inside) - 1] if inside else stack[-1]


@contextmanager
def working() -> Iterator[_Held]:
    """Stored DataFrames and broadcasts made inside are deleted at the end, except those that keep() names.

    What is made outside of any such block, for a result that is still to be computed, goes when the driver exits.
    """
    _WORK.stack = [*getattr(_WORK, "stack", []), held := _Held()]
    try:
        yield held
    finally:
        _WORK.stack = [h for h in _WORK.stack if h is not held]
        held.let_go()
        if not _WORK.stack:
            _shrink_driver()


def _shrink_driver() -> None:
    """Let the driver's JVM drop the plans and broadcasts of finished work and hand back the heap they took, and the memory beside the
    heap (compilers, collector, plans' generated classes) that the C library keeps once it is free."""
    if context := SparkContext._active_spark_context:
        context._jvm.System.gc()
        with suppress(Exception):  # not every JVM has this command
            _trim(context)


def _trim(context: SparkContext) -> None:
    jvm, array = context._jvm, context._gateway.new_array
    call = array(jvm.java.lang.Object, 4)
    call[0], call[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    call[2], call[3] = array(jvm.java.lang.Object, 0), array(jvm.java.lang.String, 0)
    # by the interface's method: the server's class isn't open to others
    (invoke,) = (m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), call)


@atexit.register
def _exit() -> None:
    with suppress(Exception):  # the session may have ended before
        _OUTERMOST.let_go()


def shared(spark: SparkSession, value):
    """A broadcast that ends with the surrounding piece of work."""
    out = spark.sparkContext.broadcast(value)
    _held().things[id(out)] = out.destroy
    return out


def stored(df: DataFrame) -> DataFrame:
    """Write df to the shared scratch space and read it back: lineage ends at files that outlive executors.

    The shuffle files that the write needed go when it is done.
    """
    spark = df.sparkSession
    path = scratch(spark)
    with _shuffle_files_go(spark):
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    _held().things[path] = lambda: _delete(spark, path)
    _WORK.stored = getattr(_WORK, "stored", 0) + 1
    if _WORK.stored % SHRINK_EVERY == 0:
        gc.collect()  # JVM objects that Python still names
        _shrink_driver()
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop_stored(*dfs: DataFrame) -> None:
    """Delete the files behind DataFrames from stored(), once nothing reads them any more."""
    for df in dfs:
        for held in [_OUTERMOST, *getattr(_WORK, "stack", [])]:
            held.things.pop(df._stored_at, None)
        _delete(df.sparkSession, df._stored_at)


def fresh(df: DataFrame, name: str) -> str:
    """name, lengthened until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_ids(docs: DataFrame, *columns: str, file: str = "file", row: str = "row") -> DataFrame:
    """The named columns of docs (default: all) and two numbers that tell rows apart, whatever the rows hold: a hash of the
    Parquet file's path and the place in the file.  Rows that no Parquet file holds are stored first."""
    columns = columns or tuple(docs.columns)

    def read(df: DataFrame) -> DataFrame:
        place = df.metadataColumn("_metadata")
        return df.select(*(df[c] for c in columns), F.xxhash64(place["file_path"]).alias(file), place["row_index"].alias(row))

    try:
        return read(docs)
    except AnalysisException:
        return read(stored(docs.select(*columns)))


def give_back() -> None:
    """Hand freed memory back to the system at a task's end: idle Python workers stay alive beside the JVM."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def hash_share(column: str, share: float) -> Column:
    """Holds for about that share of rows, the same ones each time, chosen by a hash of the column."""
    return F.pmod(F.xxhash64(column), F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20)))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about `most` bytes, so that memory doesn't follow the batch size.

    A single longer text is a run of its own.
    """
    if not batch.num_rows:
        return
    col = batch.column(batch.schema.get_field_index(column))
    size = np.array([0 if n is None else n for n in pc.binary_length(col).to_pylist()], dtype=np.int64)
    group = np.cumsum(size + 64) // most
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def hash_words(values: list[str]) -> np.ndarray:
    """64-bit hashes of strings, the same in every process."""
    import xxhash

    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(v.encode("utf-8", "surrogatepass")) for v in values), dtype=np.uint64, count=len(values))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values (splitmix64's finalizer)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
