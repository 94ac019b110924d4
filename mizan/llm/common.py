"""Helpers the operators share: inputs, shared storage, Arrow batches, words."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of text that a worker takes up at once; texts can be long.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one Parquet table; other columns never reach the plan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where it is unset, as in tests, a temporary one.

    Off a local master no folder of the driver's is shared, so there it must be set."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="mizan-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Folders written for results that callers may still read, and settings that were changed, by application.
_WRITTEN: dict[str, list[str]] = {}
_SETTINGS: dict[str, list[tuple]] = {}


def bounded(spark: SparkSession) -> None:
    """Bounds what the session puts into one batch, of Arrow or of kept rows, until release(): no worker's memory follows the
    length of texts, and an executor does not set aside megabytes for each column of a kept partition of a few rows."""
    changed = _SETTINGS.setdefault(spark.sparkContext.applicationId, [])
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.inMemoryColumnarStorage.batchSize", BATCH_ROWS)):
        if spark.conf.get(key) != str(most):
            changed.append((spark, key, spark.conf.getAll.get(key)))
            spark.conf.set(key, str(most))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody has used; release() deletes what is there."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def deleted(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared storage, whatever file system that is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Deletes all that operators have staged in this application, and gives sessions their settings back: to be called when results are written."""
    for session, key, before in reversed(_SETTINGS.pop(spark.sparkContext.applicationId, [])):
        session.conf.unset(key) if before is None else session.conf.set(key, before)
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        deleted(spark, path)


#: Rows of a small table that are worth a file of their own.
ROWS_A_FILE = 100_000


def staged(df: DataFrame, name: str, rows: int | None = None, tasks: int = 1) -> DataFrame:
    """Writes df to the shared folder and rereads it: cuts lineage and survives lost executors.

    ``rows``, a bound on the number of rows, keeps small tables from becoming many files (for each, Hadoop's local file
    system starts processes from the executor); where the last stage is much work, that many ``tasks`` do it at least."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df = df if rows is None else df.coalesce(max(tasks, 1 + rows // ROWS_A_FILE))
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def gathered(df: DataFrame, name: str) -> DataFrame:
    """staged() for a table that is small beside the texts, in no more files than its rows need: as many tasks as Spark likes
    make the rows, which lie on the executors' disks until they are counted and written."""
    first = kept(df)
    out = staged(first, name, first.count())
    first.unpersist()
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes what staged() wrote for these, which nothing will read any more."""
    for df in frames:
        deleted(df.sparkSession, df._staged_at)
        left = _WRITTEN.get(df.sparkSession.sparkContext.applicationId, [])
        if df._staged_at in left:  # else release() has been there before
            left.remove(df._staged_at)


def kept(df: DataFrame) -> DataFrame:
    """df on the executors' disks for another use; what a lost executor held is computed again from its lineage."""
    return df.persist(StorageLevel.DISK_ONLY)


def carried(df: DataFrame, keep: tuple[str, ...], made: tuple[str, ...], *needed) -> DataFrame:
    """The columns of ``keep`` as one struct ``row``, so that no name can clash within an operator, and the ``needed`` ones.

    A kept column named twice, or like one that the operator makes (regardless of case), is an error: the result could not tell them apart."""
    names = [k.lower() for k in keep]
    clash = {k for k in names if names.count(k) > 1 or k in made}
    if clash:
        raise ValueError(f"keep has names that are not free: {', '.join(sorted(clash))}")
    return df.select(F.struct(*(F.col(f"`{k}`") for k in keep)).alias("row"), *needed)


def schema_with(df: DataFrame, columns: tuple[str, ...], more: str) -> T.StructType:
    """The fields of df named in columns, and those of the DDL text ``more``."""
    return T.StructType([*(df.schema[k] for k in columns), *T.StructType.fromDDL(more).fields])


def slices(batch: pa.RecordBatch):
    """A batch in pieces of BATCH_ROWS rows and about BATCH_BYTES, so that what a worker makes of one does not follow the session's batch size."""
    n = max(1, min(BATCH_ROWS, BATCH_BYTES * batch.num_rows // max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, n):
        yield batch.slice(at, n)


def arrow_map(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | T.StructType, start: Callable | None = None) -> DataFrame:
    """mapInArrow with one call of f per slice of a batch; start() makes f's state once for each task."""
    bounded(df.sparkSession)

    def run(batches):
        state = (start(),) if start else ()
        for batch in batches:
            for part in slices(batch):
                yield f(part, *state)
        tidy()

    return df.mapInArrow(run, schema)


def tidy() -> None:
    """Gives back what a task no longer needs: workers live on, for other operators' tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


#: Letters A-Z to a-z, all other bytes as they are.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
_PRIME = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x2127599BF4325C37  # odd, so it has an inverse modulo 2**64
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16) * 2
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            out = np.ones(size, np.uint64)
            out[1:] = np.uint64(b)
            _POWERS[k] = np.multiply.accumulate(out)
    return _POWERS[0][:n], _POWERS[1][:n]


#: Bytes whose spans are hashed at once: arrays of eight bytes for each stay small, and so do the powers that a worker keeps.
AT_ONCE = 1 << 18


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[starts:ends] for all spans, whose starts rise; a hash does not depend on where its span stands."""
    cuts = [*np.searchsorted(starts, np.arange(0, len(data), AT_ONCE)).tolist(), len(starts)]
    out = np.empty(len(starts), np.uint64)
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            low, high = starts[a], ends[a:b].max()
            out[a:b] = near_hashes(data[low:high], starts[a:b] - low, ends[a:b] - low)
    return out


def near_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """span_hashes() at once: differences of a running polynomial."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(_PRIME))


def word_spans(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes; is_word is a table of 256 booleans."""
    flags = np.zeros(len(data) + 2, np.int8)
    flags[1:-1] = is_word[data]
    steps = np.diff(flags)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


#: Bytes of words as the near-duplicate operators take them: all but space and U+0009-U+000D.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False


def text_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")

