"""Helpers shared by the training-data operators: shared tables, guarded columns, byte-level word spans."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the sizing, shingling and fingerprint operators: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_tables: list[tuple[SparkSession, str]] = []
_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a temporary one only in local mode without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="brachis-"))
        base = _own[0]
    return base.rstrip("/")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors. The table goes with ``drop_table`` or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/brachis-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _tables.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._brachis_path = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete a table of ``stage_table`` that no later job reads."""
    path = getattr(df, "_brachis_path", None)
    if path:
        _delete(df.sparkSession, path)
        _tables[:] = [t for t in _tables if t[1] != path]


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _drop_all() -> None:
    for spark, path in _tables:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the JVM may be gone already
            return


def ranked(df: DataFrame, *order, per_task: int = 100_000) -> DataFrame:
    """``df`` with ``rank`` from 0 in the given order, by range partitions and their counts instead of one sorted task."""
    parts = max(1, -(-df.count() // per_task))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    kept = stage_table(dealt.select("*", F.shiftright(place, 33).alias("_part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")), "ranked")
    before, table = 0, []
    for part, n in sorted(tuple(r) for r in kept.groupBy("_part").count().collect()):  # one row a range partition
        table.append((part, before))
        before += n
    offsets = df.sparkSession.createDataFrame(table, "_part long, _before long")
    return kept.join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_at") + F.col("_before")).drop("_part", "_at", "_before")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_caches: dict[str, dict] = {}


def own_cache(name: str) -> dict:
    """What a worker keeps for an operator's next task. Those of other operators go, as a worker outlives its stage."""
    for other in [x for x in _caches if x != name]:
        del _caches[other]
    return _caches.setdefault(name, {})


def release_memory() -> None:
    """Give memory that a task has freed back to the system, as a worker outlives its task and shares its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def ascii_lower(column):
    """A-Z to a-z; other letters stay (``lower`` would also turn the Kelvin sign into an ASCII k)."""
    return F.translate(column, UPPER, LOWER)


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of an Arrow string column without making Python strings; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = 4_000_000) -> list[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a longer single row stands alone)."""
    out, start, n = [], 0, len(offsets) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
        out.append((start, min(stop, n)))
        start = min(stop, n)
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of each row (one more entry than rows)."""
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def fold_ascii(data: np.ndarray) -> np.ndarray:
    return _FOLD[data]
