"""Bulk-synchronous best-fit packing of token pieces into sequences.

Documents are cut into pieces of at most ``capacity`` tokens and range-sorted by falling length; open gaps are range-sorted
by falling size. Pieces are taken by tiers of length (over a half of the capacity, over a third, and so on), as best-fit
decreasing takes the long ones first. A round of a tier is

* sweep: each gap finds its successor, the longest unplaced piece that it holds, and asks for as many pieces from there on
  as surely fit. Gaps of one range partition are swept in one stream;
* conflicts: gaps that ask for the same pieces are settled by rank, larger gaps first. A gap's pieces begin at its
  successor, or where the pieces of the gaps before it end: a running sum and a running maximum, carried from one range
  partition to the next by one row each;
* update: gaps shrink by what they got, and the next round begins. Pieces longer than any gap open new sequences.

Pieces of one length are interchangeable, so a round needs their number by length (at most ``capacity`` rows, kept by the
driver) and the gaps, which stay on the executors; a piece meets its place by its rank in the sorted order at the end.

Defined results: a null text is empty and gives one piece of one end token; only texts over ``capacity`` tokens are cut;
repeated rows are packed as separate documents.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_table, ranked, release_memory, slices, stage_table, text_buffers
from .tokens import encoder, tokenizer_path

CAPACITY = 4096
END_ID = 1
#: Pieces longer than the capacity over each of these in turn are placed before shorter ones.
TIERS = (2, 3, 4, 6, 10, 20)
#: Gaps that one task sweeps.
GAPS_A_TASK = 1_000_000


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids, the end id last."""
    path = tokenizer or tokenizer_path()
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), *(T.StructField(x, T.LongType()) for x in ("start", "length", "ids_crc32"))])

    def run(batches):
        encode = encoder(path)
        for batch in batches:
            _, offsets = text_buffers(batch.column(1))
            for lo, hi in slices(offsets, 3_000_000):
                ids, at = encode(batch.column(1).slice(lo, hi - lo))
                row, piece, start, length, crc = [], [], [], [], []
                end = np.array([end_id], np.uint32).tobytes()
                raw, ends = memoryview(ids.astype("<u4").tobytes()), at.tolist()
                for k in range(hi - lo):
                    n = ends[k + 1] - ends[k] + 1
                    for p, s in enumerate(range(0, n, capacity)):
                        e = min(s + capacity, n)
                        value = zlib.crc32(raw[4 * (ends[k] + s) : 4 * (ends[k] + min(e, n - 1))])
                        row.append(k), piece.append(p), start.append(s), length.append(e - s)
                        crc.append(zlib.crc32(end, value) if e == n else value)
                ints = lambda x: pa.array(x, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(ints(row)), pa.array(piece, pa.int32()), ints(start), ints(length), ints(crc)], names=schema.names)
        release_memory()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def sweep(free: np.ndarray, lengths: np.ndarray, upto: np.ndarray, wanted: int = 0, lead: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of gaps by falling size: what each asks for, the running sum before it, and the running maximum of successor - sum.

    ``lengths`` are those of the unplaced pieces, falling; ``upto`` the number of pieces longer than each, and of all.
    A gap's pieces begin at sum + maximum. ``wanted`` and ``lead`` carry on from the gaps before.
    """
    at = np.searchsorted(-lengths, -free, side="left")
    want = np.where(at < len(lengths), free // lengths[np.minimum(at, len(lengths) - 1)], 0)
    before = wanted + np.cumsum(want) - want
    return want, before, np.maximum.accumulate(np.maximum(upto[at] - before, lead))


def _swept(gaps: DataFrame, lengths: np.ndarray, upto: np.ndarray, per_task: int, n: int) -> DataFrame:
    """(part, sequence_id, free, want, before, lead): the gaps in range partitions by falling size, each swept by itself."""
    names = ["part", "sequence_id", "free", "want", "before", "lead"]

    def run(batches):
        part, wanted, lead = TaskContext.get().partitionId(), 0, -(1 << 62)
        for batch in batches:
            if not batch.num_rows:
                continue
            free = batch.column(1).to_numpy()
            want, before, ahead = sweep(free, lengths, upto, wanted, lead)
            wanted, lead = int(before[-1] + want[-1]), int(ahead[-1])
            rest = (pa.array(x, pa.int64()) for x in (want, before, ahead))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(free), part), pa.int64()), *batch.columns, *rest], names=names)

    order = F.col("free").desc(), F.col("sequence_id")
    dealt = gaps.select("sequence_id", "free").repartitionByRange(max(1, -(-n // per_task)), *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(run, ", ".join(f"{x} long" for x in names))


def _settled(swept: DataFrame, carried: DataFrame, lengths: np.ndarray, upto: np.ndarray, begun: np.ndarray, capacity: int) -> DataFrame:
    """(sequence_id, free, length, at, n, offset): ``n`` pieces of a length, from its ``at``-th, put in a sequence; and, with a
    null length, each gap as it is then."""
    names = ["sequence_id", "free", "length", "at", "n", "offset"]

    def run(batches):
        for batch in batches:
            gap, free, want, before, lead, wanted, ahead = (batch.column(x).to_numpy() for x in ("sequence_id", "free", "want", "before", "lead", "wanted", "ahead"))
            first = wanted + before + np.maximum(lead - wanted, ahead)
            n = np.clip(upto[-1] - first, 0, want)
            first, n = np.where(n > 0, first, 0), n
            # the places of a gap, cut where the length changes
            low, high = (np.searchsorted(upto, x, side="right") - 1 for x in (first, np.maximum(first + n - 1, first)))
            runs = np.where(n > 0, high - low + 1, 0)
            owner = np.repeat(np.arange(len(gap)), runs)
            kind = np.repeat(low, runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
            start, stop = np.maximum(first[owner], upto[kind]), np.minimum((first + n)[owner], upto[kind + 1])
            size = (stop - start) * lengths[kind]
            filled = np.cumsum(size) - size
            filled -= np.repeat(filled[np.cumsum(runs)[runs > 0] - runs[runs > 0]], runs[runs > 0])
            left = free - np.bincount(owner, size, len(gap)).astype(np.int64)
            runs_of = (gap[owner], np.zeros(len(owner), np.int64), lengths[kind], begun[lengths[kind]] + start - upto[kind], stop - start, capacity - free[owner] + filled)
            none = np.ones(len(gap), bool)
            gaps_of = (gap, left, *(pa.array(np.zeros(len(gap), np.int64), mask=none) for _ in range(4)))
            for columns in (runs_of, gaps_of):
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in columns], names=names)

    return swept.join(F.broadcast(carried), "part").mapInArrow(run, ", ".join(f"{x} long" for x in names))


def place_pieces(spark: SparkSession, histogram: dict[int, int], capacity: int = CAPACITY, tiers: tuple = TIERS, per_task: int = GAPS_A_TASK) -> tuple[DataFrame, int]:
    """(length, at, n, sequence_id, offset): where the ``at``-th and the ``n`` - 1 next pieces of each length go; and the sequences."""
    left = np.zeros(capacity + 1, np.int64)
    left[list(histogram)] = list(histogram.values())
    begun = np.zeros(capacity + 1, np.int64)  # pieces of each length that have a place
    gaps, open_gaps, largest, opened, rounds = None, 0, 0, 0, []
    for least in [*(int(capacity / t) + 1 for t in tiers), 1]:
        while left[least:].any():
            lengths = np.flatnonzero(left)[::-1]
            lengths = lengths[lengths >= least]
            upto = np.concatenate(([0], np.cumsum(left[lengths])))
            stuck = lengths[lengths > largest]
            new = math.ceil((left[stuck] / (capacity // stuck)).sum() - 1e-9)
            if new:
                fresh = spark.range(opened, opened + new).select(F.col("id").alias("sequence_id"), F.lit(capacity).cast("long").alias("free"))
                gaps = fresh if gaps is None else gaps.unionByName(fresh)
                opened, open_gaps = opened + new, open_gaps + new
            swept = stage_table(_swept(gaps, lengths, upto, per_task, open_gaps), "swept-gaps")
            ends = swept.groupBy("part").agg(F.max(F.col("before") + F.col("want")).alias("n"), F.max("lead").alias("lead")).collect()  # one row a range partition
            carried, wanted, ahead = [], 0, -(1 << 62)
            for part, n, lead in sorted(tuple(r) for r in ends):
                carried.append((part, wanted, ahead))
                wanted, ahead = wanted + n, max(ahead, lead - wanted)
            carried = spark.createDataFrame(carried, "part long, wanted long, ahead long")
            settled = stage_table(_settled(swept, carried, lengths, upto, begun, capacity), "packing-round")
            rounds.append(settled)
            drop_table(swept)
            placed = settled.groupBy("length").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"), F.max("free").alias("free")).collect()  # at most one row a length
            for length, n, *_ in placed:
                if length is not None:
                    left[length] -= n
                    begun[length] += n
            smallest = int(np.flatnonzero(left)[0]) if left.any() else capacity + 1
            gaps = settled.where(F.col("length").isNull() & (F.col("free") >= smallest)).select("sequence_id", "free")
            open_gaps, largest = next(((rows, free) for length, _, rows, free in placed if length is None))
    if not rounds:
        return spark.createDataFrame([], "length long, at long, n long, sequence_id long, offset long"), 0
    paths = [r._brachis_path for r in rounds]
    return spark.read.schema(rounds[0].schema).parquet(*paths).where("length is not null").select("length", "at", "n", "sequence_id", "offset"), opened


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece's place, gapless from offset 0."""
    cut = pieces(docs, capacity, end_id, tokenizer, id_col, text_col)
    # the number of a row settles ties, so repeated rows are told apart
    cut = stage_table(cut.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most capacity rows
    longer, before = {}, 0
    for length in sorted(histogram, reverse=True):
        longer[length], before = before, before + histogram[length]
    spark = docs.sparkSession
    placed, _ = place_pieces(spark, histogram, capacity)
    starts = spark.createDataFrame(list(longer.items()) or [(0, 0)], "length long, longer long")  # at most capacity rows
    each = placed.join(F.broadcast(starts), "length").select("length", F.col("longer").alias("longer"), "at", "sequence_id", "offset", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k"))
    each = each.select((F.col("longer") + F.col("at") + F.col("k")).alias("rank"), "sequence_id", (F.col("offset") + F.col("k") * F.col("length")).alias("offset"))
    sorted_pieces = ranked(cut, F.col("length").desc(), "_row")
    return sorted_pieces.join(each, "rank").select(*(c for c in cut.columns if c != "_row"), "sequence_id", "offset")
