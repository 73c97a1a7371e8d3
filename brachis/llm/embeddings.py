"""Near-duplicate embeddings by sorted projection passes.

A pass gives each vector a code of concatenated random hyperplane signs, orders all vectors lexicographically by it (a
range partitioned sort), and compares each with a bounded window of its predecessors; verified pairs of all passes are
united by distributed connected components. What a pass sorts is not the vectors but their codes and sketches: one byte a
component, with a bound of what rounding may have changed. A sketch settles all pairs but those within that bound of the
threshold, which are compared by the vectors themselves. The first passes follow from the number of vectors as if these were spread
evenly. Each pass then tells, by how long a prefix a vector shares with those ``window`` places away and by its distances
from the planes, how probably a partner right at the threshold was met. Vectors that may have missed one with more than
1 - ``recall`` get further passes among themselves, or are compared all with all, tile by tile, where that is less work: of
an unmet pair both are such. A window full of vectors that a vector is linked with hides nothing. Exact copies are one vector with a count from the start.
Windows cannot hold a large group, so the links within each component are then completed without pairs. Its core, the
vectors within half the threshold's angle of its first one, are all linked with each other (angles add up at most), so
their links are a count; the rest is compared with the whole component, tile by tile, and only counts leave the tiles. A
large group of near copies thus costs one comparison a member.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, link with nothing, as do
vectors of different lengths; a row with a null vec_id links with nothing and has a null component_id; repeated rows are
copies that link with each other. Labels and other columns play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_table, stage_table
from .components import connected_components

THRESHOLD = 0.95
WINDOW = 48
RECALL = 0.99
BITS = 60
TILE = 2_048
#: Vectors whose comparison with one vector costs about what a vector's pass costs (measured: 9 microseconds and 15
#: nanoseconds), and those that one task compares.
PASS_COST = 600
EXACT_TILE = 16_384
#: Rows of a pass that one task sorts, and visitors of a tile that one task compares with it.
SORT_TASK = 100_000
VISITORS = 16_384
_SEED = 1_009
_GRID = np.linspace(0, 8, 4_097)
_LOG_AGREE = np.log([0.5 + 0.5 * math.erf(z / math.sqrt(2)) for z in _GRID])


def passes_for(n: int, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes after which a pair at the threshold has met in a window with probability ``recall``, for n vectors."""
    agree = 1 - math.acos(threshold) / math.pi
    meet = agree ** max(1.0, math.log2(max(2, n) / window))
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def unit_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, unit): the vector over its length as little-endian doubles; null where it can link with nothing."""
    kind = table.schema[id_col].dataType
    schema = T.StructType([T.StructField("vec_id", kind), T.StructField("unit", T.BinaryType())])

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            at, flat = column.offsets.to_numpy().astype(np.int64), column.values
            whole = ~np.isnan(x := flat.to_numpy(zero_copy_only=False).astype(np.float64)) & np.isfinite(x)  # nulls are nan here
            size = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(at), 0)
            out = np.full(batch.num_rows, None, object)
            for d in np.unique(size[size > 0]):
                rows = np.flatnonzero(size == d)
                place = at[rows][:, None] + np.arange(d)
                fit = whole[place].all(1)
                v = np.where(fit[:, None], x[place], 0.0)
                top = np.abs(v).max(1)
                fit &= top > 0
                v = v[fit] / top[fit][:, None]  # so that no length over- or underflows
                v = (v / np.sqrt((v * v).sum(1))[:, None] + 0.0).astype("<f8")
                out[rows[fit]] = [u.tobytes() for u in v]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.tolist(), pa.binary())], names=schema.names)

    given = table.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return given.mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of one length as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)


def _by_length(size: np.ndarray) -> list[np.ndarray]:
    return [np.flatnonzero(size == x) for x in np.unique(size)]


def _planes(d: int, number: int) -> np.ndarray:
    return np.random.default_rng([_SEED, d, number]).standard_normal((d, BITS))


def _sketched(x: np.ndarray) -> np.ndarray:
    """Rows of bytes: scale and rounding error (float32), and one signed byte a component."""
    scale = (np.abs(x).max(1) / 127).astype("<f4")
    q = np.rint(x / scale[:, None].astype(np.float64))
    error = np.sqrt(((x - q * scale[:, None].astype(np.float64)) ** 2).sum(1)) * 1.0001 + 1e-7
    head = np.stack([scale, error.astype("<f4")], 1).view(np.uint8)
    return np.concatenate([head, q.astype(np.int8).view(np.uint8)], 1)


def _drawn(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors that sketches stand for, and how far the true ones may be from them."""
    head = np.ascontiguousarray(rows[:, :8]).view("<f4")
    return rows[:, 8:].view(np.int8).astype(np.float32) * head[:, :1], head[:, 1].astype(np.float64)


def _bytes(column: pa.Array) -> np.ndarray:
    """Rows of one length as a matrix of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _code(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    return (x @ planes > 0) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _cuts(units: DataFrame, passes: range, n: int) -> dict[tuple[int, int], np.ndarray]:
    """For each length and pass the codes that cut its ``n`` rows into buckets of about ``SORT_TASK``, from a bounded sample."""
    buckets = -(-n // SORT_TASK)
    if buckets < 2:
        return {}
    some = units.select("unit").sample(min(1.0, 40 * buckets / n), seed=_SEED).limit(80 * buckets).collect()
    out = {}
    for size in {len(r.unit) for r in some}:
        x = np.frombuffer(b"".join(r.unit for r in some if len(r.unit) == size), "<f8").reshape(-1, size // 8)
        for p in passes:
            out[size // 8, p] = np.sort(_code(x, _planes(size // 8, p)))[40 :: max(1, len(x) // buckets)]
    return out


def _codes(units: DataFrame, passes: range, n: int) -> DataFrame:
    """(size, pass, bucket, code, rep, sketch) of the ``n`` rows in every pass."""
    kind, cuts = units.schema["rep"].dataType, _cuts(units, passes, n)
    schema = T.StructType([T.StructField("size", T.IntegerType()), T.StructField("pass", T.IntegerType()), T.StructField("bucket", T.IntegerType()), T.StructField("code", T.LongType()), T.StructField("rep", kind), T.StructField("sketch", T.BinaryType())])

    def run(batches):
        planes: dict[tuple[int, int], np.ndarray] = {}
        none = np.empty(0, np.int64)
        for batch in batches:
            size = np.array([len(x) for x in batch.column(1).to_pylist()], np.int32)
            for rows in _by_length(size):
                some = batch.take(pa.array(rows))
                x = _matrix(some.column(1))
                d, n = x.shape[1], len(rows)
                sketch = pa.array([u.tobytes() for u in _sketched(x)], pa.binary())
                for p in passes:
                    if (d, p) not in planes:
                        planes[d, p] = _planes(d, p)
                    code = _code(x, planes[d, p])
                    bucket = np.searchsorted(cuts.get((d, p), none), code, side="right").astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(size[rows]), pa.array(np.full(n, p, np.int32)), pa.array(bucket), pa.array(code), some.column(0), sketch], names=schema.names)

    return units.select("rep", "unit").mapInArrow(run, schema)


def _span(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[int], list[int]]:
    """Of pairs of positions, as many as join what they join."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = up[x]
        return x

    a, b = [], []
    for left, right in pairs:
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            if (x := root(i)) != (y := root(j)):
                up[x] = y
                a.append(i), b.append(j)
    return a, b


def _log_miss(x: np.ndarray, planes: np.ndarray, prefix: np.ndarray, threshold: float) -> np.ndarray:
    """Log probability that a partner at the threshold, in a random direction from x, differs in the first prefix + 1 bits."""
    apart = np.abs(x @ planes) * (threshold / math.sqrt(1 - threshold * threshold))
    agree = np.cumsum(np.interp(apart, _GRID, _LOG_AGREE), axis=1)
    met = np.where(prefix < 0, 1.0, np.exp(agree[np.arange(len(x)), np.clip(prefix, 0, BITS - 1)]))
    return np.log1p(-np.minimum(np.where(prefix >= BITS, 0.0, met), 1 - 1e-12))


def _near_pairs(x: np.ndarray, error: np.ndarray, window: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows at most ``window`` apart: pairs (later, earlier) that may link, and whether they surely do."""
    n, step = len(x), 4 * window
    later, earlier, sure = [], [], []
    for lo in range(0, n, step):
        hi, begin = min(lo + step, n), max(0, lo - window)
        dots = x[lo:hi] @ x[begin:hi].T
        i, j = np.nonzero(dots >= threshold - 2.1 * error.max(initial=0) - 1e-3)
        dot, i, j = dots[i, j].astype(np.float64), i + lo, j + begin
        here = (j < i) & (i - j <= window)
        i, j, dot = i[here], j[here], dot[here]
        bound = error[i] + error[j] + 3 * error[i] * error[j] + 1e-5
        here = dot >= threshold - bound
        later.append(i[here]), earlier.append(j[here]), sure.append((dot >= threshold + bound)[here])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *later]), np.concatenate([none, *earlier]), np.concatenate([none.astype(bool), *sure])


def window_links(codes: DataFrame, threshold: float, window: int, n: int, passes: int) -> DataFrame:
    """(src, dst, miss) among the ``n`` rows in each of the ``passes``, at most ``window`` apart in the order of their pass: links as many as join what
    they join, with miss 0; pairs that only the vectors can settle, with miss 1; and, without dst, the log probability that
    src missed a partner in a pass. Rows at the edge of a bucket are not counted as having had a pass."""
    kind = codes.schema["rep"].dataType
    schema = T.StructType([T.StructField("src", kind), T.StructField("dst", kind), T.StructField("miss", T.DoubleType())])
    cut = n > SORT_TASK
    order, key_of = ["size", "pass", "bucket", "code", "rep"], ["size", "pass", "bucket"]

    def run(batches):
        planes: dict[tuple[int, int], np.ndarray] = {}

        def step(batch, fresh: int, told: int, upto: int):
            """What rows from ``fresh`` on and the rows before them give, and what the passes of those from ``told`` to ``upto`` were worth."""
            total = batch.num_rows
            group = (batch.column(0).to_numpy().astype(np.int64) * 100_000 + batch.column(1).to_numpy()) * 1_000_000 + batch.column(2).to_numpy()
            links, doubts, rated, worth = [], [], [], []
            for rows in _by_length(group):  # contiguous, as the rows are sorted
                first, n = int(rows[0]), len(rows)
                x, error = _drawn(_bytes(batch.column(5).slice(first, n)))
                code = batch.column(3).slice(first, n).to_numpy()
                i, j, sure = _near_pairs(x, error, window, threshold)
                new = i + first >= fresh
                links.append((rows[i[new & sure]], rows[j[new & sure]]))
                doubts.append((rows[i[new & ~sure]], rows[j[new & ~sure]]))
                far = np.full(n, -1)  # bits shared with the unlinked rows ``window`` places before and after
                if n > window:
                    shared = BITS - np.frexp((code[window:] ^ code[:-window]).astype(np.float64))[1]
                    linked = i[sure & (i - j == window)] - window
                    shared[linked] = -1
                    far[window:] = shared
                    far[:-window] = np.maximum(far[:-window], shared)
                # rows before and after them may be in another bucket
                if first == 0 or cut:
                    far[: max(0, window)] = BITS
                if rows[-1] == total - 1 or cut:
                    far[max(0, n - window) :] = BITS
                lo, hi = max(told - first, 0), min(upto - first, n)
                if lo < hi:
                    key = x.shape[1], int(batch.column(1)[first].as_py())
                    if key not in planes:
                        planes.clear()
                        planes[key] = _planes(*key)
                    rated.append(rows[lo:hi])
                    worth.append(_log_miss(x[lo:hi], planes[key], far[lo:hi], threshold))
            a, b = _span(links)
            none = np.empty(0, np.int64)
            c, d = (np.concatenate([none, *(p[k] for p in doubts)]) for k in (0, 1))
            ids, at = batch.column(4), np.concatenate([none, *rated])
            left = pa.concat_arrays([ids.take(pa.array(x, pa.int64())) for x in (a, c, at)])
            right = pa.concat_arrays([*(ids.take(pa.array(x, pa.int64())) for x in (b, d)), pa.nulls(len(at), ids.type)])
            value = np.concatenate([np.zeros(len(a)), np.ones(len(c)), *worth])
            return pa.RecordBatch.from_arrays([left, right, pa.array(value)], names=schema.names)

        held, told = None, 0
        for batch in batches:
            batch = pa.RecordBatch.from_arrays([batch.column(k) for k in range(6)], names=["size", "pass", "bucket", "code", "rep", "sketch"])
            fresh = 0
            if held is not None:
                fresh = held.num_rows
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            upto = max(told, batch.num_rows - window)
            yield step(batch, fresh, told, upto)
            stay = max(0, batch.num_rows - 2 * window)
            held, told = batch.slice(stay), upto - stay
        if held is not None:
            yield step(held, held.num_rows, told, held.num_rows)

    # buckets follow from the rows, so that few rows stand at an edge whatever the session's settings
    return codes.repartition(passes * max(1, -(-n // SORT_TASK)), *key_of).sortWithinPartitions(*order).mapInArrow(run, schema)


def settled(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Those (src, dst) of the ``pairs`` whose vectors ``classes(rep, unit)`` link."""
    side = lambda name, unit: classes.select(F.col("rep").alias(name), F.col("unit").alias(unit))
    met = pairs.distinct().join(side("src", "a"), "src").join(side("dst", "b"), "dst").select("src", "dst", "a", "b")
    schema = T.StructType([met.schema["src"], met.schema["dst"]])

    def run(batches):
        for batch in batches:
            size = np.array([len(x) for x in batch.column(2).to_pylist()])
            for rows in _by_length(size):
                some = batch.take(pa.array(rows))
                near = np.einsum("ij,ij->i", _matrix(some.column(2)), _matrix(some.column(3))) >= threshold
                yield pa.RecordBatch.from_arrays([some.column(k).filter(pa.array(near)) for k in (0, 1)], names=schema.names)

    return met.mapInArrow(run, schema)


def exact_links(units: DataFrame, n: int, threshold: float, tile: int = EXACT_TILE) -> DataFrame:
    """(src, dst) links that join what all pairs of the ``n`` rows of ``units(rep, unit)`` join: each task compares two tiles."""
    kind = units.schema["rep"].dataType
    schema = T.StructType([T.StructField("src", kind), T.StructField("dst", kind)])
    tiles = max(1, -(-n // tile))
    home = F.pmod(F.xxhash64("unit"), F.lit(tiles)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    met = units.select(F.octet_length("unit").alias("size"), home.alias("home"), other.alias("other"), "rep", "unit")
    met = met.select("size", F.least("home", "other").alias("low"), F.greatest("home", "other").alias("high"), "home", "rep", "unit")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        own = table["home"].to_numpy()
        ids, x = table["rep"].combine_chunks(), _matrix(table["unit"].combine_chunks())
        left, right = np.flatnonzero(own == table["low"][0].as_py()), np.flatnonzero(own == table["high"][0].as_py())
        a, b, y, tree = [], [], x[right], np.arange(len(x))
        for lo in range(0, len(left), 128):
            near = x[left[lo : lo + 128]] @ y.T >= threshold
            for i, row in zip(left[lo : lo + 128].tolist(), near, strict=True):
                met = right[row]
                new = np.zeros(len(x), bool)
                new[tree[met]] = True
                new[tree[i]] = False
                for other in np.flatnonzero(new).tolist():  # one link to each tree that it meets, which it joins
                    a.append(i), b.append(int(met[np.argmax(tree[met] == other)]))
                    tree[tree == other] = tree[i]
        return pa.table([ids.take(pa.array(a, pa.int64())), ids.take(pa.array(b, pa.int64()))], names=schema.names)

    return met.groupBy("size", "low", "high").applyInArrow(run, schema)


def all_links(classes: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> DataFrame:
    """(src, dst): links of ``classes(rep, unit)`` by passes, until no vector may have missed one by more than ``recall`` allows."""
    allowed = math.log(1 - recall)
    pending, n, done, links = classes.select("rep", "unit", F.lit(0.0).alias("miss")), classes.count(), 0, None
    more = passes_for(n, threshold, window, recall)
    while True:
        found = stage_table(window_links(_codes(pending, range(done, done + more), n), threshold, window, n, more), "window-links")
        done += more
        new = found.where("dst is not null and miss = 0").select("src", "dst")
        doubts = found.where("dst is not null and miss = 1").select("src", "dst")
        if not doubts.isEmpty():
            new = new.unionByName(settled(doubts, classes, threshold))
        links = new if links is None else links.unionByName(new)
        miss = found.where("dst is null").groupBy(F.col("src").alias("rep")).agg(F.sum("miss").alias("passed"))
        total = F.col("miss") + F.coalesce("passed", F.lit(0.0))
        after = stage_table(pending.join(miss, "rep", "left").select("rep", "unit", total.alias("miss")).where(F.col("miss") > allowed), "pending-units")
        drop_table(pending)
        pending = after
        n, mean = pending.agg(F.count(F.lit(1)), F.avg("miss")).first()
        if not n:
            return links
        needed = max(1.0, (mean - allowed) / max(-mean / done, 1e-9))
        if n <= 2 * PASS_COST * needed:
            return links.unionByName(exact_links(pending, n, threshold))
        more = min(passes_for(n, threshold, window, recall), math.ceil(needed))


def with_core(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``members(component, rep, n, unit)`` with ``core``: whether a vector is so near to its component's first that all such
    are linked with each other. A margin far above rounding errors keeps doubtful ones out."""
    least = math.cos(math.acos(threshold) / 2) + 1e-9
    members = members.select("component", "rep", "n", "unit")
    # a table of its own, so that the rows of a large component need not come to the task that aggregated it
    first = stage_table(members.groupBy("component").agg(F.min_by("unit", "rep").alias("first")), "first-units")
    schema = T.StructType([*members.schema.fields, T.StructField("core", T.BooleanType())])

    def run(batches):
        for batch in batches:
            size = np.array([len(x) for x in batch.column(3).to_pylist()], np.int64)
            same = size == np.array([len(x) for x in batch.column(4).to_pylist()], np.int64)
            core = np.zeros(batch.num_rows, bool)
            for rows in _by_length(np.where(same, size, -1)):
                if same[rows[0]]:
                    some = batch.take(pa.array(rows))
                    core[rows] = np.einsum("ij,ij->i", _matrix(some.column(3)), _matrix(some.column(4))) >= least
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(core, pa.bool_())], names=schema.names)

    return members.join(first, "component").mapInArrow(run, schema)


def component_links(members: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, visitors: int = VISITORS) -> DataFrame:
    """(rep, links): for ``members(component, rep, n, unit, core)``, how many vectors of its component each one links with.

    ``n`` is the number of copies that a row stands for. Vectors outside the core are cut into tiles; a tile is held in
    memory, and the core and the members of the tiles before it stream past, in several parts where they are many.
    """
    kind = members.schema["rep"].dataType
    schema = T.StructType([T.StructField("rep", kind), T.StructField("links", T.LongType())])
    inner = stage_table(members.where("core").groupBy("component").agg(F.sum("n").alias("core_n")), "cores")
    among = members.where("core").join(inner, "component").select("rep", (F.col("core_n") - F.col("n")).alias("links"))
    outer = F.count_if(~F.col("core"))
    sizes = members.groupBy("component").agg(F.ceil(outer / tile).cast("int").alias("tiles"), F.ceil(F.count(F.lit(1)) / visitors).cast("int").alias("salts"))
    sizes = stage_table(sizes.where("tiles > 0"), "tiled")
    hashed = lambda n: F.pmod(F.xxhash64("rep"), F.col(n).cast("long")).cast("int")
    met = members.join(sizes, "component").withColumn("home", F.when(F.col("core"), -1).otherwise(hashed("tiles")))
    met = met.select("component", F.explode(F.sequence(F.greatest("home", F.lit(0)), F.col("tiles") - 1)).alias("tile"), "home", "salts", "rep", "n", "unit")
    # a tile's own rows go to all of its parts, a visitor to one
    part = F.when(F.col("tile") == F.col("home"), F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("rep", F.lit(1)), F.col("salts").cast("long")).cast("int")))
    met = met.select("component", "tile", F.explode(part).alias("salt"), (F.col("tile") != F.col("home")).alias("visits"), "rep", "n", "unit")
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = met.repartition(parts, "component", "tile", "salt").sortWithinPartitions("component", "tile", "salt", "visits")

    def out(ids: pa.Array, links: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids, pa.array(links.astype(np.int64))], names=schema.names)

    def run(batches):
        key, parts, own = None, [], None

        def settle():
            x, n = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
            # a unit vector links with itself; one part of the tile compares its own rows with each other
            links = (x @ x.T >= threshold) @ n - n if key[2] == 0 else np.zeros(len(n), np.int64)
            return [pa.concat_arrays([p[0] for p in parts]), x, n, links]

        for batch in batches:
            marks = list(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True))
            turns = [0, *(i for i in range(1, len(marks)) if marks[i] != marks[i - 1]), len(marks)]
            for lo, hi in zip(turns[:-1], turns[1:], strict=True):
                if lo == hi:
                    continue
                if marks[lo][:3] != key:
                    if own is None and parts:
                        own = settle()
                    if own is not None:
                        yield out(own[0], own[3])
                    key, parts, own = marks[lo][:3], [], None
                rows = (batch.column(4).slice(lo, hi - lo), _matrix(batch.column(6).slice(lo, hi - lo)), batch.column(5).slice(lo, hi - lo).to_numpy())
                if not marks[lo][3]:
                    parts.append(rows)
                    continue
                if own is None and parts:
                    own = settle()
                for at in range(0, hi - lo if own is not None else 0, 1024):
                    some = slice(at, at + 1024)
                    near = rows[1][some] @ own[1].T >= threshold
                    own[3] = own[3] + rows[2][some] @ near
                    yield out(rows[0].slice(at, 1024), near @ own[2])
        if own is None and parts:
            own = settle()
        if own is not None:
            yield out(own[0], own[3])

    return dealt.mapInArrow(run, schema).unionByName(among).groupBy("rep").agg(F.sum("links").alias("links"))


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``table``."""
    # equal vectors are known by two hashes, so that vectors themselves are only moved to be compared
    same = [F.xxhash64("unit").alias("h1"), F.xxhash64("unit", F.lit(1)).alias("h2")]
    units = stage_table(unit_vectors(table, id_col, vector_col).select("vec_id", "unit", *same), "units")
    fit = F.col("unit").isNotNull() & F.col("vec_id").isNotNull()
    each = units.where(fit).groupBy("h1", "h2").agg(F.first("unit").alias("unit"), F.min(F.struct("vec_id", F.col("h1").alias("h"))).alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = stage_table(each, "unit-classes")
    # a representative is known by its id and a hash of its vector, as rows of one id may hold different vectors
    roots = connected_components(all_links(classes, threshold, window, recall))
    roots = stage_table(roots.select(F.col("node").alias("rep"), "component"), "roots")
    members = stage_table(with_core(classes.drop("h1", "h2").join(roots, "rep"), threshold), "linked-units")
    links = component_links(members, threshold)
    label = classes.drop("unit").join(roots, "rep", "left").join(links, "rep", "left")
    label = stage_table(label.select("h1", "h2", F.coalesce("component", "rep")["vec_id"].alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "unit-labels")
    drop_table(classes)
    inside = units.where(fit).select("vec_id", "h1", "h2").join(label, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    outside = units.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = inside.unionByName(outside)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
