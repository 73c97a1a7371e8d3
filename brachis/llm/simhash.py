"""SimHash near-duplicates: 64-bit fingerprints, compared exactly tile by tile.

A tile holds the fingerprints whose equal-width blocks have the same population counts. Two fingerprints within
``radius`` bits can only lie in tiles whose counts differ by ``radius`` in sum, so all other tile pairs are skipped. Each
fingerprint is sent to its own tile and, as a visitor, to the neighbouring tiles later in order. Large tiles are cut into
sub-tiles of a bounded size, which every visitor then meets. A task keeps one sub-tile in memory and streams the visitors
past it with numpy exclusive-or and bit counts. Only a spanning forest of each comparison leaves a task, so a group of
copies gives as many links as it has members, never all pairs.

Defined results: a null or wordless text has fingerprint zero and links like any other; a text of fewer words than a
shingle is one shingle; repeated rows are repeated in the output; a null doc_id never names a component, and where a
component has no other id its component_id is null. Only doc_id and text are read, whatever other columns there are.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_table, fold_ascii, release_memory, slices, stage_table, text_buffers, word_spans
from .components import connected_components

SEED = 42
RADIUS = 2
#: Blocks whose population counts make a tile: twice as many from this number of fingerprints on. Any number is exact; more
#: blocks send each fingerprint to more neighbouring tiles and compare it with fewer others.
BLOCKS, MORE_BLOCKS_FROM = 4, 20_000_000
SUB_TILE = 16_384


def simhash_batch(column: pa.Array, shingle: int = 3) -> np.ndarray:
    """Fingerprint of each text as uint64: a bit is set if it is set in over half of the shingles' hashes."""
    data, offsets = text_buffers(column)
    out = np.zeros(len(offsets) - 1, np.uint64)
    for lo, hi in slices(offsets, 500_000):
        part = fold_ascii(data[offsets[lo] : offsets[hi]])
        starts, ends, first = word_spans(part, offsets[lo : hi + 1] - offsets[lo])
        if not len(starts):
            continue
        # words joined by one space: a shingle is then one slice of the joined bytes
        lengths = ends - starts
        at = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(lengths + 1, out=at[1:])
        keep = np.ones(int(at[-1]), np.int64)
        keep[0] = starts[0]
        keep[at[1:-1]] = starts[1:] - ends[:-1]
        where = np.cumsum(keep)
        where[at[1:] - 1] = starts[0]
        joined = part[where]
        joined[at[1:] - 1] = 0x20
        text = joined.tobytes()
        begin, end = at[:-1], at[1:] - 1
        counts = np.diff(first)
        n_shingles = np.where(counts == 0, 0, np.maximum(counts - shingle + 1, 1))
        row = np.repeat(np.arange(hi - lo), n_shingles)
        cum = np.concatenate(([0], np.cumsum(n_shingles)))
        word = first[:-1][row] + np.arange(len(row)) - cum[row]
        last = np.minimum(word + shingle - 1, first[1:][row] - 1)
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(text[s:e], SEED) for s, e in zip(begin[word].tolist(), end[last].tolist(), strict=True)), np.uint64, len(row))
        some = np.flatnonzero(n_shingles)
        edges = cum[some]
        value = np.zeros(len(some), np.uint64)
        for bit in range(64):
            ones = np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), edges)
            value |= (2 * ones > n_shingles[some]).astype(np.uint64) << np.uint64(bit)
        out[lo + some] = value
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long with the same bits."""
    return _printed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).select("doc_id", "fp")


def _printed(given: DataFrame) -> DataFrame:
    """``given(doc_id, text)`` with a hash of the text and the fingerprint in place of the text."""
    given = given.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = T.StructType([*given.schema.fields[:2], T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            fp = simhash_batch(batch.column(2)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], names=schema.names)
        release_memory()

    return given.mapInArrow(run, schema)


def _block_counts(values: np.ndarray, blocks: int) -> np.ndarray:
    width = 64 // blocks
    mask = np.uint64((1 << width) - 1) if width < 64 else np.uint64(0xFFFFFFFFFFFFFFFF)
    return np.stack([np.bitwise_count((values >> np.uint64(width * b)) & mask).astype(np.int64) for b in range(blocks)])


def _neighbour_steps(blocks: int, radius: int) -> list[tuple[int, ...]]:
    """Count differences of the tiles that may hold a neighbour, one of each opposite pair."""
    steps = [s for s in product(range(-radius, radius + 1), repeat=blocks) if 0 < sum(map(abs, s)) <= radius]
    return [s for s in steps if s > tuple(-x for x in s)]


def forest(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spanning forest of the values within ``radius``: child and parent positions, and each value's tree."""
    n = len(values)
    tree = np.full(n, -1)
    children, parents = [], []
    left = np.arange(n)
    for root in range(n):
        if tree[root] >= 0:
            continue
        left = left[tree[left] < 0]
        left = left[left != root]
        tree[root], queue = root, [root]
        while queue and len(left):
            v = queue.pop()
            near = np.bitwise_count(values[left] ^ values[v]) <= radius
            found = left[near]
            if len(found):
                left = left[~near]
                tree[found] = root
                children.append(found)
                parents.append(np.full(len(found), v))
                queue.extend(found.tolist())
    none = np.empty(0, np.int64)
    return (np.concatenate(children) if children else none), (np.concatenate(parents) if parents else none), tree


def near_links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, sub_tile: int = SUB_TILE) -> DataFrame:
    """(src, dst) links among the distinct long fingerprints of ``fps(fp)`` that span every group within ``radius`` bits."""
    spark = fps.sparkSession
    width = 64 // blocks
    mask = -1 if width == 64 else (1 << width) - 1
    counts = [F.bit_count(F.shiftrightunsigned("fp", width * b).bitwiseAND(F.lit(mask).cast("long"))).cast("long") for b in range(blocks)]
    base = width + 2 * radius + 1
    key = sum((c * base**b for b, c in enumerate(counts)), F.lit(radius * sum(base**b for b in range(blocks))).cast("long"))
    own = fps.select("fp", key.alias("tile"))
    large = stage_table(own.groupBy("tile").count().where(F.col("count") > sub_tile).select("tile", F.ceil(F.col("count") / sub_tile).cast("int").alias("subs")), "large-tiles")
    steps = F.array(F.lit(0).cast("long"), *(F.lit(sum(x * base**b for b, x in enumerate(s))).cast("long") for s in _neighbour_steps(blocks, radius)))
    sent = own.select("fp", F.explode(F.transform(steps, lambda s: s + F.col("tile"))).alias("to"), "tile")
    if large.isEmpty():
        sent = sent.select(F.col("to").alias("tile"), F.lit(0).alias("sub"), (F.col("to") != F.col("tile")).alias("visits"), "fp")
    else:
        # at a tile in parts, its own fingerprint belongs to one part and visits the later ones; a visitor visits all
        home = (F.xxhash64("fp") % F.col("subs") + F.col("subs")) % F.col("subs")
        sent = sent.join(large.withColumnRenamed("tile", "to"), "to", "left").withColumn("subs", F.coalesce("subs", F.lit(1)))
        sent = sent.withColumn("home", F.when(F.col("to") == F.col("tile"), home.cast("int")).otherwise(F.lit(-1)))
        sent = sent.select(F.col("to").alias("tile"), F.explode(F.sequence(F.greatest("home", F.lit(0)), F.col("subs") - 1)).alias("sub"), "home", "fp")
        sent = sent.select("tile", "sub", (F.col("sub") != F.col("home")).alias("visits"), "fp")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = sent.repartition(parts, "tile", "sub").sortWithinPartitions("tile", "sub", "visits")

    def run(batches):
        state: dict = {"key": None, "own": [], "sorted": None, "tree": None}

        def settle():
            """Compare the sub-tile with itself once all of it has come."""
            if state["sorted"] is None:
                values = np.concatenate(state["own"]) if state["own"] else np.empty(0, np.uint64)
                child, parent, tree = forest(values, radius)
                state["sorted"], state["tree"], state["own"] = values, tree, []
                return values[child], values[parent]
            return None

        for batch in batches:
            tile, sub = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            visits = batch.column(2).to_numpy(zero_copy_only=False)
            fp = batch.column(3).to_numpy().view(np.uint64)
            turn = np.flatnonzero((tile[1:] != tile[:-1]) | (sub[1:] != sub[:-1]) | (visits[1:] != visits[:-1])) + 1
            src, dst = [], []
            for lo, hi in zip([0, *turn.tolist()], [*turn.tolist(), len(fp)], strict=True):
                if lo == hi:
                    continue
                if (tile[lo], sub[lo]) != state["key"]:
                    if (links := settle()) is not None:
                        src.append(links[0]), dst.append(links[1])
                    state = {"key": (tile[lo], sub[lo]), "own": [], "sorted": None, "tree": None}
                if not visits[lo]:
                    state["own"].append(fp[lo:hi])
                    continue
                if (links := settle()) is not None:
                    src.append(links[0]), dst.append(links[1])
                values, tree = state["sorted"], state["tree"]
                step = max(1, 2_000_000 // max(1, len(values)))
                for i in range(lo, hi if len(values) else lo, step):
                    some = fp[i : min(i + step, hi)]
                    a, b = np.nonzero(np.bitwise_count(some[:, None] ^ values[None, :]) <= radius)
                    if len(a):  # one link from a visitor to each tree that it meets
                        _, once = np.unique(a * len(values) + tree[b], return_index=True)
                        src.append(some[a[once]]), dst.append(values[b[once]])
            if src:
                yield _links(src, dst)
        if (links := settle()) is not None:
            yield _links([links[0]], [links[1]])
        state.clear()
        release_memory()

    return dealt.mapInArrow(run, "src long, dst long")


def _links(src: list, dst: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (src, dst)], names=["src", "dst"])


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for every row of ``docs``; component_id is the smallest doc_id reachable over
    links, root the smallest fingerprint, which tells components apart where doc_ids repeat."""
    prints = stage_table(_printed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))), "simhash")
    distinct = stage_table(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    blocks = BLOCKS if distinct.count() < MORE_BLOCKS_FROM else 2 * BLOCKS
    roots = connected_components(near_links(distinct.select("fp"), radius, blocks))
    member = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("component", "fp").alias("root"))
    named = member.groupBy("root").agg(F.min("low").alias("component_id"))
    label = stage_table(member.join(named, "root").select("fp", "root", "component_id"), "simhash-label")
    drop_table(distinct)
    return prints.join(label, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stand for their group: one row of each component.

    That is the row with the smallest doc_id (null after all others), of several with that id the one with the smallest hash
    of its text, and one of those that agree in both. Unlike rows that share an id, or have none, are kept apart.
    """
    marks = stage_table(simhash_components(docs, id_col, text_col, radius), "simhash-marks")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    first = marks.groupBy("root").agg(F.min(place).alias("p"))
    kept = stage_table(first.select(F.col("p.doc_id").alias("_kept"), F.col("p.text_hash").alias("_hash")).distinct(), "simhash-kept")
    same = (F.col("doc_id").eqNullSafe(F.col("_kept"))) & (F.col("text_hash") == F.col("_hash"))
    repeated = marks.join(kept, same, "left_semi").groupBy("doc_id", "text_hash").count().where(F.col("count") > 1)
    repeated = stage_table(repeated.select(F.col("doc_id").alias("_twice"), F.col("text_hash").alias("_twice_hash")), "simhash-repeated")
    drop_table(marks)
    row = F.col(id_col).eqNullSafe(F.col("_kept")) & (F.xxhash64(text_col) == F.col("_hash"))
    once = docs.join(kept, row, "left_semi")
    # a row that is there several times stays once
    if repeated.isEmpty():
        return once
    again = F.col(id_col).eqNullSafe(F.col("_twice")) & (F.xxhash64(text_col) == F.col("_twice_hash"))
    return once.join(repeated, again, "left_anti").unionByName(once.join(repeated, again, "left_semi").dropDuplicates([id_col, text_col]))
