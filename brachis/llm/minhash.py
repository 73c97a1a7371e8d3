"""MinHash fingerprints: universal hash permutations over word shingles in vectorised numpy, bands joined in Spark.

Words (ASCII letters folded) are hashed straight from the Arrow buffers by prefix sums of a polynomial, five consecutive
words make a shingle, and each of ``PERMUTATIONS`` permutations x -> a x + b (a odd, modulo 2^32) keeps its minimum over a
text's shingles, of which the fingerprint holds 16 mixed bits. The likeness of two fingerprints is the share of equal
places, an estimate of the Jaccard similarity of the shingle sets.

Defined results: a null text is empty; a text of fewer words than a shingle is one shingle; wordless texts are all alike
and like no other text; repeated rows are fingerprinted alike; whole texts count, however long. Documents with the same
doc_id stand in the order of a hash of their texts, null ids after all others; ids may be of any orderable type.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_table, fold_ascii, release_memory, slices, stage_table, text_buffers, word_spans
from .components import connected_components

SHINGLE = 5
PERMUTATIONS = 128
THRESHOLD = 0.8
#: A pair at the threshold shares a band with probability 0.9992.
BANDS, BAND_ROWS = 18, 5
#: Documents to be verified that are broadcast by id (some 20 MB); for more all texts are shuffled once more, compressed.
BROADCAST_ENDS = 300_000
#: A bucket's part that one task holds in memory; larger buckets are cut, and every later member meets every part.
SUB_TILE = 2_048
#: One node in so many is looked at to find large buckets.
KEY_SAMPLE = 64
_BASE = 0x9E3779B97F4A7C15 | 1
_SEED = 42


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


def _powers(n: int, base: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.ones(max(n, 1), np.uint64)
    have, step = 1, base & (2**64 - 1)
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(step)
        have, step = have + more, step * step & (2**64 - 1)
    return out


_tables: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n:
        _tables["up"], _tables["down"] = _powers(n, _BASE), _powers(n, _inverse(_BASE))
    return _tables["up"], _tables["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    return rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE, wide: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every shingle of every row, of 32 bits or (``wide``) of 64, and each row's number of shingles."""
    part = fold_ascii(data)
    starts, ends, first = word_spans(part, offsets)
    up, down = _power_tables(len(part) + 1)
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
    words = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    counts = np.diff(first)
    n = np.where(counts == 0, 0, np.maximum(counts - shingle + 1, 1))
    row = np.repeat(np.arange(len(counts)), n)
    at = first[:-1][row] + np.arange(len(row)) - (np.cumsum(n) - n)[row]
    last = first[1:][row]
    total = np.zeros(len(row), np.uint64)
    for k in range(shingle):
        there = at + k < last
        total += np.where(there, words[np.minimum(at + k, len(words) - 1)], 0).astype(np.uint64) * np.uint64(_BASE + 2 * k * k + 2 * k) if len(words) else 0
    return (_mix(total) if wide else (_mix(total) >> np.uint64(32)).astype(np.uint32)), n


def minhash_batch(column: pa.Array, permutations: int = PERMUTATIONS, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints of an Arrow string column: rows x permutations of uint16."""
    data, offsets = text_buffers(column)
    a, b = _permutations(permutations)
    low = np.full((len(offsets) - 1, permutations), 0xFFFFFFFF, np.uint32)
    for lo, hi in slices(offsets, 300_000):
        hashes, n = shingle_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], shingle)
        some = np.flatnonzero(n)
        if not len(some):
            continue
        edges = (np.cumsum(n) - n)[some]
        value = np.empty_like(hashes)
        for k in range(permutations):
            np.multiply(hashes, a[k], out=value)
            np.add(value, b[k], out=value)
            low[lo + some, k] = np.minimum.reduceat(value, edges)
    return ((low * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)


def _binary(signatures: np.ndarray) -> pa.Array:
    width = signatures.shape[1] * 2
    offsets = np.arange(len(signatures) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(signatures), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(signatures.astype(">u2").tobytes())])


def _hexes(signatures: np.ndarray) -> list[str]:
    width, text = signatures.shape[1] * 4, signatures.astype(">u2").tobytes().hex()
    return [text[i : i + width] for i in range(0, len(text), width)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, signature) with the signature's places as big-endian 16-bit numbers."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("signature", T.BinaryType())])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _binary(minhash_batch(batch.column(1)))], names=schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def _packed(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """``rows`` with the text, or null, compressed: what is shuffled is two thirds of what Spark makes of it."""
    at, names = rows.columns.index(text_col), list(rows.columns)
    fields = [T.StructField(f.name, T.BinaryType()) if f.name == text_col else f for f in rows.schema.fields]

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                columns = [c.slice(lo, 500) for c in batch.columns]
                columns[at] = pa.array([None if x is None else pack(x.encode()) for x in columns[at].to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays(columns, names=names)
        release_memory()

    return rows.mapInArrow(run, T.StructType(fields))


def _unpacked(values: list) -> list:
    unpack = zstandard.ZstdDecompressor().decompress
    return [None if x is None else unpack(x).decode() for x in values]


def with_successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None, marks: DataFrame | None = None) -> DataFrame:
    """(block, guest, doc_id, text, mark): the documents in blocks by descending doc_id, each row's successor being the next,
    their texts compressed.

    Rows of a block are in one partition and in order; after them stands, as a guest, the first row of the next block (for
    the last block, of the first). Blocks begin where the range partitions of ids and text hashes begin, so that rows of one
    id are dealt to several; texts are shuffled once and never gathered. ``marks(doc_id, tie, mark)`` come to the rows with
    that id and text hash: a row without text stands before them and holds the mark.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the larger key stands first: larger ids, then smaller hashes; a null id is smaller than any other
    key = F.struct("doc_id", F.bitwise_not(F.xxhash64("text")).alias("tie"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = blocks or 4 * parts
    thin = given.select(key.alias("key")).repartitionByRange(blocks, F.col("key").desc())
    heads = thin.groupBy(F.spark_partition_id().alias("part")).agg(F.max("key").alias("key")).select("key.doc_id", "key.tie").distinct().collect()  # one row a block
    kind = given.schema["doc_id"].dataType
    heads = sorted(heads, key=lambda r: (r.doc_id is not None, r.doc_id if r.doc_id is not None else 0, r.tie), reverse=True)
    table = F.array(*(F.struct(F.lit(r.doc_id).cast(kind).alias("doc_id"), F.lit(r.tie).alias("tie")) for r in heads)) if heads else F.array().cast(T.ArrayType(given.select(key.alias("key")).schema["key"].dataType))
    block = F.size(F.filter(table, lambda h: h >= F.col("key"))) - 1
    placed = given.withColumn("key", key).withColumn("block", block)
    own = F.struct(F.col("block"), F.lit(False).alias("guest"))
    away = F.struct(F.pmod(F.col("block") - 1, F.lit(max(1, len(heads)))).alias("block"), F.lit(True).alias("guest"))
    head = F.element_at(table, F.col("block") + 1) == F.col("key")
    sent = placed.select("doc_id", "text", "key", F.explode(F.when(head, F.array(own, away)).otherwise(F.array(own))).alias("p"))
    sent = _packed(sent.select("p.block", "p.guest", "doc_id", "text", "key"))
    if marks is None:
        sent = sent.withColumn("mark", F.lit(None).cast(kind))
    else:
        marked = marks.select("doc_id", F.struct("doc_id", F.bitwise_not("tie").alias("tie")).alias("key"), "mark")
        marked = marked.withColumn("block", block).select("block", F.lit(False).alias("guest"), "doc_id", F.lit(None).cast("binary").alias("text"), "key", "mark")
        sent = sent.withColumn("mark", F.lit(None).cast(marked.schema["mark"].dataType)).unionByName(marked)
    dealt = sent.repartition(parts, "block").sortWithinPartitions("block", "guest", F.col("key").desc(), F.col("text").isNotNull())
    return dealt.select("block", "guest", "doc_id", "text", "mark")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part: int = 3, classes: DataFrame | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how like they and the next document's are.

    The edited text is the text with its last floor(n_chars / ``part``) code points replaced by as many first ones of the
    next document by descending doc_id (after the last: the first). With ``classes`` of ``document_classes`` each row also
    has its ``class_id``.
    """
    kind = docs.schema[id_col].dataType
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField("doc_id", kind), *(T.StructField(n, k) for n, k in zip(names, kinds, strict=True)), T.StructField("class_id", kind)])

    def run(batches):
        held = None  # the last local row, whose successor has not come yet: block, id (one row), text, signature, mark (one row)
        last_mark = None
        for batch in batches:
            # each text takes the mark of the row without text before it
            text = batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            marks = batch.column(4) if last_mark is None else pa.concat_arrays([last_mark, batch.column(4)])
            place = np.where(text, -1, np.arange(len(text)) + (last_mark is not None))
            place = np.maximum.accumulate(np.concatenate([[0 if last_mark is not None else -1], place]))[1:]
            taken = marks.take(pa.array(np.maximum(place, 0), mask=place < 0)) if len(marks) else marks
            last_mark = taken.slice(len(taken) - 1, 1)
            batch = pa.RecordBatch.from_arrays([*batch.columns[:4], taken], names=["block", "guest", "doc_id", "text", "mark"]).filter(pa.array(text))
            if not batch.num_rows:
                continue
            _, offsets = text_buffers(batch.column(3))
            for lo, hi in slices(offsets, 800_000):
                some = batch.slice(lo, hi - lo)
                block, guest = some.column(0).to_pylist(), some.column(1).to_pylist()
                ids, marked, texts = some.column(2), some.column(4), _unpacked(some.column(3).to_pylist())
                signatures = minhash_batch(pa.array(texts, pa.large_string()))
                if held:
                    block, guest, texts = [held[0], *block], [False, *guest], [held[2], *texts]
                    ids, marked, signatures = pa.concat_arrays([held[1], ids]), pa.concat_arrays([held[4], marked]), np.concatenate([held[3], signatures])
                own = [i for i in range(len(block) - 1) if not guest[i] and block[i] == block[i + 1]]
                last = len(block) - 1
                held = (block[last], ids.slice(last, 1), texts[last], signatures[last:], marked.slice(last, 1)) if not guest[last] else None
                if not own:
                    continue
                edited = [texts[i][: len(texts[i]) - len(texts[i]) // part] + texts[i + 1][: len(texts[i]) // part] for i in own]
                changed = minhash_batch(pa.array(edited, pa.large_string()))
                at = np.array(own)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(at)),
                        pa.array([len(texts[i]) for i in own], pa.int64()),
                        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
                        pa.array(_hexes(signatures[at])),
                        pa.array(_hexes(changed)),
                        pa.array((signatures[at] == changed).mean(1)),
                        pa.array((signatures[at] == signatures[at + 1]).mean(1)),
                        marked.take(pa.array(at)),
                    ],
                    names=schema.names,
                )
        release_memory()

    marks = None if classes is None else classes.select("doc_id", "tie", F.col("class_id").alias("mark")).distinct()
    out = with_successors(docs, id_col, text_col, marks=marks).mapInArrow(run, schema)
    return out if classes is not None else out.drop("class_id")


def _forest(rows: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Links that span the groups of signatures with at least ``least`` equal places."""
    left = np.arange(len(rows))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            v = queue.pop()
            near = (rows[left] == rows[v]).sum(1) >= least
            for w in left[near]:
                yield v, w
                queue.append(w)
            left = left[~near]


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, slack: float = 0.1, id_col: str = "doc_id", text_col: str = "text", sub_tile: int = SUB_TILE) -> DataFrame:
    """(doc_id, class_id) of every row with an id; see ``document_classes``."""
    return document_classes(docs, threshold, slack, id_col, text_col, sub_tile).where(F.col("doc_id").isNotNull()).select("doc_id", "class_id")


def document_classes(docs: DataFrame, threshold: float = THRESHOLD, slack: float = 0.1, id_col: str = "doc_id", text_col: str = "text", sub_tile: int = SUB_TILE) -> DataFrame:
    """(doc_id, tie, class_id): documents joined by links of Jaccard similarity ``threshold`` or more, ``tie`` being the hash of
    the text; class_id is the class's smallest id, null where it has none.

    Documents with equal signatures are one node from the start. Signature bands bring nodes to shared buckets, those of the
    same nodes being one; a bucket is compared part by part, nodes streaming past the part in memory, and gives a spanning
    forest of the pairs whose signatures agree within ``slack`` of the threshold. Each such link is then verified on the sets
    of all shingles, known by 64-bit hashes. As links that fail may have stood for pairs that would not, the buckets are
    compared once more: those of their nodes that are likely partners of nodes in another class come together with their
    texts and are compared exactly, and again only a spanning forest leaves the task.
    """
    least = int(np.ceil((threshold - slack) * PERMUTATIONS))
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    kind = given.schema["doc_id"].dataType
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    signed_schema = T.StructType([T.StructField("doc_id", kind), T.StructField("tie", T.LongType()), T.StructField("signature", T.BinaryType())])

    def sign(batches):
        """The low byte of each place: enough for buckets and likeness, as every link is verified."""
        for batch in batches:
            low = (minhash_batch(batch.column(2)) & np.uint16(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in low], pa.binary())], names=signed_schema.names)
        release_memory()

    signed = given.select("doc_id", "tie", "text").mapInArrow(sign, signed_schema)
    same = [F.xxhash64("signature").alias("h1"), F.xxhash64("signature", F.lit(1)).alias("h2")]
    thin = stage_table(signed.select("doc_id", "tie", *same), "minhash-ids")
    folded = signed.groupBy(*same).agg(F.first("signature").alias("signature"), F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tie")).alias("rep"))
    nodes = stage_table(folded.withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")

    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring("signature", k * BAND_ROWS + 1, F.lit(BAND_ROWS))))
    keys = nodes.select(F.explode(band).alias("key"), "node")
    # keys that a sample shows to be common: their nodes are dealt by hash, so that no task sees all of them
    some = keys.where(F.pmod(F.xxhash64("node", F.lit(2)), F.lit(KEY_SAMPLE)) == 0).groupBy("key").agg((F.count(F.lit(1)) * KEY_SAMPLE).alias("n"))
    heavy = stage_table(some.where(F.col("n") > 2 * sub_tile), "minhash-heavy")
    light, common = keys, None
    if number := heavy.count():
        side = F.broadcast(heavy) if number <= BROADCAST_ENDS else heavy
        light = keys.join(side.select("key"), "key", "left_anti")
        common = _common(keys.join(side, "key"), sub_tile)
    met = light.repartition(parts, "key").sortWithinPartitions("key", "node").mapInArrow(_buckets(sub_tile), "bucket long, sub int, visits boolean, node long").distinct()
    met = met if common is None else met.unionByName(common)
    met = stage_table(met.join(nodes.select("node", "signature"), "node"), "minhash-buckets")

    def candidates(batches):
        """Of each bucket a spanning forest of its likely pairs."""

        def found():
            key, ids, rows, settled = None, [], [], True
            within = lambda: ((ids[v], ids[w]) for v, w in _forest(np.array(rows), least))
            for bucket, sub, visits, node, signature, _ in _rows(batches):
                if (bucket, sub) != key:
                    if not settled:
                        yield from within()
                    key, ids, rows, settled = (bucket, sub), [], [], False
                value = np.frombuffer(signature, np.uint8)
                if not visits:
                    ids.append(node), rows.append(value)
                    continue
                if not settled:
                    yield from within()
                    rows, settled = np.array(rows), True
                if len(ids):
                    yield from ((node, ids[v]) for v in np.flatnonzero((rows == value).sum(1) >= least))
            if not settled:
                yield from within()

        pairs = found()
        while some := list(itertools.islice(pairs, 100_000)):
            src, dst = (pa.array(side, pa.int64()) for side in zip(*some, strict=True))
            yield pa.RecordBatch.from_arrays([src, dst], names=["src", "dst"])

    def unsettled(batches):
        """The nodes of each bucket that are likely partners of one of another class there, each once a bucket."""

        def found():
            key, ids, rows, classes, marked, settled = None, [], [], [], set(), True

            def within():
                for v in range(len(rows) - 1):
                    near = np.flatnonzero(((rows[v + 1 :] == rows[v]).sum(1) >= least) & (classes[v + 1 :] != classes[v])) + v + 1
                    if len(near):
                        marked.update([v, *near.tolist()])

            def own():
                return [(*key, False, ids[v], int(classes[v])) for v in sorted(marked)]

            for bucket, sub, visits, node, signature, group in _rows(batches):
                if (bucket, sub) != key:
                    if key is not None:
                        if not settled:
                            rows, classes = np.array(rows), np.array(classes)
                            within()
                        yield from own()
                    key, ids, rows, classes, marked, settled = (bucket, sub), [], [], [], set(), False
                value = np.frombuffer(signature, np.uint8)
                if not visits:
                    ids.append(node), rows.append(value), classes.append(group)
                    continue
                if not settled:
                    rows, classes, settled = np.array(rows), np.array(classes), True
                    within()
                near = np.flatnonzero(((rows == value).sum(1) >= least) & (classes != group)) if len(ids) else []
                if len(near):
                    marked.update(near.tolist())
                    yield (bucket, sub, True, node, group)
            if key is not None:
                if not settled:
                    rows, classes = np.array(rows), np.array(classes)
                    within()
                yield from own()

        members = found()
        while some := list(itertools.islice(members, 100_000)):
            columns = zip(zip(*some, strict=True), (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names=["bucket", "sub", "visits", "node", "class"])

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, "bucket", "sub").sortWithinPartitions("bucket", "sub", "visits")

    def texts_of(wanted: DataFrame) -> DataFrame:
        """(node, text) of the nodes, compressed."""
        ends = stage_table(wanted.select("node").distinct().join(nodes.select("node", "rep"), "node"), "minhash-ends")
        ends = ends.select("node", F.col("rep.doc_id").alias("_id"), F.col("rep.tie").alias("_tie"))
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))
        few = ends.count() <= BROADCAST_ENDS
        met = _packed(given.join(F.broadcast(ends), same).select("node", "text")) if few else _packed(given).join(ends, same)
        return met.groupBy("node").agg(F.first("text").alias("text"))

    def compared(batches):
        """Of each bucket's nodes, with their texts, links of enough similarity that join their classes."""

        def found():
            key, tile = None, None
            for bucket, sub, visits, node, group, text in _rows(batches):
                if (bucket, sub) != key:
                    if tile:
                        yield from tile.settle()
                    key, tile = (bucket, sub), _Tile(threshold)
                shingles = _shingle_sets(pa.array(_unpacked([text]), pa.large_string()))[0]
                if not visits:
                    tile.add(node, group, shingles)
                else:
                    yield from tile.settle()
                    yield from tile.visit(node, group, shingles)
            if tile:
                yield from tile.settle()

        links = found()
        while some := list(itertools.islice(links, 100_000)):
            src, dst = (pa.array(side, pa.int64()) for side in zip(*some, strict=True))
            yield pa.RecordBatch.from_arrays([src, dst], names=["src", "dst"])
        release_memory()

    def verified(links: DataFrame) -> DataFrame:
        texts = texts_of(links.select(F.explode(F.array("src", "dst")).alias("node")))
        of = lambda end, name: texts.select(F.col("node").alias(end), F.col("text").alias(name))
        both = links.join(of("src", "a"), "src").join(of("dst", "b"), "dst").select("src", "dst", "a", "b")

        def run(batches):
            for batch in batches:
                for lo in range(0, batch.num_rows, 64):
                    some = batch.slice(lo, 64)
                    sets = [_shingle_sets(pa.array(_unpacked(some.column(k).to_pylist()), pa.large_string())) for k in (2, 3)]
                    near = []
                    for x, y in zip(*sets, strict=True):
                        shared = len(np.intersect1d(x, y, assume_unique=True))
                        whole = len(x) + len(y) - shared
                        near.append(whole == 0 or shared / whole >= threshold)
                    yield pa.RecordBatch.from_arrays([some.column(k).filter(pa.array(near)) for k in (0, 1)], names=["src", "dst"])

        return both.mapInArrow(run, "src long, dst long")

    plain = lambda links: links.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    empty = met.select("bucket", "sub", "visits", "node", "signature", F.col("node").alias("class"))
    links = stage_table(plain(dealt(empty).mapInArrow(candidates, "src long, dst long")), "minhash-links")
    sure = stage_table(verified(links), "sure-links")
    roots = connected_components(sure)
    classed = met.join(roots, "node", "left").select("bucket", "sub", "visits", "node", "signature", F.coalesce("component", "node").alias("class"))
    rest = stage_table(dealt(classed).mapInArrow(unsettled, "bucket long, sub int, visits boolean, node long, class long"), "minhash-unsettled")
    if not rest.isEmpty():
        told = rest.join(texts_of(rest), "node").select("bucket", "sub", "visits", "node", "class", "text")
        roots = connected_components(sure.unionByName(plain(dealt(told).mapInArrow(compared, "src long, dst long"))))
    for table in (links, rest, met):
        drop_table(table)
    member = nodes.join(roots, "node", "left").select("h1", "h2", "rep", F.coalesce("component", "node").alias("root"))
    named = member.groupBy("root").agg(F.min("rep").alias("first")).select("root", F.col("first.doc_id").alias("class_id"))
    label = stage_table(member.join(named, "root").select("h1", "h2", "class_id"), "minhash-labels")
    return thin.join(label, ["h1", "h2"]).select("doc_id", "tie", "class_id")


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


class _Tile:
    """Nodes of one part of a bucket with their shingles; gives links that join classes, as many as join what they join."""

    def __init__(self, threshold: float):
        self.threshold, self.nodes, self.sets, self.up, self.index = threshold, [], [], {}, None

    def _root(self, group: int) -> int:
        while (above := self.up.get(group, group)) != group:
            self.up[group] = self.up.get(above, above)
            group = above
        return group

    def add(self, node: int, group: int, shingles: np.ndarray) -> None:
        self.nodes.append((node, group)), self.sets.append(shingles)

    def settle(self) -> Iterator[tuple[int, int]]:
        """Compare the nodes with each other once all have come; their shingles are then in one sorted list."""
        if self.index is None:
            self.size = np.array([len(x) for x in self.sets], np.int64)
            flat = np.concatenate([np.empty(0, np.uint64), *self.sets])
            owner = np.repeat(np.arange(len(self.sets)), self.size)
            order = np.argsort(flat, kind="stable")
            self.index, self.owner = flat[order], owner[order]
            for v, (node, group) in enumerate(self.nodes):
                yield from self.visit(node, group, self.sets[v], v)
            self.sets = []

    def visit(self, node: int, group: int, shingles: np.ndarray, upto: int | None = None) -> Iterator[tuple[int, int]]:
        """Links of a node with the tile's nodes, or with those before ``upto``."""
        low, high = np.searchsorted(self.index, shingles, "left"), np.searchsorted(self.index, shingles, "right")
        n = high - low
        places = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        shared = np.bincount(self.owner[places], minlength=len(self.nodes))[:upto]
        whole = self.size[:upto] + len(shingles) - shared
        for v in np.flatnonzero((whole == 0) | (shared >= self.threshold * whole - 1e-6)).tolist():
            a, b = self._root(group), self._root(self.nodes[v][1])
            if a != b and (whole[v] == 0 or shared[v] / whole[v] >= self.threshold):
                self.up[a] = b
                yield node, self.nodes[v][0]


def _shingle_sets(column: pa.Array) -> list[np.ndarray]:
    data, offsets = text_buffers(column)
    hashes, n = shingle_hashes(data, offsets, wide=True)
    cuts = np.cumsum(n) - n
    return [np.unique(hashes[c : c + m]) for c, m in zip(cuts, n, strict=True)]


def _common(keys: DataFrame, sub_tile: int) -> DataFrame:
    """(bucket, sub, visits, node) of ``keys(key, node, n)`` of large buckets of about n nodes.

    A node belongs to a part by its hash and visits the later ones. Visitors of a part are dealt to several tasks, each of
    which has the part's own nodes: ``sub`` numbers parts and tasks.
    """
    keys = keys.withColumns({"_parts": F.ceil(F.col("n") / sub_tile).cast("int"), "_tasks": F.ceil(F.col("n") / (8 * sub_tile)).cast("int")})
    home, task = (F.pmod(F.xxhash64("node", F.lit(seed)), F.col(c).cast("long")).cast("int") for seed, c in ((3, "_parts"), (4, "_tasks")))
    met = keys.withColumns({"_home": home, "_task": task}).withColumn("_part", F.explode(F.sequence("_home", F.col("_parts") - 1)))
    own = F.col("_part") == F.col("_home")
    met = met.withColumn("_at", F.explode(F.when(own, F.sequence(F.lit(0), F.col("_tasks") - 1)).otherwise(F.array("_task"))))
    return met.select(F.col("key").alias("bucket"), (F.col("_part") * F.col("_tasks") + F.col("_at")).alias("sub"), (~own).alias("visits"), "node")


def _buckets(sub_tile: int):
    """Rows (bucket, sub, visits, node) of the keys, sorted by key, that several nodes share.

    A bucket of up to ``sub_tile`` nodes is known by a hash of them, so that bands which bring the same nodes together give
    the same rows. Of a larger one each node belongs to the part that its place falls in and visits the parts before.
    """

    def run(batches):
        key, nodes, n, out = None, [], 0, []

        def small():
            if 1 < n <= sub_tile:
                bucket = xxhash.xxh64_intdigest(np.array(nodes, "<i8").tobytes()) - (1 << 63)
                out.extend((bucket, 0, False, x) for x in nodes)

        def rows():
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.bool_(), pa.int64()), strict=True)], names=["bucket", "sub", "visits", "node"])

        for batch in batches:
            for now, node in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if now != key:
                    small()
                    key, nodes, n = now, [], 0
                n += 1
                if n <= sub_tile:
                    nodes.append(node)
                    continue
                if n == sub_tile + 1:
                    out.extend((key, 0, False, x) for x in nodes)
                    nodes = []
                home = (n - 1) // sub_tile
                out.extend((key, sub, sub < home, node) for sub in range(home + 1))
                if len(out) > 100_000:
                    yield rows()
            yield rows()
        small()
        yield rows()

    return run
