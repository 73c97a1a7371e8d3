"""Genome features from GFF and GenBank files."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import schemas
from ..functions.identifiers import strand_of
from .tables import in_file_order


def gff_attributes(text: Column) -> Column:
    """Key and value pairs of the ninth field; the last of a repeated key counts, nothing is decoded."""
    parts = F.filter(F.split(text, ";"), lambda p: p.contains("="))
    pairs = F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("key"), F.trim(F.substr(p, F.locate("=", p) + 1)).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["key"].alias("key"), F.array(p["value"]).alias("value"))))


def parse_gff(lines: DataFrame, value: str = "value") -> DataFrame:
    """Adds contig, type, start, end, strand and attributes to lines; comments and lines of fewer than 9 fields go."""
    f = F.split(value, "\t")
    rows = lines.where(~F.col(value).startswith("#") & (F.size(f) >= 9))
    names = {"contig": f[0], "type": f[2], "start": f[3].try_cast("int"), "end": f[4].try_cast("int"), "strand": strand_of(f[6]), "attributes": gff_attributes(F.trim(f[8]))}
    return rows.select(*(c for c in lines.columns if c != value), *(v.alias(k) for k, v in names.items()))


def read_gff(spark: SparkSession, path) -> DataFrame:
    """The CDS features of GFF files, numbered within each file in its order."""
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("at")
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), at, "value")
    rows = parse_gff(lines).where(F.col("type") == "CDS")
    return in_file_order(rows, "file").select("file", "ord", "contig", "start", "end", "strand", "attributes")


_QUALIFIER = re.compile(r"^/([^=\s]+)(?:=(.*))?$", re.S)
_NAME = re.compile(rb"(VERSION|ACCESSION|LOCUS)\s+(\S+)")
_BEGINS = re.compile(rb" {0,5}(?=\S)")
_NUMBER = re.compile(r"\d+")
_OTHER_RECORD = re.compile(r"[\w.]+:")
_PLAIN = re.compile(rb" {5}CDS +(complement\()?(\d+)\.\.(\d+)\)?\s*")


def _coding(lines: list[bytes]) -> list[str]:
    """The stripped lines of a CDS feature without its key."""
    return [x.strip() for x in b"\n".join(lines).decode("utf-8", "replace").partition("CDS")[2].split("\n")]


def _place(found: list[bytes]) -> tuple[int, int, int] | None:
    """(start from 0, end, strand) of a feature's lines; None if its location has no number."""
    if (m := _PLAIN.fullmatch(found[0])) and (len(found) == 1 or found[1].lstrip().startswith(b"/")):
        low, high = sorted((int(m[2]), int(m[3])))
        return low - 1, high, -1 if m[1] else 1
    location = "".join(itertools.takewhile(lambda x: not x.startswith("/"), _coding(found)))
    bounds = [int(x) for x in _NUMBER.findall(_OTHER_RECORD.sub("", location))]
    return (min(bounds) - 1, max(bounds), -1 if "complement" in location else 1) if bounds else None


def _qualifiers(found: list[bytes]) -> dict[str, list[str]]:
    parts: list[str] = []
    for line in _coding(found):
        if line.startswith("/") and not (parts and parts[-1].count('"') % 2):
            parts.append(line)
        elif line and parts:
            parts[-1] += ("" if parts[-1].startswith("/translation") else " ") + line
    out: dict[str, list[str]] = {}
    for part in parts:
        if m := _QUALIFIER.match(part):
            out.setdefault(m[1], []).append((m[2] or "").strip().strip('"').replace('""', '"'))
    return out


class _Block:
    """Reads the lines of one block of a file in order, and keeps what only the blocks around it can settle.

    A line with at most five spaces before its text begins something: with none a part of the record, with five a
    feature, else nothing of a table (as the lines of a sequence). All others carry on what has begun. So one feature is
    held at a time, however long a record is. A record's name stands before its table.
    """

    def __init__(self):
        self.head: list[bytes] = []  # carries on what the blocks before have begun
        self.open: list[bytes] | None = None  # the CDS feature that is being read
        self.begun = False
        self.table: bool | None = None  # whether in a feature table; unknown before a part of the record begins
        self.fresh = False  # whether the record begins in this block, so that its names are known
        self.version: str | None = None
        self.name: str | None = None

    def read(self, lines: Iterable[bytes]) -> Iterator[list[bytes]]:
        """The CDS features that end within the lines, but those known to be outside of a table; each while the state is still its own."""
        for line in lines:
            if line.startswith(b"      ") or not (m := _BEGINS.match(line)):
                if self.open is not None:
                    self.open.append(line)
                elif not self.begun:
                    self.head.append(line)
                continue
            if self.open is not None:
                yield self.open
            self.begun, self.open = True, None
            if m.end() == 5 and self.table is not False and line[5:].split(b" ", 1)[0].strip() == b"CDS":
                self.open = [line]
            elif m.end() == 0:
                self.table = line.startswith(b"FEATURES")
                if line.rstrip() == b"//":
                    self.fresh, self.version, self.name = True, None, None
                elif n := _NAME.match(line):
                    kind = "version" if n[1] == b"VERSION" else "name"
                    setattr(self, kind, getattr(self, kind) or n[2].decode("utf-8", "replace"))


def parse_genbank(text: str) -> list[tuple]:
    """(record id, start from 0, end, strand, qualifiers) of every CDS of a GenBank text, in order."""
    block, out = _Block(), []
    for found in block.read([*text.encode().splitlines(), b"//"]):
        if block.table and (place := _place(found)):
            out.append((block.version or block.name, *place, _qualifiers(found)))
    return out


def _schema(columns: str) -> T.StructType:
    kinds = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "lines": T.ArrayType(T.BinaryType()), "attributes": schemas.FEATURES["attributes"].dataType}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in map(str.split, columns.split(","))])


#: What ``_blocks`` gives: a row a feature that ends in its block, numbered apart before and after a part of a record begins, and one without a feature a block; or a row a block.
_FOUND = _schema("path string, block long, n long, known boolean, fresh boolean, version string, name string, start int, end int, strand int, attributes attributes")
_ENDS = _schema("path string, block long, head lines, begun boolean, open lines, unknown long, known long, table boolean, fresh boolean, version string, name string")
#: What ``_carried`` gives: what a block begins with, how many features stand before it and its known ones, and the feature that begins in it and is open at its end.
_CARRIED = _schema("path string, block long, table boolean, of_version string, of_name string, before long, shift long, last_contig string, last_ord long, last_start int, last_end int, last_strand int, last_attributes attributes")


def _arrow(rows: list[tuple], schema: pa.Schema) -> list[pa.Array]:
    return [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)]


def _blocks(summary: bool):
    """Batches of (path, block, value), the lines of a block following one another, to ``_ENDS`` (``summary``) or ``_FOUND``."""
    schema = to_arrow_schema(_ENDS if summary else _FOUND)

    def run(batches):
        rows: list[tuple] = []
        at, block, counts = None, _Block(), [0, 0]

        def end():
            if at:
                rows.append((*at, block.head, block.begun, block.open, *counts, block.table, block.fresh, block.version, block.name) if summary else (*at, *[None] * (len(schema) - 2)))

        for batch in batches:
            if not batch.num_rows:
                continue
            path, start, value = batch["path"], batch["block"], batch["value"]
            new = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(start[1:], start[:-1]))
            for a, b in itertools.pairwise([0, *(pc.indices_nonzero(new).to_numpy() + 1).tolist(), len(path)]):
                if (here := (path[a].as_py(), start[a].as_py())) != at:
                    end()
                    at, block, counts = here, _Block(), [0, 0]
                for found in block.read(value[a:b].to_pylist()):
                    if place := _place(found):
                        known = block.table is not None
                        if not summary:
                            rows.append((*at, counts[known], known, block.fresh, block.version, block.name, *place, list(_qualifiers(found).items())))
                        counts[known] += 1
            if len(rows) >= 5000:
                yield pa.RecordBatch.from_arrays(_arrow(rows, schema), schema=schema)
                rows = []
        end()
        yield pa.RecordBatch.from_arrays(_arrow(rows, schema), schema=schema)

    return run


def _carried(table: pa.Table) -> pa.Table:
    """The ``_ENDS`` of the blocks of one file, or of the parts of one, to ``_CARRIED``."""
    blocks = sorted(table.select(_ENDS.names).to_pylist(), key=lambda b: (b["path"], b["block"]))
    rows, before = [], 0
    for _, part in itertools.groupby(blocks, key=lambda b: b["path"]):
        part = list(part)
        inside, version, name = False, None, None
        for k, b in enumerate(part):
            shift = b["unknown"] if inside else 0
            row = [b["path"], b["block"], inside, version, name, before, shift]
            before += shift + b["known"]
            version, name = (b["version"], b["name"]) if b["fresh"] else (version or b["version"], name or b["name"])
            inside = inside if b["table"] is None else b["table"]
            last = [None] * 6
            if b["open"] is not None and inside:
                found = list(b["open"])
                for after in part[k + 1 :]:
                    found += after["head"]
                    if after["begun"]:
                        break
                if place := _place(found):
                    last = [version or name, before, *place, list(_qualifiers(found).items())]
                    before += 1
            rows.append((*row, *last))
    schema = to_arrow_schema(_CARRIED)
    return pa.Table.from_arrays(_arrow(rows, schema), schema=schema)


def read_genbank(spark: SparkSession, path, whole: Column | None = None) -> DataFrame:
    """The CDS features of GenBank files, numbered within each file in its order; a file that cannot be read gives none.

    Files are read by blocks, and features stay where they are read; only a row a block is put together, for what a block
    begins with and for the feature that crosses its end. ``whole``, of the column ``path``, names the file that a path is
    a part of, if files lie in parts that hold whole records; the parts follow one another by path.
    """
    meta = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    lines = spark.read.text(path).select(*meta, F.col("value").cast("binary").alias("value"))
    name = F.url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B")))  # Spark gives paths as URIs
    ends = lines.mapInArrow(_blocks(True), _ENDS).withColumn("_of", F.col("path") if whole is None else whole)
    carried = ends.groupBy("_of").applyInArrow(_carried, _CARRIED)
    # a block without a row begins outside of records, as those of files of one block do
    carried = carried.where("table OR before > 0 OR of_version IS NOT NULL OR of_name IS NOT NULL OR last_ord IS NOT NULL")
    met = lines.mapInArrow(_blocks(False), _FOUND).join(F.broadcast(carried), ["path", "block"], "left")
    mark = F.col("start").isNull()
    contig = F.when(F.col("fresh"), F.coalesce("version", "name")).otherwise(F.coalesce("of_version", "version", "of_name", "name"))
    place = F.coalesce("before", F.lit(0)) + F.col("n") + F.when(F.col("known"), F.coalesce("shift", F.lit(0))).otherwise(0)
    met = met.where(F.when(mark, F.col("last_ord").isNotNull()).otherwise(F.col("known") | F.coalesce("table", F.lit(False))))
    own = {"ord": place, "contig": contig} | {c: F.col(c) for c in ("start", "end", "strand", "attributes")}
    return met.select((name if whole is None else whole).alias("file"), *(F.when(mark, F.col(f"last_{c}")).otherwise(v).alias(c) for c, v in own.items()))
