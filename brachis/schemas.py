"""Schemas of the tables that operators exchange. Sources never infer types."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind()) if isinstance(kind, type) else StructField(name, kind) for name, kind in fields])


SEQUENCES = _struct(("seq_id", StringType), ("ord", LongType), ("sequence", StringType))
PROTEINS = _struct(("genome", StringType), ("protein", StringType), ("ord", LongType), ("sequence", StringType))
RAW_HITS = _struct(("target", StringType), ("tlen", IntegerType), ("query", StringType), ("qlen", IntegerType), ("evalue", DoubleType), ("bitscore", DoubleType), ("ali_from", IntegerType), ("ali_to", IntegerType))
HITS = _struct(("genome", StringType), ("protein", StringType), ("hmm", StringType), ("bitscore", DoubleType), ("evalue", DoubleType), ("coverage", DoubleType))
THRESHOLDS = _struct(("hmm", StringType), ("min_score", DoubleType))
TAXONOMY = _struct(("genome_key", StringType), ("taxonomy", StringType))
CLADES = _struct(("clade", StringType), ("tip", StringType), ("ord", LongType))
ALIGNMENT = _struct(("hmm", StringType), ("tip", StringType), ("ord", LongType), ("aligned", StringType))
STATES = _struct(("hmm", StringType), ("node", StringType), ("site", IntegerType), ("state", StringType), ("ord", LongType))
FEATURES = _struct(("file", StringType), ("ord", LongType), ("contig", StringType), ("start", IntegerType), ("end", IntegerType), ("strand", IntegerType), ("attributes", MapType(StringType(), ArrayType(StringType()))))
TREE_NODES = _struct(("hmm", StringType), ("node_id", IntegerType), ("parent_id", IntegerType), ("name", StringType), ("is_tip", BooleanType), ("leaf_ord", IntegerType))
