"""Token counts of sections, attributed by offsets.

A whole document is encoded once by a byte-level BPE; its tokens spell the text's bytes exactly, so the running sum of
their byte lengths gives every token's span. The spans are joined with the sections' intervals by binary search, and a token
that crosses a boundary goes to one section by an explicit rule: ``start`` (the section of its first byte), ``end`` (of its
last byte) or ``most`` (the one with most of its bytes, ties to the earlier).

Sections are the lines of a text (the line break belongs to the line that it ends) or given fields put together into one
text. Defined results: a null or empty text is one empty section without tokens; empty sections have no tokens; repeated
rows are counted as rows of their own; a null doc_id stays null. Section starts and ends are in code points.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_buffers

RULES = ("start", "end", "most")
RULE = "start"


def ranks_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def _encoding(path: str):
    """The encoding and the byte length of each token; one a worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def token_lengths(text: str, path: str) -> np.ndarray:
    encoding, lengths = _encoding(path)
    return lengths[np.array(encoding.encode_ordinary(text), np.int64)]


def attribute(lengths: np.ndarray, edges: np.ndarray, rule: str = RULE) -> tuple[np.ndarray, np.ndarray]:
    """Tokens given to each section, and how many of those cross a boundary.

    lengths: bytes of each token, in order. edges: first byte of each section, and the end of the last.
    """
    n = len(edges) - 1
    end = np.cumsum(lengths)
    start = end - lengths
    # empty sections share their edge with the next one; searching from the right skips them
    first = np.clip(np.searchsorted(edges, start, side="right") - 1, 0, n - 1)
    last = np.clip(np.searchsorted(edges, end - 1, side="right") - 1, 0, n - 1)
    owner = first if rule == "start" else last if rule == "end" else first.copy()
    if rule == "most":
        for t in np.flatnonzero(first != last):
            cuts = np.clip(edges[first[t] : last[t] + 2], start[t], end[t])
            owner[t] = first[t] + int(np.argmax(np.diff(cuts)))
    return np.bincount(owner, minlength=n), np.bincount(owner[first != last], minlength=n)


def line_edges(data: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.flatnonzero(data[:-1] == 0x0A) + 1, [len(data)]))


def section_tokens(docs: DataFrame, rule: str = RULE, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing) of every line of every document."""
    return _attributed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), rule, tokenizer, None)


def field_tokens(docs: DataFrame, fields: list[str], separator: str = "\n", rule: str = RULE, tokenizer: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """The same of the given string columns (null: empty), put together with ``separator``, which ends the field before it."""
    texts = [F.concat(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(separator if k < len(fields) - 1 else "")) for k, c in enumerate(fields)]
    given = docs.select(F.col(id_col).alias("doc_id"), F.concat(*texts).alias("text"), F.array(*(F.octet_length(t).cast("long") for t in texts)).alias("sizes"))
    return _attributed(given, rule, tokenizer, len(fields))


def _attributed(given: DataFrame, rule: str, tokenizer: str | None, fields: int | None) -> DataFrame:
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    path = tokenizer or ranks_path()
    longs = ("start", "end", "n_tokens", "n_crossing")
    schema = T.StructType([T.StructField("doc_id", given.schema["doc_id"].dataType), T.StructField("section", T.IntegerType()), *(T.StructField(x, T.LongType()) for x in longs)])

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for lo, hi in slices(offsets, 2_000_000):
                texts = batch.column(1).slice(lo, hi - lo).to_pylist()
                row, columns = [], []
                for k, text in enumerate(texts, lo):
                    raw = data[offsets[k] : offsets[k + 1]]
                    edges = line_edges(raw) if fields is None else np.concatenate(([0], np.cumsum(batch.column(2)[k].as_py())))
                    n, crossing = attribute(token_lengths(text or "", path), edges, rule)
                    chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[edges]
                    row.append(np.full(len(n), k))
                    columns.append((np.arange(len(n)), chars[:-1], chars[1:], n, crossing))
                section, *rest = (np.concatenate(x) for x in zip(*columns, strict=True))
                ids = batch.column(0).take(pa.array(np.concatenate(row)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(section.astype(np.int32)), *(pa.array(x.astype(np.int64)) for x in rest)], names=schema.names)

    return given.mapInArrow(run, schema)
