"""Language identification by prediction by partial matching.

Each language gets a variable-order byte context tree: counts of the byte after every context of up to ``order`` bytes,
with A-Z folded to a-z. A byte not seen after a context costs that context's escape probability d/(n+d) (n: occurrences,
d: distinct followers) and is then coded by the context one byte shorter; the last resort is 1/256. The statistics are
frozen after learning, so the code length of a byte depends only on its context. For every context length the grams that
any language has seen are kept sparsely, in a hash table, with their code lengths under all languages; a byte walks down
from the longest context, adding escapes, until a table has it. A text's score is the exact sum over all its bytes.

Learning uses a bounded sample: ``sample_docs`` documents a language (those with the smallest hash of their doc_id), fewer
from 16 languages on, of the ``MAX_LANGS`` languages with most labelled documents (ties by code point), from rows with a
lang and a crc32(doc_id as text) whose remainder by 4 is not 2. Prediction uses the text alone.

Defined results: a null text, or one without a letter, is ``und`` with score 0; ties go to the language first in code
point order; with nothing to learn from every text is ``und``. A row with a null doc_id is predicted, never learned from
and not held out. Repeated rows are predicted alike. Whole texts are scored, however long.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold_ascii, own_cache, release_memory, slices, stage_table, text_buffers

ORDER = 4
#: Bounds of the learning sample: documents a language, documents in all, languages. They bound the model and its broadcast.
SAMPLE_DOCS = 600
SAMPLE_ALL = 9_600
MAX_LANGS = 64
UNDETERMINED = "und"
#: What counts as no language in the pipeline: more bits a byte than texts of any learned language need (prose takes 2 to 3,
#: short texts with keys or numbers up to 6.8; random letters, other scripts and binary data 13 and more), or a toss-up of three.
MAX_BITS = 7.5
MIN_SCORE = 1 / 3
#: Bytes that a text may cost above that, as its first ones have little context.
FIRST_BYTES = 3


def held_out(doc_id):
    """True where crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _padded(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Every row's bytes, folded, after ``order`` newlines that serve as the first bytes' context; and the rows' starts."""
    n = len(offsets) - 1
    starts = offsets + order * np.arange(n + 1)
    out = np.full(int(starts[-1]), 0x0A, np.uint8)
    mask = np.ones(len(out), bool)
    for k in range(order):
        mask[starts[:-1] + k] = False
    out[mask] = fold_ascii(data)
    return out, starts


def sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, text) of the learning sample: at most ``sample_docs`` rows a language."""
    h = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 52) - 1))
    ok = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    ok = ok.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    thin = ok.select("doc_id", "lang", h.alias("h"))
    sizes = thin.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = stage_table(sizes.orderBy(F.col("n").desc(), "lang").limit(MAX_LANGS), "languages")
    side = F.broadcast(sizes)  # at most MAX_LANGS rows
    sample_docs = min(sample_docs, max(1, SAMPLE_ALL // max(1, sizes.count())))
    # only hashes that can be among the smallest (with a margin of eight) are ranked, so no language fills a task
    near = thin.join(side, "lang").where(F.col("h") / F.lit(float(1 << 52)) * F.col("n") < 8 * sample_docs)
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= sample_docs)
    # at most sample_docs ids a language: a proven bound for the broadcast
    rows = ok.join(F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"], "left_semi")
    # rows that repeat an id count one by one; each task sends on no more than sample_docs rows a language
    each = Window.partitionBy("lang").orderBy(h, "doc_id", F.xxhash64("text"))
    return rows.withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= sample_docs).select("lang", "text")


def learn(docs: DataFrame, order: int = ORDER, sample_docs: int = SAMPLE_DOCS, **columns: str) -> dict:
    """The frozen statistics: per language the counts of every (context, byte) gram of the sample."""

    def count(batches):
        for batch in batches:
            langs = batch.column(0).to_pylist()
            data, offsets = text_buffers(batch.column(1))
            out_lang, out_gram, out_n = [], [], []
            for lo, hi in slices(offsets):
                part, starts = _padded(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], order)
                wide = part.astype(np.int64)
                for lang in sorted(set(langs[lo:hi])):
                    picked = []
                    for r in range(lo, hi):
                        if langs[r] == lang:
                            own = wide[starts[r - lo] : starts[r - lo + 1]]
                            gram = np.zeros(len(own) - order, np.int64)
                            for k in range(order + 1):
                                gram = gram * 256 + own[k : len(own) - order + k]
                            picked.append(gram)
                    grams, n = np.unique(np.concatenate(picked), return_counts=True)
                    out_lang += [lang] * len(grams)
                    out_gram.append(grams)
                    out_n.append(n)
            if out_gram:
                yield pa.RecordBatch.from_arrays([pa.array(out_lang, pa.string()), pa.array(np.concatenate(out_gram)), pa.array(np.concatenate(out_n).astype(np.int64))], names=["lang", "gram", "n"])

    counted = sample(docs, sample_docs, **columns).mapInArrow(count, "lang string, gram long, n long")
    # bounded by the sample: its languages times the distinct grams of at most sample_docs texts each
    rows = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow().combine_chunks()
    coded = rows["lang"].combine_chunks().dictionary_encode()
    gram, number = rows["gram"].to_numpy(), rows["n"].to_numpy()
    langs = sorted(coded.dictionary.to_pylist(), key=lambda x: x.encode())
    place = {lang: k for k, lang in enumerate(coded.dictionary.to_pylist())}
    own = [np.flatnonzero(coded.indices.to_numpy() == place[lang]) for lang in langs]
    return {"id": uuid.uuid4().hex, "order": order, "langs": langs, "levels": levels([(gram[x], number[x]) for x in own], order)}


def _tail(grams: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` bytes of each gram."""
    return grams & ((1 << 8 * n) - 1)


def levels(counted: list[tuple[np.ndarray, np.ndarray]], order: int) -> list[dict[str, np.ndarray]]:
    """For every context length the grams that any language has seen with their bits under each language, and the contexts
    with the bits of their escape. ``counted`` holds each language's grams of the longest context and their numbers."""
    out: list[dict[str, np.ndarray]] = []
    for k in range(order + 1):
        own = [np.unique(_tail(g, k + 1), return_inverse=True) for g, _ in counted]
        grams = np.unique(np.concatenate([np.empty(0, np.int64), *(x for x, _ in own)]))
        count = np.zeros((len(grams), len(counted)))
        for j, ((x, at), (_, n)) in enumerate(zip(own, counted, strict=True)):
            count[np.searchsorted(grams, x), j] = np.bincount(at, n, len(x))
        contexts, first, group = np.unique(grams >> 8, return_index=True, return_inverse=True)
        if len(grams):
            total, distinct = np.add.reduceat(count, first), np.add.reduceat((count > 0).astype(np.float64), first)
        else:
            total = distinct = np.zeros((0, len(counted)))
        whole = np.maximum(total + distinct, 1)
        escape = -np.log2(np.where(total > 0, distinct / whole, 1.0))
        below = out[-1]["bits"][np.searchsorted(out[-1]["grams"], _tail(grams, k))] if k else 8.0
        with np.errstate(divide="ignore"):
            bits = np.where(count > 0, -np.log2(count / whole[group]), escape[group] + below)
        out.append({"grams": grams, "bits": bits.astype(np.float32), "contexts": contexts, "escape": escape.astype(np.float32)})
    return out


class _Places:
    """The place of each of some distinct numbers, by open addressing in an array."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys, self.at = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] < 0
            _, won = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[won]
            self.keys[slot[won]], self.at[slot[won]] = keys[left[won]], left[won]
            stay = np.ones(len(left), bool)
            stay[won] = False
            left, slot = left[stay], self._next(slot[stay])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, slot: np.ndarray) -> np.ndarray:
        return (slot + 1) & ((1 << self.bits) - 1)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The places of the keys; -1 for others."""
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.at[slot], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        slot = slot[left]
        while len(left):
            slot = self._next(slot)
            there = self.keys[slot]
            same = there == keys[left]
            out[left[same]] = self.at[slot[same]]
            more = ~same & (there >= 0)
            left, slot = left[more], slot[more]
        return out


def _tables(model: dict) -> list[tuple[_Places, _Places]]:
    """Hash tables of the model's grams and contexts, kept for the worker's next task."""
    kept = own_cache("langid")
    if model["id"] not in kept:
        kept.clear()
        kept[model["id"]] = [(_Places(x["grams"]), _Places(x["contexts"])) for x in model["levels"]]
    return kept[model["id"]]


def code_lengths(grams: np.ndarray, model: dict) -> np.ndarray:
    """Bits of the last byte of each gram under each language (grams x languages)."""
    out = np.zeros((len(grams), len(model["langs"])), np.float32)
    left, tables = np.arange(len(grams)), _tables(model)
    for k in range(model["order"], -1, -1):
        level, (places, contexts) = model["levels"][k], tables[k]
        at = places(_tail(grams[left], k + 1))
        met = at >= 0
        out[left[met]] += level["bits"][at[met]]
        left = left[~met]
        if not len(left):
            break
        at = contexts(_tail(grams[left] >> 8, k))
        met = at >= 0
        out[left[met]] += level["escape"][at[met]]
    else:
        out[left] += 8
    return out


def score_batch(column: pa.Array, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code length in bits of each text under each language (rows x languages), its bytes, and whether it has a letter."""
    order, number = model["order"], len(model["langs"])
    data, offsets = text_buffers(column)
    n = len(offsets) - 1
    bits, letter = np.zeros((n, number)), np.zeros(n, bool)
    chunk = max(1_000, 1_000_000 // max(1, number))
    for lo, hi in slices(offsets, 500_000):
        part, starts = _padded(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], order)
        wide = part.astype(np.int64)
        grams = wide[: len(wide) - order].copy()
        for k in range(1, order + 1):
            grams <<= 8
            grams |= wide[k : len(wide) - order + k]
        # the gram at i belongs to the byte at i + order; those that straddle two rows are no row's
        row = np.repeat(np.arange(hi - lo), np.diff(starts) - order)
        at = np.arange(len(row)) + order * row
        for begin in range(0, len(row), chunk):
            own = row[begin : begin + chunk]
            edges = np.flatnonzero(np.diff(own, prepend=-1))
            bits[lo + own[edges]] += np.add.reduceat(code_lengths(grams[at[begin : begin + chunk]], model), edges, axis=0, dtype=np.float64)
        some = np.flatnonzero(np.diff(starts) > order)
        if len(some):
            low = (part >= 97) & (part <= 122)
            letter[lo + some] = np.logical_or.reduceat(low, starts[:-1][some])
    length = np.diff(offsets)
    for r in np.flatnonzero(~letter & (length > 0)):
        letter[r] = any(c.isalpha() for c in column[int(r)].as_py())
    return bits, length, letter


def predict(docs: DataFrame, model: dict, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score", bits_col: str = "bits_per_byte") -> DataFrame:
    """``docs`` with the predicted language, the posterior of it under equal priors, and its code length in bits a byte.

    The three new names must not clash with columns of ``docs``.
    """
    if clash := {pred_col, score_col, bits_col} & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} exist already; name others")
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # bounded by the sample
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(pred_col, T.StringType()), T.StructField(score_col, T.DoubleType()), T.StructField(bits_col, T.DoubleType())])

    def run(batches):
        model = sent.value
        langs = np.array([*model["langs"], UNDETERMINED], object)
        for batch in batches:
            n = batch.num_rows
            if len(langs) == 1:
                best, score, rate = np.zeros(n, int), np.zeros(n), np.zeros(n)
            else:
                bits, length, letter = score_batch(batch.column(at), model)
                best = bits.argmin(1)
                low = bits[np.arange(n), best] if n else np.zeros(0)
                score = 1 / np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(1)
                rate = low / np.maximum(length, 1)
                best, score = np.where(letter, best, len(langs) - 1), np.where(letter, score, 0.0)
            more = [pa.array(langs[best], pa.string()), pa.array(score), pa.array(rate)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)
        release_memory()

    return docs.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, max_bits: float = MAX_BITS, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, columns unchanged, whose text is in a learned language.

    Rows go when they are ``und``, when no language is likelier than ``min_score``, or when even the best one needs over
    ``max_bits`` bits a byte, ``FIRST_BYTES`` bytes more being granted to each text.
    """
    model = learn(docs)
    names = [f"_brachis_{k}" for k in ("pred", "score", "bits")]
    found = predict(docs, model, pred_col=names[0], score_col=names[1], bits_col=names[2])
    if not model["langs"]:
        return docs.limit(0)
    return found.where((F.col(names[0]) != UNDETERMINED) & (F.col(names[1]) >= min_score) & (F.col(names[2]) * F.octet_length("text") <= max_bits * (F.octet_length("text") + FIRST_BYTES))).select(*docs.columns)
