"""Whole-text token ids of a public word tokenizer, computed once per distinct word part of a batch.

The tokenizer drops white space and never joins symbols across it, so a text's ids are those of its chunks between ASCII
white space, one after another. Arrow splits a batch into chunks, finds the distinct ones and cuts letters from the ASCII
punctuation after them, where the tokenizer always cuts; anything else is encoded as it stands. A bounded table keeps the
ids of parts seen before, so only new parts become Python strings.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import own_cache

#: Distinct parts whose ids a worker keeps.
PARTS = 500_000
_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters that stay letters, one for one, when the tokenizer composes and lower-cases them.
_WORD = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]+$"
#: What stands for itself in the byte alphabet and is one word to the tokenizer.
_DIRECT = r"^(?:[a-z]+|[!-/:-@\[-`{-~]+)$"
_BEFORE_PUNCT = r"^[^!-/:-@\[-`{-~]+"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes Arrow string arrays to one flat id array and row offsets."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        """Start with the empty part alone."""
        self.known = pa.array([""], pa.string())
        self.begin, self.length, self.arena = np.zeros(1, np.int64), np.zeros(1, np.int64), np.empty(0, np.uint32)

    def _learn(self, parts: pa.Array) -> None:
        """Append the ids of parts not met before to the arena."""
        direct = pc.match_substring_regex(parts, _DIRECT)
        plain, other = parts.filter(direct), parts.filter(pc.invert(direct))
        flat, lengths = array("I"), []
        tokenize = self.tokenizer.model.tokenize
        for part in plain.to_pylist():
            ids = [t.id for t in tokenize(part)]
            flat.extend(ids)
            lengths.append(len(ids))
        texts = other.to_pylist()
        for lo in range(0, len(texts), 2000):
            some = texts[lo : lo + 2000]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            begins = np.cumsum([0, *(len(x) + 1 for x in some)])
            at = np.fromiter((s for s, _ in found.offsets), np.int64, len(found.offsets))
            flat.extend(found.ids)
            lengths += np.diff(np.searchsorted(at, begins)).tolist()
        each = np.array(lengths, np.int64)
        self.begin = np.concatenate((self.begin, len(self.arena) + np.cumsum(each) - each))
        self.length = np.concatenate((self.length, each))
        self.arena = np.concatenate((self.arena, np.array(flat, np.uint32)))
        self.known = pa.concat_arrays([self.known, plain, other])

    def _places(self, parts: pa.Array) -> np.ndarray:
        """The place of each part in the table, new ones added to it."""
        place, first = pc.index_in(parts, value_set=self.known), len(self.known)
        if not place.null_count:
            return place.to_numpy().astype(np.int64)
        new = place.is_null()
        met = parts.filter(new)
        self._learn(pc.unique(met))
        place = place.fill_null(0).to_numpy().astype(np.int64)
        place[new.to_numpy(zero_copy_only=False)] = first + pc.index_in(met, value_set=self.known.slice(first)).to_numpy()
        return place

    def _chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks, one after another, and the number of each."""
        base = pc.ascii_rtrim(chunks, characters=_PUNCT)
        cut = pc.and_(pc.not_equal(base, chunks), pc.match_substring_regex(base, _WORD))
        ends = pc.replace_substring_regex(chunks.filter(cut), pattern=_BEFORE_PUNCT, replacement="", max_replacements=1).dictionary_encode()
        n, kinds = len(chunks), len(ends.dictionary)
        place = self._places(pa.concat_arrays([pc.if_else(cut, base, chunks), ends.dictionary]))
        both = np.zeros((n, 2), np.int64)  # each chunk's two parts, the second mostly the empty one
        both[:, 0] = place[:n]
        both[cut.to_numpy(zero_copy_only=False), 1] = place[n : n + kinds][ends.indices.to_numpy()]
        both = both.reshape(-1)
        each = self.length[both]
        ids = self.arena[np.repeat(self.begin[both] - (np.cumsum(each) - each), each) + np.arange(each.sum())]
        return ids, each.reshape(-1, 2).sum(1)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if column.null_count:
            column = column.fill_null("")
        lists = pc.ascii_split_whitespace(pc.ascii_lower(column))
        at = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        at = at - at[0]
        if len(self.known) > PARTS:
            self._forget()
        ids, number = self._chunk_ids(coded.dictionary.cast(pa.string()))
        which = coded.indices.to_numpy()
        each = number[which]
        upto = np.concatenate(([0], np.cumsum(each)))
        place = np.repeat((np.cumsum(number) - number)[which] - upto[:-1], each)
        place += np.arange(upto[-1])
        return ids[place], upto[at]


def encoder(path: str) -> WordEncoder:
    """One encoder a worker."""
    kept = own_cache("tokens")
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]
