"""Whole-text encoding with the tokenizers library, sharing the work on repeated chunks.

For a tokenizer whose pre-tokenizer drops white space, a text's ids are the ids of its
space-separated chunks put together: no match, merge or normalisation crosses a space. Arrow splits a
batch at U+0020 and numbers the distinct chunks; the library encodes only those not met before.
"""

from __future__ import annotations

import json
import re
import unicodedata
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from kickwx.llm.batches import kept

MEMO_CHUNKS = 400_000

# Lower-case letters of Latin-1 (which normalisation leaves as they are) before ASCII punctuation.
LETTER_THEN_MARK = r"([a-zß-öø-ÿ])([!-/:-@\[-`{-~])"

ALPHABET = "abcdefghijklmnopqrstuvwxyz zyxwvutsrqponmlkjihgfedcba"


def _room(array: np.ndarray, used: int, more: int) -> np.ndarray:
    """The array, or its used part in one of twice the length, with room for ``more`` entries."""
    if used + more <= len(array):
        return array
    out = np.empty(max(2 * len(array), used + more), array.dtype)
    out[:used] = array[:used]
    return out


def _letters(word: str) -> bool:
    """Letters only, and still so once normalised as the tokenizer does."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


class ChunkEncoder:
    """Encoder for one tokenizer file; keeps the ids of at most ``MEMO_CHUNKS`` chunks (or of one slice, if it has more).

    When a slice would pass that, the chunks that the fewest slices had go: at least half of those kept.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # lower-case ASCII words need no normalisation, most of the cost of a word, where that leaves them as they are
        self.normal = self.plain = self.tokenizer.normalizer
        if self.normal and self.normal.normalize_str(ALPHABET) == ALPHABET:
            self.plain = Sequence([])
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(1 + max(vocab.values()), bool)
        if suffix:
            self.ends_word[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        # texts with an added token, in any case of A-Z, are left as they are
        self.added = "|".join("(?i:" + re.escape(t.content) + ")" for t in self.tokenizer.get_added_tokens_decoder().values())
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0
        self.starts, self.sizes, self.hits = (np.empty(1 << 14, t) for t in (np.int64, np.int64, np.int32))

    def _thin(self) -> None:
        """Keep the chunks that the most slices had, at most half of ``MEMO_CHUNKS``; their ids move together."""
        n = len(self.memo)
        hits = self.hits[:n]
        least = 2
        while np.count_nonzero(hits >= least) > MEMO_CHUNKS // 2:
            least += 1
        stay = hits >= least
        old = np.flatnonzero(stay)
        sizes = self.sizes[old]
        ids = self.ids[self._places(self.starts[old], sizes)]
        chunks = list(compress(self.memo, stay.tolist()))  # the memo numbers its chunks in the order of their insertion
        again = hits[old] // 2
        self._forget()
        self._keep(chunks, ids, sizes)
        self.hits[:len(old)] = again

    @staticmethod
    def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Positions of the runs that begin at ``starts``, one after the other."""
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        at += np.arange(len(at))
        return at

    def _keep(self, chunks: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, more = len(self.memo), len(chunks)
        self.ids = _room(self.ids, self.used, len(ids))
        self.starts, self.sizes, self.hits = (_room(a, n, more) for a in (self.starts, self.sizes, self.hits))
        self.ids[self.used:self.used + len(ids)] = ids
        self.starts[n:n + more] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n:n + more] = sizes
        self.hits[n:n + more] = 0
        self.memo.update(zip(chunks, range(n, n + more)))
        self.used += len(ids)

    def _encode_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        self.tokenizer.normalizer = self.plain
        try:
            return self._encode_words(words)
        finally:
            self.tokenizer.normalizer = self.normal

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of letter runs, each one pre-token, read off the word-end marks of their last tokens."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):
            return self._encode_chunks(words)
        return ids, np.diff(np.append(0, ends))

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode(chunks, is_pretokenized=True, add_special_tokens=False)
        return np.array(found.ids, np.uint32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(chunks))

    def _learn(self, chunks: list[str]) -> None:
        """Add chunks to the memo: runs of letters as one text, others each by itself."""
        words = [c for c in chunks if _letters(c)]
        others = list(set(chunks).difference(words))
        plain = [c for c in words if c.isascii() and c.islower()]
        words = list(set(words).difference(plain))
        for own, code in ((plain, self._encode_plain), (words, self._encode_words), (others, self._encode_chunks)):
            if own:
                self._keep(own, *code(own))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (nulls as empty) in one flat array, and the number of ids of each text."""
        texts = pc.fill_null(texts, "")
        # the tokenizer lowers A-Z itself, and a run of letters ends at the next ASCII punctuation
        eased = pc.replace_substring_regex(pc.ascii_lower(pc.replace_substring(texts, "\n", " ")), LETTER_THEN_MARK, r"\1 \2")
        if self.added:
            eased = pc.if_else(pc.match_substring_regex(texts, self.added), texts, eased)
        pieces = pc.split_pattern(eased, " ")
        offsets = np.asarray(pieces.offsets)
        coded = pieces.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        if not len(coded):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        chunks = coded.dictionary.to_pylist()
        number = self._numbers(chunks)
        new = np.flatnonzero(number < 0)
        if len(new):
            if self.memo and len(self.memo) + len(new) > MEMO_CHUNKS:
                self._thin()
                number = self._numbers(chunks)
                new = np.flatnonzero(number < 0)
            learnt = [chunks[i] for i in new.tolist()]
            self._learn(learnt)
            number[new] = self._numbers(learnt)
        self.hits[number] += 1
        index = number[np.asarray(coded.indices)]
        each = self.sizes[index]
        ends = np.cumsum(each)
        return self.ids[self._places(self.starts[index], each)], np.diff(np.append(0, ends)[offsets])

    def _numbers(self, chunks: list[str]) -> np.ndarray:
        """Each chunk's number in the memo, -1 where it has none."""
        return np.fromiter(map(self.memo.get, chunks, repeat(-1)), np.int64, len(chunks))


def encoder(path: str) -> ChunkEncoder:
    """This worker's encoder for a tokenizer file."""
    return kept("chunk encoder", path, ChunkEncoder)
