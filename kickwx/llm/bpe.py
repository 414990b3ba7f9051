"""Byte-level BPE encoding and decoding with batched numpy merge rounds."""

from __future__ import annotations

import json
import string
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kickwx.llm.batches import kept, slices

MEMO_PIECES = 500_000

# Fixed value: the split pattern of byte-level tokenizers, with Unicode white space written out.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
# A space beside other white space belongs to a longer run, so such a text is not cut at single spaces.
RUNS = r" [\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]" + "|" + (
    r"[\t-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] \z"
)
NO_RANK = np.int64(2**62)


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in vocabulary files: itself if it is printable
    Latin-1, else the next code point from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class BytePairCodec:
    """Encoder and decoder for one tokenizer file; keeps the ids of at most ``MEMO_PIECES`` pieces, then starts anew."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        plain = (
            model["type"] == "BPE" and pre["type"] == "ByteLevel" and pre.get("use_regex", True)
            and not pre["add_prefix_space"] and spec.get("normalizer") is None
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
        )
        if not plain:
            raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
        vocab, of_byte = model["vocab"], byte_characters()
        self.byte_ids = np.array([vocab[of_byte[b]] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        to_byte = {c: b for b, c in of_byte.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.added.values()])
        table = [b""] * size
        for token, i in vocab.items():
            table[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        for token, i in self.added.items():
            table[i] = token.encode()
        self.bytes_of = pa.array(table, pa.large_binary())
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.slow = RUNS + "".join(f"|{regex.escape(s)}" for s in self.added)
        self.memo: dict[str, bytes] = {}

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many byte strings in one flat array, and the number of ids of each.

        In each round every word merges its lowest-ranked pair, wherever it occurs (left to right where
        occurrences overlap); words without a known pair leave.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self.ranks[at], NO_RANK), NO_RANK)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word))))
            ended = lowest == NO_RANK
            done.append((word[ended], symbols[ended]))
            hits = np.flatnonzero((rank == lowest) & ~ended)
            run = np.append(True, np.diff(hits) > 1)
            number = np.arange(len(hits))
            hits = hits[(number - np.maximum.accumulate(np.where(run, number, 0))) % 2 == 0]
            symbols[hits] = self.merged[at[hits]]
            left = ~ended
            left[hits + 1] = False
            symbols, word = symbols[left], word[left]
        if not done:
            return np.empty(0, np.int64), sizes
        word, symbols = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(words))

    def _pieces(self, unit: str) -> list[str]:
        """Pieces of a text that starts and ends at piece boundaries; added tokens come as themselves."""
        word = unit.rstrip(string.punctuation)
        if (word[1:] if word[:1] == " " else word).isalpha():
            return [word, unit[len(word):]] if len(word) < len(unit) else [word]
        if self.special is None:
            return PIECES.findall(unit)
        out, at = [], 0
        for m in self.special.finditer(unit):
            out += [*PIECES.findall(unit[at:m.start()]), m[0]]
            at = m.end()
        return out + PIECES.findall(unit[at:])

    def _learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self.memo]
        if not new:
            return
        if len(self.memo) + len(new) > MEMO_PIECES:
            self.memo, new = {}, list(pieces)
        plain = [p for p in new if p not in self.added]
        ids, sizes = self.merge([p.encode() for p in plain])
        raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
        self.memo.update((p, raw[a:b]) for p, a, b in zip(plain, [0, *ends], ends))
        self.memo.update((p, np.array([self.added[p]], "<u4").tobytes()) for p in new if p in self.added)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (nulls as empty) in one flat array, and the number of ids of each text.

        A text is cut before each single space, which is always a piece boundary; texts with longer runs of white
        space around a space, or with added tokens, are cut by the pattern itself. Equal units are encoded once.
        """
        texts = pc.fill_null(texts, "")
        slow = np.asarray(pc.match_substring_regex(texts, self.slow))
        split = pc.split_pattern(pc.if_else(pa.array(slow), "", texts), " ")
        offsets = np.asarray(split.offsets)
        coded = split.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        code = 2 * np.asarray(coded.indices).astype(np.int64) + 1
        code[offsets[:-1][np.diff(offsets) > 0]] -= 1  # a text's first unit has no space before it
        used = np.zeros(2 * len(coded.dictionary), bool)
        used[code] = True
        used = np.flatnonzero(used)
        chunks = coded.dictionary.to_pylist()
        units = [" " + chunks[c >> 1] if c & 1 else chunks[c >> 1] for c in used.tolist()]
        number = np.zeros(2 * len(chunks), np.int64)
        number[used] = np.arange(len(used))
        index, sizes = number[code], np.diff(offsets)
        if slow.any():
            parts = np.split(index, offsets[1:-1])
            for i in np.flatnonzero(slow).tolist():
                parts[i] = np.array([len(units)])  # the whole text as a unit
                units.append(texts[i].as_py())
            index, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        pieces = [self._pieces(u) for u in units]
        self._learn(set(chain.from_iterable(pieces)))
        memo = self.memo
        raw = [b"".join([memo[p] for p in own]) for own in pieces]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        pool = np.frombuffer(b"".join(raw), "<u4")
        starts = np.cumsum(lengths) - lengths
        each = lengths[index]
        ends = np.cumsum(each)
        at = np.repeat(starts[index] - (ends - each), each)
        at += np.arange(len(at))
        return pool[at], np.diff(np.append(0, ends)[np.append(0, np.cumsum(sizes))])

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """Texts of flat ids; invalid UTF-8 becomes U+FFFD. Ids outside the vocabulary are left out."""
        inside = ids < len(self.bytes_of)
        if not inside.all():
            sizes = np.diff(np.append(0, np.cumsum(inside))[np.append(0, np.cumsum(sizes))])
            ids = ids[inside]
        taken = self.bytes_of.take(pa.array(ids, pa.int64()))
        _, offsets, data = taken.buffers()
        ends = np.frombuffer(offsets, np.int64, len(ids) + 1) if len(ids) else np.zeros(1, np.int64)
        cuts = ends[np.append(0, np.cumsum(sizes))]
        raw = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(cuts.tobytes()), data if data else pa.py_buffer(b"")])
        try:
            return raw.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.large_string())


def codec(path: str) -> BytePairCodec:
    """This worker's codec for a tokenizer file."""
    return kept("byte pair codec", path, BytePairCodec)


def bpe_encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, ids`` (array of int), as the tokenizers library encodes its text without
    adding special tokens; the strings of special tokens in a text become those tokens.

    No shuffle; a task's memory follows a 2 MB slice of texts (or one longer text) and the bounded memo.

    Defined cases: a null or empty text has no ids; ids may be null or repeated; empty input gives no rows;
    other columns are ignored.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(tokenizer_path)
        for part in slices(batches, "text", keeps=True):
            ids, sizes = code.encode(part.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(out.field(0).type), lists.cast(out.field(1).type)], schema=out)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def bpe_decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of token ids: ``doc_id, ids, text``, with special tokens as their strings.

    Defined cases: null or empty ids give an empty text; a null or unknown id stands for no text; bytes that are not
    UTF-8 become U+FFFD as the tokenizers library has it; other columns are ignored.
    """
    schema = T.StructType([
        T.StructField("doc_id", encoded.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("text", T.StringType()),
    ])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(tokenizer_path)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                lists = part.column("ids")
                flat = np.asarray(pc.fill_null(lists.flatten(), 2**31 - 1)).astype(np.int64)
                sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64)
                texts = code.decode(np.where(flat < 0, 2**31 - 1, flat), sizes)
                columns = [part.column("doc_id"), lists, texts]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, schema)
