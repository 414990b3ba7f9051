import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kickwx.llm.bpe import BytePairCodec, bpe_decode, bpe_encode
from kickwx.llm.encode import ChunkEncoder
from kickwx.llm.packing import pack_documents, place
from kickwx.llm.queries import tokenizer
from kickwx.llm.token_files import read_token_files, write_token_files
from kickwx.llm.wavelet import WaveletMatrix, dump, load
from tests.llm.helpers import awkward, documents

WORD, BYTE = tokenizer("word_bpe_49k.json"), tokenizer("byte_bpe_50k.json")
PARTS = list(" \n\t  '.,!<|>abAB éé İßſ1२٣中文\U0001f600‍-_\x00\x0b\x1c\x85\xa0\u2003\u3000\u200b") + [
    "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "word", "Word,", "naïve.", " the", "aaaa", "!!!!", "  ", "\u0958", "Ǆ", "हिन्दी"]


def strings(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30))) for _ in range(n)] + [None, "", " ", "a ", " a", "a\n ", "a  b"]


def split(ids, sizes):
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


@pytest.mark.parametrize("seed", range(3))
def test_chunks_encode_as_whole_texts(seed):
    code, texts = ChunkEncoder(WORD), strings(4000, seed)
    want = [e.ids for e in Tokenizer.from_file(WORD).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert split(*code.encode(pa.array(texts))) == want
    assert split(*code.encode(pa.array(texts))) == want  # now from the memo


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr("kickwx.llm.encode.MEMO_CHUNKS", 50)
    code, lib = ChunkEncoder(WORD), Tokenizer.from_file(WORD)
    for k in range(5):
        texts = [f"alpha{i} beta{i + k}" for i in range(20)]
        assert split(*code.encode(pa.array(texts))) == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
        assert len(code.memo) <= 50


@pytest.mark.parametrize("seed", range(3))
def test_numpy_bpe_equals_the_library_both_ways(seed):
    code, lib, texts = BytePairCodec(BYTE), Tokenizer.from_file(BYTE), strings(4000, seed)
    ids, sizes = code.encode(pa.array(texts))
    want = [e.ids for e in lib.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert split(ids, sizes) == want
    assert code.decode(ids.astype(np.int64), sizes).to_pylist() == [t or "" for t in texts]
    odd = np.random.default_rng(seed).integers(0, 50257, 5000)  # invalid UTF-8 too
    want = [lib.decode(x.tolist(), skip_special_tokens=False) for x in np.split(odd, 500)]
    assert code.decode(odd, np.full(500, 10)).to_pylist() == want


def test_bpe_operators_on_awkward_rows(spark):
    df = documents(spark, awkward()).withColumn("ids", F.lit("clash"))
    encoded = bpe_encode(df, BYTE)
    lib = Tokenizer.from_file(BYTE)
    rows = bpe_decode(encoded, BYTE).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    want = [(i, lib.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in awkward()]
    assert sorted([(r.doc_id, r.ids, r.text) for r in rows], key=key) == sorted(want, key=key)
    assert bpe_encode(df.filter("false"), BYTE).collect() == []
    odd = spark.createDataFrame([(1, None), (2, [None, 64, -1, 10**8])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in bpe_decode(odd, BYTE).collect()} == {1: "", 2: "a"}


def test_place_by_the_sum_of_squares_rule():
    """Against the rule evaluated in full for every item."""
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 41, 300)
    bins, offsets = place(lengths, 40)
    fill, counts = {}, np.zeros(41, int)
    cost = lambda c: int((c[1:40] ** 2).sum())
    for i in np.argsort(-lengths, kind="stable"):
        s, b = int(lengths[i]), int(bins[i])
        options = []
        for gap in [*(g for g in range(s, 40) if counts[g]), 40]:
            after = counts.copy()
            if gap < 40:
                after[gap] -= 1
            after[gap - s] += 1
            options.append((cost(after), gap, after))
        least = min(options)
        gap = 40 - fill.get(b, 0)
        assert offsets[i] == fill.get(b, 0)
        mine = next(o for o in options if o[1] == gap)
        assert mine[0] == least[0]
        counts, fill[b] = mine[2], fill.get(b, 0) + s


def check_packing(rows, texts, capacity):
    lib = Tokenizer.from_file(WORD)
    want = []
    for i, t in texts:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        want += [(i, k, a, ids[a:a + capacity]) for k, a in enumerate(range(0, len(ids), capacity))]
    key = lambda x: (x[0] is not None, x[0] or 0, x[1], x[3])
    got = [(r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values(), default=0) <= capacity
    return len(at), sum(at.values())


def test_packing_of_awkward_rows_and_several_rounds(spark):
    rnd = random.Random(8)
    texts = awkward() + [(100 + i, " ".join(rnd.choice(["one", "two", "apple", "zq9"]) for _ in range(rnd.randint(0, 90)))) for i in range(600)]
    df = documents(spark, texts).repartition(6).withColumn("piece", F.lit("clash"))
    bins, total = check_packing(pack_documents(df, WORD, capacity=128, buffer_tokens=4000).collect(), texts, 128)
    assert bins <= 1.02 * total / 128 + 3
    assert pack_documents(df.filter("false"), WORD).collect() == []


def test_pieces_that_fill_no_bin_end_the_rounds(spark):
    texts = [(i, " ".join(["one"] * 70)) for i in range(60)]  # 71 of 128: two never fit together
    bins, _ = check_packing(pack_documents(documents(spark, texts).repartition(4), WORD, capacity=128, buffer_tokens=500).collect(), texts, 128)
    assert bins == 60


@pytest.mark.parametrize("size", [0, 1, 511, 512, 513, 5000])
def test_wavelet_matrix_against_plain_arrays(size):
    rng = np.random.default_rng(size)
    ids = rng.choice([0, 1, 5, 700, 49407, 70000 if size == 5000 else 2], size)
    matrix, ends = load(dump(ids, np.array([size])))
    assert ends.tolist() == [size] and isinstance(matrix, WaveletMatrix)
    assert (matrix.all() == ids).all() and (matrix.access(np.arange(size)) == ids).all()
    for token in (0, 1, 5, 700, 49407, 3, 10**6):
        for a, b in ((0, size), (size // 3, size // 2)):
            assert matrix.count(token, a, b) == (ids[a:b] == token).sum()
            assert matrix.locate(token, a, b).tolist() == (a + np.flatnonzero(ids[a:b] == token)).tolist()


def test_token_files_round_trip(spark, tmp_path):
    texts = [r for r in awkward()] + [(i, f"text {i} " * (i % 50)) for i in range(20, 320)]
    df = documents(spark, texts).repartition(5).withColumns({"part": F.lit(1), "file": F.lit("f")})
    path = str(tmp_path / "files")
    write_token_files(df, path, WORD, shard_tokens=3000)
    assert spark.read.parquet(path).count() > 5
    lib = Tokenizer.from_file(WORD)
    rows = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    want = [(i, zlib.crc32(np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes())) for i, t in texts]
    assert sorted([(r.doc_id, zlib.crc32(r.ids)) for r in rows], key=key) == sorted(want, key=key)
    write_token_files(df.filter("false"), str(tmp_path / "none"), WORD)
    assert read_token_files(spark, str(tmp_path / "none")).collect() == []


def test_a_full_memo_keeps_the_chunks_that_most_slices_had(monkeypatch):
    from kickwx.llm import encode as E

    monkeypatch.setattr(E, "MEMO_CHUNKS", 60)
    code = E.ChunkEncoder(tokenizer("word_bpe_49k.json"))
    common = "der Weg, the way: Été ÅNGSTRÖM x1 don't 12"
    for n in range(40):
        texts = [common, " ".join(f"w{n}q{i} ur{chr(97 + n % 26)}{chr(97 + i)}" for i in range(8)), "", None]
        ids, sizes = code.encode(pa.array(texts, pa.string()))
        whole = [code.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [i for w in whole for i in w] and sizes.tolist() == [len(w) for w in whole]
        assert len(code.memo) <= 60 and list(code.memo.values()) == list(range(len(code.memo)))
    hits = code.hits[:len(code.memo)]
    assert hits[code.memo["weg,"] if "weg," in code.memo else code.memo["weg"]] > 1
    ids, _ = code.encode(pa.array([" ".join(f"z{i}" for i in range(200))], pa.string()))  # one slice with more than fit
    assert ids.tolist() == code.tokenizer.encode(" ".join(f"z{i}" for i in range(200)), add_special_tokens=False).ids
