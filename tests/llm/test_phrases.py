"""Phrase mining against the SQL on the given tables and against plain Python on awkward texts."""

import re
from collections import Counter

import duckdb

from kickwx.llm import phrases
from kickwx.llm.phrases import mine_phrases
from kickwx.llm.queries import OP12_SQL, op12_phrase_mining
from tests.llm.helpers import DOCUMENTS, awkward

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least=30, longest=4, within=80, limit=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {}
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i:i + size]] = max(a, inside.get(p[i:i + size], 0))
        rows = []
        for p, a in candidates.items():
            if 100 * inside.get(p, -1) >= within * a:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def collected(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS FROM '{sf}/documents.parquet'")
    want = sorted(duckdb.sql(f"SELECT {', '.join(COLUMNS)} FROM ({OP12_SQL})").fetchall())
    got = collected(op12_phrase_mining(spark, sf))
    assert len(got) > 200 and got == want


def made():
    rows = [("en", "New York is big. new york, New\tYork; not new.york! The new york times\nnew york times"), ("en", "a a a a a a a a"), (None, "a b c a b c a b c"),
            ("und", "a b c d"), ("de", ""), ("fr", None), ("en", " \t "), ("xx", "É é É é ı İ I i É é"), ("en", "x\x0by\x0cz\rw x y x y x y\x1cz x y")]
    return rows * 4 + [("en", "solo words"), ("yy", "....")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None) for i, (lang, t) in enumerate(rows)], DOCUMENTS).withColumnsRenamed({"source": "phrase", "n_chars": "word"})


def test_matches_brute_force(spark, monkeypatch):
    for least, block in ((1, 16), (3, 64), (4, 4 << 20)):
        monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
        got = collected(mine_phrases(table(spark, made()).repartition(3), least=least, limit=50))
        assert got == brute(made(), least=least, limit=50)


def test_awkward_texts(spark):
    rows = [("en", t) for _, t in awkward()] + [(None, "the hot phrase " * 20_000)]
    assert collected(mine_phrases(table(spark, rows), least=2)) == brute(rows, least=2)


def test_ranking_in_shares(spark, monkeypatch):
    monkeypatch.setattr(phrases, "RANKED", 8)
    assert collected(mine_phrases(table(spark, made()), least=2, limit=4)) == brute(made(), least=2, limit=4)


def test_empty(spark):
    assert mine_phrases(table(spark, made()).filter("false")).count() == 0
    assert mine_phrases(table(spark, [("en", None), (None, ".")])).count() == 0
