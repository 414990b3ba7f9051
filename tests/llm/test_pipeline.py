"""The pipeline's stages against brute force, and the queries that have SQL against it."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline as cp
from kickwx.llm.language_id import BUCKETS, Model
from kickwx.llm.queries import llm_oracle_sql, llm_queries
from kickwx.llm.scratch import written
from tests.llm.helpers import SF, awkward, documents
from tests.llm.test_simhash import brute_fingerprint, near_pairs
from tests.llm.helpers import union_find


def rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))


def grams(text):
    own = (text or "").lower().split()
    return {tuple(own[j:j + 50]) for j in range(len(own) - 49)}


def test_stages_on_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = rows(docs)
    stages = dict(cp.STAGES)
    docs = written(stages["language_id"](spark, docs, SF), "t")
    now = rows(docs)
    assert docs.columns == cp.COLUMNS and now == [x for x in before if x[1] and any(c.isalpha() for c in x[1])]

    largest = {}
    for i, t in now:
        largest[t] = max(i, largest.get(t, i))
    docs = written(stages["exact_dedup"](spark, docs, SF), "t")
    now = rows(docs)
    assert docs.columns == cp.COLUMNS and now == sorted((i, t) for t, i in largest.items())

    root = union_find(near_pairs([brute_fingerprint(t) for _, t in now]), range(len(now)))
    docs = written(stages["simhash_near_dedup"](spark, docs, SF), "t")
    assert docs.columns == cp.COLUMNS and rows(docs) == [x for n, x in enumerate(now) if root[n] == n]

    now = rows(docs)
    docs = written(stages["substring_dedup"](spark, docs, SF), "t")
    after = dict(rows(docs))
    assert docs.columns == cp.COLUMNS and all(r.n_chars == len(r.text) for r in docs.collect())
    counts = {}
    for i, t in now:
        for g in grams(t):
            counts.setdefault(g, []).append(i)
    repeats = {g for g, ids in counts.items() if len(ids) > 1}
    for g in repeats:  # each repeated passage is left in one place
        assert sum(g in grams(t) for t in after.values()) <= 1
    touched = {i for g in repeats for i in counts[g][1:]}
    same = sum(after.get(i) == t for i, t in now)
    assert all(after.get(i) != t for i, t in now if i in touched) and same >= len(now) - 2 * len(touched) - 3

    packed = stages["packing"](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(after)
    ends = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096


def test_stages_take_awkward_rows_extra_columns_and_empty_tables(spark):
    names = {"row": "clash", "key": "clash", "ident": "clash", "spans": "clash", "whole": "clash"}
    df = documents(spark, awkward())
    for c, v in names.items():
        from pyspark.sql import functions as F
        df = df.withColumn(c, F.lit(v))
    for name, stage in cp.STAGES:
        out = stage(spark, written(df, "t"), SF)
        none = stage(spark, written(df.filter("false"), "t"), SF)
        assert none.collect() == [] and none.columns == out.columns
        if name != "packing":
            assert out.columns == cp.COLUMNS
        assert out.count() > 0
    kept = rows(cp.exact(spark, written(df, "t"), SF))
    assert len({t or "" for _, t in kept}) == len(kept) == len({t or "" for _, t in awkward()})
    text = "the cat <b> sat " * 3
    cut = cp._without(F.lit(text), F.array(*[F.struct(F.lit(a).alias("first_char"), F.lit(n).alias("n_chars")) for a, n in ((0, 4), (2, 6), (20, 5))]))
    assert spark.range(1).select(cut).first()[0] == text[8:20] + text[25:]


def test_run_chains_the_stages(spark):
    out = cp.run(spark, SF)
    assert out.count() > 150 and "sequence_id" in out.columns
    assert E.queries()["pipeline"] is cp.run and set(llm_queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(llm_oracle_sql()))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = llm_queries()[name](spark, SF)
    found = con.execute(llm_oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, df.select(*columns).collect())) == sorted(str(r) for r in spark.createDataFrame(found.fetchall(), df.select(*columns).schema).collect())


def test_language_stage_rejects_only_texts_without_a_letter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    of = {}
    for r in docs.filter("lang IS NOT NULL AND text IS NOT NULL").orderBy("doc_id").collect():
        of.setdefault(r.lang, []).extend(w for w in r.text.split() if w.isalpha())
    n = min(len(own) for own in of.values()) // 4
    switched = [" ".join(w for lang in sorted(of) for w in of[lang][n * k:n * (k + 1)]) for k in range(4)]
    odd = [*switched, "xq zzkv wqj vvxk qqz jxkq", "12 34 -- !!", "  "]
    extra = documents(spark, [(10**9 + i, t) for i, t in enumerate(odd)])
    got = cp.language(spark, docs.select(*cp.COLUMNS).unionByName(extra), SF).filter(f"doc_id >= {10**9}").collect()
    assert {r.doc_id - 10**9 for r in got} == set(range(5))


def test_language_stage_keeps_texts_evenly_of_all_languages(spark, monkeypatch):
    even = Model(["aa", "bb", "cc", "dd"], np.zeros((BUCKETS, 4), np.float32), np.zeros((4, 4)), np.zeros(4))  # 1/4 each for any word
    monkeypatch.setattr(cp, "train", lambda docs: even)
    got = cp.language(spark, documents(spark, [(1, "words of any language"), (2, "12 !!"), (3, None)]), SF).collect()
    assert [r.doc_id for r in got] == [1]
