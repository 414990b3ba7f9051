import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kickwx.llm.language_id import features, fit, identify, marginals, train
from kickwx.llm.queries import id_remainder, op7_toxicity, op10_language_id
from kickwx.llm.toxicity import WORD, BlockMaxIndex, TermTable, class_examples, example_terms, terms_of, toxicity_scores, words_of
from tests.llm.helpers import awkward, documents

SF_LARGER = "/root/testdata/sf0.01"


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    sizes = np.array([1, 3, 64, 65, 130, 200, 2])
    scores, trans, start = 5 * rng.normal(size=(sizes.sum(), 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    got, at = marginals(scores, sizes, trans, start), 0
    for n in sizes:
        e, a = np.exp(scores[at:at + n]), np.exp(trans)
        alpha, beta = [np.exp(start) * e[0]], [np.ones(3)]
        for t in range(1, n):
            alpha.append(alpha[-1] @ a * e[t] / e[t].sum())
            beta.append(a @ (e[n - t] * beta[-1]) / e[n - t].sum())
        both = np.array(alpha) * np.array(beta[::-1])
        assert np.allclose(got[at:at + n], both / both.sum(axis=1, keepdims=True), atol=1e-12)
        at += n


def test_features_are_of_the_word_alone():
    at, sizes = features(["ab", "abc", "ab", "é"])
    cuts = np.split(at, np.cumsum(sizes)[:-1])
    assert cuts[0].tolist() == cuts[2].tolist() and sizes.tolist() == [11, 15, 11, 11]


def test_code_switched_words_are_labelled(spark):
    rnd = random.Random(2)
    make = {"aa": lambda: "".join(rnd.choice(["ka", "lo", "mi"]) for _ in range(3)), "bb": lambda: "".join(rnd.choice(["sch", "ung", "er"]) for _ in range(3))}
    spans = [(lang, [f() for _ in range(12)]) for lang, f in make.items() for _ in range(80)]
    model = fit(spans)
    text = " ".join([make["aa"]() for _ in range(20)] + [make["bb"]() for _ in range(30)])
    row = identify(documents(spark, [(1, text)]), model).first()
    assert row.lang_pred == "bb" and 0.5 < row.score < 0.7
    assert [(r.lang, r.first_word, r.n_words) for r in row.runs] == [("aa", 0, 20), ("bb", 20, 30)]


def test_language_of_awkward_rows(spark):
    rows = [(i, t) for i, t in awkward()] + [(i, "the and of this") for i in range(20, 30)] + [(40, "123 !? ٣")]
    df = documents(spark, rows).withColumns({"lang_pred": F.lit("clash"), "score": F.lit(9)})
    out = identify(df, train(df)).collect()
    assert len(out) == len(rows)
    letters = {i for i, t in rows if t and any(c.isalpha() for c in t)}
    for r in out:
        assert (r.lang_pred == "und") == (r.doc_id not in letters) or r.doc_id is None
        assert 0 <= r.score <= 1 and (r.lang_pred != "und" or (r.score == 0 and not r.runs))
    none = train(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in identify(df, none).collect()} == {"und"}
    assert identify(df.filter("false"), none).collect() == []


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_LARGER}/documents.parquet").select("doc_id", "lang")
    got = op10_language_id(spark, SF_LARGER).join(docs, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98


def test_block_max_search_is_exact():
    rng = np.random.default_rng(1)
    n_terms, vectors = 40, []
    for _ in range(500):
        terms = np.sort(rng.choice(n_terms, rng.integers(0, 6), replace=False))
        w = rng.random(len(terms))
        vectors.append((terms, w / np.sqrt((w * w).sum()) if len(w) else w))
    vectors += [(np.array([3]), np.array([1.0]))] * 100  # ties
    dense = np.zeros((len(vectors), n_terms))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    index = BlockMaxIndex(vectors, n_terms)
    for i, (t, w) in enumerate(vectors):
        for without in (-1, i):
            scores = dense @ dense[i]
            if without >= 0:
                scores[without] = 0
            found = np.flatnonzero(scores > 1e-15)
            want = found[np.lexsort((found, -np.round(scores[found], 12)))][:16]
            best, cosine = index.nearest(t, w, 16, without)
            assert np.allclose(cosine, np.minimum(scores[want], 1), atol=1e-9) and len(best) == len(want)


def test_term_counts_cover_the_whole_text():
    table = TermTable({"idiot": 0, "idio*": 1, "zz": 2})
    text = "x " * 100_000 + "Idiot, idiots IDIOT"
    terms, counts, starts = table.counts([None, text, "", "zz y"])
    assert (terms.tolist(), counts.tolist(), starts.tolist()) == ([0, 1, 2], [2, 3, 1], [0, 0, 2, 2, 3])
    assert [len(v) for v in table.counts([None, ""])] == [0, 0, 3] and not len(TermTable({}).counts(["a b"])[0])


def test_term_counts_equal_a_plain_count():
    rnd = random.Random(7)
    texts = [None, "", "123 _ --", "Straße ÉCOLE idiots_x1y Idiot's", *(" ".join(rnd.choice(["Idiots", "idiom", "zz", "été", "a1b", "unknown"]) for _ in range(n)) for n in (1, 40, 900))]
    assert all(words_of(t) == WORD.findall((t or "").lower()) for t in texts)
    number = {t: i for i, t in enumerate(["idiots", "idio*", "idiot*", "zz", "été", "b"])}
    table = TermTable(number)
    for _ in range(2):  # also with the words known
        numbers, counts, starts = table.counts(texts)
        for i, text in enumerate(texts):
            want = Counter(number[t] for w in WORD.findall((text or "").lower()) for t in terms_of(w) if t in number)
            assert list(zip(numbers[starts[i]:starts[i + 1]].tolist(), counts[starts[i]:starts[i + 1]].tolist())) == sorted(want.items())
    assert len(table.rows) == 3 * 7  # one row for all words without a term


def test_toxicity_equals_a_plain_nearest_neighbour_search(spark):
    """Scores and evidence of all documents, against vectors as dictionaries and all cosines."""
    docs = spark.read.parquet(f"{SF_LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{SF_LARGER}/labels.parquet").filter(id_remainder(5) != 0)
    got = {r.doc_id: r for r in toxicity_scores(docs, labels).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    marks = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    bags = {}
    for i, text in texts.items():
        bag = bags[i] = {}
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            for term in {word, *((word[:4] + "*",) if len(word) > 4 else ()), *((word[:5] + "*",) if len(word) > 5 else ())}:
                bag[term] = bag.get(term, 0) + 1
    ids = sorted((i for i in marks if i in texts), key=str)
    known = {t for i in ids for t in bags[i]}
    df = {}
    for bag in bags.values():
        for t in known.intersection(bag):
            df[t] = df.get(t, 0) + 1
    vectors = {}
    for i, bag in bags.items():
        v = {t: (1 + math.log(c)) * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t, c in bag.items() if t in known}
        size = math.sqrt(sum(x * x for x in v.values()))
        vectors[i] = {t: x / size for t, x in v.items()}
    by_vote = []
    share = {c: sum(m == c for m in marks.values()) / sum(marks[i] == c for i in ids) for c in (0, 1)}
    pull = {c: share[c] / max(share.values()) for c in (0, 1)}
    prior = (sum(marks.values()) + 1) / (len(marks) + 2)
    for i in texts:
        cosines = {e: sum(x * vectors[e].get(t, 0.0) for t, x in vectors[i].items()) for e in ids}
        best = sorted((c for c in cosines.values() if c > 1e-12), reverse=True)[:16]
        row = got[i]
        assert np.allclose([e.cosine for e in row.evidence], np.minimum(best, 1), atol=1e-9)
        assert all(abs(min(cosines[e.doc_id], 1) - e.cosine) < 1e-9 and e.label == marks[e.doc_id] for e in row.evidence)
        near = [(pull[e.label] * e.cosine, e.label) for e in row.evidence]
        raw = (sum(w for w, m in near if m) + 0.5 * prior) / (sum(w for w, _ in near) + 0.5)
        raw = min(max(raw, 1e-4), 1 - 1e-4)
        by_vote.append((math.log(raw / (1 - raw)), math.log(row.score / (1 - row.score))))
    x, z = np.array(sorted(by_vote)).T
    slope, shift = np.polyfit(x, z, 1)  # scores are one rising logistic function of the votes
    assert slope > 0 and np.allclose(slope * x + shift, z, atol=1e-6)


def test_toxicity_learns_only_from_the_labelled_rows(spark):
    rnd = random.Random(6)
    fill = lambda: " ".join(f"w{rnd.randrange(500)}q" for _ in range(40))
    rows = [(i, fill() + (" you vileword there" if i % 4 == 0 else "")) for i in range(400)]
    rows += [(1000, "vileword"), (1001, None), (1002, ""), (1003, fill()), (1003, fill()), (None, "a vileword b")]
    marks = [(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (5, None), (7, 0), (99999, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    df = documents(spark, rows).withColumns({"score": F.lit(1), "terms": F.lit("t"), "label": F.lit(0)})
    out = toxicity_scores(df, labels).collect()
    assert len(out) == len(rows)
    toxic = {i for i, t in rows if t and "vileword" in t}
    for r in out:
        assert 0 <= r.score <= 1 and (r.score >= 0.5) == (r.doc_id in toxic)
        assert not r.evidence or abs(r.evidence[0].cosine) <= 1
    assert next(r for r in out if r.doc_id == 1000).evidence
    assert toxicity_scores(df.filter("false"), labels).collect() == []
    flat = {r.score for r in toxicity_scores(df, labels.filter("toxic = 0")).collect()}
    assert len(flat) == 1 and flat.pop() < 0.5
    assert {round(r.score, 6) for r in toxicity_scores(df, labels.filter("false")).collect()} == {0.5}


def test_toxicity_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF_LARGER}/labels.parquet")
    got = op7_toxicity(spark, SF_LARGER).collect()
    assert len(got) == 1000
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(r.score, marks[r.doc_id]) for r in got if r.held_out and r.doc_id in marks]
    pos, neg = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) > 0.75
    want = {r[0] for r in spark.range(1000).toDF("doc_id").filter(id_remainder(5) == 0).collect()}
    assert {r.doc_id for r in got if r.held_out} == want


def test_examples_of_a_class_are_not_ranked_in_one_task(spark):
    marks = spark.range(9000).select(F.col("id").alias("doc_id"), (F.col("id") % 9 == 0).cast("int").alias("label"))
    chosen = class_examples(marks, 0, 2000)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan and "Exchange" not in plan
    order = marks.filter("label = 0").select("doc_id", F.xxhash64("doc_id").alias("h")).collect()
    want = [r.doc_id for r in sorted(order, key=lambda r: (r.h, r.doc_id))[:2000]]
    assert [r.doc_id for r in chosen.collect()] == want


def test_language_sample_is_the_smallest_hashed_ids(spark):
    from pyspark.sql import Window

    from kickwx.llm.language_id import smallest_hashed

    rows = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 3 > 0 THEN 'aa' WHEN id % 2 = 0 THEN 'bb' ELSE 'cc' END AS lang")
    rows = rows.unionByName(spark.range(3000).selectExpr("-7L AS doc_id", "'dd' AS lang"))  # one id repeated
    rows = rows.unionByName(spark.range(3000).selectExpr("id % 4 AS doc_id", "'ee' AS lang")).unionByName(spark.range(2).selectExpr("id + 90000 AS doc_id", "'ff' AS lang"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    for k in (1, 20, 700):
        want = sorted(r[0] for r in rows.withColumn("n", rank).filter(F.col("n") <= k).collect())
        assert sorted(smallest_hashed(rows, k)) == want
    assert smallest_hashed(rows.limit(0), 5) == []


def test_example_terms_come_as_arrow_in_order(spark):
    rows = spark.createDataFrame([("Zebra é word",), (None,), ("word",)], "text string")
    terms = example_terms(rows)
    assert isinstance(terms, pa.Array) and terms.to_pylist() == sorted({"zebra", "zebr*", "é", "word"})
    assert example_terms(rows.limit(0)).to_pylist() == []
