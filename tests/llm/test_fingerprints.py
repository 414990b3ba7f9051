import os.path
import random
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from kickwx.llm.fingerprints import PrefixHashes, fingerprints, likeness, spliced_fingerprints
from kickwx.llm.queries import op9_document_fingerprints
from tests.llm.helpers import SF, awkward, documents


def test_spans_and_extensions_against_slices():
    rnd = random.Random(1)
    a, b = ("".join(rnd.choice("ab\U0001f600") for _ in range(400)) for _ in range(2))
    ha, hb = PrefixHashes(a), PrefixHashes(b)
    for _ in range(500):
        i, j, n = rnd.randrange(400), rnd.randrange(400), rnd.randrange(12)
        x, y = a[i:i + n], b[j:j + n]
        assert (ha.span(i, i + len(x)) == hb.span(j, j + len(y))) == (x == y)
        assert ha.extension(i, hb, j) == len(os.path.commonprefix([a[i:], b[j:]]))


def test_likeness_follows_shared_windows():
    rnd = random.Random(2)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(4000))
    mark = PrefixHashes(text).fingerprint()
    half = PrefixHashes(text[:2000] + text[:2000][::-1]).fingerprint()
    assert likeness(mark, mark) == 1 and 0.15 < likeness(mark, half) < 0.55
    assert likeness(mark, PrefixHashes(text[::-1]).fingerprint()) < 0.1
    assert likeness(PrefixHashes("").fingerprint(), PrefixHashes("").fingerprint()) == 1
    assert 0 <= likeness(PrefixHashes("").fingerprint(), mark) <= 1


def spliced(rows):
    out = []
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        cut = len(t) // 4
        out.append((i, len(t), t[: len(t) - cut] + n[:cut]))
    return out


def test_neighbours_across_ranges(spark):
    rows = [(i * 3, "" if i % 11 == 0 else f"{i} " * (i % 40)) for i in range(200)]
    df = documents(spark, rows).repartition(7).withColumns({"part": F.lit(1), "key": F.lit(2), "follows": F.lit(3)})
    got = sorted((r.doc_id, r.n_chars, r.edited) for r in spliced_fingerprints(df).collect())
    assert got == spliced(rows)


def test_queries_result_on_the_smallest_table(spark):
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: r for r in op9_document_fingerprints(spark, SF).collect()}
    marks = [PrefixHashes(t).fingerprint() for _, t in rows]
    for (i, n, edited), mark, after in zip(spliced(rows), marks, marks[1:] + marks[:1]):
        r = got.pop(i)
        assert (r.n_chars, r.edited_sha256, r.fingerprint) == (n, sha256(edited.encode()).hexdigest(), mark)
        assert r.near_next == likeness(mark, after) and r.edited_fingerprint == PrefixHashes(edited).fingerprint()
        assert r.near_edited == likeness(mark, r.edited_fingerprint)
    assert not got


def test_awkward_rows_single_and_none(spark):
    df = documents(spark, awkward())
    out = spliced_fingerprints(df).collect()
    key = lambda x: (x is not None, x or 0)
    assert sorted((r.doc_id for r in out), key=key) == sorted((i for i, _ in awkward()), key=key)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and r.common_prefix <= r.n_chars for r in out)
    plain = sorted((str(r.doc_id), r.n_chars, r.fingerprint) for r in fingerprints(df).collect())
    assert plain == sorted((str(r.doc_id), r.n_chars, r.fingerprint) for r in out)
    one = spliced_fingerprints(documents(spark, [(5, "abcdefgh")])).collect()
    assert [(r.doc_id, r.edited, r.near_next) for r in one] == [(5, "abcdefab", 1.0)]
    assert spliced_fingerprints(documents(spark, [])).collect() == []
    assert np.isfinite(one[0].near_edited)
