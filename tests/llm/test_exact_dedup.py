from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from kickwx.llm.exact_dedup import exact_dedup
from tests.llm.helpers import awkward, documents


def check(rows, got):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    assert len(got) == len(rows)
    seen = defaultdict(list)
    for r in got:
        seen[r.text_sha256].append(r)
    for text, ids in groups.items():
        found = seen.pop(sha256(text.encode()).hexdigest())
        largest = max((i for i in ids if i is not None), default=None)
        assert sorted((r.doc_id is not None, r.doc_id or 0) for r in found) == sorted((i is not None, i or 0) for i in ids)
        assert all(r.keep_id == largest and r.group_size == len(ids) for r in found)
        kept = [r for r in found if r.kept]
        assert len(kept) == 1 and kept[0].doc_id == largest
    assert not seen


def test_matches_brute_force_on_awkward_rows(spark):
    df = documents(spark, awkward()).withColumns({"digit": F.lit(1), "rest": F.lit("r"), "kept": F.lit(0), "node": F.lit(2)})
    check(awkward(), exact_dedup(df).collect())


def test_texts_that_part_late_and_at_every_level(spark):
    base = "a" * 10_000
    rows = [(i, base[:n] + tail) for i, (n, tail) in enumerate(
        [(0, ""), (1, ""), (127, ""), (128, ""), (128, "b"), (129, ""), (1151, "b"), (1152, ""), (1152, "b"), (9344, ""), (9345, ""), (10_000, "c"), (10_000, "c")])]
    check(rows, exact_dedup(documents(spark, rows)).collect())
    check(rows, exact_dedup(documents(spark, rows), first_digit=1, growth=2).collect())


def test_empty_table(spark):
    assert exact_dedup(documents(spark, [])).collect() == []
