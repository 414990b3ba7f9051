import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from kickwx.llm.components import components
from kickwx.llm.simhash import fingerprint, near_links, simhash_near_dups
from tests.llm.helpers import SF, awkward, documents, union_find


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_pairs(prints):
    a = np.array(prints, np.uint64)
    return [(i, int(j)) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a[i] ^ a) <= 3)]


def test_fingerprints_follow_the_definition():
    for text in [t for _, t in awkward()] + ["a", "A b", "É b C d", "x\x0by\x1cz w", "a b c\n\td  e a b c"]:
        assert fingerprint(text, 3) == brute_fingerprint(text)


def test_components_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(1000 + i, t) for i, t in awkward() if i is not None]
    ids, prints = [i for i, _ in rows], [brute_fingerprint(t) for _, t in rows]
    least = {}
    root = union_find(near_pairs(prints), range(len(rows)))
    for n, i in enumerate(ids):
        least[root[n]] = min(least.get(root[n], i), i)
    want = sorted((i, f"{p:016x}", least[root[n]]) for n, (i, p) in enumerate(zip(ids, prints)))
    df = documents(spark, rows).withColumn("fp", F.lit("clash"))
    for shard_rows in (20_000, 25):
        assert sorted(map(tuple, simhash_near_dups(df, shard_rows=shard_rows).collect())) == want


def test_null_ids_and_empty_table(spark):
    out = {(r.doc_id, r.component_id) for r in simhash_near_dups(documents(spark, [(None, "a b c d"), (7, "a b c d"), (None, "q r s t u")])).collect()}
    assert out == {(None, 7), (7, 7), (None, None)}
    assert simhash_near_dups(documents(spark, [])).collect() == []


def test_dense_clusters_lose_no_link(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 12).astype(np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, (12, 150)).astype(np.uint64) for _ in range(3)]
    prints = np.unique((base[:, None] ^ flips[0] ^ flips[1] ^ flips[2]).ravel())
    values = prints.view(np.int64).tolist()
    root = union_find(near_pairs(prints), range(len(values)))
    want = {}
    for n, v in enumerate(values):
        want.setdefault(root[n], set()).add(v)
    edges = near_links(spark.createDataFrame(pd.DataFrame({"fp": values})), 3, 60, 4096)
    assert edges.count() < 20 * len(values)
    got = {}
    found = {r.node: r.root for r in components(edges).collect()}
    for v in values:
        got.setdefault(found.get(v, v), set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert all(r == min(group) for r, group in got.items())


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(60)] + [(500, 500 + i) for i in range(1, 40)] + [(7, 7), (900, 901), (901, 900)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges for n in e}
    assert got == union_find(edges, nodes)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
