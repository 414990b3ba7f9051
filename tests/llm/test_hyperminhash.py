"""HyperMinHash near-duplicates against brute force over all pairs, and its parts."""

import random
import re

import duckdb
import numpy as np
import pytest

from kickwx.llm import hyperminhash
from kickwx.llm.hyperminhash import BUCKETS, EMPTY, _coincidence, estimate, lent, near_duplicates, registers, shingle_sets
from kickwx.llm.queries import op11_minhash_near_dups
from tests.llm.helpers import awkward, documents, union_find

COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


def sets_of(text, width=4):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {" ".join(words)} if len(words) < width else {" ".join(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute(rows):
    """Rows of (doc_id, text), ids not null and unique but for copies."""
    sets = {}
    for i, t in rows:
        sets.setdefault(frozenset(sets_of(t)), []).append(i)
    groups = [g for g in sets if g]
    by = {}
    for number, g in enumerate(groups):
        for x in g:
            by.setdefault(x, []).append(number)
    pairs = set()
    for i, g in enumerate(groups):
        seen = {}
        for x in g:
            for j in by[x]:
                if j < i:
                    seen[j] = seen.get(j, 0) + 1
        pairs |= {(i, j) for j, both in seen.items() if 100 * both >= 80 * (len(g) + len(groups[j]) - both)}
    roots = union_find(pairs, range(len(groups)))
    least = {}
    for i, g in enumerate(groups):
        least[roots[i]] = min([least.get(roots[i], 1 << 60), *sets[g]])
    out = []
    for i, g in enumerate(groups):
        out += [(d, len(g), least[roots[i]], d == least[roots[i]]) for d in sets[g]]
    return sorted(out + [(d, 0, d, True) for d in sets.get(frozenset(), [])])


def collected(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def families(seed=1):
    """Texts of all lengths with edits that straddle the threshold; some families have no near centre."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for size in (1, 2, 3, 4, 5, 6, 8, 10, 15, 25, 60, 150, 400, 1500):
        for _ in range(6):
            base = [rng.choice(words) for _ in range(size)]
            texts.append(base)
            for _ in range(6):
                one = list(base)
                for _ in range(rng.randint(0, max(1, size // 18))):
                    at = rng.randrange(len(one))
                    kind = rng.random()
                    if kind < 0.5:
                        one[at] = rng.choice(words)
                    elif kind < 0.75 and len(one) > 1:
                        del one[at]
                    else:
                        one.insert(at, rng.choice(words))
                texts.append(one)
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts, 1)]


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    assert collected(op11_minhash_near_dups(spark, sf)) == brute(rows)


@pytest.mark.parametrize("block", [4, 512])
def test_families_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hyperminhash, "BLOCK", block)
    monkeypatch.setattr(hyperminhash, "GATHERED", 64)
    rows = families(block)
    assert collected(near_duplicates(documents(spark, rows).repartition(5))) == brute(rows)


def test_hot_family(spark, monkeypatch):
    """One cluster of 1,500 different edits of a text with a large id, strangers that share much of it, and a chain."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]

    def edited(text, times):
        one = list(text)
        for at in rng.sample(range(len(one)), times):
            one[at] = f"x{rng.randrange(10**6)}"
        return one

    texts = [edited(base, 5) for _ in range(1500)] + [edited(base, 12) for _ in range(40)]
    step = base
    for _ in range(12):
        step = edited(step, 3)
        texts.append(step)
    rows = [(i, " ".join(t)) for i, t in enumerate([*texts, base], 1)]
    monkeypatch.setattr(hyperminhash, "BLOCK", 200)
    assert collected(near_duplicates(documents(spark, rows))) == brute(rows)


def test_defined_cases(spark):
    table = documents(spark, awkward()).withColumnsRenamed({"lang": "node", "source": "own", "n_chars": "row"})
    got = near_duplicates(table).collect()
    assert len(got) == len(awkward())
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[1] == [(2, 1, True)] and by[2] == [(2, 1, False)] * 2 and sorted(by[None], key=str) == [(0, None, True), (2, 1, False)]
    assert by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)] and by[5] == [(0, 5, True)]
    assert [by[i][0][1:] for i in (6, 7, 8)] == [(6, True), (6, False), (6, False)]
    assert sorted(by[12]) == [(1, 12, True)] * 2
    assert near_duplicates(table.filter("false")).count() == 0
    assert near_duplicates(table.filter("doc_id IN (3, 4, 5)")).count() == 3


def test_registers_estimate_similarity():
    rng = np.random.default_rng(2)
    for size in (40, 1000, 20_000):
        errors, chance = [], []
        for _ in range(30):
            pool = rng.integers(0, 2**64, 2 * size, np.uint64)
            one, two = np.unique(pool[:size]), np.unique(np.r_[pool[size // 10:size], pool[size:size + size // 10]])
            truth = 0.9 / 1.1
            errors.append(estimate(registers(one), registers(two), size, size)[0] - truth)
            a, b = registers(one), registers(np.unique(pool[size:]))
            chance.append(((a == b) & (a != EMPTY)).mean())
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06
        half = round(2 * np.log2(size))
        assert abs(np.mean(chance) - _coincidence(half, half)) < 0.002


def test_empty_registers_are_lent():
    rng = np.random.default_rng(6)
    for size in (1, 3, 30, 300):
        own = registers(np.unique(rng.integers(0, 2**64, size, np.uint64)))
        full = lent(own)
        assert (full != EMPTY).all() and (full[own != EMPTY] == own[own != EMPTY]).all()
    assert (lent(np.full(BUCKETS, EMPTY, np.uint16)) == EMPTY).all()
    assert [len(x) for x in shingle_sets([b"", b"A b", b"a B", b"a b c d e", b" "], 4)] == [0, 1, 1, 2, 0]
