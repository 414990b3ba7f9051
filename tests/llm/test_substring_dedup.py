import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kickwx.llm.substring_dedup import compact_windows, coverable, earlier, matched_spans, rare_prefixes, repeated_passages, shingles, sliding_argmin
from tests.llm.helpers import awkward, documents


def words(rnd, n):
    return ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 12))) for _ in range(n)]


def test_shingle_hashes_tell_shingles_apart():
    rnd = random.Random(0)
    texts = [" ".join(rnd.choice(["alpha", "b", "gammagammagamma", "x", "Delta"]) for _ in range(n)).encode() for n in (0, 3, 5, 7, 300)]
    texts += [b"", b"  a \n b  ", b"a b\x0bc\td  e", b"abcdefgh ijklmnop qrstuvwx yzabcdef ghijklmn"]
    hashed, owner, counts = shingles(texts, 5)
    names, at = {}, 0
    for k, text in enumerate(texts):
        own = text.lower().split()
        assert counts[k] == len(own)
        for j in range(len(own) - 4):
            assert owner[at] == k and names.setdefault(tuple(own[j:j + 5]), hashed[at]) == hashed[at]
            at += 1
    assert at == len(hashed) and len(set(names.values())) == len(names)


@pytest.mark.parametrize("width", [2, 7, 10])
def test_compact_windows_are_the_wide_nodes_of_the_cartesian_trees(width):
    values = np.random.default_rng(width).integers(0, 2**63, 300).astype(np.uint64)
    owner = np.repeat([0, 1, 2], [100, 5, 195])
    want = []

    def tree(a, b):
        if b - a + 1 >= width:
            c = a + int(np.argmin(values[a:b + 1]))
            want.append((a, c, b))
            tree(a, c - 1)
            tree(c + 1, b)

    for a, b in ((0, 99), (100, 104), (105, 299)):
        tree(a, b)
    assert sorted(zip(*(x.tolist() for x in compact_windows(values, owner, width)))) == sorted(want)
    assert sliding_argmin(values, width).tolist() == [i + int(np.argmin(values[i:i + width])) for i in range(301 - width)]


def test_every_verbatim_passage_is_covered(spark):
    rnd = random.Random(1)
    passages = [words(rnd, n) for n in (50, 51, 70, 120, 49, 20)]
    rows = []
    for i in range(60):
        text = words(rnd, rnd.randint(0, 150))
        for p in rnd.sample(passages, rnd.randint(0, 2)):
            text += p + words(rnd, rnd.randint(5, 80))
        rows.append((i, (" " if i % 2 else "\n").join(text)))
    rows += [(100 + i, t) for i, t in awkward() if i is not None]
    df = documents(spark, rows).withColumns({"sig": F.lit(1), "first": F.lit(2), "text_key": F.lit(3)})
    got = repeated_passages(df).collect()
    texts = dict(rows)
    cover = {}
    for r in got:
        assert r.keep_id < r.doc_id and r.similarity >= 0.8 and r.n_words >= 50
        mine = texts[r.doc_id].split()[r.first_word:r.first_word + r.n_words]
        assert texts[r.doc_id][r.first_char:r.first_char + r.n_chars].split() == mine
        cover.setdefault(r.doc_id, []).append((r.first_word, r.first_word + r.n_words))
    first = {}
    for i, t in sorted(texts.items()):
        own = (t or "").lower().split()
        for j in range(len(own) - 49):
            holder = first.setdefault(tuple(own[j:j + 50]), i)
            if holder != i and texts[holder] != t:
                assert any(a <= j and j + 50 <= b for a, b in cover.get(i, [])), (i, j)
    clean = {i for i in range(60) if all(" ".join(p) not in " ".join((texts[i] or "").split()) for p in passages[:5])}
    assert not clean & set(cover) and not {r.keep_id for r in got} & clean
    assert (108, 106, 0) in {(r.doc_id, r.keep_id, r.first_char) for r in got}  # a copy, whole


def test_near_repeats_and_many_copies(spark):
    rnd = random.Random(3)
    base = words(rnd, 400)
    rows = []
    for i in range(40):
        own = list(base)
        for _ in range(3):
            own[rnd.randrange(400)] = "edited"
        rows.append((i, " ".join(words(rnd, 30) + own)))
    rows += [(50 + i, " ".join(base)) for i in range(30)] + [(90, " ".join(words(rnd, 300)))]
    got = repeated_passages(documents(spark, rows)).collect()
    assert {r.doc_id for r in got} == {i for i, _ in rows} - {0, 90}
    assert len(got) < 40 * 30  # links to one document each, not all pairs


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = " ".join(words(random.Random(5), 60))
    got = repeated_passages(documents(spark, [(None, text), (3, text), (3, text), (4, None)])).collect()
    assert [(r.doc_id, r.keep_id, r.n_words) for r in got] == [(3, None, 60)]
    assert repeated_passages(documents(spark, [])).collect() == []
    assert repeated_passages(documents(spark, [(3, text), (3, text)])).collect() == []


def test_matched_spans_handle_scattered_shingles():
    rng = np.random.default_rng(0)
    theirs = rng.permutation(400).astype(np.uint64)
    mine = np.concatenate((theirs[300:], theirs[:100], np.arange(1000, 1100, dtype=np.uint64)))
    found, failed = matched_spans(mine, theirs, [(0, 5, 300), (100, 101, 0), (230, 231, 5)], 46, 5, 0.8)
    assert {(a, b, c, d) for a, b, c, d, _ in found} == {(0, 100, 300, 400), (100, 200, 0, 100)}
    assert failed == [(230, 231)]


def test_one_word_edits_in_short_passages_are_found(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(220):
        passage = words(rnd, 50 + i % 11)
        edited = list(passage)
        edited[rnd.randrange(len(edited))] = "edited"
        rows += [(2 * i, " ".join(words(rnd, 40) + passage + words(rnd, 40))), (2 * i + 1, " ".join(words(rnd, 40) + edited + words(rnd, 40)))]
    got = {(r.doc_id, r.keep_id) for r in repeated_passages(documents(spark, rows)).collect()}
    assert got <= {(2 * i + 1, 2 * i) for i in range(220)} and len(got) >= 0.95 * 220


def test_verbatim_passages_meet_behind_many_variants(spark):
    rnd, rows = random.Random(13), []
    for place in range(6):
        base = words(rnd, 50)
        for i in range(40):  # two neighbouring words edited: similarity 0.77 to the template, less to each other
            own, at = list(base), rnd.randrange(5, 44)
            own[at:at + 2] = [f"variant{i}", f"x{at}"]
            rows.append((100 * place + i, " ".join(words(rnd, 20) + own + words(rnd, 20))))
        rows += [(100 * place + 90 + i, " ".join(words(rnd, 20) + base + words(rnd, 20))) for i in range(2)]
    got = {(r.doc_id, r.keep_id) for r in repeated_passages(documents(spark, rows)).collect()}
    assert {(100 * place + 91, 100 * place + 90) for place in range(6)} <= got


def test_near_repeats_meet_behind_many_variants(spark):
    rnd, rows = random.Random(17), []
    for place in range(4):
        base = words(rnd, 50)
        for i in range(40):  # similar to the template and to each other, but not enough
            own, at = list(base), rnd.randrange(5, 44)
            own[at:at + 2] = [f"variant{i}", f"x{at}"]
            rows.append((100 * place + i, " ".join(words(rnd, 20) + own + words(rnd, 20))))
        edited = [*base[:2], "edited", *base[3:]]
        rows += [(100 * place + 90 + i, " ".join(words(rnd, 20) + own + words(rnd, 20))) for i, own in enumerate((base, edited))]
    got = {(r.doc_id, r.keep_id) for r in repeated_passages(documents(spark, rows)).collect()}
    assert {(100 * place + 91, 100 * place + 90) for place in range(4)} <= got


def test_rare_prefixes_hold_a_shingle_of_every_similar_window(spark):
    rnd = random.Random(19)
    text = words(rnd, 50)
    hashed, _, _ = shingles([" ".join(text).encode()], 5)
    numbers = [(int(h), n) for n, h in enumerate(hashed.view(np.int64), 2)]
    schema = "text_key long, doc_id long, text string, spans array<struct<first:int,last:int>>, shared array<struct<h:long,n:long>>"
    table = spark.createDataFrame([(1, 5, " ".join(text), [(0, 0)], numbers), (2, 6, " ".join(text), [(0, 0)], numbers[:30]), (3, 7, " ".join(text), [(0, 0)], numbers[:31])], schema)
    got = [(r.doc_id, r.at) for r in rare_prefixes(table, 46, 5, 0.8).collect()]
    # 31 of 46 make a window similar: any 16 have one of them, none where only 30 are shared, the rarest where just 31 are
    assert sorted(got) == [(5, i) for i in range(16)] + [(7, 0)]


def test_matched_spans_choose_the_occurrence_in_line():
    rng = np.random.default_rng(1)
    passage, rest = rng.permutation(46).astype(np.uint64), rng.permutation(np.arange(100, 900)).astype(np.uint64)
    theirs = np.concatenate((rest[:60], passage[20:31], rest[60:75], passage, rest[75:200]))  # part of it also 46 shingles earlier
    mine = np.concatenate((rest[300:360], passage, rest[400:460]))
    found, failed = matched_spans(mine, theirs, [(52, 60, 85)], 46, 5, 0.8)  # the seed's starts are seven shingles out of line
    assert [(a, b, c, d) for a, b, c, d, _ in found] == [(60, 106, 86, 132)] and not failed


def test_matched_spans_compare_edited_windows_in_line():
    shared = np.arange(1, 43, dtype=np.uint64)
    mine, theirs = (np.concatenate((np.arange(60) + n, shared, np.arange(60) + n + 100)).astype(np.uint64) for n in (1000, 2000))
    found, failed = matched_spans(mine, theirs, [(50, 62, 59)], 46, 5, 0.8)  # 42 shingles of 46: 42 / 50
    assert len(found) == 1 and found[0][4] >= 0.8 and not failed


def test_seeds_too_late_for_a_window_are_compared_within_the_texts():
    mine = np.arange(1000, 1116, dtype=np.uint64)
    assert matched_spans(mine, np.tile(mine[108:], 6), [(108, 112, 0)], 46, 5, 0.8) == ([], [(70, 70)])  # no eight shingles, as often as they come
    theirs = np.concatenate((mine[70:115], np.arange(3000, 3010, dtype=np.uint64)))
    found, failed = matched_spans(mine, theirs, [(108, 113, 38)], 46, 5, 0.8)
    assert [(a, b, c, d) for a, b, c, d, _ in found] == [(70, 116, 0, 46)] and not failed  # 45 shingles of 46
    assert matched_spans(mine[:20], theirs, [(3, 5, 0)], 46, 5, 0.8) == ([], [(3, 5)])


def test_rest_compares_places_at_the_end_of_a_text(spark):
    rnd, rows = random.Random(23), []
    for place in range(4):
        base = words(rnd, 50)
        for i in range(40):  # similar to the template and to each other, but not enough; at the end of a text
            own, at = list(base), rnd.randrange(5, 44)
            own[at:at + 2] = [f"variant{i}", f"x{at}"]
            rows.append((100 * place + i, " ".join(words(rnd, 20 * (i % 2)) + own + base[10:24] * (i % 3))))
        edited = [*base[:2], "edited", *base[3:]]
        rows += [(100 * place + 90 + i, " ".join(words(rnd, 20) + own)) for i, own in enumerate((base, edited))]
    texts = dict(rows)
    got = repeated_passages(documents(spark, rows)).collect()
    for r in got:
        assert r.similarity >= 0.8 and 50 <= r.n_words <= len(texts[r.doc_id].split()) - r.first_word and r.keep_first_word + r.keep_n_words <= len(texts[r.keep_id].split())
    assert {(100 * place + 91, 100 * place + 90) for place in range(4)} <= {(r.doc_id, r.keep_id) for r in got}


def test_coverable_holds_every_span_with_enough_distinct_hits():
    rng = np.random.default_rng(2)
    for n in range(150):
        values = np.repeat(rng.integers(0, 30, 40), rng.integers(1, 1 + n % 5 + 1, 40))[:60]
        hit, width = (rng.random(30) < 0.7)[values], int(rng.integers(2, 12))
        got, want = coverable(hit, earlier(values), width, 0.8), np.zeros(len(values), bool)
        for a in range(len(values)):
            for b in range(a + width, len(values) + 1):
                distinct = dict(zip(values[a:b].tolist(), hit[a:b].tolist()))
                if sum(distinct.values()) >= 0.8 * len(distinct):
                    want[a:b] = True
        assert got[want].all()
    noise = np.repeat(np.arange(20), 10)  # a long run alone is no passage
    assert not coverable(noise == 3, earlier(noise), 46, 0.8).any()
