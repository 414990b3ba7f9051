"""As-of weather selection: hand-worked goldens and a brute-force check of the rank rules."""

import random
from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from kickwx.operators.asof import irregular_matches, may_be_among, select_aggregate, select_grid, select_kickoff_weather, select_topk, select_window

DAY = datetime(2001, 5, 6)


def frames(spark, obs, kicks):
    w = spark.createDataFrame(obs, "event_id int, weather_datetime timestamp_ntz, v double")
    k = spark.createDataFrame(kicks, "event_id int, match_datetime timestamp_ntz")
    return w, k


def kept(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["event_id"], set()).add(r["weather_datetime"])
    return out


GOLDEN = [  # kick-off (h, m) -> hours kept (hourly data 00:00-23:00 of the match date)
    ((15, 0), {15, 16}),
    ((15, 10), {15, 16}),
    ((15, 30), {15, 16}),
    ((15, 45), {16}),
    ((23, 0), {23}),
    ((23, 30), {23}),
    ((23, 45), {23}),
    ((0, 0), {0, 1}),
]


@pytest.mark.parametrize("method", ["window", "grid", "aggregate", "topk", "guarded"])
def test_golden_hours(spark, method):
    obs, kicks = [], []
    for i, ((h, m), _) in enumerate(GOLDEN):
        kicks.append((i, DAY.replace(hour=h, minute=m)))
        obs += [(i, DAY + timedelta(hours=x), float(x)) for x in range(24)]
    w, k = frames(spark, obs, kicks)
    got = kept(select_kickoff_weather(w, k, method=method))
    for i, (_, hours) in enumerate(GOLDEN):
        assert {t.hour for t in got[i]} == hours, GOLDEN[i]


def brute_force(obs, ko, strict=True):
    """The reference's rule: closest_rank = 1 OR after_rank = 1 OR (full hour AND after_rank = 2)."""
    ts = sorted(obs)
    closest = min(ts, key=lambda t: (abs((t - ko).total_seconds()), t))
    after = [t for t in ts if t >= ko]
    if not after and not strict:
        after = ts
    keep = {closest}
    if after:
        keep.add(after[0])
    full = ko.minute == 0 and ko.second == 0
    if full and len(after) > 1:
        keep.add(after[1])
    return keep


def test_only_the_window_form_takes_strict_false(spark):
    w, k = frames(spark, [(1, DAY, 0.0)], [(1, DAY)])
    for method in ("grid", "ranks", "aggregate", "topk", "guarded"):
        with pytest.raises(ValueError):
            select_kickoff_weather(w, k, method=method, strict=False)


@pytest.mark.parametrize("strict", [True, False])
def test_window_matches_brute_force_on_irregular_data(spark, strict):
    rnd = random.Random(7)
    obs, kicks, expect = [], [], {}
    for e in range(300):
        n = rnd.randint(1, 12)
        base = DAY + timedelta(minutes=rnd.randint(0, 600))
        times = sorted({base + timedelta(minutes=rnd.choice([0, 15, 30, 45, 60]) * rnd.randint(0, 20))
                        for _ in range(n)})
        ko = DAY + timedelta(minutes=15 * rnd.randint(0, 96))
        if e % 5 == 0:
            ko = times[0] + (times[-1] - times[0]) / 2  # between two observations
            ko = ko.replace(second=0, microsecond=0)
        kicks.append((e, ko))
        obs += [(e, t, 1.0) for t in times]
        expect[e] = brute_force(times, ko, strict)
    w, k = frames(spark, obs, kicks)
    got = kept(select_window(w, k, strict=strict))
    assert got == expect


def test_window_equals_grid_on_full_hourly_grid(spark):
    rnd = random.Random(3)
    obs, kicks = [], []
    for e in range(200):
        kicks.append((e, DAY + timedelta(minutes=rnd.randint(0, 24 * 60 - 1), seconds=rnd.choice([0, 0, 30]))))
        obs += [(e, DAY + timedelta(hours=h), 0.0) for h in range(24)]
    w, k = frames(spark, obs, kicks)
    assert kept(select_window(w, k)) == kept(select_grid(w, k))


@pytest.mark.parametrize("fn", [select_aggregate, select_topk])
def test_skew_safe_forms_match_brute_force(spark, fn):
    rnd = random.Random(19)
    obs, kicks, expect = [], [], {}
    for e in range(300):
        base = DAY + timedelta(minutes=rnd.randint(0, 600))
        times = sorted({base + timedelta(minutes=rnd.choice([0, 15, 30, 45, 60]) * rnd.randint(0, 20))
                        for _ in range(rnd.randint(1, 12))})
        ko = DAY + timedelta(minutes=15 * rnd.randint(0, 96))
        kicks.append((e, ko))
        obs += [(e, t, 1.0) for t in times]
        expect[e] = brute_force(times, ko)
    # one hot match with many rows
    hot = [DAY + timedelta(minutes=m) for m in range(0, 20000, 7)]
    kicks.append((999, DAY + timedelta(hours=100)))
    obs += [(999, t, 1.0) for t in hot]
    expect[999] = brute_force(hot, DAY + timedelta(hours=100))
    w, k = frames(spark, obs, kicks)
    assert kept(fn(w, k)) == expect


def payloads(seed):
    """Full days, half-hour series, part days, shifted hours, days around the kick-off's, single odd observations, repeated rows."""
    rnd = random.Random(seed)
    obs, kicks, expect = [], [], {}
    for e in range(400):
        ko = DAY + timedelta(minutes=rnd.choice([0, 15, 30, 45]) + 60 * rnd.randint(0, 23), seconds=rnd.choice([0, 0, 30]))
        hours = [DAY + timedelta(hours=h) for h in range(24)]
        times = [
            hours, [t + timedelta(minutes=30) for t in hours], [DAY + timedelta(minutes=30 * i) for i in range(48)], hours[: rnd.randint(1, 24)],
            hours[rnd.randint(0, 23):], [DAY + timedelta(hours=h) for h in range(-24, 48)], [*hours, ko + timedelta(seconds=7)], rnd.sample(hours, 9),
        ][e % 8 if e % 3 else 0]
        kicks.append((e, ko))
        obs += [(e, t, 0.0) for t in [*times, *times[:2]]]
        expect[e] = brute_force(times, ko)
    kicks += [(1000, None), (1001, DAY)]
    obs.append((1000, DAY, 0.0))
    return obs, kicks, expect


def test_guarded_form_matches_brute_force_on_any_payload(spark):
    obs, kicks, expect = payloads(5)
    w, k = frames(spark, obs, kicks)
    one = w.distinct()  # the selections take one version of each observation
    assert kept(select_kickoff_weather(one, k, method="guarded")) == expect
    odd = {r[0] for r in irregular_matches(w, k).collect()}
    assert kept(select_grid(one, k.filter(~F.col("event_id").isin(odd)))) == {e: t for e, t in expect.items() if e not in odd}
    assert 50 < len(odd) < 350


def test_bitmap_never_misses(spark):
    ids = spark.range(0, 3000, 7).select(F.col("id").alias("event_id"))
    all_ = spark.range(3000).select(F.col("id").alias("event_id"))
    through = {r[0] for r in all_.filter(may_be_among(ids)).collect()}
    assert through >= set(range(0, 3000, 7)) and len(through) < 600
    assert all_.filter(may_be_among(ids.filter("false"))).count() == 0
