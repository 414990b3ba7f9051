"""As-of selection of the weather observations around each kick-off.

For every match the reference keeps
  * the observation nearest to kick-off (ties go to the earlier one),
  * the first observation at or after kick-off,
  * the second one at or after kick-off, when kick-off is on the full hour,
and drops the rest. A match may keep one, two or three observations.

Five plans compute this, and ``guarded`` joins two of them. Which one suits is a property of the weather source, not of its size: ``guarded``
for a source that should deliver every full hour of the kick-off date, ``window`` (the default) for any other.

``guarded`` (exact on any data): ``grid`` for the matches whose observations it is exact for, ``window`` for the others.
:func:`irregular_matches` finds them from one small row per match (see ``staging.kickoff_weather``).

``window`` (exact on any data): one window partitioned by match and
ordered by time. All three picks sit next to kick-off in time order, so
``lag``/``lead`` over the single sort find them; no per-row ranks, no second
sort. Shuffles: one, on the match id (shared with the version choice and the join to the fixtures).

``grid`` (exact when each match's observations are the full hours of the
kick-off date, which is what the hourly payload delivers): the three
candidate hours are arithmetic on the kick-off, so the selection is an
equi-join on the match whose rows stay if their time is among its candidate hours. The one row per
match is hashed, the observations stream past it: no sort. A match whose
observations are not on that grid keeps none of them here.

``topk`` (exact on any data): each pick is a per-match
top-k (``row_number() <= k``); the rows are exchanged on the match first and joined once per pick.

``aggregate`` (exact on any data, no per-match sort): hash aggregates pick
the times, a join on the match picks the rows that have one of them.

``ranks``: the reference's two ``row_number`` rankings, for cross-checks.

Kick-offs after the last observation have no "after" pick (``strict``); the
reference's sentinel would admit an arbitrary row instead, which
``strict=False`` mimics with the earliest rows (``window`` only; the others refuse it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kickwx.functions.casts import start_of_hour

DEFAULT_WEATHER_METHOD = "window"

# There is one kick-off per match and their number grows with the input, while the planner sees the size of compressed,
# column-pruned files and would broadcast millions of them: joins to them are hinted to go over a shuffle.

EVENT = "event_id"
TS = "weather_datetime"
KO = "match_datetime"


def _secs(a: Column, b: Column) -> Column:
    return F.timestamp_diff("SECOND", a, b)


def is_full_hour(ko: Column) -> Column:
    return ko == start_of_hour(ko)


def with_kickoff(weather: DataFrame, kickoffs: DataFrame, how: str = "merge") -> DataFrame:
    """Observations with the kick-off (and what else its row has) of their match."""
    return weather.join(kickoffs.hint(how), EVENT, "inner")


def select_window(weather: DataFrame, kickoffs: DataFrame, strict: bool = True) -> DataFrame:
    """Observations kept per match, via one time-ordered window (see module doc)."""
    j = with_kickoff(weather, kickoffs.select(EVENT, KO))
    ts, ko = F.col(TS), F.col(KO)
    w = Window.partitionBy(EVENT).orderBy(TS)
    prev1, prev2, next1 = F.lag(TS, 1).over(w), F.lag(TS, 2).over(w), F.lead(TS, 1).over(w)
    extra = [] if strict else [F.max(TS).over(Window.partitionBy(EVENT)).alias("__last")]
    j = j.select("*", prev1.alias("__p1"), prev2.alias("__p2"), next1.alias("__n1"), *extra)
    p1, p2, n1 = F.col("__p1"), F.col("__p2"), F.col("__n1")

    first_after = (ts >= ko) & (p1.isNull() | (p1 < ko))
    second_after = is_full_hour(ko) & (p1 >= ko) & (p2.isNull() | (p2 < ko))
    last_before = (ts < ko) & (n1.isNull() | (n1 >= ko))
    nearest_before = last_before & (n1.isNull() | (_secs(ts, ko) <= _secs(ko, n1)))
    nearest_after = first_after & (p1.isNull() | (_secs(ko, ts) < _secs(p1, ko)))
    keep = nearest_before | nearest_after | first_after | second_after
    if not strict:
        # no observation at/after kick-off: every row ties on the sentinel; take the earliest (and next)
        none_after = F.col("__last") < ko
        keep = keep | (none_after & (p1.isNull() | (is_full_hour(ko) & p2.isNull())))
    return j.filter(keep).drop("__p1", "__p2", "__n1", "__last")


def select_ranks(weather: DataFrame, kickoffs: DataFrame) -> DataFrame:
    """The reference's literal form: two ``row_number`` rankings per match, then the rank filter.

    Ranks by distance to kick-off (ties to the earlier time) and by "first
    at/after kick-off" (later rows first, guard on). Two sorts of each
    match's rows; kept for cross-checking the one-sort ``window`` form.
    """
    j = with_kickoff(weather, kickoffs.select(EVENT, KO))
    ts, ko = F.col(TS), F.col(KO)
    by_distance = Window.partitionBy(EVENT).orderBy(F.abs(_secs(ko, ts)), ts)
    by_after = Window.partitionBy(EVENT).orderBy(F.when(ts >= ko, ts).asc_nulls_last(), ts)
    r = j.select("*", F.row_number().over(by_distance).alias("__c"), F.row_number().over(by_after).alias("__a"))
    c, a, after = F.col("__c"), F.col("__a"), ts >= ko
    keep = (c == 1) | ((a == 1) & after) | (is_full_hour(ko) & (a == 2) & after)
    return r.filter(keep).drop("__c", "__a")


def grid_hours(ko: Column) -> Column:
    """The <= 3 grid hours of a kick-off, as an array."""
    day_start = F.make_timestamp_ntz(F.year(ko), F.month(ko), F.dayofmonth(ko), F.lit(0), F.lit(0), F.lit(0))
    last_hour = F.timestamp_add("HOUR", F.lit(23), day_start)
    nearest = F.least(start_of_hour(F.timestamp_add("SECOND", F.lit(1799), ko)), last_hour)
    first_after = start_of_hour(F.timestamp_add("SECOND", F.lit(3599), ko))
    second_after = F.when(is_full_hour(ko), F.timestamp_add("HOUR", F.lit(1), ko))
    in_day = lambda t: F.when(t <= last_hour, t)
    return F.array_distinct(F.filter(
        F.array(nearest, in_day(first_after), in_day(second_after)), lambda t: t.isNotNull()))


def candidate_hours(kickoffs: DataFrame) -> DataFrame:
    """(event_id, match_datetime, weather_datetime) for the <= 3 grid hours of each kick-off."""
    return kickoffs.select(EVENT, KO, F.explode(grid_hours(F.col(KO))).alias(TS))


def select_grid(weather: DataFrame, kickoffs: DataFrame) -> DataFrame:
    """Observations kept per match: those at a candidate hour of its kick-off (see module doc)."""
    hours = kickoffs.select(EVENT, KO, grid_hours(F.col(KO)).alias("__hours"))
    return with_kickoff(weather, hours, "shuffle_hash").filter(F.array_contains("__hours", F.col(TS))).drop("__hours")


def irregular_matches(weather: DataFrame, kickoffs: DataFrame) -> DataFrame:
    """Ids of the matches for which the grid form is not exact: an observation off the full hours of the kick-off
    date, or a candidate hour without one.

    A match's observations shrink to the set of their hours, as bits, and whether any is off the grid; both are combined map-side, so
    a match leaves each task as one row whatever it holds. Repeated versions of an observation change nothing.
    """
    seen = weather.groupBy(EVENT).agg(
        F.expr(f"bit_or(shiftleft(1, hour({TS})))").alias("__hours"),
        F.max(F.date_trunc("hour", TS).cast("timestamp_ntz") != F.col(TS)).alias("__off"),
        F.min(F.to_date(TS)).alias("__first"),
        F.max(F.to_date(TS)).alias("__last"),
    )
    wanted = candidate_hours(kickoffs).groupBy(EVENT).agg(
        F.expr(f"bit_or(shiftleft(1, hour({TS})))").alias("__wanted"), F.min(F.to_date(KO)).alias("__day"))
    whole = (
        ~F.col("__off") & (F.col("__first") == F.col("__day")) & (F.col("__last") == F.col("__day"))
        & (F.col("__hours").bitwiseAND(F.col("__wanted")) == F.col("__wanted"))
    )
    return seen.join(wanted.hint("merge"), EVENT).filter(~F.coalesce(whole, F.lit(False))).select(EVENT)


MARKS = 32_768  # bits of one bitmap


def may_be_among(ids: DataFrame, column: str = EVENT) -> Column:
    """Whether a row's id may be in ``ids``, by one bitmap of 4 KB: a scalar subquery, so that the filter runs in the scan, before any exchange.

    Never false for an id in ``ids``; true for others by chance, so an exact join has to follow. With
    far more ids than bits it lets everything through.
    """
    place = F.pmod(F.xxhash64(F.col(column)), F.lit(MARKS))
    bitmap = ids.select(F.expr(f"bitmap_construct_agg(pmod(xxhash64({column}), {MARKS}))").alias("bits")).scalar()
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))), F.lit(2)) == 1


def select_aggregate(weather: DataFrame, kickoffs: DataFrame) -> DataFrame:
    """Exact selection without any per-match sort, for sources where one match may hold many rows.

    1. per match, as hash aggregates (combined map-side, so a hot match leaves
       each task as one row): last observation before kick-off, first at or
       after it;
    2. per full-hour match: first observation after that first one (a second
       aggregate over the rows after it);
    3. the <= 3 chosen times per match, as an array, select the rows: joined on the match id, on which
       both sides lie already, so the observations are not exchanged again.
    The joins on the match id are the kind AQE splits when one side is skewed. Rows without a time, which are never chosen,
    go first: else the planner drops them from one of the three readings alone, and these no longer share an exchange.
    """
    ts, ko = F.col(TS), F.col(KO)
    j = with_kickoff(weather, kickoffs.select(EVENT, KO)).filter(ts.isNotNull())
    s1 = j.groupBy(EVENT).agg(
        F.max(F.when(ts < ko, ts)).alias("__lb"),
        F.min(F.when(ts >= ko, ts)).alias("__a1"),
    )
    # one more pass carries the first picks along and finds the second "after" time
    c = j.join(s1.hint("merge"), EVENT, "inner").groupBy(EVENT).agg(
        F.max("__lb").alias("__lb"),
        F.max("__a1").alias("__a1"),
        F.max(ko).alias("__ko"),
        F.min(F.when(is_full_hour(ko) & (ts > F.col("__a1")), ts)).alias("__a2"),
    )
    lb, a1, k = F.col("__lb"), F.col("__a1"), F.col("__ko")
    nearest = (
        F.when(lb.isNull(), a1).when(a1.isNull(), lb)
        .when(_secs(lb, k) <= _secs(k, a1), lb).otherwise(a1)
    )
    picks = F.array_distinct(F.filter(F.array(nearest, a1, F.col("__a2")), lambda t: t.isNotNull()))
    chosen = c.select(EVENT, picks.alias("__picks"))
    return j.join(chosen.hint("merge"), EVENT, "inner").filter(F.array_contains("__picks", ts)).drop("__picks")


def select_topk(weather: DataFrame, kickoffs: DataFrame) -> DataFrame:
    """Exact selection as per-match top-k picks, each cut down before its shuffle.

    * first two observations at/after kick-off: ``row_number() <= 2`` by time;
    * last observation before kick-off: ``row_number() = 1`` by time descending;
    * nearest: the closer of that last-before row and the first-after row
      (ties to the earlier), decided by a join on the match id.
    Each rank filter plans a partial ``WindowGroupLimit`` ahead of the
    exchange, so a map task forwards at most two (or one) rows per match: the
    shuffle carries ~3 rows per match, not all of them, and a match holding a
    large share of the rows is reduced map-side.
    """
    j = with_kickoff(weather, kickoffs.select(EVENT, KO))
    ts, ko = F.col(TS), F.col(KO)
    r = F.col("__r")
    by_time = Window.partitionBy(EVENT).orderBy(ts.asc())
    by_time_desc = Window.partitionBy(EVENT).orderBy(ts.desc())
    after = j.filter(ts >= ko).withColumn("__r", F.row_number().over(by_time)).filter(r <= 2)
    after = after.filter((r == 1) | is_full_hour(ko))
    before = j.filter(ts < ko).withColumn("__r", F.row_number().over(by_time_desc)).filter(r == 1)
    # the last-before row is kept when no first-after row exists or it is at least as close
    # (a join on the match id, so both sides are co-partitioned by the planner)
    first_after = after.filter(r == 1).select(EVENT, F.col(TS).alias("__a1"))
    a1 = F.col("__a1")
    nearest_before = before.join(first_after.hint("merge"), EVENT, "left").filter(
        a1.isNull() | (_secs(ts, ko) <= _secs(ko, a1))).drop("__a1")
    # The union may report its inputs' hash partitioning while AQE coalesced them
    # differently; an explicit exchange of these few rows (<= 3 per match) gives the
    # downstream per-match work a real partitioning on the match id.
    return after.unionByName(nearest_before).drop("__r").repartition(EVENT)


def union_of_picks(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both sets of picks, a few rows per match, with a real partitioning on the match (see :func:`select_topk`)."""
    return first.unionByName(second).repartition(EVENT)


def select_kickoff_weather(weather: DataFrame, kickoffs: DataFrame, method: str = "window",
                           strict: bool = True) -> DataFrame:
    if method == "window":
        return select_window(weather, kickoffs, strict=strict)
    if not strict:
        raise ValueError(f"method {method!r} has no strict=False form")
    if method == "grid":
        return select_grid(weather, kickoffs)
    if method == "ranks":
        return select_ranks(weather, kickoffs)
    if method == "aggregate":
        return select_aggregate(weather, kickoffs)
    if method == "topk":
        return select_topk(weather, kickoffs)
    if method == "guarded":
        odd = irregular_matches(weather, kickoffs)
        rest = weather.filter(may_be_among(odd)).join(odd, EVENT, "left_semi")
        return union_of_picks(select_grid(weather, kickoffs.join(odd, EVENT, "left_anti")), select_window(rest, kickoffs))
    raise ValueError(f"unknown method {method!r}")
