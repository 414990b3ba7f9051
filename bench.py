"""Benchmark: build the marts from the test tables, then run the headline queries on them.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_WARMUP_DIR (default /root/testdata/sf0.001). Prints one JSON line.

Timings are steady-state: the same build and a few queries run first over the
warm-up tables (other data, so nothing timed is cached).
  bronze_load   writes the stand-in bronze tables derived from the test tables
                (input generation; reported, not in the headline value)
  marts_build   dedup, the as-of weather selection, dimensions and fact, each
                written as a catalog table from bronze, fact and weather dimension
                bucketed on the match
  weather_unnest  the hourly unnest of the payloads alone (part of bronze_load)
  <query>       each question run against the written marts, as analysts query
                the published tables
  weather_<f>   the weather selection alone in each form (window, grid,
                aggregate, topk); a step already inside marts_build, reported only
The headline value is marts_build plus all queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kickwx.plans import analytics as A  # noqa: E402
from kickwx.plans import legacy as L  # noqa: E402
from kickwx.plans.registry import DASHBOARD_COUNTRY, FOCUS_TEAM, MATCH_TEAMS  # noqa: E402
from kickwx.plans.warehouse import (  # noqa: E402
    PAYLOAD_WEATHER_METHOD, bronze_from_tables, materialize_tables, read_bronze, read_tables, write_bronze)
from kickwx.session import build_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return round(time.perf_counter() - t, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", max(8, 2 * cpus), app="kickwx-bench")
    times: dict[str, float] = {}

    # warm-up: JIT and codegen on the same code paths, over the smallest tables (other data,
    # so nothing timed below is cached)
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        wb = read_bronze(spark, write_bronze(spark, bronze_from_tables(spark, warm)))
        materialize_tables(spark, wb, "kickwx_warmup", weather_method=PAYLOAD_WEATHER_METHOD)
        wm = read_tables(spark, "kickwx_warmup")
        for q in (A.variability_rain, A.team_resilience, A.attendance_rain):
            run(q(wm))

    root = {}
    times["bronze_load"] = timed(lambda: root.setdefault("b", write_bronze(spark, bronze_from_tables(spark, sf_dir))))
    bronze = read_bronze(spark, root["b"])
    times["marts_build"] = timed(lambda: root.setdefault("m", materialize_tables(
        spark, bronze, "kickwx_bench", weather_method=PAYLOAD_WEATHER_METHOD)))
    m = read_tables(spark, "kickwx_bench")
    s = L.legacy_star(m)
    queries = {
        "attendance_rain": lambda: A.attendance_rain(m),
        "fouls_rain": lambda: A.fouls_rain(m),
        "home_win_rain": lambda: A.home_win_rain(m),
        "variability_rain": lambda: A.variability_rain(m),
        "variability_temp": lambda: A.variability_temp(m),
        "variability_wind": lambda: A.variability_wind(m),
        "penalty_weather": lambda: A.penalty_weather(m),
        "team_resilience": lambda: A.team_resilience(m),
        "bq1_temp": lambda: A.home_win_temperature(m),
        "bq1_wind": lambda: A.home_win_wind(m),
        "bq2_by_country": lambda: A.variability_rain_in_country(m, DASHBOARD_COUNTRY),
        "role_limited_top20": lambda: A.role_top20(m, limited=True),
        "rain_and_venue": lambda: L.rain_and_venue(s),
        "matches_temperature": lambda: L.matches_temperature(s, *MATCH_TEAMS),
        "team_hottest5": lambda: L.team_extreme_temperature(s, FOCUS_TEAM, hottest=True),
        "team_precipitation": lambda: L.team_precipitation(s),
    }
    for name, q in queries.items():
        times[name] = timed(lambda q=q: run(q()))

    # the as-of weather selection alone, both forms, from bronze
    from kickwx.operators.asof import select_kickoff_weather
    from kickwx.plans import staging as stg
    kick = stg.stg_fixtures(bronze.fixtures).select("event_id", "match_datetime")
    for method in ("window", "grid", "aggregate", "topk"):
        times[f"weather_{method}"] = timed(lambda method=method: run(
            select_kickoff_weather(stg.latest_observations(bronze.weather), kick, method=method)))
    times["weather_unnest"] = timed(lambda: run(bronze_from_tables(spark, sf_dir).weather))

    # bronze_load derives stand-in inputs from the test tables (not engine work) and the
    # weather_* entries re-time a step already inside marts_build: both are reported only
    total = round(sum(v for k, v in times.items() if not k.startswith("weather_") and k != "bronze_load"), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "marts_build_plus_queries_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
