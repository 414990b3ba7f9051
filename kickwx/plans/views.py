"""Temp views over the marts, so analysts keep querying them in SQL (K8).

Registered names follow the reference's layout: ``dim_date``, ``dim_team``,
``dim_venue``, ``dim_weather``, ``fact_match`` with published (unsigned
decimal) keys, plus ``v_matches_full`` and ``v_matches_limited``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from kickwx.plans.marts import Marts, published_dim, published_fact, v_matches_full, v_matches_limited


def register_views(spark: SparkSession, m: Marts, prefix: str = "") -> list[str]:
    views = {
        "dim_date": published_dim(m.dim_date, "date_key"),
        "dim_team": published_dim(m.dim_team, "team_key"),
        "dim_venue": published_dim(m.dim_venue, "venue_key"),
        "dim_weather": published_dim(m.dim_weather, "weather_key"),
        "fact_match": published_fact(m.fact_match),
        "v_matches_full": v_matches_full(m.fact_match),
        "v_matches_limited": v_matches_limited(m.fact_match),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
