"""Pseudonymising labels of the limited analytics view."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Attendance labels (power-of-ten bands, spaces as in the reference).
ATTENDANCE_LABELS = [
    (10, "0-10"),
    (100, "10-100"),
    (1000, "100-1000"),
    (10000, "1000-10 000"),
    (100000, "10 000-100 000"),
]
ATTENDANCE_TOP = "100 000+"


def goal_range(goals: Column) -> Column:
    """0,1 -> '0-1'; 2,3 -> '2-3'; ... NULL stays NULL.

    ``intDiv(g, 2) * 2`` truncates toward zero, which is ``g - g % 2`` with the
    sign-of-dividend remainder.
    """
    lo = goals - goals % 2
    return F.concat(lo.cast("string"), F.lit("-"), (lo + 1).cast("string"))


def attendance_band(att: Column) -> Column:
    out = F.when(att.isNull(), F.lit(None).cast("string"))
    for bound, label in ATTENDANCE_LABELS:
        out = out.when(att < bound, F.lit(label))
    return out.otherwise(F.lit(ATTENDANCE_TOP))
