"""Surrogate keys.

The reference keys every dimension and the fact with the first 8 bytes of the
MD5 digest of a text (``halfMD5``), read as an unsigned 64-bit integer. Inside
the marts the same 64 bits are kept as a signed ``bigint`` (two's complement),
so joins and shuffles hash a primitive long instead of a 20-digit decimal. The
published views convert to the unsigned value as ``decimal(20,0)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_POW_64 = 18446744073709551616

SEPARATOR = "|"


def key_text(*parts: Column) -> Column:
    """``toString(a) || '|' || toString(b)``; any NULL part makes the text NULL."""
    texts = [p.cast("string") for p in parts]
    if len(texts) == 1:
        return texts[0]
    out = [texts[0]]
    for t in texts[1:]:
        out += [F.lit(SEPARATOR), t]
    return F.concat(*out)


def hash_key(*parts: Column) -> Column:
    """Signed 64-bit half-MD5 key of the joined parts (NULL if any part is NULL)."""
    digest = F.md5(key_text(*parts))
    return F.conv(F.substring(digest, 1, 16), 16, -10).cast("bigint")


def published_key(key: Column) -> Column:
    """Signed internal key -> the reference's unsigned value as decimal(20,0)."""
    d = key.cast("decimal(20,0)")
    return F.when(key < 0, (d + F.lit(str(_TWO_POW_64)).cast("decimal(20,0)")).cast("decimal(20,0)")).otherwise(d)
