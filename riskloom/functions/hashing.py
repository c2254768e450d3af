"""Uniform draws that depend only on a row key and a salt.

Unlike `rand()`, a hash draw does not change with the partitioning or when a task is run again.
The `*_sql` forms give SQL text: tables of hundreds of drawn columns are built from text, as one Python
call per column is much faster than one per operator.
"""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_int(key: Column, salt: str) -> Column:
    """32-bit integer from md5; any SQL engine can reproduce it."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(":" + salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def md5_uniform(key: Column, salt: str) -> Column:
    return md5_int(key, salt) / F.lit(4294967296.0)


def md5_uniform_sql(key: str, salt: str) -> str:
    digest = f"md5(concat(cast({key} AS string), ':{salt}'))"
    return f"(cast(conv(substring({digest}, 1, 8), 16, 10) AS bigint) / 4294967296.0D)"


def fast_uniform_sql(key: str, salt: str) -> str:
    """53-bit draw from xxhash64: cheaper than md5, for use inside Spark only."""
    number = crc32(salt.encode())
    return f"(shiftrightunsigned(xxhash64({key}, {number}L), 11) * {2.0**-53!r}D)"


def fast_uniform(key: str, salt: str) -> Column:
    return F.expr(fast_uniform_sql(key, salt))
