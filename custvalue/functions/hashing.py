"""Deterministic hash buckets of text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 hex digits are 60 bits, which fit a positive BIGINT.
HEX_DIGITS = 15


def hash_bucket(text: Column, buckets: int) -> Column:
    """Bucket ``0 .. buckets-1`` of a text key, the same on every engine with md5."""
    head = F.substring(F.md5(text.cast("string")), 1, HEX_DIGITS)
    return F.conv(head, 16, 10).cast("bigint") % F.lit(buckets)


def hash_bucket_sql(text: str, buckets: int) -> str:
    """``hash_bucket`` of a SQL expression, as SQL text."""
    return f"CAST(conv(substring(md5({text}), 1, {HEX_DIGITS}), 16, 10) AS BIGINT) % {buckets}"
