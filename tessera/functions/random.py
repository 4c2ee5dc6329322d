"""Deterministic, seedable pseudo-random draws from row keys.

A draw is a hash of (seed, key columns), so it is the same on every run, on
any partitioning, and after a lost executor recomputes a task.  The same
formula in SQL (``md5`` of the same text) is the oracle's.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

TWO32 = 4294967296.0


def hash_uniform(seed: int, *keys: str | Column) -> Column:
    """Uniform draw in [0, 1) from md5 of ``seed|key1|key2...`` (first 32 bits)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k) if isinstance(k, str) else k for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / TWO32


def hash_uniform_sql(seed: int, *keys: str) -> str:
    """The DuckDB twin of :func:`hash_uniform`."""
    parts = ", ".join([f"'{seed}'"] + list(keys))
    return f"(CAST(('0x' || substr(md5(concat_ws('|', {parts})), 1, 8)) AS BIGINT) / 4294967296.0)"


def hash_normal(seed: int, *keys: str | Column) -> Column:
    """Standard normal draw by Box-Muller on two hash-uniform draws."""
    u1 = hash_uniform(seed, *keys)
    u2 = hash_uniform(seed + 7919, *keys)
    return F.sqrt(-2.0 * F.ln(1.0 - u1)) * F.cos(2.0 * math.pi * u2)


def hash_normal_sql(seed: int, *keys: str) -> str:
    u1 = hash_uniform_sql(seed, *keys)
    u2 = hash_uniform_sql(seed + 7919, *keys)
    return f"(sqrt(-2.0 * ln(1.0 - {u1})) * cos(2.0 * pi() * {u2}))"
