"""Seeded, engine-independent order keys and random draws (contracts K5, K6).

``rand()`` and ``xxhash64`` differ between engines and between runs with a
different partitioning; an md5 of ``seed:op:epoch:id`` does not, so a plan can
be replayed on any cluster and checked against SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: default shuffle seed of the streaming reader
DEFAULT_SEED = 9176


def order_key(id_col, seed: int = DEFAULT_SEED, epoch: int | None = None) -> Column:
    """md5 hex of ``seed:id`` (or ``seed:epoch:id``); ties are broken by id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    prefix = f"{seed}:" if epoch is None else f"{seed}:{epoch}:"
    return F.md5(F.concat(F.lit(prefix), c.cast("string")))


def uniform(id_col, op: str, *, seed: int = DEFAULT_SEED, epoch: int = 0, salt: str | None = None) -> Column:
    """``u`` in [0, 1): first 8 hex digits of md5(seed:op:epoch:id) / 2**32."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    tag = op if salt is None else f"{op}.{salt}"
    h = F.md5(F.concat(F.lit(f"{seed}:{tag}:{epoch}:"), c.cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint").cast("double") / F.lit(4294967296.0)


def uniform_range(u: Column, lo: float, hi: float) -> Column:
    return F.lit(float(lo)) + u * F.lit(float(hi - lo))


def coin(u: Column, prob: float) -> Column:
    return u < F.lit(float(prob))


def uniform_sql(id_sql: str, op: str, *, seed: int = DEFAULT_SEED, epoch: int = 0, salt: str | None = None) -> str:
    """SQL text of :func:`uniform` for the DuckDB oracle."""
    tag = op if salt is None else f"{op}.{salt}"
    return (f"(CAST(CAST('0x' || substr(md5('{seed}:{tag}:{epoch}:' || CAST({id_sql} AS VARCHAR)), 1, 8) "
            f"AS BIGINT) AS DOUBLE) / 4294967296.0)")
