"""File and payload hashes.  ``sha1`` is native; xxh64 (seed 0) needs the
``xxhash`` module, so it runs as an Arrow-batched pandas UDF.  Spark's own
``xxhash64`` uses seed 42 and would not match other tools."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _xxh64(content: pd.Series) -> pd.Series:
    import xxhash
    return content.map(lambda b: None if b is None else xxhash.xxh64(bytes(b), seed=0).hexdigest())


def xxh64_hex(content: Column) -> Column:
    # built on call (not at import), so worker processes can import this module
    return F.pandas_udf(_xxh64, T.StringType())(content)


def sha1_hex(content: Column) -> Column:
    return F.sha1(content)
