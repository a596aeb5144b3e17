"""Deterministic, partition-independent hashing.

The bucket of a key is the first 8 hex digits of ``md5(key || '|' || salt)``
read as an integer, modulo ``modulo``. It depends only on the key, so a split
or a synthetic score is the same however the input is partitioned or ordered,
and DuckDB can reproduce it for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Shares are exact to a millionth.
MODULO = 1_000_000


def hash_bucket(key, salt, modulo: int = MODULO) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws("|", k.cast("string"), F.lit(str(salt))))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(modulo)).cast("int")


def hash_unit(key, salt, modulo: int = MODULO) -> Column:
    """``hash_bucket / modulo`` in [0, 1)."""
    return hash_bucket(key, salt, modulo).cast("double") / F.lit(float(modulo))
