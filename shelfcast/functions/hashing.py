"""Order-free deterministic draws keyed by a string column.

The reference draws perishability, stock and costs from a seeded random
generator in row order. Spark has no row order, so each draw is a function of
the key: the first 32 bits of ``md5(key || salt)`` as an unsigned integer.
The same value is available in DuckDB as ``('0x' || substr(md5(k), 1, 8))::BIGINT``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_u32(key: Column, salt: str = "") -> Column:
    """Unsigned 32-bit integer from the md5 of ``key || salt`` (BIGINT)."""
    s = key if not salt else F.concat(key, F.lit(salt))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def md5_mod(key: Column, k: int, salt: str = "") -> Column:
    """Integer in ``[0, k)`` drawn from the key."""
    return F.pmod(md5_u32(key, salt), F.lit(k))


def md5_unit(key: Column, salt: str = "") -> Column:
    """Double in ``[0, 1)`` drawn from the key."""
    return md5_u32(key, salt) / F.lit(4294967296.0)


def md5_choice(key: Column, options: list, salt: str = "") -> Column:
    """One element of ``options`` drawn from the key."""
    arr = F.array(*[F.lit(o) for o in options])
    return F.element_at(arr, (md5_mod(key, len(options), salt) + 1).cast("int"))
