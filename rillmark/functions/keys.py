"""Key cleaning and stable hashing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EDGE_BLANKS = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def stripped(c: Column | str) -> Column:
    """Without white space, Unicode separators included, at either end; null stays null."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, EDGE_BLANKS, "")


def _key(c: Column) -> Column:
    return F.when(c != "", c)


def lower_key(c: Column | str) -> Column:
    """A key equal up to letter case and edge blanks, in lower case; blank becomes null."""
    return _key(F.lower(stripped(c)))


def upper_key(c: Column | str) -> Column:
    """A key equal up to letter case and edge blanks, in upper case; blank becomes null."""
    return _key(F.upper(stripped(c)))


def hash32(c: Column) -> Column:
    """First 32 bits of SHA-256 as a bigint."""
    return F.conv(F.substring(F.sha2(c, 256), 1, 8), 16, 10).cast("bigint")


def hash_bucket(c: Column, n: int) -> Column:
    """Stable bucket 0..n-1 of a string, independent of partitioning and of Spark's own hashes."""
    return F.pmod(hash32(c), F.lit(n).cast("bigint")).cast("int")


def hash_unit(c: Column) -> Column:
    """Uniform number in [0,1) from the first 53 bits of SHA-256."""
    return F.shiftright(F.conv(F.substring(F.sha2(c, 256), 1, 14), 16, 10).cast("bigint"), 3) / F.lit(float(1 << 53))


def run_id(prefix: str, *parts: object) -> str:
    """Deterministic id: prefix and SHA-256 over the ``|``-joined inputs, no wall clock."""
    import hashlib

    return f"{prefix}:{hashlib.sha256('|'.join(map(str, parts)).encode()).hexdigest()[:16]}"
