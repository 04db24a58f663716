"""Keys and hashes made of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Separators and null marks (fixed values; stored hashes depend on them).
HASH_SEPARATOR, HASH_NULL = "\u0001", "\u0000"
KEY_SEPARATOR, KEY_NULL = "||", "<null>"


def attribute_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the texts of columns; a null differs from an empty text."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(HASH_NULL)) for c in columns]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *texts), 256)


def surrogate_key(columns: Sequence[str | Column]) -> Column:
    """MD5 over the texts of columns: the same on every rebuild."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(KEY_NULL)) for c in cols]))
