"""Order-free digests of the content of a table.

A row's hash covers every column with its place and whether it is NULL; a table's
digest is the sum of two differently salted row hashes, as exact decimals.  Sums don't
depend on the order of rows or on how they are spread, and a repeated row counts as
often as it is there.  Two tables of the same digest and row count are equal but for
a chance of about 2 to the -128; a digest is no protection against forgery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SALTS = (11, 97)


def row_hash(columns: Sequence[Column], salt: int) -> Column:
    """Hash of one row; a NULL and a missing value of the next column differ."""
    parts = [F.lit(salt)]
    for c in columns:
        parts += [c.isNull(), c]
    return F.xxhash64(*parts)


def hash_sum(hashes: Sequence[Column], where: Column | None = None) -> Column:
    """Aggregate: the sums of the rows' hashes (those where ``where`` holds), as text."""
    exact = [h.cast("decimal(38,0)") for h in hashes]
    return F.concat_ws(":", *[
        F.coalesce(F.sum(h if where is None else F.when(where, h)), F.lit(0).cast("decimal(38,0)")).cast("string")
        for h in exact])


def content_digest(columns: Sequence[Column]) -> Column:
    """Aggregate: the digest of the rows' ``columns``."""
    return hash_sum([row_hash(columns, salt) for salt in SALTS])
