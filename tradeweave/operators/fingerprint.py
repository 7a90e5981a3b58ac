"""Which rows of two tables differ, found through mergeable fingerprints (for Q7 and C6).

Rows fall into buckets by a hash of their key. A bucket's fingerprint is the number of its rows and two
sums of 64-bit row digests, which don't depend on order and add up to those of coarser buckets. Two tables
are compared from the coarse buckets down, and only rows of fine buckets that differ are joined, so what
is shuffled by key shrinks with the number of changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.sources.tables import staged

#: Bits of a fine bucket, and how many of them a coarse one lacks.
BITS, LESS = 16, 8


def _bucket(keys: Sequence[str], bits: int) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit((1 << bits) - 1))


def fingerprints(df: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """(bucket, n, one, two): the fine buckets of ``df``. They merge: those of parts, summed, are those of
    the whole, so a table's can be kept beside it and follow what is appended."""
    digest = lambda seed: F.sum(F.xxhash64(F.lit(seed), *keys, *columns).cast("decimal(38,0)"))
    return df.groupBy(_bucket(keys, bits).alias("bucket")).agg(F.count("*").alias("n"), digest(1).alias("one"), digest(2).alias("two"))


def merged(prints: DataFrame, less: int = 0) -> DataFrame:
    """Fingerprints of parts added up, with ``less`` bits."""
    return prints.groupBy(F.shiftright("bucket", less).alias("bucket")).agg(*(F.sum(c).alias(c) for c in ("n", "one", "two")))


def _unequal(a: DataFrame, b: DataFrame) -> DataFrame:
    same = F.lit(True)
    for c in ("n", "one", "two"):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    other = b.select("bucket", *(F.col(c).alias(f"{c}_") for c in ("n", "one", "two")))
    return a.join(other, "bucket", "full_outer").filter(~same).select("bucket")


def differing_buckets(a: DataFrame, b: DataFrame, less: int = LESS) -> DataFrame:
    """(bucket): the fine buckets that differ, looked for in coarse ones that do."""
    coarse = _unequal(merged(a, less), merged(b, less)).withColumnRenamed("bucket", "coarse")
    a, b = (d.join(coarse, F.shiftright("bucket", less) == F.col("coarse"), "left_semi") for d in (a, b))
    return _unequal(a, b)


def rows_of_differing(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str], bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """The rows of either table in buckets that differ in ``columns``: all rows that were added, removed or
    changed, and few others. A bucket of n rows needs a change to be looked at, so more bits make fewer
    rows come along."""
    a, b = (staged(fingerprints(d, keys, columns, bits), "fingerprints") for d in (before, after))
    buckets = staged(differing_buckets(a, b).withColumnRenamed("bucket", "_bucket"), "differing")
    return tuple(d.join(buckets, _bucket(keys, bits) == F.col("_bucket"), "left_semi") for d in (before, after))
