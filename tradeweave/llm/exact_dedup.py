"""Exact duplicate removal through an extendible-hash index on shared files.

Native: DataFrame operations only. The directory maps the leading bits of a text's key to a bucket;
it doubles as long as a bucket has more keys than its capacity, and only such buckets split. A run of
buckets has one owner task, which gets all rows of its range of keys, compares their texts byte by
byte, chains the different texts of one key, and writes its part of the index. Every document is then
looked up by bucket, key and digest. Keys of many rows are combined by text before they go to their
owner, so a text that makes up a third of all rows arrives as one row a task; entries of such texts go
to all tasks for the lookup.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import dropped, hot_apart, saved

#: The white space that counts as equal.
_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Null becomes the empty text, each run of white space one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, " ")


def leading_bits(key: Column, n: int) -> Column:
    """The first ``n`` bits of a 64-bit key, as a long; 0 bits give 0."""
    return F.call_function("shiftrightunsigned", key, F.lit(64 - n)) if n else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int, owned: int, max_depth: int = 18) -> tuple[DataFrame, int]:
    """The directory over the distinct ``keys.key``, and its depth g.

    A row for each value ``leaf`` of the first g bits that occurs: (leaf, depth, bucket, n_keys,
    owner). g grows, which doubles the directory, while a bucket has more than ``capacity`` keys; a
    bucket's own depth is the least at which it holds no more (at ``max_depth`` it stays overfull). At
    most ``2**max_depth`` rows. Owners have runs of buckets of about ``owned`` keys.
    """
    finest = saved(keys.groupBy(leading_bits(F.col("key"), max_depth).alias("f")).agg(F.count("*").alias("n")), "leaves")

    def first(n: int) -> Column:
        return F.shiftright("f", max_depth - n)

    g = 0
    while g < max_depth and not finest.groupBy(first(g)).agg(F.sum("n").alias("n")).filter(F.col("n") > capacity).isEmpty():
        g += 1
    levels = finest.select("n", first(g).alias("leaf"), F.posexplode(F.array(*map(first, range(g + 1)))).alias("depth", "bucket"))
    levels = levels.groupBy("leaf", "depth", "bucket").agg(F.sum("n").alias("n"))
    sizes = levels.groupBy("depth", "bucket").agg(F.sum("n").alias("n_keys"), F.min("leaf").alias("start"))
    fits = sizes.filter((F.col("n_keys") <= capacity) | (F.col("depth") == g))
    of_leaf = levels.join(fits, ["depth", "bucket"]).groupBy("leaf").agg(F.min(F.struct("depth", "bucket", "n_keys", "start")).alias("b"))
    of_leaf = of_leaf.select("leaf", "b.*")
    before = F.sum("n_keys").over(Window.orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    owners = of_leaf.select("start", "n_keys").distinct().select("start", F.floor(F.coalesce(before, F.lit(0)) / owned).alias("owner"))
    out = saved(of_leaf.join(owners, "start").drop("start"), "directory")
    dropped(finest)
    return out, g


def build_index(
    docs: DataFrame, hash_: Callable[[Column], Column] = F.xxhash64, capacity: int = 2_000, owned: int = 10_000
) -> tuple[DataFrame, DataFrame]:
    """The index over the texts of ``docs``, and its documents as (doc_id, bucket, key, text_sha256).

    The index has an entry for each text: owner, depth, bucket, key (``hash_`` of the text), chain (0,
    1, ... among different texts of one key), text_sha256, keep_id (the least doc_id) and group_size.
    Buckets hold up to ``capacity`` keys and owners about ``owned``, or more where there would be over
    about 2**16 buckets.
    """
    texts = docs.select("doc_id", normalised(F.col("text")).alias("t")).select("doc_id", hash_(F.col("t")).alias("key"), "t")
    keyed = saved(texts.select("doc_id", "key", F.sha2("t", 256).alias("text_sha256")), "keyed")
    keys = saved(keyed.groupBy("key").agg(F.count("*").alias("n")), "keys")
    counts = keys.agg(F.count("*").alias("keys"), F.sum("n").alias("rows")).first()
    scale = max(1.0, counts["keys"] / (capacity << 15))
    places, g = directory(keys, int(capacity * scale), int(owned * scale))
    leaf = leading_bits(F.col("key"), g)

    # A key of more than a thousandth of all rows is hot: there are fewer than a thousand of them.
    limit = (counts["rows"] or 0) / 1000
    hot = F.broadcast(keys.filter(F.col("n") > limit).select("key"))
    least, size = F.min("doc_id").alias("doc_id"), F.count("*").alias("n")
    combined = texts.join(hot, "key", "left_semi").groupBy("key", "t").agg(least, size).select("doc_id", "key", "t", "n")
    rows = texts.join(hot, "key", "left_anti").withColumn("n", F.lit(1).cast("long")).unionByName(combined)
    rows = rows.join(F.broadcast(places), leaf == F.col("leaf")).drop("leaf", "n_keys").repartition("owner")
    same_bytes = rows.groupBy("owner", "depth", "bucket", "key", "t").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    entries = same_bytes.withColumn("text_sha256", F.sha2("t", 256)).drop("t")
    chain = F.row_number().over(Window.partitionBy("owner", "bucket", "key").orderBy("keep_id", "text_sha256")) - 1
    index = saved(entries.withColumn("chain", chain), "exact-index")
    dropped(keys)
    return index, keyed.join(F.broadcast(places.select("leaf", "bucket")), leaf == F.col("leaf")).drop("leaf")


def exact_dedup(
    docs: DataFrame, hash_: Callable[[Column], Column] = F.xxhash64, capacity: int = 2_000, owned: int = 10_000
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, key, bucket, chain.

    Texts are equal when identical after each run of white space became one space; the least
    doc_id of equal texts stays. A null text counts as empty. Rows that repeat a doc_id with the
    same text are one document given twice: each is returned, with the same verdict. A null doc_id
    is never the keeper unless all of its group are null; then keep_id is null and all stay. Texts of
    any length count as a whole. An empty table gives no rows; other columns are ignored.
    """
    index, keyed = build_index(docs, hash_, capacity, owned)
    entries = index.select("bucket", "key", "text_sha256", "keep_id", "group_size", "chain", F.col("group_size").alias("n"))
    total = index.agg(F.sum("group_size")).first()[0] or 0
    return hot_apart(keyed, entries, ["bucket", "key", "text_sha256"], "n", total).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        "key",
        "bucket",
        "chain",
    )
