"""The governance loop: proposals and their approved ingestion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.functions import text as X

from .aggregate import money, total


def build_proposals(rows: DataFrame, selectors: DataFrame, keys: Sequence[str], master: DataFrame, target: Sequence[str]) -> DataFrame:
    """B1: selectors with rows and value of the review rows that they cover, and their status.

    A selector's keys match rows null-safe, blank matching blank; its target labels are looked up in
    the master. error: it covers no row or its target is unknown.
    """
    clean = lambda d: d.withColumns({k: X.norm_exact(k) for k in keys})
    sums = clean(rows).groupBy(*keys).agg(F.count("*").alias("n_rows"), total(money("value")).alias("value"))
    known = master.select(X.target_id(*target).alias("_target")).distinct().withColumn("master_valid", F.lit(True))
    out = clean(selectors).join(sums, list(keys), "left").fillna(0, ["n_rows", "value"])
    out = out.withColumn("_target", X.target_id(*target)).join(known, "_target", "left").fillna(False, ["master_valid"]).drop("_target")
    return out.withColumn("status", F.when(F.col("n_rows") == 0, "error: no rows").when(~F.col("master_valid"), "error: not in master").otherwise("ok"))


def append_new(current: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``current`` and the rows of ``new`` whose key isn't there, each key once."""
    fresh = new.join(current.select(*keys).distinct(), list(keys), "left_anti").dropDuplicates(list(keys))
    return current.unionByName(fresh, allowMissingColumns=True)


def ingest_approved(proposals: DataFrame, master: DataFrame, maps: DataFrame, terms: DataFrame) -> dict[str, DataFrame]:
    """B2: what approved proposals (alias_entries, target_table, player, family) add.

    map_rows: aliases (map_name, key, value) of families that the master has under one maker;
    list_rows: (list_name, term) for proposals that name a term list; backlog: aliases whose family
    is unknown or ambiguous; stats: rows by kind. What is there already is left out.
    """
    each = proposals.select("target_table", "player", "family", F.explode(X.alias_entries("alias_entries")).alias("e"))
    each = each.select("target_table", "player", F.coalesce(F.when(F.col("e.target") != "", F.col("e.target")), F.col("family")).alias("family"), X.norm_exact("e.term").alias("key"))
    unique = master.groupBy(X.norm_exact("family").alias("fk"), X.norm_exact("player").alias("pk")).agg(
        F.count("*").alias("n"), F.min(F.struct("segment", "sub_segment", "product", "player", "family")).alias("m")
    )
    is_list = X.target_list("target_table") != ""
    lists = each.filter(is_list).select(X.target_list("target_table").alias("list_name"), F.col("key").alias("term")).distinct()
    list_rows = lists.join(terms.select("list_name", X.norm_exact("term").alias("term")).distinct(), ["list_name", "term"], "left_anti")
    looked = each.filter(~is_list).withColumns({"fk": X.norm_exact("family"), "pk": X.norm_exact("player")}).join(unique, ["fk", "pk"], "left")
    good = looked.filter("n is not null").select(F.lit("alias").alias("map_name"), "key", F.concat_ws("|", *[F.col(f"m.{c}") for c in ("segment", "sub_segment", "product", "player", "family")]).alias("value")).dropDuplicates(["key"])
    map_rows = good.join(maps.select("map_name", X.norm_exact("key").alias("key")).distinct(), ["map_name", "key"], "left_anti")
    backlog = looked.filter("n is null").select("key", "player", "family").distinct()
    count = lambda d, n: d.agg(F.lit(n).alias("kind"), F.count("*").alias("n_rows"))
    stats = count(map_rows, "map_rows").unionByName(count(list_rows, "list_rows")).unionByName(count(backlog, "backlog"))
    return {"map_rows": map_rows, "list_rows": list_rows, "backlog": backlog, "stats": stats}
