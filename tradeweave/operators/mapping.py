"""Mapped rows and their standard dimensions (A1-A3)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions import predicates as P
from tradeweave.functions import text as X
from tradeweave.sources.tables import small

BOUND = ("family", "category")


_FILLED = ("segment", "sub_segment", "product", "maker", "family", "match_tier", "match_confidence")


def match_labels(matches: DataFrame, key: str, keywords: DataFrame) -> DataFrame:
    """A1: (key, labels, match_tier, match_confidence) of the cascade's matches."""
    labels = keywords.select(
        "keyword", F.col("segment").alias("_seg"), F.col("sub_segment").alias("_sub"), F.col("product").alias("_prod"),
        F.col("player").alias("_player"), F.col("family").alias("_fam"),
    )
    m = matches.join(labels, "keyword", "left")
    family = F.col("tier") == "family"
    return m.select(
        key,
        F.when(family, F.col("_seg")).otherwise(X.text("segment")).alias("segment"),
        F.when(family, F.col("_sub")).otherwise(X.text("sub_segment")).alias("sub_segment"),
        F.when(family, F.col("_prod")).otherwise(X.text("product")).alias("product"),
        F.when(family, F.col("_player")).otherwise(X.text("maker")).alias("maker"),
        F.when(family, F.col("_fam")).otherwise("").alias("family"),
        F.col("tier").alias("match_tier"),
        F.when(family, "high").when(F.col("tier") == "manufacturer", "low").otherwise(X.text("confidence")).alias("match_confidence"),
    )


def _finished(df: DataFrame, hs4: str, scope: Iterable[int]) -> DataFrame:
    out = df.withColumn("match_status", F.when(F.col("match_tier").isNull(), "Unmatched").otherwise("Matched"))
    return out.fillna("", list(_FILLED)).withColumn("match_scope", P.scope_label(hs4, scope))


def assemble(df: DataFrame, key: str, matches: DataFrame, keywords: DataFrame, hs4: str, scope: Iterable[int]) -> DataFrame:
    """A1: ``df`` with labels, status, tier, confidence and scope from the cascade's matches."""
    return _finished(df.join(match_labels(matches, key, keywords), key, "left"), hs4, scope)


def assemble_texts(texts: DataFrame, text: str, labels: DataFrame, allowed: Column, hs4: str, scope: Iterable[int]) -> DataFrame:
    """A1 for distinct texts: each twice, by whether its row's parties hold a maker (``_found``). Where a text
    has no ``labels`` and may be matched, that decides on its tier; the maker itself comes with the rows."""
    out = texts.join(labels, text, "left").withColumn("_found", F.explode(F.array(F.lit(False), F.lit(True))))
    found = F.col("match_tier").isNull() & allowed & F.col("_found")
    out = out.withColumns({"match_confidence": F.when(found, "low").otherwise(F.col("match_confidence")), "match_tier": F.when(found, "manufacturer").otherwise(F.col("match_tier"))})
    return _finished(out, hs4, scope)


def labelled_rows(df: DataFrame, text: str, judged: DataFrame, maker: str) -> DataFrame:
    """``df`` with what :func:`assemble_texts` and later judgements say of its text (id) and of whether
    ``maker`` is there; rows of the maker tier have that maker."""
    out = df.withColumn("_found", F.col(maker).isNotNull()).join(small(judged), [text, "_found"])
    return out.withColumn("maker", F.when(F.col("match_tier") == "manufacturer", F.col(maker)).otherwise(F.col("maker"))).drop(text, "_found", maker)


def standard_labels(df: DataFrame, label: str = "Unspecified") -> DataFrame:
    """A2: an unspecified family on category rows, labels in place of blanks on bound rows."""
    bound = F.col("match_tier").isin(*BOUND)
    out = df.withColumn("family", F.when(F.col("match_tier") == "category", label).otherwise(F.col("family")))
    for c in ("segment", "sub_segment", "product", "maker", "family"):
        out = out.withColumn(c, F.when(bound, X.blank_to(c, label)).otherwise(F.col(c)))
    return out


def standardize(df: DataFrame, value: str, quantity: str, label: str = "Unspecified") -> DataFrame:
    """A2: standard labels and the unit price. (A maker found in the parties comes from ``derive_maker`` before.)"""
    return standard_labels(df, label).withColumn("unit_price", X.unit_price(X.number(value), X.number(quantity)))


def preserve_or_propose(current: Column | str, proposed: Column | str) -> Column:
    """A3: the current value unless it is blank, else the proposed one."""
    current = F.col(current) if isinstance(current, str) else current
    proposed = F.col(proposed) if isinstance(proposed, str) else proposed
    return F.when(~X.is_blank(current), current).otherwise(proposed)
