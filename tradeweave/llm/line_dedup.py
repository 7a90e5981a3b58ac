"""Removal of lines that spread over many sites, counted by mergeable sketches.

A HyperLogLog sketch of the sites of each line merges by aggregation. Lines whose estimate lies
near the threshold get an exact distinct count; the others are decided by the sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, own, saved


def _lines(docs: DataFrame, site: str, min_chars: int) -> DataFrame:
    """The lines that count: (line, id, of, site, pos); ``of`` tells the text."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").alias("id"),
        F.md5(text).alias("of"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "t"),
    ).withColumn("t", F.trim("t"))
    return rows.filter(F.length("t") >= min_chars).select(
        F.unhex(F.md5("t")).alias("line"), "id", "of", "site", "pos"
    )


def spread_lines(
    lines: DataFrame, min_sites: int, lg_k: int = 12, band: float = 0.25
) -> DataFrame:
    """The lines on at least ``min_sites`` sites: (line, n_sites, n, first); n counts all places.

    ``first`` is the place of the line's first copy by doc_id, text digest and position. A line
    within ``band`` of the threshold, in proportion, is counted exactly; beyond, the sketch
    decides, whose relative error is 1.04 / sqrt(2 ** lg_k), a fifteenth of the band or less.
    """
    sums = saved(
        lines.groupBy("line")
        .agg(
            F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"),
            F.min(F.struct("id", "of", "pos")).alias("first"),
            F.count("*").alias("n"),
        )
        .select("line", F.hll_sketch_estimate("sketch").alias("estimate"), "first", "n")
        .filter(F.col("estimate") >= min_sites * (1 - band)),
        "line-sums",
    )
    near = sums.filter(F.col("estimate") <= min_sites * (1 + band))
    exact = (
        lines.select("line", "site")
        .distinct()
        .join(near.select("line"), "line", "left_semi")
        .groupBy("line")
        .agg(F.count("*").alias("exact"))
    )
    out = (
        sums.join(exact, "line", "left")
        .withColumn("n_sites", F.coalesce("exact", "estimate"))
        .filter(F.col("n_sites") >= min_sites)
        .select("line", "n_sites", "n", "first")
    )
    kept = saved(out, "spread-lines")
    dropped(sums)
    return kept


def removable(lines: DataFrame, spread: DataFrame, share: int = 1000) -> DataFrame:
    """The places (id, of, pos) of ``spread`` lines other than their first.

    A line that has more than 1 / ``share`` of all places of spread lines is hot; there are fewer than
    ``share`` such lines, so they are sent to all tasks, and their places don't meet in one.
    """
    total = spread.agg(F.sum("n")).first()[0] or 0
    hot = spread.filter(F.col("n") > total / share).select("line", F.col("first").alias("hot_first"))
    rest = spread.filter(F.col("n") <= total / share).select(F.col("line").alias("rest_line"), F.col("first").alias("rest_first"))
    rows = lines.join(F.broadcast(hot), "line", "left")
    alone = F.unhex(F.md5(F.concat_ws(" ", "of", "pos")))  # no line has it as its digest
    rows = rows.withColumn("at", F.when(F.col("hot_first").isNull(), F.col("line")).otherwise(alone))
    rows = rows.join(rest, F.col("at") == F.col("rest_line"), "left").withColumn("first", F.coalesce("hot_first", "rest_first"))
    return rows.filter(F.col("first").isNotNull() & ~F.struct("id", "of", "pos").eqNullSafe(F.col("first"))).select("id", "of", "pos")


def line_dedup(
    docs: DataFrame, min_sites: int = 5, min_chars: int = 20, site: str = "source", lg_k: int = 12
) -> DataFrame:
    """``docs`` with all its columns and n_lines and n_removed, without cross-site lines.

    Lines are what newlines part, compared without leading and trailing spaces. A line of at
    least ``min_chars`` characters on at least ``min_sites`` sites goes from every place but its
    first (least doc_id, then text digest, then position), so nothing is lost from the whole.
    Documents stay even if no line is left. A null text stays null and has no lines; a null site
    counts as the site ''. Rows equal in doc_id and text are the same place and are treated alike.
    A null doc_id sorts first. n_chars, where there is one, follows a changed text. Texts of any
    length count as a whole; an empty table gives no rows; columns n_lines and n_removed are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    lines = _lines(docs, site, min_chars)
    spread = spread_lines(lines, min_sites, lg_k)
    gone = removable(lines, spread).groupBy("id", "of").agg(F.collect_set("pos").alias("gone"))
    # All columns of docs travel in one, so none clashes with those in here.
    rows = docs.select(F.struct(*(own(c).alias(c) for c in names)).alias("row"))
    text = F.col("row.text")
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.md5(F.coalesce(text, F.lit(""))) == F.col("of"))
    pieces = F.split(text, "\n", -1)
    lacks = F.array_join(F.filter(pieces, lambda _, i: ~F.array_contains("gone", i)), "\n")
    out = rows.join(gone, same, "left").withColumn("cut", F.when(F.col("gone").isNull(), text).otherwise(lacks))
    return out.select(
        *[_changed(out, c) for c in names],
        F.coalesce(F.size(pieces), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


def _changed(out: DataFrame, name: str) -> Column:
    """A column of ``docs`` after the removal."""
    before = F.col("row").getField(name)
    if name == "text":
        return F.col("cut").alias("text")
    if name == "n_chars":
        kind = out.schema["row"].dataType[name].dataType
        return F.when(F.col("gone").isNull(), before).otherwise(F.length("cut").cast(kind)).alias(name)
    return before.alias(name)
