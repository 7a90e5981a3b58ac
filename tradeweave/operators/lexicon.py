"""Dictionary builders (L1-L15). Dictionaries are DataFrames; ties have a declared order."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradeweave.functions import text as X

DIMENSIONS = ("segment", "sub_segment", "product", "player", "family")
CATEGORY = DIMENSIONS[:3]


def first_by(df: DataFrame, keys: Iterable[str], order: Iterable[Column | str]) -> DataFrame:
    """The first row of each key in the declared order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def dominant(df: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """K3: for each key its most frequent non-blank value (the first by name of equals), with n,
    total and share. A row counts as many times as its ``weight``, or once."""
    n = F.count("*") if weight is None else F.sum(weight)
    counts = df.filter(~X.is_blank(value, ("",))).groupBy(*keys, value).agg(n.alias("n"))
    # Of equal counts the smaller value: min over (-n, value).
    top = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("m"), value)).alias("t"), F.sum("n").alias("total"))
    return top.select(
        *keys, F.col(f"t.{value}").alias(value), (-F.col("t.m")).alias("n"), "total", (-F.col("t.m") / F.col("total")).alias("share")
    )


def build_keywords(master: DataFrame, blacklist: DataFrame | None = None, min_len: int = 4) -> DataFrame:
    """L1: (keyword, prefix, len, *dimensions): family names in lower case, without numbers, short
    and blacklisted ones; of rows with one keyword the first by segment, sub-segment and player."""
    rows = master.withColumn("keyword", F.lower(F.trim("family"))).filter(
        (F.length("keyword") >= min_len) & ~F.col("keyword").rlike(r"^[0-9.,\s-]+$")
    )
    if blacklist is not None:
        rows = rows.join(blacklist.select(F.lower(F.trim("term")).alias("keyword")).distinct(), "keyword", "left_anti")
    rows = first_by(rows, ["keyword"], ["segment", "sub_segment", "player", "product", "family"])
    return rows.select("keyword", F.substring("keyword", 1, 4).alias("prefix"), F.length("keyword").alias("len"), *DIMENSIONS)


def merge_missing(keywords: DataFrame, extra: DataFrame) -> DataFrame:
    """L2: adds the keywords that aren't there yet."""
    new = first_by(extra.join(keywords.select("keyword"), "keyword", "left_anti"), ["keyword"], ["segment", "sub_segment", "player"])
    return keywords.unionByName(new.select(keywords.columns))


def merge_aliases(keywords: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L3: adds aliases (key, value ``a|b|c|d|e``); also the rows whose value hasn't five parts."""
    parts = F.split("value", r"\|")
    rows = aliases.withColumn("p", parts)
    good = rows.filter(F.size("p") == 5).select(
        F.lower(F.trim("key")).alias("keyword"), *[F.trim(F.get("p", F.lit(k))).alias(d) for k, d in enumerate(DIMENSIONS)]
    )
    good = good.withColumns({"prefix": F.substring("keyword", 1, 4), "len": F.length("keyword")})
    return merge_missing(keywords, good), rows.filter(F.size("p") != 5).drop("p")


def canonical_labels(labels: DataFrame, column: str) -> DataFrame:
    """L4: (label, canonical) for labels of equal words: one with ``_``, else the shorter, else the
    first by name stands for all."""
    rows = labels.select(F.col(column).alias("label")).filter(X.text("label") != "").distinct()
    rows = rows.withColumn("identity", F.array_join(X.canon_tokens("label"), " "))
    best = rows.groupBy("identity").agg(
        F.min(F.struct((~F.col("label").contains("_")).alias("a"), F.length("label").alias("b"), "label"))["label"].alias("canonical")
    )
    return rows.join(best, "identity").select("label", "canonical")


def canonicalize(df: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """Replaces labels by their canonical ones; others and nulls pass."""
    known = labels.select(F.col("label").alias("_label"), F.col("canonical").alias("_canonical"))
    out = df.join(known, df[column] == F.col("_label"), "left")
    return out.withColumn(column, F.coalesce("_canonical", column)).drop("_label", "_canonical")


def build_phrases(curated: DataFrame, master: DataFrame, blacklist: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(phrase, n_tokens, segment, sub_segment, product, confidence), and curated rows of
    unknown products.

    Curated phrases (phrase, product) have high confidence; product labels of two words and six
    characters or more have medium. The segment pair is a product's most frequent one.
    """
    pairs = master.groupBy("product", "segment", "sub_segment").agg(F.count("*").alias("n"))
    pairs = first_by(pairs, ["product"], [F.desc("n"), "segment", "sub_segment"]).drop("n")
    own = pairs.withColumn("phrase", X.norm_phrase("product")).filter(
        (F.size(F.split("phrase", " ")) >= 2) & (F.length("phrase") >= 6) & ~F.col("phrase").isin(*blacklist, "")
    )
    known = curated.withColumn("phrase", X.norm_phrase("phrase")).join(pairs, "product", "left")
    high = known.filter("segment is not null").withColumns({"confidence": F.lit("high"), "rank": F.lit(0)})
    med = own.withColumns({"confidence": F.lit("med"), "rank": F.lit(1)})
    rows = first_by(high.unionByName(med), ["phrase"], ["rank", "product"])
    phrases = rows.select("phrase", F.size(F.split("phrase", " ")).alias("n_tokens"), "segment", "sub_segment", "product", "confidence")
    return phrases, known.filter("segment is null").select("phrase", "product")


def build_makers(aliases: DataFrame, harvested: DataFrame) -> DataFrame:
    """(core, n_tokens, len, canonical): curated cores win over harvested ones."""
    rows = aliases.withColumn("rank", F.lit(0)).unionByName(harvested.withColumn("rank", F.lit(1)))
    rows = first_by(rows.withColumn("core", X.norm_party("core")).filter("core <> ''"), ["core"], ["rank", "canonical"])
    return rows.select("core", F.size(F.split("core", " ")).alias("n_tokens"), F.length("core").alias("len"), "canonical")


def build_reference_keys(strict: DataFrame, generic: DataFrame) -> dict[str, DataFrame]:
    """The key tables of the reference gate.

    full_exact, generic_exact and category_exact have a normalised ``key``; full_loose,
    generic_loose and category_loose give the canonical labels of a loose key: the first by name,
    for categories the most frequent; player_family has the keys of makers with families.
    """
    def keyed(df, norm, columns, extra=()):
        return df.select(F.concat_ws("|", *map(norm, columns)).alias("key"), *columns, *extra)

    def loose(df):
        return first_by(keyed(df, X.norm_loose, DIMENSIONS), ["key"], DIMENSIONS)

    votes = keyed(strict, X.norm_loose, CATEGORY).groupBy("key", *CATEGORY).agg(F.count("*").alias("n"))
    return {
        "full_exact": keyed(strict, X.norm_exact, DIMENSIONS).select("key").distinct(),
        "full_loose": loose(strict),
        "generic_exact": first_by(keyed(generic, X.norm_exact, DIMENSIONS), ["key"], DIMENSIONS),
        "generic_loose": loose(generic),
        "category_exact": keyed(strict, X.norm_exact, CATEGORY).select("key").distinct(),
        "category_loose": first_by(votes, ["key"], [F.desc("n"), *CATEGORY]).drop("n"),
        "player_family": keyed(strict, X.norm_loose, ("player", "family")).select("key").distinct(),
    }


def cue_shares(lexicon: DataFrame, cues: Iterable[str], min_n: int = 2, eps: float = 0.02) -> DataFrame:
    """(cue, segment, share): how labels that hold a cue spread over segments.

    Each distinct (label, segment) of products and sub-segments votes once; cues with fewer than
    ``min_n`` votes and shares below ``eps`` are left out.
    """
    labels = lexicon.select(F.col("product").alias("label"), "segment").unionByName(lexicon.select(F.col("sub_segment").alias("label"), "segment"))
    labels = labels.filter((X.text("label") != "") & (X.text("segment") != "")).distinct()
    words = labels.select("segment", F.explode(X.cue_tokens("label")).alias("cue")).filter(F.col("cue").isin(*cues))
    counts = words.groupBy("cue", "segment").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("cue"))
    return counts.withColumns({"total": total, "share": F.col("n") / total}).filter(
        (F.col("total") >= min_n) & (F.col("share") >= eps)
    ).select("cue", "segment", "share")


def vocabulary(df: DataFrame, columns: Iterable[str], stop: Iterable[str] = ()) -> DataFrame:
    """(token): all tokens of the label columns."""
    arrays = F.array_union(*[X.tokens(c, 3, stop) for c in columns]) if len(list(columns)) == 2 else F.flatten(F.array(*[X.tokens(c, 3, stop) for c in columns]))
    return df.select(F.explode(arrays).alias("token")).distinct()


def harvest_keywords(train: DataFrame, min_rows: int = 5, min_present: float = 0.6, min_purity: float = 0.8) -> DataFrame:
    """Families (family, text, label) that are learned as keywords: enough rows, the name
    mostly stands in the text, and one label dominates."""
    rows = train.withColumn("keyword", X.norm_exact("family")).filter(F.length("keyword") >= 4)
    rows = rows.withColumn("present", F.lower(X.text("text")).contains(F.col("keyword")).cast("int"))
    stats = rows.groupBy("keyword").agg(F.count("*").alias("n_rows"), F.avg("present").alias("present"))
    pure = dominant(rows, ["keyword"], "label").select("keyword", "label", F.col("share").alias("purity"))
    return stats.join(pure, "keyword").filter(
        (F.col("n_rows") >= min_rows) & (F.col("present") >= min_present) & (F.col("purity") >= min_purity)
    )


def harvest_makers(train: DataFrame, min_rows: int = 5, min_len: int = 5) -> DataFrame:
    """(core, canonical, n_rows): maker names with a letter, long and frequent enough."""
    rows = train.withColumn("core", X.norm_party("maker")).filter((F.length("core") >= min_len) & F.col("core").rlike("[a-z]"))
    names = dominant(rows, ["core"], "maker")
    return names.filter(F.col("total") >= min_rows).select("core", F.col("maker").alias("canonical"), F.col("total").alias("n_rows"))


def fuzzy_targets(names: DataFrame, column: str, generic: Iterable[str] = (), least: int = 6, most: int = 18) -> DataFrame:
    """(name): names of one word of 6 to 18 letters that aren't generic."""
    rows = names.select(X.norm_text(column).alias("name")).distinct()
    return rows.filter(F.col("name").rlike(f"^[a-z]{{{least},{most}}}$") & ~F.col("name").isin(*generic, ""))


def retrieval_objects(master: DataFrame, aliases: DataFrame, exclusions: DataFrame, examples: DataFrame) -> DataFrame:
    """(object_id, object_type, target_id, player, family, retrieval_text) of all sources.

    ``aliases`` and ``examples`` have target columns as the master and a text; ``exclusions`` has
    term and category.
    """
    target = X.target_id(*DIMENSIONS)

    def typed(df, kind, words, target_id=target, player=F.col("player"), family=F.col("family")):
        return df.select(
            F.concat_ws(":", F.lit(kind), F.substring(F.md5(F.concat_ws("|", target_id, words)), 1, 16)).alias("object_id"),
            F.lit(kind).alias("object_type"), target_id.alias("target_id"), player.alias("player"), family.alias("family"),
            X.norm_text(words).alias("retrieval_text"),
        )

    none = F.lit("")
    out = typed(master, "target", F.concat_ws(" ", *DIMENSIONS))
    out = out.unionByName(typed(aliases, "alias", F.concat_ws(" ", "text", "product")))
    out = out.unionByName(typed(exclusions, "exclusion", F.col("term"), F.concat(F.lit("exclude|"), F.col("category")), none, none))
    return out.unionByName(typed(examples, "example", F.col("text"))).dropDuplicates(["object_id"])


def as_rows(spark, mapping: Mapping[str, str], key: str, value: str) -> DataFrame:
    """A small mapping as a DataFrame of two columns."""
    return spark.createDataFrame(sorted(mapping.items()), f"{key} string, {value} string")
