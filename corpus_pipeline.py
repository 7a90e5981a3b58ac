"""A corpus through five operators: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave.llm import bpe, common, decontam, jaccard_join, language_id, line_dedup
from tradeweave.llm.queries import table, tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no language: null texts, texts without letters, and texts that share no
    n-gram with any profile. Profiles are learned from all rows with a lang. Rows that repeat are judged
    each, texts of any length as a whole; an empty table stays empty; columns may have any names, the
    verdict's too, and types."""
    common.small_batches(spark)
    profiles = language_id.train_profiles(docs)
    aside = {c: _unused(c, docs) for c in ("lang_pred", "score") if c in docs.columns}
    judged = language_id.predict(docs.withColumnsRenamed(aside), profiles)
    rejected = F.col("score") <= 0 if profiles else F.coalesce(~F.col("text").rlike(r"\p{L}"), F.lit(True))
    kept = judged.filter(~rejected).drop("lang_pred", "score")
    return kept.withColumnsRenamed({new: old for old, new in aside.items()}).select(*map(common.own, docs.columns))


def boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that spread over many sites from all places but the first. Documents stay, with a
    null text as with one that loses all lines; rows that repeat are treated alike; texts of any length
    count as a whole; an empty table stays empty. Columns may have any names and types, and those named
    like the operator's own, n_lines and n_removed, stay."""
    aside = {c: _unused(c, docs) for c in ("n_lines", "n_removed") if c in docs.columns}
    out = line_dedup.line_dedup(docs.withColumnsRenamed(aside))
    return out.drop("n_lines", "n_removed").withColumnsRenamed({new: old for old, new in aside.items()}).select(*map(common.own, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row, of the least doc_id, of each connected group; of rows with that doc_id the one
    with the least digest. Null and empty texts are groups of their own. Rows without doc_id are no
    partners: one of each set of word runs stays, or of each text that has no words. Texts of any length
    count as a whole; an empty table stays empty; columns may have any names and types."""
    groups = jaccard_join.jaccard_components(docs)
    heads = groups.filter("component_id = doc_id").select("doc_id").distinct()
    n, least = _unused("n", docs), _unused("least", docs)
    digest = common.row_digest(docs)
    rows = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias(n), F.min(digest).alias(least))
    first = common.saved(rows.join(heads, "doc_id", "left_semi"), "heads")
    once = docs.join(first.filter(F.col(n) == 1).select("doc_id"), "doc_id", "left_semi")
    again = docs.withColumn(least, digest).join(first.filter(F.col(n) > 1).select("doc_id", least), ["doc_id", least], "left_semi")
    nameless = jaccard_join.one_of_each_set(docs.filter("doc_id is null"))
    names = [*map(common.own, docs.columns)]
    return once.select(names).unionByName(again.select(names).dropDuplicates(["doc_id"])).unionByName(nameless)


def _unused(name: str, docs: DataFrame) -> str:
    """``name``, with so many underscores before it that ``docs`` has no such column."""
    name = f"_{name}"
    while name in docs.columns:
        name = f"_{name}"
    return name


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the passages of benchmark items; documents that mostly consist of them go. Null and empty
    texts stay; rows that repeat are treated alike; texts of any length count as a whole; an empty table
    stays empty; columns may have any names and types."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number of tokens of each text, and the digests of ids and decoded text. Null texts count as
    empty; rows that repeat are encoded each; texts of any length are encoded as a whole; other columns,
    whatever they are called, are left out; an empty table gives no rows."""
    return bpe.encode(docs, tokenizer_path(), digests=True)


STAGES = [
    ("language", language),
    ("boilerplate", boilerplate),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("encoded", encoded),
]

#: The stages use learned profiles and tokenizers, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet and read again."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = common.saved(stage(spark, docs, sf_dir), f"stage-{name}")
        common.dropped(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
