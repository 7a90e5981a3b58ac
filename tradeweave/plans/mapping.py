"""The mapping run: dictionaries, cascade, guards, labels, gate."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.functions import predicates as P
from tradeweave.functions import text as X
from tradeweave.operators import gate, guards, lexicon, mapping, match
from tradeweave.sources.tables import staged


@dataclass
class Rules:
    """What a domain brings along: code sets, cues, heads and patterns."""

    core: tuple = ()
    exclude: tuple = ()
    heads: tuple = ()
    negative: tuple = ()
    guard_rules: list = field(default_factory=list)
    scope_groups: dict = field(default_factory=dict)
    whitelist: str | None = None
    generic: tuple = ()
    capital: str | None = None


TEXT, PARTIES = ("description", "hs4", "hs_code"), ("importer", "exporter")


def judge_texts(rows: DataFrame, strict: DataFrame, curated: DataFrame, rules: Rules, keywords: DataFrame | None = None) -> DataFrame:
    """M6, G1, A1 and A2 over the distinct texts, with their codes, of trade rows (a table): the cascade with
    released hits, then standard labels. A text is there twice, by whether its row's parties hold a maker."""
    keywords = staged(lexicon.build_keywords(strict) if keywords is None else keywords, "keywords")
    phrases = staged(lexicon.build_phrases(curated, strict)[0], "phrases")
    allowed = P.match_allowed("hs4", rules.core, rules.exclude)

    texts = staged(distinct_texts(rows), "texts")
    hits = match.match_keywords(texts, "_text", "description", keywords, allowed, ["description", "hs_code", "n"])
    labelled = hits.join(keywords.select("keyword", "product", "segment"), "keyword")
    one = staged(labelled.filter(~guards.conflict("product", "description", rules.guard_rules)).select("_text", "keyword", "segment", "hs_code", "n"), "family")
    segments = match.code_segments(one, "hs_code", weight="n")
    rest = texts.join(one.select("_text"), "_text", "left_anti")
    two = match.match_category(rest, "_text", "description", "hs_code", phrases, rules.heads, segments, rules.negative, allowed)
    tiers = one.select("_text", "keyword", F.lit("family").alias("tier")).unionByName(two.withColumn("tier", F.lit("category")), allowMissingColumns=True)
    labels = mapping.match_labels(tiers.withColumn("maker", F.lit(None).cast("string")), "_text", keywords)
    return mapping.standard_labels(mapping.assemble_texts(texts.drop("n"), "_text", labels, allowed, "hs4", rules.core))


def distinct_texts(rows: DataFrame) -> DataFrame:
    """(_text, TEXT, n): each distinct text with its codes, its id, and how many rows have it."""
    return match.with_ids(rows.groupBy(*TEXT).agg(F.count("*").alias("n")), {"_text": TEXT})


def gate_texts(judged: DataFrame, strict: DataFrame, generic: DataFrame, rules: Rules) -> DataFrame:
    """The gate over judged texts (a table: the gate reads it several times): what it looks at is a row's text,
    its codes and its labels."""
    keys = {k: staged(d, k) for k, d in lexicon.build_reference_keys(strict, generic).items()}
    return gate.apply_gate(judged, keys, "description", rules.scope_groups, rules.whitelist, rules.generic, rules.capital)


def map_rows(rows: DataFrame, judged: DataFrame, makers: Mapping[str, DataFrame]) -> DataFrame:
    """Trade rows with the labels of their texts (judged or gated, a table), the maker of their parties where
    that decides, and the unit price. Where judged texts and makers are small, no row is shuffled."""
    found = match.with_maker(match.with_ids(rows, {"_text": TEXT}), PARTIES, makers, "_maker")
    out = mapping.labelled_rows(found, "_text", judged.drop(*TEXT), "_maker")
    return out.withColumn("unit_price", X.unit_price(X.number("value"), X.number("quantity")))
