"""Views of the test tables in the shape of the engine's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import small

#: The code sets and rules that the test views use.
CORE, EXTENDED, EXCLUDED = (9018, 9019, 9021, 9022), (9020,), (9023,)
HEADS = ("ring", "plate", "gizmo")
NEGATIVE_CUES = ("hot",)
SCOPE_GROUPS = {"g1": r"\bold\b", "g2": r"\bsmall\b"}
WHITELIST = r"\bwidget\b"
GUARD_RULES = [{"product_cue": "gear", "forbid": ["blue"], "allow": ["large"]}]
CURATED_PHRASES = {"red bolt": "bolt", "cold rod": "rod"}
GENERIC = ("old", "new")

_CONTINUE = lambda *outcomes: dict.fromkeys(outcomes, True)
#: What becomes of a shipment of the test tables, told as a registry (operators.registry).
REGISTRY = {
    "registry_version": "3",
    "inputs": {"product_score": "double", "generic_risk": "boolean", "negative_group": "string"},
    "stages": [
        {
            "stage_id": "naming", "version": "1", "execution_order": 10, "documentation_label": "What names the goods", "stage_type": "candidate",
            "outcomes": ["Named", "Guessed", "Nameless"], "row_continues": _CONTINUE("Named", "Guessed", "Nameless"),
            "reason_precedence": ["own_name", "kind_of_goods", "guess", "unnamed"],
            "cases": [
                {"reason": "unnamed", "outcome": "Nameless"}, {"reason": "own_name", "outcome": "Named", "when": "match_tier = 'family'"},
                {"reason": "kind_of_goods", "outcome": "Named", "when": "match_tier = 'category'"},
                {"reason": "guess", "outcome": "Guessed", "when": "match_tier <> ''", "text": "concat('guess by ', match_tier)"},
            ],
        },
        {
            "stage_id": "reading", "version": "1", "execution_order": 20, "documentation_label": "What the text says", "stage_type": "candidate",
            "outcomes": ["Agreed", "Doubted"], "row_continues": _CONTINUE("Agreed", "Doubted"), "applies": "match_tier <> ''",
            "reason_precedence": ["contradicted", "supported", "silent"],
            "cases": [
                {"reason": "contradicted", "outcome": "Doubted", "when": "negative_group <> ''", "text": "concat('contradicted by ', negative_group)"},
                {"reason": "supported", "outcome": "Agreed", "when": "product_score > 0"}, {"reason": "silent", "outcome": "Doubted"},
            ],
        },
        {
            "stage_id": "listing", "version": "2", "execution_order": 25, "documentation_label": "In the list of goods", "stage_type": "candidate",
            "outcomes": ["Agreed", "Doubted"], "row_continues": _CONTINUE("Agreed", "Doubted"), "applies": "match_tier IN ('family', 'category')",
            "reason_precedence": ["listed", "unlisted"],
            "cases": [{"reason": "listed", "outcome": "Agreed", "when": "ref_valid = 'Y'"}, {"reason": "unlisted", "outcome": "Doubted"}],
        },
        {
            "stage_id": "border", "version": "1", "execution_order": 40, "documentation_label": "Within the trade looked at", "stage_type": "candidate",
            "outcomes": ["Dropped", "Doubted"], "row_continues": _CONTINUE("Dropped", "Doubted"), "reason_precedence": ["beyond", "at_the_edge"],
            "cases": [
                {"reason": "beyond", "outcome": "Dropped", "when": "scope_flag <> ''", "text": "scope_flag"},
                {"reason": "at_the_edge", "outcome": "Doubted", "when": "match_scope = 'extended'"},
            ],
        },
        {
            "stage_id": "desk", "version": "1", "execution_order": 90, "documentation_label": "Decision", "stage_type": "terminal",
            "outcomes": ["Trusted", "Review", "Excluded"], "row_continues": dict.fromkeys(("Trusted", "Review", "Excluded"), False),
            "reason_precedence": ["trusted", "review", "excluded"],
            "cases": [
                {"reason": "trusted", "outcome": "Trusted", "when": "tier = 'Trusted'", "text": "primary_reason"},
                {"reason": "review", "outcome": "Review", "when": "tier = 'Review'", "text": "primary_reason"}, {"reason": "excluded", "outcome": "Excluded", "text": "primary_reason"},
            ],
        },
        {
            "stage_id": "report", "version": "1", "execution_order": 95, "documentation_label": "Tables for readers", "stage_type": "presentation",
            "outcomes": ["Shown"], "row_continues": {"Shown": False}, "reason_precedence": ["summed"],
        },
    ],
    "rules": [
        {"rule_id": "precision", "stage_id": "reading", "when": "contains(lower(qa_status), 'precision')", "evidence": "qa_status", "precedence": 1},
        {"rule_id": "beyond_scope", "stage_id": "border", "when": "scope_flag <> ''", "evidence": "scope_flag", "reason": "concat('beyond: ', scope_flag)", "precedence": 2},
        {"rule_id": "contradiction", "stage_id": "reading", "when": "negative_group <> ''", "evidence": "negative_group", "precedence": 3},
        {"rule_id": "not_listed", "stage_id": "listing", "when": "match_tier IN ('family', 'category') AND ref_valid <> 'Y'", "precedence": 4, "counts": False},
        {"rule_id": "vague", "stage_id": "reading", "when": "generic_risk OR description LIKE '%small%plate%'", "precedence": 5},
        {"rule_id": "plate_cue", "stage_id": "naming", "when": "contains(description, 'plate')", "evidence": "'plate'"},
        {"rule_id": "missed", "stage_id": "desk", "when": "include <> 'Y' AND product_score > 0", "evidence": "cast(cast(product_score as int) as string)"},
        {"rule_id": "guessed", "stage_id": "naming", "when": "match_tier IN ('manufacturer', 'hs_prior')", "evidence": "match_tier"},
    ],
}
#: A second one, of the event stream: rows stop at the first stage that ends them.
EVENT_REGISTRY = {
    "stages": [
        {
            "stage_id": "arrival", "execution_order": 1, "documentation_label": "Arrival", "stage_type": "candidate", "outcomes": ["In", "Void"], "row_continues": {"In": True, "Void": False},
            "reason_precedence": ["worthless", "counted"], "cases": [{"reason": "counted", "outcome": "In"}, {"reason": "worthless", "outcome": "Void", "when": "value < 20"}],
        },
        {
            "stage_id": "size", "execution_order": 2, "documentation_label": "Size", "stage_type": "candidate", "outcomes": ["Large"], "row_continues": {"Large": True},
            "reason_precedence": ["large"], "cases": [{"reason": "large", "outcome": "Large", "when": "value >= 60"}],
        },
        {
            "stage_id": "end", "execution_order": 3, "documentation_label": "End", "stage_type": "terminal", "outcomes": ["Done"], "row_continues": {"Done": False},
            "reason_precedence": ["done"], "cases": [{"reason": "done", "outcome": "Done", "text": "event_type"}],
        },
    ],
    "rules": [{"rule_id": "even_user", "stage_id": "arrival", "when": "user_id % 2 = 0", "evidence": "cast(user_id as string)"}],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item, all text, as free-text trade rows are."""
    t = lambda n: table(spark, sf_dir, n)
    line, part, order = t("lineitem"), t("part"), t("orders")
    supplier = t("supplier").join(t("nation").select("n_nationkey", F.col("n_name").alias("exporter_country")), F.col("s_nationkey") == F.col("n_nationkey"))
    customer = t("customer").join(t("nation").select("n_nationkey", F.col("n_name").alias("country")), F.col("c_nationkey") == F.col("n_nationkey"))
    # Lines travel narrow: orders get their customers before, and the widest columns, the parts', come last.
    sold = order.join(customer.drop("n_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    rows = (
        line.join(sold, line.l_orderkey == F.col("o_orderkey"))
        .join(supplier.drop("n_nationkey"), line.l_suppkey == F.col("s_suppkey"))
        .join(part, line.l_partkey == part.p_partkey)
    )
    hs4 = F.lit(9018) + F.col("p_size") % 6
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("long")).alias("row_id"),
        F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("description"),
        hs4.cast("string").alias("hs4"),
        (hs4 * 10000 + F.col("p_size") * 10).cast("string").alias("hs_code"),
        F.col("c_name").alias("importer"),
        F.col("s_name").alias("exporter"),
        "country",
        "exporter_country",
        F.year("o_orderdate").cast("string").alias("year"),
        F.month("o_orderdate").cast("string").alias("month"),
        F.col("l_quantity").cast("string").alias("quantity"),
        F.col("l_extendedprice").cast("string").alias("value"),
    )


#: The same view in DuckDB's SQL.
SHIPMENTS_SQL = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * 100)::BIGINT) AS row_id,
  concat_ws(' ', p_name, p_type, p_brand) AS description,
  (9018 + p_size % 6)::VARCHAR AS hs4, ((9018 + p_size % 6) * 10000 + p_size * 10)::VARCHAR AS hs_code,
  c_name AS importer, s_name AS exporter, cn.n_name AS country, sn.n_name AS exporter_country,
  year(o_orderdate)::VARCHAR AS year, month(o_orderdate)::VARCHAR AS month,
  l_quantity::VARCHAR AS quantity, l_extendedprice::VARCHAR AS value
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey
"""


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference list: distinct labels of the parts, flagged generic for some."""
    word = F.split("p_name", " ")
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("segment"),
        F.col("p_brand").alias("sub_segment"),
        word[1].alias("product"),
        F.col("p_brand").alias("player"),
        F.col("p_name").alias("family"),
        F.when(word[0].isin(*GENERIC), "generic").otherwise("").alias("generic_flag"),
    ).distinct()


MASTER_SQL = """
SELECT DISTINCT p_type AS segment, p_brand AS sub_segment, split_part(p_name, ' ', 2) AS product, p_brand AS player,
  p_name AS family, CASE WHEN split_part(p_name, ' ', 1) IN ('old', 'new') THEN 'generic' ELSE '' END AS generic_flag
FROM part
"""


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows for priors and evaluation: the label is the quality, the code the source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang", "n_chars")
    labels = small(table(spark, sf_dir, "labels"), 2_000_000)  # three numbers each, so that texts stay where they are
    return docs.join(labels, "doc_id").select(
        "doc_id", "text", F.col("source").alias("code"), F.col("lang").alias("maker"),
        F.concat(F.lit("q"), F.col("quality").cast("string")).alias("label"),
        F.concat(F.lit("t"), F.col("toxic").cast("string")).alias("parent"),
        F.col("n_chars").alias("value"),
    )


LABELLED_SQL = """
SELECT doc_id, text, source AS code, lang AS maker, 'q' || quality AS label, 't' || toxic AS parent, n_chars AS value
FROM documents JOIN labels USING (doc_id)
"""
