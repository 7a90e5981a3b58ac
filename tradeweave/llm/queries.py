"""The registered queries of this subpackage: thin views of its operators over whole tables."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, exact_dedup, jaccard_join, language_id, lexical_search, line_dedup, merkle, packing, quality, secret_scan, url_filter, warc

from .common import small_batches

#: The vocabulary of the pipeline and of op8; a parameter of the operators.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spans, keep=None):
    if keep is not None:
        spans = F.filter(spans, keep)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, secret_scan.KINDS),
        F.sha2(_joined("spans", lambda s: s["kind"] != "crf"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).drop("valid")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path(), digests=True)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, capitals = table(spark, sf_dir, "documents"), string.ascii_uppercase
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", capitals, capitals.lower())).otherwise(F.col("text"))
    return merkle.manifest(docs, claimed={"text": tampered}).drop("proof")


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenized_pieces(table(spark, sf_dir, "documents"), tokenizer_path(), keep_ids=False)
    return packing.pack(pieces)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_secret_scan, op2_line_dedup, op3_exact_dedup, op4_warc, op5_quality, op6_url_filter,
        op7_language_id, op8_bpe, op9_decontaminate, op10_jaccard_join, op11_merkle_manifest, op12_best_fit_packing, op13_lexical_search, pipeline,
    )
    return {f.__name__: f for f in own}


_OP2 = r"""
WITH pieces AS (
  SELECT doc_id, text, coalesce(source, '') AS site, string_split(coalesce(text, ''), chr(10)) AS p FROM documents
), lines AS (
  SELECT doc_id, md5(coalesce(text, '')) AS of_, site, i - 1 AS pos, trim(p[i], ' ') AS t
  FROM pieces, unnest(range(1, len(p) + 1)) AS u(i) WHERE length(trim(p[i], ' ')) >= 20
), spread AS (
  SELECT t, min({'a': doc_id, 'b': of_, 'c': pos}) AS f FROM lines GROUP BY t HAVING count(DISTINCT site) >= 5
), gone AS (
  SELECT l.doc_id, l.of_, list(DISTINCT l.pos) AS g FROM lines l JOIN spread s USING (t)
  WHERE {'a': l.doc_id, 'b': l.of_, 'c': l.pos} <> s.f GROUP BY ALL
)
SELECT p.doc_id, CASE WHEN p.text IS NULL THEN 0 ELSE len(p.p) END AS n_lines, coalesce(len(g.g), 0) AS n_removed,
  sha256(coalesce(array_to_string([p.p[i] FOR i IN range(1, len(p.p) + 1) IF NOT coalesce(list_contains(g.g, i - 1), false)], chr(10)), '')) AS text_sha256
FROM pieces p LEFT JOIN gone g ON p.doc_id = g.doc_id AND md5(coalesce(p.text, '')) = g.of_
"""

_OP3 = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g') AS n FROM documents
), k AS (
  SELECT doc_id, n, min(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size FROM t
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(n) AS text_sha256 FROM k
"""

_OP4 = r"""
WITH t AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), k AS (
  SELECT page_id, h, octet_length(encode(h)) AS n, max(page_id) OVER (PARTITION BY h) AS m FROM t
)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN n >= 1000 AND m <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND m <> page_id THEN m END AS refers_to
FROM k
"""

_OP9 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS k
  FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT n FROM win
), spots AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n
), found AS (
  SELECT a.doc_id, a.i, a.n, win.item_id FROM spots a JOIN win USING (n, k)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) AS u(p) GROUP BY doc_id
), items AS (
  SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM found GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""



def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE octet_length(encode({x}::VARCHAR)) || ':' || {x} END"


def _op11(levels: int = 8, over: int = 4) -> str:
    """Trees of up to 8**levels leaves and 8**over groups, level by level: n* are nodes, s* siblings, f* folds."""

    def up(name, source, k):
        return (
            f"{name}{k} AS (SELECT g, pos // 8 AS pos, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE min(h) END AS h FROM {source} GROUP BY g, pos // 8, n)"
        )

    def siblings(name, source, k):
        frame = "PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN"
        return (
            f"{name}{k} AS (SELECT g, pos, n > 1 AS up, coalesce(string_agg(h, '') OVER ({frame} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
            f"coalesce(string_agg(h, '') OVER ({frame} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {source})"
        )

    def fold(name, source, other, k):
        return f"{name}{k} AS (SELECT u, g, pos // 8 AS pos, proof || l || r AS proof, CASE WHEN up THEN sha256(l || x || r) ELSE x END AS x FROM {source} JOIN {other} USING (g, pos))"

    fields = lambda text: " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text)))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda e: ascii(e)::BIGINT)), lambda c, b: {step}), 4294967295)"
    parts = [
        f"leaves AS (SELECT row_number() OVER () AS u, doc_id, coalesce('=' || lang, '') AS g, sha256({fields('text')}) AS h, "
        f"CASE WHEN {crc} % 3 = 0 THEN sha256({fields(lower)}) END AS other FROM documents)",
        "d AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves)",
        "n0 AS (SELECT g, pos, n, h FROM d)", "f0 AS (SELECT u, g, pos, '' AS proof, coalesce(other, h) AS x FROM d)",
    ]
    for k in range(levels):
        parts += [up("n", f"n{k}", k + 1), siblings("s", f"n{k}", k), fold("f", f"f{k}", f"s{k}", k + 1)]
    top = f"n{levels}"
    parts += [
        f"roots AS (SELECT g AS of_, h AS subroot, '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM {top})",
        "m0 AS (SELECT g, pos, n, subroot AS h FROM roots)",
        f"e0 AS (SELECT u, '' AS g, r.pos, proof, x FROM f{levels} f JOIN roots r ON f.g = r.of_)",
    ]
    for k in range(over):
        parts += [up("m", f"m{k}", k + 1), siblings("t", f"m{k}", k), fold("e", f"e{k}", f"t{k}", k + 1)]
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, d.h AS leaf, subroot, m.h AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = m.h AS verified "
        f"FROM d JOIN roots ON d.g = of_ JOIN e{over} e USING (u), m{over} m"
    )


_OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS u, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark
), s AS (
  SELECT count(*) AS big_n, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0
), tf AS (
  SELECT u, doc_id, n, t, count(*) AS tf FROM (SELECT u, doc_id, len(w) AS n, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL
), df AS (
  SELECT t, floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, s GROUP BY t, big_n
), scored AS (
  SELECT item_id, u, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // total))))::BIGINT AS score
  FROM q JOIN df USING (t) JOIN tf USING (t), s GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL expresses; the others have brute-force tests."""
    return {"op2_line_dedup": _OP2, "op3_exact_dedup": _OP3, "op4_warc": _OP4, "op9_decontaminate": _OP9, "op11_merkle_manifest": _op11(), "op13_lexical_search": _OP13}
