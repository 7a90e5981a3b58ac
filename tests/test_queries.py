"""Queries on the smallest tables against DuckDB."""

import decimal
import os

import duckdb
import pytest

from tradeweave.plans import queries as q

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: One or more of each family; the driver runs them all.
NAMES = [
    "n03_norm_phrase", "n14_family_features", "n20_number_status", "n26_row_key", "n27_hash_bucket", "p09_risk_token", "p11_product_evidence",
    "flagship_value_bounds", "l04_canonical_labels", "l10_cue_shares", "m01_match_keywords", "m02_match_phrases", "m09_fuzzy_match", "g02_inconsistent",
    "r01_validate_families", "r07_gate", "d04_roll_up", "k12_score_families", "k13_apply_product_prior", "e10_route_rows", "e13_apply_guards",
    "q02_top_candidates", "q18_gold_template", "v04_by_dimension", "c06_compare_aggregates", "u02_primary_reason", "u03_stage_path", "u04_rule_hits", "u06_risk_inventory", "u10_funnel", "u12_review_sample", "u13_reconciliation", "u14_sample_view", "t1_shortlist", "s05_active_terms", "c01_output_invariants", "c04_partition_reconciliation", "v02_agrees", "k08_transfer_prior_contained",
    "s01_read_delimited", "s10_write_and_read_slices", "s11_ground_truth", "u15_registry_stages",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    return con


def plain(v):
    return round(float(v), 6) if isinstance(v, (float, decimal.Decimal)) else v


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables here")
@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, duck, name):
    df = q.QUERIES[name](spark, DIR)
    found = duck.execute(q.SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(plain(v) for v in r) for r in found.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr) == want


def test_every_sql_has_a_query():
    assert set(q.SQL) <= set(q.QUERIES)
