"""Registries of stages and rules, and what an audit makes of them."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from tradeweave.operators import audit
from tradeweave.operators.registry import Registry
from tradeweave.sources import fixtures as fx

PARCELS = {
    "registry_version": 7,
    "inputs": {"damaged": "boolean"},
    "stages": [
        {
            "stage_id": "gate", "execution_order": 30, "documentation_label": "Gate", "stage_type": "terminal", "outcomes": ["Out", "Back"], "row_continues": {"Out": False, "Back": False},
            "reason_precedence": ["broken", "fine"], "cases": [{"reason": "fine", "outcome": "Out"}, {"reason": "broken", "outcome": "Back", "when": "damaged"}],
        },
        {
            "stage_id": "scale", "execution_order": 10, "version": "2", "documentation_label": "Scale", "stage_type": "candidate", "outcomes": ["Light", "Heavy", "Refused"],
            "row_continues": {"Light": True, "Heavy": True, "Refused": False}, "reason_precedence": ["too_heavy", "heavy", "light"], "applies": "weight is not null",
            "cases": [
                {"reason": "light", "outcome": "Light"}, {"reason": "heavy", "outcome": "Heavy", "when": "weight > 10", "text": "concat('weighs ', cast(weight as int))"},
                {"reason": "too_heavy", "outcome": "Refused", "when": "weight > 30"},
            ],
        },
        {"stage_id": "board", "execution_order": 40, "stage_type": "presentation", "outcomes": ["Shown"], "row_continues": {"Shown": False}},
    ],
    "rules": [
        {"rule_id": "heavy", "stage_id": "scale", "when": "weight > 10", "evidence": "cast(weight as string)", "precedence": 2},
        {"rule_id": "torn", "stage_id": "gate", "when": "damaged", "reason": "concat('torn: ', name)", "precedence": 1, "counts": False},
        {"rule_id": "named", "stage_id": "gate", "when": "name is not null"},
    ],
}
ROWS = [("a", 5.0, False), ("b", 20.0, True), ("c", 40.0, True), (None, None, None)]


def found(spark, spec, schema="name string, weight double, damaged boolean", rows=ROWS):
    r = Registry.of(spec)
    df = r.prepared(spark.createDataFrame(rows, schema)).withColumns({"tier": F.lit("Review"), "primary_reason": F.lit("x")})
    out = df.select("name", r.path().alias("path"), r.hits().alias("hits"), r.first_reason().alias("why")).collect()
    return {x.name: ([(s.stage_id, s.outcome, s.reason, s.continues) for s in x.path], [tuple(h) for h in x.hits], x.why and tuple(x.why)) for x in out}


def test_stages_and_rules_come_from_data(spark):
    got = found(spark, PARCELS)
    assert got["a"] == ([("scale", "Light", "light", True), ("gate", "Out", "fine", False)], [("gate", "named", "1")], None)
    assert got["b"] == ([("scale", "Heavy", "weighs 20", True), ("gate", "Back", "broken", False)], [("scale", "heavy", "20.0"), ("gate", "named", "1")], ("torn: b", "gate"))
    assert got["c"][0] == [("scale", "Refused", "too_heavy", False)]  # it doesn't go on
    assert got[None] == ([("gate", "Out", "fine", False)], [], None)


def test_other_names_and_precedence_give_other_paths(spark):
    """The same rows under a second registry; an input that the table lacks is null."""
    other = copy.deepcopy(PARCELS)
    other["stages"][1] |= {"stage_id": "Waage", "reason_precedence": ["heavy", "too_heavy", "light"]}
    other["rules"][0] |= {"stage_id": "Waage", "precedence": 0}
    got = found(spark, other, "name string, weight double", [r[:2] for r in ROWS])
    assert got["c"] == ([("Waage", "Heavy", "weighs 40", True), ("gate", "Out", "fine", False)], [("Waage", "heavy", "40.0"), ("gate", "named", "1")], ("heavy", "Waage"))


@pytest.mark.parametrize("change, said", [
    (lambda s: s["stages"][0].update(execution_order=10), "execution_order 10 repeats"),
    (lambda s: s["stages"][1].update(stage_id="gate"), "stage gate repeats"),
    (lambda s: s["stages"][1]["cases"][0].update(outcome="Odd"), "outcome Odd of light isn't declared"),
    (lambda s: s["stages"][1]["cases"][0].update(reason="odd"), "case odd isn't in reason_precedence"),
    (lambda s: s["stages"][1].update(row_continues={"Light": True}), "row_continues isn't about its outcomes"),
    (lambda s: s["stages"][0].update(row_continues={"Out": True, "Back": False}), "the last stage, gate, lets rows go on"),
    (lambda s: s["rules"][0].update(stage_id="nowhere"), "no stage nowhere"),
    (lambda s: s["rules"][0].update(precedence=1), "precedence 1 repeats"),
    (lambda s: s["rules"].append(s["rules"][0]), "repeats"),
    (lambda s: s.update(stages=[]), "no stage has cases"),
])
def test_unsound_registries_are_told(change, said):
    spec = copy.deepcopy(PARCELS)
    change(spec)
    with pytest.raises(ValueError, match=said):
        Registry.of(spec)


def test_expressions_must_suit_the_table(spark):
    spec = copy.deepcopy(PARCELS)
    spec["rules"][0]["when"], spec["rules"][1]["reason"] = "weight + 1", "no_such(name)"
    spec["stages"][1]["cases"][1]["when"] = "width > 1"
    with pytest.raises(ValueError) as e:
        Registry.of(spec).prepared(spark.createDataFrame(ROWS, "name string, weight double, damaged boolean"))
    assert all(w in str(e.value) for w in ("rule heavy: weight + 1 is double, not boolean", "rule torn", "stage scale, heavy: width > 1"))


def test_registry_file_and_its_stages(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps(PARCELS))
    rows = [tuple(r) for r in audit.registry_stages(spark, str(path)).orderBy("execution_order").collect()]
    assert rows[0] == ("scale", "2", 10, "Scale", "candidate", ["Light", "Heavy", "Refused"], ["too_heavy", "heavy", "light"], ["Light", "Heavy"])
    assert [r[0] for r in rows] == ["scale", "gate", "board"] and Registry.read(spark, str(path)).last == "gate"


def mapped_rows(spark):
    columns = "row_id string, description string, importer string, exporter string, country string, maker string, family string, product string, match_tier string, match_scope string, ref_valid string, scope_flag string, qa_status string, include string, value string, quantity string"
    row = lambda k, tier, status, inc, c, v, flag="": (f"r{k}", "red plate", "i", "e", c, "m", "f", "p", tier, "core", "Y" if inc else "", flag, status, inc, v, "2")
    rows = [row(k, "family", "Mapped", "Y", "A", str(k)) for k in range(40)] + [row(100 + k, "category", "Review - x", "", "AB"[k % 2], "3") for k in range(20)]
    return spark.createDataFrame(rows + [row(200, "", "Unmapped", "", "B", "x"), row(201, "manufacturer", "Audit - m", "", "B", "7", "s")], columns)


def test_facts_under_two_registries(spark):
    """Path, hits, reason and funnel follow whichever registry is brought; inputs that lack count as null."""
    own = Registry.of(fx.REGISTRY)
    facts = audit.row_facts(mapped_rows(spark), "row_id", own)
    by = {r.row_id: r for r in facts.collect()}
    assert [s.stage_id for s in by["r201"].path] == ["naming", "reading", "border", "desk"]
    assert (by["r201"].primary_reason, by["r201"].removal_stage) == ("beyond: s", "border")
    assert {h.rule_id for h in by["r201"].hits} == {"beyond_scope", "plate_cue", "guessed"}
    funnel = {(r.output_id, r.stage_id, r.outcome): r for r in audit.funnel(facts, own.stage_table(spark)).collect()}
    assert funnel["OVERALL", "desk", "Trusted"].n_rows == 40 and funnel["OVERALL", "desk", "Trusted"].label == "Decision"
    assert funnel["B", "naming", "Nameless"].invalid_value == 1

    stop = {"stages": [
        {"stage_id": "in", "execution_order": 1, "documentation_label": "First", "outcomes": ["On", "Off"], "row_continues": {"On": True, "Off": False}, "reason_precedence": ["unmapped", "mapped"],
         "cases": [{"reason": "mapped", "outcome": "On"}, {"reason": "unmapped", "outcome": "Off", "when": "match_tier = ''"}]},
        {"stage_id": "out", "execution_order": 2, "documentation_label": "Last", "outcomes": ["End"], "row_continues": {"End": False}, "reason_precedence": ["end"], "cases": [{"reason": "end", "outcome": "End", "text": "primary_reason"}]},
    ]}
    second = Registry.of(stop)
    facts = audit.row_facts(mapped_rows(spark), "row_id", second)
    funnel = {(r.stage_id, r.outcome): (r.n_rows, r.label) for r in audit.funnel(facts, second.stage_table(spark)).collect() if r.output_id == "OVERALL"}
    assert funnel == {("in", "On"): (61, "First"), ("in", "Off"): (1, "First"), ("out", "End"): (61, "Last")}
    assert {r.primary_reason for r in facts.collect()} == {"accepted", "Review - x", "Audit - m", "Unmapped"}


def test_cube_is_summed_from_groups(spark):
    """The rows that expand to the coarser levels are sums, not facts, and the levels agree with each other."""
    facts = audit.row_facts(mapped_rows(spark), "row_id", Registry.of(fx.REGISTRY))
    cube = audit.removal_cube(facts)
    plan = cube._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate")  # printed from the top: an aggregate lies below
    rows = cube.collect()
    for kind, tier in (("Primary", "Review"), ("Primary", "Excluded"), ("Secondary", "Trusted")):
        level = {lv: sum(r.n_rows for r in rows if (r.kind, r.tier, r.output_id, r.level) == (kind, tier, "OVERALL", lv)) for lv in ("", "maker", "maker+family+product")}
        assert len(set(level.values())) == 1 and level[""] > 0


def test_sample_has_fixed_sizes(spark):
    facts = audit.row_facts(mapped_rows(spark), "row_id", Registry.of(fx.REGISTRY))
    sample = audit.Sample({"Guessed": "match_tier = 'manufacturer'", "Not trusted": "tier <> 'Trusted'"}, targeted=3, random={"Trusted": 5, "Review": 2, "Excluded": 1})
    rows = audit.review_sample(facts, sample).collect()
    by = {}
    for r in rows:
        by.setdefault((r.output_id, r.sample_type), []).append(r)
    assert [len(by["A", t]) for t in (audit.TARGETED_TYPE, audit.RANDOM_TYPE)] == [3, 7] and len({r.row_id for r in rows}) == len(rows)
    assert by["B", audit.TARGETED_TYPE][0].stratum == "Guessed" or "Guessed" in {r.stratum for r in by["B", audit.TARGETED_TYPE]}
