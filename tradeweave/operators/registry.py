"""Rule registries: the stages and rules of an audit as data, compiled to column expressions.

A registry is JSON. Its predicates are SQL expressions over the audited table, and over ``tier`` and
``primary_reason`` in stages::

    {"registry_version": "1", "inputs": {"damaged": "boolean"},
     "stages": [{"stage_id": "weighed", "execution_order": 10, "documentation_label": "Weight", "stage_type": "candidate",
                 "outcomes": ["Passed", "Stopped"], "row_continues": {"Passed": true, "Stopped": false},
                 "reason_precedence": ["too_heavy", "fits"], "applies": "weight is not null",
                 "cases": [{"reason": "too_heavy", "outcome": "Stopped", "when": "weight > 30"}, {"reason": "fits", "outcome": "Passed"}]}],
     "rules": [{"rule_id": "heavy", "stage_id": "weighed", "when": "weight > 25", "evidence": "cast(weight as string)", "precedence": 1}]}

Of a stage's cases the one whose reason comes first in ``reason_precedence`` and that holds gives a row's
outcome there; rows that no case fits, or that ``applies`` leaves out, aren't at the stage. A row whose
outcome doesn't continue is at no later stage. A rule with ``precedence`` can be a row's primary reason;
one with ``counts`` (the default) is a hit. ``text`` of a case and ``reason`` of a rule are SQL for the
reason's wording where it isn't the plain name. ``inputs`` are columns that a table may lack: null then.
Stages without cases, such as a presentation, are documentation.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STEP = "struct<stage_id:string,outcome:string,reason:string,continues:boolean>"
_HIT = "struct<stage_id:string,rule_id:string,evidence:string>"
#: What a registry table shows of a stage.
STAGE_FIELDS = (
    "stage_id string, version string, execution_order int, label string, stage_type string, outcomes array<string>, reason_precedence array<string>, "
    "continues array<string>"
)


@dataclass(frozen=True)
class Registry:
    """A registry that :meth:`of` found sound."""

    version: str
    stages: tuple[Mapping, ...]  # in execution order
    rules: tuple[Mapping, ...]
    inputs: Mapping[str, str]

    @classmethod
    def of(cls, spec: Mapping) -> Registry:
        """Takes a registry; an error lists all that is wrong with it."""
        wrong = problems(spec)
        if wrong:
            raise ValueError("registry: " + "; ".join(wrong))
        stages = sorted(spec["stages"], key=lambda s: s["execution_order"])
        return cls(str(spec.get("registry_version", "")), tuple(stages), tuple(spec.get("rules", ())), dict(spec.get("inputs", {})))

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Registry:
        """The registry in a file, or in the files of a folder that Spark wrote."""
        return cls.of(json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())))

    @cached_property
    def live(self) -> list[Mapping]:
        """The stages that rows pass."""
        return [s for s in self.stages if s.get("cases")]

    @property
    def last(self) -> str:
        """The stage at which rows end that nothing stops before."""
        return self.live[-1]["stage_id"]

    def stage_table(self, spark: SparkSession) -> DataFrame:
        """(stage_id, version, execution_order, label, stage_type, outcomes, reason_precedence,
        continues); ``continues`` has the outcomes after which a row goes on."""
        rows = [
            (s["stage_id"], str(s.get("version", "")), s["execution_order"], s.get("documentation_label", ""), s.get("stage_type", ""), list(s["outcomes"]),
             list(s.get("reason_precedence", ())), [o for o in s["outcomes"] if s["row_continues"][o]])
            for s in self.stages
        ]
        return spark.createDataFrame(rows, STAGE_FIELDS)

    def prepared(self, df: DataFrame) -> DataFrame:
        """``df`` with null for the inputs that it lacks, once all expressions suit it."""
        df = df.withColumns({c: F.lit(None).cast(t) for c, t in self.inputs.items() if c not in df.columns})
        seen = df.limit(0).withColumns({c: F.lit("") for c in ("tier", "primary_reason")})
        wrong = []
        for where, sql, kind, table in self._expressions(df, seen):
            try:
                found = table.select(F.expr(sql)).schema[0].dataType
                if not isinstance(found, (kind, T.NullType)):
                    wrong.append(f"{where}: {sql} is {found.simpleString()}, not {kind().simpleString()}")
            except AnalysisException as e:
                wrong.append(f"{where}: {sql}: {str(e).splitlines()[0]}")
        if wrong:
            raise ValueError("registry: " + "; ".join(wrong))
        return df

    def _expressions(self, df: DataFrame, seen: DataFrame):
        for s in self.live:
            at = f"stage {s['stage_id']}"
            if s.get("applies"):
                yield at, s["applies"], T.BooleanType, seen
            for c in s["cases"]:
                if c.get("when"):
                    yield f"{at}, {c['reason']}", c["when"], T.BooleanType, seen
                if c.get("text"):
                    yield f"{at}, {c['reason']}", c["text"], T.StringType, seen
        for r in self.rules:
            at = f"rule {r['rule_id']}"
            yield at, r["when"], T.BooleanType, df
            for name in ("evidence", "reason"):
                if r.get(name):
                    yield at, r[name], T.StringType, df

    def path(self) -> Column:
        """The stages that a row passes, in order, up to the first that it doesn't go on from: an array
        of (stage_id, outcome, reason, continues)."""
        steps = F.filter(F.array(*map(_step, self.live)), lambda s: s.isNotNull())
        stop = F.array_position(F.transform(steps, lambda s: s["continues"]), False)
        return F.when(stop > 0, F.slice(steps, 1, stop.cast("int"))).otherwise(steps)

    def hits(self) -> Column:
        """U4: the rules that a row hits, as an array of (stage_id, rule_id, evidence)."""
        def hit(r):
            return F.when(F.expr(r["when"]), F.struct(F.lit(r["stage_id"]).alias("stage_id"), F.lit(r["rule_id"]).alias("rule_id"), F.expr(r.get("evidence") or "'1'").alias("evidence")))

        found = [hit(r).cast(_HIT) for r in self.rules if r.get("counts", True)]
        return F.filter(F.array(*found), lambda h: h.isNotNull()) if found else F.expr(f"cast(array() as array<{_HIT}>)")

    def first_reason(self) -> Column:
        """(reason, stage) of the first rule, by precedence, that a row hits; else null."""
        first = sorted((r for r in self.rules if r.get("precedence") is not None), key=lambda r: r["precedence"])
        pairs = [F.when(F.expr(r["when"]), F.struct(_text(r, "reason", "rule_id").alias("reason"), F.lit(r["stage_id"]).alias("stage"))) for r in first]
        return F.coalesce(*pairs) if pairs else F.lit(None).cast("struct<reason:string,stage:string>")


def _text(row: Mapping, sql: str, name: str) -> Column:
    return F.expr(row[sql]) if row.get(sql) else F.lit(row[name])


def _step(stage: Mapping) -> Column:
    order = {reason: k for k, reason in enumerate(stage["reason_precedence"])}

    def case(c):
        step = F.struct(
            F.lit(stage["stage_id"]).alias("stage_id"), F.lit(c["outcome"]).alias("outcome"), _text(c, "text", "reason").alias("reason"),
            F.lit(bool(stage["row_continues"][c["outcome"]])).alias("continues"),
        ).cast(_STEP)
        return F.when(F.expr(c["when"]), step) if c.get("when") else step

    found = F.coalesce(*map(case, sorted(stage["cases"], key=lambda c: order[c["reason"]])))
    return F.when(F.expr(stage["applies"]), found) if stage.get("applies") else found


def problems(spec: Mapping) -> list[str]:
    """What is wrong with a registry, whatever table it is for."""
    out, stages, rules = [], list(spec.get("stages", ())), list(spec.get("rules", ()))

    def once(values: Sequence, what: str) -> None:
        out.extend(f"{what} {v} repeats" for v in sorted({str(v) for v in values if values.count(v) > 1}))

    for s in stages:
        name, outcomes, reasons = s.get("stage_id"), list(s.get("outcomes", ())), list(s.get("reason_precedence", ()))
        if not name or not isinstance(s.get("execution_order"), int) or not outcomes:
            out.append(f"stage {name} lacks a stage_id, an execution_order or outcomes")
        if set(s.get("row_continues", {})) != set(outcomes):
            out.append(f"stage {name}: row_continues isn't about its outcomes")
        cases = list(s.get("cases", ()))
        out.extend(f"stage {name}: case {c.get('reason')} isn't in reason_precedence" for c in cases if c.get("reason") not in reasons)
        out.extend(f"stage {name}: outcome {c.get('outcome')} of {c.get('reason')} isn't declared" for c in cases if c.get("outcome") not in outcomes)
        once([(c.get("reason"), c.get("when")) for c in cases], f"stage {name}: case")
    once([s.get("stage_id") for s in stages], "stage")
    once([s.get("execution_order") for s in stages], "execution_order")
    once([(r.get("stage_id"), r.get("rule_id")) for r in rules], "rule")
    once([r["precedence"] for r in rules if r.get("precedence") is not None], "precedence")
    live = sorted((s for s in stages if s.get("cases") and isinstance(s.get("execution_order"), int)), key=lambda s: s["execution_order"])
    if not live:
        out.append("no stage has cases")
    else:
        last = live[-1]
        if any(last.get("row_continues", {}).values()):
            out.append(f"the last stage, {last.get('stage_id')}, lets rows go on")
    names = {s.get("stage_id") for s in stages}
    for r in rules:
        if not r.get("rule_id") or not r.get("when"):
            out.append(f"rule {r.get('rule_id')} lacks a rule_id or when")
        if r.get("stage_id") not in names:
            out.append(f"rule {r.get('rule_id')}: no stage {r.get('stage_id')}")
    return out
