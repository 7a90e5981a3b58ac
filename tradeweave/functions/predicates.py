"""Filters and predicates over rows as column expressions.

Patterns, cues and code sets are arguments. Patterns are matched in lower-cased or normalised
text, in the order given, as one expression for each; the lists are short.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T


def _code(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("double").cast("int")


def match_allowed(hs4: Column | str, scope: Iterable[int], exclude: Iterable[int] = (), open_gate: bool = True) -> Column:
    """Excluded codes are blocked; else the gate is open, or open to the codes in scope."""
    n = _code(hs4)
    blocked = F.coalesce(n.isin(*exclude), F.lit(False)) if list(exclude) else F.lit(False)
    return ~blocked & (F.lit(open_gate) | F.coalesce(n.isin(*scope), F.lit(False)))


def scope_label(hs4: Column | str, scope: Iterable[int], core: str = "core", extended: str = "extended") -> Column:
    """P2."""
    return F.when(_code(hs4).isin(*scope), core).otherwise(extended)


def has_cue(c: Column | str, cues: Iterable[str]) -> Column:
    """Whether a cue is in the lower-cased text."""
    cues = list(cues)
    if not cues:
        return F.lit(False)
    return F.lower(T.text(c)).rlike("|".join(re.escape(x) for x in cues))


def first_group(c: Column, patterns: Mapping[str, str]) -> Column:
    """The name of the first pattern that fits, else ''."""
    return F.coalesce(*[F.when(c.rlike(p), F.lit(n)) for n, p in patterns.items()], F.lit(""))


def first_hit(c: Column, patterns: Mapping[str, str]) -> Column:
    """P5: (name, matched text) of the first pattern that fits, else null."""
    return F.coalesce(
        *[
            F.when(c.rlike(p), F.struct(F.lit(n).alias("name"), F.regexp_extract(c, p, 0).alias("hit")))
            for n, p in patterns.items()
        ]
    )


def union_pattern(patterns: Iterable[str]) -> str | None:
    """One pattern for all, of which broken ones are taken literally."""
    parts = []
    for p in map(str.strip, patterns):
        if not p:
            continue
        try:
            re.compile(p)
        except re.error:
            p = re.escape(p)
        parts.append(f"(?:{p})")
    return "|".join(parts) or None


def scope_hit(c: Column, groups: Mapping[str, str], whitelist: str | None = None) -> Column:
    """The first group's (name, matched text); null if none or if the whitelist fits."""
    hit = first_hit(c, groups)
    return F.when(~c.rlike(whitelist), hit) if whitelist else hit


def unspecified(product: Column | str, *others: Column | str, label: str = "unspecified", mark: str = "(unspecified)") -> Column:
    """Whether one of the dimensions is blank or unspecified, or the product bears the mark."""
    out = T.norm_exact(product).contains(mark)
    for c in (product, *others):
        out = out | T.norm_exact(c).isin("", label)
    return out


def risk_token(family: Column | str, maker: Column | str, risky: Iterable[str]) -> Column:
    """The longest risky token that stands whole in family or maker, else ''."""
    both = F.concat(F.lit(" "), T.norm_text(family), F.lit(" | "), T.norm_text(maker), F.lit(" "))
    ordered = sorted(set(risky), key=lambda t: (-len(t), t))
    return F.coalesce(*[F.when(both.contains(f" {t} "), F.lit(t)) for t in ordered], F.lit(""))


def label_in_text(label: Column | str, row: Column, least: int = 3) -> Column:
    """P10: whether a label that isn't blank and has ``least`` characters is in the row's text."""
    n = T.norm_text(label)
    return (F.length(n) >= least) & ~n.isin(*T.BLANK) & row.contains(n)


def product_evidence(product: Column | str, row: Column, rules: Mapping[str, str], general: str) -> Column:
    """The text that the pattern of the first rule whose cue is in the product finds in the
    row; only if no rule applies, the general pattern. Null without a hit."""
    label = T.norm_text(product)
    out = F.when(row.rlike(general), F.regexp_extract(row, general, 0))
    for cue, pattern in reversed(list(rules.items())):
        own = F.when(row.rlike(pattern), F.regexp_extract(row, pattern, 0))
        out = F.when(label.contains(cue), own).otherwise(out)
    return out


def month_as_brand(family: Column | str, row: Column, months: Iterable[str], date_context: Column, bad_context: Column, supported: Column) -> Column:
    """A month's name as brand, in a row that names the month, without strong support or in
    the context of a date or a wrong domain."""
    months = sorted(months)
    is_month = T.norm_text(family).isin(*months)
    named = row.rlike(rf"\b(?:{'|'.join(months)})\b")
    return is_month & named & (~supported | date_context | bad_context)


def lacks_context(family: Column | str, name: str, vendor: Column, context: Column, bad_context: Column) -> Column:
    """An ambiguous brand without its vendor, its product context, or in a wrong domain."""
    return (T.norm_text(family) == name) & ~(vendor & context & ~bad_context)


def domain_conflict(row: Column, pattern: str, group: Column, group_pattern: str) -> Column:
    """P14."""
    return row.rlike(pattern) | F.lower(group).rlike(group_pattern)


def independent_signal(row: Column, pattern: str, value: Column, device_pattern: str, least: float = 50_000) -> Column:
    """A product's pattern, or a device's in a row of high value."""
    return row.rlike(pattern) | ((value >= least) & row.rlike(device_pattern))


def extended_false_positive(extended: Column, bad_context: Column, true_extended: Column, weak: Column, exempt: Column) -> Column:
    """An extended-scope row in a wrong domain, or with a weak name and no support."""
    return extended & ((bad_context & ~true_extended) | (weak & ~true_extended & ~exempt))


def product_support(score: Column, product: Column | str, row: Column) -> Column:
    """A positive score, or the product's own label in the row."""
    return (score > 0) | label_in_text(product, row, least=4)


def code_review_hit(code: Column, wanted: str, row: Column, patterns: Mapping[str, str]) -> Column:
    """The first pattern's hit, in rows of one code."""
    return F.when(code == wanted, first_hit(row, patterns))
