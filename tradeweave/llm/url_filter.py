"""URL filters: host and path rules, and the ratio of two character language models.

A rule decides the urls that it fits. The urls that rules accept or reject train two
variable-order Markov models of characters, over all of them: contexts of up to ``order``
characters that were seen often enough, each interpolated with the next shorter one. Other urls
are judged by the difference of log-likelihoods per character against a calibrated threshold.
"""

from __future__ import annotations

import functools
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, dropped, saved

#: The rules (host and path) with their verdicts.
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BINS = 400


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty where it is null or has no ``://``."""
    start = F.instr(url, "://")
    after = F.coalesce(F.when(start > 0, F.substring(url, start + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, else null. A rule's host fits itself and all its subdomains."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=len):
        h, p = r.split("/", 1)
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(f"/{p}")
        out = F.when(fits, F.lit(r)).otherwise(out)
    return out


def judged_by_rules(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(page_id, url, host, path, rule, by_rule)."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for r, v in rules.items():
        verdict = F.when(F.col("rule") == r, F.lit(v)).otherwise(verdict)
    return rows.withColumn("by_rule", verdict)


class MarkovModel:
    """A smoothed variable-order model of characters, from counts of (context, character).

    A context's own estimate is mixed with that of the context one shorter by the share of
    distinct characters seen after it (Witten-Bell); a context that isn't there leaves it to the
    shorter one, down to the uniform distribution. ``total`` and ``kinds`` by context come with
    the counts where these are a part of all.
    """

    def __init__(
        self,
        counts: dict[str, int],
        order: int,
        alphabet: int = 256,
        total: dict[str, int] | None = None,
        kinds: dict[str, int] | None = None,
    ):
        self.order, self.alphabet, self.counts = order, alphabet, counts
        self.total, self.kinds = total or {}, kinds or {}
        if total is None:
            for gram, n in counts.items():
                c = gram[:-1]
                self.total[c] = self.total.get(c, 0) + n
                self.kinds[c] = self.kinds.get(c, 0) + 1
        self.probability = functools.lru_cache(1 << 18)(self._probability)

    def _probability(self, gram: str) -> float:
        """Of the last character of ``gram`` after the others."""
        context = gram[:-1]
        shorter = self.probability(gram[1:]) if context else 1 / self.alphabet
        total = self.total.get(context)
        if not total:
            return shorter
        kinds = self.kinds[context]
        return (self.counts.get(gram, 0) + kinds * shorter) / (total + kinds)

    def log_likelihood(self, text: str) -> float:
        n = self.order
        return sum(math.log(self.probability(text[max(0, k - n) : k + 1])) for k in range(len(text)))


def framed(url: str) -> str:
    """The url between a beginning and an end mark."""
    return f"\x02{url}\x03"


def grams(url: str, order: int):
    """All (context, character) strings of a url, with contexts of 0 to ``order`` characters."""
    text = framed(url)
    for k in range(len(text)):
        for n in range(min(order, k) + 1):
            yield text[k - n : k + 1]


def gram_counts(labelled: DataFrame, order: int, flush: int = 300_000) -> DataFrame:
    """(label, gram, n) over all urls of ``labelled`` (label, url)."""
    schema = pa.schema([("label", pa.string()), ("gram", pa.string()), ("n", pa.int64())])

    def run(batches):
        counts: dict[tuple[str, str], int] = {}

        def out():
            return batch({"label": [k[0] for k in counts], "gram": [k[1] for k in counts], "n": list(counts.values())}, schema)

        for b in batches:
            for label, url in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for g in grams(url, order):
                    counts[label, g] = counts.get((label, g), 0) + 1
            if len(counts) > flush:
                yield out()
                counts = {}
        yield out()

    return labelled.mapInArrow(run, "label string, gram string, n bigint").groupBy("label", "gram").agg(F.sum("n").alias("n"))


def train_models(labelled: DataFrame, order: int, min_count: int) -> DataFrame:
    """The models of allowed and blocked urls as a table by string: for each label its count as a
    gram (n), and as a context the sum of counts (total) and the number (kinds) of its grams.

    Longer grams than two count from ``min_count`` on; all of them are kept."""
    counts = gram_counts(labelled, order)
    kept = saved(counts.filter((F.length("gram") <= 2) | (F.col("n") >= min_count)), "grams")
    none = F.lit(0).cast("long")
    context = F.expr("substring(gram, 1, length(gram) - 1)")
    parts = kept.groupBy("label", context.alias("gram")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    parts = parts.select("label", "gram", none.alias("n"), "total", "kinds")
    parts = parts.unionByName(kept.select("label", "gram", "n", none.alias("total"), none.alias("kinds")))
    sums = [
        F.sum(F.when(F.col("label") == v, F.col(c)).otherwise(none)).alias(f"{v}_{c}")
        for v in ("allow", "block")
        for c in ("n", "total", "kinds")
    ]
    models = saved(parts.groupBy("gram").agg(*sums), "models")
    dropped(kept)
    return models


def scores(rows: DataFrame, models: DataFrame, order: int) -> DataFrame:
    """``rows`` with score: the allowed model's log-likelihood less the blocked one's, by length.

    Blocks of at most 8,192 rows get the part of ``models`` that their urls need: contexts are
    grams of the character before, so one join by string brings counts and contexts.
    """
    names = rows.columns
    dealt = saved(rows.withColumn("_block", F.shiftright(F.monotonically_increasing_id(), 13)), "urls")

    def strings(key, table):
        found = {""}
        for url in set(table.column("url").to_pylist()):
            found.update(grams(url or "", order))
        return pa.table({"_block": pa.array([key[0].as_py()] * len(found), pa.int64()), "gram": pa.array(list(found), pa.string())})

    needs = dealt.select("_block", "url").groupBy("_block").applyInArrow(strings, "_block bigint, gram string").join(models, "gram")

    def run(urls, part):
        grams_, by_label = part.column("gram").to_pylist(), []
        for v in ("allow", "block"):
            n, total, kinds = (
                {g: x for g, x in zip(grams_, part.column(f"{v}_{c}").to_pylist()) if x} for c in ("n", "total", "kinds")
            )
            by_label.append(MarkovModel(n, order, total=total, kinds=kinds))
        allow, block = by_label
        out: dict[str | None, float] = {}
        texts = urls.column("url").to_pylist()
        for url in set(texts):
            t = framed(url or "")
            out[url] = (allow.log_likelihood(t) - block.log_likelihood(t)) / len(t)
        return urls.select(names).append_column("score", pa.array([out[url] for url in texts], pa.float64()))

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return dealt.groupBy("_block").cogroup(needs.groupBy("_block")).applyInArrow(run, f"{kept}, score double")


def calibrate(scored: DataFrame, span: float = 4.0) -> float:
    """The threshold of best balanced accuracy over ``scored`` (by_rule, score): the lower bound of
    one of 400 bins; 0 where a label is missing."""
    bin_ = F.least(F.greatest(F.floor((F.col("score") + span) * _BINS / (2 * span)), F.lit(0)), F.lit(_BINS - 1))
    rows = scored.groupBy(bin_.alias("bin"), "by_rule").agg(F.count("*").alias("n")).collect()
    n = {v: [0] * _BINS for v in ("allow", "block")}
    for r in rows:
        n[r.by_rule][r.bin] += r.n
    if not sum(n["allow"]) or not sum(n["block"]):
        return 0.0
    best = (-1.0, 0.0, 0.0)
    for k in range(_BINS + 1):
        right = sum(n["allow"][k:]) / sum(n["allow"]) + sum(n["block"][:k]) / sum(n["block"])
        threshold = k * 2 * span / _BINS - span
        best = max(best, (round(right, 9), -abs(threshold), threshold))
    return best[2]


def url_filter(
    pages: DataFrame, rules: dict[str, str] | None = None, order: int = 5, min_count: int = 3
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict and score.

    Three quarters of the urls that rules decide (by hash) train the models, the rest sets the
    threshold. A url that no rule fits is allowed if its score is at least the threshold. The score
    is null where a rule decides. A null url is the empty text; without urls of both verdicts the
    threshold is 0 and equal likelihoods allow. Rows that repeat are judged each; an empty table
    gives no rows; other columns are ignored.
    """
    rows = judged_by_rules(pages, RULES if rules is None else rules)
    decided = rows.filter("by_rule is not null")
    fold = F.pmod(F.xxhash64("url"), F.lit(4))
    models = train_models(decided.filter(fold != 0).select(F.col("by_rule").alias("label"), "url"), order, min_count)
    scored = saved(scores(rows.filter((F.col("by_rule").isNull()) | (fold == 0)), models, order), "scores")
    dropped(models)
    threshold = calibrate(scored.filter("by_rule is not null"))
    rest = scored.filter("by_rule is null")
    judged = decided.withColumn("score", F.lit(None).cast("double")).unionByName(rest)
    by_model = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"), "score")
