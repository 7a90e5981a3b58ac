"""Quality of documents: a classifier's evidence under hierarchical empirical-Bayes site priors.

A logistic model of the text gives each document its evidence. Sites and their sections (host and
path) get posterior rates by grouped sums: a section's rate is drawn to its site's, and a site's
to the global rate, the more so the fewer documents it has; how strongly, the spread of the rates
tells. A document's verdict adds its evidence to its section's log-odds.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch, hot_apart, saved

FEATURES = (
    "log words", "mean word length", "distinct words", "most frequent word", "repeated neighbours",
    "punctuation", "symbols", "digits", "capitals", "bars", "distinct lines", "sentence ends",
)
_WORDISH = bytes(b for b in range(256) if b >= 128 or chr(b).isalnum() or chr(b) in " \n\t\r")
_PUNCTUATION = b".,;:!?'\"()-"


def features(text: str | None) -> list[float]:
    """Numbers between 0 and about 1 that describe the whole text; all 0 for an empty one."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    other = raw.translate(None, _WORDISH)
    symbols = other.translate(None, _PUNCTUATION)
    lines = raw.split(b"\n")
    size = len(raw)
    return [
        math.log1p(n) / 10,
        min(1.0, size / n / 20),
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        (len(other) - len(symbols)) / size * 10,
        len(symbols) / size * 10,
        (size - len(raw.translate(None, b"0123456789"))) / size * 10,
        (size - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / size * 10,
        raw.count(b"|") / n,
        len(set(lines)) / len(lines),
        min(1.0, (raw.count(b". ") + raw.count(b".\n") + 1) / n * 5),
    ]


def expanded(x: np.ndarray) -> np.ndarray:
    """Features with their squares and a constant."""
    return np.concatenate([np.ones((len(x), 1)), x, x * x], axis=1)


def fit(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 40) -> np.ndarray:
    """Weights of a logistic model by Newton's method; all 0 where a class is missing."""
    x = expanded(x) if len(x) else np.zeros((0, 1 + 2 * len(FEATURES)))
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        return w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (y - p) / len(y) - l2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + l2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def described(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` of ``docs`` with x, the features of text."""

    def run(batches):
        for b in batches:
            x = [features(t) for t in b.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], pa.array(x, pa.list_(pa.float64()))], names=[*keys, "x"])

    rows = docs.select(*keys, "text")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(run, f"{kept}, x array<double>")


def posterior(good: Column, n: Column, prior: Column, strength: Column) -> Column:
    """The mean of a beta posterior whose prior has mean ``prior`` and weighs ``strength`` rows."""
    return (good + prior * strength) / (n + strength)


def strength_of(rates: DataFrame, prior: Column, least: float = 1.0, most: float = 1e4) -> float:
    """How many rows a prior weighs: by the spread of group rates over what chance alone explains.

    ``rates`` has n, good and prior. With p as prior mean, a group's rate varies by
    p(1 - p)(1/n + (1 - 1/n)/(s + 1)) around it; moments over all groups give s.
    """
    v = prior * (1 - prior)
    r = rates.filter("n > 0").agg(
        F.sum(F.col("n") * (F.col("good") / F.col("n") - prior) ** 2).alias("seen"),
        F.sum(v).alias("chance"),
        F.sum(v * (F.col("n") - 1)).alias("more"),
    ).first()
    if not r.more or r.seen is None or r.seen <= r.chance:
        return most
    return min(most, max(least, r.more / (r.seen - r.chance) - 1))


def classify(
    docs: DataFrame, labels: DataFrame, site: str = "source", section: str = "lang", max_labels: int = 50_000, threshold: float = 0.5
) -> DataFrame:
    """One row per document: doc_id, evidence, site_rate, section_rate, score and kept.

    evidence is the log-odds of the text's classifier less those of the overall rate. The classifier
    learns from at most ``max_labels`` labelled documents, drawn by hash of the id. The rates come
    from grouped sums over all documents: a labelled one counts by its label, another by its
    classifier's probability. score is the posterior probability of good quality; kept is score >=
    ``threshold``. A null text counts as empty, a null site or section as ''. A document with several
    labels counts by their mean; labels that are null or of no document are ignored. Without labels
    of both kinds, evidence is 0 and the prior rate 0.5. Texts of any length count as a whole. Rows
    that repeat are judged each; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    truth = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("label_id")).agg(
        F.avg(F.col("quality").cast("double")).alias("y")
    )
    n_labels = truth.count()
    share = min(1.0, max_labels / max(1, n_labels))
    drawn = truth.filter(F.pmod(F.xxhash64("label_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(max_labels)
    train = described(docs.select("doc_id", "text").join(drawn, F.col("doc_id") == F.col("label_id")).select("y", "text"), ["y"])
    rows = train.collect()  # at most max_labels rows of a dozen numbers
    y = np.array([float(r.y >= 0.5) for r in rows])
    w = fit(np.array([r.x for r in rows]), y)
    base = (y.sum() + 1) / (len(y) + 2) if w.any() else 0.5
    logit = math.log(base / (1 - base))
    model = spark.sparkContext.broadcast(w)

    def run(batches):
        schema = pa.schema([("evidence", pa.float64())])
        for b in batches:
            x = np.array([features(t) for t in b.column(b.num_columns - 1).to_pylist()]).reshape(-1, len(FEATURES))
            e = np.clip(expanded(x) @ model.value, -30, 30) - logit if model.value.any() else np.zeros(len(x))
            out = batch({"evidence": np.round(e, 9)}, schema)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *out.columns], names=[*b.schema.names[:-1], "evidence"])

    named = docs.select(
        "doc_id",
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.coalesce(F.col(section).cast("string"), F.lit("")).alias("section"),
        "text",
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = named.mapInArrow(run, f"doc_id {kind}, site string, section string, evidence double")
    scored = saved(scored.join(truth, F.col("doc_id") == F.col("label_id"), "left").drop("label_id"), "quality")
    p = 1 / (1 + F.exp(-(F.col("evidence") + F.lit(logit))))
    # Sums of whole millionths don't depend on the order in which they are added up.
    good = F.sum(F.round(F.coalesce("y", p) * 1_000_000).cast("long")).alias("m")
    by_section = scored.groupBy("site", "section").agg(F.count("*").alias("n"), good)
    by_section = by_section.select("site", "section", "n", (F.col("m") / 1e6).alias("good"))
    by_site = by_section.groupBy("site").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = by_site.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = (total.good + 1) / (total.n + 2) if total.n else 0.5
    s1 = strength_of(by_site, F.lit(overall))
    sites = by_site.select(
        F.col("site").alias("of"), F.round(posterior(F.col("good"), F.col("n"), F.lit(overall), F.lit(s1)), 9).alias("site_rate")
    )
    sections = by_section.join(sites, F.col("site") == F.col("of")).drop("of")
    s2 = strength_of(sections, F.col("site_rate"))
    rate = F.round(posterior(F.col("good"), F.col("n"), F.col("site_rate"), F.lit(s2)), 9)
    sections = sections.select("site", "section", "site_rate", rate.alias("section_rate"), "n")
    joined = hot_apart(scored, sections, ["site", "section"], "n", total.n or 0)
    bounded = F.greatest(F.least(F.col("section_rate"), F.lit(1 - 1e-6)), F.lit(1e-6))
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.log(bounded / (1 - bounded)))))
    return joined.select(
        "doc_id", "evidence", "site_rate", "section_rate", F.round(score, 6).alias("score"), (F.round(score, 6) >= threshold).alias("kept")
    )
