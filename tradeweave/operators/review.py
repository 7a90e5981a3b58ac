"""Candidate, review and request tables (Q1-Q22)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradeweave.functions import text as X
from tradeweave.sources.tables import small, staged

from .aggregate import money, total
from .fingerprint import rows_of_differing
from .mapping import preserve_or_propose


def ranked(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], cap: int) -> DataFrame:
    """The first ``cap`` rows of each group."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_n", n).filter(F.col("_n") <= cap).drop("_n")


def joined_reasons(reasons: Mapping[str, Column]) -> Column:
    """The names of the conditions that hold, joined by semicolons."""
    return F.concat_ws("; ", *[F.when(c, F.lit(n)) for n, c in reasons.items()])


def candidates(df: DataFrame, condition: Column, reasons: Mapping[str, Column]) -> DataFrame:
    """Q1: rows that meet a condition, with proposed labels where the current ones are blank."""
    proposed = {f"proposed_{n}": preserve_or_propose(n, f"candidate_{n}") for n in ("segment", "sub_segment", "product")}
    return df.filter(condition).withColumns({**proposed, "reason": joined_reasons(reasons)})


def top_candidates(df: DataFrame, key: str, methods: Mapping[str, tuple[Column, Column]], per_method: int, per_row: int, cap: int, value: str = "value") -> DataFrame:
    """Q2: (key, method, label, value): one row for each method that fires, at most ``per_method``
    of each by value, distinct, at most ``per_row`` of a row in the methods' order, ``cap`` in all.

    ``methods`` gives (condition, proposed label) by name. A first pass over ``df`` counts each method's rows by bands of
    value, so that only rows of bands that hold its first ``per_method`` are taken apart and ranked.
    """
    number, names = X.safe_number(value), list(methods)
    band = F.floor(F.signum(number) * F.log1p(F.abs(number)) * 200)  # rises with the value
    counts = df.groupBy(band.alias("band")).agg(*[F.count(F.when(methods[n][0], 1)).alias(f"n{k}") for k, n in enumerate(names)]).collect()
    least = {n: _band_of(((r["band"], r[f"n{k}"]) for r in counts), per_method) for k, n in enumerate(names)}
    if None not in least.values():
        df = df.filter(band >= min(least.values()))
    methods = {n: (c if least[n] is None else c & (band >= least[n]), label) for n, (c, label) in methods.items()}
    each = F.filter(
        F.array(*[F.when(c, F.struct(F.lit(k).alias("rank"), F.lit(n).alias("method"), label.alias("label"))) for k, (n, (c, label)) in enumerate(methods.items())]),
        lambda x: x.isNotNull(),
    )
    rows = df.select(key, X.safe_number(value).alias("value"), F.explode(each).alias("m")).select(key, "value", "m.rank", "m.method", "m.label")
    rows = ranked(rows, ["method"], [F.desc("value"), key], per_method)
    rows = ranked(rows, [key, "label"], ["rank"], 1)
    rows = ranked(rows, [key], ["rank", "label"], per_row)
    return rows.orderBy(F.desc("value"), key, "rank").limit(cap).select(key, "method", "label", "value")


def _band_of(counts: Iterable[tuple[int, int]], n: int) -> int | None:
    """The band down to which there are ``n`` rows, None if there are fewer."""
    for band, rows in sorted(counts, reverse=True):
        n -= rows
        if n <= 0:
            return band
    return None


def grouped_request(df: DataFrame, keys: Sequence[str], issue: Column, sample: str, key: str) -> DataFrame:
    """Q3, Q4, Q12: rows and value of each group, its issue, and the sample of highest value."""
    v = X.safe_number("value")
    return df.withColumn("issue", issue).groupBy(*keys, "issue").agg(
        F.count("*").alias("n_rows"), total(money("value")).alias("value"), F.min(F.struct((-v).alias("m"), F.col(key).alias("k"), F.col(sample).alias("s")))["s"].alias("sample")
    )


def last_rule(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """Q5: the category of the last rule that holds."""
    out = F.lit(default)
    for condition, name in rules:
        out = F.when(condition, name).otherwise(out)
    return out


def decision_table(df: DataFrame, category: Column, keys: Sequence[str]) -> DataFrame:
    """Q5, Q16: rows and value by category."""
    return df.withColumn("category", category).groupBy(*keys, "category").agg(F.count("*").alias("n_rows"), total(money("value")).alias("value"))


def clusters(df: DataFrame, keys: Sequence[str], high: float, playbook: Mapping[str, str]) -> DataFrame:
    """Q6: review clusters with the number of rows of high value and a text by status."""
    text = F.lit("")
    for prefix, what in playbook.items():
        text = F.when(F.col("qa_status").startswith(prefix), what).otherwise(text)
    return df.groupBy("qa_status", *keys).agg(
        F.count("*").alias("n_rows"), F.count(F.when(X.safe_number("value") >= high, 1)).alias("n_high"), total(money("value")).alias("value")
    ).withColumn("playbook", text)


def changed_rows(before: DataFrame, after: DataFrame, key: str, columns: Iterable[str]) -> DataFrame:
    """Q7: rows whose columns differ, with the values before. Only rows in buckets whose fingerprints differ
    are joined."""
    columns = list(columns)
    before, after = rows_of_differing(before.select(key, *columns), after.select(key, *columns), [key], columns)
    b = before.select(key, *[F.col(c).alias(f"before_{c}") for c in columns])
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"before_{c}"))
    return after.join(b, key).filter(differs)


def screen(df: DataFrame, text: Column, wanted: str, unwanted: str | None = None) -> DataFrame:
    """Q8-Q10, Q13, Q14: rows with one pattern and not another, with the words found."""
    keep = text.rlike(wanted)
    if unwanted:
        keep = keep & ~text.rlike(unwanted)
    return df.filter(keep).withColumn("hit", F.regexp_extract(text, wanted, 0))


def split_requests(df: DataFrame, name: str, generic: Iterable[str], months: Iterable[str], risky: Column) -> DataFrame:
    """Q11: ``disposition`` of each request: rejected, needs review or clean."""
    norm = X.norm_text(name)
    bad = norm.isin(*generic, *months, "")
    return df.withColumn("disposition", F.when(bad, "rejected").when(risky, "needs review").otherwise("clean"))


def anomalies(df: DataFrame, reasons: Mapping[str, Column]) -> DataFrame:
    """Q15: rows with at least one reason."""
    return df.withColumn("reasons", joined_reasons(reasons)).filter("reasons <> ''")


def named_screens(df: DataFrame, text: Column, screens: Mapping[str, str], key: str, sample: str) -> DataFrame:
    """Q17: rows, value and the sample of highest value for each named pattern, in one pass."""
    hits = F.filter(F.array(*[F.when(text.rlike(p), F.lit(n)) for n, p in screens.items()]), lambda x: x.isNotNull())
    rows = df.select(key, sample, "value", F.explode(hits).alias("screen"))
    v = X.safe_number("value")
    return rows.groupBy("screen").agg(
        F.count("*").alias("n_rows"), total(money("value")).alias("value"), F.min(F.struct((-v).alias("m"), F.col(key).alias("k"), F.col(sample).alias("s")))["s"].alias("sample")
    )


def gold_template(df: DataFrame, key: str, buckets: Mapping[str, Column], caps: Mapping[str, int | None], blank: Iterable[str]) -> DataFrame:
    """Q18, Q19: rows to label: of each bucket the ``cap`` of highest value (None: all), each row in
    its first bucket, with blank columns for the labels."""
    ranks = {n: k for k, n in enumerate(buckets)}
    capped = {n: caps[n] for n in buckets if caps.get(n) is not None}
    free = [n for n in buckets if n not in capped]
    one = lambda n: F.when(buckets[n], F.struct(F.lit(ranks[n]).alias("rank"), F.lit(n).alias("bucket")))
    none = F.lit(None).cast("struct<rank:int,bucket:string>")
    # A row's first bucket without a cap is known from the row itself.
    rows = df.withColumns({"_v": X.safe_number("value"), "_free": F.coalesce(*map(one, free)) if free else none})
    empty = [F.lit("").alias(c) for c in blank]
    if not capped:
        return rows.filter("_free is not null").select(key, F.col("_free.bucket").alias("bucket"), *empty)
    each = F.filter(F.array(*map(one, capped)), lambda x: x.isNotNull())
    cap = F.element_at(F.create_map(*[F.lit(x) for kv in capped.items() for x in kv]), F.col("bucket"))
    n = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("_v"), key))
    few = rows.select(key, "_v", "_free", F.explode(each).alias("b")).select(key, "_v", "_free", "b.rank", "b.bucket")
    # The literal limit lets each task pass on only so many rows of a bucket; the few that stay become a table.
    few = few.withColumn("n", n).filter((F.col("n") <= max(capped.values())) & (F.col("n") <= cap))
    few = few.filter(F.col("_free").isNull() | (F.col("rank") < F.col("_free.rank")))
    few = staged(ranked(few, [key], ["rank"], 1).select(key, "bucket"), "capped")
    rest = rows.filter("_free is not null").select(key, F.col("_free.bucket").alias("bucket")).join(small(few.select(key)), key, "left_anti")
    return few.unionByName(rest).select(key, "bucket", *empty)


def counts_by_type(flags: Mapping[str, Column], df: DataFrame) -> DataFrame:
    """Q20: (type, n_rows) of correction types, 0 included."""
    one = df.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in flags.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("type"), F.col(n).alias("n_rows")) for n in flags])).alias("x")).select("x.*")


def decision_log(df: DataFrame, key: str, decision: Column) -> DataFrame:
    """Q21."""
    return df.select(key, "match_tier", "qa_status", decision.alias("decision"), F.concat_ws(" / ", "segment", "product", "family").alias("target"))


def signature_impact(df: DataFrame, label: str, text: str, signatures: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Q22: (signature, n_rows, value) for (name, label contains, text has, text hasn't) rules; the
    few rules are columns, not a join."""
    low, name = F.lower(X.text(text)), F.lower(X.text(label))
    hits = [F.when(name.contains(a) & low.rlike(b) & ~low.rlike(c), F.lit(n)) for n, a, b, c in signatures]
    rows = df.select("value", F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("signature"))
    return rows.groupBy("signature").agg(F.count("*").alias("n_rows"), total(money("value")).alias("value"))
