"""Readers, checks and writers of tables."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Where it isn't set and the master is local, a folder below the session's warehouse; on a cluster that
    is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared"
    return found.rstrip("/")


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    What several later steps read is computed once, survives lost executors, and has a known size.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Fixed value: tables of up to so many rows go to all tasks in place of being dealt out with what they join.
SMALL = 300_000


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """``df``, a table (its rows are counted without reading them), for a join: sent to all tasks if it has at
    most ``most`` rows, so that the other side isn't shuffled; else as it is."""
    return F.broadcast(df) if df.count() <= most else df


def require_columns(df: DataFrame, columns: Iterable[str], where: str = "table") -> DataFrame:
    """``df``, if it has the columns; else an error that lists what lacks and what is there."""
    lacks = [c for c in columns if c not in df.columns]
    if lacks:
        raise ValueError(f"{where}: lacks {lacks}; has {df.columns}")
    return df


def column_check(tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]]) -> DataFrame:
    """S2 as a table: (table, column, found, n_rows, n_missing) for each required column; the values that lack
    are counted in one pass over each table, null where the column lacks as a whole."""
    out = None
    for name, columns in required.items():
        df = tables[name]
        lacks = [F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"m{k}") for k, c in enumerate(columns) if c in df.columns]
        one = df.agg(F.count("*").alias("n"), *lacks)
        missing = [F.col(f"m{k}") if c in df.columns else F.lit(None).cast("long") for k, c in enumerate(columns)]
        rows = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(c in df.columns).alias("found"), m.alias("n_missing")) for c, m in zip(columns, missing)))
        part = one.select(F.lit(name).alias("table"), F.col("n").alias("n_rows"), F.explode(rows).alias("r")).select("table", "r.column", "r.found", "n_rows", "r.n_missing")
        out = part if out is None else out.unionByName(part)
    return out


def file_state(spark: SparkSession, paths: Iterable[str]) -> str:
    """A digest of the names, sizes and times of all files below ``paths``, from their listing alone."""
    seen = None
    for path in paths:  # one by one, as a path may be a file or a folder
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
        seen = files if seen is None else seen.unionByName(files)
    return str(seen.agg(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()[0])


def read_delimited(spark: SparkSession, path: str, sep: str = "\t", required: Iterable[str] = (), multi_line: bool = False) -> DataFrame:
    """Delimited files with a header as strings, each file by itself UTF-8 or, where any of its bytes
    aren't, Latin-1.

    A first pass asks each file's lines whether they are UTF-8, and only the names of files that aren't
    reach the driver; then every file is parsed once. Spark splits large files in both passes. Line breaks
    within quotes need ``multi_line``, which makes each file one task of the second. Files may have
    different columns if their encodings differ; what one lacks is null.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.expr("is_valid_utf8(value)").alias("ok"))
    broken = {r.file for r in lines.groupBy("file").agg(F.bool_and("ok").alias("ok")).filter("NOT ok").collect()}

    def parsed(files: str | list[str], encoding: str) -> DataFrame:
        df = spark.read.csv(files, sep=sep, header=True, encoding=encoding, quote='"', escape='"', multiLine=multi_line)
        return df.withColumnsRenamed({c: c.lstrip("\ufeff") for c in df.columns})

    def plain(name: str) -> str:  # both listings, whichever way they write a name
        return re.sub(r"^(\w+):/+", r"\1:/", unquote(name))

    files, decoded = spark.read.text(path).inputFiles() if broken else [], {plain(f) for f in broken}
    of: dict[bool, list[str]] = {False: [], True: []}
    for f in files:
        of[plain(f) in decoded].append(unquote(f))
    if not broken:
        out = parsed(path, "UTF-8")
    elif not of[False]:
        out = parsed(path, "ISO-8859-1")
    else:
        out = parsed(of[False], "UTF-8").unionByName(parsed(of[True], "ISO-8859-1"), allowMissingColumns=True)
    return require_columns(out, required, path)


def narrow(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns that are needed, in order; the scan reads no others."""
    return require_columns(df, columns).select(*columns)


def load_master(df: DataFrame, rename: Mapping[str, str], generic_flag: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The master list under logical names: (strict, generic, all). Generic rows bear the flag."""
    full = require_columns(df, rename, "master").withColumnsRenamed(dict(rename))
    generic = F.trim(F.coalesce(F.col(generic_flag).cast("string"), F.lit(""))) != ""
    return full.filter(~generic), full.filter(generic), full


def active_terms(terms: DataFrame, list_name: str | None = None) -> DataFrame:
    """(list_name, term, ord): trimmed terms of active rows, once each, with their first place."""
    rows = terms.filter((F.lower(F.trim("status")) == "active") & (F.trim("term") != ""))
    if list_name is not None:
        rows = rows.filter(F.col("list_name") == list_name)
    return rows.groupBy("list_name", F.trim("term").alias("term")).agg(F.min("ord").alias("ord"))


def active_map(maps: DataFrame, mode: str = "last") -> DataFrame:
    """(map_name, key, value) with the last value of each key, or with all in order (``mode`` all)."""
    rows = maps.filter((F.trim("key") != "") & F.col("value").isNotNull())
    group = rows.groupBy("map_name", F.trim("key").alias("key"))
    if mode == "last":
        return group.agg(F.max_by("value", "ord").alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("ord", "value")))
    return group.agg(F.transform(ordered, lambda x: x["value"]).alias("value"))


def list_catalog_counts(catalog: DataFrame, terms: DataFrame, maps: DataFrame) -> DataFrame:
    """The catalogue with n_active and n_total rows of each list or map, 0 where there is none."""
    active = F.sum(F.when(F.lower(F.trim("status")) == "active", 1).otherwise(0)).alias("n_active")
    counts = terms.groupBy("list_name").agg(active, F.count("*").alias("n_total")).unionByName(
        maps.groupBy(F.col("map_name").alias("list_name")).agg(F.count("*").alias("n_active"), F.count("*").alias("n_total"))
    )
    return catalog.join(counts, "list_name", "left").fillna(0, ["n_active", "n_total"])


def ensure_columns(df: DataFrame, defaults: Mapping[str, object], preserve: Iterable[str] = ()) -> DataFrame:
    """``df`` with the columns that it lacks, and copies ``original_*`` of those to preserve."""
    df = df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})
    return df.withColumns({f"original_{c}": F.col(c) for c in preserve if f"original_{c}" not in df.columns})


def with_row_id(df: DataFrame, uid: str, order: Sequence[Column | str], name: str = "row_id") -> DataFrame:
    """A stable id ``uid#n``; n counts the rows of a uid in the declared order."""
    n = F.row_number().over(Window.partitionBy(uid).orderBy(*order))
    return df.withColumn(name, F.concat_ws("#", F.col(uid).cast("string"), n.cast("string")))


def write_slice(df: DataFrame, path: str, key: str = "country") -> None:
    """Writes rows by ``key``; slices that ``df`` holds are replaced, the others stay."""
    df.write.partitionBy(key).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_slices(spark: SparkSession, path: str) -> DataFrame:
    """All slices as one table, sorted by country, segment, sub-segment and upper bound."""
    return spark.read.parquet(path).orderBy("country", "segment", "sub_segment", F.desc("upper_value"), "product", "family", "maker")


def publish_slices(
    df: DataFrame, path: str, expected: Mapping[str, int], key: str = "country", value: str | None = None, totals: Mapping[str, float] | None = None, tolerance: float = 0.005
) -> str:
    """S10, S12, C4 in one: writes a new version of the slices in ``expected``, and publishes it only if what
    was written is what was expected; the version's name.

    Rows and, for ``totals``, the sum of ``value`` of each slice are observed by the write itself. A slice
    with other numbers, or rows of a slice that isn't expected, raise an error, and readers keep seeing the
    versions before. So they do if the job is lost at any point: a version counts from the moment its
    small entry is written, after all else.
    """
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    seen, slices = Observation(version), list(expected)
    metrics = [F.count(F.when(F.col(key) == s, 1)).alias(f"n{i}") for i, s in enumerate(slices)]
    if totals:
        money = F.col(value).cast("decimal(30,6)")
        metrics += [F.coalesce(F.sum(F.when(F.col(key) == s, money)), F.lit(0)).cast("double").alias(f"v{i}") for i, s in enumerate(slices) if s in totals]
    metrics.append(F.count(F.when(~F.coalesce(F.col(key).isin(*slices), F.lit(False)), 1)).alias("others"))
    df.observe(seen, *metrics).withColumn("_slice", F.col(key)).write.partitionBy("_slice").parquet(f"{path}/versions/{version}")
    got, wrong = seen.get, []
    if got["others"]:
        wrong.append(f"{got['others']} rows of other slices")
    for i, s in enumerate(slices):
        if got[f"n{i}"] != expected[s]:
            wrong.append(f"{s}: {got[f'n{i}']} rows, expected {expected[s]}")
        if totals and s in totals and abs(got[f"v{i}"] - totals[s]) > tolerance:
            wrong.append(f"{s}: {value} {got[f'v{i}']}, expected {totals[s]}")
    if wrong:
        raise ValueError(f"not published: {'; '.join(wrong)}")
    _publish(df.sparkSession, path, version, slices, df.schema.json())
    return version


_ENTRY = "version string, slice string, schema string"


def _publish(spark: SparkSession, path: str, version: str, slices: Sequence[str], schema: str) -> None:
    """Makes a version the one that readers see, by one small file."""
    spark.createDataFrame([(version, s, schema) for s in slices], _ENTRY).coalesce(1).write.mode("append").json(f"{path}/published")


def read_published(spark: SparkSession, path: str, key: str = "country") -> DataFrame:
    """The rows of each slice's last published version."""
    entries = spark.read.schema(_ENTRY).json(f"{path}/published")
    last = entries.groupBy(F.col("slice").alias("_slice")).agg(F.max(F.struct("version", "schema")).alias("e")).select("_slice", F.col("e.version").alias("_version"), "e.schema")
    rows = None
    for r in last.select("_version", "schema").distinct().collect():  # at most one a slice
        kept = T.StructType.fromJson(json.loads(r.schema))
        part = spark.read.schema(kept).parquet(f"{path}/versions/{r[0]}").drop("_slice").withColumn("_of", F.lit(r[0]))
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    own = (F.col(key) == F.col("_slice")) & (F.col("_of") == F.col("_version"))
    return rows.join(last, own, "left_semi").drop("_of")


def build_ground_truth(files: Mapping[str, DataFrame], keep: Sequence[str], year_column: str, year: str) -> DataFrame:
    """The files' rows of one fiscal year with the columns that exist, src_file and join keys."""
    from tradeweave.functions import text as X

    rows = combine_tables({n: d.select(*[c for c in keep if c in d.columns]) for n, d in files.items()}, "src_file")
    for c in keep:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    rows = rows.filter(F.trim(F.col(year_column).cast("string")) == year)
    return rows.withColumns(
        {"desc_key": X.desc_key("description"), "code": X.hs8("hs_code"), "value_key": F.bround(X.number("value")).cast("bigint")}
    )


def assert_row_count(df: DataFrame, expected: int, where: str = "table") -> DataFrame:
    """``df``, if it has the expected number of rows; else an error."""
    n = df.count()
    if n != expected:
        raise ValueError(f"{where}: {n} rows, expected {expected}")
    return df


def capped_extract(df: DataFrame, cap: int, status: str, value: str, key: str) -> DataFrame:
    """All rows if at most ``cap``; else the matched ones; of more than that, those of top value."""
    if df.limit(cap + 1).count() <= cap:
        return df
    matched = df.filter(F.col(status) == "Matched")
    if matched.limit(cap + 1).count() <= cap:
        return matched
    return matched.orderBy(F.desc_nulls_last(F.col(value).try_cast(T.DoubleType())), key).limit(cap)


def combine_tables(tables: Mapping[str, DataFrame], name_column: str = "source") -> DataFrame:
    """The tables' rows with the name of each; columns that one lacks are null in it."""
    out = None
    for name, df in tables.items():
        df = df.withColumn(name_column, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def parse_market_year(path: Column | str) -> Column:
    """(market, year) out of a file's name such as ``.../Country_FY2024_x.csv``."""
    base = F.regexp_extract(F.col(path) if isinstance(path, str) else path, r"([^/]+)$", 1)
    year = F.regexp_extract(base, r"(?:FY|_)(20[0-9]{2})", 1)
    return F.struct(F.regexp_extract(base, r"^([A-Za-z]+)", 1).alias("market"), F.when(year != "", year).alias("year"))
