"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
import weakref

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lower-cases A-Z and turns every ASCII byte that is neither a digit nor a letter into a space.
_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

#: Spark's setting by which a query's shuffle files are removed when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Where the tables that :func:`saved` gave lie.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
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


def shared_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def write_file(path: str, data: bytes) -> None:
    """A small file in the shared folder, from the driver or a task."""
    store, where = fs.FileSystem.from_uri(path)
    store.create_dir(where.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(where) as out:
        out.write(data)


def read_file(path: str) -> bytes:
    """The bytes that :func:`write_file` wrote."""
    store, where = fs.FileSystem.from_uri(path)
    with store.open_input_stream(where) as data:
        return data.read()


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again; this cuts its lineage.

    The files survive the loss of any executor, so a later stage never recomputes what is above.
    The shuffle files of the write go with its end, as nothing reads them again.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that :func:`saved` gave; call it once all that reads them is itself saved."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(_PATHS.pop(t))
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def most_frequent(counts: DataFrame, n: str, size: int) -> DataFrame:
    """The rows of ``counts`` with the largest ``n``, at most ``size`` of them.

    A histogram over logarithmic bins of n (a thousand rows at most) gives the cut, so no task sorts
    all. Of the bin that doesn't fit, the largest go in, of equals those first by the other columns.
    """
    bin_ = F.floor(F.log2(F.col(n).cast("double")) * 16)
    total, whole, partly = 0, None, None
    for r in sorted(counts.groupBy(bin_.alias("b")).agg(F.count("*").alias("c")).collect(), reverse=True):
        if total + r.c > size:
            partly = r.b
            break
        total, whole = total + r.c, r.b
    out = counts.filter(bin_ >= whole) if whole is not None else counts.limit(0)
    if partly is None or total == size:
        return out
    order = [F.desc(n), *(c for c in counts.columns if c != n)]
    return out.unionByName(counts.filter(bin_ == partly).orderBy(*order).limit(size - total))


def own(name: str) -> Column:
    """The column of exactly that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered_names(df: DataFrame) -> DataFrame:
    """``df`` with columns c0, c1, ...: Arrow functions take columns by name, and names may have dots."""
    return df.toDF(*(f"c{k}" for k in range(len(df.columns))))


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def row_digest(df: DataFrame) -> Column:
    """A 64-bit digest of all columns of a row, of any names and types; maps count by their JSON."""
    return F.xxhash64(*(F.to_json(F.struct(own(f.name).alias("v"))) if _has_map(f.dataType) else own(f.name) for f in df.schema))


def hot_apart(rows: DataFrame, table: DataFrame, on: list[str], n: str, total: int, share: int = 1000, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` (one row per key ``on``, of which ``n`` rows are) without its column n.

    A key of more than 1 / ``share`` of ``total`` rows is hot: as the rows of all keys are at most ``total``,
    there are fewer than ``share`` of them. They are sent to all tasks; the rows of the others meet by key.
    """
    hot, rest = (table.filter(c).drop(n) for c in (F.col(n) > total / share, F.col(n) <= total / share))
    hot = F.broadcast(hot)
    return rows.join(hot, on).unionByName(rows.join(hot.select(*on), on, "left_anti").join(rest, on, how))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Sees to it that texts reach Python in batches of at most ``rows``, unless the session says
    otherwise: whole texts can be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":  # its default
        spark.conf.set(name, str(rows))


def alnum_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, in UTF-8."""
    return text.encode().translate(_ALNUM).split() if text else []


def space_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, in UTF-8."""
    return text.encode().lower().split() if text else []


def batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A record batch of lists or arrays by name, cast to ``schema``."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )
