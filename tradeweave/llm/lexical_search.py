"""Ranked lexical search of items over all documents by dense blocked matrix products.

Items are dealt to shards of a bounded number of terms. A shard's terms get small numbers; documents
keep only these, with their frequencies, so texts are read once a shard. Items of a shard form tiles
over a compact vocabulary; a block of documents becomes a dense tile of impacts over the same terms, and
one product in float64 scores all pairs of both. All factors are whole numbers and a product adds so few
terms that partial sums stay below 2**53, so it is exact in any order of addition. Each task keeps the
best documents of each item with ties by doc_id, and Spark merges the tasks' lists.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from .common import alnum_words, batch, dropped, read_file, saved, shared_path, write_file

#: Fixed values of the score: the scale of weights and impacts, and the share of the length in a
#: document's damping (in hundredths).
SCALE, IMPACT, SHARE = 1000, 1_000_000_000, 90
#: Terms and items of a tile at most; documents of a block.
WIDTH, ITEMS, BLOCK = 4096, 256, 512


def weight(n_docs: int, df: int) -> int:
    """A term's weight, rounded down; not negative as long as ``df <= n_docs``."""
    return math.floor(SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def damping(n: int, n_docs: int, total: int) -> int:
    """A document's m out of its number of terms."""
    return 100 - SHARE + SHARE * n * n_docs // total


def tile_width(n_docs: int, most: int = WIDTH) -> int:
    """How many terms one product may add so that no partial sum reaches 2**53: a weight is at most that
    of a term in no document, an impact less than IMPACT / SCALE."""
    return max(1, min(most, (2**53 - 1) // (max(1, weight(n_docs, 0)) * (IMPACT // SCALE))))


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term): the distinct terms of each item; rows of one item_id are one item."""

    def run(batches):
        for b in batches:
            sets = [sorted(set(alnum_words(t))) for t in b.column(1).to_pylist()]
            at = pa.array([k for k, s in enumerate(sets) for _ in s], pa.int64())
            terms = pa.array([w.decode() for s in sets for w in s], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), terms], names=["item", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, f"item {kind}, term string").distinct()


def _vocabularies(terms: DataFrame, folder: str) -> DataFrame:
    """(shard, term, number): each shard's terms in order; their list goes to a file of the folder, too."""

    def write(table):
        words = sorted(set(w.encode() for w in table.column("term").to_pylist()))
        shard = table.column("shard")[0].as_py()
        write_file(f"{folder}/terms-{shard}", pickle.dumps(words, pickle.HIGHEST_PROTOCOL))
        return pa.table({"shard": [shard] * len(words), "term": [w.decode() for w in words], "number": pa.array(range(len(words)), pa.int32())})

    return saved(terms.select("shard", "term").groupBy("shard").applyInArrow(write, "shard long, term string, number int"), "vocabulary")


@lru_cache(1)
def _vocabulary(path: str) -> dict[bytes, int]:
    return {w: k for k, w in enumerate(pickle.loads(read_file(path)))}


def frequencies(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n, terms, tf): for documents with terms, how many, and those of the vocabulary file."""

    def run(batches):
        for b in batches:
            known, out = _vocabulary(path), {"n": [], "terms": [], "tf": []}
            keep = []
            for k, text in enumerate(b.column(1).to_pylist()):
                words = alnum_words(text)
                if not words:
                    continue
                found = Counter(filter(known.__contains__, words))
                keep.append(k)
                out["n"].append(len(words))
                out["terms"].append([known[w] for w in found])
                out["tf"].append(list(found.values()))
            rest = batch(out, pa.schema([("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), *rest.columns], names=["doc_id", *rest.schema.names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).mapInArrow(run, f"doc_id {kind}, n bigint, terms array<int>, tf array<bigint>")


def _tiles(terms: DataFrame, folder: str, n_docs: int, most: tuple[int, int]) -> list[str]:
    """Writes the tiles of (shard, tile, item, number, df) as files, and gives their paths. A tile has
    its items and, for each run of at most :func:`tile_width` of its terms, the terms' numbers and the
    dense weights (items x terms)."""
    most_items, width = most[0], tile_width(n_docs, most[1])

    def write(table):
        paths, items = [], list(dict.fromkeys(table.column("item").to_pylist()))
        place = {i: k for k, i in enumerate(items)}
        rows = np.array([place[i] for i in table.column("item").to_pylist()])
        numbers, df = table.column("number").to_numpy(), table.column("df").to_numpy()
        weights = {d: weight(n_docs, d) for d in set(df.tolist())}
        w = np.array([weights[d] for d in df.tolist()], np.float64)
        for first in range(0, len(items), most_items):
            mine = (rows >= first) & (rows < first + most_items)
            columns, at = np.unique(numbers[mine], return_inverse=True)
            parts = []
            for start in range(0, len(columns), width):
                inside = (at >= start) & (at < start + width)
                parts.append((columns[start : start + width], rows[mine][inside] - first, at[inside] - start, w[mine][inside]))
            path = f"{folder}/tile-{table.column('shard')[0].as_py()}-{table.column('tile')[0].as_py()}-{first}"
            write_file(path, pickle.dumps((items[first : first + most_items], parts), pickle.HIGHEST_PROTOCOL))
            paths.append(path)
        return pa.table({"path": pa.array(paths, pa.string())})

    return sorted(r.path for r in terms.groupBy("shard", "tile").applyInArrow(write, "path string").collect())


@lru_cache(1)
def _loaded(paths: tuple[str, ...]) -> list:
    return [pickle.loads(read_file(p)) for p in paths]


class _Best:
    """The ``k`` best (score, doc_id) of each item of a tile; of equal scores those of lesser doc_id."""

    def __init__(self, n_items: int, k: int):
        self.k, self.rows = k, [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)  # a score below can't enter

    def add(self, scores: np.ndarray, ids: list) -> None:
        """Scores (items x documents) of documents whose ids ascend."""
        k = self.k
        least = self.least
        if scores.shape[1] > k:  # the block's own k-th score bounds what enters, ties included
            least = np.maximum(least, np.partition(scores, -k, axis=1)[:, -k])
        at, docs = np.nonzero(scores >= least[:, None])
        for i in np.unique(at).tolist():
            mine = docs[at == i]
            own = scores[i, mine]
            order = np.argsort(-own, kind="stable")[:k].tolist()  # documents ascend, so ties keep the first
            rows = self.rows[i] + [(int(own[j]), ids[mine[j]]) for j in order]
            rows.sort(key=lambda r: (-r[0], r[1] is not None, r[1] if r[1] is not None else 0))
            self.rows[i] = rows[:k]
            if len(rows) >= k:
                self.least[i] = max(1, self.rows[i][-1][0])


def _scored(docs: DataFrame, paths: list[str], n_docs: int, total: int, k: int, item: T.DataType, block: int) -> DataFrame:
    """(item_id, doc_id, score, part): the best of each task over documents of :func:`frequencies`."""
    doc = docs.schema["doc_id"].dataType
    schema = pa.schema([("item_id", to_arrow_type(item)), ("doc_id", to_arrow_type(doc)), ("score", pa.int64())])

    def impacts(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a block: the document, the term and the impact of each frequency."""
        _, n, terms, tf = part.columns
        at = np.repeat(np.arange(len(part)), pc.list_value_length(terms).to_numpy())
        m, f = np.array([damping(x, n_docs, total) for x in n.to_pylist()], np.int64)[at], tf.flatten().to_numpy()
        return at, terms.flatten().to_numpy(), (IMPACT * f) // (SCALE * f + 8 * m)

    def run(batches):
        tiles = _loaded(tuple(paths))
        best = [_Best(len(items), k) for items, _ in tiles]
        columns_of = np.zeros(1 + max(int(columns[-1]) for _, parts in tiles for columns, *_ in parts), np.int64)
        for b in batches:
            b = b.take(pc.sort_indices(b.column(0), null_placement="at_start"))
            for first in range(0, b.num_rows, block):
                part = b.slice(first, block)
                ids, (at, terms, impact) = part.column(0).to_pylist(), impacts(part)
                for top, (items, parts) in zip(best, tiles):
                    scores = np.zeros((len(items), len(ids)), np.int64)
                    for columns, rows, where, w in parts:
                        columns_of[columns] = np.arange(1, len(columns) + 1)
                        inside = terms < len(columns_of)
                        place = np.where(inside, columns_of[np.where(inside, terms, 0)], 0)
                        columns_of[columns] = 0
                        weights, dense = np.zeros((len(items), len(columns))), np.zeros((len(ids), len(columns)))
                        weights[rows, where] = w
                        has = place > 0
                        dense[at[has], place[has] - 1] = impact[has]
                        scores += (weights @ dense.T).astype(np.int64)
                    top.add(scores, ids)
        for top, (items, _) in zip(best, tiles):
            found = [(i, d, s) for i, rows in zip(items, top.rows) for s, d in rows]
            if found:
                yield batch(dict(zip(schema.names, map(list, zip(*found)))), schema)

    kinds = f"item_id {item.simpleString()}, doc_id {doc.simpleString()}, score bigint"
    return docs.select("doc_id", "n", "terms", "tf").mapInArrow(run, kinds).withColumn("part", F.spark_partition_id())


def _best(rows: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, shard_terms: int = 1 << 19, tile: tuple[int, int] = (ITEMS, WIDTH), block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score for each item.

    Terms are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. A score sums, over the
    item's distinct terms, weight times impact in whole numbers; documents with score 0 aren't ranked, so
    an item may have fewer rows or none. Equal scores rank by ascending doc_id, null first. A null or
    empty text has no terms and doesn't count as a document. Rows that repeat are documents each; rows of
    one item_id, null included, are one item with the terms of all. Texts of any length count as a
    whole. Without documents or items there are no rows. Other columns are ignored.

    Shards have about ``shard_terms`` (item, term) pairs, or one item; documents are read once a shard.
    ``tile`` has the items and terms of a tile at most, ``block`` the documents.
    """
    spark, folder = docs.sparkSession, shared_path(docs.sparkSession, "search")
    item, doc = items.schema["item_id"].dataType, docs.schema["doc_id"].dataType
    terms = saved(item_terms(items), "item-terms")
    pairs, distinct = terms.agg(F.count("*"), F.count_distinct(F.struct("item"))).first()
    n_shards = max(1, -(-pairs // shard_terms))
    per_shard = max(1, -(-distinct // (n_shards * tile[0])))
    dealt = {"shard": F.pmod(F.xxhash64("item"), F.lit(n_shards)), "tile": F.pmod(F.xxhash64("item", F.lit(1)), F.lit(per_shard))}
    terms = terms.withColumns(dealt)
    numbers, found, stats = _vocabularies(terms, folder), [], None
    for shard in [r.shard for r in numbers.select("shard").distinct().collect()]:  # a few, or one for each large item
        rows = saved(frequencies(docs, f"{folder}/terms-{shard}"), "frequencies")
        stats = stats or rows.agg(F.count("*"), F.sum("n")).first()
        if stats[0]:
            df = rows.select(F.explode("terms").alias("number")).groupBy("number").agg(F.count("*").alias("df"))
            own = numbers.filter(F.col("shard") == shard).join(df, "number").drop("shard")
            paths = _tiles(terms.filter(F.col("shard") == shard).join(own, "term"), folder, stats[0], tile)
            if paths:
                found.append(saved(_scored(rows, paths, *stats, k, item, block), "best"))
        dropped(rows)
    if not found:
        none = T.StructType([T.StructField(n, t) for n, t in (("item_id", item), ("rank", T.IntegerType()), ("doc_id", doc), ("score", T.LongType()))])
        return spark.createDataFrame([], none)
    # Lists of many tasks merge in two steps, so that no task gets those of all.
    some = _best(reduce(DataFrame.unionByName, found).withColumn("part", F.col("part") % 256), k, "item_id", "part")
    return _best(some.drop("rank", "part"), k, "item_id").select("item_id", "rank", "doc_id", "score")
