"""N-gram Jaccard join: count vectors in R-trees, exact verification, connected groups.

A document is the set of its word n-grams. Its n-grams are hashed into groups; how many fall into
each is its count vector, a point. The overlap of two sets is at most the sum of the smaller
coordinates of their points, and for all points below a node of an R-tree at most the sum of the
smaller of the query's coordinates and the node's upper corner. What the bound can't exclude is
verified on the sets.

One tree over a corpus would have to be in one place, and points of unrelated documents of a length
lie close to each other; so documents are first dealt to neighbourhoods, in which every pair that
can link meets: two sets with a Jaccard similarity of t share at least l elements among the first
n - ceil(t n) + l elements of each, in any order common to all (here: rare ones first). A set that
shares fewer of them with all others together links with none. A neighbourhood takes in all sets
that share such an element with its hub.

A neighbourhood is cut into slices of a bounded size, each with the hub's own set, and a tree over
each slice finds its links. Where there are several slices, trees find what links the slices: sets
outside of the largest component so far ask the trees of all other slices. Only links between sets
that aren't yet known to be connected are looked for, so the output is a forest, whatever the size of
a group of copies. The sets themselves travel only where their points can't exclude a link.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from .common import dropped, hot_apart, own, row_digest, saved, space_words

#: Counters of the frequency sketch, groups of a count vector, leaf and node sizes of a tree.
_COUNTERS, _CHUNK, GROUPS, LEAF, FAN = 1 << 18, 1 << 12, 128, 16, 8
#: A set of n elements gives n // _SPARE more of them than needed, so that partners share more.
_SPARE = 20
_BITS, _BIT_CHUNK = 1 << 25, 1 << 19
_P = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _folded(m: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` mixed word hashes."""
    h = m[: len(m) - n + 1].copy()
    for k in range(1, n):
        h = h * _P + m[k : len(m) - n + 1 + k]
    return _mixed(h + np.uint64(n))


def shingle_sets(texts: list[str | None], n: int = 5) -> list[np.ndarray]:
    """For each text the distinct n-grams of its words as sorted 64-bit hashes; fewer words than n
    are one n-gram, no words none. The texts are hashed together."""
    words = [space_words(t) for t in texts]
    ends = np.cumsum([len(w) for w in words])
    total = int(ends[-1]) if len(ends) else 0
    m = _mixed(np.fromiter(map(xxh3_64_intdigest, chain.from_iterable(words)), dtype=np.uint64, count=total))
    runs, out = _folded(m, n) if total >= n else m[:0], []
    for w, end in zip(words, ends.tolist()):
        start = end - len(w)
        s = np.sort(runs[start : end - n + 1]) if len(w) >= n else _folded(m[start:end], len(w)) if w else m[:0]
        out.append(s[np.append(True, s[1:] != s[:-1])] if len(s) > 1 else s)
    return out


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    """The set of one text."""
    return shingle_sets([text], n)[0]


def point(s: np.ndarray) -> np.ndarray:
    """The count vector of a set."""
    return np.bincount((s >> np.uint64(40)).astype(np.int64) % GROUPS, minlength=GROUPS).astype(np.int32)


def _signature(s: np.ndarray) -> tuple[int, int]:
    d = xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


# --- sets and their rare elements -------------------------------------------------------------


def _signatures(docs: DataFrame, n: int) -> DataFrame:
    """(id, n, s1, s2) of each document and (chunk, counts) of the sketch of each task."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("chunk", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        sketch = np.zeros(_COUNTERS, dtype=np.int64)
        for b in batches:
            sets = shingle_sets(b.column(1).to_pylist(), n)
            sketch += np.bincount((np.concatenate(sets) % np.uint64(_COUNTERS)).astype(np.int64), minlength=_COUNTERS) if sets else 0
            marks = [_signature(s) for s in sets]
            none = [None] * len(sets)
            columns = [b.column(0), [len(s) for s in sets], [m[0] for m in marks], [m[1] for m in marks], none, none]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        for c in range(0, _COUNTERS, _CHUNK):
            row = {"chunk": c // _CHUNK, "counts": sketch[c : c + _CHUNK].astype("<i4" if sketch.max() < 1 << 31 else "<i8").tobytes()}
            yield pa.RecordBatch.from_pylist([row], schema)

    return docs.mapInArrow(run, "id bigint, n bigint, s1 bigint, s2 bigint, chunk int, counts binary")


def _levels(parts: DataFrame) -> np.ndarray:
    """For each counter of the sketch a level by which elements are ordered: the bit length of
    what its sum has over the usual sum, so elements that many sets share come last."""

    def add(key, table):
        total = np.zeros(_CHUNK, dtype=np.int64)
        for c in table.column("counts").to_pylist():
            total += np.frombuffer(c, dtype="<i4" if len(c) == 4 * _CHUNK else "<i8")
        return pa.table({"chunk": [key[0].as_py()], "total": [total.tobytes()]}, schema=pa.schema([("chunk", pa.int32()), ("total", pa.binary())]))

    rows = parts.select("chunk", "counts").groupBy("chunk").applyInArrow(add, "chunk int, total binary").collect()
    total = np.zeros(_COUNTERS, dtype=np.int64)  # a fixed size, whatever the input
    for r in rows:
        total[r.chunk * _CHUNK : (r.chunk + 1) * _CHUNK] = np.frombuffer(r.total, dtype=np.int64)
    usual = float(np.median(total))
    return np.ceil(np.log2(np.maximum(0, total - usual - 4 * usual**0.5) + 1)).astype(np.uint8)


def rare_first(s: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The elements of a set in the common order: by level, then by hash."""
    level = levels[(s % np.uint64(_COUNTERS)).astype(np.int64)].astype(np.uint64)
    return s[np.argsort(level << np.uint64(58) | s >> np.uint64(6), kind="stable")]


def _rare_elements(docs: DataFrame, n: int, num: int, den: int, levels: np.ndarray) -> DataFrame:
    """(key, s1): for each set the elements of which a similar set shares one. A task gives them
    once for equal sets."""
    given = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches):
        seen = set()
        for b in batches:
            keys, of = [], []
            for s in shingle_sets(b.column(1).to_pylist(), n):
                mark = _signature(s)
                if not len(s) or mark in seen:
                    continue
                if len(seen) < 500_000:
                    seen.add(mark)
                size = min(len(s), len(s) - -(-num * len(s) // den) + 1 + len(s) // _SPARE)
                keys.append(rare_first(s, given.value)[:size].view(np.int64))
                of.append(np.full(size, mark[0], dtype=np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(of))], names=["key", "s1"])

    return docs.mapInArrow(run, "key bigint, s1 bigint")


def _marked_ids(ids: DataFrame) -> np.ndarray:
    """A bit for each hash of an id, set for those in ``ids`` (rid): 4 MB, whatever the input.

    It spares most of the other documents the shuffle; those that it lets by do no harm.
    """

    def run(key, table):
        bit = _bit(table.column("rid").to_numpy()) % _BIT_CHUNK
        bits = np.zeros(_BIT_CHUNK, dtype=np.uint8)
        bits[bit] = 1
        return pa.table({"chunk": [key[0].as_py()], "bits": [np.packbits(bits).tobytes()]}, schema=pa.schema([("chunk", pa.int32()), ("bits", pa.binary())]))

    def chunks(batches):
        for b in batches:
            chunk = (_bit(b.column(0).to_numpy()) // _BIT_CHUNK).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(chunk)], names=["rid", "chunk"])

    rows = ids.mapInArrow(chunks, "rid bigint, chunk int").groupBy("chunk").applyInArrow(run, "chunk int, bits binary")
    out = np.zeros(_BITS // 8, dtype=np.uint8)
    for r in rows.toLocalIterator():
        at = r.chunk * _BIT_CHUNK // 8
        out[at : at + _BIT_CHUNK // 8] = np.frombuffer(r.bits, dtype=np.uint8)
    return out


def _bit(ids: np.ndarray) -> np.ndarray:
    return (_mixed(ids.astype(np.int64).view(np.uint64)) % np.uint64(_BITS)).astype(np.int64)


def _shared_keys(rows: DataFrame) -> DataFrame:
    """The distinct rows (key, s1) whose key has several s1; the sorted rows stream by."""

    def run(batches):
        k = s = np.zeros(0, dtype=np.int64)
        given = False  # whether the row that is carried over has been given out
        for b in batches:
            k = np.concatenate([k, b.column(0).to_numpy()])
            s = np.concatenate([s, b.column(1).to_numpy()])
            if not len(k):
                continue
            new = np.append(True, (k[1:] != k[:-1]) | (s[1:] != s[:-1]))
            k, s = k[new], s[new]
            same = k[1:] == k[:-1]
            out = np.append(False, same) | np.append(same, False)
            if given:
                out[0] = False
            given = bool(out[-1]) or given and len(k) == 1
            yield pa.RecordBatch.from_arrays([pa.array(k[out]), pa.array(s[out])], names=["key", "s1"])
            k, s = k[-1:], s[-1:]

    return rows.repartition("key").sortWithinPartitions("key", "s1").mapInArrow(run, "key bigint, s1 bigint")


def _neighbourhoods(blocks: DataFrame) -> DataFrame:
    """(hub, s1, shared): the sets of each hub's neighbourhood, with the number of shared keys.

    The hub of a key is the set whose keys are shared most on average; of a group of edited copies
    that is the original, which has no rare elements of its own.
    """
    size = blocks.groupBy("key").agg(F.count("*").alias("size"))
    fame = blocks.join(size, "key").groupBy("s1").agg((F.sum("size") / F.count("*")).alias("fame"))
    hub = blocks.join(fame, "s1").groupBy("key").agg(F.max(F.struct("fame", "s1")).alias("h"))
    rows = blocks.join(hub.select("key", F.col("h.s1").alias("hub")), "key")
    return rows.groupBy("hub", "s1").agg(F.count("*").alias("shared"))


def _needed(near: DataFrame, least: DataFrame) -> DataFrame:
    """The rows of ``near`` in which every pair that can link still meets.

    Two such sets share at least ``least`` keys (s1, least; either set's own figure holds). A set
    leaves the neighbourhoods that have the fewest of its keys as long as these are less than half
    of its figure. What both leave can't hold all keys that they share, so they meet in a
    neighbourhood that neither leaves. This parts long texts that have a passage in common.
    """
    first = Window.partitionBy("s1").orderBy("shared", "hub").rowsBetween(Window.unboundedPreceding, 0)
    rows = near.join(least, "s1").withColumn("left", F.sum("shared").over(first))
    rows = rows.filter(2 * F.col("left") >= F.col("least")).select("hub", "s1", "shared")
    several = rows.groupBy("hub").agg(F.count("*").alias("size")).filter("size > 1").select("hub")
    return rows.join(several, "hub", "left_semi")


# --- the tree ---------------------------------------------------------------------------------


class RTree:
    """A packed R-tree of count vectors with the sizes of their sets.

    Points are sorted by size and dealt to leaves in that order, within slabs by their fullest
    group, so that a node's corner stays low. Each node keeps the upper corner and the range of sizes.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = np.argsort(sizes, kind="stable")
        for a in range(0, len(order), LEAF * FAN):
            slab = order[a : a + LEAF * FAN]
            order[a : a + LEAF * FAN] = slab[np.argsort(points[slab].argmax(axis=1), kind="stable")]
        self.order, self.points, self.sizes = order, points[order], sizes[order]
        self.levels = []
        top, low, high = self.points, self.sizes, self.sizes
        for width in (LEAF, FAN, FAN, FAN):
            at = np.arange(0, len(top), width)
            top = np.maximum.reduceat(top, at) if len(at) else top
            low = np.minimum.reduceat(low, at) if len(at) else low
            high = np.maximum.reduceat(high, at) if len(at) else high
            self.levels.append((width, top, low, high))

    def query(self, q: np.ndarray, size: int, num: int, den: int) -> np.ndarray:
        """The numbers of the points whose sets may be similar to a set of ``size`` with point q."""
        at = np.arange(len(self.levels[-1][1]))
        for k in range(len(self.levels) - 1, -1, -1):
            width, top, low, high = self.levels[k]
            at = at[(den * high[at] >= num * size) & (num * low[at] <= den * size)]
            at = at[(num + den) * np.minimum(top[at], q).sum(axis=1) >= num * (low[at] + size)]
            below = len(self.levels[k - 1][1]) if k else len(self.points)
            at = (at[:, None] * width + np.arange(width)).reshape(-1)
            at = at[at < below]
        n = self.sizes[at]
        at = at[(den * n >= num * size) & (num * n <= den * size)]
        at = at[(num + den) * np.minimum(self.points[at], q).sum(axis=1) >= num * (self.sizes[at] + size)]
        return self.order[at]


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether den * |a & b| >= num * |a | b|."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int(np.count_nonzero(b[at] == a))
    return den * both >= num * (len(a) + len(b) - both)


# --- the join ---------------------------------------------------------------------------------


_PIECE = ["hub", "i", "j", "stored", "asks", "rid", "s1", "s2", "n", "c"]
_PIECES = "hub bigint, i bigint, j bigint, stored boolean, asks boolean, rid bigint, s1 bigint, s2 bigint, n bigint, c bigint"


def _parts(n: str, rows: str, most: int, most_rows: int):
    """How many parts hold at most about ``most`` elements and ``most_rows`` sets each."""
    return F.greatest(F.ceil(F.col(n) / most), F.ceil(F.col(rows) / most_rows))


def _slices(members: DataFrame, most: int, most_rows: int) -> DataFrame:
    """The members of each neighbourhood in slices by hash, the hub in all; all ask all."""
    sizes = members.groupBy("hub").agg(F.sum("n").alias("total"), F.count("*").alias("rows"))
    large = sizes.select("hub", _parts("total", "rows", most, most_rows).alias("parts")).filter("parts > 1")
    # Few hubs have several slices, so Spark broadcasts them and a hub's rows needn't meet here.
    rows = members.join(large, "hub", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    own = F.array(F.pmod(F.xxhash64("rid"), F.col("parts")))
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    rows = rows.withColumn("i", F.explode(F.when(F.col("hub") == F.col("s1"), every).otherwise(own)))
    yes = F.lit(True)
    return rows.withColumns({"j": F.lit(0).cast("long"), "stored": yes, "asks": yes, "c": F.col("rid")}).select(_PIECE)


def _across(members: DataFrame, component: DataFrame, most: int, most_rows: int) -> DataFrame:
    """Pieces of the neighbourhoods that have several slices and components: piece (i, j) holds the
    members of slice i, and the strays of slice j ask. Strays are the members outside of the
    neighbourhood's largest component, so every pair of one and a member meets."""
    sizes = members.groupBy("hub").agg(F.sum("n").alias("total"), F.count("*").alias("rows"))
    sizes = sizes.select("hub", _parts("total", "rows", most, most_rows).alias("ni")).filter("ni > 1")
    rows = members.join(sizes, "hub").join(component, "rid", "left").withColumn("c", F.coalesce("c", "rid"))
    of = rows.groupBy("hub", "c").agg(F.sum("n").alias("total"), F.count("*").alias("rows"))
    hubs = of.groupBy("hub").agg(
        F.max(F.struct("rows", "c"))["c"].alias("main"), F.max(F.struct("rows", "c", "total"))["total"].alias("kept"),
        F.max("rows").alias("kept_rows"), F.sum("total").alias("total"), F.sum("rows").alias("rows"),
    ).filter("rows > kept_rows")
    hubs = hubs.withColumns({"total": F.col("total") - F.col("kept"), "rows": F.col("rows") - F.col("kept_rows")})
    rows = rows.join(hubs.select("hub", "main", _parts("total", "rows", most, most_rows).alias("nj")), "hub")
    i, j = F.pmod(F.xxhash64("rid"), F.col("ni")), F.pmod(F.xxhash64("rid", F.lit(1)), F.col("nj"))
    every_j, every_i = (F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)) for n in ("nj", "ni"))
    yes, no = F.lit(True), F.lit(False)
    stored = rows.withColumns({"i": i, "j": every_j, "stored": yes, "asks": no})
    asks = rows.filter("c <> main").withColumns({"i": every_i, "j": j, "stored": no, "asks": yes})
    return stored.select(_PIECE).unionByName(asks.select(_PIECE))


def _columns(table: pa.Table):
    """Of a piece: the numbers of the stored and the asking sets, sizes, components and points.

    The points of small sets come in two bytes a group."""
    stored, asks = (np.flatnonzero(np.array(table.column(x).to_pylist(), dtype=bool)) for x in ("stored", "asks"))
    n, c = table.column("n").to_numpy(), np.unique(table.column("c").to_numpy(), return_inverse=True)[1]
    rows = [np.frombuffer(x, dtype="<u2" if len(x) == 2 * GROUPS else "<u4") for x in table.column("point").to_pylist()]
    return stored, asks, n, c, np.array(rows, dtype=np.int32).reshape(-1, GROUPS)


def _candidates(pieces: DataFrame, points: DataFrame, num: int, den: int) -> DataFrame:
    """The rows of ``pieces`` whose points don't exclude a link with another component."""

    def run(table):
        stored, asks, n, c, points = _columns(table)
        used = np.zeros(len(n), dtype=bool)
        tree = RTree(points[stored], n[stored])
        for q in asks.tolist():
            if used.all():
                break
            found = stored[tree.query(points[q], int(n[q]), num, den)]
            found = found[c[found] != c[q]]
            if len(found):
                used[found] = used[q] = True
        return table.select([*_PIECE, "point"]).filter(pa.array(used))

    rows = pieces.join(points, ["rid", "s1", "s2"]).select(*_PIECE, "point")
    return rows.groupBy("hub", "i", "j").applyInArrow(run, f"{_PIECES}, point binary")


def _links(candidates: DataFrame, elements: DataFrame, num: int, den: int) -> DataFrame:
    """Verified links (a, b) between components, enough to connect what they connect."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table):
        stored, asks, n, c, points = _columns(table)
        rid, sets = table.column("rid").to_numpy(), [np.frombuffer(x, dtype=np.uint64) for x in table.column("elements").to_pylist()]
        tree, left, a, b = RTree(points[stored], n[stored]), len(np.unique(c)), [], []
        for q in asks.tolist():
            if left < 2:
                break
            for x in stored[tree.query(points[q], int(n[q]), num, den)].tolist():
                if c[x] != c[q] and similar(sets[x], sets[q], num, den):
                    c[c == c[x]] = c[q]
                    left -= 1
                    a.append(rid[x])
                    b.append(rid[q])
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    rows = candidates.join(elements, ["rid", "s1", "s2"]).select(*_PIECE, "point", "elements")
    return rows.groupBy("hub", "i", "j").applyInArrow(run, "a bigint, b bigint")


def _computed(docs: DataFrame, ids: DataFrame, n: int, name: str, value: Callable[[np.ndarray], bytes]) -> DataFrame:
    """(rid, s1, s2, ``name``) of the sets of all rows (id, t) of ``docs`` whose id is in ``ids``, and
    of a few others. The signature tells a set from another under the same id."""
    marked = docs.sparkSession.sparkContext.broadcast(_marked_ids(ids.select("rid")))
    schema = pa.schema([("rid", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), (name, pa.binary())])

    def run(batches):
        bits, seen = np.unpackbits(marked.value), set()
        for b in batches:
            rows, out = b.filter(pa.array(bits[_bit(b.column(0).to_numpy())] == 1)), []
            for i, s in zip(rows.column(0).to_pylist(), shingle_sets(rows.column(1).to_pylist(), n)):
                key = (i, *_signature(s))
                if key not in seen:  # of rows that repeat, a task gives one
                    out.append((*key, value(s)))
                if len(seen) < 500_000:
                    seen.add(key)
            columns = zip(*out) if out else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return docs.mapInArrow(run, f"rid bigint, s1 bigint, s2 bigint, {name} binary")


def _linked(docs: DataFrame, pieces: DataFrame, points: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The links that the trees of ``pieces`` find."""
    candidates = saved(_candidates(pieces, points, num, den), "candidates")
    elements = _computed(docs, candidates, n, "elements", np.ndarray.tobytes)
    links = saved(_links(candidates, elements, num, den), "links")
    dropped(candidates)
    return links


def components(edges: DataFrame) -> DataFrame:
    """(rid, c) for all ends of ``edges`` (a, b): the least number connected with each.

    Alternates two steps until nothing changes: each number's larger neighbours, then its smaller
    ones, are tied to the least of its neighbours and itself. A step never makes more edges.
    """
    now = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(small, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, now = now, saved(tied.unionByName(small.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "edges")
        dropped(last)
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    ends = now.select(F.col("a").alias("rid"), F.col("b").alias("c")).unionByName(now.select(F.col("b").alias("rid"), F.col("b").alias("c")))
    out = saved(ends.distinct(), "components")
    dropped(now)
    return out


def jaccard_components(
    docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, most: int = 2_000_000, most_rows: int = 2_000
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Words are runs without ASCII white space, A-Z lower-cased; a set holds the distinct runs of
    ``n`` words, or the whole of fewer. Documents link when den * |A & B| >= num * |A | B|;
    component_id is the least doc_id reachable over links. A null text or one without words has no
    set, links with nothing and is its own component. Rows of equal sets are linked, rows that
    repeat too. A null doc_id gets a null component_id and isn't a partner. Rows that
    repeat a doc_id with other texts are one document, with the links of all of them. Texts of any
    length count as a whole. An empty table gives no rows; other columns are ignored.

    A tree takes at most about ``most`` elements and ``most_rows`` sets; results don't depend on it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("t"))
    known = rows.filter("id is not null")
    first = saved(_signatures(rows, n), "signatures")
    marks = first.filter("chunk is null").drop("chunk", "counts")
    levels = _levels(first.filter("chunk is not null"))
    reps = marks.filter("n > 0 and id is not null").groupBy("s1", "s2", "n").agg(F.min("id").alias("rid"))

    keys = saved(_shared_keys(_rare_elements(known, n, num, den, levels)), "keys")
    # A partner has at least num / den as many elements, and gives as many spare ones.
    needs = reps.groupBy("s1").agg((1 + F.floor(F.min("n") * num / (den * _SPARE))).alias("least"))
    enough = keys.groupBy("s1").agg(F.count("*").alias("keys")).join(needs, "s1").filter("keys >= least")
    enough = saved(enough.select("s1", "least"), "enough")
    blocks = saved(keys.join(enough, "s1", "left_semi"), "blocks")
    dropped(keys)
    near = saved(_needed(_neighbourhoods(blocks), enough), "neighbourhoods")
    dropped(blocks, enough)
    members = saved(near.join(reps, "s1").select("hub", "s1", "s2", "n", "rid"), "members")
    dropped(near)

    points = saved(
        _computed(known, members, n, "point", lambda s: point(s).astype("<u2" if len(s) < 1 << 16 else "<u4").tobytes()), "points"
    )
    within = _linked(known, _slices(members, most, most_rows), points, n, num, den)
    component = components(within)
    pieces = saved(_across(members, component, most, most_rows), "pieces")
    if pieces.isEmpty():
        final = component
    else:
        across = _linked(known, pieces, points, n, num, den)
        final = components(within.unionByName(across))
        dropped(across, component)
    dropped(pieces, points, members, within)

    copies = marks.filter("n > 0 and id is not null").groupBy("s1", "s2").agg(F.min("id").alias("rid"), F.count("*").alias("copies"))
    named = saved(copies.join(final, "rid", "left").select("s1", "s2", F.coalesce("c", "rid").alias("c"), "copies"), "named")
    total = named.agg(F.sum("copies")).first()[0] or 0
    # Rows without a set or an id have no name to look up, and those of a hot set don't meet.
    asks = marks.filter("n > 0 and id is not null")
    rest = marks.filter("n = 0 or id is null").withColumn("c", F.col("id"))
    out = hot_apart(asks, named, ["s1", "s2"], "copies", total).unionByName(rest)
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("id")).otherwise(F.col("c")).alias("component_id"),
    )


def one_of_each_set(docs: DataFrame, n: int = 5) -> DataFrame:
    """``docs`` with one row, of the least digest, of those with equal sets of runs of ``n`` words;
    texts without words are told apart by their bytes."""

    def run(batches):
        for b in batches:
            of = [_signature(s) if len(s) else (None, None) for s in shingle_sets(b.column(1).to_pylist(), n)]
            marks = [pa.array([x[k] for x in of], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *marks], names=["row", "text", "h", "s1", "s2"])

    rows = docs.select(F.struct(*(own(c).alias(c) for c in docs.columns)).alias("row"), "text", row_digest(docs).alias("h"))
    signed = rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType())]))
    wordless = F.when(F.col("s1").isNull(), F.xxhash64("text"))
    # min_by takes rows with maps, which have no order of their own.
    return signed.groupBy("s1", "s2", wordless.alias("t")).agg(F.min_by("row", "h").alias("row")).select("row.*")
