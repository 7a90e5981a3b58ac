"""A Merkle manifest of a dataset: leaves, one subtree for each group, a root over the subtrees, proofs.

Leaves of a group are numbered by key without a group meeting in one task. A run of ``8**height``
consecutive nodes is a superblock. On the way up each superblock becomes one node of the level above;
on the way down the nodes of a superblock are cogrouped with the path that its own node needs outside
of it, and one function finishes the local reduction, joins local siblings and outer path to each
node's proof, and folds the claimed leaf along it. No task holds more than one superblock.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import dropped, own, saved

ARITY = 8
#: Levels that are reduced within a superblock: 512 leaves.
HEIGHT = 3

#: The siblings to the left and to the right at each level from a node to the root, as joined hex text.
_PATH = "array<struct<left:string,right:string>>"


def field_text(value: Column, kind: T.DataType | None = None) -> Column:
    """A value as a leaf states it: ``-`` if null, else the byte count of its text, ``:``, the text."""
    if kind is not None and not isinstance(kind, T.AtomicType):
        value = F.to_json(F.struct(value))  # arrays, structs and maps
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(docs: DataFrame, columns: Sequence[str], claimed: Mapping[str, Column] | None = None) -> Column:
    """The digest of a row over ``columns`` in this order; ``claimed`` has other values for some."""
    values = claimed or {}
    return F.sha2(F.concat(*(field_text(values.get(c, own(c)), docs.schema[c].dataType) for c in columns)), 256)


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (0, 1, ... within each group, by ``order``) and ``size``, the group's rows.

    Rows are sorted over all by range, so a hot group spreads over tasks; rows equal in ``order`` are
    told apart by where they were read. Only the first place and the count of each group in each task's
    range are joined back.
    """
    told = rows.withColumn("_u", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "_u")]
    at = saved(told.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_u").withColumn("_m", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_m", 33)
    runs = at.groupBy(F.col(group).alias("_g"), part.alias("_p")).agg(F.min("_m").alias("_first"), F.count("*").alias("_n"))
    by = Window.partitionBy("_g").orderBy("_p")
    before = F.coalesce(F.sum("_n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumn("_before", before).withColumn("size", F.sum("_n").over(Window.partitionBy("_g")))
    same = (F.col(group) == F.col("_g")) & (part == F.col("_p"))
    out = at.join(runs, same).withColumn("pos", F.col("_m") - F.col("_first") + F.col("_before"))
    kept = saved(out.drop("_g", "_p", "_m", "_first", "_n", "_before"), "numbered")
    dropped(at)
    return kept


def _h(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def _levels(digests: list[str], size: int, height: int) -> list[list[str]]:
    """The levels over a superblock's nodes, up to its own node: as many as a tree of ``size`` nodes
    needs, at most ``height``."""
    out = [digests]
    while size > 1 and len(out) <= height:
        below = out[-1]
        out.append([_h(*below[k : k + ARITY]) for k in range(0, len(below), ARITY)])
        size = -(-size // ARITY)
    return out


def _block(height: int) -> Column:
    return F.shiftright("pos", 3 * height)


def _reduced(nodes: DataFrame, height: int) -> DataFrame:
    """The level of superblocks over ``nodes`` (tree, pos, size, digest)."""

    def reduce(key, block):
        tree, b, size = key
        top = _levels(block.sort_values("pos")["digest"].tolist(), int(size), height)[-1]
        return pd.DataFrame({"tree": [tree], "pos": [int(b)], "size": [-(-int(size) // ARITY**height)], "digest": top})

    return nodes.groupBy("tree", _block(height).alias("b"), "size").applyInPandas(reduce, "tree string, pos long, size long, digest string")


def _exchange(nodes: DataFrame, outer: DataFrame, height: int, schema: str, finish) -> DataFrame:
    """Cogroups ``nodes`` with the outer path (tree, pos, path, subroot) of their superblock. ``finish``
    gets the nodes in order, the path of each as a list of (left, right), and the subroot; it gives a
    frame."""

    def join(block, above):
        block = block.sort_values("pos", ignore_index=True)
        levels = _levels(block["digest"].tolist(), int(block["size"].iloc[0]), height)
        beyond = [(s["left"], s["right"]) for s in above["path"].iloc[0]]
        paths = []
        for k in range(len(block)):
            own = []
            for level in levels[:-1]:
                start = k - k % ARITY
                own.append(("".join(level[start:k]), "".join(level[k + 1 : start + ARITY])))
                k //= ARITY
            paths.append(own + beyond)
        return finish(block, paths, above["subroot"].iloc[0])

    left = nodes.withColumn("b", _block(height))
    right = outer.select("tree", F.col("pos").alias("b"), "path", "subroot")
    return left.groupBy("tree", "b").cogroup(right.groupBy("tree", "b")).applyInPandas(join, schema)


def _structs(paths: list) -> list:
    return [[{"left": a, "right": b} for a, b in p] for p in paths]


def _with_paths(block: pd.DataFrame, paths: list, subroot: str) -> pd.DataFrame:
    return pd.DataFrame({"tree": block["tree"], "pos": block["pos"], "path": _structs(paths), "subroot": subroot})


def _up(nodes: DataFrame, height: int) -> list[DataFrame]:
    """``nodes`` and the levels of superblocks above them, until each tree has one node."""
    levels = [nodes]
    most = nodes.agg(F.max("size")).first()[0] or 0
    while most > 1:
        levels.append(saved(_reduced(levels[-1], height), "nodes"))
        most = -(-most // ARITY**height)
    return levels


def _down(levels: list[DataFrame], outer: DataFrame, height: int) -> DataFrame:
    """The paths of the nodes of the lowest of ``levels``, from the paths of the nodes above them."""
    for nodes in reversed(levels):
        outer = saved(_exchange(nodes, outer, height, f"tree string, pos long, path {_PATH}, subroot string", _with_paths), "paths")
    return outer


def manifest(
    docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang", key: str = "doc_id",
    claimed: Mapping[str, Column] | None = None, height: int = HEIGHT,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, leaf, subroot, root, proof (the siblings from the leaf to
    the root, as (left, right) for each level), proof_sha256, folded_root and verified.

    A leaf is the digest of ``columns``. Leaves of a ``group`` ascend by key (null first, then by leaf;
    rows that repeat are leaves each); while there are several, each run of 8 becomes one node, so a
    lone leaf is its group's subroot. Subroots ordered by the group's text (null first, then bytewise)
    give the root alike. ``folded_root`` comes from the leaf over ``claimed`` values, the row's own where
    there are none, and the proof; ``verified`` tells if it is the root. Nulls differ from empty texts,
    texts of any length count as a whole, other columns are ignored, whatever they are called. An empty
    table gives no rows.
    """
    mine, other = leaf(docs, columns), leaf(docs, columns, claimed)
    tree = F.coalesce(F.concat(F.lit("="), own(group).cast("string")), F.lit(""))
    rows = docs.select(tree.alias("tree"), own(key).alias("k"), mine.alias("digest"), F.nullif(other, mine).alias("other"))
    leaves = numbered(rows, "tree", ("k", "digest"))
    levels = _up(leaves.select("tree", "pos", "size", "digest"), height)

    # The subroots are the nodes of one further tree, '', and each gets its place there.
    roots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    places = numbered(roots, "tree", ("of",))
    tops = _up(places.select("tree", "pos", "size", "digest"), height)
    top = tops[-1].select("digest").first()
    root = F.lit(top[0] if top else None).cast("string")
    whole = tops[-1].select("tree", "pos", F.expr(f"cast(array() as {_PATH})").alias("path"), F.lit("").alias("subroot"))
    outer = _down(tops[:-1], whole, height).select("pos", "path").join(places.select("pos", "of", "digest"), "pos")
    outer = outer.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("subroot"))
    outer = _down(levels[1:-1], outer, height)

    def fold(block: pd.DataFrame, paths: list, subroot: str) -> pd.DataFrame:
        folded = []
        for digest, path in zip(block["other"].fillna(block["digest"]), paths):
            for left, right in path:
                digest = _h(left, digest, right)
            folded.append(digest)
        proofs = [_h(*(s for pair in p for s in pair)) for p in paths]
        return pd.DataFrame({"k": block["k"], "leaf": block["digest"], "subroot": subroot, "proof": _structs(paths), "proof_sha256": proofs, "folded_root": folded})

    lowest = leaves.withColumn("k", F.col("k").cast("string"))  # pandas would turn long keys beside nulls to doubles
    done = _exchange(lowest, outer, height, f"k string, leaf string, subroot string, proof {_PATH}, proof_sha256 string, folded_root string", fold)
    kind = docs.schema[key].dataType
    return done.select(
        F.col("k").cast(kind).alias(key), "leaf", "subroot", root.alias("root"), "proof", "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified")
    )
