"""Merkle manifest of a table: a leaf per document, a tree per source, and one over the sources.

Leaves are put into their places by a range sort. A superblock is FAN ** LEVELS consecutive nodes of a tree.
Going up, every superblock is reduced to its top, and the tops are the nodes of the next round, until
each tree is down to one node. Going down, a round's nodes and the outer nodes that their superblock needs
(the siblings on the way from its top to the root) are cogrouped by superblock; one ``applyInPandas`` call then
reduces the superblock again, joins each node's siblings in it with the outer ones, and, in the first round,
folds the leaf that is found now along them. A call holds one superblock, however large a source is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faresift.llm.common import materialise

FAN = 16
LEVELS = 3
SUPERBLOCK = FAN**LEVELS
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST_CHARS = 64


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _said(column: Column) -> Column:
    """``-`` for null, else the value behind its count of UTF-8 bytes, so that neighbours cannot run together."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(text: Column) -> Column:
    """Digest of a document row that has this text."""
    return F.sha2(F.concat(*[_said(text if c == "text" else F.col(c)) for c in LEAF_COLUMNS]), 256)


# --- Places -----------------------------------------------------------------------------


def _numbered(rows: DataFrame) -> DataFrame:
    """Add ``local``, the number of a row among those of its tree in its partition; rows are sorted by tree."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([*rows.schema.fields]).add("local", "long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, before = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("tree")
            new = np.zeros(batch.num_rows, bool)
            new[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
            at = np.arange(batch.num_rows)
            local = at - np.maximum.accumulate(np.where(new, at, 0))
            if keys[0].as_py() == tree:
                local[: int(np.argmax(new)) if new.any() else None] += before
            tree, before = keys[-1].as_py(), int(local[-1]) + 1
            columns = [*batch.columns, pa.array(local, pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return rows.mapInArrow(run, schema)


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    """Add ``place``, the rank from 0 in the row's tree by this order, and ``total``, the tree's rows.

    A range sort deals rows out evenly whatever the sizes of trees; only counts per tree and range are summed up.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = materialise(_numbered(ranged.withColumn("part", F.spark_partition_id())), "merkle-sorted")
    own = Window.partitionBy("tree")
    counts = ranged.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(
        "tree", "part", (F.sum("n").over(own.orderBy("part")) - F.col("n")).alias("ahead"), F.sum("n").over(own).alias("total")
    )
    found = ranged.join(materialise(counts, "merkle-counts"), ["tree", "part"])
    return found.withColumn("place", F.col("ahead") + F.col("local")).drop("part", "local", "ahead")


# --- Up -----------------------------------------------------------------------------------


def _depth(total: int) -> int:
    """Levels from this many nodes to one."""
    depth = 0
    while total > 1:
        total, depth = -(-total // FAN), depth + 1
    return depth


def _reduced(digests: list[str], total: int) -> list[list[str]]:
    """Levels of a superblock from its nodes up; ``total`` are the nodes of the whole tree."""
    levels = [digests]
    for _ in range(min(LEVELS, _depth(total))):
        below = levels[-1]
        levels.append([digest_of("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return levels


def _top(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    nodes, total = nodes.sort_values("place"), int(nodes["total"].iloc[0])
    top = _reduced(nodes["digest"].tolist(), total)[-1][0]
    row = {"tree": [key[0]], "place": [key[1]], "total": [-(-total // SUPERBLOCK)], "digest": [top]}
    return pd.DataFrame(row)


def _block() -> Column:
    return F.floor(F.col("place") / SUPERBLOCK).alias("block")


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """Nodes (tree, place, total, digest) of each round, the given ones first; in the last each tree has one."""
    rounds = [nodes]
    while True:
        below = rounds[-1].select("tree", "place", "total", "digest", _block())
        tops = below.groupBy("tree", "block").applyInPandas(_top, "tree string, place long, total long, digest string")
        rounds.append(materialise(tops, "merkle-tops"))
        if (rounds[-1].agg(F.max("total")).first()[0] or 1) == 1:
            return rounds


# --- Down ---------------------------------------------------------------------------------


def _paths(nodes: pd.DataFrame, outer: pd.DataFrame) -> list[tuple[list[str], list[str]]]:
    """Digests to the left and right of each node's way, level by level up to the root; nodes lie by place."""
    levels = _reduced(nodes["digest"].tolist(), int(nodes["total"].iloc[0]))
    runs = [["".join(level[i : i + FAN]) for i in range(0, len(level), FAN)] for level in levels[:-1]]
    lefts, rights = (list(outer[c].iloc[0]) for c in ("lefts", "rights"))
    found = []
    for i in range(len(nodes)):
        left, right = [], []
        for level in runs:
            i, at = divmod(i, FAN)
            left.append(level[i][: at * DIGEST_CHARS])
            right.append(level[i][(at + 1) * DIGEST_CHARS :])
        found.append((left + lefts, right + rights))
    return found


_PATH = "lefts array<string>, rights array<string>, subroot string, root string"


def _inner(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("place")
    paths = _paths(nodes, outer)
    return pd.DataFrame(
        {
            "tree": nodes["tree"],
            "place": nodes["place"],
            "lefts": [left for left, _ in paths],
            "rights": [right for _, right in paths],
            "subroot": outer["subroot"].iloc[0],
            "root": outer["root"].iloc[0],
        }
    )


def _folded(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    nodes, root = nodes.sort_values("place"), outer["root"].iloc[0]
    proofs, folds = [], []
    for found, (lefts, rights) in zip(nodes["found"].tolist(), _paths(nodes, outer), strict=True):
        proofs.append(digest_of("".join([part for step in zip(lefts, rights, strict=True) for part in step])))
        for left, right in zip(lefts, rights, strict=True):
            found = digest_of(left + found + right)
        folds.append(found)
    return pd.DataFrame(
        {
            "id": nodes["id"],
            "leaf": nodes["digest"],
            "subroot": outer["subroot"].iloc[0],
            "root": root,
            "proof_sha256": proofs,
            "folded_root": folds,
            "verified": [f == root for f in folds],
        }
    )


def _exchange(nodes: DataFrame, outer: DataFrame, finish, schema: str) -> DataFrame:
    """Finish every superblock of a round from its nodes and the one row of outer nodes it needs."""
    inner = nodes.select("*", _block()).groupBy("tree", "block")
    return inner.cogroup(outer.groupBy("tree", "block")).applyInPandas(finish, schema)


def _descend(rounds: list[DataFrame], outer: DataFrame) -> DataFrame:
    """Outer nodes (tree, block) of the given round's superblocks from those of the last round's."""
    for nodes in rounds:
        found = _exchange(nodes, outer, _inner, f"tree string, place long, {_PATH}")
        outer = found.withColumnRenamed("place", "block")
    return outer


def manifest(docs: DataFrame, found: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per row of docs.

    ``found`` is the text as it is found now, by default the recorded one; its leaf is folded with the
    recorded siblings, and ``verified`` says whether that gives the recorded root. Rows of a null source are a
    source of their own, before all others. Null ids come first in their source; rows that repeat an id are ordered by
    their leaves, and whole repeated rows are leaves of their own. Empty texts are values, nulls are not. An empty
    table has no rows. Other columns are not read.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree")
    changed = leaf(F.col("text") if found is None else found).alias("found")
    leaves = docs.select(tree, "doc_id", leaf(F.col("text")).alias("digest"), changed)
    leaves = _placed(leaves, "doc_id", "digest", "found")
    # Ids travel as text: pandas would turn whole numbers beside nulls into floats.
    leaves = leaves.select("tree", "place", "total", "digest", "found", F.col("doc_id").cast("string").alias("id"))
    rounds = _climb(leaves)
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), "digest")
    sources = materialise(_placed(subroots, "source_tree"), "merkle-sources")
    upper = _climb(sources)

    none = F.array().cast("array<string>")
    root = upper[-1].select(
        "tree", F.lit(0).cast("long").alias("block"), none.alias("lefts"), none.alias("rights"), F.lit("").alias("subroot"), F.col("digest").alias("root")
    )
    above = _descend(upper[-2::-1], root).withColumnRenamed("block", "place").drop("tree", "subroot")
    ways = sources.select("place", F.col("source_tree").alias("tree"), F.col("digest").alias("subroot")).join(above, "place")
    outer = ways.select("tree", F.lit(0).cast("long").alias("block"), "lefts", "rights", "subroot", "root")
    outer = _descend(rounds[-2:0:-1], materialise(outer, "merkle-outer"))
    shape = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    done = _exchange(leaves, outer, _folded, shape)
    return done.withColumn("id", F.col("id").cast(docs.schema["doc_id"].dataType)).withColumnRenamed("id", "doc_id")
