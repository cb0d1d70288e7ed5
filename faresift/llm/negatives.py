"""Hard negatives by shared candidate lists of anchor clusters, after MAXIMUS.

Anchors are clustered by direction. For a cluster with centre c whose members lie within the angle w of it, no
member a has a larger product with x than |a| |x| cos(max(0, angle(x, c) - w)). Candidates are sorted by that
bound once per cluster, and every member walks the list until the bound shows that nothing behind can
enter its result. Candidates come in blocks and clusters in tiles of bounded size: one task walks one block for the
clusters of one tile, and the few rows found per block are ranked by a window. A first walk finds the positives, whose
scores set the windows of the second.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from faresift.llm.common import bounded_sample, materialise

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
# Scores of negatives from 30 to 90 hundredths of the positive's.
RANGE = (30, 90)
# Anchors that centres are fitted on (taken by hash), and centres at most: one for CLUSTER anchors, or fewer.
SAMPLE_ANCHORS, CENTRES, CLUSTER, STEPS = 4096, 256, 256, 8
# Anchors of a tile, candidates of a block, and candidates between two looks at the bound.
TILE, BLOCK, CHUNK = 2048, 8192, 1024
NONE = np.iinfo(np.int64).min


def vectors(embeddings: DataFrame, anchor: Column, column: str = "embedding") -> DataFrame:
    """(uid, vec_id, label, v, is_anchor): rows that take part, with whole components floor(256 x)."""
    x = F.col(column)
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    taking = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & sound)
    return taking.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform(x, lambda e: F.floor(e.cast("double") * SCALE).cast("long")).alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    )


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    found = np.zeros((len(column), dim), np.int64)
    found[np.arange(dim) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return found


def _unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, lengths, out=np.zeros(rows.shape), where=lengths > 0)


def _centres(sample: np.ndarray, k: int) -> np.ndarray:
    """Directions that the sample gathers around, by a few rounds of spherical k-means from evenly taken rows."""
    units = _unit(sample.astype(float))
    centres = units[np.linspace(0, len(units) - 1, k).astype(int)]
    for _ in range(STEPS):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        centres = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, _unit(sums), centres)
    return centres


def _products(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact inner products: as doubles where none can pass 2**53, else as whole numbers."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(others).max(initial=0)) * max(1, rows.shape[1])
    if most < 2**53:
        return (rows.astype(float) @ others.T.astype(float)).astype(np.int64)
    return rows @ others.T


class _Block:
    """Candidates of a block by vec_id, so that of equal scores the smaller place has the smaller id."""

    def __init__(self, rows: pa.Table, dim: int):
        rows = rows.sort_by([("vec_id", "ascending"), ("uid", "ascending")])
        self.uid, self.id, self.label = (rows[c].to_numpy() for c in ("uid", "vec_id", "label"))
        self.v = _matrix(rows["v"], dim)
        self.lengths = np.linalg.norm(self.v.astype(float), axis=1)


def _key_type(members: np.ndarray, block: _Block) -> type:
    """Whole numbers that hold a score times the block's size: machine words, or Python's own beyond them."""
    most = float(np.abs(members).max(initial=0)) * float(np.abs(block.v).max(initial=0)) * max(1, members.shape[1])
    return np.int64 if (most + 1) * (len(block.id) + 1) < 2**62 else object


def _walk(
    members: np.ndarray,
    fits: Callable[[np.ndarray, np.ndarray], np.ndarray],
    centre: np.ndarray,
    block: _Block,
    known: np.ndarray,
    low: np.ndarray,
    high: np.ndarray,
    n: int,
) -> np.ndarray:
    """Keys of the n best candidates of each member in each of its windows, low <= score <= high.

    A key is score * size + size - 1 - place for a block of this size, so larger keys come first: higher scores, then
    smaller ids. NONE is no key. ``fits(members, places)`` says which candidates may count, ``known`` which windows there are.
    """
    size, kind = len(block.id), _key_type(members, block)
    lengths = np.linalg.norm(members.astype(float), axis=1)
    angle = lambda rows, sizes: np.arccos(
        np.clip(np.divide(rows @ centre, sizes, out=np.ones(len(rows)), where=sizes > 0), -1, 1)
    )
    width = angle(members.astype(float), lengths).max(initial=0)
    bound = block.lengths * np.cos(np.maximum(0, angle(block.v.astype(float), block.lengths) - width))
    order = np.argsort(-bound, kind="stable")
    keys = np.full((*known.shape, n), NONE, kind)
    # The least score that can still enter a window.
    least = np.where(known, low, CEILING).astype(kind)
    walking = np.flatnonzero(known.any(axis=1))
    for start in range(0, size, CHUNK):
        # The rounding of a bound is far below this margin.
        reach = lengths[walking] * bound[order[start]] + 1e-6 * (1 + lengths[walking] * block.lengths.max())
        walking = walking[reach >= least[walking].min(axis=1).astype(float)]
        if not len(walking):
            break
        part = np.sort(order[start : start + CHUNK])
        product = _products(members[walking], block.v[part]).astype(kind)
        counts = fits(walking, part)
        for slot in range(known.shape[1]):
            inside = counts & (product <= high[walking, slot, None]) & (product >= least[walking, slot, None])
            some = np.flatnonzero(inside.any(axis=1) & known[walking, slot])
            if len(some):
                who = walking[some]
                new = np.where(inside[some], product[some] * size + (size - 1 - part), NONE)
                keys[who, slot] = np.partition(np.concatenate([keys[who, slot], new], axis=1), -n, axis=1)[:, -n:]
                worst = keys[who, slot].min(axis=1)
                least[who, slot] = np.where(worst > NONE, worst // size, least[who, slot])
    return keys


_RESULT = "anchor_uid long, anchor_id long, slot int, positive_id long, positive_score long, uid long, vec_id long, score long"
FLOOR, CEILING = -(2**62), 2**62


def _search(dim: int, centres: np.ndarray, same: bool, n: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Walk one block for the clusters of one tile; anchors carry their windows as (slot, id, score, low, high)."""
    arrow = to_arrow_schema(StructType.fromDDL(_RESULT))

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        if not anchors.num_rows or not candidates.num_rows:
            return arrow.empty_table()
        block = _Block(candidates, dim)
        clusters = anchors["cluster"].to_numpy()
        windows = anchors["windows"].to_pylist()
        slots = max(map(len, windows))
        known = np.zeros((len(windows), slots), bool)
        ids, hits, low, high = (np.zeros((len(windows), slots), np.int64) for _ in range(4))
        for i, own in enumerate(windows):
            for k, window in enumerate(own):
                known[i, k], ids[i, k], hits[i, k] = True, window["id"], window["score"]
                low[i, k], high[i, k] = window["low"], window["high"]
        members, labels = _matrix(anchors["v"], dim), anchors["label"].to_numpy()
        uids, names = anchors["uid"].to_numpy(), anchors["vec_id"].to_numpy()
        columns: list[list[np.ndarray]] = [[] for _ in arrow]
        for cluster in np.unique(clusters):
            at = np.flatnonzero(clusters == cluster)

            def fits(who: np.ndarray, part: np.ndarray, at: np.ndarray = at) -> np.ndarray:
                alike = labels[at[who], None] == block.label[part]
                return alike & (uids[at[who], None] != block.uid[part]) if same else ~alike

            keys = _walk(members[at], fits, centres[cluster], block, known[at], low[at], high[at], n)
            row, slot, rank = np.nonzero(keys > NONE)
            key, own = keys[row, slot, rank], at[row]
            place = (len(block.id) - 1 - key % len(block.id)).astype(np.int64)
            score = (key // len(block.id)).astype(np.int64)
            found = (uids[own], names[own], slot, ids[own, slot], hits[own, slot], block.uid[place], block.id[place], score)
            for column, values in zip(columns, found, strict=True):
                column.append(values)
        return pa.table([pa.array(np.concatenate(c)).cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return run


def _clustered(anchors: DataFrame, centres: np.ndarray, dim: int) -> DataFrame:
    """Add the cluster, the nearest centre; anchors of no length go to the first."""
    schema = StructType([*anchors.schema.fields]).add("cluster", "integer")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest = (_matrix(batch.column("v"), dim) @ centres.T).argmax(axis=1)
            columns = [*batch.columns, pa.array(nearest, pa.int32())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return anchors.mapInArrow(run, schema)


def _tiles(anchors: DataFrame) -> tuple[DataFrame, int]:
    """Add the tile: small clusters share one, a large cluster is cut by hash into several. Also the number of tiles."""
    sizes = {r["cluster"]: r["n"] for r in anchors.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}  # CENTRES rows
    first, parts, tile, room = [0] * CENTRES, [1] * CENTRES, -1, 0
    for cluster, n in sorted(sizes.items()):
        if n > room:
            parts[cluster] = -(-n // TILE)
            first[cluster], tile = tile + 1, tile + parts[cluster]
            room = TILE - n if parts[cluster] == 1 else 0
        else:
            first[cluster], room = tile, room - n
    of = lambda values: F.get(F.array(*map(F.lit, values)), F.col("cluster"))
    return anchors.withColumn("tile", of(first) + F.pmod(F.xxhash64("uid"), of(parts)).cast("int")), tile + 1


def mine(
    embeddings: DataFrame,
    anchor: Column,
    column: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    score_range: tuple[int, int] = RANGE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for each anchor and positive.

    ``anchor`` picks the anchors among the rows. Rows with a null id, label, vector or component, or a component that is
    not finite, take no part. Vectors that are shorter than others end in zeros; scores must fit 62 bits. Every row counts for itself, repeated rows and ids too; an anchor is no partner of its own row
    alone. Anchors without positives, and positives without negatives in range, have no rows. Without anchors
    the result is empty. Other columns are not read.
    """
    rows = materialise(vectors(embeddings, anchor, column), "vectors")
    total, dim, n = rows.agg(F.count(F.lit(1)), F.max(F.size("v")), F.count_if("is_anchor")).first()
    dim, blocks = max(1, dim or 1), max(1, -(-total // BLOCK))
    sample = bounded_sample(rows.filter("is_anchor").select("uid", "v"), SAMPLE_ANCHORS, "uid").toArrow()
    if sample.num_rows:
        centres = _centres(_matrix(sample["v"], dim), min(CENTRES, sample.num_rows, max(1, -(-n // CLUSTER))))
    else:
        centres = np.zeros((1, dim))
    anchors = _clustered(rows.filter("is_anchor").select("uid", "vec_id", "label", "v"), centres, dim)
    anchors, tiles = _tiles(materialise(anchors, "anchors"))
    every = lambda count, name: F.explode(F.sequence(F.lit(0), F.lit(max(1, count) - 1))).alias(name)
    block = F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int").alias("block")
    candidates = rows.select("uid", "vec_id", "label", "v", block, every(tiles, "tile")).groupBy("tile", "block")

    def ranked(windowed: DataFrame, same: bool, wanted: int) -> DataFrame:
        dealt = windowed.select("*", every(blocks, "block")).groupBy("tile", "block")
        found = dealt.cogroup(candidates).applyInArrow(_search(dim, centres, same, wanted), _RESULT)
        order = Window.partitionBy("anchor_uid", "slot").orderBy(F.desc("score"), "vec_id", "uid")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)

    whole = F.array(F.struct(F.lit(0).alias("slot"), F.lit(0).alias("id"), F.lit(0).alias("score"), F.lit(FLOOR).alias("low"), F.lit(CEILING).alias("high")))
    shape = "array<struct<slot:int,id:bigint,score:bigint,low:bigint,high:bigint>>"
    firsts = ranked(anchors.withColumn("windows", whole.cast(shape)), True, positives)

    # Ends of the range in whole scores, both inside.
    share = lambda percent: F.col("score").cast("decimal(20,0)") * percent / 100
    low, high = F.ceil(share(score_range[0])).cast("long"), F.floor(share(score_range[1])).cast("long")
    window = F.struct(
        (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("id"), "score", low.alias("low"), high.alias("high")
    )
    windows = firsts.filter(low <= high).groupBy(F.col("anchor_uid").alias("uid"))
    windows = windows.agg(F.array_sort(F.collect_list(window)).cast(shape).alias("windows"))
    return ranked(anchors.join(windows, "uid"), False, negatives).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
