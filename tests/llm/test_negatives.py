"""Hard negatives against a scan of all pairs in NumPy, over blocks, tiles and awkward vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from faresift.llm import negatives, queries

MEDIUM = "/root/testdata/sf0.1"
ROW = "vec_id long, embedding array<double>, label int, uid long, v string, tile int, block string"


def slow(rows, positives=5, wanted=10, low=30, high=90):
    sound = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    rows = [(r[0], r[2], [math.floor(256 * x) for x in r[1]]) for r in rows if r[0] is not None and r[2] is not None and sound(r[1])]
    found = []
    for a, (anchor, label, v) in enumerate(rows):
        if anchor % 100:
            continue
        scores = [sum(x * y for x, y in zip(v, o[2])) for o in rows]
        order = sorted(range(len(rows)), key=lambda i: (-scores[i], rows[i][0]))
        for p in [i for i in order if rows[i][1] == label and i != a][:positives]:
            fits = [i for i in order if rows[i][1] != label and low * scores[p] <= 100 * scores[i] <= high * scores[p]]
            found += [(anchor, rows[p][0], k, rows[i][0], scores[p], scores[i]) for k, i in enumerate(fits[:wanted], 1)]
    return sorted(found)


def mined(df, **more):
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % 100 == 0, **more).collect()))


def test_query_matches_sql(spark):
    df = queries.op13_hard_negatives(spark, MEDIUM)
    assert differences(df, connect(MEDIUM), queries.ORACLE_SQL["op13_hard_negatives"]) == []


def blobs(n, dim=6, seed=1):
    """Vectors around a few directions, of very different lengths, with ties and whole copies."""
    random = np.random.default_rng(seed)
    centres = random.normal(size=(4, dim))
    rows = []
    for i in range(n):
        v = (centres[i % 4] + random.normal(size=dim) * 0.05) * random.choice([0.1, 1, 5])
        rows.append((i * 10, [float(x) for x in np.round(v, 1)], int(random.integers(3)), i, "v", 1, "b"))
    return rows + rows[:40] + [(r[0], rows[0][1], 0, 0, "", 0, "") for r in rows[:7]]


@pytest.mark.parametrize(("tile", "block", "chunk", "cluster"), [(2048, 8192, 1024, 256), (3, 50, 16, 4), (1, 1000, 7, 1)])
def test_blocks_and_tiles_change_nothing(spark, monkeypatch, tile, block, chunk, cluster):
    for name, value in (("TILE", tile), ("BLOCK", block), ("CHUNK", chunk), ("CLUSTER", cluster)):
        monkeypatch.setattr(negatives, name, value)
    rows = blobs(400)
    assert mined(spark.createDataFrame(rows, ROW).repartition(5)) == slow(rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (100, [], 1), (200, None, 1), (300, [1.0, None], 1), (400, [nan, 1.0], 1), (500, [inf, 1.0], 1),
        (600, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (1, [1.0, 0.5], 1), (2, [0.5], 2), (3, [0.5, 0.0, 0.0], 2), (4, [0.0, 0.0], 2),
        (700, [-1.0, -1.0], 1), (-100, [0.25, 0.25], 2), (5, [0.4, 0.3], 3), (800, [0.001], 9),
    ]
    rows = [(*r, 1, "v", 1, "b") for r in rows]
    padded = [(r[0], [*r[1], *[0.0] * (3 - len(r[1]))] if r[1] is not None else None, *r[2:]) for r in rows]
    assert mined(spark.createDataFrame(rows, ROW).repartition(3)) == slow(padded)


def test_scores_beyond_machine_words_of_keys(spark):
    """Products pass 2**53 and, times the block's size, 2**62."""
    random = np.random.default_rng(5)
    rows = [(i * 20, [float(x) for x in random.integers(-(2**20), 2**20, 3)], i % 2, 1, "", 1, "") for i in range(60)]
    assert mined(spark.createDataFrame(rows, ROW)) == slow(rows)


def test_empty_tables_and_no_anchors(spark):
    rows = spark.createDataFrame([(1, [1.0], 1, 1, "", 1, ""), (2, [1.0], 2, 1, "", 1, "")], ROW)
    assert mined(rows) == mined(rows.limit(0)) == []
    alone = spark.createDataFrame([(100, [1.0], 1, 1, "", 1, ""), (2, [0.5], 2, 1, "", 1, "")], ROW)
    assert mined(alone) == []


def test_far_candidates_are_not_scored(spark, monkeypatch):
    """The list ends for members whose results are certain: few products for two far directions."""
    scored = []
    plain = negatives._products
    monkeypatch.setattr(negatives, "_products", lambda a, b: scored.append(a.shape[0] * b.shape[0]) or plain(a, b))
    monkeypatch.setattr(negatives, "CHUNK", 50)
    random = np.random.default_rng(2)
    near, far = (np.abs(random.normal(size=(n, 4))) * side for n, side in ((200, 100), (1800, -100)))
    block = object.__new__(negatives._Block)
    block.v = np.concatenate([near, far]).astype(np.int64)
    block.uid = block.id = np.arange(2000)
    block.label, block.lengths = np.zeros(2000, int), np.linalg.norm(block.v, axis=1)
    members, centre = block.v[:3], negatives._unit(block.v[:3].sum(axis=0)[None].astype(float))[0]
    low, high = np.full((3, 1), negatives.FLOOR), np.full((3, 1), negatives.CEILING)
    keys = negatives._walk(members, lambda who, part: np.ones((len(who), len(part)), bool), centre, block, low < high, low, high, 5)
    products = members @ block.v.T
    assert [sorted(own // 2000) for own in keys[:, 0]] == [sorted(own)[-5:] for own in products]
    assert sum(scored) < 3 * 600
