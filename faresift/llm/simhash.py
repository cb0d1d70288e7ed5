"""Near-duplicates by SimHash and multi-index hashing.

A fingerprint is cut into three segments. Fingerprints that differ in at most four bits differ in at
most one bit of one of the first two segments, or agree in the third: otherwise they would differ in
2 + 2 + 1 bits. So the small Hamming balls around the first two segments and the plain third segment
are looked up in the segment table, and whole distances are verified inside the join.

A group of near copies has fingerprints all over a small ball. So that not every pair of them becomes a row,
neighbours in one bit are joined first, each by a lookup of the whole fingerprint; the segment table then only
has to give links between the parts found so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from faresift.llm.common import BLANK_BYTES, LOWERED, materialise
from faresift.llm.graph import components

SHINGLE_WORDS = 4
SEED = 42
BITS = 64
DISTANCE = 4
# (first bit, bits, radius of the ball) of each segment.
SEGMENTS = ((0, 21, 1), (21, 21, 1), (42, 22, 0))
HASHES_AT_ONCE = 1 << 15
_TO_SPACE = bytes.maketrans(BLANK_BYTES, b" " * len(BLANK_BYTES))


def fingerprint(text: str | None) -> int:
    """Unsigned SimHash of one text; without words it is zero."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(LOWERED).translate(_TO_SPACE)
    words = [w for w in raw.split(b" ") if w]
    if not words:
        return 0
    line, size = memoryview(b" ".join(words)), SHINGLE_WORDS
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= size:
        stops, starts = [len(line)], [0]
    else:
        stops, starts = ends[size - 1 :].tolist(), [0, *(ends[:-size] + 1).tolist()]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), HASHES_AT_ONCE):
        part = zip(starts[at : at + HASHES_AT_ONCE], stops[at : at + HASHES_AT_ONCE], strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in part], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    ones = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int.from_bytes(ones.tobytes(), "little")


@F.arrow_udf(LongType())
def fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        values = np.array([fingerprint(t.as_py()) for t in batch], np.uint64)
        yield pa.array(values.view(np.int64))


def hex16(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _segment(fp: str, k: int) -> Column:
    first, bits, _ = SEGMENTS[k]
    return F.shiftrightunsigned(F.col(fp), first).bitwiseAND(F.lit((1 << bits) - 1))


def _key(k: int, value: Column) -> Column:
    return value.bitwiseOR(F.lit(k << 32))


def _probe(k: int) -> Column:
    """Keys to look up for segment k: the value itself and, for a ball, each value with one more bit set.

    The neighbour with a bit less is looked up from its own side, so each pair is met once.
    """
    _, bits, radius = SEGMENTS[k]
    same = F.array(F.struct(_key(k, _segment("fp", k)).alias("key"), F.lit(True).alias("same")))
    if not radius:
        return same
    free = F.filter(
        F.array(*[F.lit(1 << b).cast("long") for b in range(bits)]),
        lambda bit: _segment("fp", k).bitwiseAND(bit) == 0,
    )
    ball = F.transform(
        free, lambda bit: F.struct(_key(k, _segment("fp", k).bitwiseOR(bit)).alias("key"), F.lit(False).alias("same"))
    )
    return F.concat(same, ball)


def neighbours(fps: DataFrame) -> DataFrame:
    """(a, b): fingerprints of column ``fp`` that differ in one bit; each lookup meets one row at most."""
    bits = F.array(*[F.lit(np.uint64(1 << b).astype(np.int64).item()) for b in range(BITS)])
    free = F.filter(bits, lambda bit: F.col("fp").bitwiseAND(bit) == 0)
    probes = fps.select(F.col("fp").alias("a"), F.explode(F.transform(free, lambda bit: F.col("fp").bitwiseOR(bit))).alias("b"))
    return probes.join(fps.select(F.col("fp").alias("b")), "b").select("a", "b")


def links(fps: DataFrame) -> DataFrame:
    """(a, b): different parts with fingerprints that differ in 1 to DISTANCE bits, from (fp, part)."""
    table = fps.select(
        F.explode(F.array(*[_key(k, _segment("fp", k)) for k in range(len(SEGMENTS))])).alias("key"),
        F.col("fp").alias("fp_b"),
        F.col("part").alias("b"),
    )
    probes = fps.select(
        F.explode(F.concat(*[_probe(k) for k in range(len(SEGMENTS))])).alias("p"), F.col("fp").alias("fp_a"), F.col("part").alias("a")
    ).select("p.key", "p.same", "fp_a", "a")
    near = F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= DISTANCE
    once = (F.col("fp_a") < F.col("fp_b")) | ~F.col("same")
    found = probes.join(table, "key").filter((F.col("a") != F.col("b")) & once & near)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _rooted(fps: DataFrame, pairs: DataFrame, at: str) -> DataFrame:
    """fps with column ``at`` replaced by the root that pairs give it, if any."""
    roots = components(pairs, "a", "b")
    return fps.join(roots, fps[at] == roots.node, "left").withColumn(at, F.coalesce("root", at)).drop("node", "root")


def _grouped(marked: DataFrame) -> DataFrame:
    """(fp, part, component_id) of all fingerprints of a materialised (doc_id, fp); part is the component's root."""
    fps = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    parts = materialise(_rooted(fps.withColumn("part", F.col("fp")), neighbours(fps), "part"), "parts")
    rooted = materialise(_rooted(parts, links(parts), "part"), "rooted")
    least = materialise(rooted.groupBy("part").agg(F.min("least").alias("component_id")), "least-ids")
    return rooted.join(least, "part").select("fp", "part", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable).

    Null text counts as empty; texts without words share the fingerprint zero and are linked like any
    other. A null doc_id is never the least one unless a component has no other. Other columns of docs
    are not read.
    """
    marked = materialise(docs.select("doc_id", fingerprints(F.col("text")).alias("fp")), "marked")
    return marked.join(_grouped(marked), "fp").select("doc_id", hex16("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, that stay when each component keeps one document.

    That is the row with the least doc_id; a component whose ids are all null keeps one of its rows.
    Of rows that repeat doc_id and whole text one stays; of rows with the least doc_id but other
    texts, the one of the smallest text hash.
    """
    body = F.xxhash64(F.coalesce("text", F.lit("")))
    marked = materialise(
        docs.select("doc_id", body.alias("body"), fingerprints(F.col("text")).alias("fp")), "marked"
    )
    placed = marked.join(_grouped(marked.select("doc_id", "fp")), "fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "body"))
    # Components are told apart by their roots: their least ids may be null or agree.
    winners = (
        placed.groupBy("part")
        .agg(first.alias("w"))
        .select(F.col("w.doc_id").alias("win_id"), F.col("w.body").alias("win_body"))
        .distinct()
    )
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), body.alias("own_body"))
    kept = rows.join(winners, F.col("own_id").eqNullSafe(F.col("win_id")) & (F.col("own_body") == F.col("win_body")))
    once = Window.partitionBy("win_id", "win_body").orderBy(F.lit(0))
    return kept.withColumn("nth", F.row_number().over(once)).filter("nth = 1").select("row.*")
