"""Packing token pieces into sequences of fixed length by a grouping genetic algorithm on islands.

A genome is a set of bins. Crossover injects whole well-filled bins of one parent into the other, drops
the bins there that hold the same pieces, and places the displaced pieces best-fit. Pieces are dealt
by hash into groups of bounded size; each group evolves on several islands, which hand their best
genome to the next island between epochs. Bins that stay loose are pooled over all groups and evolved
again. Spark holds genomes as rows and moves elites by a shuffle.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from random import Random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faresift.llm.common import materialise
from faresift.llm.tokens import encoder, parts_of, vocabulary_path

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 4096
ISLANDS = 2
EPOCHS = 2
# Generations of an epoch: this many at least, more in small groups until so many pieces have been looked at.
GENERATIONS = 24
PLACEMENTS = 100_000
POPULATION = 4
# Share of a genome's bins that crossover injects, and of bins that mutation dissolves.
INJECTED = 0.15
DISSOLVED = 0.02
# Bins filled less than this are pooled over all groups and packed again.
TIGHT = 2000
ROUNDS = 2
BIN_BITS = 20
GROUP_BITS = 40

Genome = list[list[int]]


def _place(lengths: list[int], bins: Genome, loose: list[int], capacity: int) -> Genome:
    """Best-fit the loose pieces, longest first, into bins and new ones."""
    bins = [list(b) for b in bins]
    free = sorted((capacity - sum(lengths[i] for i in b), k) for k, b in enumerate(bins))
    for i in sorted(loose, key=lambda i: -lengths[i]):
        at = bisect_left(free, (lengths[i], -1))
        if at < len(free):
            room, k = free.pop(at)
            bins[k].append(i)
        else:
            room, k = capacity, len(bins)
            bins.append([i])
        if room > lengths[i]:
            insort(free, (room - lengths[i], k))
    return bins


def _fitness(lengths: list[int], bins: Genome, capacity: int) -> tuple[int, float]:
    """Fewer bins are better, then a larger sum of squared fills; smaller tuples win."""
    return len(bins), -sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins)


def _cross(lengths: list[int], a: Genome, b: Genome, capacity: int, random: Random) -> Genome:
    fills = sorted(range(len(b)), key=lambda k: -sum(lengths[i] for i in b[k]))
    n = max(1, int(len(b) * INJECTED))
    # A window over the better-filled half of b.
    start = random.randrange(max(1, len(b) // 2 - n + 1))
    injected = [b[k] for k in fills[start : start + n]]
    held = {i for own in injected for i in own}
    stays = [own for own in a if held.isdisjoint(own)]
    displaced = [i for own in a if not held.isdisjoint(own) for i in own if i not in held]
    return _place(lengths, stays + injected, displaced, capacity)


def _mutate(lengths: list[int], a: Genome, capacity: int, random: Random) -> Genome:
    n = max(2, int(len(a) * DISSOLVED))
    loosest = sorted(range(len(a)), key=lambda k: sum(lengths[i] for i in a[k]))[: n // 2 + 1]
    gone = {*loosest, *random.sample(range(len(a)), min(n, len(a)))}
    return _place(lengths, [b for k, b in enumerate(a) if k not in gone], [i for k in gone for i in a[k]], capacity)


def evolve(lengths: list[int], population: list[Genome], capacity: int, seed: int) -> Genome:
    """The best genome after some generations; at once if it meets the lower bound of bins."""
    random, least = Random(seed), -(-sum(lengths) // capacity)
    pieces = list(range(len(lengths)))
    score = lambda g: _fitness(lengths, g, capacity)
    population = list(population) or [_place(lengths, [], pieces, capacity)]
    if min(map(len, population)) > least:
        while len(population) < POPULATION:
            # Best-fit into seeds opened by a random part of the pieces.
            opened = random.sample(pieces, max(1, len(pieces) // 8))
            rest = set(pieces) - set(opened)
            population.append(_place(lengths, [[i] for i in opened], list(rest), capacity))
    population = sorted(population, key=score)
    for generation in range(max(GENERATIONS, PLACEMENTS // max(1, len(lengths)))):
        if len(population[0]) <= least or len(population) < 2:
            break
        a, b = random.sample(population, 2)
        child = _cross(lengths, a, b, capacity, random)
        if generation % 2:
            child = _mutate(lengths, child, capacity, random)
        if score(child) < score(population[-1]):
            population = sorted([*population[:-1], child], key=score)
    return population[0]


_GENOME = "group long, island int, uid long, length int, bin int, n_bins int, fitness double, met boolean"


def _epoch(capacity: int, epoch: int | None):
    """Evolve the genomes of an island, or best-fit its pieces where there is no epoch yet."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        group, island = int(pdf["group"].iloc[0]), int(pdf["island"].iloc[0])
        pieces = pdf.drop_duplicates("uid").sort_values("uid")
        uids = pieces["uid"].to_numpy()
        lengths = pieces["length"].tolist()
        if epoch is None:
            best = _place(lengths, [], list(range(len(lengths))), capacity)
        else:
            population: list[Genome] = []
            for _, own in pdf.groupby("origin", sort=True):
                index = np.searchsorted(uids, own["uid"].to_numpy())
                genome: dict[int, list[int]] = {}
                for i, k in sorted(zip(index.tolist(), own["bin"].tolist(), strict=True)):
                    genome.setdefault(k, []).append(i)
                population.append(list(genome.values()))
            best = evolve(lengths, population, capacity, hash((group, island, epoch)))
        order = [(i, k) for k, own in enumerate(best) for i in own]
        n_bins, fitness = _fitness(lengths, best, capacity)
        at = [i for i, _ in order]
        return pd.DataFrame(
            {
                "group": group,
                "island": island,
                "uid": uids[at],
                "length": np.array(lengths)[at],
                "bin": [k for _, k in order],
                "n_bins": n_bins,
                "fitness": fitness,
                "met": n_bins <= -(-sum(lengths) // capacity),
            }
        )

    return run


def _evolved(pieces: DataFrame, capacity: int, groups: int) -> DataFrame:
    """(group, uid, length, bin) of (uid, length): the best island of each group.

    Groups that best-fit packs into the least possible number of bins are done; the others evolve on islands.
    """
    columns = ["group", "uid", "length", "bin"]
    group = F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("group")
    dealt = pieces.select(group, F.lit(0).alias("island"), "uid", "length")
    fitted = materialise(dealt.groupBy("group", "island").applyInPandas(_epoch(capacity, None), _GENOME), "genomes")
    open_ = fitted.filter("NOT met")
    if open_.isEmpty():
        return fitted.select(*columns)
    islands = F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island")
    state = open_.select("group", islands, "uid", "length", "bin", F.lit(0).alias("origin"))
    for epoch in range(EPOCHS):
        best = materialise(state.groupBy("group", "island").applyInPandas(_epoch(capacity, epoch), _GENOME), "genomes")
        own = best.select("group", "island", "uid", "length", "bin", F.lit(0).alias("origin"))
        moved = ((F.col("island") + 1) % ISLANDS).alias("island")
        state = own.union(best.select("group", moved, "uid", "length", "bin", F.lit(1).alias("origin")))
    rank = F.struct("n_bins", "fitness", "island")
    winner = best.groupBy("group").agg(F.min_by("island", rank).alias("island"))
    return fitted.filter("met").select(*columns).union(best.join(winner, ["group", "island"]).select(*columns))


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(uid, sequence_id, offset) of (uid, length) pieces of 1 to capacity tokens, in as few sequences as found.

    Pieces of full length fill sequences of their own (negative ids).
    """
    full = pieces.filter(F.col("length") == capacity).select("uid", (-1 - F.col("uid")).alias("sequence_id"))
    placed = full.withColumn("length", F.lit(capacity))
    rest = pieces.filter(F.col("length") < capacity).select("uid", "length")
    for stage in range(ROUNDS):
        n = rest.count()
        if not n:
            break
        found = materialise(_evolved(rest, capacity, -(-n // GROUP_PIECES)), "packed")
        bins = found.groupBy("group", "bin").agg(F.sum("length").alias("fill"))
        tight = (F.col("fill") >= min(TIGHT, capacity)) | F.lit(stage == ROUNDS - 1)
        marked = materialise(
            found.join(bins, ["group", "bin"]).select("uid", "length", "group", "bin", tight.alias("tight")), "marked-bins"
        )
        number = F.lit(stage << (BIN_BITS + GROUP_BITS)) + F.col("group") * (1 << BIN_BITS) + F.col("bin")
        placed = placed.union(marked.filter("tight").select("uid", number.alias("sequence_id"), "length"))
        rest = marked.filter("NOT tight").select("uid", "length")
    before = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")
    return placed.select("uid", "sequence_id", offset.alias("offset"))


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): token ids of whole texts and a closing id 0, cut only
    where a document is longer than capacity."""
    from pyspark.sql.pandas.types import to_arrow_schema

    at = vocabulary_path(path)
    schema = StructType([docs.schema["doc_id"]])
    for field in StructType.fromDDL("piece int, start long, length int, ids_crc32 long" + ", ids array<int>" * with_ids):
        schema = schema.add(field)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(at).encode
        for batch in batches:
            ids, whole = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            # The ids of a part of the documents, not of a whole batch, are held at a time.
            for part in parts_of(whole):
                rows: list[list] = [[] for _ in arrow]
                texts = whole[part]
                for doc_id, packed in zip(ids[part], encode(texts), strict=True):
                    packed += END_ID.to_bytes(4, "little")
                    for piece, start in enumerate(range(0, len(packed) // 4, capacity)):
                        own = packed[4 * start : 4 * (start + capacity)]
                        row = [doc_id, piece, start, len(own) // 4, zlib.crc32(own)]
                        row += [np.frombuffer(own, "<i4")] if with_ids else []
                        for column, value in zip(rows, row, strict=True):
                            column.append(value)
                columns = [pa.array(c, f.type) for c, f in zip(rows, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        if with_ids:
            # Ids are asked for in pipelines, whose other stages go on in this worker: give the memory back.
            encoder(at).forget()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids on request).

    Null text counts as empty and is one piece, the closing id. Rows that repeat a doc_id are packed each for
    itself. Other columns of docs are not read.
    """
    pieces = token_pieces(docs, capacity, path, with_ids).withColumn("uid", F.monotonically_increasing_id())
    pieces = materialise(pieces, "pieces")
    placed = assign(pieces.select("uid", "length"), capacity)
    columns = ["doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"]
    return pieces.join(placed, "uid").select(*columns, *(["ids"] if with_ids else []))
