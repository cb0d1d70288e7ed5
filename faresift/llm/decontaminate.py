"""Benchmark contamination: one Aho-Corasick automaton over normalised items, and windows of 13 words verified where it stops.

Of the 13 words of any window, SEED_WORDS in a row begin at a word of the item that STRIDE divides. So an automaton over
these seeds alone (and over whole short items) meets every window, with a thirteenth of the states that all windows need. A
text is scanned once as word numbers; the windows around the seeds met are then looked up among the item's windows by a
64-bit hash and compared word by word. Runs of hit words are mapped to offsets in the original text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType

from faresift.llm.common import LOWERED, materialise

WINDOW_WORDS = 13
SEED_WORDS = 5
STRIDE = WINDOW_WORDS - SEED_WORDS + 1
# A document is contaminated if hit words times this reach its words.
SHARE = 20
# Bytes of normalised items in one automaton (some 25 bytes of memory each); more are scanned for in further steps.
WINDOW_CHARS = 8_000_000
# Words of a piece of a long item; its pieces overlap, so that no window is lost.
PIECE_WORDS = 4096

# Everything that is not a word byte becomes a space: 00-2F, 3A-60 (after lower-casing) and 7B-7F.
_BREAKS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_NORMAL = LOWERED.translate(bytes.maketrans(_BREAKS, b" " * len(_BREAKS)))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def pieces_of(text: str | None) -> list[bytes]:
    """The words of an item, in overlapping pieces that hold each of its windows whole."""
    words = words_of(text)
    starts = range(0, max(1, len(words) - WINDOW_WORDS + 1), PIECE_WORDS - WINDOW_WORDS + 1) if words else ()
    return [b" ".join(words[at : at + PIECE_WORDS]) for at in starts]


class Items:
    """The automaton over seeds and short items, and the windows of the longer ones."""

    def __init__(self, pieces: tuple[tuple[str, bytes], ...]) -> None:
        self.names: list[list[str]] = []
        known: dict[bytes, int] = {}
        for item_id, line in pieces:
            at = known.setdefault(line, len(known))
            if at == len(self.names):
                self.names.append([])
            self.names[at].append(item_id)
        # Word 0 is any word that no item has.
        self.numbers: dict[bytes, int] = {}
        lines = [
            np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in line.split(b" ")], np.int64) for line in known
        ]
        self.base = 2
        while self.base**3 <= len(self.numbers):
            self.base += 1
        self.short = [at for at, own in enumerate(lines) if len(own) < WINDOW_WORDS]
        self.short_words = [len(lines[at]) for at in self.short]
        seeds: dict[str, int] = {self.spell(lines[at]): 2 * (k + 1) for k, at in enumerate(self.short)}
        width = 3 * SEED_WORDS
        for own in lines:
            if len(own) >= WINDOW_WORDS:
                spelled = self.spell(own)
                for at in range(0, len(own) - SEED_WORDS + 1, STRIDE):
                    seed = spelled[3 * at : 3 * at + width]
                    seeds[seed] = seeds.get(seed, 0) | 1
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for seed, value in seeds.items():
            self.automaton.add_word(seed, value)
        self.automaton.make_automaton()
        self._index([(at, own) for at, own in enumerate(lines) if len(own) >= WINDOW_WORDS])

    def spell(self, numbers: np.ndarray) -> str:
        """Three characters per word, of different ranges, so that no match begins inside a word."""
        base = self.base
        digits = np.stack([numbers // base**2, numbers // base % base + base, numbers % base + 2 * base], axis=1) + 1
        return digits.astype("<u4").tobytes().decode("utf-32-le")

    def _index(self, long: list[tuple[int, np.ndarray]]) -> None:
        self.words = np.concatenate([own for _, own in long]).astype(np.int32) if long else np.zeros(0, np.int32)
        ends = np.cumsum([len(own) for _, own in long], dtype=np.int64)
        starts = [np.arange(end - len(own), end - WINDOW_WORDS + 1) for end, (_, own) in zip(ends, long, strict=True)]
        start = np.concatenate(starts) if long else np.zeros(0, np.int64)
        line = np.repeat([at for at, _ in long], [len(s) for s in starts]).astype(np.int64)
        for seed in range(1 << 30):
            self.table = np.random.default_rng(seed).integers(0, 1 << 63, len(self.numbers) + 1, np.uint64) * np.uint64(2) + np.uint64(1)
            hashes = self.hashes(self.words, start)
            order = np.argsort(hashes, kind="stable")
            first = np.r_[True, np.diff(hashes[order]) != 0][: len(order)]
            group = np.cumsum(first) - 1
            self.keys, self.at = hashes[order][first], start[order][first]
            # Different windows of one hash are never taken for each other: other numbers are drawn then.
            if self._equal(self.words, start[order], self.at[group] if len(group) else group).all():
                break
        owners = np.unique(np.stack([group, line[order]], axis=1), axis=0)
        self.owner, self.owners_from = owners[:, 1], np.searchsorted(owners[:, 0], np.arange(len(self.keys) + 1))

    def hashes(self, numbers: np.ndarray, start: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the window at each start."""
        found = np.zeros(len(start), np.uint64)
        for k in range(WINDOW_WORDS):
            found = found * np.uint64(0x9E3779B97F4A7C15) + self.table[numbers[start + k]]
        return found

    def _equal(self, numbers: np.ndarray, start: np.ndarray, at: np.ndarray) -> np.ndarray:
        same = np.ones(len(start), bool)
        for k in range(WINDOW_WORDS):
            same &= numbers[start + k] == self.words[at + k]
        return same

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, hit runs of words as (first, after the last), and items met."""
        words = words_of(text)
        if not words or not self.names:
            return len(words), [], []
        get = self.numbers.get
        numbers = np.array([get(w, 0) for w in words], np.int64)
        seen: list[int] = []
        hits: list[tuple[int, int]] = []
        lines: set[int] = set()
        for end, value in self.automaton.iter(self.spell(numbers)):
            after = (end + 1) // 3
            if value & 1:
                seen.append(after - SEED_WORDS)
            if value >> 1:
                k = (value >> 1) - 1
                hits.append((after - self.short_words[k], after))
                lines.add(self.short[k])
        if seen:
            reach = np.arange(-(WINDOW_WORDS - SEED_WORDS), 1)
            start = np.unique(np.array(seen)[:, None] + reach)
            start = start[(start >= 0) & (start <= len(words) - WINDOW_WORDS)]
            hashes = self.hashes(numbers, start)
            place = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            met = self.keys[place] == hashes
            start, place = start[met], place[met]
            met = self._equal(numbers, start, self.at[place])
            hits += [(at, at + WINDOW_WORDS) for at in start[met].tolist()]
            for g in np.unique(place[met]).tolist():
                lines.update(self.owner[self.owners_from[g] : self.owners_from[g + 1]].tolist())
        spans: list[tuple[int, int]] = []
        for first, after in sorted(hits):
            if spans and first <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(after, spans[-1][1]))
            else:
                spans.append((first, after))
        return len(words), spans, sorted({name for at in lines for name in self.names[at]})


@lru_cache(maxsize=1)
def _items(pieces: tuple[tuple[str, bytes], ...]) -> Items:
    return Items(pieces)


def offsets_of(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte offsets in the original UTF-8 text of hit runs of words."""
    spaced = text.encode("utf-8", "surrogatepass").translate(_NORMAL)
    is_word = np.frombuffer(b" " + spaced + b" ", np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(is_word.astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    return [(int(starts[a]), int(stops[b - 1])) for a, b in spans]


_FOUND = "n_words long, hit array<struct<first:long,after:long>>, byte_spans array<struct<first:long,after:long>>, items array<string>"
_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("hit", pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))),
        ("byte_spans", pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def _scanner(pieces: tuple[tuple[str, bytes], ...]):
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = _items(pieces)
        for batch in texts:
            rows = []
            for value in batch:
                text = value.as_py()
                n, spans, names = items.scan(text)
                at = offsets_of(text, spans) if spans else []
                name = lambda pairs: [{"first": a, "after": b} for a, b in pairs]
                rows.append({"n_words": n, "hit": name(spans), "byte_spans": name(at), "items": names})
            yield pa.array(rows, _ARROW)

    return F.arrow_udf(find, _FOUND)


@F.arrow_udf(ArrayType(BinaryType()))
def _pieces(texts: pa.Array) -> pa.Array:
    return pa.array([pieces_of(t.as_py()) for t in texts], pa.list_(pa.binary()))


def _parts(benchmark: DataFrame) -> Iterator[tuple[tuple[str, bytes], ...]]:
    """The pieces of all items for one automaton after the other, each of WINDOW_CHARS bytes at most (or one piece)."""
    name = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id")
    pieces = benchmark.select(name, F.explode(_pieces("text")).alias("line")).distinct()
    pieces = materialise(pieces, "benchmark-pieces").withColumn("bytes", F.octet_length("line") + F.octet_length("item_id"))
    part = lambda n: F.pmod(F.xxhash64("line", "item_id"), F.lit(n))
    n = -(-(pieces.agg(F.sum("bytes")).first()[0] or 0) // WINDOW_CHARS) or 1
    # No part comes to the driver before its size is known.
    while n > 1 and (
        pieces.groupBy(part(n)).agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("c")).filter(f"b > {WINDOW_CHARS} AND c > 1").count()
    ):
        n *= 2
    for k in range(n):
        own = pieces.filter(part(n) == k).select("item_id", "line").collect()
        if own or k == 0:
            yield tuple((r["item_id"], bytes(r["line"])) for r in own)


def find_windows(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """docs as struct ``row`` with n_words, n_hit, items and byte_spans of what the benchmark's windows hit.

    A benchmark for one automaton is a projection of docs. A larger one is gone through in steps, one automaton alive at a
    time; each step writes the rows it hits, and their runs are united by row.
    """
    parts = _parts(benchmark)
    row = docs.select(F.struct("*").alias("row"), F.col(text).alias("scanned"))
    first, second = next(parts), next(parts, None)
    if second is None:
        found = row.withColumn("f", _scanner(first)("scanned"))
        spans, names = F.col("f.byte_spans"), F.col("f.items")
        hit = F.col("f.hit")
    else:
        row = row.withColumn("uid", F.monotonically_increasing_id()).withColumn("f", _scanner(first)("scanned"))
        found = materialise(row, "scanned-documents")
        steps = []
        while second is not None:
            step = found.select("uid", _scanner(second)("scanned").alias("f"))
            steps.append(materialise(step.filter(F.size("f.items") > 0), "hit-documents"))
            second = next(parts, None)
        more = steps[0]
        for step in steps[1:]:
            more = more.union(step)
        more = more.groupBy("uid").agg(*[F.flatten(F.collect_list(f"f.{c}")).alias(f"more_{c}") for c in ("hit", "byte_spans", "items")])
        found = found.join(more, "uid", "left")
        both = lambda c: F.concat(F.col(f"f.{c}"), F.coalesce(F.col(f"more_{c}"), F.array()))
        hit, spans, names = both("hit"), both("byte_spans"), both("items")
    return found.select(
        "row",
        F.col("f.n_words").alias("n_words"),
        _length(hit).alias("n_hit"),
        F.array_sort(F.array_distinct(names)).alias("items"),
        spans.alias("byte_spans"),
    )


def _length(runs: Column) -> Column:
    """Words in runs that may overlap."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    step = lambda s, r: F.struct(
        (s["n"] + F.greatest(F.lit(0), r["after"] - F.greatest(r["first"], s["upto"]))).alias("n"),
        F.greatest(r["after"], s["upto"]).alias("upto"),
    )
    return F.aggregate(F.array_sort(runs), start, step, lambda s: s["n"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, byte_spans.

    Null text has no words. An item without words has no window; equal items are all named. Without
    items nothing is hit. byte_spans holds the hit runs as offsets in the original UTF-8 text; with several automata
    runs may overlap. Other columns of docs and benchmark are not read.
    """
    found = find_windows(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        _contaminated().alias("contaminated"),
        "byte_spans",
    )


def _contaminated() -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, that are not contaminated."""
    return find_windows(docs, benchmark).filter(~_contaminated()).select("row.*")
