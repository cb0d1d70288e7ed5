"""Repeated passages: content-defined chunks of lines, compared over all documents.

A boundary lies between two lines if the rolling hash over both is divisible by CHUNK_LINES, if one of them is
blank or has MIN_WORDS words, and at both ends of a text. So it depends on those lines only, not on what
was inserted before. From every boundary a chunk runs forward, and another one backward, until it has
MIN_WORDS words. A long line or a paragraph between blank lines is covered wherever it stands, and runs of
short lines are met again at the boundaries they carry inside. DataFrame functions only.

That rule is the one of the SQL of op7_line_dedup; it misses passages of short lines whose boundaries do not leave
MIN_WORDS words between them. ``whole=True`` has no such gaps: every line with words starts and ends a chunk. So each
run of lines with MIN_WORDS words that is met twice is made of whole chunks, from its first line to its last. Chunks are
then told by hashes of their lines, and only those met twice are compared by their bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faresift.llm.common import materialise

CHUNK_LINES = 4
MIN_WORDS = 50
# Lines, blank ones included, over which a chunk may gather its words.
MAX_LINES = 200
WORD = r"[^\x20\x09-\x0D]+"
SPREAD = 31


def _line_facts(lines: Column) -> Column:
    return F.transform(
        lines,
        lambda line: F.struct(
            F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long").alias("hash"),
            F.regexp_count(line, F.lit(WORD)).alias("words"),
        ),
    )


def _boundary(facts: Column, i: Column, other: int, min_words: int) -> Column:
    """Whether the line i has words and a boundary towards its neighbour at i + other."""
    own, next_ = F.get(facts, i), F.get(facts, i + other)
    first, second = (next_, own) if other < 0 else (own, next_)
    apart = (own["words"] >= min_words) | (next_["words"] >= min_words) | (next_["words"] == 0)
    rolling = (first["hash"] * SPREAD + second["hash"]) % CHUNK_LINES == 0
    return (own["words"] > 0) & (next_.isNull() | apart | rolling)


def _reach(facts: Column, i: Column, other: int, min_words: int) -> Column:
    """The line at which a chunk from i has its words; null if there are too few."""
    size = F.least(F.lit(MAX_LINES), i + 1)
    ahead = F.slice(facts, i + 1, MAX_LINES) if other > 0 else F.reverse(F.slice(facts, i - size + 2, size))
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"))

    def step(state: Column, line: Column) -> Column:
        more = state["words"] < min_words
        return F.struct(
            (state["words"] + F.when(more, line["words"]).otherwise(0)).alias("words"),
            (state["lines"] + F.when(more, 1).otherwise(0)).alias("lines"),
        )

    end = lambda state: F.when(state["words"] >= min_words, i + other * (state["lines"] - 1))
    return F.when(F.get(facts, i)["words"] >= min_words, i).otherwise(F.aggregate(ahead, start, step, end))


def _chunks(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, body_hash, first, last, body) of the chunks, which may overlap."""
    lines = docs.filter("text IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("body_hash"), F.split("text", "\n").alias("lines")
    )
    known = lines.withColumn("facts", _line_facts(F.col("lines")))
    facts, every = F.col("facts"), F.sequence(F.lit(0), F.size("lines") - 1)
    ahead = F.transform(
        F.filter(every, lambda i: _boundary(facts, i, -1, min_words)),
        lambda i: F.struct(i.alias("first"), _reach(facts, i, 1, min_words).alias("last")),
    )
    back = F.transform(
        F.filter(every, lambda i: _boundary(facts, i, 1, min_words)),
        lambda i: F.struct(_reach(facts, i, -1, min_words).alias("first"), i.alias("last")),
    )
    spans = F.filter(F.array_distinct(F.concat(ahead, back)), lambda s: s["first"].isNotNull() & s["last"].isNotNull())
    cut = known.withColumn("spans", spans)
    body = lambda s: F.array_join(F.slice("lines", s["first"] + 1, s["last"] - s["first"] + 1), "\n")
    chunk = lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), body(s).alias("body"))
    return cut.select("doc_id", "body_hash", F.inline(F.transform("spans", chunk)))


def _met(docs: DataFrame, min_words: int) -> DataFrame:
    """(k1, k2, doc_id, body_hash, first, last) of the chunks between boundaries whose bytes are met twice or more."""
    key = [F.xxhash64("body").alias("k1"), F.xxhash64("body", F.lit(1)).alias("k2")]
    chunks = _chunks(docs, min_words)
    # Whole chunks are compared by grouping on their bytes; equal ones are combined before they are
    # shuffled. Should keys of 128 bits agree where bytes do not, those chunks stay.
    bodies = chunks.select(*key, "body").groupBy("k1", "k2", "body").agg(F.count(F.lit(1)).alias("n"))
    repeated = bodies.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("bodies"), F.sum("n").alias("n"))
    repeated = repeated.filter("bodies = 1 AND n > 1").select("k1", "k2")
    places = chunks.select(*key, "doc_id", "body_hash", "first", "last")
    repeated = materialise(repeated, "repeated-chunks")
    return materialise(places.join(repeated, ["k1", "k2"]), "met-chunks")


def _removed(met: DataFrame) -> DataFrame:
    """(doc_id, body_hash, spans): the runs of lines that each document loses."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "body_hash", "first", "last")
    stays = materialise(met.groupBy("k1", "k2").agg(F.min(place).alias("stays")), "first-chunks")
    lost = met.join(stays, ["k1", "k2"]).filter(place != F.col("stays"))
    return lost.groupBy("doc_id", "body_hash").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def _all_chunks(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, body_hash, first, last, k1, k2): from every line with words the shortest chunk ahead and back."""
    lines = docs.filter("text IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("body_hash"), F.split("text", "\n").alias("lines")
    )
    fact = lambda line, i: F.struct(i.alias("i"), F.regexp_count(line, F.lit(WORD)).alias("words"))
    known = lines.select(
        "doc_id",
        "body_hash",
        F.transform("lines", lambda line: F.xxhash64(line)).alias("h1"),
        F.transform("lines", lambda line: F.xxhash64(line, F.lit(1))).alias("h2"),
        F.filter(F.transform("lines", fact), lambda f: f["words"] > 0).alias("solid"),
    ).filter(F.size("solid") > 0)
    start = F.struct(F.lit(0).alias("words"), F.lit(None).cast("int").alias("i"))

    def step(state: Column, line: Column) -> Column:
        more = state["words"] < min_words
        return F.struct(
            (state["words"] + F.when(more, line["words"]).otherwise(0)).alias("words"),
            F.when(more, line["i"]).otherwise(state["i"]).alias("i"),
        )

    # A line with words has one at least, so min_words such lines are enough.
    end = lambda state: F.when(state["words"] >= min_words, state["i"])
    reach = lambda own, ahead: F.when(own["words"] >= min_words, own["i"]).otherwise(F.aggregate(ahead, start, step, end))
    ahead = F.transform(
        "solid", lambda own, k: F.struct(own["i"].alias("first"), reach(own, F.slice("solid", k + 1, min_words)).alias("last"))
    )
    size = lambda k: F.least(F.lit(min_words), k + 1)
    back = F.transform(
        "solid",
        lambda own, k: F.struct(
            reach(own, F.reverse(F.slice("solid", k - size(k) + 2, size(k)))).alias("first"), own["i"].alias("last")
        ),
    )
    spans = F.filter(F.array_distinct(F.concat(ahead, back)), lambda s: s["first"].isNotNull() & s["last"].isNotNull())
    key = lambda hashes, s: F.xxhash64(F.slice(hashes, s["first"] + 1, s["last"] - s["first"] + 1))
    chunk = lambda s: F.struct(
        s["first"].alias("first"), s["last"].alias("last"), key("h1", s).alias("k1"), key("h2", s).alias("k2")
    )
    cut = known.withColumn("spans", spans)
    return cut.select("doc_id", "body_hash", F.inline(F.transform("spans", chunk)))


def _met_twice(docs: DataFrame, min_words: int) -> DataFrame:
    """(k1, k2, doc_id, body_hash, first, last) of all chunks whose bytes are met at two places or more."""
    chunks = materialise(_all_chunks(docs, min_words), "chunks")
    repeated = materialise(chunks.groupBy("k1", "k2").count().filter("count > 1").select("k1", "k2"), "repeated-chunks")
    met = materialise(chunks.join(repeated, ["k1", "k2"]), "met-chunks")
    # Should keys of 128 bits agree where bytes do not, those chunks stay.
    spans = met.groupBy(F.col("doc_id").alias("own_id"), F.col("body_hash").alias("own_hash")).agg(
        F.collect_set(F.struct("k1", "k2", "first", "last")).alias("spans")
    )
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.xxhash64("text"))
    texts = docs.join(spans, same).withColumn("lines", F.split("text", "\n"))
    body = lambda s: F.array_join(F.slice("lines", s["first"] + 1, s["last"] - s["first"] + 1), "\n")
    bodies = texts.select(
        F.inline(F.transform("spans", lambda s: F.struct(s["k1"].alias("k1"), s["k2"].alias("k2"), body(s).alias("body"))))
    )
    unlike = bodies.distinct().groupBy("k1", "k2").count().filter("count > 1").select("k1", "k2")
    return met.join(materialise(unlike, "unlike-chunks"), ["k1", "k2"], "left_anti")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, whole: bool = False) -> DataFrame:
    """(row, text, n_lines, removed_lines): docs as struct ``row`` and their text without repeated chunks.

    Of equal chunks the first stays: that of the least doc_id (null ids last), then of the smallest text
    hash, then of the earliest line. A line goes if any later chunk over it goes, so every line that goes
    stands at an earlier place as well. Rows that repeat doc_id and whole text
    are one document. Null text stays null with no lines; empty text is one empty line; a document whose
    chunks all go has empty text. Other columns of docs stay in row whatever their names.
    """
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_hash")
    )
    texts = docs.select("doc_id", "text")
    removed = _removed(_met_twice(texts, min_words) if whole else _met(texts, min_words))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("body_hash"))
    joined = rows.join(removed, same, "left").select(
        "row", "spans", F.col("row.text").alias("text"), F.split("row.text", "\n").alias("lines")
    )
    gone = F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["last"])))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
    joined = joined.withColumn("kept", kept)
    left = F.array_join(F.transform("kept", lambda k: F.get("lines", k)), "\n")
    return joined.select(
        "row",
        F.when(F.col("spans").isNull(), F.col("text")).otherwise(left).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).alias("n_lines"),
        F.when(F.col("spans").isNull(), 0).otherwise(F.size("lines") - F.size("kept")).alias("removed_lines"),
    )


def clean(docs: DataFrame) -> DataFrame:
    """All rows and columns of docs, with repeated passages taken out of text; an n_chars column follows the text."""
    found = without_repeats(docs, whole=True)
    new = {"text": F.col("text"), "n_chars": F.char_length("text")}
    kinds = dict(docs.dtypes)
    return found.select(
        *[(new[c].cast(kinds[c]) if c in new else F.col("row").getField(c)).alias(c) for c in docs.columns]
    )
