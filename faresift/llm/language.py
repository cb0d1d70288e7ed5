"""Language of a text by compression against one raw-content dictionary per language.

The text is cut into pieces, so that the dictionary and not the text's own past explains them, and every
piece is encoded with zstandard once per language; the language whose dictionary leaves the fewest bytes
wins. Where the winner leads by less than MIN_LEAD bytes the prediction is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faresift.llm.common import hash_place, held_out, place_bound

FOLDS, FOLD = 4, 2
UNKNOWN = "und"
# Bounds of the sample that is fitted on: documents per language, bytes of one of them (a longer one gives a piece),
# bytes of a dictionary, to which the joined sample is cut.
SAMPLE_DOCS = 300
SAMPLE_BYTES = 8_000
DICTIONARY_BYTES = 256_000
PIECE_BYTES = 2_000
MIN_LEAD = 2
# Short matches of four bytes, found greedily: words of a language are short.
SETTINGS = zstandard.ZstdCompressionParameters(
    strategy=zstandard.STRATEGY_GREEDY, min_match=4, search_log=3, window_log=19, chain_log=18, hash_log=18, write_content_size=False
)

_LETTER = regex.compile(r"\p{L}")
_BLANKS = regex.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+")


def encoded(text: str) -> bytes:
    """Lower case, with whatever is not a letter in ASCII as one space."""
    return _BLANKS.sub(b" ", text.lower().encode("utf-8", "surrogatepass"))


def dictionaries(sample: list[tuple[str, str]]) -> tuple[tuple[str, bytes], ...]:
    """(language, content of its dictionary) from (language, text) rows."""
    texts: dict[str, list[str]] = {}
    for lang, text in sample:
        texts.setdefault(lang, []).append(text)
    return tuple((lang, b" ".join(map(encoded, own))[:DICTIONARY_BYTES]) for lang, own in sorted(texts.items()))


@lru_cache(maxsize=2)
def compressors(contents: tuple[tuple[str, bytes], ...]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    def compressor(content: bytes) -> zstandard.ZstdCompressor:
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=SETTINGS)
        return zstandard.ZstdCompressor(compression_params=SETTINGS, dict_data=known)

    # Less than eight bytes are no dictionary.
    return [(lang, compressor(content.ljust(8))) for lang, content in contents]


def predict(text: str | None, languages: list[tuple[str, zstandard.ZstdCompressor]]) -> tuple[str, float, bool]:
    """(language, score, rejected). The score is one over the sum of 2^-(bytes behind the best) of all languages."""
    if not text or not languages or not _LETTER.search(text):
        return UNKNOWN, 0.0, True
    raw = encoded(text)
    pieces = [raw[at : at + PIECE_BYTES] for at in range(0, len(raw), PIECE_BYTES)]
    sizes = sorted((sum(len(c.compress(p)) for p in pieces), lang) for lang, c in languages)
    best, lang = sizes[0]
    score = 1 / sum(2.0 ** -min(size - best, 60) for size, _ in sizes)
    return lang, score, len(sizes) > 1 and sizes[1][0] - best < MIN_LEAD


def fit(docs: DataFrame) -> tuple[tuple[str, bytes], ...]:
    """Dictionaries from at most SAMPLE_DOCS documents a language, taken by hash of the id from rows with a language, a
    letter and an id outside the held-out fold. A document of more than SAMPLE_BYTES gives a piece at a hashed place."""
    usable = docs.filter(F.col("lang").isNotNull() & ~held_out("doc_id", FOLDS, FOLD)).filter(
        F.col("text").rlike(r"\p{L}")
    )
    place = hash_place("doc_id", "text")
    # One row per language; its bound lets few more rows pass than the sample takes.
    counted = usable.groupBy("lang").count().collect()
    bounds = usable.sparkSession.createDataFrame(
        [(r["lang"], place_bound(SAMPLE_DOCS, r["count"])) for r in counted], "lang string, bound long"
    )
    order = Window.partitionBy("lang").orderBy(place, "doc_id")
    few = usable.join(F.broadcast(bounds), "lang").filter(place < F.col("bound"))
    # A character has four bytes at most. A piece without a letter gives way to the one from the first letter on.
    chars = SAMPLE_BYTES // 4
    start = F.pmod(F.xxhash64("doc_id", "text", F.lit(1)), F.char_length("text") - chars + 1).cast("int") + 1
    piece = F.substring("text", start, chars)
    lettered = F.substring("text", F.regexp_instr("text", F.lit(r"\p{L}")), chars)
    piece = F.when(piece.rlike(r"\p{L}"), piece).otherwise(lettered)
    text = F.when(F.octet_length("text") <= SAMPLE_BYTES, F.col("text")).otherwise(piece).alias("text")
    sample = few.select("lang", text, F.row_number().over(order).alias("nth")).filter(F.col("nth") <= SAMPLE_DOCS)
    rows = sample.select("lang", "nth", "text").collect()
    return dictionaries([(r["lang"], r["text"]) for r in sorted(rows, key=lambda r: (r["lang"], r["nth"]))])


def languages(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score, rejected.

    lang_pred is ``und`` with score 0 for null texts, texts without a letter, and all texts if no row
    teaches a language. Ties go to the language first in the alphabet and are rejected. Other columns
    are not read; lang only to fit.
    """
    contents = fit(docs.select("doc_id", "text", "lang"))
    out = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def identify(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = compressors(contents)
        for batch in texts:
            found = [predict(t.as_py(), known) for t in batch]
            yield pa.array([dict(zip(out.names, row, strict=True)) for row in found], out)

    udf = F.arrow_udf(identify, "lang_pred string, score double, rejected boolean")
    scored = docs.select("doc_id", held_out("doc_id", FOLDS, FOLD).alias("held_out"), udf("text").alias("found"))
    return scored.select("doc_id", "held_out", "found.*")
