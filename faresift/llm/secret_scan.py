"""Secrets in texts: broad candidate patterns, then a random forest that removes false positives.

The forest looks at the candidate's length, its character transitions, how much of it a dictionary
covers, whether it is part of a path, and the words beside it. It is trained from labelled findings; where
none are given, findings that a checkable rule settles are the labels.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faresift.llm.common import bounded_sample, held_out, materialise

FOLDS, FOLD = 5, 0
# Labelled findings that the forest is fitted on.
SAMPLE_FINDINGS = 20_000
TREES, DEPTH, SEED = 24, 6, 42
THRESHOLD = 0.5
# Letters of a dictionary word, and documents that hold it: this many, and one in so many of all.
WORD_CHARS, WORD_MOST = 4, 12
WORD_DOCS, DOCS_PER_WORD = 3, 1000
# Seed of Spark's 64-bit hash; places of a value in one row, and parts of values in one batch.
WORD_SEED = 42
PARTS_AT_ONCE, PARTS_OF_BATCH = 4096, 100_000
NEIGHBOURS = 3

# Formats of known issuers, names that announce a secret, names of harmless digests and ids.
ISSUED = (
    r"AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{50,}|glpat-[A-Za-z0-9_-]{20,}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{36}"
    r"|(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}|-----BEGIN [A-Z ]*PRIVATE KEY-----"
)
SECRET_NAMES = frozenset(
    "password passwd passphrase pwd pass secret token apikey key auth credential credentials bearer authorization private access".split()
)
HARMLESS_NAMES = frozenset("commit sha sha1 sha256 md5 digest checksum hash uuid guid etag revision version id isbn phone tel".split())

_CANDIDATE = re.compile(
    rf"(?P<issued>{ISSUED})"
    # A name is a whole run of letters and dashes, looked through once from its start: linear in the text.
    r"|(?P<named>(?i:(?<![a-z_-])(?=[a-z_-]*(?:passw(?:or)?d|passphrase|pwd|secret|token|api_?-?key|credential|access_?-?key))[a-z_-]++)"
    r"[\"']?[ \t]*(?::=|=>|[:=])[ \t]*[\"']?(?P<value>[^\s\"'<>,;]{6,}))"
    r"|(?P<bare>(?<![A-Za-z0-9+/=_.@-])(?=[A-Za-z+/=_.@-]*[0-9])[A-Za-z0-9+/=_-]{16,}(?![A-Za-z0-9@]))"
)
_HARMLESS = re.compile(
    r"[0-9+(). -]+|[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}|(?i:x+|\*+|.*(?:example|changeme|placeholder|your[_-]).*)"
)
_WORD = re.compile(r"[^\W\d_]+")
_KINDS = str.maketrans(
    {c: k for k, own in {"l": "abcdefghijklmnopqrstuvwxyz", "u": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "d": "0123456789"}.items() for c in own}
)

FEATURES = (
    "length",
    "kind_changes",
    "same_as_before",
    "digit_share",
    "upper_share",
    "hex_only",
    "entropy",
    "dictionary_share",
    "in_path",
    "quoted",
    "assigned",
    "secret_name_near",
    "harmless_name_near",
    "issued",
    "harmless_form",
)


def _entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def _parts(value: str, start: int) -> list[dict]:
    """Every run of WORD_CHARS to WORD_MOST letters of a value that begins at PARTS_AT_ONCE places from ``start`` on:
    where it begins, its length and the hash that Spark gives it."""
    low = value.lower()
    found = []
    for at in range(start, min(start + PARTS_AT_ONCE, len(low) - WORD_CHARS + 1)):
        letters = _WORD.match(low, at, at + WORD_MOST)
        most = letters.end() - at if letters else 0
        found += [
            {"at": at, "size": k, "hash": _signed(xxhash.xxh64_intdigest(low[at : at + k].encode("utf-8", "surrogatepass"), WORD_SEED))}
            for k in range(WORD_CHARS, most + 1)
        ]
    return found


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def candidates_of(text: str) -> Iterator[dict]:
    """Candidates of a text, each as one row with its features, and more rows with the parts of a value beyond PARTS_AT_ONCE."""
    for match in _CANDIDATE.finditer(text):
        issued = match["issued"] is not None
        name = "value" if match["value"] is not None else match.lastgroup if not issued else "issued"
        value, (start, end) = match[name], match.span(name)
        before, after = text[max(0, start - 60) : start], text[end : end + 40]
        words = [w.lower() for w in _WORD.findall(before)[-NEIGHBOURS:] + _WORD.findall(after)[:NEIGHBOURS]]
        kinds = value.translate(_KINDS)
        n = len(value)
        pairs = max(1, n - 1)
        yield {
            "first": start,
            "after": end,
            "rule": "issued" if issued else "named" if match["value"] is not None else "bare",
            "value_sha256": hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest(),
            "x": [
                float(n),
                sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / pairs,
                sum(a == b for a, b in zip(value, value[1:], strict=False)) / pairs,
                sum(c.isdigit() for c in value) / n,
                sum(c.isupper() for c in value) / n,
                float(all(c in "0123456789abcdefABCDEF" for c in value)),
                _entropy(value),
                0.0,  # dictionary_share, once the words are counted
                float("/" in value or "\\" in value or before[-1:] in ("/", "\\") or "://" in before[-60:].split(" ")[-1]),
                float(before[-1:] in ("'", '"')),
                float(bool(re.search(r"[:=]\s*[\"']?$", before))),
                float(not SECRET_NAMES.isdisjoint(words)),
                float(not HARMLESS_NAMES.isdisjoint(words)),
                float(issued),
                float(bool(_HARMLESS.fullmatch(value))),
            ],
            "parts": _parts(value, 0),
        }
        for at in range(PARTS_AT_ONCE, n - WORD_CHARS + 1, PARTS_AT_ONCE):
            yield {"first": start, "parts": _parts(value, at)}


_FOUND = "first int, after int, rule string, value_sha256 string, x array<double>"
_PARTS = "parts array<struct<at:int,size:int,hash:bigint>>"


def dictionary(docs: DataFrame) -> DataFrame:
    """(hash): words of WORD_CHARS to WORD_MOST letters that WORD_DOCS documents and one in DOCS_PER_WORD hold, counted over all."""
    least = max(WORD_DOCS, docs.count() / DOCS_PER_WORD)
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word"))
    words = words.filter(F.char_length("word").between(WORD_CHARS, WORD_MOST)).groupBy(F.xxhash64("word").alias("hash"))
    return words.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select("hash")


def _found_in(docs: DataFrame) -> DataFrame:
    """(row, doc_id, held_out, first, after, rule, value_sha256, x, parts): see ``candidates_of``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([docs.schema["doc_id"]]).add("held_out", "boolean").add("row", "long")
    for field in StructType.fromDDL(f"{_FOUND}, {_PARTS}"):
        schema = schema.add(field)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts = [], 0
            for doc_id, out, row, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                for found in candidates_of(text or ""):
                    rows.append({"doc_id": doc_id, "held_out": out, "row": row} | found)
                    parts += len(found["parts"])
                    if parts > PARTS_OF_BATCH:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, parts = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    named = docs.select("doc_id", held_out("doc_id", FOLDS, FOLD).alias("held_out"), F.monotonically_increasing_id().alias("row"), "text")
    return named.mapInArrow(run, schema)


def candidates(docs: DataFrame, known: frozenset[str] | None = None) -> DataFrame:
    """(doc_id, held_out, first, after, rule, value_sha256, x): every candidate of the whole texts.

    ``known`` are the dictionary's words if they are not to be counted.
    The share of a value that dictionary words cover is found by joining the runs of letters in it with the words of
    all documents, by hash; at each place the longest word counts, then the place behind it.
    """
    found = materialise(_found_in(docs), "candidates")
    if known is None:
        words = dictionary(docs.select("doc_id", "text"))
    else:
        words = docs.sparkSession.createDataFrame([(w,) for w in sorted(known)], "word string").select(F.xxhash64("word").alias("hash"))
    met = found.select("row", "first", F.inline("parts")).join(words, "hash").groupBy("row", "first")
    hits = F.array_sort(F.collect_list(F.struct("at", (-F.col("size")).alias("size"))))
    start = F.struct(F.lit(0).alias("next"), F.lit(0).alias("hit"))
    step = lambda had, word: F.when(
        word["at"] >= had["next"], F.struct((word["at"] - word["size"]).alias("next"), (had["hit"] - word["size"]).alias("hit"))
    ).otherwise(had)
    shares = met.agg(F.aggregate(hits, start, step)["hit"].alias("hit"))
    whole = found.filter("x IS NOT NULL").drop("parts").join(shares, ["row", "first"], "left")
    share = F.coalesce(F.col("hit"), F.lit(0)) / F.get("x", FEATURES.index("length"))
    at = FEATURES.index("dictionary_share")
    filled = F.transform("x", lambda v, i: F.when(i == at, share).otherwise(v)).alias("x")
    return whole.select("doc_id", "held_out", "first", "after", "rule", "value_sha256", filled)


def _x(name: str):
    return F.get("x", FEATURES.index(name))


def rule_labels(found: DataFrame) -> DataFrame:
    """Findings that a rule settles, with label 1 or 0: issued formats and named random values are secrets;
    placeholders, numbers, ids, values of dictionary words and bare values beside harmless names are not."""
    harmless = (_x("harmless_form") == 1) | (_x("dictionary_share") > 0.6) | ((F.col("rule") == "bare") & (_x("harmless_name_near") == 1))
    random = (_x("entropy") >= 2.8) & (_x("digit_share") > 0.05) & (_x("dictionary_share") < 0.3)
    secret = (F.col("rule") == "issued") | ((F.col("rule") == "named") & random)
    bare = (F.col("rule") == "bare") & (_x("secret_name_near") == 0)
    label = F.when(harmless, 0).when(secret, 1).when(bare, 0)
    return found.withColumn("label", label).filter("label IS NOT NULL").select("doc_id", "first", "after", "x", "label")


def train(labelled: DataFrame) -> tuple[RandomForestClassificationModel | float, bool]:
    """A forest from at most SAMPLE_FINDINGS labelled findings, or a constant where they do not differ; and
    whether the findings have issued formats among them."""
    rows = bounded_sample(labelled, SAMPLE_FINDINGS, "doc_id", "first").select("x", F.col("label").cast("double").alias("label"))
    rows = materialise(rows, "labelled-findings")
    kinds = rows.groupBy("label", (_x("issued") == 1).alias("issued")).count().collect()
    seen, issued = {r["label"] for r in kinds}, any(r["issued"] for r in kinds)
    if len(seen) < 2:
        return (seen.pop() if seen else 0.5), issued
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt", minInstancesPerNode=2)
    return forest.fit(rows.select(array_to_vector("x").alias("features"), "label").coalesce(1)), issued


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """One row per candidate: doc_id, held_out, first, after (code points), rule, value_sha256, score, is_secret.

    findings: labelled findings (doc_id, first, after, label) to train from, by default those that rules settle
    outside the held-out fold. Whether a value looks like a placeholder, number or id is a feature, so given
    labels decide if it is a secret; without them it never is. A forest that saw no issued format does not judge those: they stay, with score 1. Null and empty texts have no candidate; repeated rows give their candidates again. Values
    never leave as text. Other columns of docs are not read.
    """
    found = materialise(candidates(docs), "judged-candidates")
    if findings is None:
        labelled = rule_labels(found.filter("NOT held_out"))
    else:
        labelled = found.join(findings.select("doc_id", "first", "after", "label"), ["doc_id", "first", "after"])
    model, knows_issued = train(labelled)
    if isinstance(model, float):
        scored = found.withColumn("score", F.lit(model))
    else:
        vectors = found.withColumn("features", array_to_vector("x"))
        scored = model.transform(vectors).withColumn("score", F.get(vector_to_array("probability"), 1))
    if not knows_issued:
        scored = scored.withColumn("score", F.when(F.col("rule") == "issued", 1.0).otherwise(F.col("score")))
    if findings is None:
        # No label speaks for placeholders, numbers and plain ids then, so they are no secrets whatever stands beside them.
        scored = scored.withColumn("score", F.when(_x("harmless_form") == 1, 0.0).otherwise(F.col("score")))
    return scored.select(
        "doc_id", "held_out", "first", "after", "rule", "value_sha256", "score", (F.col("score") >= THRESHOLD).alias("is_secret")
    )
