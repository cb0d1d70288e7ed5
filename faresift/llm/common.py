"""What the operators share: tables, materialised steps and the fixed word rules."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faresift.session import work_root

# White space of the word rules, ASCII letters of the case rule.
BLANK = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
PLACES = 1 << 40
BLANK_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared scratch folder and read it again: lineage ends here and the step runs once."""
    path = f"{work_root(df.sparkSession)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's text leaves this remainder; an id that is null counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == fold


def hash_place(*key: str) -> Column:
    """A row's place among all rows by the hash of its key, from 0 to PLACES - 1."""
    return F.pmod(F.xxhash64(*key), F.lit(PLACES))


def place_bound(size: int, rows: int) -> int:
    """Places below which rows hold a sample of this size and few more."""
    return min(PLACES, int(PLACES * (1.2 * size + 100) / max(1, rows)))


def bounded_sample(df: DataFrame, size: int, *key: str) -> DataFrame:
    """At most ``size`` rows, those with the smallest hash of the key.

    The rows are counted first, so that no more than a few over the sample ever leave their tasks.
    """
    place = hash_place(*key)
    return df.filter(place < place_bound(size, df.count())).orderBy(place, *key).limit(size)
