"""Exact duplicates by sorting content: sampled splitters deal ranges, Spark's external sort puts equal
texts side by side, and neighbours are compared in full.

Splitters are (first characters, SHA-256, doc_id), so a sampled row is small and a group of equal texts
is spread over as many ranges as it fills. A run that continues in the next range is joined to it by
comparing the whole texts at the seam.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faresift.llm.common import BLANK, materialise

SPLITTER_CHARS = 32
ROW, HEAD, TAIL = 0, 1, 2


def _runs(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal texts of a sorted range; send the texts at both ends along."""
    pid, run, last = TaskContext.get().partitionId(), -1, None

    def rows(edge: int, runs, ids, shas, firsts, texts) -> pa.RecordBatch:
        n = len(runs)
        columns = [pa.array([edge] * n, pa.int32()), pa.array([pid] * n, pa.int32()), pa.array(runs, pa.int64()), ids, shas]
        columns += [pa.array(firsts, pa.bool_()), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    empty = lambda kind: pa.nulls(1, kind)
    id_type, sha_type = schema.field("doc_id").type, schema.field("sha").type
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(1)
        new = np.ones(batch.num_rows, bool)
        if batch.num_rows > 1:
            new[1:] = pc.not_equal(texts.slice(1), texts.slice(0, len(texts) - 1)).to_numpy(zero_copy_only=False)
        if last is None:
            yield rows(HEAD, [0], empty(id_type), empty(sha_type), [False], [texts[0].as_py()])
        elif texts[0].as_py() == last:
            new[0] = False
        runs = run + np.cumsum(new)
        yield rows(ROW, runs, batch.column(0), batch.column(2), new, [None] * len(runs))
        run, last = int(runs[-1]), texts[len(texts) - 1].as_py()
    if last is not None:
        yield rows(TAIL, [run], empty(id_type), empty(sha_type), [False], [last])


def _seams(runs: DataFrame) -> DataFrame:
    """(pid, to_pid, to_run): for each range whose first run continues an earlier one, where that run began.

    One row per range goes through the windows; the texts at the seams only meet in an equi-join.
    """
    ends = runs.filter(F.col("edge") == TAIL).select("pid", F.col("run").alias("last_run"))
    order = Window.orderBy("pid")
    ends = ends.select(
        "pid", F.lag("pid").over(order).alias("before"), F.lag("last_run").over(order).alias("before_run")
    )
    heads = runs.filter(F.col("edge") == HEAD).select("pid", F.col("text").alias("head"))
    tails = runs.filter(F.col("edge") == TAIL).select(F.col("pid").alias("before"), F.col("text").alias("tail"))
    seams = ends.join(heads, "pid").join(tails, "before", "left")
    joined = F.coalesce(F.col("head") == F.col("tail"), F.lit(False))
    start = F.when(~joined, F.struct(F.col("pid").alias("pid"), F.lit(0).cast("long").alias("run"))).when(
        F.col("before_run") > 0, F.struct(F.col("before").alias("pid"), F.col("before_run").alias("run"))
    )
    seams = seams.select("pid", joined.alias("joined"), start.alias("start"))
    begun = F.last("start", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return seams.withColumn("begun", begun).filter("joined").select(
        F.col("pid").alias("seam_pid"), F.col("begun.pid").alias("to_pid"), F.col("begun.run").alias("to_run")
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of blanks is one space; null counts as empty. The row
    with the least doc_id stays; null ids come last, and of rows that repeat the least id exactly one is
    kept. Other columns of docs are not read.
    """
    text = F.regexp_replace(F.coalesce("text", F.lit("")), BLANK, " ")
    texts = docs.select("doc_id", text.alias("text"))
    texts = texts.select("doc_id", "text", F.unhex(F.sha2("text", 256)).alias("sha"))
    order = [F.substring("text", 1, SPLITTER_CHARS), F.col("sha"), F.col("doc_id").asc_nulls_last()]
    schema = StructType.fromDDL("edge int, pid int, run long").add(docs.schema["doc_id"])
    for field in StructType.fromDDL("sha binary, first boolean, text string"):
        schema = schema.add(field)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    ranges = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = materialise(ranges.mapInArrow(lambda batches: _runs(batches, arrow), schema), "runs")

    rows = runs.filter(F.col("edge") == ROW).drop("edge", "text")
    seam = (F.col("pid") == F.col("seam_pid")) & (F.col("run") == 0)
    rows = rows.join(_seams(runs), seam, "left").select(
        "doc_id",
        "sha",
        (F.col("first") & F.col("to_pid").isNull()).alias("kept"),
        F.coalesce("to_pid", "pid").alias("group_pid"),
        F.coalesce("to_run", "run").alias("group_run"),
    )
    keys = ["group_pid", "group_run"]
    groups = rows.groupBy(*keys).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Written, so that the join deals both sides anew and a large group's rows can be split over tasks.
    groups = materialise(groups, "groups")
    return rows.join(groups, keys).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )
