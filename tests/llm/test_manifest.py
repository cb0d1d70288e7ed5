"""The manifest against a plain tree over all rows, with small superblocks, and its edge cases."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from compare import connect, differences
from faresift.llm import merkle, queries

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, source string, n_chars long, tree string, place int, digest string, root string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow_tree(digests):
    """Top of a tree and, per leaf, the (left, right) siblings of each level."""
    ways, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, p in enumerate(at):
            first = p // 16 * 16
            ways[i].append(("".join(level[first:p]), "".join(level[p + 1 : first + 16])))
        at = [p // 16 for p in at]
        level = [sha("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
    return level[0], ways


def slow_manifest(rows, changed):
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: sha("".join(map(said, (r.doc_id, r.source, r.lang, r.n_chars, t))))
    own = defaultdict(list)
    for r in rows:
        own[r.source].append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), leaf(r, changed(r))))
    sources = sorted(own, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: slow_tree([r[2] for r in sorted(own[s])]) for s in sources}
    root, above = slow_tree([trees[s][0] for s in sources]) if sources else (None, [])
    found = []
    for s, upper in zip(sources, above, strict=True):
        for (known, doc_id, digest, now), way in zip(sorted(own[s]), trees[s][1], strict=True):
            steps = way + upper
            for left, right in steps:
                now = sha(left + now + right)
            proof = sha("".join(left + right for left, right in steps))
            found.append((doc_id if known else None, digest, trees[s][0], root, proof, now, now == root))
    return sorted(found, key=str)


def lowered(r):
    if r.doc_id is None or r.text is None or zlib.crc32(str(r.doc_id).encode()) % 5:
        return r.text
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text)


def test_query_equals_the_plain_tree(spark):
    got = sorted(map(tuple, queries.op11_merkle(spark, SMALL).collect()), key=str)
    assert got == slow_manifest(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), lowered)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_query_matches_sql(spark):
    assert differences(queries.op11_merkle(spark, MEDIUM), connect(MEDIUM), queries.ORACLE_SQL["op11_merkle"]) == []


def awkward(n=700):
    rows = [(i, f"Text {i} É\n", "en", "hot", i, "t", 1, "d", "r") for i in range(n)]
    rows += [(i, "" if i % 2 else None, None, None, None, None, None, None, None) for i in range(17)]
    rows += [(5, "again", "en", "hot", 1, "x", 2, "y", "z")] * 3 + [(5, "other", "de", "hot", 1, "x", 2, "y", "z")]
    rows += [(None, "no id", "en", "hot", 5, "t", 1, "d", "r"), (None, None, None, "lone", None, None, None, None, None)]
    rows += [(2**53 + 1, "A" * 300_000, "en", "", 1, None, None, None, None), (-3, "b", "en", "é", 1, None, None, None, None)]
    return rows + [(i, "s", "en", f"src{i}", 1, None, None, None, None) for i in range(300)]


@pytest.mark.parametrize("parts", [1, 7])
def test_awkward_rows(spark, monkeypatch, parts):
    """Several rounds of superblocks: null, empty, repeated and large values, many sources, one of them hot."""
    docs = spark.createDataFrame(awkward(), DOC).repartition(parts)
    got = sorted(map(tuple, merkle.manifest(docs).collect()), key=str)
    assert got == slow_manifest(docs.collect(), lambda r: r.text)
    assert all(r[-1] for r in got)


def test_more_than_one_round(spark):
    docs = spark.range(merkle.SUPERBLOCK * 2 + 1).selectExpr("id AS doc_id", "'a' AS text", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    got = sorted(map(tuple, merkle.manifest(docs).collect()), key=str)
    assert got == slow_manifest(docs.collect(), lambda r: r.text)


def test_every_changed_row_shows(spark, frame):
    from pyspark.sql import functions as F

    docs = frame([(i, f"t{i}", "en", f"s{i % 3}", i, None, None, None, None) for i in range(100)], DOC)
    found = merkle.manifest(docs, F.when(F.col("doc_id") == 41, "forged").otherwise(F.col("text")))
    assert [r.doc_id for r in found.collect() if not r.verified] == [41]


def test_empty_table(frame):
    found = merkle.manifest(frame([], DOC))
    assert found.collect() == []
    assert dict(found.dtypes)["doc_id"] == "bigint"
