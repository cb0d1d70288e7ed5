"""Near and exact duplicates against brute force, and the defined edge cases."""

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from compare import connect, differences
from faresift.llm import exact_dedup, graph, queries, simhash

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, fp string, row int"


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(nodes, near):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(nodes), 2):
        if near(a, b):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="aAbÉz \t\n\x0b\x1c\xa0日", max_size=60)))
def test_fingerprint_is_the_majority_of_shingle_hashes(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_of_a_long_text_does_not_depend_on_blocks():
    text = " ".join(f"w{i % 5001}" for i in range(70_000))
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    prints = {d: slow_fingerprint(t) for d, t in docs.items()}
    roots = slow_components(docs, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op1_simhash(spark, SMALL).collect()}
    assert got == {d: (f"{prints[d]:016x}", roots[d]) for d in docs}


@pytest.mark.parametrize("spread", [2, 9])
def test_links_are_all_pairs_within_four_bits(spark, spread):
    random = np.random.default_rng(spread)
    base = random.integers(0, 2**63, 12, dtype=np.uint64)
    prints = {int(np.uint64(b) ^ np.bitwise_or.reduce(np.uint64(1) << random.integers(0, 64, spread).astype(np.uint64))) for b in base for _ in range(12)}
    signed = sorted(p - 2**64 if p >= 2**63 else p for p in prints)
    fps = spark.createDataFrame([(p, p) for p in signed], "fp long, part long")
    apart = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    pairs = list(combinations(signed, 2))
    assert {tuple(r) for r in simhash.links(fps).collect()} == {p for p in pairs if apart(*p) <= 4}
    assert {tuple(sorted(r)) for r in simhash.neighbours(fps).collect()} == {p for p in pairs if apart(*p) == 1}
    marked = fps.withColumnRenamed("part", "doc_id")
    want = slow_components(signed, lambda a, b: apart(a, b) <= 4)
    assert {r.fp: r.component_id for r in simhash._grouped(marked).collect()} == want


def test_components_of_a_path_a_star_and_loops(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 60)]
    links = spark.createDataFrame([*path, *star, (200, 200), (301, 300), (300, 301)], "a long, b long")
    got = {r.node: r.root for r in graph.components(links, "a", "b").collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)} | {300: 300, 301: 300}
    assert got == want


def test_near_duplicate_edges(frame):
    rows = [(1, None, "x", "f", 1), (2, "", "x", "f", 2), (3, " \n", "x", "f", 3), (None, "a b c d e", "x", "f", 4)]
    rows += [(9, "A b c d e", "x", "f", 5), (9, "A b c d e", "x", "f", 6), (4, "lone", None, None, None)]
    docs = frame(rows, DOC)
    got = sorted((r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == [(0, 9), (1, 1), (2, 1), (3, 1), (4, 4), (9, 9), (9, 9)]
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 9]


def test_near_duplicates_without_ids_and_without_rows(frame):
    docs = frame([(None, "one two", "x", "f", 1), (None, "one two", "x", "f", 2), (None, "other text", "x", "f", 3)], DOC)
    assert simhash.keep_one(docs).count() == 2
    assert simhash.keep_one(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_components_with_the_same_least_id_keep_a_document_each(frame):
    rows = [(1, "one two three four five", "x", "f", 1), (2, "One two three four five", "x", "f", 2)]
    rows += [(1, "six seven eight nine ten", "x", "f", 3), (3, "Six seven eight nine ten", "x", "f", 4)]
    assert sorted(r.row for r in simhash.keep_one(frame(rows, DOC)).collect()) == [1, 3]


def test_exact_query_matches_sql(spark):
    df = queries.op2_exact_dedup(spark, SMALL)
    assert differences(df, connect(SMALL), queries.ORACLE_SQL["op2_exact_dedup"]) == []


def test_exact_groups_that_fill_many_ranges(spark):
    """One text holds most rows, so its run crosses several range seams."""
    rows = [(i, "hot  text" if i % 10 else f"t{i % 70}", "s") for i in range(4000)]
    df = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string, sha string").repartition(7))
    want = {}
    for i, text, _ in rows:
        want.setdefault(" ".join(text.split()), []).append(i)
    groups = {i: (min(own), len(own), i == min(own)) for own in want.values() for i in own}
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in df.collect()} == groups


def test_exact_edges(frame):
    rows = [(2, None, "", "", 0), (1, "", "", "", 0), (5, " ", "", "", 0), (6, "\t\r\n", "", "", 0), (7, "x" * 200_000, "", "", 0)]
    rows += [(3, "same", "", "", 0), (3, "same", "", "", 1), (None, "same", "", "", 2), (None, "alone", "", "", 3)]
    got = exact_dedup.exact_duplicates(frame(rows, DOC)).collect()
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size) for r in got if r.keep_id) == [
        (0, 3, 3), (1, 1, 2), (2, 1, 2), (3, 3, 3), (3, 3, 3), (5, 5, 2), (6, 5, 2), (7, 7, 1),
    ]
    assert sum(r.kept for r in got) == 5
    assert exact_dedup.exact_duplicates(frame([], DOC)).count() == 0
