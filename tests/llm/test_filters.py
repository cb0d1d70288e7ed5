"""Quality, language and benchmark filters: brute force, held-out accuracy and edge cases."""

import hashlib
import re
import zlib
from random import Random

import numpy as np
import pytest

from compare import connect, differences
from faresift.llm import decontaminate, language, quality, queries

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOC = "doc_id long, text string, lang string, f0 string, row int, score string"


def slow_words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def slow_contamination(text, items):
    words, hit, met = slow_words(text), set(), set()
    for item_id, own in items:
        own = slow_words(own)
        size = min(13, len(own))
        for k in range(len(own) - size + 1) if own else []:
            for i in range(len(words) - size + 1):
                if words[i : i + size] == own[k : k + size]:
                    hit |= set(range(i, i + size))
                    met.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
    return len(words), len(hit), len(met), digest, bool(hit) and 20 * len(hit) >= len(words)


def test_contamination_query_equals_brute_force(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r[0]: tuple(r)[1:] for r in queries.op8_decontaminate(spark, SMALL).collect()}
    some = {d for d, found in got.items() if found[1]} | set(list(docs)[:15])
    assert {d: got[d] for d in some} == {d: slow_contamination(docs[d], items) for d in some}
    assert len(got) == len(docs)


def test_contamination_query_matches_sql(spark):
    df = queries.op8_decontaminate(spark, SMALL)
    assert differences(df, connect(SMALL), queries.ORACLE_SQL["op8_decontaminate"]) == []


ITEMS = [(10, "Alpha-beta GAMMA"), (9, "alpha beta gamma"), (3, " ".join(f"w{i}" for i in range(20))), (4, "..!"), (5, None)]


@pytest.mark.parametrize("chars", [4_000_000, 40])
def test_contamination_edges(frame, monkeypatch, chars):
    """One automaton, or several where the benchmark is larger than the bound."""
    monkeypatch.setattr(decontaminate, "WINDOW_CHARS", chars)
    texts = [None, "", "...", "x alpha beta gamma", "xalpha beta gamma", "ALPHA, beta; gamma " + "y " * 57, "alpha beta gamma " + "y " * 58]
    texts += [" ".join(f"w{i}" for i in range(1, 18)) + " tail", "é alpha\nbeta gamma gamma", "w " * 100_000 + "alpha beta gamma"]
    docs = frame([(i, t, "en", "a", i, None) for i, t in enumerate(texts)], DOC)
    items = frame([(i, t, "z") for i, t in ITEMS], "item_id long, text string, row string")
    got = {r.doc_id: tuple(r)[1:6] for r in decontaminate.contamination(docs, items).collect()}
    assert got == {i: slow_contamination(t, ITEMS) for i, t in enumerate(texts)}
    kept = decontaminate.clean(docs, items)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, f in got.items() if not f[4])


def test_contamination_spans_point_into_the_original(frame):
    text = "Été: (Alpha-Beta!  gamma) fin"
    found = decontaminate.contamination(frame([(1, text, "", "", 0, "")], DOC), frame(ITEMS, "item_id long, text string"))
    (span,) = found.first().byte_spans
    assert text.encode()[span["first"] : span["after"]].decode() == "Alpha-Beta!  gamma"


def test_windows_of_random_items_equal_brute_force(monkeypatch):
    random = Random(4)
    say = lambda n, v: " ".join(f"w{random.randrange(v)}" for _ in range(n))
    for _ in range(150):
        v = random.choice([2, 5, 30])
        monkeypatch.setattr(decontaminate, "PIECE_WORDS", random.choice([13, 17, 4096]))
        items = [(i, say(random.choice([0, 1, 4, 5, 12, 13, 14, 30, 60]), v)) for i in range(random.randrange(6))]
        text = say(random.randrange(30), v + 2)
        for _, item in items:
            words = item.split()
            at = random.randrange(len(words) + 1)
            text += " zz " * random.randrange(2) + " " + " ".join(words[at : at + random.randrange(40)])
        found = decontaminate.Items(tuple((str(i), piece) for i, item in items for piece in decontaminate.pieces_of(item)))
        n, spans, names = found.scan(text)
        want = slow_contamination(text, items)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        assert (n, sum(b - a for a, b in spans), len(names), digest) == want[:4]


def test_parts_of_a_large_benchmark_are_bounded_and_equal(spark, frame, monkeypatch):
    """Every part but a lone piece is within the bound, and steps give what one automaton gives."""
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    whole = {tuple(r)[:6] for r in decontaminate.contamination(docs, items).collect()}
    size = items.selectExpr("sum(octet_length(text))").first()[0]
    monkeypatch.setattr(decontaminate, "WINDOW_CHARS", size // 3)
    parts = list(decontaminate._parts(items))
    assert len(parts) > 2
    assert all(sum(len(line) + len(i) for i, line in own) <= size // 3 or len(own) == 1 for own in parts)
    assert {tuple(r)[:6] for r in decontaminate.contamination(docs, items).collect()} == whole


def test_automaton_grows_with_the_items_and_not_with_their_windows():
    random = Random(2)
    line = b" ".join(b"w%d" % random.randrange(20_000) for _ in range(4000))
    states = decontaminate.Items((("1", line),)).automaton.get_stats()["nodes_count"]
    assert states < 2 * 4000


def test_contamination_without_rows(frame):
    docs, none = frame([(1, "a b", "", "", 0, "")], DOC), frame([], "item_id long, text string")
    assert tuple(decontaminate.contamination(docs, none).first())[1:4] == (2, 0, 0)
    assert decontaminate.clean(docs, none).count() == 1
    assert decontaminate.contamination(docs.limit(0), none).count() == 0


def test_quality_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = queries.op4_quality(spark, MEDIUM).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.95 * len(held)


def test_model_learns_steps_and_an_interaction():
    random = np.random.default_rng(1)
    x = random.random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.6) | ((x[:, 2] > 0.5) ^ (x[:, 3] > 0.5))).astype(float)
    model = quality.fit(x, y)
    assert (2, 3) in model.pairs
    assert ((model.scores(x) > 0.5) == y).mean() > 0.95


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, None), (None, 0), (2, 0), (2, 1), (2, 1)]])
def test_quality_edges(frame, labels):
    texts = [None, "", "plain words here", "word " * 200_000, "?!", "😀".encode("utf-16", "surrogatepass").decode("utf-16")]
    docs = frame([(i, t, None, "a", 0, "b") for i, t in enumerate(texts)] + [(None, "no id", None, None, None, None)], DOC)
    known = frame([(d, q, 0, "x") for d, q in labels], "doc_id long, quality int, toxic int, text string")
    rows = quality.quality_scores(docs, known).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    assert quality.keep_good(docs, known).schema == docs.schema
    if not labels:
        assert {r.score for r in rows} == {0.5}
        assert quality.keep_good(docs, known).count() == 7
    assert quality.quality_scores(docs.limit(0), known).count() == 0


def test_language_held_out_accuracy(spark):
    known = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    rows = queries.op9_language(spark, MEDIUM).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and len(known[r.doc_id][1]) > 100]
    assert sum(r.lang_pred == known[r.doc_id][0] for r in held) >= 0.95 * len(held)


def test_language_edges(frame):
    learn = [(i, f"der die das und ist nicht {i} heit", "de", "", 0, "") for i in range(40)]
    learn += [(100 + i, f"the and of is not {i} tion", "en", "", 0, "") for i in range(40)]
    odd = [(900, None, None), (901, "", "en"), (902, "12 !? _", "de"), (903, "the and of is not this tion " * 9, None), (904, "THE AND OF " * 60_000, None), (None, "und", "de")]
    docs = frame(learn + [(i, t, lang, "", 0, "") for i, t, lang in odd], DOC)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.languages(docs).collect()}
    assert [got[i] for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert got[903][0] == got[904][0] == "en"
    assert got[None][0] in ("de", "en")
    assert all(0 <= score <= 1 for _, score in got.values())
    unknown = frame([(1, "text", None, "", 0, "")], DOC)
    assert language.languages(unknown).first().lang_pred == "und"
    assert language.languages(unknown.limit(0)).count() == 0


def test_language_of_long_texts_only_is_learned(frame):
    """One language has nothing but long texts, one of them with a letter at its end alone."""
    rows = [(i, f"short words of the common kind number {i}", "aa", "") for i in range(40)]
    rows += [(100 + i, f"mnogo drugih slov v etom tekste {i} " * 400, "bb", "") for i in range(20)]
    rows += [(200 + i, "1 " * 9_000 + f"konec{i} slova", "cc", "") for i in range(4)]
    docs = frame(rows, "doc_id long, text string, lang string, source string")
    contents = dict(language.fit(docs.select("doc_id", "text", "lang")))
    assert set(contents) == {"aa", "bb", "cc"} and b"konec" in contents["cc"]
    got = {r.doc_id: r.lang_pred for r in language.languages(docs).collect()}
    assert all(got[i] == "aa" for i in range(40)) and all(got[100 + i] == "bb" for i in range(20))
