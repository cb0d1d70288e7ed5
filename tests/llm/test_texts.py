"""Line chunks, packing, chat formatting, page extraction and secrets."""

import hashlib
import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from compare import connect, differences
from faresift.llm import chat, extraction, line_dedup, packing, queries, secret_scan, tokens

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, spans string, row int, n_chars long"
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")


def passage(name, n=60):
    return " ".join(f"{name}{i}" for i in range(n))


def test_line_query_matches_sql(spark):
    df = queries.op7_line_dedup(spark, SMALL)
    assert differences(df, connect(SMALL), queries.ORACLE_SQL["op7_line_dedup"]) == []


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_whole_passages_match_sql(spark, folder):
    df = queries.op7_whole_passages(spark, folder)
    assert differences(df, connect(folder), queries.ORACLE_SQL["op7_whole_passages"]) == []


def test_repeated_passages_stay_once(frame):
    a, b, short = passage("a"), passage("b"), "a short line"
    verse = "\n".join(passage(f"v{k}", 10) for k in range(6))
    rows = [(2, f"{a}\nown two\n{b}"), (1, f"first\n{a}"), (3, f"{short}\n\n{verse}\n\nend"), (4, f"{verse}\n\n{short}")]
    rows += [(5, a), (6, f"{b} changed"), (7, None), (8, ""), (None, f"{b}\ntail"), (9, f"{b}\n{b}")]
    docs = frame([(i, t, "x", 1, len(t or "")) for i, t in rows], DOC)
    kept = line_dedup.clean(docs)
    assert kept.dtypes == docs.dtypes
    got = {r.doc_id: r.text for r in kept.collect()}
    assert got == {
        1: f"first\n{a}", 2: f"own two\n{b}", 3: f"{short}\n\n{verse}\n\nend", 4: f"\n{short}", 5: "",
        6: f"{b} changed", 7: None, 8: "", None: "tail", 9: "",
    }
    assert all(r.n_chars == len(r.text or "") for r in kept.collect() if r.doc_id != 7)


def test_short_lines_are_met_again_inside_other_lines(frame):
    """Forty short lines between other short lines: what is left is at most the way to the first boundary."""
    shared = [f"shared line number {i} of the passage" for i in range(40)]
    own = lambda name: [f"{name} has an own line {i}" for i in range(9)]
    docs = frame([(k, "\n".join([*own(f"d{k}"), *shared, *own(f"e{k}")]), "", 0, 0) for k in range(4)], DOC)
    got = {r.doc_id: r.text.split("\n") for r in line_dedup.clean(docs).collect()}
    assert len(got[0]) == 58
    for k in (1, 2, 3):
        assert set(own(f"d{k}") + own(f"e{k}")) <= set(got[k])
        assert len(got[k]) <= 18 + 12


@pytest.mark.parametrize(("lines", "words"), [(2, 30), (3, 20), (4, 15), (6, 10), (10, 8)])
def test_passages_of_short_lines_go_whole(frame, lines, words):
    """One shared passage between differing short lines, twelve times each shape: no line of it stays twice."""
    rows = []
    for n in range(12):
        shared = [passage(f"p{n}l{k}w", words) for k in range(lines)]
        for d in range(2):
            rows.append((2 * n + d, "\n".join([f"before {n} {d}", *shared, f"after {n} {d}"]), "", 0, 0))
    got = {r.doc_id: r.text for r in line_dedup.clean(frame(rows, DOC)).collect()}
    assert got == {i: t if i % 2 == 0 else f"before {i // 2} 1\nafter {i // 2} 1" for i, t, *_ in rows}


def slow_repeats(texts, least):
    """Every run of lines with enough words that stands at an earlier place goes; all runs are tried."""
    seen, gone = {}, defaultdict(set)
    for d, text in sorted(texts.items()):
        lines = text.split("\n")
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                run = tuple(lines[a:b])
                if lines[a].split() and lines[b - 1].split() and sum(len(x.split()) for x in run) >= least:
                    if seen.setdefault(run, (d, a)) != (d, a):
                        gone[d].update(range(a, b))
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in texts.items()}


def test_whole_repeats_equal_all_runs(frame):
    random = np.random.default_rng(11)
    pool = ["a b", "c d e", "f", "", "g h i j"]
    texts = {d: "\n".join(random.choice(pool, random.integers(1, 14))) for d in range(60)}
    docs = frame([(d, t, "", 0, 0) for d, t in texts.items()], DOC)
    got = {r.row.doc_id: r.text for r in line_dedup.without_repeats(docs, 7, whole=True).collect()}
    assert got == slow_repeats(texts, 7)


def test_line_chunks_of_long_and_repeated_documents(frame):
    long = "\n".join(f"line {i % 7} of a long text" for i in range(20_000))
    docs = frame([(1, long, "", 0, 0), (1, long, "", 1, 0), (2, "\n".join(["same"] * 500), "", 0, 0)], DOC)
    assert line_dedup.clean(docs).count() == 3
    assert line_dedup.clean(docs.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aB'st.,! \t\n\x1c\xa0éİΣß’“日́³12_<|endoftext|>", max_size=40), max_size=6))
def test_remembered_chunks_have_the_ids_of_whole_texts(texts):
    full = Tokenizer.from_file(WORD_FILE)
    got = [np.frombuffer(p, "<u4").tolist() for p in tokens.encoder(WORD_FILE).encode(texts)]
    assert got == [full.encode(t, add_special_tokens=False).ids for t in texts]


def test_memory_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    monkeypatch.setattr(tokens, "TEXTS_AT_ONCE", 2)
    texts = [f"one two{i} three, don't {i}" for i in range(20)] * 2
    full = Tokenizer.from_file(WORD_FILE)
    got = tokens.Encoder(WORD_FILE).encode(texts)
    assert [np.frombuffer(p, "<u4").tolist() for p in got] == [full.encode(t, add_special_tokens=False).ids for t in texts]


def check_packing(rows, texts, capacity):
    full, places, left = Tokenizer.from_file(WORD_FILE), defaultdict(list), defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
        left[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    want = defaultdict(list)
    for doc_id, text in texts:
        ids = np.array([*full.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            want[doc_id].append((k, start, len(own), zlib.crc32(own.tobytes())))
    assert {d: sorted(v) for d, v in left.items()} == {d: sorted(v) for d, v in want.items()}
    return len(places), -(-sum(r.length for r in rows) // capacity)


def test_packing_query_is_an_exact_and_tight_cover(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    bins, least = check_packing(queries.op6_packing(spark, SMALL).collect(), texts, 2048)
    assert bins <= least + 1


def test_packing_edges(frame):
    texts = [(1, None), (2, ""), (3, "word " * 5000), (4, "a b c"), (4, "a b c"), (None, "x"), (5, "y " * 15)]
    docs = frame([(i, t, "s", 0, 0) for i, t in texts], DOC)
    rows = packing.pack(docs, capacity=16, with_ids=True).collect()
    bins, least = check_packing(rows, texts, 16)
    assert bins <= least + 1
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_over_several_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 64)
    random = np.random.default_rng(3)
    lengths = random.integers(1, 60, 700).tolist()
    placed = packing.assign(spark.createDataFrame(list(enumerate(lengths)), "uid long, length int"), 100).collect()
    assert sorted(r.uid for r in placed) == list(range(700))
    fill = defaultdict(int)
    for r in placed:
        fill[r.sequence_id] += lengths[r.uid]
    assert max(fill.values()) <= 100
    assert len(fill) <= 1.02 * sum(lengths) / 100 + 1


def test_crossover_and_mutation_keep_every_piece_once():
    random = packing.Random(5)
    lengths = [random.randrange(1, 60) for _ in range(120)]
    a = packing._place(lengths, [], list(range(120)), 100)
    b = packing._place(lengths, [[i] for i in range(30)], list(range(30, 120)), 100)
    for genome in (packing._cross(lengths, a, b, 100, random), packing._mutate(lengths, a, 100, random)):
        assert sorted(i for own in genome for i in own) == list(range(120))
        assert max(sum(lengths[i] for i in own) for own in genome) <= 100


def test_evolution_beats_best_fit():
    """Pieces that best-fit decreasing packs into one bin more than needed."""
    lengths = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6, 10, 10] * 4
    greedy = packing._place(lengths, [], list(range(len(lengths))), 100)
    best = packing.evolve(lengths, [], 100, 1)
    assert len(best) <= len(greedy)


def triplets(seed, n=20):
    """Pieces that fill n bins of 1,000 in threes; best-fit does not find them."""
    random = packing.Random(seed)
    pairs = ((random.randrange(380, 490), random.randrange(250, 305)) for _ in range(n))
    return [x for a, b in pairs for x in (a, b, 1000 - a - b)]


def test_evolution_needs_fewer_bins_than_best_fit_in_the_whole_operator(spark):
    lengths = triplets(0)
    greedy = packing._place(lengths, [], list(range(len(lengths))), 1000)
    given = spark.createDataFrame(list(enumerate(lengths)), "uid long, length int")
    evolved = packing.assign(given, 1000).select("sequence_id").distinct().count()
    assert 20 <= evolved < len(greedy)


def test_generations_need_fewer_bins_than_the_first_population(monkeypatch):
    evolved = [len(packing.evolve(triplets(seed), [], 1000, seed)) for seed in range(8)]
    monkeypatch.setattr(packing, "GENERATIONS", 0)
    monkeypatch.setattr(packing, "PLACEMENTS", 0)
    first = [len(packing.evolve(triplets(seed), [], 1000, seed)) for seed in range(8)]
    assert all(e <= f for e, f in zip(evolved, first, strict=True))
    assert sum(evolved) < sum(first)


def test_groups_at_the_lower_bound_do_not_evolve(spark, monkeypatch):
    epochs = []
    real = packing._epoch
    monkeypatch.setattr(packing, "_epoch", lambda capacity, epoch: epochs.append(epoch) or real(capacity, epoch))
    halves = spark.range(40).select(F.col("id").alias("uid"), F.lit(500).alias("length"))
    assert packing.assign(halves, 1000).select("sequence_id").distinct().count() == 20
    assert epochs == [None]


TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", ""]), st.text(alphabet="a <|\\>turnsaysdone\n é日😀", max_size=30)), max_size=6)


@settings(max_examples=120, deadline=None)
@given(TURNS)
def test_chat_round_trip_and_mask(turns):
    one = chat.format_one(turns, public_tokenizers.path(chat.TOKENIZER))
    assert chat.parse(one["formatted"]) == turns
    said = "".join(text for role, text in turns if role == "assistant")
    assert chat.masked_text(one["formatted"], one["offsets"], one["mask"]) == said


def test_chat_query_matches_sql(spark):
    df = queries.op5_chat_format(spark, SMALL)
    assert differences(df, connect(SMALL), queries.ORACLE_SQL["op5_chat_format"]) == []


def test_chat_edges(frame):
    rows = [(1, 0, "user", None, "x"), (1, 1, "assistant", "", "x"), (2, None, None, "q", "x"), (None, 0, "assistant", "<|done|>" * 3, "x")]
    rows += [(3, 1, "assistant", "b", "x"), (3, 1, "assistant", "b", "x"), (3, 0, "user", "long " * 40_000, "x")]
    given_rows = frame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(given_rows)).collect()}
    assert {c: (r.n_turns, r.loss_chars) for c, r in got.items()} == {1: (2, 0), 2: (1, 0), None: (1, 24), 3: (3, 2)}
    assert chat.format_conversations(given_rows.limit(0)).count() == 0


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body class='has-sidebar'>"
    "<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home<li>More</ul></nav><!-- note --><div class='ad-box'>Buy <b>now</div>"
    "<div class='cookie-notice'>We use cookies</div>{}<aside>Side</aside><form><p>Search<input></form>"
    "<section id='comments'><article><p>Nice!</p></article></section><footer>&copy; 2024</footer></body></html>"
)


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<article><header><h1>Head &amp; more</h1><p>by me</p></header><p>One<br>two\n three<p>Four &lt;b&gt; &#233;</article>", "Head & more\n\nOne two three\n\nFour <b> é"),
        ("<main><p>In main</p><div class='share'>Share</div></main>", "In main"),
        ("<div><p>No article</p>tail</div>", "No article\n\ntail"),
        ("<article><p><b>bold.<br><p>next &am", "bold.\n\nnext &am"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\n\nb\n\nc d"),
        ("<article></article>", ""),
    ],
)
def test_main_text_of_one_page(body, want):
    page = PAGE.format(body)
    if body.endswith("&am</article>"):
        page = page[: page.index("&am") + 3]
    assert extraction.main_texts([page]) == [want]


def test_repetition_over_a_host_removes_what_has_no_role():
    pages = [f"<body><div>Welcome to our shared site today</div><p>own words number {i} of page {i}</p><div>All rights stay with us</div>" for i in range(4)]
    assert extraction.main_texts(pages) == [f"own words number {i} of page {i}" for i in range(4)]


def test_article_copies_on_a_host_stay():
    page = "<body><article><p>the very same article text on two pages</p></article>"
    assert extraction.main_texts([page, page]) == ["the very same article text on two pages"] * 2


def test_repetition_decides_beside_articles_and_never_inside():
    notice = "This notice stands on every page of the site and says nothing new"
    page = "<body><article><p>teaser {0}</p></article><div>Main words {0} of the page {0}</div><div>{1}</div><article><p>own {0} text</p><p>{1}</p></article>"
    pages = [page.format(f"n{i}", notice) for i in range(5)]
    want = [f"teaser n{i}\n\nMain words n{i} of the page n{i}\n\nown n{i} text\n\n{notice}" for i in range(5)]
    assert extraction.main_texts(pages) == want


def test_a_sentence_that_two_articles_share_is_content():
    shared = passage("both", 12)
    pages = [f"<body><div>Welcome to our shared site today</div><article><p>{passage(f'a{i}', 20)}</p><p>{shared}</p>tail {shared}</article>" for i in range(2)]
    assert extraction.main_texts(pages) == [f"{passage(f'a{i}', 20)}\n\n{shared}\n\ntail {shared}" for i in range(2)]


@pytest.mark.parametrize("odd", ["<b>x", "</q>x", "<div>x", "<b></q>x", "<p><b>x", "<li>x</i>", "<p>x<i>"])
def test_odd_markup_takes_linear_time(odd):
    started = time.perf_counter()
    found = extraction.blocks_of("<article>" + odd * 20_000)
    assert time.perf_counter() - started < 2
    assert sum(b.text.count("x") for b in found) == 20_000


def test_copies_and_near_copies_without_article_stay():
    text = lambda name: f"<p>{passage(name, 40)}</p><p>{passage(name + 'x', 40)}</p>"
    pages = [f"<body>{text('a')}", f"<body>{text('a')}", f"<body>{text('a')}<p>one more</p>", f"<body>{text('b')}", None]
    own = lambda name: f"{passage(name, 40)}\n\n{passage(name + 'x', 40)}"
    assert extraction.main_texts(pages) == [own("a"), own("a"), own("a") + "\n\none more", own("b"), ""]


def test_phrases_of_few_pages_stay_and_long_runs_are_cut():
    shared = passage("site", 12)
    pages = [f"<body><p>{passage(f'p{i}', 20)} {'as a matter of fact' if i < 6 else ''} {shared if i > 5 else ''}</p>" for i in range(60)]
    want = [passage(f"p{i}", 20) + (" as a matter of fact" if i < 6 else "") for i in range(60)]
    assert extraction.main_texts(pages) == want


def test_hosts_stay_whole_whatever_the_partitions(spark):
    own = lambda h, i: passage(f"h{h}p{i}w", 8)
    rows = [(10 * h + i, f"http://h{h}/{i}", f"<body><div>Welcome to our shared site today</div><p>{own(h, i)}</p>") for h in range(20) for i in range(2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for n in (1, 40):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = {r.page_id: r.text for r in extraction.extract(pages).collect()}
            assert got == {10 * h + i: own(h, i) for h in range(20) for i in range(2)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), max_size=5))
def test_suffix_array_marks_runs_of_other_pages(streams):
    n, where = extraction.RUN_WORDS, defaultdict(set)
    for p, s in enumerate(streams):
        for i in range(len(s) - n + 1):
            where[tuple(s[i : i + n])].add(p)
    want = [[any(len(where[tuple(s[i : i + n])]) > 1 for i in range(max(0, j - n + 1), min(j, len(s) - n) + 1)) for j in range(len(s))] for s in streams]
    assert [c.tolist() for c in extraction.repeated_words(streams)] == want


def test_page_query_and_edges(spark, frame):
    assert queries.op10_main_text(spark, SMALL).count() == spark.read.parquet(f"{SMALL}/pages.parquet").count()
    rows = [(1, "http://a.b/1", None, 0), (2, None, "<p>x", 0), (2, None, "<p>x", 0), (None, "odd", "", 0), (3, "HTTP://A.b/2", "<article>" + "<p>long</p>" * 30_000, 0)]
    pages = frame(rows, "page_id long, url string, html string, host int")
    got = sorted((r.page_id or 0, r.n_chars) for r in extraction.extract(pages).collect())
    assert got == [(0, 0), (1, 0), (2, 1), (2, 1), (3, 6 * 30_000 - 2)]
    assert extraction.extract(pages.limit(0)).count() == 0


def _site(seed):
    """Pages of three hosts: own words, phrases, notices and runs that some share, copies and near copies, articles or none."""
    rng = random.Random(seed)
    rows = []
    for h, n in enumerate((70, 25, 2)):
        rare = [passage(f"h{h}rare{k}w", 14) for k in range(n // 5 + 1)]
        for i in range(n):
            own = [passage(f"h{h}p{i}b{b}w", rng.choice((3, 15, 40))) for b in range(rng.randint(1, 3))]
            parts = [f"<p>{o}</p>" for o in own]
            parts += [f"<p>{rng.choice(rare)} {own[0]}</p>"] * (rng.random() < 0.5)
            parts += ["<div>Welcome to our shared site today</div>"] * (rng.random() < 0.6)
            parts += [f"<div>{passage('notice', 30)}</div>"] * (rng.random() < 0.5)
            rng.shuffle(parts)
            if rng.random() < 0.4:
                parts = [f"<article>{parts[0]}</article>", *parts[1:]]
            page = "<body>" + "".join(parts)
            copies = [page] * rng.choice((1, 1, 1, 2))
            copies += [page + f"<p>more {k} of {i}</p>" for k in range(rng.choice((0, 0, 1, 3)))]
            rows += [(f"http://h{h}/", c) for c in copies]
    rng.shuffle(rows)
    return [(k, url, page) for k, (url, page) in enumerate(rows)]


@pytest.mark.parametrize("size", [1, 3000, 2_000_000])
def test_texts_do_not_depend_on_the_size_of_suffix_arrays(frame, monkeypatch, size):
    monkeypatch.setattr(extraction, "HOST_BYTES", size)
    rows, want = _site(3), {}
    for host in {url for _, url, _ in rows}:
        own = [(k, page) for k, url, page in rows if url == host]
        want |= dict(zip([k for k, _ in own], extraction.main_texts([page for _, page in own])))
    whole = {k: "\n\n".join(b.text for b in extraction.blocks_of(page) if not b.dropped) for k, _, page in rows}
    assert sum(want[k] != whole[k] for k in want) > 30
    got = {r.page_id: r.text for r in extraction.extract(frame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_near_copies_are_linked_as_in_memory(frame):
    rng = random.Random(5)
    texts = [passage(f"t{i}w", 40).split() for i in range(12)]
    contents = []
    for words in texts:
        for _ in range(6):
            words = [w if rng.random() > 0.03 else f"x{rng.randint(0, 99)}" for w in words]
            contents.append([(list(words), False)])
    want = extraction._near_copies(contents, list(range(len(contents))))
    assert len(set(want)) < len(contents) - 12 and len(set(want)) > 12
    shingles = [sorted({hash(tuple(w[i : i + 4])) for i in range(len(w) - 3)}) for [(w, _)] in contents]
    rows = [(f"{k:03}", own) for k, own in enumerate(shingles)]
    roots = {r.node: r.root for r in extraction._near_roots(frame(rows, "content string, shingles array<long>")).collect()}
    assert [int(roots.get(f"{k:03}", f"{k:03}")) for k in range(len(contents))] == want


def test_hosts_are_dealt_into_bounded_blocks(frame, monkeypatch):
    monkeypatch.setattr(extraction, "HOST_BYTES", 2000)
    rows = [(i, "http://hot/x", f"<body><div>Welcome to our shared site today</div><p>own {i} words {i} page {i}</p>") for i in range(200)]
    got = {r.page_id: r.text for r in extraction.extract(frame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"own {i} words {i} page {i}" for i in range(200)}


def test_secrets_planted_in_documents(spark, frame):
    keys = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(60)]
    rows = [(i, f"some words password={k[:18]} and token = \"{k[:40]}\" here", "", 0, 0) for i, k in enumerate(keys)]
    rows += [(100 + i, f"call +1 (555) 010-{1000 + i} card 4{i:015d} mail a{i}@b.example commit {k[:40]} end", "", 0, 0) for i, k in enumerate(keys)]
    rows += [(400 + i, f"id AKIA{k[:16].upper()} x", "", 0, 0) for i, k in enumerate(keys[:20])]
    rows += [(301, None, "", 0, 0), (302, "", "", 0, 0), (303, "password=changeme123", "", 0, 0), (304, "w " * 200_000, "", 0, 0)]
    got = secret_scan.scan(frame(rows, DOC)).collect()
    secret = defaultdict(int)
    for r in got:
        secret[r.doc_id] += r.is_secret
    assert [secret[i] for i in range(60)] == [2] * 60
    assert all(not secret[100 + i] for i in range(60))
    assert all(secret[400 + i] == 1 for i in range(20)) and not secret[303]
    first = next(r for r in got if r.doc_id == 0 and r.rule == "named")
    assert hashlib.sha256(rows[0][1][first.first : first.after].encode()).hexdigest() == first.value_sha256


def test_secrets_from_given_labels_and_without_rows(spark, frame):
    docs = frame([(i, f"token={'ab12cd34' if i % 2 else 'zz99zz99'}ef{i}", "", 0, 0) for i in range(40)], DOC)
    found = secret_scan.scan(docs).collect()
    labels = spark.createDataFrame([(r.doc_id, r.first, r.after, r.doc_id % 2) for r in found], "doc_id long, first int, after int, label int")
    assert secret_scan.scan(docs, labels).count() == len(found)
    assert secret_scan.scan(docs.limit(0)).count() == 0


def test_issued_formats_stay_where_no_label_covers_them(frame):
    rows = [(i, f"token={i:04d}ab{i * 7919 % 10007:05d}cd99 commit {i:016d}f", "", 0, 0) for i in range(30)]
    docs = frame([*rows, (99, "id AKIA" + "Z7Q4" * 4 + " x", "", 0, 0)], DOC)
    found = secret_scan.candidates(docs, frozenset())
    labels = secret_scan.rule_labels(found).filter("doc_id <> 99").select("doc_id", "first", "after", "label")
    got = {r.doc_id: r.is_secret for r in secret_scan.scan(docs, labels).collect() if r.rule == "issued"}
    assert got == {99: True}


def test_labels_decide_and_hold_on_documents_not_learned_from(spark, frame):
    """Labels that no built-in rule gives: numbers and random values are secrets after 'vault auth', not after 'build id'."""
    random = packing.Random(8)
    value = lambda: random.choice([f"{random.randrange(10**17):017d}", f"{random.getrandbits(80):020x}"])
    secret = [random.random() < 0.5 for _ in range(300)]
    docs = frame([(i, f"note {'vault auth' if s else 'build id'} {value()} done", "", 0, 0) for i, s in enumerate(secret)], DOC)
    found = [r for r in secret_scan.candidates(docs, frozenset()).collect() if r.rule == "bare"]
    assert len(found) == 300
    rows = [(r.doc_id, r.first, r.after, int(secret[r.doc_id])) for r in found if not r.held_out]
    labels = spark.createDataFrame(rows, "doc_id long, first int, after int, label int")
    held = [(r.is_secret, secret[r.doc_id]) for r in secret_scan.scan(docs, labels).collect() if r.held_out]
    hit = sum(got and want for got, want in held)
    assert len(held) > 30 and {want for _, want in held} == {True, False}
    assert hit >= 0.95 * sum(want for _, want in held)
    assert hit >= 0.95 * sum(got for got, _ in held)


def test_secret_query(spark):
    rows = queries.op3_secret_scan(spark, SMALL).collect()
    assert all(0 <= r.score <= 1 and r.first < r.after for r in rows)


def slow_cover(value, known):
    """Share of the characters inside known words, the longest word first at each place."""
    low, at, hit = value.lower(), 0, 0
    while at < len(low):
        size = next((k for k in range(12, 3, -1) if low[at : at + k] in known and at + k <= len(low)), 0)
        hit, at = hit + size, at + max(1, size)
    return hit / len(low)


@pytest.mark.parametrize("at_once", [4096, 5])
def test_dictionary_cover_equals_brute_force(spark, frame, monkeypatch, at_once):
    """Overlapping and nested words, capitals, accents, values over several rows, words in too few documents."""
    monkeypatch.setattr(secret_scan, "PARTS_AT_ONCE", at_once)
    known = {"river", "riverbank", "bank", "banker", "stone", "écoles", "unusually", "abcdefghijkl"}
    values = ["riverbanker9", "bankriverstone1x", "xx7xx8xx9", "RiverBank77Stone", "mesécoles2024", "abcdefghijklm1", "riverriverbank-5", "rare9rareword"]
    rows = [(i, f"token={v} " + ("rareword" if i < 1 else ""), "", 0, 0) for i, v in enumerate(values)]
    rows += [(100 + i, " ".join(sorted(known)) + f" Unusually{i}", "", 0, 0) for i in range(3)]
    docs = frame(rows, DOC)
    at = secret_scan.FEATURES.index("dictionary_share")
    for found in (secret_scan.candidates(docs), secret_scan.candidates(docs, frozenset(known))):
        got = {r.doc_id: r.x[at] for r in found.collect() if r.rule == "named"}
        assert got == pytest.approx({i: slow_cover(v, known) for i, v in enumerate(values)})


def test_words_are_counted_over_all_documents(frame):
    rows = [(i, f"common word{'' if i % 1500 else ' seldom'} x{i}", "", 0, 0) for i in range(6000)]
    docs = frame([*rows, (9000, "common " * 50_000, "", 0, 0), (9001, None, "", 0, 0)], DOC)
    assert secret_scan.dictionary(docs).count() == 2  # common and word; seldom stands in 4 of 6,002


@pytest.mark.parametrize("text", ["a" * 1_000_000, "token" * 200_000, "eyJ" * 300_000, "a-_" * 300_000])
def test_long_runs_take_linear_time(text):
    started = time.perf_counter()
    assert list(secret_scan.candidates_of(text)) == []
    assert time.perf_counter() - started < 3


def test_a_long_value_is_one_candidate(frame):
    value = "".join(f"river{i % 10}" for i in range(50_000))
    found = secret_scan.candidates(frame([(1, f"password={value}", "", 0, 0)], DOC), frozenset({"river"})).collect()
    assert [(r.first, r.after) for r in found] == [(9, 9 + len(value))]
    assert found[0].x[secret_scan.FEATURES.index("dictionary_share")] == pytest.approx(5 / 6)
