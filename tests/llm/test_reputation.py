"""URL rules and host reputation: SQL, Beta bounds by integration, planted hosts and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from faresift.llm import queries, reputation

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
PAGE = "page_id long, url string, html string, host string, bad int, rules string"
RULES = reputation.rule_list(queries.URL_RULES)


@pytest.mark.parametrize("folder_", [SMALL, MEDIUM])
def test_query_matches_sql(spark, folder_):
    df = queries.op12_url_filter(spark, folder_)
    assert differences(df, connect(folder_), queries.ORACLE_SQL["op12_url_filter"]) == []


def test_query_plan_has_no_python(spark):
    plan = queries.op12_url_filter(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def judged(spark, urls, outcomes=(), rules=RULES, **more):
    pages = spark.createDataFrame([(i, u, "<p>", "h", i, "r") for i, u in enumerate(urls)], PAGE).repartition(3)
    known = spark.createDataFrame(list(outcomes), "page_id long, bad boolean")
    return {r.page_id: r for r in reputation.judge(pages, known, rules, **more).collect()}


def test_rules_and_urls(spark):
    expected = {
        "http://a.org/x": ("a.org", "/x", "org/", "allow"),
        "HTTPS://ORG/es/": ("org", "/es/", "org/", "allow"),
        "http://WWW.Example.ORG/es/1?q#f": ("www.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/17": ("example.org", "/en/17", "example.org/en/1", "block"),
        "http://example.org/en/2#x/y": ("example.org", "/en/2", "org/", "allow"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://b.com/de/": ("b.com", "/de/", "com/de/", "block"),
        "http://b.com/fr": ("b.com", "/fr", None, "allow"),
        "http://b.org?x=/": ("b.org", "", None, "allow"),
        "http://b.org:80/": ("b.org:80", "/", None, "allow"),
        "mailto:x": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "x://": ("", "", None, "allow"),
        "http://a.org/http://b.com/de/": ("a.org", "/http://b.com/de/", "org/", "allow"),
        "http://é.ORG/" + "p/" * 50_000: ("é.org", "/" + "p/" * 50_000, "org/", "allow"),
    }
    got = judged(spark, list(expected))
    assert [(r.host, r.path, r.rule, r.verdict) for _, r in sorted(got.items())] == list(expected.values())


def test_rules_of_one_text_and_no_rules(spark):
    both = [("allow", "a.org", "/x"), ("block", "a.org", "/x"), ("allow", "org", "/")]
    assert judged(spark, ["http://a.org/x"], rules=both)[0].verdict == "block"
    assert judged(spark, ["http://a.org/x"], rules=[])[0].rule is None


def test_domains(spark):
    cases = {
        "a.b.example.com": ("example.com", "com"),
        "u@www.x.co.uk:8080": ("x.co.uk", "co.uk"),
        "co.uk": ("co.uk", "co.uk"),
        "localhost.": ("localhost", "localhost"),
        "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"),
        "[::1]": ("[::1]", "[::1]"),
        "": ("", ""),
    }
    df = spark.createDataFrame([(h,) for h in cases], "host string")
    domain, suffix = reputation.domains_of(F.col("host"))
    assert {r[0]: (r[1], r[2]) for r in df.select("host", domain, suffix).collect()} == cases


def test_bad_hosts_are_blocked_and_others_kept(spark):
    """One spam farm among sound hosts of the same domain; a host without outcomes under a bad domain goes as well."""
    urls, outcomes = [], []
    add = lambda host, n, bad: [(outcomes.append((len(urls), i < bad)), urls.append(f"http://{host}/{i}")) for i in range(n)]
    add("spam.mixed.net", 40, 38)
    for k in range(12):
        add(f"h{k}.mixed.net", 30, k % 3)
        add(f"f{k}.farm.info", 30, 29)
    urls += ["http://new.farm.info/", "http://new.mixed.net/", "http://few.mixed.net/1"]
    outcomes.append((len(urls) - 1, True))
    got = judged(spark, urls, outcomes)
    blocked = {r.host for r in got.values() if r.verdict == "block"}
    assert blocked == {"spam.mixed.net", "new.farm.info", *[f"f{k}.farm.info" for k in range(12)]}
    few = next(r for r in got.values() if r.host == "few.mixed.net")
    assert (few.n_labelled, few.n_bad) == (1, 1) and few.bad_bound < 0.5


def test_outcomes_from_labelled_lines(spark):
    line = lambda k: f"a line of its own that is long enough {k}"
    docs = [(1, f"{line(1)}\n{line(2)}\n{line(1)}"), (2, f"{line(3)}\nshort"), (3, f"{line(3)}\n{line(4)}"), (4, None), (5, ""), (1, line(5))]
    docs = spark.createDataFrame([(*d, "en", "x") for d in docs], "doc_id long, text string, html string, bad string")
    labels = [(1, 0, None), (1, 1, 0), (2, 1, 0), (3, 1, 1), (4, 0, 0), (9, 0, 0), (None, 0, 0), (5, None, None)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    shown = [[1, 2], [3], [4], [1, 4, 5], [], [7]]
    pages = [(k, "u", "<p>" + "</p><p> ".join(map(line, own)) + " </p><i>short</i>", "h", 0, "r") for k, own in enumerate(shown)]
    pages = spark.createDataFrame([*pages, (6, "u", None, "h", 0, "r"), (None, "u", f"<p>{line(1)}</p>", "h", 0, "r")], PAGE)
    got = {r.page_id: r.bad for r in reputation.labelled_pages(pages, docs, labels).collect()}
    # Line 3 stands in a good and a bad document and says nothing.
    assert got == {0: True, 2: True, 3: True}


def test_repeated_rows_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", "", "", 0, "")] * 3 + [(None, "http://a.net/", "", "", 0, "")], PAGE)
    known = spark.createDataFrame([(1, True)], "page_id long, bad boolean")
    got = reputation.judge(pages, known, RULES).collect()
    assert [(r.n_labelled, r.n_bad) for r in got] == [(3, 3)] * 4
    assert reputation.judge(pages.limit(0), known, RULES).collect() == []
    assert [r.verdict for r in reputation.judge(pages, known.limit(0), RULES).collect()] == ["allow"] * 4


@pytest.mark.parametrize(("a", "b"), [(1.0, 1.0), (2.5, 40.0), (30.0, 5.0), (400.0, 600.0)])
def test_bound_is_the_fifth_percentile(spark, a, b):
    got = spark.range(1).select(reputation.lower_bound(F.lit(a), F.lit(b))).first()[0]
    x = (np.arange(200_000) + 0.5) / 200_000
    density = np.exp((a - 1) * np.log(x) + (b - 1) * np.log1p(-x) - max((a - 1) * np.log(x) + (b - 1) * np.log1p(-x)))
    below = np.cumsum(density) / density.sum()
    assert abs(got - x[np.searchsorted(below, 0.05)]) < 0.012


def test_strength_is_found_again(spark):
    random = np.random.default_rng(3)
    rows = [(int(n), int(random.binomial(n, random.beta(4, 16)))) for n in random.integers(20, 200, 3000)]
    found = reputation.strength(spark.createDataFrame(rows, "n long, bad long"))
    assert 17 < found < 23
    same = spark.createDataFrame([(50, 10)] * 100, "n long, bad long")
    assert reputation.strength(same) == reputation.STRENGTHS[1]
    assert reputation.strength(same.limit(1)) == reputation.NO_STRENGTH
    assert reputation.strength(spark.createDataFrame([(50, 0)] * 9, "n long, bad long")) == reputation.NO_STRENGTH
