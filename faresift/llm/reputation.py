"""URL filter by empirical-Bayes host reputation, with rules that overrule it. DataFrame functions only.

Pages get outcomes (bad or not) from labelled documents whose lines they show. The bad share of a host is
beta-binomial: its prior is centred on the posterior mean of the registered domain, that one's on the
suffix's, and that one's on the share of all outcomes. How strongly each level is pulled to the one above
is estimated from how much the shares of its members differ beyond chance. A host is blocked where
the lower posterior bound of its bad share reaches a limit, so a host without outcomes is judged by what is above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faresift.llm.common import LOWER, UPPER, materialise

# Public suffixes of two labels that the last-label rule would miss; a parameter of ``judge``.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "co.kr", "co.in", "co.za", "com.br", "com.mx", "com.ar", "com.tr", "com.cn", "com.tw", "com.hk", "com.sg")
# Least characters of a line that tells where a page's text comes from.
LINE_CHARS = 20
# The bound lies below the bad share with 95 % posterior probability; a host is blocked from this bound on.
BOUND_Z = 1.6448536269514722
BLOCK_SHARE = 0.5
# Prior strengths, in outcomes: at least, at most, and where the members of a level say nothing about it.
STRENGTHS = (1.0, 1000.0)
NO_STRENGTH = 10.0


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): what follows the first ``://``; both empty without one."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def domains_of(host: Column, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host without its user and port; an address is both itself."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@|:[0-9]*$", ""), r"\.$", "")
    last = lambda n: F.substring_index(name, ".", -n)
    address, two = name.rlike(r"^[0-9.]+$|^\["), last(2).isin(*two_label)
    domain = F.when(address, name).when(two, last(3)).otherwise(last(2))
    return domain, F.when(address, name).when(two, last(2)).otherwise(last(1))


def labelled_pages(pages: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, bad): outcomes of pages that show lines of labelled documents.

    A document is bad if any of its labels has quality 0 or toxic 1; rows of labels with neither known say nothing.
    A line of at least LINE_CHARS characters speaks for its documents if all labelled ones that hold it agree. A page
    is bad if half or more of its speaking lines are. Lines are counted per document and per page, however often they
    stand there, and are met by their 128-bit digests. Rows without page_id or doc_id have no part.
    """
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.filter("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
    known = known.groupBy("doc_id").agg(F.max(bad.cast("int")).alias("bad"))

    def lines(texts: Column) -> Column:
        long = F.filter(F.transform(texts, lambda line: F.trim(line)), lambda line: F.length(line) >= LINE_CHARS)
        return F.array_distinct(F.transform(long, lambda line: F.unhex(F.md5(line)))).alias("lines")

    # Texts stay where they are read; what moves are digests.
    own = docs.select("doc_id", lines(F.split("text", "\n"))).join(known, "doc_id")
    said = own.select(F.explode("lines").alias("line"), "bad").groupBy("line").agg(F.min("bad").alias("bad"), F.max("bad").alias("most"))
    shown = pages.filter("page_id IS NOT NULL").select("page_id", lines(F.regexp_extract_all("html", F.lit(">([^<>]+)<"), F.lit(1))))
    met = shown.select("page_id", F.explode("lines").alias("line")).join(said.filter("bad = most").drop("most"), "line")
    # Rows that repeat a page_id are one page here.
    return met.distinct().groupBy("page_id").agg((2 * F.sum("bad") >= F.count(F.lit(1))).alias("bad"))


def strength(counts: DataFrame) -> float:
    """Prior strength of a level from (n, bad) of its members, by moments: 1 / rho - 1 for the correlation rho of
    outcomes inside a member, the excess of the spread of their shares over what chance alone would give."""
    rows = counts.filter("n > 0").select(F.col("n").cast("double").alias("n"), F.col("bad").cast("double").alias("bad"))
    x, n = F.col("bad"), F.col("n")
    sums = rows.agg(F.count(n).alias("k"), F.sum(n).alias("n"), F.sum(x).alias("x"), F.sum(x * x / n).alias("xx"), F.sum(n * n).alias("nn"))
    k, total, bad, squares, sizes = sums.first()
    if k < 2:
        return NO_STRENGTH
    share = bad / total
    chance, spread = (k - 1) / total, squares / total - share * share
    scale = share * (1 - share) * (1 - sizes / total**2 - chance)
    if scale <= 0:
        return NO_STRENGTH
    rho = (spread - share * (1 - share) * chance) / scale
    least, most = STRENGTHS
    return most if rho <= 1 / (most + 1) else max(least, 1 / rho - 1)


def lower_bound(a: Column, b: Column, z: float = BOUND_Z) -> Column:
    """Lower bound of a Beta(a, b) share: the closed approximation by a normal deviate where both are 1 or more
    (good to a hundredth), else mean less z standard deviations."""
    flat = F.greatest(F.lit(0.0), a / (a + b) - z * F.sqrt(a * b / (a + b + 1)) / (a + b))
    # Whatever branch is taken, no division by zero is evaluated.
    p, q = 2 * F.greatest(a, F.lit(1.0)) - 1, 2 * F.greatest(b, F.lit(1.0)) - 1
    h, curve = 2 / (1 / p + 1 / q), (z * z - 3) / 6
    w = z * F.sqrt(h + curve) / h - (1 / q - 1 / p) * (curve + 5 / 6 - 2 / (3 * h))
    return F.when((a >= 1) & (b >= 1), a / (a + b * F.exp(2 * w))).otherwise(flat)


def _host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules of a host and of those it is below, longest first; of the same length, blocks first."""
    # A host with n dots is below n others.
    names = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(names)), lambda i: F.array_join(F.slice(names, i, F.size(names)), "."))
    found = hosts.select("host", F.explode(above).alias("rule_host")).join(rules, "rule_host")
    rule = F.concat("rule_host", "rule_path")
    order = F.struct(
        (-F.length(rule)).alias("length"),
        F.when(F.col("rule_verdict") == "block", 0).otherwise(1).alias("allows"),
        F.col("rule_path").alias("path"),
        rule.alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    return found.groupBy("host").agg(F.array_sort(F.collect_set(order)).alias("rules"))


def host_reputation(outcomes: DataFrame, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """(host, n_labelled, n_bad, bad_bound) of (host, n, bad) counts, one row per host."""
    domain, suffix = domains_of(F.col("host"), two_label)
    hosts = materialise(outcomes.select("host", "n", "bad", domain.alias("domain"), suffix.alias("suffix")), "host-outcomes")
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = materialise(hosts.groupBy("domain", "suffix").agg(*sums), "domain-outcomes")
    suffixes = materialise(domains.groupBy("suffix").agg(*sums), "suffix-outcomes")
    n, bad = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()

    prior, mean = (bad + 1) / (n + 2), lambda m, s: (F.lit(s) * m + F.col("bad")) / (F.lit(s) + F.col("n"))
    suffixes = suffixes.select("suffix", mean(F.lit(prior), strength(suffixes)).alias("suffix_mean"))
    domains = domains.join(suffixes, "suffix").select("domain", "suffix", mean(F.col("suffix_mean"), strength(domains)).alias("domain_mean"))
    pull = F.lit(strength(hosts))
    a = pull * F.col("domain_mean") + F.col("bad")
    b = pull * (1 - F.col("domain_mean")) + F.col("n") - F.col("bad")
    return hosts.join(domains, ["domain", "suffix"]).select(
        "host", F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"), lower_bound(a, b).alias("bad_bound")
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[tuple[str, str, str]] | DataFrame,
    block_share: float = BLOCK_SHARE,
    two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """page_id, host, path, rule, verdict, n_labelled, n_bad, bad_bound: one row per row of pages.

    ``outcomes`` has (page_id, bad), at most one row per page. ``rules`` has (verdict, host, path) and may be a frame
    with columns verdict, host, path: a rule fits its host and all below it where the page's path starts with its path.
    The longest rule decides, a block before an allow of the same text; where none fits, the host's
    reputation does. Null and odd urls have empty host and path and are one host. Repeated rows count and are judged
    each. The rules that fit one host lie in one row; joins of a hot host are left to Spark's skew handling. Without any
    outcome nothing is blocked but by rules. Other columns are not read.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rows = [F.struct(*[F.lit(v).alias(c) for v, c in zip(r, ("verdict", "host", "path"), strict=True)]) for r in rules]
        listed = F.array(*rows).cast("array<struct<verdict:string,host:string,path:string>>")
        rules = spark.range(1).select(F.inline(listed))
    rules = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))

    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    outcomes = outcomes.select("page_id", F.col("bad").cast("int").alias("bad"))
    known = F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0).cast("long")).alias("bad")
    counts = materialise(urls.join(outcomes, "page_id", "left").groupBy("host").agg(*known), "host-counts")
    told = host_reputation(counts, two_label)
    told = materialise(told.join(_host_rules(counts.select("host"), rules), "host", "left"), "host-verdicts")

    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    rule = F.when(F.size("rules") > 0, F.get(fitting, F.lit(0)))
    decided = F.when(F.col("bad_bound") >= block_share, "block").otherwise("allow")
    return urls.join(told, "host").withColumn("hit", rule).select(
        "page_id",
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", decided).alias("verdict"),
        "n_labelled",
        "n_bad",
        "bad_bound",
    )


def rule_list(rules: list[tuple[str, str]]) -> list[tuple[str, str, str]]:
    """(verdict, host, path) of rules written like ``("block", "example.org/es/")``."""
    return [(verdict, text.partition("/")[0], "".join(text.partition("/")[1:])) for verdict, text in rules]
