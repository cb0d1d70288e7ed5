"""Queries of the operators over whole tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faresift.llm import (
    chat,
    decontaminate,
    exact_dedup,
    extraction,
    language,
    line_dedup,
    merkle,
    negatives,
    packing,
    quality,
    reputation,
    secret_scan,
    simhash,
)
from faresift.llm.common import LOWER, UPPER, held_out, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations of the table and one of control strings only, as id -7."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = F.lit("</s>[INST] ok [/INST]").alias("text")
    turns = F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role")
    extra = spark.range(1).select(turns).select(F.lit(-7).cast("long").alias("conv_id"), "turn", "role", tricky)
    return chat.digests(chat.format_conversations(given.unionByName(extra)))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "text", "n_lines", "removed_lines")


def op7_whole_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7_line_dedup with chunks from every line, as the pipeline has it."""
    found = line_dedup.without_repeats(table(spark, sf_dir, "documents"), whole=True)
    return found.select("row.doc_id", "text", "n_lines", "removed_lines")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("byte_spans")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of documents, held against the table with the texts of some documents in lower case."""
    picked = F.col("doc_id").isNotNull() & held_out("doc_id", 5, 0)
    found = F.when(picked, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return merkle.manifest(table(spark, sf_dir, "documents"), found)


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, docs, labels = (table(spark, sf_dir, name) for name in ("pages", "documents", "labels"))
    outcomes = reputation.labelled_pages(pages, docs, labels)
    judged = reputation.judge(pages, outcomes, reputation.rule_list(URL_RULES))
    return judged.withColumn("bad_bound", F.round("bad_bound", 6))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows of every hundredth id; rows of every seventh id have the next label."""
    given = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(given.withColumn("label", label), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_simhash,
        op2_exact_dedup,
        op3_secret_scan,
        op4_quality,
        op5_chat_format,
        op6_packing,
        op7_line_dedup,
        op7_whole_passages,
        op8_decontaminate,
        op9_language,
        op10_main_text,
        op11_merkle,
        op12_url_filter,
        op13_hard_negatives,
    )
}

WORDS_SQL = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


# The CRC-32 of a number's decimal text; the constant is the polynomial, bits reversed.
CRC_SQL = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))))"""


def merkle_sql(source_levels: int = 6, root_levels: int = 4) -> str:
    """Trees of up to 16 ** levels nodes, one level after the other; finished trees are carried on as they are."""
    said = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256({' || '.join(map(said, ('doc_id', 'source', 'lang', 'n_chars', text)))})"
    changed = (
        "CASE WHEN doc_id IS NOT NULL AND crc % 5 = 0 "
        "THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
    )
    levels = lambda name, n: "".join(
        f"""{name}b{k} AS MATERIALIZED (
            SELECT tree, place, total, digest,
                coalesce(string_agg(digest, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(digest, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM {name}{k} WINDOW r AS (PARTITION BY tree, place // 16 ORDER BY place)
        ), {name}{k + 1} AS MATERIALIZED (
            SELECT tree, place // 16 AS place, (any_value(total) + 15) // 16 AS total,
                CASE WHEN any_value(total) > 1 THEN sha256(string_agg(digest, '' ORDER BY place)) ELSE any_value(digest) END AS digest
            FROM {name}{k} GROUP BY tree, place // 16
        ), """
        for k in range(n)
    )
    # A node at a place of the leaves has its way through places // 16 ** k.
    way = lambda name, n, at: (
        "".join(f" JOIN {name}b{k} AS {name}w{k} ON {name}w{k}.tree = {at[0]} AND {name}w{k}.place = {at[1]} // {16**k}" for k in range(n))
    )
    steps = [f"{name}w{k}" for name, n in (("s", source_levels), ("t", root_levels)) for k in range(n)]
    folds, below = "", "found"
    for i, step in enumerate(steps):
        folds += f", CASE WHEN {step}.total > 1 THEN sha256({step}.l || {below} || {step}.r) ELSE {below} END AS fold{i}"
        below = f"fold{i}"
    proof = " || ".join(f"{s}.l || {s}.r" for s in steps)
    return f"""
        WITH c AS (
            SELECT *, {CRC_SQL} AS crc FROM documents
        ), d AS MATERIALIZED (
            SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf("text")} AS digest, {leaf(changed)} AS found FROM c
        ), p AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest, found) - 1 AS place,
                count(*) OVER (PARTITION BY tree) AS total FROM d
        ), s0 AS (
            SELECT tree, place, total, digest FROM p
        ), {levels("s", source_levels)}t0 AS MATERIALIZED (
            SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS total, digest, tree AS source_tree
            FROM s{source_levels}
        ), {levels("t", root_levels)}f AS (
            SELECT doc_id, p.digest AS leaf, t0.digest AS subroot, t{root_levels}.digest AS root, sha256({proof}) AS proof_sha256{folds}
            FROM p{way("s", source_levels, ("p.tree", "p.place"))}
            JOIN t0 ON t0.source_tree = p.tree{way("t", root_levels, ("''", "t0.place"))}
            JOIN t{root_levels} ON true
        )
        SELECT doc_id, leaf, subroot, root, proof_sha256, {below} AS folded_root, {below} = root AS verified FROM f"""


def strength_sql(name: str) -> str:
    """(s): the prior strength of a level, from (n, bad) of its members."""
    return f"""(
            SELECT CASE WHEN k < 2 OR v IS NULL OR v * (1 - sizes / (total * total) - chance) <= 0 THEN 10.0
                WHEN (spread - v * chance) / (v * (1 - sizes / (total * total) - chance)) <= 1 / 1001.0 THEN 1000.0
                ELSE greatest(1.0, 1 / ((spread - v * chance) / (v * (1 - sizes / (total * total) - chance))) - 1) END AS s
            FROM (SELECT *, (k - 1) / total AS chance, squares / total - (x / total) * (x / total) AS spread,
                    (x / total) * (1 - x / total) AS v
                FROM (SELECT count(*) AS k, sum(n::DOUBLE) AS total, sum(bad::DOUBLE) AS x,
                        sum(bad::DOUBLE * bad / n) AS squares, sum(n::DOUBLE * n) AS sizes
                    FROM {name} WHERE n > 0)))"""


URL_SQL = f"""
        WITH known AS (
            SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
            WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id
        ), dl AS (
            SELECT DISTINCT doc_id, bad, trim(unnest(string_split(text, chr(10)))) AS line FROM documents JOIN known USING (doc_id)
        ), said AS (
            SELECT line, min(bad) AS bad FROM dl WHERE length(line) >= 20 GROUP BY line HAVING min(bad) = max(bad)
        ), pl AS (
            SELECT DISTINCT page_id, trim(unnest(regexp_extract_all(html, '>([^<>]+)<', 1))) AS line FROM pages WHERE page_id IS NOT NULL
        ), o AS (
            SELECT page_id, CAST(2 * sum(bad) >= count(*) AS INT) AS bad FROM pl JOIN said USING (line) GROUP BY page_id
        ), u AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), p AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
        ), h0 AS (
            SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
                regexp_replace(regexp_replace(host, '^.*@|:[0-9]*$', '', 'g'), '\\.$', '') AS name
            FROM p LEFT JOIN o USING (page_id) GROUP BY host
        ), h1 AS (
            SELECT *, string_split(name, '.') AS labels, regexp_matches(name, '^[0-9.]+$|^\\[') AS address,
                array_to_string(labels[-2:], '.') IN {reputation.TWO_LABEL_SUFFIXES} AS two FROM h0
        ), hosts AS (
            SELECT *, CASE WHEN address THEN name ELSE array_to_string(labels[(CASE WHEN two THEN -3 ELSE -2 END):], '.') END AS domain,
                CASE WHEN address THEN name ELSE array_to_string(labels[(CASE WHEN two THEN -2 ELSE -1 END):], '.') END AS suffix
            FROM h1
        ), domains AS (
            SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL
        ), suffixes AS (
            SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL
        ), sm AS (
            SELECT suffix, (s * ((SELECT sum(bad) + 1 FROM suffixes)::DOUBLE / (SELECT sum(n) + 2 FROM suffixes)) + bad) / (s + n) AS m
            FROM suffixes, {strength_sql("suffixes")}
        ), dm AS (
            SELECT domain, suffix, (s * m + bad) / (s + n) AS m FROM domains JOIN sm USING (suffix), {strength_sql("domains")}
        ), ab AS (
            SELECT host, n, bad, s * m + bad AS a, s * (1 - m) + n - bad AS b
            FROM hosts JOIN dm USING (domain, suffix), {strength_sql("hosts")}
        ), pq AS (
            SELECT *, 2 * greatest(a, 1) - 1 AS x, 2 * greatest(b, 1) - 1 AS y, {reputation.BOUND_Z}::DOUBLE AS z FROM ab
        ), hc AS (
            SELECT *, 2 / (1 / x + 1 / y) AS h, (z * z - 3) / 6 AS c FROM pq
        ), t AS (
            SELECT host, n, bad, CASE WHEN a >= 1 AND b >= 1
                THEN a / (a + b * exp(2 * (z * sqrt(h + c) / h - (1 / y - 1 / x) * (c + 5 / 6 - 2 / (3 * h)))))
                ELSE greatest(0, a / (a + b) - z * sqrt(a * b / (a + b + 1)) / (a + b)) END AS bound
            FROM hc
        ), r AS (
            SELECT * FROM (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in reputation.rule_list(URL_RULES))}) r(v, rh, rp)
        ), f AS (
            SELECT host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
            FROM (SELECT DISTINCT host, path FROM p) JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
            GROUP BY host, path
        )
        SELECT page_id, p.host, p.path, rule, coalesce(v, CASE WHEN bound >= {reputation.BLOCK_SHARE} THEN 'block' ELSE 'allow' END) AS verdict,
            n AS n_labelled, CAST(bad AS BIGINT) AS n_bad, round(bound, 6) AS bad_bound
        FROM p JOIN t ON t.host = p.host LEFT JOIN f ON f.host = p.host AND f.path = p.path"""


ORACLE_SQL: dict[str, str] = {
    "op5_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), t AS (
            SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
                coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
                sum(24 + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'))
                    + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS chars
            FROM c GROUP BY conv_id
        )
        SELECT CAST(conv_id AS BIGINT) AS conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
            sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
        FROM t""",
    "op8_decontaminate": f"""
        WITH d AS (
            SELECT doc_id, coalesce({WORDS_SQL}, []) AS w FROM documents
        ), b AS (
            SELECT CAST(item_id AS VARCHAR) AS item_id, {WORDS_SQL} AS w FROM benchmark WHERE text IS NOT NULL
        ), iw AS (
            SELECT DISTINCT item_id, least(len(w), 13) AS n, unnest(list_transform(
                range(1, len(w) - least(len(w), 13) + 2), lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' ')
            )) AS body FROM b WHERE len(w) > 0
        ), dw AS (
            SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(
                range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS body
            FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n
        ), m AS (
            SELECT doc_id, dw.n, i, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.body = iw.body
        ), h AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id
        ), t AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
            FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id
        )
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
        FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id""",
    "op2_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
        )
        SELECT doc_id,
            min(doc_id) OVER (PARTITION BY body) AS keep_id,
            count(*) OVER (PARTITION BY body) AS group_size,
            row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept,
            sha256(body) AS text_sha256
        FROM n""",
    "op7_line_dedup": r"""
        WITH u AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                generate_subscripts(string_split(text, chr(10)), 1) AS i
            FROM documents WHERE text IS NOT NULL
        ), w AS (
            SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
                CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h
            FROM u
        ), n AS (
            SELECT *, sum(words) OVER o AS upto,
                lag(words) OVER o AS w0, lag(h) OVER o AS h0, lead(words) OVER o AS w1, lead(h) OVER o AS h1
            FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
        ), b AS (
            SELECT *,
                words > 0 AND (w0 IS NULL OR words >= 50 OR w0 >= 50 OR w0 = 0 OR (h0 * 31 + h) % 4 = 0) AS starts,
                words > 0 AND (w1 IS NULL OR words >= 50 OR w1 >= 50 OR w1 = 0 OR (h * 31 + h1) % 4 = 0) AS ends
            FROM n
        ), s AS (
            SELECT a.doc_id, a.i AS first, min(z.i) AS last FROM b a JOIN n z ON a.doc_id = z.doc_id
                AND z.i BETWEEN a.i AND a.i + 199 AND z.upto - a.upto + a.words >= 50
            WHERE a.starts GROUP BY a.doc_id, a.i
            UNION
            SELECT z.doc_id, max(a.i), z.i FROM b z JOIN n a ON a.doc_id = z.doc_id
                AND a.i BETWEEN z.i - 199 AND z.i AND z.upto - a.upto + a.words >= 50
            WHERE z.ends GROUP BY z.doc_id, z.i
        ), k AS (
            SELECT s.doc_id, first, last, string_agg(line, chr(10) ORDER BY i) AS body
            FROM s JOIN w ON s.doc_id = w.doc_id AND i BETWEEN first AND last GROUP BY ALL
        ), r AS (
            SELECT doc_id, first, last, row_number() OVER (PARTITION BY body ORDER BY doc_id, first, last) AS nth FROM k
        ), g AS (
            SELECT w.doc_id, w.i, line, bool_or(coalesce(nth > 1, false)) AS gone
            FROM w LEFT JOIN r ON r.doc_id = w.doc_id AND w.i BETWEEN first AND last GROUP BY ALL
        ), t AS (
            SELECT doc_id, count(*) AS n_lines, sum(CAST(gone AS INT)) AS removed_lines,
                coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text
            FROM g GROUP BY doc_id
        )
        SELECT d.doc_id, t.text, CAST(coalesce(n_lines, 0) AS INT) AS n_lines,
            CAST(coalesce(removed_lines, 0) AS INT) AS removed_lines
        FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id""",
    "op7_whole_passages": r"""
        WITH w AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                generate_subscripts(string_split(text, chr(10)), 1) AS i
            FROM documents WHERE text IS NOT NULL
        ), n AS (
            SELECT *, sum(words) OVER o AS upto, row_number() OVER o AS k
            FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM w) WHERE words > 0
            WINDOW o AS (PARTITION BY doc_id ORDER BY i)
        ), p AS (
            SELECT a.doc_id, a.i AS first, z.i AS last
            FROM n a JOIN n z ON a.doc_id = z.doc_id AND z.k BETWEEN a.k AND a.k + 49 AND z.upto - a.upto + a.words >= 50
        ), s AS (
            SELECT doc_id, first, min(last) AS last FROM p GROUP BY doc_id, first
            UNION
            SELECT doc_id, max(first), last FROM p GROUP BY doc_id, last
        ), k AS (
            SELECT s.doc_id, first, last, string_agg(line, chr(10) ORDER BY i) AS body
            FROM s JOIN w ON s.doc_id = w.doc_id AND i BETWEEN first AND last GROUP BY ALL
        ), r AS (
            SELECT doc_id, first, last, row_number() OVER (PARTITION BY body ORDER BY doc_id, first, last) AS nth FROM k
        ), g AS (
            SELECT w.doc_id, w.i, line, bool_or(coalesce(nth > 1, false)) AS gone
            FROM w LEFT JOIN r ON r.doc_id = w.doc_id AND w.i BETWEEN first AND last GROUP BY ALL
        ), t AS (
            SELECT doc_id, count(*) AS n_lines, sum(CAST(gone AS INT)) AS removed_lines,
                coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text
            FROM g GROUP BY doc_id
        )
        SELECT d.doc_id, t.text, CAST(coalesce(n_lines, 0) AS INT) AS n_lines,
            CAST(coalesce(removed_lines, 0) AS INT) AS removed_lines
        FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id""",
    "op11_merkle": merkle_sql(),
    "op12_url_filter": URL_SQL,
    "op13_hard_negatives": """
        WITH e AS (
            SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.uid AS au, a.vec_id AS anchor_id, e.uid, e.vec_id, a.label = e.label AS same,
                list_inner_product(a.v, e.v)::BIGINT AS score
            FROM e a, e WHERE a.vec_id % 100 = 0 AND a.uid <> e.uid
        ), p AS (
            SELECT *, row_number() OVER (PARTITION BY au ORDER BY score DESC, vec_id, uid) AS nth FROM s WHERE same
        ), n AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                row_number() OVER (PARTITION BY p.au, p.nth ORDER BY s.score DESC, s.vec_id, s.uid) AS rank
            FROM p JOIN s ON p.au = s.au
            WHERE nth <= 5 AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
        )
        SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}
