"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    collocations,
    decontamination,
    html_extraction,
    language_id,
    lexical_search,
    line_dedup,
    mixing,
    near_dedup,
    quality_rules,
    substring_dedup,
    token_counts,
    toxicity,
    url_filters,
)
from starmart.llm.common import held_out, read

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs.select("doc_id", "text", "lang"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(toxicity.SCORE).alias("score"),
        (F.col(toxicity.SCORE) >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        toxicity.is_toxic(model).alias("toxic_for_language"),
    )


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read(spark, sf_dir, "documents"))


def language_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(~held_out(F.col("doc_id"))))
    return language_id.identify(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )


def substring_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = substring_dedup.remove_passages(read(spark, sf_dir, "documents"))
    kept = F.when(F.col("n_removed") > 0, F.sha2("kept", 256)).otherwise(
        F.lower(F.hex("words_sha"))
    )
    return result.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))


def html_extraction_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(read(spark, sf_dir, "pages"))


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    return decontamination.matches(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )


def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
    return quality_rules.judge(read(spark, sf_dir, "documents")).select(
        *columns, "base_failed", "kept"
    )


def url_filters_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filters.judge_pages(read(spark, sf_dir, "pages"))
    host_rules = [rule.text for rule in url_filters.HOST_RULES]
    rule = F.when(F.col("matched").isin(host_rules), F.col("matched"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), "verdict")


def near_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, which of them go, links of its lines to other texts, and
    the documents where the classes of the lines that go begin."""
    return line_dedup.dedup(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_lines",
        "n_removed",
        "n_links",
        F.sha2("text", 256).alias("kept_sha256"),
        F.array_join(F.col("classes").cast("array<string>"), ",").alias("class_ids"),
    )


def collocations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        tokenizer = file.read()
    counts = token_counts.token_counts(read(spark, sf_dir, "documents"), tokenizer)
    return counts.withColumn("over_limit", F.col("n_tokens") > token_counts.LIMIT)


def lexical_search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )


QUERIES: dict[str, Query] = {
    "op1_toxicity": toxicity_query,
    "op2_substring_dedup": substring_dedup_query,
    "op3_html_extraction": html_extraction_query,
    "op4_decontamination": decontamination_query,
    "op5_quality_rules": quality_rules_query,
    "op6_url_filters": url_filters_query,
    "op7_mixing": mixing_query,
    "op8_language_id": language_id_query,
    "op9_near_dedup": near_dedup_query,
    "op10_line_dedup": line_dedup_query,
    "op11_collocations": collocations_query,
    "op12_token_counts": token_counts_query,
    "op13_lexical_search": lexical_search_query,
}

ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row_id, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), places AS (
            SELECT row_id, doc_id, w, unnest(range(1, len(w) - 18)) AS start
            FROM docs WHERE doc_id IS NOT NULL
        ), windows AS (
            SELECT row_id, doc_id, start, array_to_string(w[start:start + 19], ' ') AS words
            FROM places
        ), firsts AS (
            SELECT words, min({'doc_id': doc_id, 'start': start}) AS earliest
            FROM windows GROUP BY words
        ), repeats AS (
            SELECT row_id, start FROM windows JOIN firsts USING (words)
            WHERE earliest < {'doc_id': doc_id, 'start': start}
        ), removed AS (
            SELECT DISTINCT row_id, start + shift AS place
            FROM repeats, (SELECT unnest(range(0, 20)) AS shift)
        ), tokens AS (
            SELECT row_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM docs
        ), kept AS (
            SELECT row_id, count(r.place) AS n_removed,
                   string_agg(word, ' ' ORDER BY t.place) FILTER (WHERE r.place IS NULL) AS text
            FROM tokens t LEFT JOIN removed r USING (row_id, place) GROUP BY row_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (row_id)
    """,
    "op9_near_dedup": r"""
        WITH RECURSIVE docs AS (
            SELECT row_number() OVER () AS row_id, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), places AS (
            SELECT row_id, doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS place
            FROM docs WHERE len(w) > 0
        ), shingles AS (
            SELECT DISTINCT row_id, doc_id, array_to_string(w[place:place + 4], ' ') AS shingle
            FROM places
        ), sizes AS (
            SELECT row_id, count(*) AS n FROM shingles GROUP BY row_id
        ), shared AS (
            SELECT a.row_id AS x, b.row_id AS y, count(*) AS n
            FROM shingles a JOIN shingles b
              ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY ALL
        ), links AS (
            SELECT DISTINCT p.doc_id AS x, q.doc_id AS y
            FROM shared JOIN sizes a ON a.row_id = x JOIN sizes b ON b.row_id = y
            JOIN docs p ON p.row_id = x JOIN docs q ON q.row_id = y
            WHERE 100 * shared.n >= 85 * (a.n + b.n - shared.n)
        ), reach AS (
            SELECT DISTINCT doc_id AS node, doc_id AS root FROM docs WHERE doc_id IS NOT NULL
            UNION
            SELECT links.y, reach.root FROM reach JOIN links ON links.x = reach.node
            WHERE reach.root < links.y
        ), components AS (
            SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY node
        )
        SELECT docs.doc_id, coalesce(n, 0) AS n_shingles, component_id,
               coalesce(component_id = docs.doc_id, true) AS kept
        FROM docs LEFT JOIN sizes USING (row_id)
        LEFT JOIN components ON components.doc_id = docs.doc_id
    """,
    "op4_decontamination": r"""
        WITH items AS (
            SELECT item_row, item_id, w,
                   unnest(range(1, greatest(len(w) - 3, 2))) AS place
            FROM (SELECT row_number() OVER () AS item_row, item_id, regexp_extract_all(translate(text,
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x20\x09-\x0D]+') AS w
                  FROM benchmark)
            WHERE len(w) > 0
        ), item_shingles AS (
            SELECT DISTINCT item_row, item_id, least(len(w), 5) AS width,
                   array_to_string(w[place:place + 4], ' ') AS shingle
            FROM items
        ), docs AS (
            SELECT row_number() OVER () AS row_id, doc_id,
                   regexp_extract_all(translate(text,
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), places AS (
            SELECT row_id, doc_id, width, w, unnest(range(1, len(w) - width + 2)) AS place
            FROM docs, (SELECT DISTINCT width FROM item_shingles)
        ), doc_shingles AS (
            SELECT DISTINCT row_id, doc_id, width,
                   array_to_string(w[place:place + width - 1], ' ') AS shingle
            FROM places
        ), sizes AS (
            SELECT item_row, count(*) AS n_item FROM item_shingles GROUP BY item_row
        )
        SELECT doc_id, item_id, any_value(n_item) AS n_item, count(*) AS n_shared
        FROM doc_shingles JOIN item_shingles USING (width, shingle) JOIN sizes USING (item_row)
        GROUP BY row_id, doc_id, item_row, item_id
        HAVING 10 * count(*) >= 8 * any_value(n_item)
    """,
    "op5_quality_rules": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS row_id, doc_id, source,
                   coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                   [line FOR line IN string_split(coalesce(text, ''), chr(10))
                    IF regexp_matches(line, '[^\x20\x09-\x0D]')] AS lines
            FROM documents
        ), places AS (
            SELECT row_id, words, unnest(range(1, len(words) - 1)) AS place FROM texts
        ), windows AS (
            SELECT row_id, place,
                   count(*) OVER (PARTITION BY row_id, words[place], words[place + 1],
                                  words[place + 2]) AS n
            FROM places
        ), repeated AS (
            SELECT row_id, count(DISTINCT place + shift) AS n_repeat_words
            FROM windows, (SELECT unnest([0, 1, 2]) AS shift) WHERE n > 1
            GROUP BY row_id
        ), measured AS (
            SELECT doc_id, source, len(words) AS n_words,
                   length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
                   length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g'))
                       AS n_symbols,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   len(lines) AS n_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words
            FROM texts LEFT JOIN repeated USING (row_id)
        ), judged AS (
            SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2,
                   10 * n_symbols > n_words AS f3, 2 * n_dup_lines > n_lines AS f4,
                   word_chars < 2 * n_words OR word_chars > 12 * n_words AS f5
            FROM measured
        ), failures AS (
            UNPIVOT (SELECT source, f1::INT AS f1, f2::INT AS f2, f3::INT AS f3,
                            f4::INT AS f4, f5::INT AS f5
                     FROM judged WHERE source IS NOT NULL)
            ON f1, f2, f3, f4, f5 INTO NAME rule VALUE failed
        ), hosts AS (
            SELECT source, rule, sum(failed) AS k, count(*) AS n
            FROM failures GROUP BY ALL
        ), moments AS (
            SELECT rule, sum(k) / sum(n) AS mean, avg((k / n) * (k / n)) AS square,
                   avg(k / n) AS rate, avg(1 / n) AS inverse
            FROM hosts GROUP BY rule
        ), spreads AS (
            SELECT *, square - 2 * mean * rate + mean * mean
                      - mean * (1 - mean) * inverse AS excess
            FROM moments
        ), priors AS (
            SELECT rule, mean,
                   CASE WHEN excess > 0
                        THEN least(greatest(mean * (1 - mean) / excess - 1, 1), 1000)
                        ELSE 1000 END AS weight
            FROM spreads
        ), rejected AS (
            SELECT source FROM hosts JOIN priors USING (rule)
            GROUP BY source HAVING max((k + mean * weight) / (n + weight)) > 0.5
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               f1 OR f2 AS base_failed,
               NOT (f1 OR f2)
                   AND (source IS NULL OR source NOT IN (FROM rejected)) AS kept
        FROM judged
    """,
    "op6_url_filters": r"""
        WITH rests AS (
            SELECT page_id,
                   CASE WHEN contains(url, '://')
                        THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
            FROM pages
        ), split AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM rests
        ), ruled AS (
            SELECT *,
                   CASE WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%'
                        THEN 'example.net/en/'
                        WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%'
                        THEN 'example.com/de/'
                        WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
                        WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/'
                   END AS rule
            FROM split
        )
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
                    WHEN rule IS NOT NULL THEN 'allow'
                    WHEN regexp_matches(host || path, '/(login|signup|checkout|cart|ads)/')
                    THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled
    """,
    # Lines within one edit share what is left when each loses a certain character.
    "op10_line_dedup": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row_id, doc_id, text,
                   string_split(coalesce(text, ''), chr(10)) AS lines
            FROM documents
        ), places AS (
            SELECT row_id, doc_id, lines, unnest(range(1, len(lines) + 1)) AS n FROM docs
        ), seen AS (
            SELECT row_id, doc_id, n, lines[n] AS line,
                   regexp_matches(lines[n], '[^\x20\x09-\x0D]') AS has_word
            FROM places
        ), firsts AS (
            SELECT line, length(line) AS size, min({'doc_id': doc_id, 'n': n}) AS earliest
            FROM seen WHERE has_word AND doc_id IS NOT NULL GROUP BY line
        ), places_of AS (
            SELECT line, size, unnest(range(1, size + 1)) AS i FROM firsts WHERE size > 1
        ), shorter AS (
            SELECT line, size, i, hash(left(line, i - 1) || substr(line, i + 1)) AS rest
            FROM places_of
        ), one_less AS (
            SELECT DISTINCT a.line AS x, b.line AS y
            FROM shorter a JOIN firsts b
              ON a.rest = hash(b.line) AND a.size = b.size + 1 AND b.size > 1
        ), links AS (
            SELECT DISTINCT a.line AS x, b.line AS y
            FROM shorter a JOIN shorter b USING (size, i, rest) WHERE a.line <> b.line
            UNION ALL SELECT x, y FROM one_less UNION ALL SELECT y, x FROM one_less
        ), around AS (
            SELECT x AS line, min(earliest) AS near, count(*) AS n_links
            FROM links JOIN firsts ON firsts.line = y GROUP BY x
        ), classes AS (
            SELECT line, coalesce(n_links, 0) AS n_links,
                   CASE WHEN near < earliest THEN near ELSE earliest END AS before
            FROM firsts LEFT JOIN around USING (line)
        ), judged AS (
            SELECT row_id, n, seen.line, has_word, n_links, before,
                   coalesce(before < {'doc_id': doc_id, 'n': n}, false) AS repeat
            FROM seen LEFT JOIN classes
              ON seen.line = classes.line AND has_word AND doc_id IS NOT NULL
        ), digests AS (
            SELECT row_id, count(*) FILTER (WHERE has_word) AS n_lines,
                   count(*) FILTER (WHERE repeat) AS n_removed,
                   CAST(coalesce(sum(n_links), 0) AS BIGINT) AS n_links,
                   coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT repeat), '')
                       AS kept,
                   list_sort(list_distinct(list(before.doc_id) FILTER (WHERE repeat)))
                       AS classes
            FROM judged GROUP BY row_id
        )
        SELECT doc_id, n_lines, n_removed, n_links,
               sha256(CASE WHEN n_removed > 0 THEN kept ELSE text END) AS kept_sha256,
               coalesce(array_to_string(classes, ','), '') AS class_ids
        FROM docs JOIN digests USING (row_id)
    """,
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT row_number() OVER () AS piece_id, lang, piece FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents)
        ), split AS (
            SELECT piece_id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), starts AS (
            SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split
        ), phrases AS (
            SELECT lang, w[i:i + size - 1] AS p
            FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE i + size - 1 <= len(w)
        ), counts AS (
            SELECT lang, p, count(*) AS f FROM phrases GROUP BY lang, p HAVING count(*) >= 100
        ), totals AS (
            SELECT lang, sum(len(w))::HUGEINT AS n FROM split GROUP BY lang
        ), candidates AS (
            SELECT lang, p, f AS a, n FROM counts JOIN totals USING (lang) WHERE len(p) > 1
        ), cuts AS (
            SELECT *, unnest(range(1, len(p))) AS k FROM candidates
        ), valued AS (
            SELECT c.lang, c.p, a, n, k, l.f AS l, r.f AS r,
                   (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
            FROM cuts c JOIN counts l ON l.lang = c.lang AND l.p = c.p[1:k]
            JOIN counts r ON r.lang = c.lang AND r.p = c.p[k + 1:]
        ), lowest AS (
            SELECT lang, p, a, n, arg_min({'l': l, 'r': r, 'score': score},
                                          {'score': score, 'k': k}) AS best
            FROM valued GROUP BY ALL
        ), inner_starts AS (
            SELECT lang, p, a, unnest(range(1, len(p) + 1)) AS i FROM candidates
        ), covered AS (
            SELECT DISTINCT s.lang, s.p[i:i + size - 1] AS p, s.a
            FROM inner_starts s, (SELECT unnest([2, 3, 4]) AS size)
            WHERE i + size - 1 <= len(s.p) AND size < len(s.p)
        ), alone AS (
            SELECT * FROM lowest x WHERE NOT EXISTS (
                FROM covered c WHERE c.lang = x.lang AND c.p = x.p AND 100 * c.a >= 100 * x.a)
        ), ranked AS (
            SELECT lang, array_to_string(p, ' ') AS phrase, a, best.l AS l, best.r AS r,
                   n::BIGINT AS n, best.score::BIGINT AS score
            FROM alone
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
                   AS rank, phrase, a, l, r, n, score
        FROM ranked QUALIFY rank <= 2000
    """,
    "op13_lexical_search": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), items AS (
            SELECT row_number() OVER () AS item_row, item_id, regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), totals AS (
            SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS length FROM docs WHERE len(w) > 0
        ), asked AS (
            SELECT item_row, item_id, unnest(w) AS term FROM items
        ), tfs AS (
            SELECT row_id, doc_id, n, term, count(*) AS tf FROM (
                SELECT row_id, doc_id, len(w) AS n, unnest(w) AS term FROM docs)
            GROUP BY ALL
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM tfs, totals GROUP BY term, n_docs
        ), scores AS (
            SELECT item_row, item_id, row_id, doc_id, sum(w * ((1000000000 * tf)
                       // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // length)))) AS score
            FROM asked JOIN weights USING (term) JOIN tfs USING (term), totals
            GROUP BY ALL
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_row
                   ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank,
               doc_id, score::BIGINT AS score
        FROM scores WHERE score > 0 QUALIFY rank <= 10
    """,
}
