"""The registered queries of this package, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.conversation_repair import repair_report
from turnstile.llm.decontaminate import contamination
from turnstile.llm.exact_dedup import exact_duplicates
from turnstile.llm.filter_audit import filter_audit
from turnstile.llm.html_text import page_texts
from turnstile.llm.language import languages
from turnstile.llm.mixing import mixed
from turnstile.llm.quality import quality
from turnstile.llm.sharding import sharded
from turnstile.llm.simhash import linked_documents
from turnstile.llm.toxicity import toxicity
from turnstile.llm.url_filter import Rule, canonical, host_of, judged
from turnstile.llm.vector_lists import nearest, usable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register ``build(spark, folder)`` under its own name."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op2_longest_first_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharded(table(spark, folder, "documents"))


RULES = [
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
]
# Words in host names that put the pages of a host on the list of the day.
LISTED_WORDS = ("adult", "bets", "casino", "pills", "spam", "track")

_HOST = "translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


@query(
    rf"""
    WITH parts AS (
        SELECT page_id, {_HOST} AS host, {_PATH} AS path,
            regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*(\?[^#]*)', 1),
                '[?&](utm_[a-z]+|ref|fbclid|gclid)=[^&#]*', '', 'g'), '^&', '?') AS query
        FROM pages
    ), keyed AS (
        SELECT page_id, host, path,
            concat(regexp_replace(host, ':(80|443)$', ''), regexp_replace(path, '(\.html?|/+)$', ''), query) AS key
        FROM parts
    ), listed AS (
        SELECT DISTINCT key FROM keyed WHERE regexp_matches(host, '{"|".join(LISTED_WORDS)}')
    ), ruled AS (
        SELECT k.page_id, r.host || r.path AS rule, r.verdict,
            row_number() OVER (PARTITION BY k.page_id ORDER BY length(r.host || r.path) DESC) AS place
        FROM keyed k JOIN (VALUES {", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)}) r(host, path, verdict)
        ON (k.host = r.host OR ends_with(k.host, '.' || r.host)) AND starts_with(k.path, r.path)
    )
    SELECT k.page_id, k.host, k.path, r.rule,
        coalesce(r.verdict, CASE WHEN l.key IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
        l.key IS NOT NULL AS listed
    FROM keyed k LEFT JOIN ruled r ON r.page_id = k.page_id AND r.place = 1 LEFT JOIN listed l ON l.key = k.key
    """
)
def op6_listed_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    listed = pages.where(host_of(F.col("url")).rlike("|".join(LISTED_WORDS))).select(canonical(F.col("url")).alias("key"))
    return judged(pages, RULES, listed)


@query(
    r"""
    WITH rows AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256,
            length(coalesce(text, '')) AS points
        FROM documents
    )
    SELECT doc_id, keep_id, group_size, points = most AND doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
    FROM (
        SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
            first_value(doc_id) OVER best AS keep_id, first_value(points) OVER best AS most
        FROM rows WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)
    )
    """
)
def op7_digest_index(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


@query(
    r"""
    WITH rows AS (
        SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(coalesce(text, '')))) AS hash,
            CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
        FROM documents
    ), sized AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source
    ), placed AS (
        SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sized
    ), levels AS (  -- each source as the first that its cap does not cut
        SELECT a.source,
            (1.5 * (SELECT sum(source_size) FROM placed)
                - coalesce(sum(2.0 * b.source_size) FILTER (b.source_size / b.weight < a.source_size / a.weight), 0))
            / (coalesce(sum(b.weight) FILTER (b.source_size / b.weight >= a.source_size / a.weight), 0)) AS level,
            2.0 * any_value(a.source_size) / any_value(a.weight) AS ratio
        FROM placed a CROSS JOIN placed b GROUP BY a.source
    ), targets AS (
        SELECT source, source_size, least(2.0 * source_size, weight * (
            SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio)) AS target
        FROM placed
    ), hashes AS (
        SELECT r.source, r.hash, sum(r.size) AS together FROM rows r GROUP BY ALL
    ), summed AS (
        SELECT source, hash, together,
            coalesce(sum(together) OVER (PARTITION BY source ORDER BY hash
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM hashes
    )
    SELECT r.doc_id, r.source, r.size, t.source_size, round(CAST(t.target AS DOUBLE), 6) AS target,
        CASE WHEN t.source_size = 0 THEN 0 ELSE r.size * (floor(t.target / t.source_size)::BIGINT
            + CASE WHEN t.target < 2 * t.source_size AND s.before + s.together / 2
                <= t.target - floor(t.target / t.source_size) * t.source_size THEN 1 ELSE 0 END) END AS taken
    FROM rows r
    JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
    JOIN summed s ON s.source IS NOT DISTINCT FROM r.source AND s.hash = r.hash
    """
)
def op8_hash_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixed(table(spark, folder, "documents"))
    return mix.select("doc_id", "source", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query(
    r"""
    WITH doc_words AS (
        SELECT row_number() OVER () AS row_id, doc_id,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
    ), item_words AS (
        SELECT item_id,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM benchmark
    ), sized AS (
        SELECT item_id, words, least(10, len(words)) AS n FROM item_words WHERE len(words) > 0
    ), windows AS (
        SELECT DISTINCT item_id, n, array_to_string(words[s : s + n - 1], ' ') AS passage
        FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS s FROM sized)
    ), runs AS (
        SELECT row_id, s, n, array_to_string(words[s : s + n - 1], ' ') AS passage
        FROM (
            SELECT row_id, words, n, unnest(range(1, len(words) - n + 2)) AS s
            FROM doc_words CROSS JOIN (SELECT DISTINCT n FROM windows)
        )
    ), hits AS (
        SELECT row_id, s, n, item_id FROM runs JOIN windows USING (n, passage)
    ), covered AS (
        SELECT row_id, count(DISTINCT place) AS n_hit
        FROM (SELECT DISTINCT row_id, unnest(range(s, s + n)) AS place FROM hits) GROUP BY row_id
    ), named AS (
        SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY row_id
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc_words LEFT JOIN covered USING (row_id) LEFT JOIN named USING (row_id)
    """
)
def op9_winnowed_passages(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op10_simhash_trees(spark: SparkSession, folder: str) -> DataFrame:
    return linked_documents(table(spark, folder, "documents"))


@query()
def op4_restored_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op1_partial_matching_language(spark: SparkSession, folder: str) -> DataFrame:
    return languages(table(spark, folder, "documents"))


@query()
def op3_tree_marginals(spark: SparkSession, folder: str) -> DataFrame:
    return page_texts(table(spark, folder, "pages"))


@query()
def op5_site_shrinkage(spark: SparkSession, folder: str) -> DataFrame:
    source = F.col("source")
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality(docs, labels, host=source, path=F.concat_ws("/", source, F.col("lang")))


@query(
    r"""
    WITH rows AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
    ), firsts AS (
        SELECT text, min(doc_id) AS first FROM rows GROUP BY text
    ), worded AS (
        SELECT r.doc_id, r.part, r.text, f.first, regexp_extract_all(r.text, '[^\x20\x09-\x0D]+') AS words
        FROM rows r JOIN firsts f ON f.text = r.text
    ), fails AS (
        SELECT doc_id, part, MAP {
            'A': len(words) < 200,
            'B': 100 * len(list_distinct(words)) < 50 * len(words),
            'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text),
            'D': regexp_matches(text, '[#$%&*|]'),
            'E': coalesce(first < doc_id, false)} AS failed
        FROM worded
    ), marked AS (
        SELECT f.part, f.failed,
            coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
        FROM fails f LEFT JOIN (
            SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
        ) l ON l.doc_id = f.doc_id
    ), masks AS (
        SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marked GROUP BY ALL
    ), letters AS (
        SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
    ), orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
    ), steps AS (
        SELECT filter_order, step, filter_order[step] AS letter, string_split(left(filter_order, step - 1), '') AS before
        FROM orders, (SELECT unnest(range(1, 6)) AS step)
    ), told AS (
        SELECT part, filter_order, step, letter,
            sum(n * (NOT failed[letter] AND NOT coalesce(list_bool_or([failed[b] FOR b IN before]), false))::INT) AS kept,
            sum(n * (failed[letter] AND NOT coalesce(list_bool_or([failed[b] FOR b IN before]), false))::INT) AS removed,
            sum(n * (failed[letter] AND coalesce(list_bool_or([failed[b] FOR b IN before]), false))::INT) AS redundant,
            sum(n * (failed[letter] AND len(list_filter(map_values(failed), lambda v: v)) = 1)::INT) AS unique_fails,
            sum(good * (failed[letter] AND NOT coalesce(list_bool_or([failed[b] FOR b IN before]), false))::INT) AS good_lost,
            sum(toxic * (failed[letter] AND NOT coalesce(list_bool_or([failed[b] FOR b IN before]), false))::INT) AS toxic_lost
        FROM masks, steps GROUP BY ALL
    )
    SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
        unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
        sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
    FROM told
    """
)
def op11_failure_diagrams(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op13_checkpointed_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair_report(table(spark, folder, "conversations"))


@query()
def op12_balanced_lists(spark: SparkSession, folder: str) -> DataFrame:
    rows = usable(table(spark, folder, "embeddings"))
    return nearest(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)
