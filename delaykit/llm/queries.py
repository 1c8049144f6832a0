"""The registered queries of the subpackage and the SQL of those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from delaykit.llm import (
    alignment,
    ann,
    collocations,
    mixing,
    pieces,
    quality,
    rules,
    secrets,
    sharding,
    simhash,
    token_counts,
    token_files,
    toxicity,
)
from delaykit.llm.shared import fresh_path, send_code

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        def run(spark: SparkSession, path: str) -> DataFrame:
            send_code(spark)
            return fn(spark, path)

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return keep


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


@register("op1_simhash_groups")
def op1_simhash_groups(spark: SparkSession, path: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, path, "documents"))


@register("op2_mixed_sources")
def op2_mixed_sources(spark: SparkSession, path: str) -> DataFrame:
    return mixing.mix(table(spark, path, "documents"), max_epochs=2.0)


@register("op3_nearest_vectors")
def op3_nearest_vectors(spark: SparkSession, path: str) -> DataFrame:
    rows = table(spark, path, "embeddings")
    return ann.nearest(rows, rows.where("vec_id % 50 = 0"))


OP4_SQL = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS t,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM documents
), windows AS (
    SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)
), twice AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT i + k) AS n
    FROM twice CROSS JOIN (VALUES (0), (1), (2)) AS place(k) GROUP BY doc_id
), lines AS (
    SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), m AS (
    SELECT doc_id, source, len(ws)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines
    FROM d JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
), f AS (
    SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
        unnest([
            {'rule': 'short', 'failed': n_words < 50},
            {'rule': 'repeats', 'failed': n_repeat_words * 100 > n_words * 50},
            {'rule': 'symbols', 'failed': n_symbols * 100 > word_chars * 10},
            {'rule': 'lines', 'failed': n_dup_lines * 100 > n_lines * 30}
        ], recursive := true)
    FROM m
), hosts AS (
    SELECT source, rule, count(*) AS n, sum(failed::INT) AS x FROM f WHERE source IS NOT NULL GROUP BY ALL
), prior AS (
    SELECT rule, sum(x) / sum(n) AS mean, sum(x * x / n) / sum(n) - (sum(x) / sum(n)) ** 2
        - (sum(x) / sum(n)) * (1 - sum(x) / sum(n)) * (count(*) - 1) / sum(n) AS spread
    FROM hosts GROUP BY rule
), weighed AS (
    SELECT rule, mean, CASE WHEN spread > 1e-12
        THEN least(greatest(mean * (1 - mean) / spread - 1, 1), 1e6) ELSE 1e6 END AS weight
    FROM prior
), bad AS (
    SELECT DISTINCT source FROM hosts JOIN weighed USING (rule) WHERE (x + mean * weight) / (n + weight) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
    NOT (n_words < 50 OR n_repeat_words * 100 > n_words * 50)
        AND (source NOT IN (SELECT source FROM bad)) IS NOT FALSE AS kept
FROM m
"""


@register("op4_host_rules", OP4_SQL)
def op4_host_rules(spark: SparkSession, path: str) -> DataFrame:
    return rules.host_rules(table(spark, path, "documents"))


@register("op5_quality_scores")
def op5_quality_scores(spark: SparkSession, path: str) -> DataFrame:
    return quality.score_documents(table(spark, path, "documents"), table(spark, path, "labels"))


@register("op6_toxicity_scores")
def op6_toxicity_scores(spark: SparkSession, path: str) -> DataFrame:
    return toxicity.score_documents(table(spark, path, "documents"), table(spark, path, "labels"))


@register("op7_balanced_shards")
def op7_balanced_shards(spark: SparkSession, path: str) -> DataFrame:
    return sharding.shard_documents(table(spark, path, "documents"))


@register("op8_token_files")
def op8_token_files(spark: SparkSession, path: str) -> DataFrame:
    manifest = token_files.write_files(
        table(spark, path, "documents"),
        fresh_path(spark, "ids"),
        public_tokenizers.path("word_bpe_49k.json"),
    )
    return token_files.read_files(manifest)


@register("op9_pieces")
def op9_pieces(spark: SparkSession, path: str) -> DataFrame:
    return pieces.round_trip(table(spark, path, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op10_token_counts")
def op10_token_counts(spark: SparkSession, path: str) -> DataFrame:
    return token_counts.count_tokens(
        table(spark, path, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _strong_sql(kind: int, pattern: str, kept: str) -> str:
    p = _quoted(pattern)
    return f"""SELECT rid, t, regexp_extract_all(t, {p}, 0) AS h, regexp_split_to_array(t, {p}) AS g,
        list_transform({kept}, lambda x: CASE WHEN x THEN {kind} END) AS ks FROM d"""


_WEAK = _quoted(secrets.WEAK)
OP11_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), cut AS (
    {_strong_sql(0, secrets.ASSIGN, f"list_transform(regexp_extract_all(t, {_quoted(secrets.ASSIGN)}, 2), lambda v: length(v) >= 8)")}
    UNION ALL {_strong_sql(1, secrets.ACCESS, f"list_transform(regexp_extract_all(t, {_quoted(secrets.ACCESS)}, 0), lambda v: true)")}
    UNION ALL {_strong_sql(2, secrets.HEX, f"list_transform(regexp_extract_all(t, {_quoted(secrets.HEX)}, 0), lambda v: true)")}
    UNION ALL SELECT rid, t, regexp_extract_all(t, {_WEAK}, 0), regexp_split_to_array(t, {_WEAK}),
        list_transform(list_zip(regexp_extract_all(t, {_WEAK}, 1), regexp_extract_all(t, {_WEAK}, 2), regexp_extract_all(t, {_WEAK}, 3)),
            lambda z: CASE WHEN z[1] <> '' THEN 3 WHEN z[2] <> '' THEN 5
                WHEN regexp_matches(z[3], '[a-z]') AND regexp_matches(z[3], '[A-Z]') AND regexp_matches(z[3], '[0-9]') THEN 4 END)
    FROM d
), hits AS (
    SELECT rid, t, ks[i] AS kind, length(h[i]) AS n, list_sum(list_transform(g[1:i], lambda x: length(x)))
        + list_sum(list_transform(h[1:i], lambda x: length(x))) AS finish
    FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM cut)
), parts AS (
    SELECT rid, kind, (finish - n)::BIGINT AS start, finish::BIGINT AS finish,
        len(regexp_extract_all(left(t, (finish - n)::BIGINT), {_quoted(secrets.BLANK)})) AS scope
    FROM hits WHERE kind IS NOT NULL
), met AS (
    SELECT a.rid, a.kind, a.start, a.finish, bool_or(b.kind IN (1, 3)) AS named, bool_or(b.kind IN (0, 2, 4)) AS secret
    FROM parts a JOIN parts b ON a.rid = b.rid AND a.scope = b.scope AND abs(a.start - b.start) <= 300
    WHERE a.kind >= 3 GROUP BY ALL
), reported AS (
    SELECT rid, kind, start, finish FROM parts WHERE kind < 3
    UNION ALL SELECT rid, kind, start, finish FROM met
    WHERE CASE kind WHEN 3 THEN secret WHEN 4 THEN named ELSE named AND secret END
), told AS (
    SELECT rid, kind, start, ['assign', 'access', 'hex', 'user', 'opaque', 'endpoint'][kind + 1] || ':' || start || ':' || finish AS span
    FROM reported
), summed AS (
    SELECT rid, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
        count(*) FILTER (WHERE kind = 2) AS n_hex,
        string_agg(span, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base,
        string_agg(span, ',' ORDER BY start, kind) AS spans
    FROM told GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
    coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN summed USING (rid)
"""


@register("op11_linked_secrets", OP11_SQL)
def op11_linked_secrets(spark: SparkSession, path: str) -> DataFrame:
    return secrets.span_digests(secrets.scan(table(spark, path, "documents")))


@register("op12_aligned_tokens")
def op12_aligned_tokens(spark: SparkSession, path: str) -> DataFrame:
    rows = alignment.align_documents(
        table(spark, path, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
        digest=True,
    )
    return rows.withColumnRenamed("groups", "groups_sha256")


OP13_SQL = r"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS piece, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda w: w <> '') AS ws
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), places AS (
    SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM pieces CROSS JOIN (VALUES (1), (2), (3), (4), (5)) AS length(k)
), counts AS (
    SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL
), sizes AS (
    SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang
), longer AS (
    SELECT lang, f, string_split(phrase, ' ') AS ws, k, unnest(range(2, k)) AS m FROM counts WHERE f >= 100 AND k > 2
), inside AS (
    SELECT lang, f, ws, m, unnest(range(1, k - m + 2)) AS i FROM longer
), held AS (
    SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(f) AS held FROM inside GROUP BY ALL
), candidates AS (
    SELECT c.lang, c.phrase, c.f AS a, c.k, string_split(c.phrase, ' ') AS ws FROM counts c LEFT JOIN held h ON c.lang = h.lang AND c.phrase = h.phrase
    WHERE c.k > 1 AND c.f >= 100 AND 100 * coalesce(h.held, 0) < 100 * c.f
), cuts AS (
    SELECT lang, phrase, a, k, ws, unnest(range(1, k)) AS cut FROM candidates
), scored AS (
    SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r, n::BIGINT AS n,
        ((1000::HUGEINT * c.a * n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT))::BIGINT AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1 : cut], ' ')
        JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(ws[cut + 1 : c.k], ' ') JOIN sizes s ON s.lang = c.lang
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1
), placed AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM scored
)
SELECT * FROM placed WHERE rank <= 2000
"""


@register("op13_phrases", OP13_SQL)
def op13_phrases(spark: SparkSession, path: str) -> DataFrame:
    return collocations.mine(table(spark, path, "documents"))
