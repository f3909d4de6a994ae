"""Registered queries of the operators, each over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm import centroids, chats, divergence, fingerprints, language, lines, packing, pieces, simhash, token_files, topk, toxicity, urls
from gazetta.llm.common import table
from gazetta.session import work_path

RULES = (
    urls.Rule("com", "/", "allow"),
    urls.Rule("example.com", "/en/", "block"),
    urls.Rule("www.example.com", "/en/", "allow"),
    urls.Rule("net", "/es/", "block"),
    urls.Rule("net", "/fr/", "block"),
)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "token-ids")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.token_digests(token_files.read_token_files(spark, path))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_versions(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_rows(table(spark, sf_dir, "documents"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digests(table(spark, sf_dir, "documents"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), RULES)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


#: Both turns of the conversation that the query adds.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op13_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(CONTROL_TEXT).alias("prompt"), F.lit(CONTROL_TEXT).alias("response"))
    rows = table(spark, sf_dir, "conversations").withColumn("conv_id", F.col("conv_id").cast("long"))
    return chats.chat_digests(chats.format_conversations(rows, added))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_toxicity,
        op3_top_k,
        op4_token_files,
        op5_fingerprints,
        op6_simhash,
        op7_pieces,
        op8_language,
        op9_lines,
        op10_urls,
        op11_centroids,
        op12_divergence,
        op13_chats,
    )
}


def _centroid_sql(k: int = 40, rounds: int = 5) -> str:
    """Rounds one after the other: assignment of every vector, then floors of the means."""
    steps = [
        """v AS MATERIALIZED (
            SELECT row_number() OVER () AS row_no, vec_id, [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) for x in embedding] AS v
            FROM embeddings WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        )""",
        f"""c0 AS MATERIALIZED (
            SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS INTEGER) AS cluster, v
            FROM v QUALIFY cluster < {k}
        )""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
            SELECT row_no, vec_id, v.v, c.cluster, CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(v.v, c.v)]) AS BIGINT) AS distance
            FROM v, c{r} c QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY distance, c.cluster) = 1
        )""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
                WITH e AS (SELECT cluster, generate_subscripts(v, 1) AS d, unnest(v) AS x FROM a{r}),
                s AS (SELECT cluster, d, sum(x) AS s, count(*) AS n FROM e GROUP BY cluster, d),
                m AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS v FROM s GROUP BY cluster)
                SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m ON m.cluster = c.cluster
            )""")
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia,
               (SELECT sha256(array_to_string(c.v, ',')) FROM c{rounds} c WHERE c.cluster = a.cluster) AS centroid_sha256
        FROM a{rounds} a"""


ORACLES: dict[str, str] = {
    "op3_top_k": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT) for x in embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 10
    """,
    "op9_lines": r"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
            FROM documents
        ), k AS (
            SELECT doc_id, line_no, line,
                   translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l
        ), d AS (
            SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
        ), m AS (
            SELECT k.doc_id, k.line_no, k.line, d.key IS NOT NULL AND k.doc_id <> d.keeper AS gone FROM k LEFT JOIN d ON k.key = d.key
        )
        SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    "op10_urls": """
        WITH p AS (
            SELECT row_number() OVER () AS row_no, page_id,
                   translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), r(rule_host, rule_path, verdict) AS (
            VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
        ), f AS (
            SELECT p.*, r.rule_host || r.rule_path AS rule, r.verdict,
                   row_number() OVER (PARTITION BY row_no ORDER BY length(r.rule_host || r.rule_path) DESC) AS nth
            FROM p LEFT JOIN r ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE nth = 1
    """,
    "op11_centroids": _centroid_sql(),
    "op12_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
            FROM documents
        ), w AS (
            SELECT row_no, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
        ), c AS (
            SELECT lang, source, term, count(*) AS n, count(DISTINCT row_no) AS docs FROM w GROUP BY lang, source, term
        ), t AS (
            SELECT lang, term, sum(n) AS total FROM c GROUP BY lang, term HAVING sum(docs) >= 3
        ), l AS (
            SELECT lang, count(*) AS terms, sum(total) AS size FROM t GROUP BY lang
        ), k AS (
            SELECT c.lang, c.source, c.term, c.n, t.total FROM c JOIN t ON t.lang = c.lang AND t.term = c.term
        ), z AS (
            SELECT lang, source, sum(n) AS size FROM k GROUP BY lang, source
        ), g AS (
            SELECT d.lang, d.source, coalesce(z.size, 0) AS size, coalesce(l.terms, 0) AS terms, l.size AS lang_size
            FROM (SELECT DISTINCT lang, source FROM d) d
            LEFT JOIN z ON z.lang = d.lang AND z.source = d.source LEFT JOIN l ON l.lang = d.lang
        ), e AS (
            SELECT g.lang, g.source, t.term, k.n, 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(k.n, 0) + 1)) // (g.size + g.terms) AS p,
                   1 + (CAST(1000000000 AS HUGEINT) * (t.total + 1)) // (g.lang_size + g.terms) AS q
            FROM g JOIN t ON t.lang = g.lang LEFT JOIN k ON k.lang = g.lang AND k.source = g.source AND k.term = t.term
        ), s AS (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
            FROM e a JOIN e b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
        ), r AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM e WHERE n > 0 AND p > q
        )
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
               CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
        FROM r QUALIFY part = 'pair' OR rank <= 200
    """,
    "op13_chats": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, 'turns' AS layout FROM conversations
            UNION ALL
            VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]', 'prompt_response'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]', 'prompt_response')
        ), e AS (
            SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|(?:SYS|INST|TURN|TEXT)\]))', '\1\2\\\3', 'g')) AS body,
                   length(regexp_replace(role, '([<\[])(\\*)(/?(?:s>|(?:SYS|INST|TURN|TEXT)\]))', '\1\2\\\3', 'g')) AS name
            FROM t
        )
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(3 + sum(body + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 4 ELSE 19 + name END) AS BIGINT) AS formatted_chars,
               any_value(layout) AS layout
        FROM e GROUP BY conv_id
    """,
}
