"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tablewright.llm.centroids import cluster
from tablewright.llm.common import table
from tablewright.llm.decontamination import decontaminate
from tablewright.llm.html import extract_pages
from tablewright.llm.lines import dedup_lines
from tablewright.llm.middle import transformed
from tablewright.llm.pieces import encode_documents, read_model
from tablewright.llm.positive import quality_scores
from tablewright.llm.pseudonyms import pseudonymise
from tablewright.llm.quality import quality_rules
from tablewright.llm.secrets import scan_secrets
from tablewright.llm.sharding import shard_by_size
from tablewright.llm.simhash import near_duplicates
from tablewright.llm.urls import filter_urls

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
PSEUDONYM_KEY = "tablewright-demo-key"  # production passes its own secret
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_size(table(spark, sf_dir, "documents"), shards=8)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text left, and which lines went."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), cuts_as="cuts")
    lines = F.array_sort(
        F.array_distinct(F.flatten(F.transform("cuts", lambda c: F.sequence(c["start"], c["end"]))))
    )
    cut_lines = F.coalesce(lines, F.array().cast("array<int>"))
    return out.select(
        "doc_id",
        "text",
        F.size(cut_lines).cast("long").alias("n_cut_lines"),
        F.array_join(cut_lines.cast("array<string>"), ",").alias("cut_lines"),
    )


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), read_model(MODEL_PATH))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), RULES)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("_fp")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, seed=2)
    return out.drop("n_exact")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transformed(table(spark, sf_dir, "documents"), seed=1)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


QUERIES = {
    "op1_quality_rules": op1,
    "op2_sharding": op2,
    "op3_pseudonyms": op3,
    "op4_line_dedup": op4,
    "op5_sentencepiece": op5,
    "op6_decontamination": op6,
    "op7_secret_scans": op7,
    "op8_url_filters": op8,
    "op9_simhash": op9,
    "op10_html_extraction": op10,
    "op11_centroid_clustering": op11,
    "op12_fill_in_middle": op12,
    "op13_quality_classifier": op13,
    "pipeline": corpus_pipeline.run,
}


def centroid_sql(k: int = 40, rounds: int = 5) -> str:
    """Each round assigns every vector to every centroid's nearest; all sums stay
    below 2**53, so doubles hold them exactly."""
    parts = [
        """v AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
            WHERE len(embedding) = 64 AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
        )""",
        f"""c0 AS (
            SELECT (row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), q) - 1)::INT AS cluster, q
            FROM v ORDER BY cluster LIMIT {k}
        )""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
            SELECT vec_id, v.q, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (
                SELECT v.vec_id, v.q, c.cluster,
                       list_inner_product(v.q, v.q) + list_inner_product(c.q, c.q) - 2 * list_inner_product(v.q, c.q) AS d
                FROM v, c{i} c
            ) v GROUP BY vec_id, v.q
        )"""
        )
        if i < rounds:
            parts.append(
                f"""m{i} AS (
            SELECT cluster, list(mean ORDER BY pos) AS q FROM (
                SELECT cluster, pos, floor(sum(x) / count(*)) AS mean
                FROM (SELECT cluster, unnest(range(64)) AS pos, unnest(q) AS x FROM a{i}) GROUP BY cluster, pos
            ) GROUP BY cluster
        ), c{i + 1} AS MATERIALIZED (
            SELECT cluster, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN m{i} m USING (cluster)
        )"""
            )
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, cluster, d::BIGINT AS distance,
               (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
               sha256(array_to_string([x::BIGINT FOR x IN c.q], ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} c USING (cluster)"""


ORACLES = {
    "op4_line_dedup": r"""
        WITH raw AS (
            SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL
        ), line AS (
            SELECT doc_id, unnest(range(len(l)))::INT AS pos, unnest(l) AS line FROM raw
        ), used AS (
            SELECT doc_id, pos, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS line,
                   len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
            FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
        ), place AS (
            SELECT *, row_number() OVER w AS k, sum(n) OVER w AS upto
            FROM used WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
        ), doc AS (
            SELECT doc_id, list(line ORDER BY k) AS lines, list(pos ORDER BY k) AS poss FROM place GROUP BY doc_id
        ), span AS (
            SELECT a.doc_id, a.k AS i, min(b.k) AS j FROM place a
            JOIN place b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.upto - a.upto + a.n >= 50 GROUP BY ALL
            UNION
            SELECT b.doc_id, max(a.k) AS i, b.k AS j FROM place b
            JOIN place a ON a.doc_id = b.doc_id AND a.k <= b.k AND b.upto - a.upto + a.n >= 50 GROUP BY ALL
        ), window_ AS (
            SELECT doc_id, poss[i] AS s, poss[j] AS e, lines[i:j] AS stretch FROM span JOIN doc USING (doc_id)
        ), later AS (
            SELECT doc_id, s, e FROM (
                SELECT *, row_number() OVER (PARTITION BY stretch ORDER BY doc_id, s) AS nth FROM window_
            ) WHERE nth > 1
        ), cut AS (
            SELECT doc_id, list(DISTINCT x ORDER BY x) AS cuts
            FROM (SELECT doc_id, unnest(range(s, e + 1))::INT AS x FROM later) GROUP BY doc_id
        ), kept AS (
            SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS left_
            FROM line ANTI JOIN (SELECT doc_id, unnest(cuts) AS pos FROM cut) USING (doc_id, pos) GROUP BY doc_id
        )
        SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.left_, '') END AS text,
               coalesce(len(c.cuts), 0)::BIGINT AS n_cut_lines,
               coalesce(array_to_string(c.cuts, ','), '') AS cut_lines
        FROM documents d LEFT JOIN cut c USING (doc_id) LEFT JOIN kept k USING (doc_id)
    """,
    "op6_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), item AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(
                [array_to_string(w[i : i + least(len(w), 10) - 1], ' ') FOR i IN range(1, greatest(len(w) - 10, 0) + 2)]
            ) AS gram FROM b WHERE len(w) > 0
        ), size AS (SELECT DISTINCT n FROM item), grams AS (
            SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos,
                   unnest([array_to_string(w[i : i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS gram
            FROM d, size WHERE len(w) >= n
        ), hit AS (SELECT doc_id, pos, n, item_id FROM grams JOIN item USING (n, gram)
        ), word AS (
            SELECT doc_id, count(DISTINCT pos) AS n_hit
            FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS pos FROM hit) GROUP BY doc_id
        ), ids AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
            FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
        )
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN word USING (doc_id) LEFT JOIN ids USING (doc_id)
    """,
    "op8_url_filters": r"""
        WITH p AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
                   html
            FROM pages
        ), r(verdict, rule_host, rule_path) AS (
            VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                   ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
        ), fit AS (
            SELECT page_id, arg_max(rule_host || rule_path, len(rule_host || rule_path)) AS rule,
                   arg_max(verdict, len(rule_host || rule_path)) AS verdict
            FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY page_id
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict,
               CASE WHEN rule IS NULL THEN 'default' ELSE 'rule' END AS via
        FROM p LEFT JOIN fit USING (page_id)
    """,
    "op11_centroid_clustering": centroid_sql(),
    "op12_fill_in_middle": r"""
        WITH unit AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t FROM documents
        ), drawn AS (
            SELECT *, len(t) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
                   ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM unit
        ), cut AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR h3 % 100 >= 90 THEN 'plain'
                        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
        ), part AS (
            SELECT *, array_to_string(t[1:a], '') AS p, array_to_string(t[a + 1:b], '') AS m,
                   array_to_string(t[b + 1:], '') AS s FROM cut
        )
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM part
    """,
}
