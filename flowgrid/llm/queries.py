"""The registered queries of the corpus operators, next to their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgrid.llm import decontaminate, dual_tree, hash_ring, host_reputation, maxscore, nb_svm, pii_disclosure, pruned_graph, repair_agenda, secret_scan, simhash, spm_bpe, suffix_buckets
from flowgrid.llm.common import ship, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


# Fixed values of the contract.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
         ("net/fr/", "block"))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled page outcomes: the label with the page's number; low quality or toxic counts as bad."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))


def _rules_sql() -> str:
    rows = ", ".join(f"('{r}', '{v}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for r, v in RULES)
    return f"(VALUES {rows}) r(rule, verdict, rule_host, rule_path)"


def _strength_sql(units: str) -> str:
    return (f"(SELECT CASE WHEN sum(n) > 0 AND sum(n * (n - 1)) > 0 AND m2 - mu * mu > 0 "
            f"THEN least(greatest((mu - m2) / (m2 - mu * mu), 1.0), 1000.0) ELSE 1000.0 END "
            f"FROM {units}, (SELECT sum(k)::DOUBLE / sum(n)::DOUBLE AS mu, "
            f"sum(k * (k - 1))::DOUBLE / sum(n * (n - 1))::DOUBLE AS m2 FROM {units}) GROUP BY mu, m2)")


@query("op1_latent_decontamination")
def op1_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents: one row for each document and benchmark item that it holds."""
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("cosine", 4).alias("cosine"), F.round("lcs", 4).alias("lcs"),
                        F.round("answer", 4).alias("answer"), "kind")


@query("op2_host_reputation", f"""
    WITH bad AS (SELECT doc_id AS page_id, max((quality = 0 OR toxic = 1)::INT) AS bad FROM labels
                 WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY 1),
    parts AS (SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '') AS host,
              coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    hosts AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS k,
              regexp_extract(host, '([^.]*\\.)?[^.]*$', 0) AS domain, regexp_extract(host, '[^.]*$', 0) AS suffix
              FROM parts LEFT JOIN bad USING (page_id) GROUP BY host),
    sx AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY suffix),
    dm AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
    s AS (SELECT (SELECT coalesce(sum(k)::DOUBLE / nullif(sum(n), 0)::DOUBLE, 0.0) FROM hosts) AS base,
          {_strength_sql('sx')} AS s1, {_strength_sql('(SELECT domain, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY 1)')} AS s2,
          {_strength_sql('hosts')} AS s3),
    ps AS (SELECT suffix, (k + s1 * base) / (n + s1) AS p_suffix FROM sx, s),
    pd AS (SELECT domain, (k + s2 * p_suffix) / (n + s2) AS p_domain FROM dm JOIN ps USING (suffix), s),
    ph AS (SELECT host, (k + s3 * p_domain) / (n + s3) AS mean, n + s3 AS size FROM hosts JOIN pd USING (domain), s),
    verdicts AS (SELECT host, CASE WHEN mean - 1.645 * sqrt(mean * (1.0 - mean) / (size + 1.0)) > 0.3 THEN 'block'
                 ELSE 'allow' END AS by_host FROM ph),
    fits AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(r.verdict, length(rule)) AS verdict
             FROM (SELECT DISTINCT host, path FROM parts) p JOIN {_rules_sql()}
             ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY ALL)
    SELECT page_id, host, path, rule, coalesce(fits.verdict, by_host) AS verdict
    FROM parts JOIN verdicts USING (host) LEFT JOIN fits USING (host, path)""")
def op2_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_reputation.judge(table(spark, sf_dir, "pages"), outcomes(spark, sf_dir), RULES)


@query("op3_simhash_vp")
def op3_simhash_vp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


@query("op4_bucket_refinement")
def op4_bucket_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_buckets.digests(table(spark, sf_dir, "documents"))


@query("op5_markov_secrets")
def op5_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(table(spark, sf_dir, "documents"))


@query("op6_nb_svm")
def op6_nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    scored = nb_svm.score(docs, nb_svm.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(nb_svm.remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
                         F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.7).cast("int").alias("predicted"))


@query("op7_bounded_ring")
def op7_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hash_ring.place(table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op8_spm_bpe")
def op8_spm_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return spm_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                           public_tokenizers.PATTERN)


@query("op9_disclosure_pii")
def op9_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_disclosure.digests(table(spark, sf_dir, "documents"))


@query("op10_maxscore", """
    WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS x FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
               AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, max(list_inner_product(q.x, c.x))::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id GROUP BY ALL)
    SELECT query_id, rank::INT AS rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20""")
def op10_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"))


STEPS = "(VALUES ('B', 's', 'S'), ('B', 'u', 'U'), ('S', 'u', 'U'), ('A', 'u', 'U'), ('U', 'a', 'A')) step(q, initial, nq)"
INSERTS = ("(VALUES ('B', 'B', 0, '', ''), ('S', 'S', 0, '', ''), ('U', 'U', 0, '', ''), ('A', 'A', 0, '', ''), "
           + ", ".join(f"('{q}', 'U', 5, 'I', '\nuser:'), ('{q}', 'A', 10, 'II', '\nuser:\nassistant:')" for q in "BSA")
           + ", ('U', 'A', 5, 'I', '\nassistant:'), ('U', 'U', 10, 'II', '\nassistant:\nuser:')) ins(q, nq, c, e, t)")
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query("op11_repair_agenda", f"""
    WITH RECURSIVE bits AS (SELECT k, 0 AS i, k AS v FROM (SELECT unnest(range(256)) AS k) UNION ALL
      SELECT k, i + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE i < 8),
    crc AS (SELECT list(v ORDER BY k) AS lut FROM bits WHERE i = 8),
    keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        [ascii(x) FOR x IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')] AS key FROM conversations),
    how AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, key), lambda a, b: xor(a // 256, lut[1 + xor(a % 256, b)])),
        4294967295) % 20 AS how FROM keyed, crc),
    dmg AS (SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
        CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN how = 3 THEN 2 ELSE 1 END)) FROM how WHERE how <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role || ':' || text) AS i FROM dmg),
    seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
        rtrim(text, {SPACES}) AS rest, role[1] AS initial FROM placed),
    r AS MATERIALIZED (SELECT *, CASE WHEN rest = '' THEN 'blank' WHEN seen THEN 'duplicate'
        WHEN right(rest, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS odd FROM seen),
    edits AS MATERIALIZED (
      SELECT conv_id, i, q, q AS nq, 2 AS c, 'D' AS e, '' AS t FROM r, (VALUES ('A'), ('B'), ('S'), ('U')) s(q)
      UNION ALL SELECT conv_id, i, q, nq, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K', chr(10) || role || ':' || text
        FROM r JOIN {STEPS} ON step.initial = r.initial WHERE fault NOT IN ('blank', 'duplicate')
      UNION ALL SELECT conv_id, i, q, nq, CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, 'R',
        chr(10) || CASE step.initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text
        FROM r JOIN {STEPS} ON step.initial <> r.initial AND step.initial <> 's' WHERE fault NOT IN ('blank', 'duplicate')),
    moves AS MATERIALIZED (SELECT conv_id, i, ins.q, edits.nq, ins.c + edits.c AS c, ins.e || edits.e AS e, ins.t || edits.t AS t
      FROM edits JOIN {INSERTS} ON ins.nq = edits.q),
    n AS (SELECT conv_id, max(i) AS n, sum((fault = 'blank')::BIGINT)::BIGINT AS blank, sum((fault = 'duplicate')::BIGINT)::BIGINT AS duplicate,
      sum((fault = 'truncated')::BIGINT)::BIGINT AS truncated, coalesce(sum(odd::BIGINT), 0)::BIGINT AS illegal,
      coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps FROM r GROUP BY conv_id),
    st AS (SELECT conv_id, 0::BIGINT AS i, 'B' AS q, {{'c': 0, 'e': '', 't': ''}} AS best FROM n UNION ALL
      SELECT st.conv_id, m.i, m.nq, min({{'c': best.c + m.c, 'e': best.e || m.e, 't': best.t || m.t}})
      FROM st JOIN moves m ON m.conv_id IS NOT DISTINCT FROM st.conv_id AND m.i = st.i + 1 AND m.q = st.q GROUP BY ALL),
    done AS (SELECT st.conv_id, min({{'c': best.c + c, 'e': best.e || e, 't': best.t || t}}) AS best FROM st
      JOIN n ON n.conv_id IS NOT DISTINCT FROM st.conv_id AND n.n = st.i JOIN {INSERTS} ON ins.q = st.q AND ins.nq IN ('A', 'B') GROUP BY 1)
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.e, '') AS audit,
      sha256(coalesce(best.t[2:], '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id""")
def op11_repair_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_agenda.repaired(table(spark, sf_dir, "conversations"))


@query("op12_pruned_graph")
def op12_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pruned_graph.top_k(table(spark, sf_dir, "embeddings"))


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms_sql(columns: str, source: str) -> str:
    return (f"SELECT {columns}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            f"'{TERM}') AS terms FROM {source} WHERE text IS NOT NULL")


@query("op13_dual_tree", f"""
    WITH d AS MATERIALIZED (SELECT *, len(terms) AS n FROM (
      {_terms_sql('r, doc_id', '(SELECT row_number() OVER () AS r, doc_id, text FROM documents)')}) WHERE len(terms) > 0),
    q AS MATERIALIZED (SELECT DISTINCT item_id, unnest(terms) AS term FROM ({_terms_sql('item_id', 'benchmark')})),
    s AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS ld FROM d),
    tf AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d)
      WHERE term IN (SELECT term FROM q) GROUP BY ALL),
    w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
    x AS (SELECT d.r, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // ld)) AS x
      FROM tf JOIN d ON d.r = tf.r, s),
    scores AS (SELECT item_id, r, doc_id, sum(w * x)::BIGINT AS score FROM q JOIN w ON w.term = q.term JOIN x ON x.term = q.term GROUP BY ALL)
    SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (
      PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0) WHERE rank <= 10""")
def op13_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.top_k(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
