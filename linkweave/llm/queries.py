"""The registered queries: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm import chat, decontaminate, fingerprints, mixing, neardup, repeats, secrets, sharding, toxicity, urlfilter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(_table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return toxicity.scored(documents, toxicity.fitted(documents, _table(spark, sf_dir, "labels")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicate_classes(_table(spark, sf_dir, "documents"), radius=4, words=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return urlfilter.judged(_table(spark, sf_dir, "pages"), rules)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.narrow(_table(spark, sf_dir, "documents"))
    return sharding.sharded(rows, shards=8, checksum="text_crc32").withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixture(mixing.narrow(_table(spark, sf_dir, "documents")), size="size", digest="digest")
    return rows.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed(_table(spark, sf_dir, "documents"), length=400).drop("text_key")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(_table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (op1_fingerprints, op2_secrets, op3_toxicity, op4_simhash, op5_url_rules, op6_sharding, op7_mixing, op8_repeats, op9_decontamination, op10_chat)
}

_HOST_PATH = r"""
    SELECT page_id, CASE WHEN pos = 0 THEN '' ELSE translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS host,
           CASE WHEN pos = 0 THEN '' ELSE regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) END AS path
    FROM (SELECT page_id, strpos(coalesce(url, ''), '://') AS pos, substring(coalesce(url, ''), strpos(coalesce(url, ''), '://') + 3) AS rest FROM pages)
"""



def _sql_spans(kind: str, place: int) -> str:
    pattern, group, least, role, weak = secrets.KINDS[kind]
    p = "'" + pattern.replace("'", "''") + "'"
    return (
        f"SELECT r, '{kind}' AS kind, {place} AS place, '{role}' AS role, {weak} AS weak, length(g) >= {least} AS ok, length(m) AS size, sum(length(gap) + length(m)) OVER (PARTITION BY r ORDER BY i) AS stop "
        f"FROM (SELECT r, unnest(ms) AS m, unnest(gs) AS g, unnest(gaps[1:len(ms)]) AS gap, unnest(range(len(ms))) AS i FROM (SELECT r, regexp_extract_all(t, {p}, 0) AS ms, regexp_extract_all(t, {p}, {group}) AS gs, string_split_regex(t, {p}) AS gaps FROM d))"
    )


_SQL_LISTED = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place, stop, kind)"

ORACLES = {
    "op2_secrets": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
every AS (SELECT r, kind, place, role, weak, (stop - size)::BIGINT AS start, stop::BIGINT AS stop FROM ({" UNION ALL ".join(_sql_spans(k, i) for i, k in enumerate(secrets.KINDS))}) WHERE ok),
linked AS (
    SELECT * FROM every a WHERE weak AND EXISTS (
        SELECT 1 FROM every b WHERE a.r = b.r AND greatest(b.start - a.stop, a.start - b.stop) BETWEEN 0 AND {secrets.SCOPE}
            AND ((a.role = 'secret' AND b.role IN ('identifier', 'endpoint')) OR (a.role IN ('identifier', 'endpoint') AND b.role = 'secret'))
    )
),
base AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, {_SQL_LISTED} AS listed FROM every WHERE NOT weak GROUP BY r),
spans AS (SELECT r, {_SQL_LISTED} AS listed, count(*) FILTER (weak) AS n_linked FROM (SELECT * FROM every WHERE NOT weak UNION ALL SELECT * FROM linked) GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base.listed, '')) AS base_sha256,
       coalesce(spans.listed, '') AS spans, coalesce(n_linked, 0)::BIGINT AS n_linked
FROM d LEFT JOIN base USING (r) LEFT JOIN spans USING (r)
""",
    "op5_url_rules": f"""
WITH p AS ({_HOST_PATH}),
rules(h, q, v) AS (VALUES {", ".join(str(r) for r in RULES)}),
fit AS (
    SELECT page_id, h || q AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h || q) DESC, length(h) DESC, v) AS k
    FROM p JOIN rules ON (host = h OR host LIKE '%.' || h) AND starts_with(path, q)
)
SELECT p.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN fit ON p.page_id = fit.page_id AND k = 1
""",
    "op7_mixing": r"""
WITH d AS (
    SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, source_size * 3.0::DOUBLE AS cap FROM s),
l AS (
    SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
    FROM w
),
t AS (
    SELECT source, source_size, CASE WHEN f.level IS NULL THEN cap ELSE least(cap, f.level * weight) END AS target
    FROM l LEFT JOIN (SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1) f ON true
),
r AS (
    SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
        ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS draw
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
),
c AS (SELECT *, (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM r)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
""",
    "op8_repeats": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT r, p, md5(substr(h, 2 * p + 1, 800)) AS g FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 399)) AS p FROM d)),
hit AS (SELECT r, p FROM s SEMI JOIN (SELECT g FROM s GROUP BY g HAVING count(*) > 1) USING (g)),
cut AS (SELECT r, p, sum(CASE WHEN p - before <= 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS run FROM (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM hit)),
runs AS (SELECT r, min(p) AS lo, max(p) + 400 AS hi FROM cut GROUP BY r, run),
gaps AS (SELECT r, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS since FROM runs),
kept AS (SELECT r, sum(hi - lo)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, max(hi) AS tail, string_agg(substr(h, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) AS head FROM gaps JOIN d USING (r) GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN tail IS NULL THEN h ELSE head || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
""",
    "op9_decontamination": r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
),
win AS (
    SELECT DISTINCT item_id, least(10, len(words)) AS n, array_to_string(words[i : i + least(10, len(words)) - 1], ' ') AS phrase
    FROM (SELECT item_id, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM b WHERE len(words) > 0)
),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM w, sizes),
occ AS (SELECT doc_id, i, i + pos.n AS j, item_id FROM pos JOIN win ON win.n = pos.n AND win.phrase = array_to_string(words[i : i + pos.n - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, j)) AS k FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM occ) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
""",
    "op10_chat": r"""
WITH t AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n FROM conversations
),
p AS (
    SELECT conv_id, n, md5(string_agg(coalesce(length(role)::VARCHAR || ':' || role, '-') || '|' || coalesce(length(text)::VARCHAR || ':' || text, '-'), '|') OVER (PARTITION BY conv_id ORDER BY n)) AS name FROM t
),
f AS (SELECT conv_id, max(n) AS n, arg_max(name, n) AS name FROM p GROUP BY conv_id),
k AS (SELECT name, min(conv_id) AS kept_id FROM f GROUP BY name),
proper AS (SELECT DISTINCT p.name FROM p JOIN f USING (conv_id) WHERE p.n < f.n),
s AS (
    SELECT f.conv_id, f.n AS n_turns, CASE WHEN proper.name IS NOT NULL THEN 'prefix' WHEN f.conv_id = k.kept_id THEN 'kept' ELSE 'copy' END AS state, k.kept_id
    FROM f JOIN k USING (name) LEFT JOIN proper USING (name)
),
c AS (SELECT conv_id, string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10), '' ORDER BY n) AS chat FROM t GROUP BY conv_id)
SELECT s.conv_id, n_turns, state, CASE WHEN state <> 'prefix' THEN kept_id END AS kept_id, CASE WHEN state = 'kept' THEN chat END AS chat FROM s JOIN c USING (conv_id)
""",
}
__all__ = ["ORACLES", "QUERIES"]
