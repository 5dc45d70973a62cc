"""Entity views over the test tables: documents as business records.

A document's name is its first line, its address its length and source, its
country its language. Exact copies of a text are the truth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.functions.fixed import DOMAIN_ENDINGS, MAIL_DOMAINS
from linkweave.functions.text import clean_text
from linkweave.operators.keys import key_columns
from linkweave.sources.scratch import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, business_name, business_address, country, text_key and source_type 1, 2 or 3."""
    kind = F.pmod(F.col("doc_id"), F.lit(10))
    number = F.when(kind < 4, 1).when(kind < 7, 2).otherwise(3)
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("S"), number.cast("string"), F.lit("-"), F.lpad(F.col("doc_id").cast("string"), 10, "0")).alias("entity_id"),
        F.trim(F.substring_index("text", "\n", 1)).alias("business_name"), F.concat_ws(" ", F.col("n_chars").cast("string"), "source").alias("business_address"),
        F.col("lang").alias("country"), F.md5("text").alias("text_key"), number.alias("source_type"),
    )


def sides(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S1 and the pool."""
    return df.where("source_type = 1"), df.where("source_type > 1")


def dealt(df: DataFrame) -> DataFrame:
    """The narrow rows of entities over all tasks of a shuffle: the test tables are one row group each, which one task reads."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "entity_id")


def keyed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Keyed S1 and pool, written once: the channels read them many times."""
    return sides(written(key_columns(dealt(entities(spark, sf_dir))), "keyed"))


def keyed_alike(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``keyed`` without the rows whose raw name no row of the other side has in their country: those have no pair of equal names, and no key is made for them."""
    rows, on = written(entities(spark, sf_dir).where("country IS NOT NULL AND business_name IS NOT NULL"), "entities"), ["country", "business_name"]
    both = rows.groupBy(*on).agg(F.min("source_type").alias("least"), F.max("source_type").alias("most")).where("least = 1 AND most > 1").select(*on)
    return sides(written(key_columns(dealt(rows.join(both, on, "left_semi"))), "keyed"))


def names_no_legal(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """S1 and pool as (id, part, text) for a query that reads each once: no other key is made, and nothing is written."""
    rows = key_columns(dealt(entities(spark, sf_dir)))
    return tuple(x.select(F.col("entity_id").alias("id"), F.col("country").alias("part"), F.col("name_no_legal").alias("text")) for x in sides(rows))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, cand_id) of equal texts."""
    s1, pool = sides(entities(spark, sf_dir))
    return s1.select(F.col("entity_id").alias("s1_id"), "text_key").join(pool.select(F.col("entity_id").alias("cand_id"), "text_key"), "text_key").select("s1_id", "cand_id")


def s1_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sides(entities(spark, sf_dir))[0].select(F.col("entity_id").alias("s1_id"))


#: Pairs of one name that one task makes, about; tasks that make pairs for each partition of a shuffle; and the columns by which pairs lie.
PAIRS_EACH, TASKS_EACH, DEALT = 1 << 19, 4, ("name_key", "deal")


def dealt_pairs(spark: SparkSession, sf_dir: str, each: str = "s1_id") -> DataFrame:
    """(s1_id, cand_id, name_key, deal): pairs of equal raw names within a country, all those of one ``each`` (s1_id or cand_id) in one task.

    ``each`` decides DEALT, by which the pairs are partitioned, so windows over it and
    DEALT move no pair. A frequent name is parted by a hash of ``each``, as often as its
    pairs are many, and meets the other side once in each part. Names are compared by digest.
    """
    key = F.unhex(F.md5(F.concat(F.length("country").cast("string"), F.lit(":"), "country", "business_name")))
    rows = entities(spark, sf_dir).select("entity_id", key.alias("name_key"), "source_type").where("name_key IS NOT NULL")
    rows = written(rows, "names")
    one, two = F.count_if(F.col("source_type") == 1), F.count_if(F.col("source_type") > 1)
    sizes = rows.groupBy("name_key").agg(one.alias("n1"), two.alias("n2")).where("n1 > 0 AND n2 > 0")
    held = F.col("n1" if each == "s1_id" else "n2")
    sizes = sizes.select("name_key", F.least(F.ceil(F.col("n1") * F.col("n2") / PAIRS_EACH), held).cast("int").alias("deals"))
    s1, pool = (x.select(F.col("entity_id").alias(i), "name_key").join(sizes, "name_key") for x, i in zip(sides(rows), ("s1_id", "cand_id"), strict=True))
    left, right = (s1, pool) if each == "s1_id" else (pool, s1)
    left = left.withColumn("deal", F.expr(f"CAST(pmod(xxhash64({each}), deals) AS INT)")).drop("deals")
    right = right.withColumn("deal", F.explode(F.expr("sequence(0, deals - 1)"))).drop("deals")
    # Numbers of partitions are given, since the sides are small where the pairs are many.
    tasks = TASKS_EACH * int(spark.conf.get("spark.sql.shuffle.partitions"))
    left, right = (x.repartition(tasks, *DEALT) for x in (left, right))
    return left.join(right.hint("merge"), [*DEALT]).select("s1_id", "cand_id", *DEALT)


def name_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, cand_id) of equal raw names within a country."""
    return dealt_pairs(spark, sf_dir).select("s1_id", "cand_id")


def dealt_scores(spark: SparkSession, sf_dir: str, each: str = "s1_id") -> DataFrame:
    """``scored_pairs`` with the columns DEALT."""
    bucket = F.conv(F.substring(F.md5(F.concat_ws("|", "s1_id", "cand_id")), 1, 8), 16, 10).cast("long") % 10_000
    return dealt_pairs(spark, sf_dir, each).withColumn("p", bucket / F.lit(10_000.0))


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name pairs with a score that a hash of the pair decides."""
    return dealt_scores(spark, sf_dir).select("s1_id", "cand_id", "p")


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct cleaned part names, split into two sides by brand, for string scores."""
    return table(spark, sf_dir, "part").select(clean_text("p_name").alias("name"), F.col("p_brand").alias("brand")).distinct()


# The same views in SQL.
def sql_junk(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({c}, '--+|<<+|>>+|\[|\]|\(|\)|\+|\*\*+|##+|==+|~~+|//+', ' ', 'g'), '\s+', ' ', 'g'))"


def sql_clean(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(strip_accents(replace(lower({c}), '&', ' and ')), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))"


_LEGAL = r"pvt\s+ltd|private\s+limited|pvt\s+limited|private\s+ltd|corp|corporation|pvt|private|ltd|limited|llc|llp|inc|incorporated|sarl|sas|sci|gmbh|co|company"


def sql_no_legal(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '\b({_LEGAL})\b', ' ', 'g'), '\b(and|&)\s*$', ' ', 'g'), '^\s*(and|&)\b', ' ', 'g'), '\s+', ' ', 'g'))"


def sql_tokens(c: str, least: int = 1) -> str:
    return f"list_filter(string_split({c}, ' '), lambda t: length(t) >= {least})"


SQL_ENT = """ent AS (
    SELECT 'S' || kind || '-' || lpad(doc_id::VARCHAR, 10, '0') AS entity_id, trim(split_part(text, chr(10), 1)) AS business_name, concat_ws(' ', n_chars::VARCHAR, source) AS business_address,
        lang AS country, md5(text) AS text_key, kind AS source_type
    FROM (SELECT *, CASE WHEN doc_id % 10 < 4 THEN 1 WHEN doc_id % 10 < 7 THEN 2 ELSE 3 END AS kind FROM documents)
)"""

SQL_KEYED = f"""{SQL_ENT},
c AS (
    SELECT *, {sql_clean(sql_junk("business_name"))} AS name_clean, {sql_clean(sql_junk("business_address"))} AS address_clean,
        nullif(regexp_extract(business_address, '\\b(\\d{{1,5}})\\b', 1), '') AS street_number,
        lower(nullif(regexp_extract(business_name, '(?:https?://)?(?:www\\.)?([a-zA-Z0-9-]+)\\.(?:{DOMAIN_ENDINGS})\\b', 1), '')) AS domain
    FROM ent
),
n AS (SELECT *, {sql_no_legal("name_clean")} AS name_no_legal FROM c),
k AS (
    SELECT *, array_to_string(list_sort({sql_tokens("CASE WHEN name_no_legal <> '' THEN name_no_legal ELSE name_clean END")}), ' ') AS name_token_sorted_key,
        {sql_tokens("name_clean", 3)}[1] AS first_token, {sql_tokens("name_clean", 3)}[2] AS second_token,
        CASE WHEN domain NOT IN ({", ".join(f"'{m}'" for m in sorted(MAIL_DOMAINS))}) THEN domain END AS domain_root
    FROM n
)"""

SQL_TRUTH = f"""{SQL_ENT},
s1 AS (SELECT entity_id AS s1_id FROM ent WHERE source_type = 1),
gt AS (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id FROM ent a JOIN ent b ON a.text_key = b.text_key WHERE a.source_type = 1 AND b.source_type > 1)"""

SQL_SCORED = f"""{SQL_TRUTH},
pairs AS (
    SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, ('0x' || substr(md5(a.entity_id || '|' || b.entity_id), 1, 8))::BIGINT % 10000 / 10000.0::DOUBLE AS p
    FROM ent a JOIN ent b ON a.country = b.country AND a.business_name = b.business_name WHERE a.source_type = 1 AND b.source_type > 1
)"""


def sql_scores(predictions: str, by: str = "") -> str:
    """CTEs ``sizes`` and ``e``, an entity's scores, from a table of (by, s1_id, cand_id)."""
    group = f"{by}, " if by else ""
    base = f"(SELECT s1_id, {by} FROM s1, taus)" if by else "s1"
    return f"""
hits AS (SELECT {group}p.s1_id, count(*) AS n_pred, count(g.s1_id) AS tp FROM (SELECT DISTINCT {group}s1_id, cand_id FROM {predictions}) p LEFT JOIN (SELECT DISTINCT * FROM gt) g ON p.s1_id = g.s1_id AND p.cand_id = g.cand_id GROUP BY {group}p.s1_id),
sizes AS (SELECT s1_id, count(DISTINCT cand_id) AS n_true FROM gt GROUP BY s1_id),
counts AS (SELECT {group}s1_id, coalesce(n_true, 0) AS n_true, coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp FROM {base} LEFT JOIN sizes USING (s1_id) LEFT JOIN hits USING ({group}s1_id)),
e AS (
    SELECT *, CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_pred) * (tp / n_true) / (0.25 * (tp / n_pred) + tp / n_true) END AS f05,
        CASE WHEN n_true = 0 AND n_pred > 0 THEN 0.0 WHEN n_pred = 0 THEN 1.0 ELSE tp / n_pred END AS precision,
        CASE WHEN n_true = 0 THEN 1.0 ELSE tp / n_true END AS recall,
        CASE WHEN n_true = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 1.25 * (tp / n_true) / (0.25 + tp / n_true) END AS ceiling
    FROM counts
)"""


def sql_metrics(by: str = "") -> str:
    group = f"{by}, " if by else ""
    return f"""
SELECT {group}round(avg(f05), 5) AS f05_macro, round(avg(ceiling), 5) AS f05_ceiling, round(coalesce(avg(precision) FILTER (n_true > 0), 1.0), 5) AS precision_macro,
    round(coalesce(avg(recall) FILTER (n_true > 0), 1.0), 5) AS recall_macro, round(coalesce(avg((n_pred = 0)::INT) FILTER (n_true = 0), 1.0), 5) AS singleton_accuracy,
    round(coalesce(avg(f05) FILTER (n_true > 0), 0.0), 5) AS non_singleton_f05, round(coalesce(sum(tp) / nullif(sum(n_true), 0), 1.0), 5) AS candidate_recall,
    count(*) AS total_entities, count(*) FILTER (n_true = 0) AS num_singletons, count(*) FILTER (n_true > 0) AS num_non_singletons
FROM e {f"GROUP BY {by}" if by else ""}"""
