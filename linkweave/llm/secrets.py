"""Secret scans with multipart credential linking, in SQL functions only.

Strong patterns (assignments, access identifiers, long hex runs) are reported
by themselves. Weak ones - names of accounts, short or unnamed secrets,
endpoints - are common in clean text, so one is reported only if a part that
complements it lies in its scope: an identifier needs a secret, a secret an
identifier or endpoint, an endpoint a secret. Parts meet in an interval join on
document and scope bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import written

#: kind: (pattern, group that a length is asked of, least length, role, weak). Kinds are listed in the order of equal starts.
KINDS: dict[str, tuple[str, int, int, str, bool]] = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, "secret", False),
    "access": (r"AKIA[A-Z0-9]+", 0, 20, "identifier", False),
    "hex": (r"[0-9a-f]{24,}", 0, 24, "secret", False),
    "identifier": (r"""(?i)\b(?:user(?:_?name|_?id)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.-]+)""", 1, 3, "identifier", True),
    "secret": (r"""(?i)\b(?:pwd|pass|passphrase|auth|bearer|credentials?|private_?key)["']?\x20*[:=]?\x20*["']?([A-Za-z0-9+/_.=-]*[0-9][A-Za-z0-9+/_.=-]*)""", 1, 4, "secret", True),
    "endpoint": (r"""(?i)\b(?:https?|s?ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://([^\x00-\x20"'<>]+)""", 1, 4, "endpoint", True),
}
#: Code points that may lie between two parts of one credential.
SCOPE = 200
#: Matches whose positions are summed together.
BLOCK = 64
_SPAN = "struct<kind:string,place:int,start:bigint,stop:bigint>"


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def spans(text: Column, kind: str, place: int) -> Column:
    """Spans of one kind, code points, leftmost and non-overlapping, matches that are too short dropped after matching.

    The text split at the matches gives what lies between them; running sums
    of both lengths are the positions. They are summed by blocks of matches
    first, so a text of n matches takes some n * BLOCK steps and not n * n.
    """
    pattern, group, least, _, _ = KINDS[kind]
    p = F.lit(pattern)
    parts = F.arrays_zip(F.split(text, pattern).alias("p"), F.regexp_extract_all(text, p, 0).alias("m"), F.regexp_extract_all(text, p, group).alias("g"))
    sizes = F.transform(parts, lambda x: F.struct(F.length(x["p"]).cast("long").alias("gap"), F.coalesce(F.length(x["m"]), F.lit(0)).cast("long").alias("match"), F.coalesce(F.length(x["g"]) >= least, F.lit(False)).alias("ok")))
    none, zero = F.expr(f"CAST(array() AS array<{_SPAN}>)"), F.lit(0).cast("long")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        stop = start + x["match"]
        one = F.struct(F.lit(kind).alias("kind"), F.lit(place).alias("place"), start.alias("start"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.when(x["ok"], F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    def placed(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda acc, x: acc + x["gap"] + x["match"]))
        first = F.struct(zero.alias("at"), F.expr("CAST(array() AS array<bigint>)").alias("out"))
        starts = F.aggregate(totals, first, lambda acc, t: F.struct((acc["at"] + t).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), starts.alias("s")), lambda z: F.aggregate(z["b"], F.struct(z["s"].alias("at"), none.alias("out")), step, lambda acc: acc["out"])))

    cut = _bound(sizes, lambda s: F.transform(F.sequence(F.lit(0), F.ceil(F.size(s) / BLOCK).cast("int") - 1), lambda i: F.slice(s, i * BLOCK + 1, F.lit(BLOCK))))
    return F.when(text.rlike(pattern), _bound(cut, placed)).otherwise(none)


def _listed(column: str) -> Column:
    """kind:start:end, comma-joined, by start, then kind as listed, then end."""
    key = F.transform(F.col(column), lambda x: F.struct(x["start"], x["place"], x["stop"], x["kind"]))
    return F.array_join(F.transform(F.array_sort(key), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def linked_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak rows of ``parts`` with a complementary row at most ``scope`` code points away.

    ``parts`` has doc_id, text_key, kind, place, role, weak, start and stop.
    Both sides are cut into buckets of ``scope``, so the join is one of equal
    keys and its rows are bounded by what fits into neighbouring buckets.
    """
    buckets = lambda lo, hi: F.explode(F.sequence(F.floor(lo / scope), F.floor(hi / scope)))
    left = parts.where("weak").withColumn("bucket", buckets(F.col("start"), F.col("stop")))
    roles = parts.select("doc_id", "text_key", F.col("role").alias("o_role"), F.col("start").alias("o_start"), F.col("stop").alias("o_stop"))
    right = roles.withColumn("bucket", buckets(F.col("o_start") - scope, F.col("o_stop") + scope))
    complements = ((F.col("role") == "secret") & F.col("o_role").isin("identifier", "endpoint")) | (F.col("role").isin("identifier", "endpoint") & (F.col("o_role") == "secret"))
    apart = F.greatest(F.col("o_start") - F.col("stop"), F.col("start") - F.col("o_stop"))
    right = right.withColumnsRenamed({"doc_id": "o_id", "text_key": "o_key", "bucket": "o_bucket"})
    same = F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("text_key") == F.col("o_key")) & (F.col("bucket") == F.col("o_bucket"))
    # Parts that overlap are one token read twice; they are not two parts.
    return left.join(right, same & complements & (apart >= 0) & (apart <= scope), "left_semi").drop("bucket").distinct()


def scanned(documents: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row for each document: doc_id, text_key, ``base`` and ``linked`` arrays of spans (kind, place, start, stop).

    Null texts are empty; repeated rows have the same spans each; a text
    without secrets has empty arrays.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    columns = {k: spans(F.col("text"), k, i) for i, k in enumerate(KINDS)}
    strong = [k for k, v in KINDS.items() if not v[4]]
    weak = [k for k, v in KINDS.items() if v[4]]
    found = rows.select("doc_id", F.md5("text").alias("text_key"), *[c.alias(k) for k, c in columns.items()])
    found = written(found.select("doc_id", "text_key", *strong, F.concat(*strong).alias("base"), F.concat(*weak).alias("weak")), "spans")

    role = F.create_map(*[F.lit(x) for k, v in KINDS.items() for x in (k, v[3])])
    several = found.where((F.size("weak") > 0) & (F.size("weak") + F.size("base") > 1))
    parts = several.select("doc_id", "text_key", F.explode(F.concat("base", "weak")).alias("x")).distinct().select("doc_id", "text_key", "x.*")
    parts = parts.withColumns({"role": role[F.col("kind")], "weak": F.col("kind").isin(*weak)})
    links = linked_parts(parts, scope).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("kind", "place", "start", "stop")).alias("linked"))
    right = links.withColumnsRenamed({"doc_id": "i", "text_key": "t"})
    joined = found.join(right, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("t")), "left")
    return joined.select("doc_id", "text_key", *strong, "base", F.coalesce("linked", F.expr(f"CAST(array() AS array<{_SPAN}>)")).alias("linked"))


def secret_report(documents: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text.

    A row for each document: null and empty texts have none, repeated rows the
    same each, and an empty table gives no rows. Columns other than doc_id and
    text don't matter.
    """
    return scanned(documents, scope).withColumn("every", F.concat("base", "linked")).select(
        "doc_id", F.size("assign").cast("long").alias("n_assign"), F.size("access").cast("long").alias("n_access"), F.size("hex").cast("long").alias("n_hex"),
        F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("every").alias("spans"), F.size("linked").cast("long").alias("n_linked"),
    )
