"""Key columns of entity tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.functions import text as t

KEY_COLUMNS = ("name_clean", "name_no_legal", "legal_form", "name_token_sorted_key", "first_token", "second_token", "address_clean", "street_number", "pincode", "domain_root")


def key_columns(df: DataFrame, name: str = "business_name", address: str = "business_address") -> DataFrame:
    """``df`` with all key columns.

    The cleaned name is a column of its own first, so its Python step runs
    once. The sorted key is that of the name without legal form, or of the
    clean name where nothing else is left.
    """
    clean, street, pin = t.address_keys(address)
    first = df.withColumns({"name_clean": t.clean_text(t.transliterate(t.remove_junk(name))), "address_clean": clean, "street_number": street, "pincode": pin, "domain_root": t.domain_root(name)})
    second = first.withColumns({"name_no_legal": t.without_legal_form("name_clean"), "legal_form": t.legal_form("name_clean")})
    t0, t1 = t.first_two_tokens("name_clean")
    bare = F.when(F.col("name_no_legal") != "", F.col("name_no_legal")).otherwise(F.col("name_clean"))
    out = second.withColumns({"name_token_sorted_key": t.token_sort_key(bare), "first_token": t0, "second_token": t1})
    return out.select(*df.columns, *[c for c in KEY_COLUMNS if c not in df.columns])


def ensure_keys(df: DataFrame, name: str = "business_name", address: str = "business_address", lenient: bool = False) -> DataFrame:
    """``df`` with those key columns added that it lacks.

    Without the raw columns they need, a missing key is an error, or with ``lenient`` null.
    """
    missing = [c for c in KEY_COLUMNS if c not in df.columns]
    if not missing:
        return df
    lacking = [c for c in (name, address) if c not in df.columns]
    if lacking and not lenient:
        raise ValueError(f"{missing} can't be derived without {lacking}")
    base = df.withColumns({c: F.lit(None).cast("string") for c in lacking})
    full = key_columns(base.drop(*[c for c in KEY_COLUMNS if c in df.columns]), name, address)
    kept = [F.col(c) for c in df.columns if c not in KEY_COLUMNS]
    if len(missing) == len(KEY_COLUMNS):
        return full.select(*kept, *KEY_COLUMNS)
    tagged = base.withColumns({f"_own_{c}": F.col(c) for c in KEY_COLUMNS if c in df.columns}).drop(*[c for c in KEY_COLUMNS if c in df.columns])
    again = key_columns(tagged, name, address)
    return again.select(*kept, *[(F.col(f"_own_{c}") if c in df.columns else F.col(c)).alias(c) for c in KEY_COLUMNS])


def metadata(df: DataFrame, entity_id: str, out_id: str, prefix: str) -> DataFrame:
    """Id and the six columns that pair features read, null as empty, each with a prefix."""
    source: dict[str, Column] = {
        "name_clean": F.coalesce(*[F.col(c) for c in ("name_no_legal", "name_clean", "business_name") if c in df.columns], F.lit("")) if "name_clean" not in df.columns else F.coalesce("name_clean", F.lit("")),
        **{c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("") for c in ("address_clean", "legal_form", "domain_root", "street_number", "pincode")},
    }
    return df.select(F.col(entity_id).alias(out_id), *[c.alias(prefix + n) for n, c in source.items()])


def pool(*sources: DataFrame) -> DataFrame:
    """S2 and S3 as one table with ``source_type`` 2 and 3, over the columns they share."""
    shared = [c for c in sources[0].columns if all(c in s.columns for s in sources)]
    out = None
    for number, source in enumerate(sources, 2):
        part = source.select(*shared).withColumn("source_type", F.lit(number))
        out = part if out is None else out.unionByName(part)
    return out
