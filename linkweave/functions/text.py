"""Normalization of names and addresses, as column expressions.

Regular expressions read letters, digits and word bounds as Unicode does
(``(?U)``). Python runs only for rows that need it: decomposition of non-ASCII
text and Devanagari; other rows go to it as null.
"""

from __future__ import annotations

import string
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkweave.functions.fixed import (
    BASELINE_SUFFIXES,
    BLOCKING_SUFFIXES,
    BUSINESS_SUFFIXES,
    DEVANAGARI_LETTERS,
    DEVANAGARI_WORDS,
    DOMAIN_ENDINGS,
    DOMAIN_ENDINGS_SHORT,
    FEATURE_SUFFIXES,
    LEGAL_FORMS,
    LEGAL_WORDS,
    MAIL_DOMAINS,
    PROFILED_SUFFIXES,
)

_DEVANAGARI = str.maketrans({k: v for k, v in DEVANAGARI_LETTERS.items() if len(k) == 1})


@F.pandas_udf(T.StringType())
def _decomposed(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKD")


@F.pandas_udf(T.StringType())
def _latin(s: pd.Series) -> pd.Series:
    def one(text):
        if text is None:
            return None
        for word, latin in DEVANAGARI_WORDS.items():
            text = text.replace(word, latin)
        return text.translate(_DEVANAGARI)

    return s.map(one)


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def collapsed(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def decomposed(c: Column | str) -> Column:
    """NFKD form; ASCII rows don't go through Python."""
    t = _text(c)
    wide = t.rlike(r"[^\x00-\x7F]")
    return F.when(wide, _decomposed(F.when(wide, t))).otherwise(t)


def ascii_folded(c: Column | str) -> Column:
    """NFKD form without what is not ASCII."""
    return F.regexp_replace(decomposed(c), r"[^\x00-\x7F]", "")


def remove_junk(c: Column | str) -> Column:
    """Formatting marks (runs of - < > * # = ~ /, and any + or bracket) as one blank."""
    return collapsed(F.regexp_replace(_text(c), r"--+|<<+|>>+|\[|\]|\(|\)|\+|\*\*+|##+|==+|~~+|//+", " "))


def transliterate(c: Column | str) -> Column:
    """Devanagari in Latin letters: known words in the order of their list, then code point by code point."""
    t = _text(c)
    has = t.rlike("[ऀ-ॿ]")
    return F.when(has, _latin(F.when(has, t))).otherwise(t)


def clean_text(c: Column | str) -> Column:
    """Lower case, ``&`` as ``and``, no marks, only a-z, 0-9 and single blanks."""
    t = F.replace(F.lower(_text(c)), F.lit("&"), F.lit(" and "))
    t = F.regexp_replace(decomposed(t), r"\p{M}", "")
    return collapsed(F.regexp_replace(t, r"(?U)[^a-z0-9\s]", " "))


def legal_form(c: Column | str) -> Column:
    """The legal form named first in the order of the list; null if none."""
    t = _text(c)
    chain = None
    for label, pattern in LEGAL_FORMS:
        hit = t.rlike(rf"(?U)\b({pattern})\b")
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain


def without_legal_form(c: Column | str) -> Column:
    """The text without legal forms, and without an ``and`` left over at either end."""
    t = F.regexp_replace(_text(c), rf"(?U)\b({LEGAL_WORDS})\b", " ")
    t = F.regexp_replace(t, r"(?U)\b(and|&)\s*$", " ")
    return collapsed(F.regexp_replace(t, r"(?U)^\s*(and|&)\b", " "))


def domain_root(c: Column | str) -> Column:
    """Second-level name of the first web address, lower case; null if there is none or it is a mail provider."""
    root = F.lower(null_if_empty(F.regexp_extract(_text(c), rf"(?U)(?:https?://)?(?:www\.)?([a-zA-Z0-9-]+)\.(?:{DOMAIN_ENDINGS})\b", 1)))
    return F.when(~root.isin(MAIL_DOMAINS), root)


def domain_root_unfiltered(c: Column | str) -> Column:
    """As ``domain_root``, in either case and with mail providers."""
    return F.lower(null_if_empty(F.regexp_extract(_text(c), rf"(?iU)([a-z0-9-]+)\.(?:{DOMAIN_ENDINGS})\b", 1)))


def name_tokens(c: Column | str) -> Column:
    """Words of three or more letters and digits, lower case, common company suffixes left out."""
    clean = F.regexp_replace(F.lower(F.coalesce(_text(c), F.lit(""))), r"[^a-zA-Z0-9\s]", " ")
    return F.filter(F.split(clean, r"\s+"), lambda w: (F.length(w) >= 3) & ~w.isin(PROFILED_SUFFIXES))


def domains(c: Column | str) -> Column:
    """All web addresses of a text, as an array."""
    return F.regexp_extract_all(_text(c), F.lit(rf"(?i)([a-zA-Z0-9-]+\.(?:{DOMAIN_ENDINGS_SHORT}))"), 1)


def pincode(c: Column | str) -> Column:
    return null_if_empty(F.regexp_extract(_text(c), r"(?U)\b(\d{5,6})\b", 1))


def street_number(c: Column | str, digits: int = 5) -> Column:
    return null_if_empty(F.regexp_extract(_text(c), rf"(?U)\b(\d{{1,{digits}}})\b", 1))


def soundex(c: Column | str) -> Column:
    """Four-character code in which every letter without a digit, H and W too, parts equal digits; null without A-Z."""
    letters = F.regexp_replace(F.upper(_text(c)), "[^A-Z]", "")
    digits = F.translate(letters, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "01230120022455012623010202")
    tail = F.replace(F.substring(F.regexp_replace(digits, r"(\d)\1+", "$1"), 2, 1 << 30), F.lit("0"), F.lit(""))
    return F.when(letters != "", F.rpad(F.substring(F.concat(F.substring(letters, 1, 1), tail), 1, 4), 4, "0"))


def _long_tokens(c: Column | str) -> Column:
    return F.filter(F.split(_text(c), " "), lambda t: F.length(t) >= 3)


def first_two_tokens(c: Column | str) -> tuple[Column, Column]:
    tokens = _long_tokens(c)
    return F.get(tokens, F.lit(0)), F.get(tokens, F.lit(1))


def phonetic_first_token(c: Column | str) -> Column:
    return soundex(first_two_tokens(c)[0])


def token_sort_key(c: Column | str) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(_text(c), " "), lambda t: t != "")), " ")


def clean_address(c: Column | str) -> Column:
    return clean_text(remove_junk(transliterate(c)))


def address_keys(c: Column | str) -> tuple[Column, Column, Column]:
    """Clean address, street number and pin code, the latter two from the raw text."""
    return clean_address(c), street_number(c), pincode(c)


def normalize_text(c: Column | str) -> Column:
    """Profile of the pair features: domains without ending, ASCII letters, lower case, no punctuation; null is empty."""
    t = F.regexp_replace(F.coalesce(_text(c), F.lit("")), rf"(?iU)([a-z0-9-]+)\.(?:{DOMAIN_ENDINGS})\b", "$1")
    return collapsed(F.regexp_replace(F.lower(ascii_folded(t)), r"[^\w\s]", " "))


def significant_tokens(normalized: Column) -> Column:
    """Tokens of three characters or more that are no suffix and no number, of ``normalize_text``."""
    return F.filter(F.split(normalized, " "), lambda t: (F.length(t) >= 3) & ~t.isin(FEATURE_SUFFIXES) & ~t.rlike("^[0-9]+$"))


def clean_business_name(c: Column | str) -> Column:
    """Profile of the country-keyed exact match."""
    t = F.lower(ascii_folded(F.coalesce(_text(c), F.lit(""))))
    t = F.regexp_replace(t, rf"([a-z0-9-]+)\.(?:{DOMAIN_ENDINGS_SHORT})\b", "$1")
    t = F.regexp_replace(F.regexp_replace(t, r"[^\w\s]", " "), rf"\b({'|'.join(BUSINESS_SUFFIXES)})\b", " ")
    return collapsed(t)


def _letter_table() -> tuple[str, str]:
    """Accented Latin letters (U+00C0 to U+024F) to their base, punctuation to blanks."""
    source, target = [], []
    for code in range(0x00C0, 0x0250):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0].isascii() and parts[0].isalpha():
            source.append(chr(code))
            target.append(parts[0])
    marks = string.punctuation + "«»“”‘’–—…"
    return "".join(source) + marks, "".join(target) + " " * len(marks)


def normalize_name(c: Column | str) -> Column:
    """Profile of the vocabulary join: one ``translate``, suffixes dropped unless nothing else is left."""
    tokens = F.filter(F.split(F.translate(F.lower(F.coalesce(_text(c), F.lit(""))), *_letter_table()), r"(?U)\s+"), lambda t: t != "")
    kept = F.filter(tokens, lambda t: ~t.isin(BASELINE_SUFFIXES))
    return F.array_join(F.when(F.size(kept) > 0, kept).otherwise(tokens), " ")


def blocking_keys(name: Column | str, address: Column | str, squeeze: bool) -> dict[str, Column]:
    """cname, caddr, t0, t1 (and with ``squeeze``, snum, p4 and domain) of the exact-join generators.

    Without ``squeeze`` white space is not collapsed, so t1 is empty where
    punctuation stood next to a blank.
    """
    raw, addr = F.coalesce(_text(name), F.lit("")), F.coalesce(_text(address), F.lit(""))
    plain = F.regexp_replace(F.lower(raw), r"(?U)[^\w\s]", " ")
    squeezed = collapsed if squeeze else F.trim
    bare = F.regexp_replace(plain, rf"(?U)\b({'|'.join(BLOCKING_SUFFIXES)})\b", " ")
    tokens = F.split(squeezed(plain) if squeeze else plain, " ")
    keys = {
        "cname": squeezed(bare),
        "caddr": squeezed(F.regexp_replace(F.lower(addr), r"(?U)[^\w\s]", " ")),
        "t0": F.get(tokens, F.lit(0)),
        "t1": F.get(tokens, F.lit(1)),
    }
    if squeeze:
        keys |= {
            "snum": street_number(addr, 6),
            "p4": F.substring(squeezed(plain), 1, 4),
            "domain": null_if_empty(F.regexp_extract(F.lower(raw), rf"(?U)([a-z0-9-]+)\.(?:{DOMAIN_ENDINGS})\b", 1)),
        }
    return keys


def entity_text(name: Column | str, address: Column | str, country: Column | str) -> Column:
    """``name | address | country``, null as empty, for encoders."""
    return F.concat_ws(" | ", *[F.coalesce(_text(c), F.lit("")) for c in (name, address, country)])


def split_name(entity_id: Column | str, shares: tuple[float, ...] = (0.8, 0.1, 0.1), salt: str = "split", names: tuple[str, ...] = ("train", "dev", "val")) -> Column:
    """train, dev or val by an MD5 bucket of salt and id: the same id has the same split everywhere."""
    bucket = F.conv(F.substring(F.md5(F.concat(F.lit(salt + ":"), _text(entity_id))), 1, 8), 16, 10).cast("long") % 10_000
    bound, chain = 0, None
    for share, name in list(zip(shares, names, strict=True))[:-1]:
        bound += int(share / sum(shares) * 10_000)
        hit = bucket < bound
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain.otherwise(names[-1])


def id_list(c: Column | str) -> Column:
    """A comma-joined list as an array, blanks trimmed, empty ones dropped, repeats once."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(_text(c), F.lit("")), ","), lambda x: F.trim(x)), lambda t: t != ""))


def capped_ids(c: Column | str, most: int = 2) -> Column:
    """The first ids of S2 and of S3, ``most`` each, S2 first."""
    ids = F.filter(F.transform(F.split(F.coalesce(_text(c), F.lit("")), ","), lambda x: F.trim(x)), lambda t: t != "")
    of = lambda p: F.slice(F.filter(ids, lambda t: t.startswith(p)), 1, most)
    return F.array_join(F.concat(of("S2-"), of("S3-")), ",")
