"""Text functions as Catalyst expressions; Arrow UDFs only where Spark has no equivalent."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Settings

DEFAULTS = Settings()

# Abbreviations and what they stand for, names and addresses apart.
NAME_ABBREVIATIONS = {"corp": "corporation", "inc": "incorporated", "pvt": "private", "ltd": "limited", "co": "company", "intl": "international", "mfg": "manufacturing"}
ADDRESS_ABBREVIATIONS = {"st": "street", "rd": "road", "ave": "avenue", "blvd": "boulevard", "dr": "drive", "ln": "lane", "hwy": "highway", "apt": "apartment", "bldg": "building", "flr": "floor"}
# Spellings of countries that mean the same.
COUNTRY_VARIANTS = {"usa": "us", "u.s.a.": "us", "u.s.": "us", "united states": "us", "uk": "gb", "united kingdom": "gb"}


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def words(text: Column) -> Column:
    """White-space tokens, none empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda x: x != "")


def numbers(text: Column) -> Column:
    """Distinct runs of digits, in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)(\d+)"), F.lit(1)))


def initials(tokens: Column) -> Column:
    return F.array_join(F.transform(tokens, lambda x: F.substring(x, 1, 1)), "")


def char_ngrams(text: Column, n: int = DEFAULTS.bm25_ngram_size, settings: Settings = DEFAULTS) -> Column:
    """Overlapping character n-grams with their case.

    Null, empty and sentinel texts (equal to a sentinel when stripped and lower-cased) give none;
    a text shorter than ``n`` is its own only token.
    """
    grams = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
    none = F.array().cast("array<string>")
    blank = text.isNull() | (text == "") | F.lower(strip(text)).isin(settings.nullname_prefix, settings.nulladdr_prefix)
    return F.when(blank, none).when(F.length(text) < n, F.array(text)).otherwise(grams)


def index_ngrams(text: Column, sentinel: str, n: int = DEFAULTS.bm25_ngram_size) -> Column:
    """``char_ngrams`` for indexing: sentinels with an id (``nullname <id>``) give none, either."""
    return F.when(text.startswith(sentinel + " "), F.array().cast("array<string>")).otherwise(char_ngrams(text, n))


def repair_null(text: Column, literals: tuple[str, ...] = DEFAULTS.null_literals) -> Column:
    """Null and words that mean it become empty."""
    value = F.coalesce(text, F.lit(""))
    return F.when(F.lower(strip(value)).isin(*literals), F.lit("")).otherwise(value)


def normalise_country(country: Column, variants: dict[str, str] = COUNTRY_VARIANTS) -> Column:
    plain = F.lower(strip(F.coalesce(country, F.lit(""))))
    known = F.create_map(*[F.lit(x) for pair in variants.items() for x in pair])
    return F.coalesce(F.element_at(known, plain), plain)


#: Devanagari to Malayalam but for Oriya: the eight scripts that are transliterated.
CROSS_SCRIPT = "[\\u0900-\\u0AFF\\u0B80-\\u0D7F]"


def is_cross_script(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(CROSS_SCRIPT).cast("tinyint")


def name_for_vectors(text: Column) -> Column:
    """Lower case and single spaces, nothing else."""
    return strip(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+", " "))


def expand(text: Column, abbreviations: dict[str, str]) -> Column:
    """Abbreviations one after the other; a text with none of them is read once."""
    whole = text
    for short, long in abbreviations.items():
        whole = F.regexp_replace(whole, rf"\b{short}\b", long)
    return F.when(text.rlike(rf"\b(?:{'|'.join(abbreviations)})\b"), whole).otherwise(text) if abbreviations else text


def symbols(text: Column, settings: Settings = DEFAULTS) -> Column:
    """Lower case; periods go, @ and & become words, all else but letters and digits a space."""
    text = F.lower(text)
    text = F.replace(text, F.lit("."), F.lit(""))
    text = F.replace(text, F.lit("@"), F.lit(settings.symbol_at_replacement))
    text = F.replace(text, F.lit("&"), F.lit(settings.symbol_amp_replacement))
    return F.trim(F.regexp_replace(F.regexp_replace(text, "[^a-z0-9]+", " "), " +", " "))


def fold_ascii_text(text: str | None) -> str | None:
    """NFKD, then whatever is not ASCII is dropped."""
    return None if text is None else unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


@F.pandas_udf(T.StringType())
def _fold(text: pd.Series) -> pd.Series:
    return text.map(fold_ascii_text)


@F.pandas_udf(T.StringType())
def _itrans(text: pd.Series) -> pd.Series:
    from .indic import to_itrans

    return text.map(lambda x: None if x is None else to_itrans(x))


def fold_ascii(text: Column) -> Column:
    """ASCII only; Python gets nulls for rows that are ASCII already."""
    return F.coalesce(_fold(F.when(text.rlike("[^\\x00-\\x7F]"), text)), text)


def transliterate(text: Column) -> Column:
    return F.coalesce(_itrans(F.when(text.rlike(CROSS_SCRIPT), text)), text)


def clean_name(text: Column, settings: Settings = DEFAULTS) -> Column:
    """The name as BM25 reads it."""
    value = F.coalesce(text, F.lit(""))
    value = transliterate(value) if settings.enable_transliteration else value
    return expand(symbols(fold_ascii(value), settings), NAME_ABBREVIATIONS)


def clean_address(text: Column, settings: Settings = DEFAULTS) -> Column:
    """The address as BM25 reads it: words in other scripts are transliterated one by one, so digits and Latin words stay."""
    value = F.coalesce(text, F.lit(""))
    value = transliterate(value) if settings.enable_transliteration else value
    return expand(symbols(fold_ascii(value), settings), ADDRESS_ABBREVIATIONS)


def with_sentinel(text: Column, id: Column, prefix: str) -> Column:
    return F.when(F.coalesce(text, F.lit("")) == "", F.concat(F.lit(prefix + " "), id)).otherwise(text)
