"""Normalised forms of names and addresses as column expressions.

Everything stays in built-in functions but the accent fold, which Spark lacks: that one
is an Arrow UDF that gets only the rows with non-ASCII text. Regular expressions carry
(?U), so that word and space classes are those of Unicode.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from korvane.functions import vocab


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def let(value: Column, body) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def words(c: Column) -> Column:
    """The text split at runs of white space, without empty strings."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda t: t != "")


def _no_dots(c: Column) -> Column:
    return F.regexp_replace(c, "[.,]+$", "")


@F.pandas_udf(StringType())
def _fold(texts: pd.Series) -> pd.Series:
    fold = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if unicodedata.category(c) != "Mn")
    return texts.map(fold, na_action="ignore")


def fold_accents(c: Column) -> Column:
    """Compatibility decomposition without non-spacing marks."""
    ascii_ = c.rlike(r"^\p{ASCII}*$")
    return F.when(ascii_, c).otherwise(_fold(F.when(~ascii_, c)))


def drop_websites(c: Column) -> Column:
    for pattern, flags in zip(vocab.WEBSITES, ("(?U)", "(?U)", "(?iU)"), strict=True):
        c = F.regexp_replace(c, flags + pattern, "")
    return strip(c)


def split_dba(c: Column) -> Column:
    """struct(primary, dba): the first mark in order that occurs, else the first |, divides the name; dba is null without one."""
    rest = F.when(F.contains(c, F.lit("|")), F.struct(strip(F.substring_index(c, "|", 1)).alias("primary"), strip(c.substr(F.instr(c, "|") + 1, F.length(c))).alias("dba")))
    out = rest.otherwise(F.struct(c.alias("primary"), F.lit(None).cast("string").alias("dba")))
    for mark in reversed(vocab.DBA_MARKS):
        whole = f"(?isU)^(.*?)(?:{mark})(.*)$"
        out = F.when(c.rlike(f"(?iU){mark}"), F.struct(strip(F.regexp_extract(c, whole, 1)).alias("primary"), strip(F.regexp_extract(c, whole, 2)).alias("dba"))).otherwise(out)
    return out


def clean_name(c: Column) -> Column:
    c = F.regexp_replace(F.regexp_replace(c, vocab.NAME_SEPARATORS, " "), vocab.NAME_QUOTES, " ")
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def legal_suffix(c: Column) -> Column:
    """struct(name_only, legal_suffix): up to three closing tokens that are suffixes, in canonical form."""
    known = _map(vocab.LEGAL_SUFFIXES)

    def last(t: Column) -> Column:
        found = F.transform(F.array(*[F.lit(k) for k in (1, 2, 3)]), lambda k: F.try_element_at(known, _no_dots(F.lower(F.try_element_at(t, -k)))))
        n = lambda f: F.when(f[0].isNull(), 0).when(f[1].isNull(), 1).when(f[2].isNull(), 2).otherwise(3)
        parts = lambda f: F.struct(F.array_join(F.slice(t, F.lit(1), F.size(t) - n(f)), " ").alias("name_only"), F.array_join(F.reverse(F.slice(f, F.lit(1), n(f))), " ").alias("legal_suffix"))
        return let(found, parts)

    return let(words(c), last)


def canonical_suffix(token: Column) -> Column:
    """A token's canonical suffix, or the token in lower case."""
    return F.coalesce(F.try_element_at(_map(vocab.LEGAL_SUFFIXES), _no_dots(F.lower(token))), F.lower(token))


def name_parts(name: Column, fold: bool = True) -> Column:
    """struct(original, cleaned, name_only, legal_suffix, dba_name, tokens, acronym) of a name; null counts as empty."""
    name = F.coalesce(name, F.lit(""))
    token = lambda t: F.coalesce(F.try_element_at(_map(vocab.NAME_TOKENS), t), t)

    def divided(plain: Column) -> Column:
        return let(split_dba(plain), lambda dba: F.struct(F.when(dba["primary"] != "", dba["primary"]).otherwise(plain).alias("base"), F.coalesce(dba["dba"], F.lit("")).alias("dba")))

    def cleaned(x: Column) -> Column:
        return F.struct(F.array_join(F.transform(words(F.lower(clean_name(x["base"]))), token), " ").alias("cleaned"), x["dba"].alias("dba"))

    def whole(x: Column) -> Column:
        return let(F.struct(x["cleaned"].alias("cleaned"), x["dba"].alias("dba"), legal_suffix(x["cleaned"]).alias("s")), parts)

    def parts(x: Column) -> Column:
        tokens = words(x["s"]["name_only"])
        long_ = F.filter(tokens, lambda t: (F.length(t) > 1) & t.rlike(r"^\p{L}+$"))
        return F.struct(
            name.alias("original"), x["cleaned"].alias("cleaned"), x["s"]["name_only"].alias("name_only"), x["s"]["legal_suffix"].alias("legal_suffix"),
            x["dba"].alias("dba_name"), tokens.alias("tokens"), F.array_join(F.transform(long_, lambda t: F.substring(t, 1, 1)), "").alias("acronym"),
        )

    return let(let(let(drop_websites(fold_accents(name) if fold else name), divided), cleaned), whole)


def numbers(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("(?U)" + vocab.NUMBER), F.lit(0))


def pin_zip(c: Column) -> Column:
    """The first number of six digits, else the first of five (before any -dddd), else empty."""
    got = lambda p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    return F.coalesce(got("(?U)" + vocab.PIN), got("(?U)" + vocab.ZIP), F.lit(""))


def clean_address(c: Column) -> Column:
    c = F.regexp_replace(c, vocab.ADDRESS_QUOTES, " ")
    c = F.regexp_replace(F.regexp_replace(c, vocab.ADDRESS_HASHES, "#"), vocab.ADDRESS_COMMAS, ", ")
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def expand_address(c: Column) -> Column:
    """Tokens in lower case, abbreviations written out; a token without one keeps its punctuation."""
    return F.array_join(F.transform(words(F.lower(c)), lambda t: F.coalesce(F.try_element_at(_map(vocab.ADDRESS_TOKENS), _no_dots(t)), t)), " ")


_LANDMARK = rf"(?iU)\b(?:{vocab.LANDMARK_WORDS})\s+(\S+(?:\s+\S+){{0,3}})"


def landmarks(c: Column) -> Column:
    return F.array_join(F.regexp_extract_all(c, F.lit(_LANDMARK), F.lit(1)), " ")


def without_landmarks(c: Column) -> Column:
    return strip(F.regexp_replace(c, _LANDMARK, ""))


def address_parts(address: Column, fold: bool = True) -> Column:
    """struct(original, cleaned, tokens, numbers, pin_zip, landmarks, no_landmarks) of an address; null counts as empty."""
    address = F.coalesce(address, F.lit(""))
    folded = fold_accents(address) if fold else address
    clean = clean_address(folded)
    cleaned = expand_address(clean)
    return F.struct(
        address.alias("original"), cleaned.alias("cleaned"), words(cleaned).alias("tokens"), numbers(folded).alias("numbers"), pin_zip(folded).alias("pin_zip"),
        landmarks(folded).alias("landmarks"), expand_address(without_landmarks(clean)).alias("no_landmarks"),
    )


def normalise(df: DataFrame, fold: bool = True) -> DataFrame:
    """df with name_clean, addr_clean, combined and country_clean."""
    df = df.withColumns({"name_clean": name_parts(F.col("business_name"), fold)["cleaned"], "addr_clean": address_parts(F.col("business_address"), fold)["cleaned"]})
    return df.withColumns({"combined": F.concat_ws(" ", "name_clean", "addr_clean"), "country_clean": F.lower(F.trim(F.coalesce("country", F.lit(""))))})
