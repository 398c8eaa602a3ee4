"""Column builders that decode a raw feature's properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed import CATEGORIES, COARSE, CODED, CODES, HIGH_SEAS, LEVELS

#: Unicode white space and the byte order mark.
_BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
NA = LEVELS.index("na")


def trimmed(c: Column) -> Column:
    """Without Unicode white space and byte order marks at both ends."""
    return F.btrim(c.cast("string"), F.lit(_BLANKS))


def safe_string(c: Column) -> Column:
    """Trimmed text; null if blank."""
    return F.nullif(trimmed(c), F.lit(""))


def _number(c: Column) -> Column:
    """The number that the text is, which may overflow to infinity; else null."""
    return F.regexp_extract(trimmed(c), _NUMBER, 0).try_cast("double")


def safe_number(c: Column) -> Column:
    """A finite number, or text that is one; else null."""
    n, text = _number(c), c.cast("string")
    whole = text.try_cast("int")
    # most are plain whole numbers, which need no pattern
    return F.when(whole.cast("string") == text, whole.cast("double")).otherwise(F.when(F.abs(n) < F.lit(float("inf")), n))


_RANKS = {float(code): LEVELS.index(level) for code, level in CODES.items()}


def rank(c: Column) -> Column:
    """Severity of a code: 0 the strictest, 4 for everything unknown to the coding."""
    table = F.create_map(*(F.lit(x) for pair in _RANKS.items() for x in pair))
    # most are absent or plain digits, which need no pattern
    out = F.when(c.isNull(), F.lit(NA))
    for code, level in CODES.items():
        out = out.when(c.cast("string") == str(code), F.lit(LEVELS.index(level)))
    return out.otherwise(F.coalesce(F.element_at(table, _number(c) + 0.0), F.lit(NA)))


def label(r: Column) -> Column:
    """The level of a rank."""
    return F.element_at(F.array(*map(F.lit, LEVELS)), r + 1)


def level(c: Column) -> Column:
    return label(rank(c))


def stricter(a: Column, b: Column) -> Column:
    """The stricter of two ranks."""
    return F.least(a, b)


def worst(ranks: list[Column]) -> Column:
    """The strictest of any number of ranks."""
    return F.least(*ranks, F.lit(NA)) if ranks else F.lit(NA)


def ranked(df: DataFrame, prefix: str = "", columns: list[str] = CODED) -> DataFrame:
    """df with a rank column ``r_<name>`` for each coded column, computed once."""
    return df.withColumns({f"r_{c}": rank(F.col(prefix + c)) for c in columns})


def coarse(prefix: str = "r_") -> Column:
    """Struct of the 12 coarse activities, from rank columns."""
    return F.struct(*(label(worst([F.col(prefix + c) for c in cs])).alias(name) for name, cs in COARSE.items()))


def raw_levels(prefix: str = "r_") -> Column:
    """Map of all 43 coded columns to their level, from rank columns."""
    return F.create_map(*(x for c in CODED for x in (F.lit(c), label(F.col(prefix + c)))))


def unpivot_levels(df: DataFrame, keys: list[str], prefix: str = "r_") -> DataFrame:
    """keys, activity, level: one row a coded column, from rank columns."""
    pairs = ", ".join(f"'{c}', {prefix}{c}" for c in CODED)
    return df.selectExpr(*keys, f"stack({len(CODED)}, {pairs}) as (activity, rank)").select(*keys, "activity", label(F.col("rank")).alias("level"))


def category_id(c: Column) -> Column:
    """Id of an exact category label; null for any other."""
    return F.element_at(F.create_map(*(x for i, s in enumerate(CATEGORIES, 1) for x in (F.lit(s), F.lit(i)))), F.coalesce(c, F.lit("")))


def category_text(c: Column) -> Column:
    return F.coalesce(category_id(c).cast("string"), F.lit("unknown"))


def wdpa_id(c: Column) -> Column:
    """Text that is never read as a number; blank and '0' are absent."""
    return F.nullif(safe_string(c), F.lit("0"))


def iucn(c: Column) -> Column:
    return F.nullif(safe_string(c), F.lit("Unassigned"))


def tribal(c: Column) -> Column:
    """0 is an exemption, 1 is none: inverted against activities."""
    n = safe_number(c)
    return F.when(n == 0, True).when(n == 1, False)


def source_urls(*cs: Column) -> Column:
    return F.array_distinct(F.array_compact(F.array(*map(safe_string, cs))))


def clean_text(c: Column) -> Column:
    """Line breaks of markup as line feeds, no blanks before them, trimmed.

    Null only for blank input: text that is nothing but markup becomes empty.
    """
    s = F.regexp_replace(safe_string(c), r"(?i)<br\s*/?>", "\n")
    return trimmed(F.regexp_replace(s, r"[ \t]+\n", "\n"))


def summary(*cs: Column) -> Column:
    """Cleaned parts with a blank line between them; null if there is none."""
    return F.when(F.coalesce(*map(safe_string, cs)).isNotNull(), F.concat_ws("\n\n", *map(clean_text, cs)))


def high_seas(country: Column) -> Column:
    return country.eqNullSafe(HIGH_SEAS)


def removed(status: Column) -> Column:
    return F.coalesce(F.lower(status) == "removed", F.lit(False))


def has_token(partition: Column, tokens: tuple[str, ...]) -> Column:
    """Whether some part of an underscore-delimited name is one of the tokens."""
    return F.coalesce(F.arrays_overlap(F.split(partition, "_"), F.array(*map(F.lit, tokens))), F.lit(False))


def identity(df: DataFrame, prefix: str = "") -> DataFrame:
    """The 20 decoded properties, from raw columns and rank columns."""
    c = lambda name: F.col(prefix + name)
    text = lambda name: safe_string(c(name))
    return df.withColumns(
        {
            "siteId": F.coalesce(c("SITE_ID"), F.lit("")),
            "name": F.coalesce(text("site_name"), F.lit("(unnamed area)")),
            "country": text("country"),
            "state": text("state"),
            "authority": text("managing_authority"),
            "designation": text("designation"),
            "category": text("category_name"),
            "categoryId": category_text(c("category_name")),
            "wdpaId": wdpa_id(c("wdpa_id")),
            "iucnCat": iucn(c("iucn_cat")),
            "lfp": safe_number(c("lfp")),
            "tribalExemption": tribal(c("tribal")),
            "summary": summary(c("purpose"), c("restrictions"), c("allowed")),
            "sourceUrls": source_urls(c("url"), c("regulation_source"), c("other_helpful_links")),
            "season": text("season"),
            "effectiveFrom": text("effective_from"),
            "effectiveTo": text("effective_to"),
            "siteVersion": F.struct(safe_number(c("site_major_version")).alias("major"), safe_number(c("site_minor_version")).alias("minor")),
            "marineArea": safe_number(c("marine_area")),
            "coarse": coarse(),
            "raw": raw_levels(),
        }
    )


PROPERTIES = ["siteId", "name", "country", "state", "authority", "designation", "category", "categoryId", "wdpaId", "iucnCat", "lfp", "tribalExemption", "restrictions", "raw", "summary", "sourceUrls", "season", "effectiveFrom", "effectiveTo", "siteVersion"]


def scalar_columns(df: DataFrame) -> DataFrame:
    """Objects and arrays as JSON text, nulls kept; whole versions without a fraction."""
    keep = {"ignoreNullFields": "false"}
    whole = lambda n: F.when(n == F.floor(n), F.floor(n).cast("string")).otherwise(n.cast("string"))
    version = F.concat(F.lit('{"major":'), F.coalesce(whole(F.col("siteVersion.major")), F.lit("null")), F.lit(',"minor":'), F.coalesce(whole(F.col("siteVersion.minor")), F.lit("null")), F.lit("}"))
    return df.withColumns({"restrictions": F.to_json("restrictions", keep), "raw": F.to_json("raw", keep), "sourceUrls": F.to_json("sourceUrls", keep), "siteVersion": version})
