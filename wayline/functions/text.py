"""Text helpers as column expressions; Python runs only for Unicode decomposition."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wayline.functions.casts import cast_try_date, cast_try_number

# Marker for a missing key part, text masks, line-break tag, entity table (decode order
# matters: the ampersand goes first) and letters that Unicode decomposition leaves whole.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"
PHONE_MASK = "***-***-****"
EMAIL_MASK = "***@"
BREAK_TAG = r"(?i)<br\s*/?>"
HTML_ENTITIES = [("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">")]
WHOLE_LETTERS = {"ı": "i", "ł": "l", "ø": "o", "æ": "ae", "ß": "ss", "đ": "d", "œ": "oe"}
DEFAULT_NAME = "traveler"


def fn_trim_case(c: Column, case: str = "upper") -> Column:
    return {"upper": F.upper, "lower": F.lower}[case](F.trim(c))


def fn_surrogate_key(*parts: Column) -> Column:
    """md5 over the dash-joined parts; NULL parts are marked, so NULL and '' stay apart."""
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(NULL_KEY_PART)) for p in parts]))


def flight_key(date: Column, carrier: Column, number: Column, origin: Column, dest: Column,
               departure: Column) -> Column:
    """Key of one scheduled flight, built from normalised text columns on both join sides."""
    return fn_surrogate_key(cast_try_date(date), fn_trim_case(carrier), cast_try_number(number),
                            fn_trim_case(origin), fn_trim_case(dest), F.lpad(departure, 4, "0"))


def fn_replace_money(c: Column, precision: int = 12, scale: int = 2) -> Column:
    """ "$1,234.50" -> 1234.50 """
    return cast_try_number(F.regexp_replace(c, r"[$,]", ""), precision, scale)


def fn_percent(c: Column) -> Column:
    """ "97%" -> 0.97 """
    return (cast_try_number(F.replace(c, F.lit("%"), F.lit(""))).cast("decimal(19,0)") / F.lit(100)).cast(
        "decimal(24,6)")


def fn_clean_html(c: Column) -> Column:
    text = F.regexp_replace(c, BREAK_TAG, "\n")
    for entity, char in HTML_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return project_blank(text)


def project_blank(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def fn_length(c: Column) -> Column:
    return F.length(c)


def fn_split_mask(c: Column, kind: str = "email") -> Column:
    """E-mail keeps its domain; a phone number keeps nothing. NULL stays NULL for e-mail."""
    if kind == "email":
        return F.concat(F.lit(EMAIL_MASK), F.split_part(c, F.lit("@"), F.lit(2)))
    return F.lit(PHONE_MASK)


def fn_concat_left(c: Column, n: int, *more: Column) -> Column:
    return F.concat(F.substring(c, 1, n), *more)


@F.pandas_udf(StringType())
def _decompose(names: pd.Series) -> pd.Series:
    return names.str.normalize("NFKD")


def fn_ascii_fold(c: Column) -> Column:
    """Lower-case a-z form of a name; an empty result becomes a default word."""
    text = F.lower(c)
    for letter, plain in WHOLE_LETTERS.items():
        text = F.replace(text, F.lit(letter), F.lit(plain))
    # plain ASCII needs no decomposition; Python only sees the other names
    marked = _decompose(F.when(text.rlike("[^\\x00-\\x7F]"), text))
    letters = F.regexp_replace(F.coalesce(marked, text), "[^a-z]", "")
    return F.when(c.isNotNull(), F.when(letters == "", F.lit(DEFAULT_NAME)).otherwise(letters))


def fn_json_array(c: Column) -> Column:
    """Number of elements of a JSON array in text; NULL when the text is no array."""
    return F.json_array_length(c)


def fn_json_to_array(c: Column, element: str = "string") -> Column:
    return F.from_json(c, f"array<{element}>")


def fn_array_filter_slice(c: Column, allowed: list[str], n: int, default: str) -> Column:
    """Allowed values only, in order, at most n; an empty rest becomes [default]."""
    words = F.array(*[F.lit(a) for a in allowed])
    kept = F.slice(F.filter(F.coalesce(c, F.array().cast("array<string>")),
                            lambda x: F.array_contains(words, x)), 1, n)
    return F.when(F.size(kept) == 0, F.array(F.lit(default))).otherwise(kept)
