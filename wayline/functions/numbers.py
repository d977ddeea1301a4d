"""Exact arithmetic: ratios, means and money stay decimal until they leave the engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def fn_round_money(c: Column, scale: int = 2) -> Column:
    return F.round(c, scale)


def exact_ratio(num: Column, den: Column, inner: int = 6) -> Column:
    """num/den held at ``inner`` decimals; NULL when either side is NULL or den is 0."""
    top, bottom = num.cast("decimal(24,4)"), den.cast("decimal(24,4)")
    return F.round(F.try_divide(top, bottom), inner)


def agg_safe_ratio(num: Column, den: Column, scale: int, inner: int = 6) -> Column:
    """Ratio of two aggregates: 0 for a zero denominator, NULL for a NULL operand."""
    value = F.round(exact_ratio(num, den, inner), scale)
    known = num.isNotNull() & den.isNotNull()
    return F.when(known & (den == 0), F.lit(0).cast(f"decimal(38,{scale})")).otherwise(value)


def agg_mean(c: Column, scale: int, inner: int = 6, kind: str = "decimal(24,6)") -> Column:
    """Mean as exact sum over count, so the result does not depend on row order. For integers
    ``kind="bigint"`` keeps the running sum a machine number."""
    total = F.sum(c.cast(kind)).cast("decimal(32,6)")
    return F.round(F.round(F.try_divide(total, F.count(c).cast("decimal(18,0)")), inner), scale)


def fn_greatest_least(c: Column, low, high) -> Column:
    """Clamp to [low, high]; NULL stays NULL."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


MATH = {"exp": F.exp, "ln": F.ln, "pow": F.pow, "sqrt": F.sqrt, "cos": F.cos,
        "abs": F.abs, "floor": F.floor, "mod": lambda a, b: a % b, "pi": F.pi}


def fn_math(name: str, *cs: Column) -> Column:
    return MATH[name](*cs)


def fn_fx_convert(amount: Column, rate: Column, scale: int = 2) -> Column:
    """Local money to the report currency; an unknown rate gives NULL."""
    return F.round(amount * rate, scale)


def fn_cross_rate(base: Column, quote: Column, scale: int = 8) -> Column:
    """Both quotes against one pivot currency -> price of one unit of ``quote`` in ``base``."""
    return F.round(F.try_divide(base.cast("decimal(18,8)"), quote.cast("decimal(18,8)")), scale)


def fn_dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def fn_cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of two float arrays; NULL for a zero vector or different lengths."""
    score = F.try_divide(fn_dot(a, b), F.sqrt(fn_dot(a, a)) * F.sqrt(fn_dot(b, b)))
    return F.when(F.size(a) == F.size(b), score)


def project_case_bucket(c: Column, bounds: Sequence[tuple[object, str]], otherwise: str | None) -> Column:
    """First band whose upper bound lies above the value; NULL falls through to ``otherwise``."""
    bands = F
    for upper, label in bounds:
        bands = bands.when(c < F.lit(upper), F.lit(label))
    return bands.otherwise(F.lit(otherwise))


def project_decode(c: Column, mapping: dict, default=None) -> Column:
    cases = F
    for value, result in mapping.items():
        cases = cases.when(c == F.lit(value), F.lit(result))
    return cases.otherwise(F.lit(default))


def project_null_handling(c: Column) -> Column:
    """Blank text counts as missing."""
    return F.nullif(F.trim(c), F.lit(""))


def project_iff(condition: Column, yes, no) -> Column:
    """Two-way choice; an unknown condition takes the second branch."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(condition, as_col(yes)).otherwise(as_col(no))
