"""Random-looking values that depend only on a key and a salt, not on tasks, runs or engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The modulus of the uniform draw and the seed joined into every key.
MODULUS = 1000000007
SEED = 42


def hash_int(key: Column, salt: str = "") -> Column:
    """60 bits of md5 as a long."""
    text = F.concat_ws("|", key.cast("string"), F.lit(salt), F.lit(str(SEED)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def hash_uniform(key: Column, salt: str) -> Column:
    """Uniform in [0, 1)."""
    return (hash_int(key, salt) % F.lit(MODULUS)).cast("double") / F.lit(float(MODULUS))


def hash_normal(key: Column, salt: str) -> Column:
    """Standard normal by the Box-Muller transform of two uniform draws."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(F.greatest(hash_uniform(key, salt + "a"), F.lit(1e-12))))
    return radius * F.cos(F.lit(2.0) * F.pi() * hash_uniform(key, salt + "b"))


def hash_exponential(key: Column, salt: str, mean: float) -> Column:
    return -F.ln(F.lit(1.0) - hash_uniform(key, salt)) * F.lit(float(mean))


def weighted_assign(u: Column, weights: dict[str, float]) -> Column:
    """Map a uniform draw onto weighted labels; the last label takes the rest."""
    total, reached, cases = sum(weights.values()), 0.0, F
    *head, last = weights
    for label in head:
        reached += weights[label] / total
        cases = cases.when(u < F.lit(round(reached, 6)), F.lit(label))
    return cases.otherwise(F.lit(last)) if head else F.lit(last)
