"""Vector arithmetic on ARRAY columns, JVM-side, in DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: added to the norm when a random vector is normalised.
NORM_EPS = 2.220446049250313e-16


def as_double(v) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a, b) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def l2_norm(v) -> Column:
    return F.sqrt(dot(v, v))


def finite(v) -> Column:
    """Has the vector a number in every place?"""
    number = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(number, F.lit(False))


def cosine(a, b) -> Column:
    """Cosine similarity; 0 where it is undefined (a zero or broken vector)."""
    norms = l2_norm(a) * l2_norm(b)
    value = F.when(norms > 0, F.try_divide(dot(a, b), norms))
    return F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(value)


def euclidean(a, b) -> Column:
    return F.sqrt(
        F.aggregate(
            F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double")),
            F.lit(0.0),
            lambda acc, d: acc + d * d,
        )
    )


def l1_distance(a, b) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double"))),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def vector_concat(a, b) -> Column:
    return F.concat(a, b)


def concat_ids(a, b) -> Column:
    return F.concat_ws("_", a.cast("string"), b.cast("string"))


def unit(v) -> Column:
    """``v`` scaled to length one."""
    return F.aggregate(
        v,
        F.lit(0.0),
        lambda acc, x: acc + x * x,
        lambda total: F.transform(v, lambda x: x / (F.sqrt(total) + F.lit(NORM_EPS))),
    )


def uniforms(dim: int, *keys) -> Column:
    """``dim`` reproducible numbers in [0, 1), from md5 of the keys.

    One digest holds four 32-bit numbers, so ``dim / 4`` digests are taken.
    """
    prefix = F.concat_ws(":", *[k.cast("string") if isinstance(k, Column) else F.lit(str(k)) for k in keys])
    digests = F.transform(
        F.sequence(F.lit(0), F.lit((dim + 3) // 4 - 1)),
        lambda j: F.md5(F.concat_ws(":", prefix, j.cast("string"))),
    )
    words = F.flatten(
        F.transform(
            digests,
            lambda d: F.array(*[F.conv(F.substring(d, 8 * w + 1, 8), 16, 10) for w in range(4)]),
        )
    )
    return F.transform(F.slice(words, 1, dim), lambda x: x.cast("double") / F.lit(4294967296.0))


def random_unit_vector(dim: int, *keys) -> Column:
    """A unit vector of the positive orthant."""
    return unit(uniforms(dim, *keys))
