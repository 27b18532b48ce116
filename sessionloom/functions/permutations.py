"""Permutations of 0 .. n-1, one for each key, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 24


def pivots(prefix: Column, n: int) -> Column:
    """The key's number in ``0 .. n-1`` for each round, from md5."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        lambda k: F.struct(
            k.alias("round"),
            (F.conv(F.substring(F.md5(F.concat_ws(":", prefix, k.cast("string"))), 1, 8), 16, 10).cast("long") % n).alias("pivot"),
        ),
    )


def permuted(place: Column, keyed: Column, prefix: Column, n: int) -> Column:
    """What the key's permutation has at ``place``; ``keyed`` are its ``pivots``.

    A swap-or-not network: a round's pivot pairs all places, and a digest of the pair's
    larger place tells whether the two change places. Each round undoes itself, so the
    whole is a permutation for every ``n``, and one place costs no more than its rounds.
    """

    def step(at: Column, turn: Column) -> Column:
        mirror = F.pmod(turn["pivot"] - at, F.lit(n).cast("long"))
        digest = F.md5(F.concat_ws(":", prefix, turn["round"].cast("string"), F.greatest(at, mirror).cast("string")))
        return F.when(F.substring(digest, 1, 1) >= "8", mirror).otherwise(at)

    return F.aggregate(keyed, place.cast("long"), step)
