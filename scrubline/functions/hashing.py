"""Deterministic numbers from strings: jitter and dictionary choices."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_hash(text: Column) -> Column:
    """``String.hashCode`` of an ASCII text as a signed 32-bit number (long)."""
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    folded = F.aggregate(codes, F.lit(0).cast("long"), lambda h, c: F.pmod(h * 31 + c, F.lit(1 << 32)))
    return F.when(folded >= 1 << 31, folded - (1 << 32)).otherwise(folded)


def jitter_from(seed: Column, salt: str, days: int) -> Column:
    """Days in [-days, days) from a seed, never 0; null for a null seed."""
    if days <= 0:
        raise ValueError("the jitter range must be over 0")
    x = F.abs(java_hash(F.concat(seed, F.lit(salt)))) % (2 * days) - days
    return F.when(x == 0, F.lit(days // 2)).otherwise(x).cast("int")


def keyed_index(salt: str, person: Column, word: Column, n: int) -> Column:
    """A number in [0, n) that depends on the salt, the person and the word."""
    key = F.md5(F.concat_ws("|", F.lit(salt), F.coalesce(person.cast("string"), F.lit("")), F.lower(word)).cast("binary"))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long") % n


def _uniform(salt: str, person: Column, word: Column) -> Column:
    """A number in (0, 1) that depends on the salt, the person and the word."""
    return (keyed_index(salt, person, word, 1 << 31) + F.lit(0.5)) / F.lit(float(1 << 31))


def skewed_index(salt: str, person: Column, word: Column, n: int, skew: float = 1.0) -> Column:
    """A number in [0, n) as keyed_index, but small ones oftener, as in lists by
    popularity: a uniform rank times the size of a normal deviate over skew."""
    size = F.abs(F.sqrt(-2 * F.ln(_uniform(salt + "#1", person, word))) * F.cos(2 * math.pi * _uniform(salt + "#2", person, word)))
    return F.least(F.floor(keyed_index(salt, person, word, n) * size / F.lit(float(skew))), F.lit(n - 1)).cast("long")


def permuted(i: Column, n: int, key: Column, rounds: int = 4, walk: int = 24) -> Column:
    """A permutation of [0, n) that depends on the key, applied to i: different i have different places.

    A Feistel network over pairs (l, r) of a x b >= n numbers adds a hash of one half
    to the other, in turn; what comes out over n goes in again until it does not.  A
    step fails with a chance of at most 1 in the root of n, so ``walk`` of them leave
    none (a null, if ever, is for the caller to treat as no place).
    """
    a = math.isqrt(n - 1) + 1 if n > 1 else 1
    b = -(-n // a)

    def mixed(x: Column) -> Column:
        l, r = F.floor(x / b), x % b  # noqa: E741
        for k in range(rounds):
            if k % 2:
                r = (r + F.pmod(F.xxhash64(F.lit(k), key, l), F.lit(b))) % b
            else:
                l = (l + F.pmod(F.xxhash64(F.lit(k), key, r), F.lit(a))) % a  # noqa: E741
        return l * b + r

    once = mixed(i.cast("long"))
    if a * b == n:
        return once

    # the state is a number, so that each step is computed once; the first one settles nearly all
    def on(x: Column) -> Column:
        walked = F.aggregate(F.sequence(F.lit(2), F.lit(walk)), F.struct(x.alias("x"), F.lit(False).alias("done")), lambda s, _: F.when(
            s["done"], s).otherwise(F.transform(F.array(mixed(s["x"])), lambda y: F.struct(y.alias("x"), (y < n).alias("done")))[0]))
        return F.transform(F.array(walked), lambda s: F.when(s["done"], s["x"]))[0]

    return F.transform(F.array(once), lambda x: F.when(x < n, x).otherwise(on(x)))[0]


def pick(options: list[str], index: Column, avoid: Column) -> Column:
    """options[index], or the next one where that is ``avoid`` (in any case)."""
    listed = F.array(*[F.lit(x) for x in options])
    at = lambda i: F.element_at(listed, (i % len(options) + 1).cast("int"))
    return F.when(F.lower(at(index)) == F.lower(avoid), at(index + 1)).otherwise(at(index))
