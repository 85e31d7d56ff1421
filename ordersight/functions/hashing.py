"""Deterministic pseudo-random draws for the order generator.

Every value is a pure function of (seed, stream, key): output does not depend
on partitioning, task retries or executor count. One md5 yields two 52-bit
halves; each seeds a congruential sequence whose n-th draw is one
multiplication away, so a row needs few digests for many draws.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: int, stream: str, key: Column) -> Column:
    """32 lowercase hex characters of md5('seed|stream|key')."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(stream), key.cast("string")))


MODULUS = (1 << 31) - 1
MULTIPLIER, INCREMENT = 48271, 12345


def half(hex_digest: Column, j: int) -> Column:
    """52 bits of a digest (hex digits 13j+1 .. 13j+13) as BIGINT, j in 0..1."""
    return F.conv(F.substring(hex_digest, 13 * j + 1, 13), 16, 10).cast("bigint")


def jump(n: int) -> tuple[int, int]:
    """(a, c) such that n steps of the sequence take x to (a x + c) mod MODULUS."""
    a, c = 1, 0
    for _ in range(n):
        a, c = a * MULTIPLIER % MODULUS, (c * MULTIPLIER + INCREMENT) % MODULUS
    return a, c


def draw(start: Column, n: int) -> Column:
    """The n-th draw (n >= 1) of the sequence from ``start`` in [0, MODULUS): a word in [0, MODULUS)."""
    a, c = jump(n)
    return (start * F.lit(a).cast("bigint") + F.lit(c)) % F.lit(MODULUS).cast("bigint")


def pick(values: tuple[str, ...] | list[str], w: Column) -> Column:
    """Uniform choice from a literal list by a word."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (w % len(values) + 1).cast("int"))


def uuid_text(hex_digest: Column) -> Column:
    """Format a digest as a version-4 shaped UUID string."""
    return F.concat_ws(
        "-",
        F.substring(hex_digest, 1, 8),
        F.substring(hex_digest, 9, 4),
        F.concat(F.lit("4"), F.substring(hex_digest, 14, 3)),
        F.substring(hex_digest, 17, 4),
        F.substring(hex_digest, 21, 12),
    )
