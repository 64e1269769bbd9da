"""Reproducible uniforms from integers, equal on every engine with 64-bit integers.

A draw is a pure function of (seed, draw number, entity code, position), so a
lost task recomputes the same numbers and no generator state travels.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The modulus 2^31 - 1, the multipliers and the additive terms.
MODULUS = 2147483647
DRAW_STEP = 1103515245
POSITION_STEP = 69069069
MIX = 48271
ADDED = (12345, 67891, 24689)
# Bits of a code that enter before the first squaring; the others enter after it.
HALF = 30


def _big(value: int) -> Column:
    return F.lit(value).cast("bigint")


def entity_code(entity: Column) -> Column:
    """A 60-bit code from the first fifteen hex digits of the key's md5."""
    text = F.substring(F.md5(entity.cast("string").cast("binary")), 1, 15)
    return F.conv(text, 16, 10).cast("bigint")


def _square(x: Column, added: Column) -> Column:
    return (x * x + added) % _big(MODULUS)


def hashed_integer(seed: int, draw: Column, code: Column, position: Column) -> Column:
    """A value in [0, 2^31 - 1), by three squaring rounds over the inputs."""
    m = _big(MODULUS)
    x = (draw.cast("bigint") * _big(DRAW_STEP) + _big(seed)) % m
    code = code.cast("bigint")
    x = _square((x + code % _big(1 << HALF)) % m, _big(ADDED[0]) + F.shiftright(code, HALF))
    x = _square((x * _big(MIX) + position.cast("bigint") * _big(POSITION_STEP)) % m, _big(ADDED[1]))
    return _square((x * _big(MIX)) % m, _big(ADDED[2]))


def uniform(seed: int, draw: Column, code: Column, position: Column) -> Column:
    return hashed_integer(seed, draw, code, position) / F.lit(float(MODULUS))
