"""Fourteen-digit entity keys: cleaning and check digits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_LENGTH = 14

# The published weights of the two check digits.
FIRST_DIGIT_WEIGHTS = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
SECOND_DIGIT_WEIGHTS = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)


def digits_only(raw: Column) -> Column:
    return F.regexp_replace(raw, r"\D", "")


PAIRS = 6
SUMS = 9 * 11  # room for a sum of digit-times-weight remainders


def _closing_digit(total: int) -> int:
    rest = total % 11
    return 0 if rest < 2 else 11 - rest


def _pair_table(pair: int) -> list[int]:
    """For two digits in their place: both weighted sums modulo 11, packed in one number."""
    place = 2 * pair
    packed = []
    for value in range(100):
        digits = divmod(value, 10)
        first = sum(d * w for d, w in zip(digits, FIRST_DIGIT_WEIGHTS[place:])) % 11
        second = sum(d * w for d, w in zip(digits, SECOND_DIGIT_WEIGHTS[place:])) % 11
        packed.append(first + SUMS * second)
    return packed


def _closing_table() -> list[int]:
    """For the packed sums of all pairs: the two digits that close the key."""
    closing = []
    for packed in range(SUMS * (10 * PAIRS + 1)):
        second, first = divmod(packed, SUMS)
        digit = _closing_digit(first)
        closing.append(10 * digit + _closing_digit(second + digit * SECOND_DIGIT_WEIGHTS[12]))
    return closing


def _lookup(table: list[int], index: Column) -> Column:
    return F.get(F.expr(f"array({','.join(map(str, table))})"), index.cast("int"))


def _div(number: Column, power: int) -> Column:
    return F.call_function("div", number, F.lit(10**power).cast("bigint"))


def closing_digits(base: Column) -> Column:
    """The two check digits, as 0..99, of the first twelve digits as a whole number.

    Six table lookups: spelling out every place makes generated code too long for
    the JVM to compile, and an interpreted method is many times slower.
    """
    total = F.lit(0)
    for pair in range(PAIRS):
        total = total + _lookup(_pair_table(pair), _div(base, 10 - 2 * pair) % 100)
    return _lookup(_closing_table(), total)


def check_digits_match(key: Column) -> Column:
    """True for a well-formed key, false otherwise, null for null.

    A few integer operations per row cost far less than the shuffle that judging
    each distinct key once would need.
    """
    number = key.try_cast("bigint")
    return (
        key.rlike(r"^[0-9]{14}$")
        & (key != F.repeat(F.substring(key, 1, 1), KEY_LENGTH))
        & (number % 100 == closing_digits(_div(number, 2)))
    )


def key_problem(key: Column) -> Column:
    """Why a cleaned key cannot be used, or null when it can."""
    return F.when(key.isNull() | (F.length(key) != KEY_LENGTH), "key must have 14 digits").when(
        ~check_digits_match(key), "key fails its check digits"
    )


def with_normalised_key(frame: DataFrame, raw: str, clean: str, problem: str) -> DataFrame:
    """Add the clean key, null where the raw text holds none, and why it does not.

    Cleaning is a projection of its own: the check digits read each place of the
    clean text, and must not clean it again every time.
    """
    cleaned = frame.withColumn(clean, digits_only(F.col(raw)))
    judged = cleaned.withColumn(problem, key_problem(F.col(clean)))
    return judged.withColumn(clean, F.when(F.col(problem).isNull(), F.col(clean)))
