"""Hex words: 32-byte words as lower-case hex text, numbers in them, and their byte order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 64  # hex digits of a 32-byte word
TWO_64 = 2**64
# Largest high half for which high * 2^64 + low still has at most 38 digits.
HIGH_END = (10**38 - 1) // TWO_64


def hex_text(data: Column) -> Column:
    return F.lower(F.hex(data))


def word_from_number(number: Column) -> Column:
    """A non-negative BIGINT as a 32-byte big-endian word."""
    return F.lpad(F.lower(F.hex(number.cast("bigint"))), WORD, "0")


def right_padded_word(data: Column) -> Column:
    """Bytes as a 32-byte word, zeros appended: the form a little-endian number of these bytes has."""
    return F.rpad(hex_text(data), WORD, "0")


def _u64(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("decimal(20,0)")


def word_to_bigint(word: Column) -> Column:
    """The number in a word as BIGINT, NULL when it is larger."""
    low = _u64(F.substring(word, 49, 16))
    return F.when(
        (F.length(word) == WORD) & (F.substring(word, 1, 48) == "0" * 48), low.try_cast("bigint")
    )


def word_to_decimal(word: Column) -> Column:
    """The number in a word as DECIMAL(38,0), NULL when it has more digits."""
    high = _u64(F.substring(word, 33, 16))
    low = _u64(F.substring(word, 49, 16))
    small = (F.length(word) == WORD) & (F.substring(word, 1, 32) == "0" * 32)
    return F.when(
        small & (high < F.lit(Decimal(HIGH_END))),
        (high.cast("decimal(38,0)") * F.lit(Decimal(TWO_64)) + low).cast("decimal(38,0)"),
    )


def word_to_text(word: Column) -> Column:
    """The number in a word as decimal text, whatever its size.

    Numbers of up to 38 digits go through DECIMAL. Larger ones are carried as six limbs in base
    10^13, sixteen bits at a time; every step stays inside BIGINT.
    """
    base = 10**13

    def push(limbs: Column, chunk: Column) -> Column:
        start = F.struct(F.array().cast("array<bigint>").alias("done"), chunk.alias("carry"))

        def one(state: Column, limb: Column) -> Column:
            total = limb * F.lit(65536).cast("bigint") + state["carry"]
            rest = total % base
            # The quotient is a whole number below 2^17, so rounding the division gives it exactly.
            return F.struct(
                F.array_append(state["done"], rest).alias("done"),
                F.round((total - rest) / base).cast("bigint").alias("carry"),
            )

        return F.aggregate(limbs, start, one)["done"]

    chunks = F.transform(
        F.sequence(F.lit(0), F.lit(15)),
        lambda i: F.conv(F.substring(word, i * 4 + 1, F.lit(4)), 16, 10).cast("bigint"),
    )
    zero = F.array(*[F.lit(0).cast("bigint")] * 6)
    limbs = F.aggregate(chunks, zero, push)
    digits = F.array_join(
        F.transform(F.reverse(limbs), lambda limb: F.lpad(limb.cast("string"), 13, "0")), ""
    )
    return F.coalesce(
        word_to_decimal(word).cast("string"),
        F.when(F.length(word) == WORD, F.ltrim(digits, F.lit("0"))),
    )


def bytes_to_word(data: Column) -> Column:
    """Up to 32 big-endian bytes as a word; NULL stands for zero."""
    return F.lpad(F.coalesce(hex_text(data), F.lit("")), WORD, "0")


def little_endian_hex(word: Column) -> Column:
    """The number in a word as signed little-endian bytes in hex: shortest form, with a zero byte
    appended when the top bit is set."""
    even = F.regexp_extract(word, "^(?:00)*((?:..)+)$", 1)
    swapped = F.regexp_replace(F.reverse(even), "(.)(.)", "$2$1")
    return F.concat(swapped, F.when(F.substring(even, 1, 1) >= "8", F.lit("00")).otherwise(F.lit("")))


# The prime of the field whose digits stand for a number (fixed value).
FIELD_PRIME = 2**64 - 2**32 + 1
FIELD_DIGITS = 5
LIMB = 2**32


def byte_swapped(digits: Column) -> Column:
    """Hex text with its bytes in the other order."""
    return F.regexp_replace(F.reverse(digits), "(.)(.)", "$2$1")


def field_digits(word: Column) -> Column:
    """The number of a 32-byte little-endian word as five digits in base FIELD_PRIME, the lowest first, each as 8
    little-endian bytes in hex.

    The number is up to eight limbs of 32 bits, without zeros in front. Dividing them by the prime, from the highest
    on, leaves the limbs of the quotient and one digit. A remainder times 2^32 plus a limb stays below 2^96 and so
    inside DECIMAL.
    """
    prime, limb = F.lit(Decimal(FIELD_PRIME)), F.lit(Decimal(LIMB))
    none = F.array().cast("array<decimal(10,0)>")

    def split(number: Column) -> Column:
        size = F.ceil(F.length(number) / 8).cast("int")
        padded = F.lpad(number, size * 8, F.lit("0"))
        parts = F.transform(
            F.sequence(F.lit(1), size * 8, F.lit(8)),
            lambda at: F.conv(F.substring(padded, at, F.lit(8)), 16, 10).cast("decimal(10,0)"),
        )
        return F.when(size > 0, parts).otherwise(none)

    limbs = F.transform(F.array(F.ltrim(byte_swapped(word), F.lit("0"))), split)[0]
    zero = F.struct(none.alias("quotient"), F.lit(0).cast("decimal(20,0)").alias("rest"))

    def divided(quotient: Column, total: Column) -> Column:
        upper = F.call_function("div", total, prime).cast("decimal(10,0)")
        in_front = (F.size(quotient) == 0) & (total < prime)
        return F.struct(
            F.when(in_front, quotient).otherwise(F.array_append(quotient, upper)).alias("quotient"),
            (total % prime).cast("decimal(20,0)").alias("rest"),
        )

    def one(state: Column, part: Column) -> Column:
        total = (state["rest"] * limb + part).cast("decimal(38,0)")
        return F.transform(F.array(total), lambda t: divided(state["quotient"], t))[0]

    def digit(state: Column, _: Column) -> Column:
        return F.transform(
            F.array(F.aggregate(state["limbs"], zero, one)),
            lambda d: F.struct(
                d["quotient"].alias("limbs"), F.array_append(state["digits"], d["rest"]).alias("digits")
            ),
        )[0]

    start = F.struct(limbs.alias("limbs"), F.array().cast("array<decimal(20,0)>").alias("digits"))
    digits = F.aggregate(F.sequence(F.lit(1), F.lit(FIELD_DIGITS)), start, digit)["digits"]
    shown = F.transform(digits, lambda d: byte_swapped(F.lpad(F.lower(F.conv(d.cast("string"), 10, 16)), 16, "0")))
    return F.when(F.length(word) == WORD, F.array_join(shown, ""))
