"""First or last row per key as one number per key.

The order columns and the columns that go with them are written as digits of one whole number,
whose ranges are measured first. It sorts as the columns do, null first, so `min` / `max` of
it picks the row, and it has a fixed width: Spark sums it up in hash maps, where a struct needs
both sides of the shuffle sorted. The digits are then read back. Columns that are no whole numbers,
dates, times or flags, or rows over 126 bits, go the way of `operators.loading`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators import loading

WORD_BITS = 63
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _code(name: str, kind: T.DataType) -> Column | None:
    """The column as a whole number in its own order; None if it has none."""
    c = F.col(name)
    if isinstance(kind, WHOLE):
        return c.cast("long")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    return None


def _uncoded(code: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(code.cast("int"))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(code)
    return code.cast(kind)


@dataclass(frozen=True)
class Digit:
    name: str
    kind: T.DataType
    low: int
    high: int  # below `low` if the column is always null
    bits: int

    def of_row(self) -> Column:
        """0 for null, else 1 and up. A value outside the measured range ends the query: the source has changed."""
        code = _code(self.name, self.kind)
        inside = F.when(code.between(self.low, self.high), code - F.lit(self.low) + 1)
        return F.when(code.isNull(), F.lit(0).cast("long")).otherwise(
            inside.otherwise(F.raise_error(F.lit(f"{self.name} left its measured range")).cast("long")))

    def back(self, digit: Column) -> Column:
        return F.when(digit != 0, _uncoded(digit + F.lit(self.low - 1), self.kind))


@dataclass(frozen=True)
class Packing:
    """Digits in one word of 63 bits, or in two."""

    words: tuple[tuple[Digit, ...], ...]

    def number(self) -> Column:
        words = [self._word(w) for w in self.words]
        if len(words) == 1:
            return words[0]
        size = F.lit(Decimal(1 << WORD_BITS)).cast("decimal(19,0)")
        return words[0].cast("decimal(19,0)") * size + words[1].cast("decimal(19,0)")

    @staticmethod
    def _word(digits: Sequence[Digit]) -> Column:
        out = F.lit(0).cast("long")
        for d in digits:
            out = F.shiftleft(out, d.bits).bitwiseOR(d.of_row())
        return out

    def columns(self, number: Column) -> dict[str, Column]:
        if len(self.words) == 1:
            words = [number]
        else:
            size = F.lit(Decimal(1 << WORD_BITS)).cast("decimal(19,0)")
            words = [F.call_function("div", number, size), (number % size).cast("long")]
        out = {}
        for word, digits in zip(words, self.words):
            for d in reversed(digits):
                out[d.name] = d.back(word.bitwiseAND(F.lit((1 << d.bits) - 1)))
                word = F.shiftright(word, d.bits)
        return out


def _words(digits: Sequence[Digit]) -> tuple[tuple[Digit, ...], ...] | None:
    words, room = [[]], WORD_BITS
    for d in digits:
        if d.bits > room:
            words.append([])
            room = WORD_BITS
        if d.bits > room or len(words) > 2:
            return None
        words[-1].append(d)
        room -= d.bits
    return tuple(map(tuple, words))


def measure(df: DataFrame, columns: Sequence[str]) -> Packing | None:
    """Ranges of the columns in one pass over them; None where they do not fit."""
    kinds = {c: df.schema[c].dataType for c in columns}
    codes = {c: _code(c, kinds[c]) for c in columns}
    if not columns or any(code is None for code in codes.values()):
        return None
    found = df.agg(*[f(code).alias(f"{c}_{name}") for c, code in codes.items() for f, name in ((F.min, "low"), (F.max, "high"))]).first()
    digits = []
    for c in columns:
        low, high = found[f"{c}_low"], found[f"{c}_high"]
        if low is None:
            low, high = 1, 0
        # `low - 1` and all steps from it must be 64-bit numbers.
        if low == -(1 << 63) or high - low + 1 >= 1 << WORD_BITS:
            return None
        digits.append(Digit(c, kinds[c], low, high, max(1, (high - low + 1).bit_length())))
    words = _words(digits)
    return None if words is None else Packing(words)


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    place = [o for o in order if o not in keys]
    rest = [c for c in df.columns if c not in keys and c not in place]
    packing = measure(df, place + rest)
    if packing is None:
        return (loading.last_per_key if last else loading.first_per_key)(df, keys, order)
    chosen = df.groupBy(*keys).agg((F.max if last else F.min)(packing.number()).alias("_row"))
    back = packing.columns(F.col("_row"))
    return chosen.select(*[c if c in keys else back[c].alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """As `loading.first_per_key`, ties included. `df` is read twice, the first time for its ranges:
    for plain scans and stored tables, not for costly plans."""
    return _one_per_key(df, keys, order, last=False)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, order, last=True)
