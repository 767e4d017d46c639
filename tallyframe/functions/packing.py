"""Columns of codes as one number, for rows that tasks buffer, sort and shuffle in great numbers.

A code of a few letters takes 16 bytes in a row of Spark's. Its place among the known codes takes a few bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.codes import STANDARD_CODES
from tallyframe.functions.sqltext import literal

PACKED = "__packed"
#: the values of a row that are in no list, in the order of the columns; NULL where there are none
OTHERS = "__others"
_PLACE = "__place_{}"
#: below three columns the two that replace them take no less
_LEAST = 3
_BITS = 63

Codes = Mapping[str, Mapping[str, str]]


def packable(df: DataFrame, columns: Iterable[str], codes: Codes = STANDARD_CODES) -> list[str]:
    """Those of ``columns`` that ``pack`` makes one number of: plain strings with known codes, as many as fit."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    found, bits = [], 0
    for c in columns:
        if codes.get(c) and fields.get(c) == T.StringType():
            bits += 1 + len(codes[c]).bit_length()
            if bits <= _BITS:
                found.append(c)
    return found if len(found) >= _LEAST else []


def _placed(columns: Iterable[str], codes: Codes) -> Iterator[tuple[int, str, str, int, int]]:
    """Number, name, list of codes as SQL, first bit and number of bits of each column, after one bit a column."""
    columns = list(columns)
    first = len(columns)
    for i, c in enumerate(columns):
        bits = len(codes[c]).bit_length()
        yield i, c, "array(" + ", ".join(map(literal, codes[c])) + ")", first, bits
        first += bits


def pack(df: DataFrame, columns: Iterable[str], codes: Codes = STANDARD_CODES) -> DataFrame:
    """``df`` with one number in place of ``columns``: a bit for each that has a value in no list, and their places.

    Places in the lists of codes count from 1 and are 0 for NULL. Values in no list are kept as they are, in an array.
    The two come out of a generator. Spark moves a filter on an unpacked column down to here and no further; with plain columns it
    would put what makes them in place of each use of them, again and again, until the driver's memory is full.
    """
    placed = list(_placed(columns, codes))
    if not placed:
        return df
    place = [_PLACE.format(i) for i, *_ in placed]
    found = df.withColumns({p: F.expr(f"array_position({known}, {c})") for p, (_, c, known, _, _) in zip(place, placed)})
    number = " | ".join(
        f"CASE {p} WHEN 0 THEN {1 << i}L ELSE shiftleft(coalesce({p}, 0L), {first}) END"
        for p, (i, _, _, first, _) in zip(place, placed)
    )
    others = ", ".join(
        f"CASE {p} WHEN 0 THEN array({c}) ELSE cast(array() AS array<string>) END" for p, (_, c, *_) in zip(place, placed)
    )
    some = " OR ".join(f"{p} = 0" for p in place)
    made = f"named_struct('{PACKED}', {number}, '{OTHERS}', CASE WHEN {some} THEN concat({others}) END)"
    gone = {*place, *[c for _, c, *_ in placed]}
    return found.select(*[c for c in found.columns if c not in gone], F.expr(f"inline(array({made}))"))


def unpack(df: DataFrame, columns: Iterable[str], codes: Codes = STANDARD_CODES) -> DataFrame:
    """The columns again, after what is left of ``df``. Takes the columns and codes that ``pack`` was given."""
    placed = list(_placed(columns, codes))
    if not placed:
        return df
    return df.withColumns(
        {
            c: F.expr(
                f"if({PACKED} & {1 << i}L = 0, get({known}, int(shiftright({PACKED}, {first}) & {(1 << bits) - 1}L) - 1), "
                f"get({OTHERS}, bit_count({PACKED} & {(1 << i) - 1}L)))"
            )
            for i, c, known, first, bits in placed
        }
    ).drop(PACKED, OTHERS)
