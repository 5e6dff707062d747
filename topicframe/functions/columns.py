"""Column builders shared by decoders and encoders. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: str | Column) -> Column:
    """Value as text: strings stay, binary is read as UTF-8, others use their text form."""
    return col_of(c).cast("string")


def utf8_bytes(c: str | Column) -> Column:
    """UTF-8 bytes of the text form of a value; binary passes unchanged; null stays null."""
    return col_of(c).cast("string").cast("binary")


def delimited(cols: Sequence[str | Column], sep: str = ",") -> Column:
    """Join the text form of ``cols`` with ``sep``; null becomes the empty string.

    Deliberately no quoting and no escaping (the reference's CSV writer does
    neither). Unlike ``concat_ws`` a null keeps its slot, so columns never shift.
    """
    return F.array_join(F.array(*[as_text(c) for c in cols]), sep, "")


def int32_be(c: str | Column) -> Column:
    """4-byte big-endian two's-complement encoding of an int column."""
    v = col_of(c).cast("bigint")
    return F.unhex(F.lpad(F.hex(F.when(v < 0, v + F.lit(1 << 32)).otherwise(v)), 8, "0"))


def from_int32_be(c: str | Column) -> Column:
    """Inverse of :func:`int32_be` for a 4-byte binary column."""
    u = F.conv(F.hex(col_of(c)), 16, 10).cast("bigint")
    return F.when(u >= F.lit(1 << 31), u - F.lit(1 << 32)).otherwise(u).cast("int")
