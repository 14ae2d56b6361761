"""Single-byte code pages that Spark's own charset list leaves out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def char_of(byte: int, codepage: str) -> str:
    """Character of one byte; bytes the code page leaves open keep their number."""
    try:
        return bytes([byte]).decode(codepage)
    except UnicodeDecodeError:
        return chr(byte)


def upper_half(codepage: str) -> str:
    """The characters of bytes 128-255."""
    return "".join(char_of(b, codepage) for b in range(128, 256))


def decode(data: Column, codepage: str) -> Column:
    """Binary column to text: read as Latin-1, then move the upper half to the code page."""
    latin = "".join(map(chr, range(128, 256)))
    return F.translate(F.decode(data, "ISO-8859-1"), latin, upper_half(codepage))
