"""Fixed-width records of a DBF member as Arrow columns of canonical text.

A cell's text depends on the cell and on the kind of its own header's field alone: numbers without leading and trailing
zeros, dates in one form, logical values as True and False, blank ones null, text without its padding. Cells that are none of
what their field says are null, and their text is kept beside the record.
"""

from __future__ import annotations

import struct
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions.codepages import char_of

# White space removed from both ends of a field, and two marks of the file format.
WHITESPACE = " \t\n\r\x0b\x0c\x85\xa0"  # the first six are ASCII
DELETED = 0x2A
FIELDS_END = 0x0D


class Field(NamedTuple):
    name: str
    kind: str
    offset: int
    length: int
    decimals: int


class Header(NamedTuple):
    records: int
    length: int
    record_length: int
    fields: list


def read_header(stream) -> Header:
    start = stream.read(32)
    if len(start) < 32:
        raise ValueError("DBF header is cut short")
    records, length, record_length = struct.unpack_from("<IHH", start, 4)
    rest = stream.read(length - 32)
    fields, offset, at = [], 1, 0
    while at + 32 <= len(rest) and rest[at] != FIELDS_END:
        name = rest[at : at + 11].split(b"\0")[0].decode("latin-1").strip().upper()
        field = Field(name, chr(rest[at + 11]), offset, rest[at + 16], rest[at + 17])
        fields.append(field)
        offset += field.length
        at += 32
    return Header(records, length, record_length, fields)


def _text(block: np.ndarray, kind: str, characters: np.ndarray) -> pa.Array:
    """One field of all records as text without its padding."""
    if kind == "I":
        return pa.array(np.ascontiguousarray(block).view("<i4").ravel()).cast(pa.string())
    if block.max(initial=0) < 128:
        ascii_bytes = np.ascontiguousarray(block).view(f"S{block.shape[1]}").ravel()
        return pc.ascii_trim(pa.array(ascii_bytes, pa.binary()).cast(pa.string()), characters=WHITESPACE[:6])
    wide = np.ascontiguousarray(characters[block]).view(f"U{block.shape[1]}").ravel()
    return pa.array(np.strings.strip(wide, WHITESPACE), pa.string())


# The letters of logical fields, and a date field that was never filled.
TRUE, FALSE, UNSET = ("T", "Y", "t", "y"), ("F", "N", "f", "n"), "?"
NO_DATE = "00000000"
ISO_DATE, DAY_FIRST = "-", "."  # forms of dates: 2024-01-31 and 31.01.2024

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
PLAIN = r"^(0|-?[1-9][0-9]*)$"
DECIMAL = r"^-?(0|[1-9][0-9]*)\.[0-9]*$"
POWER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]{1,3}$"
# In turn: no plus sign, a digit before the point, no more zeros than needed before and behind, no negative zero.
PLAINER = ((r"^\+", ""), (r"^(-?)\.", r"\10."), (r"^(-?)0+([0-9])", r"\1\2"), (r"(\.[0-9]*?)0+$", r"\1"), (r"\.$", ""), (r"^-0$", "0"))


def _numbers(text: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Canonical numbers, and which cells are unreadable."""
    blank = pc.equal(text, "")
    plain = pc.match_substring_regex(text, PLAIN)
    if pc.all(pc.or_(blank, plain)).as_py():
        return pc.if_else(blank, None, text), pc.and_(blank, False)
    rest = pc.invert(pc.or_(blank, plain))
    decimal = pc.match_substring_regex(text.filter(rest), DECIMAL)
    if pc.all(decimal).as_py():  # only the zeros behind are too many
        short = pc.ascii_rtrim(pc.ascii_rtrim(text.filter(rest), "0"), ".")
        shown = pc.replace_with_mask(text, rest, pc.if_else(pc.equal(short, "-0"), "0", short))
        return pc.if_else(blank, None, shown), pc.and_(blank, False)
    power = pc.match_substring_regex(text, POWER)
    if pc.any(power).as_py():
        moved = [format(Decimal(t), "f") if p else t for t, p in zip(text.to_pylist(), power.to_pylist())]
        text = pc.if_else(power, pa.array(moved, pa.string()), text)
    sound = pc.match_substring_regex(text, NUMBER)
    shown = text
    for pattern, by in PLAINER:
        shown = pc.replace_substring_regex(shown, pattern, by)
    return pc.if_else(sound, shown, None), pc.invert(pc.or_(sound, blank))


LAST_DAYS = np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])


def _are_days(text: pa.Array, digits: pa.Array) -> pa.Array:
    """Whether texts of eight digits are days of the calendar; other texts are none."""
    at = digits.to_numpy(zero_copy_only=False)
    number = text.filter(digits).cast(pa.int64()).to_numpy()
    year, month, day = number // 10000, number // 100 % 100, number % 100
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    sound = np.zeros(len(text), bool)
    sound[at] = (month >= 1) & (month <= 12) & (day >= 1) & (day <= LAST_DAYS[np.minimum(month, 12)] + (leap & (month == 2)))
    return pa.array(sound)


def _dates(text: pa.Array, form: str) -> tuple[pa.Array, pa.Array]:
    blank = pc.or_(pc.equal(text, ""), pc.equal(text, NO_DATE))
    digits = pc.match_substring_regex(text, "^[0-9]{8}$")
    sound = _are_days(text, digits)
    parts = [pc.utf8_slice_codeunits(text, a, b) for a, b in ((0, 4), (4, 6), (6, 8))]
    shown = pc.binary_join_element_wise(*(parts if form == ISO_DATE else parts[::-1]), form)
    return pc.if_else(sound, shown, None), pc.invert(pc.or_(sound, blank))


def _logicals(text: pa.Array) -> tuple[pa.Array, pa.Array]:
    true, false = (pc.is_in(text, value_set=pa.array(v)) for v in (TRUE, FALSE))
    unset = pc.is_in(text, value_set=pa.array(["", UNSET]))
    shown = pc.if_else(true, "True", pc.if_else(false, "False", None))
    return shown, pc.invert(pc.or_(pc.or_(true, false), unset))


def canonical(text: pa.Array, kind: str, dates: str = ISO_DATE) -> tuple[pa.Array, pa.Array | None]:
    """Cells of one field by its kind, and which of them are unreadable (None where no text is)."""
    if kind in "NF":
        return _numbers(text)
    if kind == "D":
        return _dates(text, dates)
    if kind == "L":
        return _logicals(text)
    return text, None


def unread_map(count: int, found: dict[str, tuple[pa.Array, pa.Array]]) -> pa.Array:
    """For each record its unreadable cells, column -> text, from {column: (texts, which are unreadable)}."""
    rows, names, texts = [np.empty(0, np.int64)], [], [pa.array([], pa.string())]
    for name, (text, bad) in found.items():
        at = np.flatnonzero(bad.to_numpy(zero_copy_only=False))
        rows.append(at)
        names += [name] * len(at)
        texts.append(text.take(pa.array(at)))
    rows = np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    bounds = pa.array(np.searchsorted(rows[order], np.arange(count + 1)), pa.int32())
    keys = pa.array(names, pa.string()).take(pa.array(order))
    return pa.MapArray.from_arrays(bounds, keys, pa.concat_arrays(texts).take(pa.array(order)))


def read_columns(
    stream, header: Header, names: list, start: int, stop: int, codepage: str, dates: str = ISO_DATE, chunk: int = 16384
):
    """Yield (records seen, record numbers, {name: canonical text}, unreadable cells) for the live records in [start, stop)."""
    page = np.array([ord(char_of(b, codepage)) for b in range(256)], dtype=np.uint32)
    plain = np.arange(256, dtype=np.uint32)
    wanted = {f.name: f for f in header.fields if f.name in names and f.length}
    size = header.record_length
    stream.seek(header.length + start * size)
    at = start
    while at < stop:
        data = stream.read(size * min(chunk, stop - at))
        got = len(data) // size
        if not got:
            return
        rows = np.frombuffer(data, np.uint8, got * size).reshape(got, size)
        live = rows[:, 0] != DELETED
        rec_no = (np.arange(at, at + got, dtype=np.int64) + 1)[live]
        rows = rows[live]
        columns, unread = {}, {}
        for n, f in wanted.items():
            text = _text(rows[:, f.offset : f.offset + f.length], f.kind, page if f.kind in "CNFDL" else plain)
            columns[n], bad = canonical(text, f.kind, dates)
            if bad is not None and pc.any(bad).as_py():
                unread[n] = text, bad
        yield got, rec_no, columns, unread_map(len(rec_no), unread)
        at += got
