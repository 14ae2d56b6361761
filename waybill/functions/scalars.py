"""Column functions shared by the audits and the imports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Status code -> label, feminine for lines and masculine for courses.
LINE_STATUS = {1: "projektowana", 2: "aktywna", 3: "zawieszona", 4: "zlikwidowana"}
COURSE_STATUS = {1: "projektowany", 2: "aktywny", 3: "zawieszony", 4: "zlikwidowany"}
UNKNOWN_STATUS = "bd"

# Employee statuses that are kept, and the one all others become.
EMPLOYEE_STATUSES = ("7", "8")
DEFAULT_EMPLOYEE_STATUS = "8"

# Fixed value: lower bound that stands in for a missing date.
MIN_DATE = "0001-01-01"


# Fixed value: the white space that is trimmed, as code points of Unicode.
SPACES = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


# Metadata of columns that are canonical text, without outer white space.
CLEAN = "clean"
# Columns with this name hold the texts of unreadable cells by column name.
UNREAD = "unread"


def trimmed(c: Column) -> Column:
    """Text of a value without outer white space; null stays null.

    Most values begin and end with printed characters of ASCII, which a look at both ends tells faster than trimming.
    """
    text = c.cast("string")
    ends = F.ascii(text), F.ascii(F.right(text, F.lit(1)))
    plain = ends[0].between(0x21, 0x7E) & ends[1].between(0x21, 0x7E)
    return F.when(plain, text).otherwise(F.btrim(text, F.lit(SPACES)))


def is_clean(df: DataFrame, name: str) -> bool:
    return df.schema[name].metadata.get(CLEAN, False)


def unread_text(df: DataFrame, name: str) -> Column:
    """Text of a cell that is not what its field says; null for all others."""
    return F.try_element_at(F.col(UNREAD), F.lit(name)) if UNREAD in df.columns else F.lit(None).cast("string")


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def text_of(df: DataFrame, name: str) -> Column:
    """Trimmed text of a column. Numbers lose decimals that are zero, so that it doesn't matter how many there are."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.col(name) if is_clean(df, name) else trimmed(F.col(name))
    if isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
        text = F.col(name).cast("string")
        point = F.contains(text, F.lit(".")) & ~F.contains(text, F.lit("E"))
        return F.when(point, F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)
    return F.col(name).cast("string")


def int_of(df: DataFrame, name: str) -> Column:
    """Whole number of a column; straight from numbers without decimals, else by way of its text."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType) or (isinstance(kind, T.DecimalType) and kind.scale == 0):
        return F.col(name).try_cast("int")
    if isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
        return F.when(F.col(name) % 1 == 0, F.col(name).try_cast("int"))
    return F.col(name).try_cast("int") if is_clean(df, name) else to_int(F.col(name))


def upper_key(c: Column) -> Column:
    """Case-insensitive comparison key."""
    return F.upper(c)


def is_blank(c: Column) -> Column:
    """Null, empty, or white space only."""
    return c.isNull() | (trimmed(c) == "")


def to_int(c: Column) -> Column:
    """Whole number written as text; null when it is anything else."""
    return trimmed(c).try_cast("int")


def to_version(c: Column) -> Column:
    """Version text as a number with a decimal dot, so 1.10 equals 1.1."""
    return trimmed(c).try_cast("float")


def parse_date(c: Column, clean: bool = False) -> Column:
    """Date written as text, in ISO, archive (yyyyMMdd) or day.month.year form, a time of day being ignored.

    Text known to be `clean` isn't trimmed, which keeps the code for a row short enough to be compiled.
    """
    text = c if clean else trimmed(c)
    return F.coalesce(
        F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd")),
        F.when(F.length(text) >= 8, text.try_cast("date")),
        F.try_to_date(F.substring(text, 1, 10), "dd.MM.yyyy"),
        F.try_to_date(F.substring(text, 1, 10), "yyyy/MM/dd"),
    )


def date_of(df: DataFrame, name: str) -> Column:
    """A column as date, or as timestamp when it is one; null when it is no date."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(name)
    if isinstance(kind, T.StringType):
        return parse_date(F.col(name), is_clean(df, name))
    return F.lit(None).cast("date")


def to_date_or_min(df: DataFrame, name: str) -> Column:
    return F.coalesce(date_of(df, name).cast("date"), F.lit(MIN_DATE).cast("date"))


def to_ts_or_min(df: DataFrame, day: str, time: str) -> Column:
    """Date column plus time-of-day text; the lower bound when either does not parse."""
    clock = trimmed(F.col(time))
    joined = F.concat_ws(" ", F.date_format(date_of(df, day), "yyyy-MM-dd"), clock)
    stamp = F.coalesce(
        *[
            F.try_to_timestamp(joined, F.lit(f"yyyy-MM-dd {form}"))
            for form in ("H:mm:ss", "H:mm", "HHmm", "HHmmss")
        ]
    )
    usable = F.col(day).isNotNull() & F.col(time).isNotNull()
    return F.coalesce(F.when(usable, stamp).cast("timestamp_ntz"), F.lit(MIN_DATE).cast("timestamp_ntz"))


def years_ago(today: dt.date, years: int = 1) -> Column:
    return F.add_months(F.lit(today), -12 * years)


def format_date(c: Column) -> Column:
    return F.date_format(c, "dd.MM.yyyy")


def _label(code: Column, labels: dict) -> Column:
    out = F.lit(UNKNOWN_STATUS)
    for value, text in labels.items():
        out = F.when(code == value, text).otherwise(out)
    return out


def line_status(c: Column, codes=(1, 2, 3, 4)) -> Column:
    """Label of a line status; `codes` are the column's values for the four labels."""
    return _label(c, dict(zip(codes, LINE_STATUS.values())))


def course_status(c: Column, codes=(1, 2, 3, 4)) -> Column:
    return _label(c, dict(zip(codes, COURSE_STATUS.values())))


def default_status(c: Column, allowed=EMPLOYEE_STATUSES, default=DEFAULT_EMPLOYEE_STATUS) -> Column:
    """Keep an allowed status, replace every other one, null included."""
    return F.when(c.isin(*allowed), c).otherwise(F.lit(default))


def is_model(c: Column, model: str) -> Column:
    """Exact device model test; null is not a match."""
    return F.coalesce(c == model, F.lit(False))


def int_or(df: DataFrame, name: str, default: int) -> Column:
    """Whole number, with a default for null only (unreadable text and cells stay null)."""
    missing = F.col(name).isNull() & unread_text(df, name).isNull()
    return F.when(missing, F.lit(default)).otherwise(int_of(df, name))
