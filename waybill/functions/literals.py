"""Rendering of column values as SQL literals and INSERT statements.

The literals are composed as Spark SQL text: a statement has up to 92 of them, and one expression to parse is
far quicker to plan than the several hundred column objects it would take.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scalars import SPACES, is_clean

DATE_FORM = "dd.MM.yyyy"
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _string(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _trimmed(df: DataFrame, name: str) -> str:
    c = _name(name)
    if is_clean(df, name):
        return c
    plain = " and ".join(f"ascii({end}) between 33 and 126" for end in (c, f"right({c}, 1)"))
    return f"if({plain}, {c}, btrim({c}, {_string(SPACES)}))"


def _quoted(text: str) -> str:
    return f"concat('\\'', {text}, '\\'')"


def _number(c: str, kind: T.DataType) -> str:
    """Number with a decimal dot and no exponent; whole values lose their decimals."""
    whole = f"cast(try_cast({c} as decimal(38,0)) as string)"
    if isinstance(kind, T.DecimalType):
        return f"if({c} % 1 = 0, {whole}, cast({c} as string))"
    # Beyond these bounds the text has an exponent: 1.25E-10. The point is moved by it in the digits of the text.
    plain = f"abs({c}) >= 1e-3 and abs({c}) < 1e7"
    text = f"cast({c} as string)"
    digits = f"rtrim('0', translate(split_part({text}, 'E', 1), '-.', ''))"
    point = f"(1 + try_cast(split_part({text}, 'E', 2) as int))"
    moved = (
        f"concat(if({c} < 0, '-', ''), case when {point} <= 0 then concat('0.', repeat('0', -{point}), {digits}) "
        f"when length({digits}) <= {point} then rpad({digits}, {point}, '0') "
        f"else concat(substr({digits}, 1, {point}), '.', substr({digits}, {point} + 1)) end)"
    )
    return f"case when {plain} and {c} % 1 = 0 then {whole} when {c} = 0 then '0' when {plain} then {text} else coalesce({moved}, {text}) end"


def _literal(text: str | None) -> str:
    """The quoted text, or null where there is none."""
    return "'null'" if text is None else f"coalesce({_quoted(text)}, 'null')"


def value_text(df: DataFrame, name: str) -> str | None:
    """Text of a value before it is quoted; None where a column has none by its type."""
    c, kind = _name(name), df.schema[name].dataType
    if isinstance(kind, (T.BinaryType, T.NullType)):
        return None
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        text = _number(c, kind)
    elif isinstance(kind, TEMPORAL):
        text = f"date_format(cast({c} as date), '{DATE_FORM}')"
    elif isinstance(kind, T.BooleanType):
        text = f"case when {c} then 'True' when not {c} then 'False' end"
    elif isinstance(kind, T.StringType):
        text = f"replace({_trimmed(df, name)}, '\\'', '\\'\\'')"
    else:
        text = f"cast({c} as string)"
    return text


def date_text(df: DataFrame, name: str) -> str | None:
    c, kind = _name(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        text = _trimmed(df, name)
        day = f"substr({text}, 1, 10)"
        packed = f"case when {text} rlike '^[0-9]{{8}}$' then try_to_date({text}, 'yyyyMMdd') end"
        iso = f"case when length({text}) >= 8 then try_cast({text} as date) end"
        c = f"coalesce({packed}, {iso}, try_to_date({day}, 'dd.MM.yyyy'), try_to_date({day}, 'yyyy/MM/dd'))"
    elif not isinstance(kind, TEMPORAL):
        return None
    return f"date_format(cast({c} as date), '{DATE_FORM}')"


def sql_value(df: DataFrame, name: str) -> Column:
    """Literal of a column by its type: null and binary give null, the rest a quoted text, quotes doubled."""
    return F.expr(_literal(value_text(df, name)))


def sql_date(df: DataFrame, name: str) -> Column:
    """Quoted day.month.year literal, or null when the value is no date."""
    return F.expr(_literal(date_text(df, name)))


def insert_statement(df: DataFrame, table: str, spec: list) -> Column:
    """One INSERT statement per row; `spec` lists (column, kind) with kind `value` or `date`."""
    absent = [name for name, _ in spec if name not in df.columns]
    if absent:
        raise ValueError(f"columns missing for {table}: {', '.join(absent)}")
    texts = []
    for name, kind in spec:
        text = (date_text if kind == "date" else value_text)(df, name)
        # Most cells of a row are null, which one look tells before any text is made or parsed.
        texts.append("cast(null as string)" if text is None else f"if({_name(name)} is null, null, {text})")
    head = f"INSERT INTO {table} ({', '.join(n for n, _ in spec)}) VALUES ("
    # Quoted in one place: as one literal after another the code for a row is too long to be compiled, and slower.
    quoted = f"transform(array({', '.join(texts)}), x -> if(x is null, 'null', {_quoted('x')}))"
    return F.expr(f"concat({_string(head)}, concat_ws(',', {quoted}), ');')")
