"""Columns of a source row by name, with the coercions every document field uses.

The expressions are SQL text: a document has a hundred fields, and one
``selectExpr`` of text plans many times faster than as many column objects.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A SQL expression over one row.
Sql = str

# Fixed value: the characters a full whitespace strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: text forms accepted as numbers.  A trailing d or f, valid in a SQL
# cast, is not one of them; single underscores between digits are.
_DIGITS = r"[0-9](?:_?[0-9])*"
NUMBER = rf"^[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?|(?i:nan|inf|infinity))$"

NULL: Sql = "cast(null as string)"
_DAYS = (T.DateType, T.TimestampType, T.TimestampNTZType)


def quoted(value: str) -> Sql:
    """A text as a SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


_STRIPPED = quoted(WHITESPACE)


def strip(c: Sql) -> Sql:
    return f"btrim({c}, {_STRIPPED})"


def non_blank(c: Sql) -> Sql:
    """The stripped text, or null when nothing is left of it."""
    return f"nullif({strip(c)}, '')"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute a value once a row and use it several times.

    A column used inside a lambda can be replaced by its definition when a
    filter is pushed below it, and would then be computed per element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


class Columns:
    """A frame's columns by name; a name the frame lacks reads as null."""

    def __init__(self, df: DataFrame):
        self._types = {f.name: f.dataType for f in df.schema.fields}

    def __contains__(self, name: str) -> bool:
        return name in self._types

    def names(self) -> list[str]:
        return list(self._types)

    def type(self, name: str) -> T.DataType:
        return self._types.get(name, T.StringType())

    def _is(self, name: str, *kinds: type) -> bool:
        return name in self._types and isinstance(self._types[name], kinds)

    def __getitem__(self, name: str) -> Sql:
        return f"`{name}`" if name in self._types else NULL

    def text(self, name: str) -> Sql:
        """The value as text, the way it prints: booleans as 1/0, doubles without exponent."""
        c = self[name]
        if self._is(name, T.BooleanType):
            return f"cast(cast({c} as int) as string)"
        if self._is(name, T.DoubleType, T.FloatType):
            return _plain_double(c)
        if self._is(name, T.TimestampType, T.TimestampNTZType):
            whole, part = f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')", f"date_format({c}, 'SSSSSS')"
            return f"if({part} = '000000', {whole}, concat_ws('.', {whole}, {part}))"
        return c if self._is(name, T.StringType) or name not in self else f"cast({c} as string)"

    def truthy(self, name: str) -> Sql:
        """The value, or null when it is null, empty text, zero or false."""
        c = self[name]
        if self._is(name, T.BooleanType):
            return f"if({c}, {c}, null)"
        if self._is(name, T.NumericType):
            return f"if({c} <> 0, {c}, null)"
        return c if self._is(name, *_DAYS) or name not in self else f"nullif({c}, '')"

    def truthy_text(self, name: str) -> Sql:
        if self._is(name, T.StringType) or name not in self:
            return self.truthy(name)
        return f"if({self.truthy(name)} is not null, {self.text(name)}, null)"

    def first_truthy(self, *names: str) -> Sql:
        """``a or b or c``: the first truthy value, else the last one as it is."""
        return f"coalesce({', '.join([*map(self.truthy_text, names[:-1]), self.text(names[-1])])})"

    def number(self, name: str) -> Sql:
        """The value as a double, or null when it is not a number."""
        c = self[name]
        if self._is(name, T.BooleanType):
            return f"cast(cast({c} as int) as double)"
        if self._is(name, T.NumericType):
            return f"cast({c} as double)"
        if self._is(name, T.StringType):
            s = strip(c)
            return f"if({s} rlike r'{NUMBER}', try_cast(replace({s}, '_', '') as double), null)"
        return "cast(null as double)"

    def date(self, name: str) -> Sql:
        if self._is(name, *_DAYS):
            return f"cast({self[name]} as date)"
        return f"try_cast({strip(self.text(name))} as date)"

    def bad_date(self, name: str) -> Sql | None:
        """True where text is present but is no date; none when the type rules that out."""
        if name not in self or self._is(name, *_DAYS):
            return None
        return f"({non_blank(self.text(name))} is not null and {self.date(name)} is null)"


def _plain_double(c: Sql) -> Sql:
    s = f"cast({c} as string)"
    exact = f"cast(try_cast({s} as decimal(38, 18)) as string)"
    plain = rf"regexp_replace(regexp_replace({exact}, '0+$', ''), r'\.$', '.0')"
    wide = f"(abs({c}) >= 1e7 and abs({c}) < 1e16) or (abs({c}) >= 1e-4 and abs({c}) < 1e-3)"
    return f"if({wide}, {plain}, {s})"
