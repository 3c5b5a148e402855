"""Typed access to the columns of one raw sheet.

Raw columns may be padded, blank, mixed-case, or strings where a number is
meant.  ``Raw`` turns a raw column into a clean one; quality flags that ask
"was the cell empty?" look at the raw column (``missing``), so a blank string
is not missing while its cleaned value is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def flag(condition: Column) -> Column:
    """A condition as a boolean that is never NULL."""
    return F.coalesce(condition, F.lit(False))


class Raw:
    """``strict=True`` fails on malformed cells, the default turns them into NULL."""

    def __init__(self, df: DataFrame, strict: bool = False):
        self._types = {f.name: f.dataType for f in df.schema.fields}
        self._strict = strict

    def _cast(self, c: Column, to: str) -> Column:
        return c.cast(to) if self._strict else c.try_cast(to)

    def missing(self, name: str) -> Column:
        return F.col(name).isNull()

    def string(self, name: str) -> Column:
        return F.col(name).cast("string")

    def folded(self, name: str) -> Column:
        """Lower-case, untrimmed: what keyword and status tests compare with."""
        return F.lower(self.string(name))

    def text(self, name: str) -> Column:
        return blank_to_null(self.string(name))

    def lower_text(self, name: str) -> Column:
        return blank_to_null(self.folded(name))

    def upper_text(self, name: str) -> Column:
        return blank_to_null(F.upper(self.string(name)))

    def double(self, name: str) -> Column:
        return self._cast(F.col(name), "double")

    def date(self, name: str) -> Column:
        return self._cast(F.col(name), "date")

    def timestamp(self, name: str) -> Column:
        return self._cast(F.col(name), "timestamp_ntz")

    def integer(self, name: str) -> Column:
        """Round to int: text half away from zero, floating point half to even."""
        kind, c = self._types[name], F.col(name)
        if isinstance(kind, T.StringType):
            c = F.round(self._cast(c, "double"), 0)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            c = F.bround(c, 0)
        elif isinstance(kind, T.DecimalType):
            c = F.round(c, 0)
        return self._cast(c, "int")
