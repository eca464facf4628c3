"""Numbers, dates and the empty-means-NULL rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: code of the currency all salaries are stored in.
BASE_CURRENCY = "RUR"


def falsy_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Turn empty text, zero and false into NULL in the named columns."""

    def rule(field: T.StructField) -> Column:
        col = F.col(field.name)
        if isinstance(field.dataType, T.BooleanType):
            return F.when(col, col)
        if isinstance(field.dataType, T.NumericType):
            return F.when(col != 0, col)
        if isinstance(field.dataType, T.StringType):
            return F.when(col != "", col)
        return col

    return df.withColumns({name: rule(df.schema[name]) for name in cols})


def parse_number(text: Column, to: str = "double") -> Column:
    """Number in a text with a decimal comma or point; NULL if it is none."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast(to)


def unit_rate(value: Column, nominal: Column) -> Column:
    """Price of one unit from a price text for ``nominal`` units."""
    return F.try_divide(parse_number(value), nominal.cast("double"))


def to_rubles(value: Column, currency: Column, rate: Column, base: str = BASE_CURRENCY) -> Column:
    """Amount in the base currency; an unknown rate gives NULL."""
    return F.when(value.isNull() | (currency == base), value).otherwise(value * rate)


def local_date(text: Column) -> Column:
    """Date of an ISO timestamp in the offset it is written in, whatever the session zone."""
    return F.substring(text, 1, 10).try_cast("date")


def naive_timestamp(text: Column) -> Column:
    """Wall-clock time of a timestamp text, its offset dropped."""
    return text.try_cast("timestamp_ntz")
