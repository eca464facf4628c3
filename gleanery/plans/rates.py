"""Exchange rates: rate sheets to a table of unit prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import naive_timestamp, unit_rate
from ..operators import counted, latest_per_key, normalise_names, surrogate_key
from ..sources import TableStore

TABLE = "hh_currency_exchange_rate"

# Table columns for the lower-cased names of a rate sheet.
RENAMES = {"id": "currency_id", "charcode": "char_code", "name": "title", "numcode": "num_code"}


def transform_rates(sheet: DataFrame, interval_end: str) -> DataFrame:
    """Price of one unit of each currency, dated with the day the interval ends."""
    named = normalise_names(sheet, RENAMES, date=interval_end[:10])
    return named.withColumns(
        {
            "date": F.col("date").cast("date"),
            "value": unit_rate(F.col("value"), F.col("nominal")),
            "nominal": F.lit(1),
            "created_at": naive_timestamp(F.lit(interval_end)),
        }
    )


def load_rates(store: TableStore, rows: DataFrame, now: str) -> int:
    """Append; the table has no key, so a day loaded twice is there twice, told apart by the load's time."""
    at = naive_timestamp(F.lit(now))
    loaded = rows.withColumn("loaded_at", at)
    batch, seen = counted(loaded.withColumn("id", surrogate_key("currency_id", "date", "loaded_at")))
    store.append(TABLE, batch)
    return seen.get["rows"]


def latest_rates(table: DataFrame) -> DataFrame:
    """The newest rate per currency: of the last day, and of its loads the last one.

    A table without load times is ordered by id instead; the value is the last resort, so the result
    never depends on the order of rows.
    """
    loaded = F.col("loaded_at") if "loaded_at" in table.columns else F.lit(None).cast("timestamp_ntz")
    newest = latest_per_key(
        table.select("id", "char_code", "value", "date", loaded.alias("loaded_at")),
        ["char_code"],
        F.col("date").desc_nulls_first(),
        F.col("loaded_at").desc_nulls_last(),
        F.col("id").desc(),
        F.col("value").desc(),
    )
    return newest.select("id", "char_code", "value")
