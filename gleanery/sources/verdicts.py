"""Rows that passed and rows that did not, told apart in one pass: written once, partitioned by verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ATOM_ENTRY
from .feeds import ATOM_OPTIONS, fields_of

CORRUPT = "_corrupt"
GOOD, BROKEN = "good", "broken"


class Verdicts:
    """``df``, which has a column ``verdict``, written once to ``path``; readers open the parts of the verdicts they ask for."""

    def __init__(self, df: DataFrame, path: str):
        self.spark, self.path, self.schema = df.sparkSession, path, df.schema
        # Without "static" the parts of an earlier run with other verdicts would stay.
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("verdict").parquet(path)

    def rows(self, *verdicts: str) -> DataFrame:
        """Rows with one of the verdicts, or all rows, without the verdict."""
        schema = T.StructType([*[f for f in self.schema if f.name != "verdict"], T.StructField("verdict", T.StringType())])
        # A verdict that no row has leaves no folder; a table without any row has none at all.
        stored = self.spark.read.schema(schema).parquet(self.path)
        return (stored.where(F.col("verdict").isin(*verdicts)) if verdicts else stored).drop("verdict")


def _tagged(read: DataFrame) -> DataFrame:
    return read.withColumn("verdict", F.when(F.col(CORRUPT).isNull(), GOOD).otherwise(BROKEN))


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl).add(CORRUPT, T.StringType())


def split_documents(
    spark: SparkSession, path: str, schema: str, target: str, lineage: str = "s3_key", lines: bool = False, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Documents as ``read_documents`` gives them, and the rejects: ``path, reason, record``.

    A document that is no JSON, or does not fit the schema, is a reject in place of the end of the run; with
    ``strict`` it fails the read. Files are read once and the outcome is written to ``target``, since a reader of some columns only
    would not see what is wrong in the others. A file of white space only is a reject with a NULL record;
    only the files' names are read for that. Spark lists no files of length zero, and a compressed file that cannot be unpacked
    still fails.
    """
    mode = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    read = spark.read.schema(_schema(schema)).option("multiLine", not lines).options(**mode).json(path)
    tagged = _tagged(read.withColumn(lineage, F.col("_metadata.file_path")))
    written = Verdicts(tagged, target)
    reason = F.when(F.try_parse_json(CORRUPT).isNull(), "not JSON").otherwise("not of the schema")
    rejects = written.rows(BROKEN).select(F.col(lineage).alias("path"), reason.alias("reason"), F.col(CORRUPT).alias("record"))
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    files = spark.read.format("binaryFile").load(path).where(~name.rlike("^[_.]"))
    # Two readers spell the scheme of a path in different ways.
    bare = lambda column: F.regexp_replace(column, "^[a-z0-9]+:/+", "/")
    seen = written.rows().select(bare(F.col(lineage)).alias("_bare")).distinct()
    empty = files.select("path").withColumn("_bare", bare(F.col("path"))).join(seen, "_bare", "left_anti")
    if not strict:
        rejects = rejects.unionByName(empty.select("path", F.lit("no document").alias("reason"), F.lit(None).cast("string").alias("record")))
    return written.rows(GOOD).drop(CORRUPT), rejects


def split_atom(spark: SparkSession, path: str, target: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Entries as ``read_atom`` gives them, and the rejects: ``path, entry_no, reason, record``.

    A reader of whole feeds ends at the first tag that does not fit, so the files (UTF-8) are cut at the ends of
    their entries and each entry is parsed by itself. A broken entry keeps its number, so those after it have the numbers
    they would have in a sound feed. An entry that another one or the file's end cuts off is "not closed". With ``strict``
    a broken entry fails the read. Closing tags within CDATA sections count as the entry's end.
    """
    file = {"feed_path": F.col("_metadata.file_path"), "feed_file": F.col("_metadata.file_name"), "_block": F.col("_metadata.file_block_start")}
    cut = spark.read.option("lineSep", "</entry>").text(path).select("value", *[c.alias(n) for n, c in file.items()])
    starts = F.split("value", r"(?=<entry[\s>])")
    pieces = cut.withColumn("_at", F.monotonically_increasing_id()).select("feed_path", "feed_file", "_block", "_at", F.size(starts).alias("_n"), F.posexplode(starts).alias("_piece", "_text"))
    place = Window.partitionBy("feed_path").orderBy("_block", "_at", "_piece")
    # The text after the last entry is the feed's own end.
    closed = (F.col("_piece") == F.col("_n") - 1) & F.lead("_piece").over(place).isNotNull()
    entries = pieces.withColumn("_closed", closed).where(F.col("_text").rlike(r"^<entry[\s>]"))
    record = F.when(F.col("_closed"), F.concat("_text", F.lit("</entry>"))).otherwise(F.col("_text"))
    options = {**ATOM_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = entries.withColumn("entry_no", F.row_number().over(place) - 1).withColumn("record", record)
    parsed = parsed.withColumn("_entry", F.when(F.col("_closed"), F.from_xml("record", _schema(ATOM_ENTRY).simpleString(), options)))
    reason = F.when(~F.col("_closed"), "not closed").when(F.col(f"_entry.{CORRUPT}").isNotNull(), "not XML")
    verdict = F.when(reason.isNull(), GOOD).otherwise(F.raise_error(F.concat(F.lit("malformed entry in "), "feed_path")) if strict else F.lit(BROKEN))
    tagged = parsed.withColumns({"reason": reason, "verdict": verdict}).select("feed_path", "feed_file", "entry_no", "_entry", "reason", "record", "verdict")
    written = Verdicts(tagged, target)
    good = written.rows(GOOD).select("feed_path", "feed_file", *fields_of(F.col("_entry")), "entry_no")
    return good, written.rows(BROKEN).select(F.col("feed_path").alias("path"), "entry_no", "reason", "record")
