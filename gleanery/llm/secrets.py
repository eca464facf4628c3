"""Secrets in texts, found once per different text and rule version (a ledger of blobs).

Everything here is DataFrame expressions; no Python runs in the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import spread
from ..session import scratch_path
from .common import unused


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters.

    A changed rule needs a new version, which makes every blob unseen for it.
    """

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1


#: In the order in which spans that start together are listed.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # Runs are maximal, so shorter ones need not match in order to be dropped.
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)

SCANS = "blob BINARY, kind STRING, version INT"
FINDINGS = f"{SCANS}, start INT, stop INT"


def blob_id(text: Column) -> Column:
    """Content address of a text; NULL counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class Ledger:
    """Which blob was scanned under which rule version, and what was found: two tables in a folder.

    Scans are only ever added. ``update`` writes findings before scans, so a scan that broke off is
    simply repeated; findings are therefore read as distinct rows.
    """

    def __init__(self, spark, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "ledger")
        for name, schema in (("scans", SCANS), ("findings", FINDINGS)):
            empty = spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in map(str.split, schema.split(", "))])
            empty.write.mode("append").parquet(f"{self.path}/{name}")

    def scans(self) -> DataFrame:
        return self.spark.read.schema(SCANS).parquet(f"{self.path}/scans")

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        rows = self.spark.read.schema(FINDINGS).parquet(f"{self.path}/findings")
        return rows.where(_any(rules, lambda r: (F.col("kind") == r.kind) & (F.col("version") == r.version))).distinct()

    def update(self, texts: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
        """Scan what is new among ``texts``: current ones or any historical versions.

        A blob is scanned once however many rows hold it, and only under the rule versions that the
        ledger lacks for it.
        """
        # Sizes as of now, since the scan's rows are added to the files that the plan reads.
        seen = self.scans().groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))
        blobs = texts.select(blob_id(F.col(text)).alias("blob"), F.coalesce(text, F.lit("")).alias("text")).distinct()
        wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
        todo = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<struct<kind:string,version:int>>")))
        unseen = blobs.join(seen, "blob", "left").select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)
        hits = F.filter(F.array(*[_hits(r) for r in rules]), lambda x: F.size(x["found"]) > 0)
        found = unseen.select("blob", "todo", hits.alias("hits"))
        path = scratch_path(self.spark, "scan")
        found.write.parquet(path)
        found = self.spark.read.schema(found.schema).parquet(path)
        _spans(found).write.mode("append").parquet(f"{self.path}/findings")
        done = found.select("blob", F.explode("todo").alias("rule")).select("blob", "rule.kind", "rule.version")
        done.write.mode("append").parquet(f"{self.path}/scans")


def _any(rules: tuple[Rule, ...], holds) -> Column:
    either = F.lit(False)
    for rule in rules:
        either = either | holds(rule)
    return either


def _hits(rule: Rule) -> Column:
    """What a rule matches in ``text``: kind, lengths of the stretches between, matches, and groups.

    The text splits at every match, so the lengths of the pieces and of the matches give all positions.
    """
    text, pattern = F.col("text"), F.lit(rule.pattern)
    due = F.exists("todo", lambda x: (x["kind"] == rule.kind) & (x["version"] == rule.version)) & text.rlike(rule.pattern)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    part = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    found = F.when(due, F.arrays_zip(between.alias("gap"), whole.alias("whole"), part.alias("part")))
    none = F.array().cast("array<struct<gap:int,whole:int,part:int>>")
    return F.struct(
        F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), F.lit(rule.least).alias("least"),
        F.coalesce(found, none).alias("found"),
    )


def _spans(found: DataFrame) -> DataFrame:
    """Matches of the required length as rows, by running sums over the matches of one text."""
    rows = found.select("blob", F.explode("hits").alias("hit")).select("blob", "hit.*")
    rows = rows.select("blob", "kind", "version", "least", F.posexplode("found").alias("i", "at"))
    before = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("at.gap") + F.coalesce("at.whole", F.lit(0))).over(before).cast("int")
    rows = rows.withColumn("stop", stop).where(F.col("at.part") >= F.col("least"))
    return rows.select("blob", "kind", "version", (F.col("stop") - F.col("at.whole")).alias("start"), "stop")


def listed(rules: tuple[Rule, ...] = RULES) -> Column:
    """Aggregate: all spans of a blob by start, then in the order of the rules."""
    place = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind")).cast("int")
    return F.sort_array(F.collect_list(F.struct("start", place.alias("place"), "stop", "kind"))).alias("spans")


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", ledger: Ledger | None = None) -> DataFrame:
    """Per row of ``docs``: its id and ``spans``, an array of ``start, place, stop, kind``.

    Offsets count code points, ends are exclusive. NULL and empty texts have no spans; repeated rows
    are each returned; other columns are left out. The findings of a blob are joined back to all its rows.
    """
    ledger = ledger or Ledger(docs.sparkSession)
    ledger.update(docs, text)
    spans = ledger.findings().groupBy("blob").agg(listed())
    rows = docs.select(F.col(id).alias(id), blob_id(F.col(text)).alias("blob"))
    return rows.join(spread(spans, "blob"), "blob", "left").select(id, "spans")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _stretches(findings: DataFrame) -> DataFrame:
    """Per blob the stretches that its spans cover; overlapping and adjacent spans are one."""
    order = Window.partitionBy("blob").orderBy("start", "stop")
    earlier = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = findings.withColumn("opens", (F.coalesce(earlier, F.lit(-1)) < F.col("start")).cast("int"))
    numbered = opens.withColumn("n", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    each = numbered.groupBy("blob", "n").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return each.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("covered"))


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", ledger: Ledger | None = None) -> DataFrame:
    """``docs`` with every stretch of a text that spans cover replaced by ``mask``; all rows stay.

    A text without spans is returned as it was.
    """
    ledger = ledger or Ledger(docs.sparkSession)
    ledger.update(docs, text)
    key, spans = unused(docs, "_blob"), unused(docs, "_spans")
    found = _stretches(ledger.findings()).select(F.col("blob").alias(key), F.col("covered").alias(spans))
    covered, from_, to = F.col(spans), F.lit(0), F.length(F.col(text))
    starts = F.concat(F.array(from_), F.transform(covered, lambda s: s["stop"]))
    stops = F.concat(F.transform(covered, lambda s: s["start"]), F.array(to))
    pieces = F.zip_with(starts, stops, lambda a, b: F.substring(F.col(text), a + 1, b - a))
    clean = F.when(F.col(spans).isNull(), F.col(text)).otherwise(F.array_join(pieces, mask))
    rows = docs.withColumn(key, blob_id(F.col(text))).join(spread(found, key), key, "left")
    return rows.withColumn(text, clean).select(*docs.columns)
