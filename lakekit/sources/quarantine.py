"""Raw CSV with malformed rows set aside: every line is kept or quarantined, none is lost.

Lines are read as text and parsed with Spark's CSV expression in PERMISSIVE mode.
A line that doesn't fit the header goes to the quarantine with its file, place
and reason.  One scan writes both parts, so their counts add up.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.session import work_path
from lakekit.sources.files import all_text_schema

#: Why a line is quarantined.
SHORT, LONG, UNBALANCED, MALFORMED = "SHORT", "LONG", "UNBALANCED", "MALFORMED"


@dataclass
class Split:
    """The two parts of a delivery; ``checks`` compares their counts with the lines read."""

    kept: DataFrame
    quarantined: DataFrame
    checks: DataFrame


def _options(quoted: bool) -> dict[str, str]:
    return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"} | ({"quote": '"', "escape": '"'} if quoted else {})


def _separators(line: Column, quoted: bool) -> Column:
    """Separators outside quotes."""
    escapes = '""' if quoted else r'\\.'
    bare = F.regexp_replace(F.regexp_replace(line, escapes, ""), '"[^"]*"', "")
    return F.char_length(bare) - F.char_length(F.replace(bare, F.lit(","), F.lit("")))


def _unbalanced(line: Column, quoted: bool) -> Column:
    """An odd number of quotes that are not escaped."""
    plain = line if quoted else F.regexp_replace(line, r"\\.", "")
    return (F.char_length(plain) - F.char_length(F.replace(plain, F.lit('"'), F.lit("")))) % 2 == 1


def split_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, quoted: bool = True, staging: str | None = None) -> Split:
    """Read headered CSV deliveries below ``path`` into rows that fit and rows that don't.

    ``kept`` has the columns as text, as ``read_raw_csv`` gives them; ``quarantined``
    is ``(file, block, line, reason)``, reason SHORT or LONG (too few or many
    fields), UNBALANCED (a quote without its pair; fields can't span lines here)
    or MALFORMED (Spark's parser rejects it for another reason).  ``columns``
    defaults to the header of the first file.  Lines equal to the header are
    headers, blank lines are no rows; both are counted in neither part.

    Everything is written once to ``staging`` (default: the shared working
    folder), partitioned by the part, and read from there.
    """
    if columns is None:
        columns = spark.read.option("header", True).options(**{k: v for k, v in _options(quoted).items() if k in ("quote", "escape")}).csv(path).columns
    text = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    schema = all_text_schema(columns).add("_corrupt", "string")
    ddl = ", ".join(f"`{f.name}` string" for f in schema)
    rows = text.where(F.trim("line") != "").withColumn("row", F.from_csv("line", ddl, _options(quoted)))
    header = F.lit(True)
    for name in columns:
        header = header & F.col("row").getField(name).eqNullSafe(F.lit(name))
    extra = _separators(F.col("line"), quoted) - (len(columns) - 1)
    reason = (
        F.when(_unbalanced(F.col("line"), quoted), UNBALANCED)
        .when(extra < 0, SHORT)
        .when(extra > 0, LONG)
        .when(F.col("row._corrupt").isNotNull(), MALFORMED)
    )
    judged = rows.where(~header).withColumn("reason", reason)
    stored = judged.select(
        *[F.when(F.col("reason").isNull(), F.col("row").getField(c)).alias(f"c{i}") for i, c in enumerate(columns)],
        *[F.when(F.col("reason").isNotNull(), F.col(c)).alias(c) for c in ("file", "block", "line")],
        "reason",
        F.when(F.col("reason").isNull(), "kept").otherwise("quarantined").alias("part"),
    )
    staging = staging or work_path(spark, "csv-split")
    stored.write.mode("overwrite").partitionBy("part").parquet(staging)
    written = spark.read.schema(stored.schema).option("basePath", staging).parquet(staging)
    kept = written.where("part = 'kept'").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
    quarantined = written.where("part = 'quarantined'").select("file", "block", "line", "reason")
    lines = judged.agg(F.count("*").alias("lines"))
    counts = written.agg(F.count_if(F.col("part") == "kept").alias("kept"), F.count_if(F.col("part") == "quarantined").alias("set_aside"))
    total = counts.select("*", lines.scalar().alias("lines"))
    detail = F.concat(F.lit("lines="), F.col("lines"), F.lit(" kept="), F.col("kept"), F.lit(" quarantined="), F.col("set_aside"))
    whole = total.select(
        F.lit("raw:rows_accounted").alias("check"),
        F.when(F.col("lines") == F.col("kept") + F.col("set_aside"), "OK").otherwise("FAIL").alias("status"),
        detail.alias("detail"),
    )
    clean = total.select(
        F.lit("raw:malformed_rows").alias("check"), F.when(F.col("set_aside") == 0, "OK").otherwise("WARN").alias("status"), F.concat(F.lit("rows="), F.col("set_aside")).alias("detail")
    )
    return Split(kept, quarantined, whole.unionByName(clean))
