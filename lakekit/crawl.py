"""Crawling a lake root: which tables lie below it, and which partitions a table has.

``crawl`` groups files into tables as a crawler with a combining policy does:
files of one folder, or of sibling folders, whose schemas are compatible are one
table.  ``partition_report`` compares the ``key=value`` folders of a location
with the catalog's partitions; ``repair_partitions`` makes the catalog follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.catalog import bound_of, file_columns, type_family, widened
from lakekit.session import work_path


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = work_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _segments(path: Column) -> Column:
    return F.split(path, "/")


def compatible_shapes(columns: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``(a, b)`` of shapes of one parent with compatible schemas, from ``(parent, shape, column, type, width)``.

    Compatible: no common column with types that nothing holds, and at least
    ``similarity`` of the wider one's columns in common.  Shapes are distinct
    schemas, so this grows with the schemas below a parent, not with its files.
    """
    one = columns.select("parent", "column", F.col("shape").alias("a"), F.col("type").alias("ta"), F.col("width").alias("wa"))
    two = columns.select("parent", "column", F.col("shape").alias("b"), F.col("type").alias("tb"), F.col("width").alias("wb"))
    numeric = (type_family(F.col("ta")) == "numeric") & (type_family(F.col("tb")) == "numeric")
    fits = (F.col("ta") == F.col("tb")) | numeric & bound_of(F.col("ta"), F.col("tb")).isNotNull() | (type_family(F.col("ta")) == type_family(F.col("tb"))) & ~numeric
    both = one.join(two, ["parent", "column"]).where("a < b").withColumn("fits", fits)
    pairs = both.groupBy("parent", "a", "b").agg(F.count("*").alias("common"), F.count_if(~F.col("fits")).alias("clashes"), F.max(F.greatest("wa", "wb")).alias("width"))
    return pairs.where((F.col("clashes") == 0) & (F.col("common") >= similarity * F.col("width"))).select("parent", "a", "b")


def grouped_shapes(shapes: DataFrame, links: DataFrame) -> DataFrame:
    """``(parent, shape, group)``: the smallest shape that links reach, by rounds of taking the neighbours' least."""
    both = links.unionByName(links.select("parent", F.col("b").alias("a"), F.col("a").alias("b")))
    both = _stored(both, "crawl-links")
    now = _stored(shapes.select("parent", "shape", F.col("shape").alias("group")), "crawl-groups")
    while True:
        near = both.join(now.select("parent", F.col("shape").alias("b"), F.col("group").alias("least")), ["parent", "b"])
        near = near.groupBy("parent", F.col("a").alias("shape")).agg(F.min("least").alias("least"))
        new = now.join(near, ["parent", "shape"], "left").withColumn("new", F.least("group", "least"))
        new = _stored(new, "crawl-groups")
        changed = new.where("`new` <> `group`").limit(1).count()
        now = new.select("parent", "shape", F.col("new").alias("group"))
        if not changed:
            return now


def crawl(spark: SparkSession, root: str, glob: str = "*.parquet", similarity: float = 0.7) -> DataFrame:
    """One row per table below ``root``.

    Returns ``table``, ``location``, ``partition_keys``, ``folders``, ``files``,
    ``rows`` and ``columns`` (numbers), ``schema`` (``column type`` in file order,
    types widened over all files) and ``status`` (SAME, WIDEN or CONFLICT).

    ``key=value`` folders at the end of a path are partitions of the folder
    above.  Files of a folder, and of sibling folders, are one table if their
    schemas are compatible (``compatible_shapes``), directly or by way of others.
    A table takes its name from its folder, from the common folder of several,
    or from its first file where a folder holds several tables.  Footers are read
    by the executors; only schemas, never files, are compared with each other.
    """
    columns = _stored(file_columns(spark, root, glob), "crawl-columns")
    parts = _segments(F.col("path"))
    folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
    plain = F.filter(folders, lambda s: ~s.contains("="))
    files = columns.groupBy("path").agg(
        F.first("rows").alias("rows"),
        F.count("*").alias("width"),
        F.md5(F.to_json(F.array_sort(F.collect_list(F.struct("column", "type")))).cast("binary")).alias("shape"),
    )
    files = files.select(
        *("path", "rows", "width", "shape"),
        F.array_join(plain, "/").alias("folder"),
        F.array_join(F.slice(plain, F.lit(1), F.size(plain) - 1), "/").alias("parent"),
        F.transform(F.filter(folders, lambda s: s.contains("=")), lambda s: F.substring_index(s, "=", 1)).alias("keys"),
        F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "").alias("stem"),
    )
    files = _stored(files, "crawl-files")
    shapes = files.groupBy("parent", "shape").agg(F.min("path").alias("path"), F.first("width").alias("width"))
    of_shape = shapes.join(columns.select("path", "column", "type"), "path").select("parent", "shape", "column", "type", "width")
    groups = grouped_shapes(shapes, compatible_shapes(_stored(of_shape, "crawl-shapes"), similarity))
    grouped = _stored(files.join(groups, ["parent", "shape"]), "crawl-grouped")

    schema = widened(columns.join(grouped.select("path", "parent", "group"), "path"), "parent", "group")
    schema = schema.groupBy("parent", "group").agg(
        F.count("*").alias("columns"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "column", "type"))), lambda c: F.concat_ws(" ", c["column"], F.coalesce(c["type"], F.lit("?")))), ", ").alias("schema"),
        F.when(F.max(F.col("status") == "CONFLICT"), "CONFLICT").when(F.max(F.col("status") == "WIDEN"), "WIDEN").otherwise("SAME").alias("status"),
    )
    tables = grouped.groupBy("parent", "group").agg(
        F.countDistinct("folder").alias("folders"),
        F.min("folder").alias("folder"),
        F.min("stem").alias("stem"),
        F.count("*").alias("files"),
        F.sum("rows").alias("rows"),
        F.max("keys").alias("partition_keys"),
    )
    shared = grouped.groupBy("folder").agg(F.countDistinct("group").alias("tables_here"))
    location = F.when(F.col("folders") > 1, F.col("parent")).otherwise(F.col("folder"))
    name = F.when((F.col("folders") == 1) & (F.col("tables_here") > 1), F.col("stem")).otherwise(F.regexp_replace(F.substring_index(location, "/", -1), r"\.[^.]*$", ""))
    out = tables.join(schema, ["parent", "group"]).join(shared, "folder")
    return out.select(name.alias("table"), location.alias("location"), "partition_keys", "folders", "files", "rows", "columns", "schema", "status")


# ---------------------------------------------------------------------------
# partitions
# ---------------------------------------------------------------------------

_NULL = "__HIVE_DEFAULT_PARTITION__"


def _decoded(value: Column) -> Column:
    return F.try_url_decode(F.regexp_replace(value, r"\+", "%2B"))


def found_partitions(spark: SparkSession, location: str, glob: str = "*.parquet") -> DataFrame:
    """``(spec, keys, files, bytes)`` of the ``key=value`` folders below a location that hold files.

    ``spec`` is the path below the location, ``""`` for files directly in it.  Only the listing is read.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(location)
    parts = _segments(F.col("path"))
    folders = F.filter(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda s: s.contains("="))
    below = listing.select(F.array_join(folders, "/").alias("spec"), F.transform(folders, lambda s: F.substring_index(s, "=", 1)).alias("keys"), "length")
    return below.groupBy("spec", "keys").agg(F.count("*").alias("files"), F.sum("length").cast("bigint").alias("bytes"))


def partition_report(spark: SparkSession, qualified_name: str, location: str, glob: str = "*.parquet") -> DataFrame:
    """``(spec, status, files, bytes)``: the folders of a location against the catalog's partitions.

    status: OK; MISSING (files, but no partition in the catalog); STALE (a
    partition without files); WRONG_KEY (other keys than the table declares, or in
    another order); FLAT (files outside any partition, though keys are declared).
    """
    declared = [c.name for c in spark.catalog.listColumns(qualified_name) if c.isPartition]
    found = found_partitions(spark, location, glob)
    if declared:
        known = spark.sql(f"SHOW PARTITIONS {qualified_name}").select(F.col("partition").alias("spec"))
    else:
        known = spark.createDataFrame([], "spec string")
    # the catalog and the folders may escape values differently: compare them decoded
    known = known.select(_decoded(F.col("spec")).alias("at"), F.col("spec").alias("known"))
    both = found.withColumn("at", _decoded(F.col("spec"))).join(known, "at", "full_outer")
    status = (
        F.when(F.col("files").isNull(), "STALE")
        .when((F.size("keys") == 0) & F.lit(bool(declared)), "FLAT")
        .when(F.col("keys") != F.array(*[F.lit(k) for k in declared]).cast("array<string>"), "WRONG_KEY")
        .when(F.col("known").isNull() & F.lit(bool(declared)), "MISSING")
        .otherwise("OK")
    )
    return both.select(F.coalesce("spec", "known").alias("spec"), status.alias("status"), F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("bytes", F.lit(0)).alias("bytes"))


def repair_partitions(spark: SparkSession, qualified_name: str, location: str, glob: str = "*.parquet", batch: int = 100, allowed=None) -> dict[str, int]:
    """Add MISSING and drop STALE partitions in batches; returns how many of each.

    WRONG_KEY and FLAT folders are left to the owner.  One row per partition to
    change goes through the driver, ``batch`` of them to a statement.
    """
    if allowed is not None and not allowed("ALTER", qualified_name.split(".")[0]):
        raise PermissionError(f"ALTER on {qualified_name} not granted")
    report = partition_report(spark, qualified_name, location, glob).where("status IN ('MISSING', 'STALE')")
    pairs = F.transform(F.split("spec", "/"), lambda s: F.struct(F.substring_index(s, "=", 1).alias("key"), _decoded(F.regexp_replace(s, "^[^=]*=", "")).alias("value")))
    done = {"MISSING": 0, "STALE": 0}
    pending: dict[str, list[str]] = {"MISSING": [], "STALE": []}

    def run(status: str) -> None:
        if pending[status]:
            verb = f"ADD IF NOT EXISTS {' '.join(pending[status])}" if status == "MISSING" else f"DROP IF EXISTS {', '.join(pending[status])}"
            spark.sql(f"ALTER TABLE {qualified_name} {verb}")
            done[status] += len(pending[status])
            pending[status].clear()

    def quoted(value: str) -> str:
        return "null" if value == _NULL else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    for r in report.select("spec", "status", pairs.alias("pairs")).toLocalIterator():
        spec = "PARTITION (" + ", ".join(f"`{p['key']}` = {quoted(p['value'])}" for p in r["pairs"]) + ")"
        if r["status"] == "MISSING":
            spec += " LOCATION " + quoted(f"{location.rstrip('/')}/{r['spec']}")
        pending[r["status"]].append(spec)
        if len(pending[r["status"]]) >= batch:
            run(r["status"])
    run("MISSING")
    run("STALE")
    spark.catalog.refreshTable(qualified_name)
    return done
