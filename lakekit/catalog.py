"""Catalog registration, schema discovery and schema drift.

* ``register_domain`` / ``register_table``: databases with a location and
  external Parquet tables with declared columns.
* ``discover_schema``: the schema of a folder of Parquet files, widened
  across files.  Footers are read by the executors (one task per batch of
  files), so discovery scales with the number of files, not the driver.
* ``schema_drift``: declared vs observed columns -> ADD / LOG / WIDEN /
  SAME / CONFLICT.  Removed columns are only logged, never dropped.
* ``apply_drift``: adds new columns to the registered table; ``evolve_table``
  also widens types and changes nested columns, by a rewritten version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.contracts import Contract, Domain

COLUMN_TYPES = "path string, rows bigint, position int, column string, type string"


# ---------------------------------------------------------------------------
# registration
# ---------------------------------------------------------------------------


def register_domain(spark: SparkSession, domain: Domain, lake_root: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {domain.database} LOCATION '{domain.prefix(lake_root)}'")


def register_table(spark: SparkSession, contract: Contract, location: str, replace: bool = False) -> str:
    """External Parquet table with the contract's columns at ``location``."""
    name = contract.qualified_name
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    parts = f" PARTITIONED BY ({', '.join(contract.partition_by)})" if contract.partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({contract.ddl()}) USING parquet{parts} LOCATION '{location}'")
    return name


def check_partitions(spark: SparkSession, contract: Contract) -> list[str]:
    """Differences between catalog partition keys and the contract's."""
    cols = spark.catalog.listColumns(contract.qualified_name)
    actual = [c.name for c in cols if c.isPartition]
    expected = list(contract.partition_by)
    return [] if actual == expected else [f"{contract.qualified_name}: partitions {actual}, declared {expected}"]


# ---------------------------------------------------------------------------
# type lattice (Spark SQL type names)
# ---------------------------------------------------------------------------

# Digits that a whole-number type needs.
_WHOLE_DIGITS = (("tinyint", 3), ("smallint", 5), ("int", 10), ("bigint", 19))


def type_family(t: Column) -> Column:
    numeric = t.isin(*[n for n, _ in _WHOLE_DIGITS], "float", "double") | t.startswith("decimal")
    return F.when(numeric, F.lit("numeric")).when(t.isin("timestamp", "timestamp_ntz"), F.lit("timestamp")).otherwise(t)


def _digits(t: Column) -> Column:
    """Digits before the point that a numeric type holds; 0 for others."""
    decimal = F.regexp_extract(t, r"decimal\((\d+),", 1).try_cast("int") - F.regexp_extract(t, r",\s*(\d+)\)", 1).try_cast("int")
    expr = F.when(t.startswith("decimal"), decimal)
    for name, n in _WHOLE_DIGITS:
        expr = expr.when(t == name, F.lit(n))
    return expr.otherwise(F.lit(0))


def _scale(t: Column) -> Column:
    return F.when(t.startswith("decimal"), F.regexp_extract(t, r",\s*(\d+)\)", 1).try_cast("int")).otherwise(F.lit(0))


def _bound(digits: Column, scale: Column, decimals: Column, floats: Column, doubles: Column) -> Column:
    """The least numeric type that holds them all; NULL where no decimal has the digits.

    A float holds whole numbers of up to five digits; with more, or with decimals, it widens to double.
    """
    whole = F.lit("bigint")
    for name, n in reversed(_WHOLE_DIGITS[:-1]):
        whole = F.when(digits <= n, F.lit(name)).otherwise(whole)
    wide = F.when(digits + scale <= 38, F.concat(F.lit("decimal("), digits + scale, F.lit(","), scale, F.lit(")")))
    approximate = F.when(doubles | decimals | (digits > 5), F.lit("double")).otherwise(F.lit("float"))
    return F.when(floats | doubles, approximate).when(decimals, wide).otherwise(whole)


def bound_of(a: Column, b: Column) -> Column:
    """The least type that holds both numeric types."""

    def either(test):
        return test(a) | test(b)

    return _bound(
        F.greatest(_digits(a), _digits(b)),
        F.greatest(_scale(a), _scale(b)),
        either(lambda t: t.startswith("decimal")),
        either(lambda t: t == "float"),
        either(lambda t: t == "double"),
    )


def _footer_reader(nested: bool = False):
    """Executor-side footer reader.

    Built as a closure so Spark ships its code with the task: executors only
    need pyarrow and pandas, not an installed copy of this package.
    """

    def arrow_to_spark(t) -> str:
        import pyarrow as pa

        if pa.types.is_int8(t):
            return "tinyint"
        if pa.types.is_int16(t):
            return "smallint"
        if pa.types.is_int32(t) or pa.types.is_uint16(t) or pa.types.is_uint8(t):
            return "int"
        if pa.types.is_int64(t) or pa.types.is_uint32(t):
            return "bigint"
        if pa.types.is_uint64(t):
            return "decimal(20,0)"
        if pa.types.is_float32(t):
            return "float"
        if pa.types.is_float64(t):
            return "double"
        if pa.types.is_decimal(t):
            return f"decimal({t.precision},{t.scale})"
        if pa.types.is_string(t) or pa.types.is_large_string(t):
            return "string"
        if pa.types.is_binary(t) or pa.types.is_large_binary(t):
            return "binary"
        if pa.types.is_boolean(t):
            return "boolean"
        if pa.types.is_date(t):
            return "date"
        if pa.types.is_timestamp(t):
            return "timestamp" if t.tz is not None else "timestamp_ntz"
        if pa.types.is_list(t) or pa.types.is_large_list(t):
            return f"array<{arrow_to_spark(t.value_type)}>"
        if pa.types.is_map(t):
            return f"map<{arrow_to_spark(t.key_type)},{arrow_to_spark(t.item_type)}>"
        if pa.types.is_struct(t):
            return "struct<" + ",".join(f"{f.name}:{arrow_to_spark(f.type)}" for f in t) + ">"
        return str(t)

    def paths_of(name: str, t):
        """The column and all that is nested in it, as (path, type): a.b for fields, a[] for elements, a{key} and a{value}."""
        import pyarrow as pa

        if pa.types.is_struct(t):
            yield name, "struct"
            for f in t:
                field = f.name if f.name.replace("_", "a").isalnum() else "`" + f.name.replace("`", "``") + "`"
                yield from paths_of(f"{name}.{field}", f.type)
        elif pa.types.is_list(t) or pa.types.is_large_list(t):
            yield name, "array"
            yield from paths_of(f"{name}[]", t.value_type)
        elif pa.types.is_map(t):
            yield name, "map"
            yield from paths_of(name + "{key}", t.key_type)
            yield from paths_of(name + "{value}", t.item_type)
        else:
            yield name, arrow_to_spark(t)

    def read_footers(batches):
        import pandas
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            out = []
            for path in batch["path"]:
                if path.startswith("file:"):
                    filesystem, local = fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
                else:
                    filesystem, local = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
                with pq.ParquetFile(local, filesystem=filesystem) as file:
                    schema, rows = file.schema.to_arrow_schema(), file.metadata.num_rows
                for i, field in enumerate(schema):
                    if nested:
                        quoted = field.name if field.name.replace("_", "a").isalnum() else "`" + field.name.replace("`", "``") + "`"
                        out += [(path, rows, i, name, kind) for name, kind in paths_of(quoted, field.type)]
                    else:
                        out.append((path, rows, i, field.name, arrow_to_spark(field.type)))
            yield pandas.DataFrame(out, columns=["path", "rows", "position", "column", "type"])

    return read_footers


def file_columns(spark: SparkSession, path: str, glob: str = "*.parquet", nested: bool = False) -> DataFrame:
    """(path, rows, position, column, type) for every column of every file.

    ``nested`` gives the paths inside nested columns rows of their own:
    ``a.b`` for a field, ``a[]`` for an array's elements, ``a{key}`` and
    ``a{value}`` for a map's; a name with other characters stands in backticks.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path")
    )
    return listing.mapInPandas(_footer_reader(nested), COLUMN_TYPES)


def widened(cols: DataFrame, *keys: str, allow_string: bool = False) -> DataFrame:
    """One row per (``keys``, column) of ``(keys, path, position, column, type)``: the least type that holds all of a column's.

    Adds files, types, status and position, as ``discover_schema`` returns them.
    """
    t = F.col("type")
    agg = cols.withColumn("_family", type_family(t)).groupBy(*keys, "column").agg(
        F.min("position").alias("position"),
        F.countDistinct("path").alias("files"),
        F.array_sort(F.collect_set("type")).alias("types"),
        F.max("type").alias("_any"),
        F.max("_family").alias("_family"),
        F.countDistinct("_family").alias("_families"),
        _bound(F.max(_digits(t)), F.max(_scale(t)), F.max(t.startswith("decimal")), F.max(t == "float"), F.max(t == "double")).alias("_bound"),
    )
    one = F.size("types") == 1
    widest = F.when(one, F.col("_any")).when(F.col("_family") == "numeric", F.col("_bound")).otherwise(F.col("_any"))
    conflict = (F.col("_families") > 1) | widest.isNull()
    resolved = F.when(conflict, F.lit("string") if allow_string else F.lit(None).cast("string")).otherwise(widest)
    status = F.when(conflict, F.lit("CONFLICT")).when(F.size("types") > 1, F.lit("WIDEN")).otherwise(F.lit("SAME"))
    return agg.select(*keys, "column", resolved.alias("type"), "files", "types", status.alias("status"), "position")


def discover_schema(spark: SparkSession, path: str, glob: str = "*.parquet", allow_string: bool = False, nested: bool = False) -> DataFrame:
    """Widened schema over all files: (column, type, files, types, status).

    status: SAME (one type), WIDEN (numeric types widened to the least that holds them all),
    CONFLICT (incompatible families, or more digits than a decimal has; ``allow_string`` resolves to string).
    ``nested`` compares nested columns path by path (see ``file_columns``), so that a struct may gain fields
    and an array's elements may widen.
    """
    return widened(file_columns(spark, path, glob, nested), allow_string=allow_string)


def to_struct(discovered: DataFrame) -> T.StructType:
    """StructType of a discovered schema (one small row per column)."""
    rows = discovered.filter(F.col("type").isNotNull()).orderBy("position", "column").select("column", "type").collect()
    return T.StructType.fromJson(
        {
            "type": "struct",
            "fields": [
                {"name": r["column"], "type": T._parse_datatype_string(r["type"]).jsonValue(), "nullable": True, "metadata": {}}
                for r in rows
            ],
        }
    )


# ---------------------------------------------------------------------------
# drift
# ---------------------------------------------------------------------------


def schema_frame(spark: SparkSession, schema: T.StructType | Sequence[tuple[str, str]], nested: bool = False) -> DataFrame:
    """``(column, type)`` rows of a schema; ``nested``: a row per path, as ``file_columns`` names them."""
    if isinstance(schema, T.StructType):
        pairs = type_paths(schema) if nested else [(f.name, f.dataType.simpleString()) for f in schema.fields]
    else:
        pairs = list(schema)
    return spark.createDataFrame(pairs, "column string, type string")


def _quoted(name: str) -> str:
    return name if name.replace("_", "a").isalnum() else "`" + name.replace("`", "``") + "`"


def type_paths(kind: T.DataType, path: str = "") -> list[tuple[str, str]]:
    """``(path, type)`` of a type and all that is nested in it; a schema's own path is empty and left out."""
    if isinstance(kind, T.StructType):
        below = [p for f in kind.fields for p in type_paths(f.dataType, f"{path}.{_quoted(f.name)}" if path else _quoted(f.name))]
        return ([(path, "struct")] if path else []) + below
    if isinstance(kind, T.ArrayType):
        return [(path, "array"), *type_paths(kind.elementType, f"{path}[]")]
    if isinstance(kind, T.MapType):
        return [(path, "map"), *type_paths(kind.keyType, path + "{key}"), *type_paths(kind.valueType, path + "{value}")]
    return [(path, kind.simpleString())]


def evolved(kind: T.DataType, changes: dict[str, str], path: str = "") -> T.DataType:
    """The type with leaf types replaced and fields added, by path (``changes``: path -> new type)."""
    if isinstance(kind, T.StructType):
        fields = []
        for f in kind.fields:
            at = f"{path}.{_quoted(f.name)}" if path else _quoted(f.name)
            fields.append(T.StructField(f.name, evolved(f.dataType, changes, at), True))
        have = {_quoted(f.name) for f in kind.fields}
        for at in changes:
            head = at[len(path) + 1 :] if path and at.startswith(path + ".") else "" if path else at
            if head and head not in have and _is_name(head):
                fields.append(T.StructField(_unquoted(head), _built(at, changes), True))
        return T.StructType(fields)
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(evolved(kind.elementType, changes, f"{path}[]"), True)
    if isinstance(kind, T.MapType):
        return T.MapType(evolved(kind.keyType, changes, path + "{key}"), evolved(kind.valueType, changes, path + "{value}"), True)
    return T._parse_datatype_string(changes[path]) if path in changes else kind


def _is_name(head: str) -> bool:
    return head.replace("_", "a").isalnum() or head[0] == "`" and head[-1] == "`" and "`" not in head[1:-1].replace("``", "")


def _unquoted(head: str) -> str:
    return head[1:-1].replace("``", "`") if head.startswith("`") else head


def _built(path: str, rows: dict[str, str]) -> T.DataType:
    """The type at ``path`` made from its path rows."""
    kind = rows[path]
    if kind == "struct":
        heads = [at[len(path) + 1 :] for at in rows if at.startswith(path + ".")]
        return T.StructType([T.StructField(_unquoted(h), _built(f"{path}.{h}", rows), True) for h in heads if _is_name(h)])
    if kind == "array":
        return T.ArrayType(_built(f"{path}[]", rows), True)
    if kind == "map":
        return T.MapType(_built(path + "{key}", rows), _built(path + "{value}", rows), True)
    return T._parse_datatype_string(kind)


def conformed_to(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` in the wanted type: fields by name (missing ones null), elements one by one, leaves cast."""
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        mine = {f.name: f.dataType for f in have.fields}
        fields = [(conformed_to(value[f.name], mine[f.name], f.dataType) if f.name in mine else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: conformed_to(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(conformed_to(e["key"], have.keyType, want.keyType).alias("key"), conformed_to(e["value"], have.valueType, want.valueType).alias("value")),
        )
        return F.map_from_entries(entries)
    return value if have == want else value.cast(want)


def schema_drift(declared: DataFrame, observed: DataFrame, table: str | None = None) -> DataFrame:
    """Declared vs observed ``(column, type)`` -> one row per column.

    ADD: new observed column; LOG: declared column no longer observed
    (kept, only logged); WIDEN: numeric type grew; SAME: equal or the
    observed type fits the declared one; CONFLICT: incompatible change.
    """
    d = declared.select(F.col("column"), F.col("type").alias("declared"))
    o = observed.select(F.col("column"), F.col("type").alias("observed"))
    j = d.join(o, on="column", how="full_outer")
    numeric = (type_family(F.col("declared")) == "numeric") & (type_family(F.col("observed")) == "numeric")
    bound = bound_of(F.col("declared"), F.col("observed"))
    action = (
        F.when(F.col("declared").isNull(), "ADD")
        .when(F.col("observed").isNull(), "LOG")
        .when(F.col("declared") == F.col("observed"), "SAME")
        .when(numeric & (bound == F.col("declared")), "SAME")
        .when(numeric & bound.isNotNull(), "WIDEN")
        .otherwise("CONFLICT")
    )
    out = j.select("column", "declared", "observed", action.alias("action"))
    if table is not None:
        out = out.select(F.lit(table).alias("table"), "*")
    return out


def apply_drift(spark: SparkSession, qualified_name: str, drift: DataFrame, allowed=None) -> list[str]:
    """Add ADD columns to the registered table; returns the statements run.

    ``allowed(permission, database)`` may veto (DDL grants).  WIDEN rows and
    rows of nested paths need a rewritten version (``evolve_table``); CONFLICT
    rows are left to the owner.
    """
    database = qualified_name.split(".")[0]
    if allowed is not None and not allowed("ALTER", database):
        raise PermissionError(f"ALTER on {database} not granted")
    adds = drift.filter((F.col("action") == "ADD") & ~F.col("column").rlike(r"[.\[{]")).select("column", "observed").collect()
    stmts = []
    for r in adds:
        if r["observed"] in ("struct", "array", "map"):
            continue  # its paths tell the type
        stmt = f"ALTER TABLE {qualified_name} ADD COLUMNS (`{_unquoted(r['column'])}` {r['observed']})"
        spark.sql(stmt)
        stmts.append(stmt)
    return stmts


def evolve_table(spark: SparkSession, qualified_name: str, location: str, drift: DataFrame, allowed=None) -> T.StructType:
    """Carry ADD and WIDEN rows, nested ones too, into a registered table; returns its new schema.

    The current version below ``location`` is rewritten in the new schema (new
    columns and fields null, leaves cast to the type that holds both), committed
    as the next version and the table declared anew over it, so that readers
    see the old table or the new one.  ``drift`` compares path rows
    (``schema_frame(..., nested=True)`` and ``discover_schema(..., nested=True)``).
    CONFLICT rows raise ``ValueError``: nothing is changed then.
    """
    from lakekit import sinks as K

    database = qualified_name.split(".")[0]
    if allowed is not None and not allowed("ALTER", database):
        raise PermissionError(f"ALTER on {database} not granted")
    rows = drift.filter(F.col("action").isin("ADD", "WIDEN", "CONFLICT")).select("column", "action", "declared", "observed").collect()
    conflicts = sorted(r["column"] for r in rows if r["action"] == "CONFLICT")
    if conflicts:
        raise ValueError(f"{qualified_name}: incompatible types of {conflicts}")
    declared = spark.table(qualified_name).schema
    changes = {r["column"]: r["observed"] for r in rows if r["action"] == "ADD"}
    wider = spark.createDataFrame([r for r in rows if r["action"] == "WIDEN"], "column string, action string, declared string, observed string")
    changes |= {r["column"]: r["bound"] for r in wider.select("column", bound_of(F.col("declared"), F.col("observed")).alias("bound")).collect()}
    changes = dict(sorted(changes.items()))
    target = evolved(declared, changes)
    if not changes:
        return declared
    base = K.published(spark, location)
    now = spark.read.schema(declared).parquet(K.current_version(spark, location))
    path = K.new_version_path(location)
    columns = [
        (conformed_to(F.col(_quoted(f.name)), declared[f.name].dataType, f.dataType) if f.name in declared.names else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in target
    ]
    K.write_parquet(now.select(*columns), path)
    K.publish_version(spark, location, path, base)
    keys = [c.name for c in spark.catalog.listColumns(qualified_name) if c.isPartition]
    parts = f" PARTITIONED BY ({', '.join(keys)})" if keys else ""
    spark.sql(f"DROP TABLE {qualified_name}")
    spark.sql(f"CREATE TABLE {qualified_name} ({target.toDDL()}) USING parquet{parts} LOCATION '{path}'")
    return target
