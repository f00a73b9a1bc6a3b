"""Writers: refined tables, query results, previews and retention.

Full refresh is done as *write a new version, check it, then repoint*:
overwriting the path a plan is reading deletes its input before the job
runs, so a table is never overwritten in place.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekit.commits import CommitLog, file_system
from lakekit.contracts import Contract


class ContractViolation(ValueError):
    pass


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=()) -> str:
    """Snappy Parquet write (the refined zone's format)."""
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def check_contract(df: DataFrame, contract: Contract) -> None:
    """Raise if the DataFrame's columns/types differ from the contract."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in contract.schema.fields]
    if got != want:
        raise ContractViolation(f"{contract.qualified_name}: produced {got}, declared {want}")


def new_version_path(location: str) -> str:
    """Fresh ``version=<UTC stamp to the microsecond>-<random>`` folder; the
    stamps sort chronologically."""
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{location.rstrip('/')}/version={stamp}-{uuid.uuid4().hex[:8]}"


def write_refined(
    df: DataFrame,
    contract: Contract,
    location: str,
    spark: SparkSession | None = None,
    guard=None,
    base: int | None = None,
) -> str:
    """Full refresh of a refined table.

    Writes the contract-shaped data to a fresh version folder under
    ``location``, re-reads it to check the contract, commits it as the next
    version, and, when the table is registered in the catalog, repoints it there
    (readers switch at once).  ``guard(path)`` may veto the write (see
    ``lakekit.policy``).  Returns the version path.

    A version published by another writer since this one started, or since the
    commit number ``base`` if given (see ``published``), raises
    ``ConcurrentPublish``; this writer's folder then stays without a name.
    """
    spark = spark or df.sparkSession
    base = published(spark, location) if base is None else base
    check_contract(df, contract)
    path = new_version_path(location)
    if guard is not None:
        guard(path)
    write_parquet(df, path)
    check_contract(spark.read.parquet(path), contract)
    publish_version(spark, location, path, base)
    if spark.catalog.tableExists(contract.qualified_name):
        # the location's latest, which need not be this one: another writer may have gone on from it
        spark.sql(f"ALTER TABLE {contract.qualified_name} SET LOCATION '{current_version(spark, location)}'")
        spark.catalog.refreshTable(contract.qualified_name)
    return path


def published(spark: SparkSession, location: str) -> int:
    """Number of the location's last commit; 0 before the first."""
    return CommitLog(spark, location).last_number()


def publish_version(spark: SparkSession, location: str, path: str, base: int | None = None) -> int:
    """Commit ``path`` as the version that follows commit ``base`` (default: the last one now); returns its number."""
    log = CommitLog(spark, location)
    return log.commit(log.last_number() if base is None else base, {"version": path.rstrip("/").rsplit("/", 1)[-1]})


def current_version(spark: SparkSession, location: str) -> str | None:
    """Path of the current version of a table location; None where none was published."""
    last = CommitLog(spark, location).latest()
    return f"{location.rstrip('/')}/{last.entry['version']}" if last else None


def expire_versions(spark: SparkSession, location: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` latest published versions and their log entries; returns the deleted paths."""
    log, gone = CommitLog(spark, location), []
    hadoop, fs, _ = file_system(spark, location)
    for number in log.numbers()[: -max(1, keep)]:
        path = f"{location.rstrip('/')}/{log.read(number).entry['version']}"
        fs.delete(hadoop.Path(path), True)
        log.forget(number)
        gone.append(path)
    return gone


def expire_results(spark: SparkSession, root: str, query_id: str, as_of: str | _dt.date, days: int = 30) -> list[str]:
    """Delete result folders of days more than ``days`` before ``as_of``; returns the deleted paths."""
    hadoop, fs, folder = file_system(spark, f"{root.rstrip('/')}/{query_id}")
    first = (_dt.date.fromisoformat(str(as_of)) - _dt.timedelta(days=days)).isoformat()
    gone = []
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        name = status.getPath().getName()
        if name.startswith("run_date=") and name.split("=", 1)[1] < first:
            fs.delete(status.getPath(), True)
            gone.append(f"{root.rstrip('/')}/{query_id}/{name}")
    return gone


def save_result(df: DataFrame, root: str, query_id: str, run_date: str | _dt.date | None = None) -> str:
    """Persist a query result as headered CSV under one results root.

    Each execution gets a folder of its own,
    ``<root>/<query_id>/run_date=<d>/execution=<id>/``, so a later run of a day
    keeps the earlier ones, and retention and reads of one day are
    partition-pruned.
    """
    day = str(run_date or _dt.date.today())
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    path = f"{root.rstrip('/')}/{query_id}/run_date={day}/execution={stamp}-{uuid.uuid4().hex[:8]}"
    df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


def read_results(spark: SparkSession, root: str, query_id: str, schema=None, run_date=None) -> DataFrame:
    """Saved results of ``query_id``, with their ``run_date`` and ``execution``.

    With ``run_date`` only that day's latest execution is read, without these columns.
    """
    if run_date is not None:
        _, fs, folder = file_system(spark, f"{root.rstrip('/')}/{query_id}/run_date={run_date}")
        latest = max(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith("execution="))
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    if run_date is not None:
        return reader.csv(f"{root.rstrip('/')}/{query_id}/run_date={run_date}/{latest}")
    return reader.csv(f"{root.rstrip('/')}/{query_id}")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First n rows; give an ordered DataFrame for a deterministic preview."""
    return df.limit(n)


def retain(df: DataFrame, ts_col: str, as_of, days: int = 30) -> DataFrame:
    """Rows whose ``ts_col`` lies within ``days`` before ``as_of``.

    The bound is built in the column's own type (date, timestamp or
    timestamp_ntz), so no time-zone conversion happens.  On a ``run_date``
    partition column this prunes partitions; on a data column the filter
    is pushed to the Parquet scan.
    """
    dtype = df.schema[ts_col].dataType
    if isinstance(dtype, T.DateType):
        start = F.date_sub(F.lit(str(as_of)).cast("date"), int(days))
    else:
        start = F.lit(str(as_of)).cast(dtype) - F.make_dt_interval(F.lit(int(days)))
    return df.filter(F.col(ts_col) >= start)
