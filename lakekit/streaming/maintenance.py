"""Incremental maintenance of the sales table while products change.

Items and product changes stream in together.  What is known of a product lies
with the checkpoint as one row per product and micro-batch that touched it: the
batch's sums of its items and the change it took.  A micro-batch adds up its
items and changes by product and joins them to what earlier ones stored.  An
item adds to its product's category; a product that moves to another category,
appears or is deleted takes its sums out of the old category and adds them to
the new one.  What goes out per micro-batch is therefore a handful of signed
differences per category, which are stored by epoch, added up, and published as
a new version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakekit.commits import file_system
from lakekit.contracts import SALES_CONTRACT, Contract
from lakekit.functions.columns import amount_units, merged_sql
from lakekit.sinks import write_refined
from lakekit.sources.files import all_text_schema

#: Signed sums that go out per category and are held per product.
SUMS = {"high": "bigint", "low": "bigint", "micro": "bigint", "rough": "double", "odd": "bigint", "priced": "bigint", "items": "bigint", "n": "bigint"}
_SUMS = ", ".join(f"{n} {t}" for n, t in SUMS.items())
_CHANGE = "struct<seq: bigint, deleted: boolean, category: string>"
#: A product's sums and last change; of one epoch, with what was known before, or of all epochs before one.
_STATE = f"product string, change {_CHANGE}, {_SUMS}"
_TOUCHED = f"{_STATE}, was struct<change: {_CHANGE}, {', '.join(f'{n}: {t}' for n, t in SUMS.items())}>"
_DELTA = f"category string, {_SUMS}"
#: Epochs after which the differences, and the products' rows, so far are added up to one set of totals.
COMPACT_EVERY = 16


def _raw_stream(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    reader = spark.readStream.schema(all_text_schema(columns)).option("header", True).option("quote", '"').option("escape", '"')
    return reader.csv(path)


def _zero(name: str):
    return F.lit(0).cast(SUMS[name])


def _by_product(batch: DataFrame) -> DataFrame:
    """A micro-batch's products: the sums of their items and their last change."""
    units = {n: F.expr(e) for n, e in amount_units("price").items()}
    units |= {"priced": F.col("price").isNotNull().cast("bigint"), "items": F.col("item").cast("bigint"), "n": F.lit(1).cast("bigint")}
    sums = [F.sum(F.coalesce(units[n], _zero(n))).alias(n) for n in SUMS]
    items = batch.where("seq is null").groupBy("product").agg(*sums)
    changes = batch.where("seq is not null").groupBy("product").agg(F.max(F.struct("seq", "deleted", "category")).alias("change"))
    both = items.join(changes, "product", "full_outer")
    return both.select("product", "change", *[F.coalesce(n, _zero(n)).alias(n) for n in SUMS])


def _known(state: DataFrame) -> DataFrame:
    """Products' sums and last changes over all epochs read."""
    return state.groupBy("product").agg(F.max("change").alias("change"), *[F.sum(n).alias(n) for n in SUMS])


def _joined(touched: DataFrame, known: DataFrame) -> DataFrame:
    """A micro-batch's products with what was known before; changes that come late are left out."""
    was = known.select(F.col("product"), F.struct("change", *SUMS).alias("was"))
    newer = F.col("change.seq") > F.coalesce("was.change.seq", F.lit(-1))
    rows = touched.join(was, "product", "left")
    return rows.withColumn("change", F.when(newer, F.col("change"))).select("product", "change", *SUMS, "was")


def _differences(touched: DataFrame) -> DataFrame:
    """What the products of a micro-batch take from and give to categories."""
    listed = lambda change: F.coalesce(change["seq"].isNotNull() & ~change["deleted"], F.lit(False))
    before, now = F.col("was.change"), F.coalesce("change", "was.change")
    stays = listed(before) & listed(now) & before["category"].eqNullSafe(now["category"])
    added = {n: F.col(n) for n in SUMS}
    old = {n: F.coalesce(F.col(f"was.{n}"), _zero(n)) for n in SUMS}
    row = lambda change, sums: F.struct(change["category"].alias("category"), *[sums[n].alias(n) for n in SUMS])
    taken = F.when(listed(before) & ~stays, row(before, {n: -old[n] for n in SUMS}))
    given = F.when(stays, row(now, added)).when(listed(now), row(now, {n: old[n] + added[n] for n in SUMS}))
    return touched.select(F.explode(F.array(taken, given)).alias("d")).where("d is not null and d.n <> 0").select("d.*")


def maintain_sales(
    spark: SparkSession,
    items_dir: str,
    items_columns: Sequence[str],
    changes_dir: str,
    changes_columns: Sequence[str],
    location: str,
    checkpoint: str,
    contract: Contract = SALES_CONTRACT,
    key: str = "product_id",
    category: str = "product_category_name",
    price: str = "price",
    item: str = "order_item_id",
    seq: str = "seq",
    deleted: str = "deleted",
    wait: bool = True,
) -> StreamingQuery:
    """Process every not-yet-seen item and product-change file and publish the updated sales table.

    A product change is a row with the product's ``key``, ``category``, a
    number ``seq`` that grows with each change of a product, and ``deleted``
    ('true' removes the product: its items count again once it is back).  Changes
    that arrive late, with a smaller ``seq``, are ignored.  The table equals the
    full refresh of all items with the products as they are now, however the
    files are spread over calls; only amounts with more than six places, which
    are summed as doubles, may differ in their last digits.

    Products and differences by epoch lie with the checkpoint; an epoch that runs
    again writes the same ones, so recovery neither loses nor doubles anything.
    What is stored grows with the products, the sums with the categories.
    A checkpoint begun when products lay in Spark's state store ends with an
    error here; start a new one.
    """
    # items have no `seq`, changes have
    items = _raw_stream(spark, items_dir, items_columns).where(F.col(key).isNotNull())
    items = items.select(
        F.col(key).alias("product"),
        F.lit(None).cast("bigint").alias("seq"),
        F.lit(False).alias("deleted"),
        F.lit(None).cast("string").alias("category"),
        F.trim(F.col(price)).try_cast("double").alias("price"),
        F.col(item).isNotNull().alias("item"),
    )
    changes = _raw_stream(spark, changes_dir, changes_columns).where(F.col(key).isNotNull() & F.col(seq).try_cast("bigint").isNotNull())
    changes = changes.select(
        F.col(key).alias("product"),
        F.col(seq).try_cast("bigint").alias("seq"),
        F.coalesce(F.col(deleted).try_cast("boolean"), F.lit(False)).alias("deleted"),
        F.col(category).alias("category"),
        F.lit(None).cast("double").alias("price"),
        F.lit(False).alias("item"),
    )
    events = items.unionByName(changes)
    stored, totals, touched, known_products = (f"{checkpoint.rstrip('/')}/{name}" for name in ("category-deltas", "category-totals", "product-deltas", "product-totals"))

    def added_up(df: DataFrame) -> DataFrame:
        return df.groupBy("category").agg(*[F.sum(n).alias(n) for n in SUMS])

    def read(schema: str, parts: str, sums: str, base: int, until: int) -> DataFrame:
        """Totals of epochs before ``base`` and the parts from there to before ``until``."""
        paths = [f"{parts}/epoch={e}" for e in range(base, until)] + ([f"{sums}/epoch={base}"] if base else [])
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def publish(batch: DataFrame, epoch: int) -> None:
        # totals of epochs before `base` were written when the epoch before it ran
        base = epoch - epoch % COMPACT_EVERY
        batch_products = f"{touched}/batch"
        _by_product(batch).write.mode("overwrite").parquet(batch_products)
        rows = _joined(spark.read.schema(_STATE).parquet(batch_products), _known(read(_STATE, touched, known_products, base, epoch)))
        rows.write.mode("overwrite").parquet(f"{touched}/epoch={epoch}")
        added_up(_differences(spark.read.schema(_TOUCHED).parquet(f"{touched}/epoch={epoch}"))).write.mode("overwrite").parquet(f"{stored}/epoch={epoch}")
        now = added_up(read(_DELTA, stored, totals, base, epoch + 1))
        if (epoch + 1) % COMPACT_EVERY == 0:
            now.write.mode("overwrite").parquet(f"{totals}/epoch={epoch + 1}")
            _known(read(_STATE, touched, known_products, base, epoch + 1)).write.mode("overwrite").parquet(f"{known_products}/epoch={epoch + 1}")
            hadoop, fs, _ = file_system(spark, stored)
            gone = [f"{x}/epoch={e}" for x in (stored, touched) for e in range(max(0, base - COMPACT_EVERY), base)]
            for path in [*gone, *([f"{known_products}/epoch={base - COMPACT_EVERY}"] if base > COMPACT_EVERY else [])]:
                fs.delete(hadoop.Path(path), True)
        revenue = F.expr(merged_sql({n: n for n in amount_units("price")}))
        table = now.where("n > 0").select(
            F.col("category").alias("product_category_name"),
            F.when(F.col("priced") > 0, revenue).alias("total_receita"),
            F.col("items").alias("qtd_itens"),
        )
        write_refined(table, contract, location)

    query = events.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query

