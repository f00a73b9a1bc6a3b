"""Mixing sources to target weights, in DataFrame operations only.

Each source's words, document after document, are packed into blocks of a
fixed length.  The mix is a row of slots of one block each, cut into shards.  A
shard's slots are drawn from the sources at their weights, so its counts by
source are multinomial; what a source is drawn beyond its quota over all shards
goes to sources that fell short of theirs.  The slots of a source are numbered
over all shards, and a pseudorandom permutation of its block indexes, another
for each pass over the source, maps the numbers to blocks, which are joined by
index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import discard, materialize

#: Words are runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def _div(a: Column | str, b: Column | int) -> Column:
    return F.call_function("div", F.col(a) if isinstance(a, str) else a, F.lit(b) if isinstance(b, int) else b)


def running(df: DataFrame, keys: list[str], order: str, value: str, name: str, fan: int = 1000) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of ``keys`` with a smaller ``order`` (a bigint, unique in ``keys``).

    In two levels: a window holds at most ``fan`` orders of a key, or one row for each ``fan`` of them.
    """
    cut = df.withColumn("__cut", _div(order, fan)).withColumn("__key", F.xxhash64(*keys) if keys else F.lit(0))
    by = [*keys, "__key", "__cut"]
    sums = cut.groupBy(*by).agg(F.sum(value).alias("__total"))
    upto = Window.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__total").over(upto.partitionBy(*keys, "__key").orderBy("__cut")), F.lit(0))
    inside = F.coalesce(F.sum(value).over(upto.partitionBy(*by).orderBy(order)), F.lit(0))
    both = cut.withColumn("__inside", inside).join(sums.select(*by, before.alias("__before")), by)
    return both.withColumn(name, F.col("__before") + F.col("__inside")).drop("__key", "__cut", "__before", "__inside")


def permuted(x: Column, n: Column, *key: Column, rounds: int = 20) -> Column:
    """The place of ``x`` in a pseudorandom permutation of 0..n-1, another one for each ``key``.

    A swap-or-not shuffle: each round pairs every index with its mirror image
    at a pseudorandom centre and swaps the two or not by a hash of the pair, so
    it is a permutation for any ``n``.
    """

    def swap(at: Column, r: Column) -> Column:
        twin = F.pmod(F.pmod(F.xxhash64(*key, r), n) - at, n)
        return F.when(F.xxhash64(*key, r, F.greatest(at, twin)) % 2 == 0, twin).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x.cast("bigint"), swap)


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """``(source, number, source_size, target)`` of ``(source, size)``.

    Sources are numbered by code point, null last, and take ``weights`` in turn.
    Targets share ``share`` times all words at these weights, but stop at
    ``most`` times their source's words; the excess is shared among the other
    sources by weight until no target is above.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # numbered without one task for all: ranges of sources, numbered within, and the counts of the ranges before
    ranged = by_source.repartitionByRange(F.col("source").isNull(), F.col("source"))
    ranged = materialize(ranged.withColumn("part", F.spark_partition_id().cast("bigint")), "mix-sources")
    starts = running(ranged.groupBy("part").agg(F.count("*").alias("n")), [], "part", "n", "start").select("part", "start")
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")) - 1
    named = ranged.withColumn("inside", inside).join(starts, "part").withColumn("number", F.col("start") + F.col("inside"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    named = materialize(named.select("source", "number", "source_size", weight.alias("weight")), "mix-sources")
    discard(ranged)
    total = named.agg(F.sum("source_size")).first()[0] or 0
    full, rate, capped = most * F.col("source_size"), 0.0, None
    while True:  # each round caps a source more, or ends; three numbers go to the driver
        above = F.col("weight") * F.lit(rate) > full
        n, held, weight = named.agg(F.count(F.when(above, 1)), F.sum(F.when(above, full)), F.sum(F.when(~above, F.col("weight")))).first()
        if n == capped:
            break
        capped, rate = n, (share * total - (held or 0)) / weight if weight else float("inf")
    target = F.least(F.col("weight") * F.lit(rate), full.cast("double"))
    return named.select("source", "number", "source_size", target.alias("target"))


def placed_documents(sizes: DataFrame, targets: DataFrame, rows_per_group: int = 500) -> DataFrame:
    """``sizes`` with its source's figures, a unique ``(salt, nth)`` in the source and the place ``start`` of its first word there.

    Documents of a source are placed by hash groups of about ``rows_per_group``,
    so a source that holds most rows is many groups.
    """
    groups = max(1, -(-sizes.count() // rows_per_group))
    rows = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop("source")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id", "tid"), F.lit(groups)))
    sums = rows.groupBy("number", "salt").agg(F.sum("size").alias("total"))
    starts = running(sums, ["number"], "salt", "total", "base").select("number", "salt", "base")
    order = Window.partitionBy("number", "salt").orderBy("id", "tid")
    inside = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    rows = rows.withColumn("nth", F.row_number().over(order)).withColumn("inside", inside).join(starts, ["number", "salt"])
    return rows.withColumn("start", F.col("base") + F.col("inside")).drop("base", "inside")


def draw_slots(targets: DataFrame, block: int = 256, shard_slots: int = 1024, seed: int = 7) -> DataFrame:
    """The mix's slots ``(shard, slot, number, block, words)``.

    ``number`` is the source's, ``block`` the index of one of its blocks and
    ``words`` how many of the block's words are taken: all, but for the last
    slot of a source, with which it gets its target to the word.  The last,
    shorter block of a source comes last in each pass, the others in permuted
    order.
    """
    spark = targets.sparkSession
    size = F.nullif(F.col("source_size"), F.lit(0))
    quotas = targets.withColumn("words", F.round("target").cast("bigint")).withColumn("full", _div("source_size", block))
    quotas = quotas.withColumn("blocks", _div(F.col("source_size") + (block - 1), block))
    quota = _div(F.col("words"), size) * F.col("blocks") + _div(F.col("words") % size + (block - 1), block)
    quotas = running(quotas.withColumn("quota", F.coalesce(quota, F.lit(0))), [], "number", "quota", "start")
    quotas = materialize(quotas, "mix-quotas")
    slots, sources = quotas.agg(F.coalesce(F.sum("quota"), F.lit(0)), F.count("*")).first()

    # multinomial counts: each slot draws a number of 0..slots-1, and the source whose share holds it is found by cells
    cell = max(1, slots // (4 * max(1, sources)))
    last = F.col("start") + F.col("quota") - 1
    cells = quotas.where("quota > 0").withColumn("end", last)
    cells = cells.select("number", "start", "end", F.explode(F.sequence(_div("start", cell), _div("end", cell))).alias("cell"))
    tasks = max(spark.sparkContext.defaultParallelism, slots // 1_000_000)
    draws = spark.range(0, slots, 1, tasks).select(
        F.col("id").alias("slot"),
        _div("id", shard_slots).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, slots))).alias("drawn"),
    )
    draws = draws.withColumn("cell", _div("drawn", cell)).join(cells, "cell").where("drawn between start and end")
    got = draws.groupBy("number", "shard").agg(F.sort_array(F.collect_list("slot")).alias("slots"))  # at most a shard's
    got = materialize(got.withColumn("n", F.size("slots").cast("bigint")), "mix-draws")

    counts = running(got.drop("slots"), ["number"], "shard", "n", "base").join(quotas.select("number", "quota"), "number")
    counts = materialize(counts, "mix-counts")
    ranked = got.drop("n").join(counts, ["number", "shard"]).select("number", "shard", "base", "quota", F.posexplode("slots").alias("pos", "slot"))
    ranked = ranked.select("number", "shard", "slot", "quota", (F.col("base") + F.col("pos")).alias("rank"))
    # slots beyond a quota, numbered, meet the ranks that other sources lack, numbered alike
    lost = F.greatest(F.col("base") + F.col("n") - F.greatest("base", "quota"), F.lit(0))
    by_shard = counts.groupBy("shard").agg(F.sum(lost).alias("lost")).where("lost > 0")
    by_shard = running(by_shard, [], "shard", "lost", "before").select("shard", "before")
    nth = F.row_number().over(Window.partitionBy("shard").orderBy("slot")) - 1
    freed = ranked.where("rank >= quota").withColumn("nth", nth).join(by_shard, "shard")
    freed = freed.select("shard", "slot", (F.col("before") + F.col("nth")).alias("place"))
    drawn = counts.groupBy("number").agg(F.sum("n").alias("drawn"))
    short = quotas.join(drawn, "number", "left").select("number", F.coalesce("drawn", F.lit(0)).alias("drawn"), "quota").where("drawn < quota")
    short = running(short.withColumn("lacks", F.col("quota") - F.col("drawn")), [], "number", "lacks", "first")
    lacking = short.select("number", "drawn", "first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("lacks") - 1)).alias("i"))
    lacking = lacking.select("number", (F.col("first") + F.col("i")).alias("place"), (F.col("drawn") + F.col("i")).alias("rank"))
    settled = ranked.where("rank < quota").select("number", "shard", "slot", "rank")
    settled = settled.unionByName(freed.join(lacking, "place").select("number", "shard", "slot", "rank"))

    at = settled.join(quotas.select("number", "source_size", "words", "full", "blocks"), "number")
    at = at.withColumn("pass", _div("rank", F.col("blocks"))).withColumn("i", F.col("rank") % F.col("blocks"))
    index = F.when(F.col("i") < F.col("full"), permuted(F.col("i"), F.col("full"), F.lit(seed), F.col("number"), F.col("pass")))
    at = at.withColumn("block", F.coalesce(index, F.col("full")))
    length = F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    left = F.col("words") - F.col("pass") * F.col("source_size") - F.col("i") * block
    return materialize(at.select("shard", "slot", "number", "block", F.least(length, left).alias("words")), "mix-slots")


def _mixed(docs: DataFrame, id_col: str, text_col: str, source_col: str, block: int, weights, share, most, **options):
    """``(documents of any size, their parts that slots take)``, both with the documents' columns of ``placed_documents``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    sizes = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
        F.xxhash64(text).alias("tid"),
    )
    sizes = materialize(sizes, "mix-sizes")
    targets = materialize(source_targets(sizes, weights, share, most), "mix-targets")
    placed = materialize(placed_documents(sizes, targets), "mix-documents")
    discard(sizes)
    slots = draw_slots(targets, block, **options)
    some = placed.where("size > 0")
    parts = some.withColumn("block", F.explode(F.sequence(_div("start", block), _div(F.col("start") + F.col("size") - 1, block))))
    parts = parts.join(slots, ["number", "block"])
    lo = F.greatest(F.col("start"), F.col("block") * block)
    hi = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("words"))
    parts = parts.withColumn("first_word", lo - F.col("start")).withColumn("n_words", hi - lo).where("n_words > 0")
    return placed, parts.withColumn("place", lo - F.col("block") * block)


def mix_sources(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", block=256, weights=(5, 2, 1), share=1.5, most=2, with_text=False, **options) -> DataFrame:
    """The mix as parts of documents: ``(shard, slot, place, id_col, first_word, n_words[, text])``.

    ``place`` is the part's first word in its slot of ``block`` words, and
    ``first_word`` its first word in the document, both from 0.  ``with_text``
    adds the words, joined by single blanks.  A source's parts together have its
    target's number of words (``source_targets``), rounded, and no word is taken
    more than ``most`` times.  Equal input gives an equal mix, whatever its order.

    Words are runs without ASCII white space.  Null, empty and blank texts have
    none and are in no part.  A null source is a source, the last one; null ids
    are kept; repeated rows are documents of their own.  An empty table gives an
    empty mix.  Other columns are not read.  ``options``: ``shard_slots``, ``seed``.
    """
    _, parts = _mixed(docs, id_col, text_col, source_col, block, weights, share, most, **options)
    columns = ["shard", "slot", "place", F.col("id").alias(id_col), "first_word", "n_words"]
    if not with_text:
        return parts.select(*columns)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    texts = docs.select(F.col(f"`{id_col}`").alias("__id"), F.xxhash64(text).alias("__tid"), text.alias("__text")).dropDuplicates(["__id", "__tid"])
    # a document's parts travel together, so that its text does once
    bundle = parts.groupBy("id", "tid").agg(F.collect_list(F.struct("shard", "slot", "place", "first_word", "n_words")).alias("__parts"))
    both = bundle.join(texts, F.col("id").eqNullSafe(F.col("__id")) & (F.col("tid") == F.col("__tid")))
    both = both.select("id", F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)).alias("__words"), F.explode("__parts").alias("__part")).select("id", "__words", "__part.*")
    words = F.slice("__words", (F.col("first_word") + 1).cast("int"), F.col("n_words").cast("int"))
    return both.select(*columns, F.array_join(words, " ").alias("text"))


def taken_words(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", block=256, weights=(5, 2, 1), share=1.5, most=2, **options) -> DataFrame:
    """One row per document: ``(id_col, size, source_size, target, taken)``.

    ``size`` is its number of words, ``source_size`` and ``target`` are its
    source's, and ``taken`` is how many of its words ``mix_sources`` takes,
    repeats counted: at most ``most`` times its size, 0 for documents without
    words.  Arguments and odd cases as there; each input row gives a row.
    """
    placed, parts = _mixed(docs, id_col, text_col, source_col, block, weights, share, most, **options)
    key = ["number", "salt", "nth"]
    taken = parts.groupBy(*key).agg(F.sum("n_words").alias("taken"))
    out = placed.join(taken, key, "left")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
