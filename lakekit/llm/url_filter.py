"""URL filters: fixed host and path rules, and association rules mined from labelled URLs.

Spark's FP-growth mines token combinations of labelled URLs.  Rules whose
consequence is a label are pruned by support, confidence and lift over the
label's share of all rows; a rule also goes when any part of its tokens says
the same at least as surely.  Tokens that always come together count as one.  URLs
match through an inverted index: each rule is filed under its rarest token, a
URL looks its tokens up there and the rule fires if the URL has all its tokens.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import lower_ascii, materialize

ALLOW, BLOCK = "allow", "block"
#: The rules of the production query (fixed values): host, path, verdict.
RULES = (
    ("org", "/", ALLOW),
    ("example.org", "/es/", BLOCK),
    ("example.org", "/en/1", BLOCK),
    ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and query of a URL; empty without ``://`` or for null."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"(?s)^[^?#]*\?([^#]*)", 1)
    return lower_ascii(host), path, query


def fixed_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none fits."""
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return (rule, verdict) if rules else (none, none)


def url_tokens(url: Column) -> Column:
    """Distinct tokens: scheme, host, its labels and parent domains, path words, query keys; numbers only by their length."""
    host, path, query = url_parts(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))),
        lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(labels, -i, i), ".")),
    )
    parents = F.when(F.size(labels) > 0, parents).otherwise(F.array().cast("array<string>"))
    words = F.filter(F.split(F.lower(path), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    words = F.transform(words, lambda x: F.when(x.rlike(r"^\d+$"), F.concat(F.lit("digits:"), F.length(x).cast("string"))).otherwise(F.concat(F.lit("p:"), x)))
    keys = F.filter(F.transform(F.split(F.lower(query), "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    keys = F.transform(keys, lambda x: F.concat(F.lit("q:"), x))
    scheme = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    scheme = F.when(scheme != "", F.array(F.concat(F.lit("s:"), scheme))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(scheme, parents, words, keys))


def together(baskets: DataFrame, tokens_col: str) -> DataFrame:
    """``(token, stands_for)``: tokens that are in the same rows stand for one another; the least one of each such set is mined.

    Rows of a token are told by their number and two sums of row hashes.
    """
    rows = baskets.withColumn("__row", F.monotonically_increasing_id()).select(F.explode(tokens_col).alias("token"), "__row")
    one, two = F.xxhash64("__row"), F.xxhash64("__row", F.lit(1))
    marks = rows.groupBy("token").agg(F.count("*").alias("n"), F.sum(F.shiftright(one, 32)).alias("a"), F.sum(F.shiftright(two, 32)).alias("b"))
    return marks.withColumn("stands_for", F.min("token").over(Window.partitionBy("n", "a", "b"))).select("token", "stands_for")


def mine_rules(labelled: DataFrame, tokens_col: str, label_col: str, min_support: float = 0.01, min_confidence: float = 0.7, min_lift: float = 1.1) -> DataFrame:
    """``(rule_id, tokens, verdict, confidence, support, lift)`` from rows with a label; materialised.

    Label items are ``label=...``.  FP-growth runs over all labelled rows.
    Tokens that always come together are mined as one, so they don't multiply
    the frequent sets; their rule holds the least of them.  A rule stays if its
    verdict is ``min_lift`` times as likely as in all rows (or its confidence
    is 1), and if none of its parts, down to single tokens, is as sure.
    """
    spark = labelled.sparkSession
    none = "rule_id bigint, tokens array<string>, verdict string, confidence double, support double, lift double"
    rows = materialize(labelled.select(F.col(tokens_col).alias("tokens"), F.col(label_col).alias("label")), "url-labels")
    total = rows.count()
    if not total:
        return spark.createDataFrame([], none)
    one_of = materialize(together(rows, "tokens").where("token <> stands_for"), "url-synonyms")
    baskets = materialize(_without(rows, one_of).select(F.concat("tokens", F.array(F.concat(F.lit("label="), "label"))).alias("items")), "url-baskets")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0).fit(baskets)
    labels = F.filter("items", lambda x: x.startswith("label="))
    sets = model.freqItemsets.select(F.sort_array(F.filter("items", lambda x: ~x.startswith("label="))).alias("tokens"), F.get(labels, F.lit(0)).alias("label"), "freq")
    sets = materialize(sets, "url-itemsets")
    both = sets.where("label is not null and size(tokens) > 0").withColumnRenamed("freq", "hits")
    both = both.join(sets.where("label is null").select("tokens", "freq"), "tokens").join(sets.where("label is not null and size(tokens) = 0").select("label", F.col("freq").alias("base")), "label")
    confidence = F.col("hits") / F.col("freq")
    rules = both.select(
        "tokens",
        F.substring("label", 7, 1 << 20).alias("verdict"),
        confidence.alias("confidence"),
        (F.col("hits") / total).alias("support"),
        (confidence * total / F.col("base")).alias("lift"),
    )
    rules = materialize(rules, "url-rules")
    # the surest of a rule's parts: every part of a frequent set is frequent, so it is found through parts of one token less
    longest = rules.agg(F.max(F.size("tokens"))).first()[0] or 0
    surest = rules.where("size(tokens) = 1").select("tokens", "verdict", "confidence", F.lit(0.0).alias("part"))
    done = [surest]
    for size in range(2, longest + 1):
        parts = rules.where(F.size("tokens") == size).select("tokens", "verdict", "confidence", F.explode("tokens").alias("t"))
        parts = parts.select("tokens", "verdict", "confidence", F.array_remove(F.col("tokens"), F.col("t")).alias("less"))
        below = surest.select(F.col("tokens").alias("less"), "verdict", F.greatest("confidence", "part").alias("c"))
        surest = parts.join(below, ["less", "verdict"], "left").groupBy("tokens", "verdict").agg(F.first("confidence").alias("confidence"), F.coalesce(F.max("c"), F.lit(0.0)).alias("part"))
        surest = materialize(surest, "url-parts-of-rules")
        done.append(surest)
    part = reduce(DataFrame.unionByName, done).select("tokens", "verdict", "part")
    kept = rules.join(part, ["tokens", "verdict"]).where("confidence > part")
    kept = kept.where((F.col("confidence") >= min_confidence) & ((F.col("lift") >= min_lift) | (F.col("confidence") == 1)))
    order = Window.partitionBy("tokens").orderBy(F.desc("confidence"), F.desc("support"), "verdict")
    kept = kept.withColumn("r", F.row_number().over(order)).where("r = 1").drop("r")
    return materialize(kept.withColumn("rule_id", F.xxhash64(F.array_join("tokens", " "))).select("rule_id", "tokens", "verdict", "confidence", "support", "lift"), "url-rules")


def _without(rows: DataFrame, one_of: DataFrame) -> DataFrame:
    """The rows' token sets without tokens for which another one stands; equal sets are looked at once."""
    sets = rows.select(F.col("tokens").alias("set")).distinct()
    kept = sets.select("set", F.explode("set").alias("token")).join(one_of.select("token"), "token", "left_anti")
    kept = kept.groupBy("set").agg(F.array_sort(F.collect_list("token")).alias("less"))
    both = rows.join(kept, rows["tokens"] == kept["set"], "left")
    return both.select(F.coalesce("less", F.array().cast("array<string>")).alias("tokens"), "label")


def match_rules(urls: DataFrame, id_cols: list[str], tokens_col: str, rules: DataFrame) -> DataFrame:
    """The surest fired rule of each distinct token set: ``tokens_col, rule_tokens, rule_verdict, rule_confidence``.

    Equal token sets are matched once.
    """
    sets = urls.select(F.sort_array(tokens_col).alias("set")).distinct()
    count = rules.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    place = Window.partitionBy("rule_id").orderBy("n", "token")
    index = rules.select("rule_id", "tokens", "verdict", "confidence", "support", F.explode("tokens").alias("token"))
    # a rule is filed under the token that the fewest rules have
    index = index.join(count, "token").withColumn("r", F.row_number().over(place)).where("r = 1").drop("r", "n")
    looked = sets.select("set", F.explode("set").alias("token")).join(index, "token")
    fired = looked.where(F.size(F.array_except("tokens", "set")) == 0)
    best = F.max_by(F.struct("tokens", "verdict", "confidence"), F.struct("confidence", "support", -F.size("tokens"), "rule_id"))
    return fired.groupBy("set").agg(best.alias("rule")).select("set", "rule.*")


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules=RULES,
    default: str = ALLOW,
    min_support: float = 0.01,
    min_confidence: float = 0.7,
) -> DataFrame:
    """``(id_col, host, path, rule, verdict, mined_rule, mined_confidence)``, one row per input row.

    The longest fixed rule decides where one fits.  The URLs that fixed rules
    decide are the labels from which association rules are mined; these judge
    the other URLs, and ``default`` holds where none fires.

    Null URLs and URLs without ``://`` have an empty host and path, match no
    rule and get ``default``.  Null ids are kept, repeated rows are judged
    alike, extra columns are not read, an empty table gives no rows.
    """
    host, path, _ = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), F.sort_array(url_tokens(F.col(url_col))).alias("set"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    rows = materialize(rows.withColumn("rule", rule).withColumn("fixed", verdict), "url-parts")
    # the fixed rules' own answer is the label: only tokens that also occur elsewhere can help, so all are mined
    mined = mine_rules(rows.where("fixed is not null"), "set", "fixed", min_support, min_confidence)
    found = match_rules(rows.where("fixed is null"), [id_col], "set", mined)
    found = materialize(found, "url-matches").withColumnsRenamed({"set": "__set", "tokens": "__tokens", "verdict": "__verdict", "confidence": "__confidence"})
    out = rows.join(found, (F.col("set") == F.col("__set")) & F.col("fixed").isNull(), "left")
    return out.select(
        F.col(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("fixed", "__verdict", F.lit(default)).alias("verdict"),
        F.array_join("__tokens", " ").alias("mined_rule"),
        F.col("__confidence").alias("mined_confidence"),
    )
