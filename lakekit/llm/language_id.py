"""Language ID by Bayesian fusion of text, declared language, address and host evidence.

``log P(l | row) = w * log P(text | l) + log P(declared | l) + log P(suffix | l) + log P(l | host)``.
The text model counts letter trigrams of a bounded sample of labelled rows.
Everything else is counted over all rows by grouped aggregation, from rows
whose text alone is decided: how often each declared language and each address
suffix comes with each language, and the languages of each host, smoothed
towards those of its parent domain, and these towards all rows.  An extra
class ``und`` gives every trigram the same probability; it takes texts without
letters and texts that no language explains.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import bounded_batches, bytes_of, materialize, runs_of, small

BUCKETS = 1 << 15
UND = "und"
#: Share of rows that are in no language, before any evidence.
UND_PRIOR = 1e-3
#: Overlapping trigrams are not independent: weight of their log likelihood.
TEXT_WEIGHT = 1 / 3
_LETTER = np.zeros(256, np.uint32)
_LETTER[65:91] = _LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def trigrams(texts: list[bytes]):
    """``(bucket, text index)`` of all letter trigrams: A-Z lower-cased, other ASCII counts as a gap, no gap in the middle."""
    buf = np.frombuffer(b"\0" + b"\0".join(texts) + b"\0", np.uint8)
    x = _LETTER[buf]
    at = np.flatnonzero(x[1:-1]) + 1
    code = (x[at - 1] << np.uint32(16)) | (x[at] << np.uint32(8)) | x[at + 1]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(17)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return bucket.astype(np.int64), np.searchsorted(at - 1, ends)


@dataclass
class TextModel:
    """Log probabilities of the trigram buckets by language; the last row is ``und``."""

    languages: list[str]
    table: np.ndarray

    def score(self, texts: list[bytes], limit: int = 1 << 18):
        """Trigram counts and log likelihoods (one row per class) of each text."""
        for lo, hi in runs_of([len(t) for t in texts], limit):
            bucket, cuts = trigrams(texts[lo:hi])
            total = np.zeros((len(self.table), len(bucket) + 1))
            np.cumsum(self.table[:, bucket], axis=1, dtype=np.float64, out=total[:, 1:])
            starts = np.append(0, cuts[:-1])
            yield cuts - starts, total[:, cuts] - total[:, starts]


def fit_text_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 2000) -> TextModel:
    """Count trigrams of about ``per_language`` labelled rows of each language, picked by a hash of the id."""
    bounded_batches(docs)
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = {r["l"]: r["n"] for r in labelled.groupBy(F.col(lang_col).alias("l")).agg(F.count("*").alias("n")).collect()}
    names = sorted(known)
    if not names:
        return TextModel([], np.full((1, BUCKETS), -math.log(BUCKETS)))
    share = F.create_map(*[F.lit(v) for n in names for v in (n, min(1.0, per_language / known[n]))])
    picked = labelled.where(F.pmod(F.xxhash64(F.lit("fit"), F.col(id_col)), F.lit(1 << 20)) < share[F.col(lang_col)] * (1 << 20))

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in small(batches):
            for lang, text in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1))):
                counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                counts[lang] += np.bincount(trigrams([text])[0], minlength=BUCKETS)
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(n[at])], ["lang", "bucket", "n"])

    rows = picked.select(lang_col, text_col).mapInArrow(count, "lang string, bucket int, n bigint")
    table = np.full((len(names) + 1, BUCKETS), 0.05)
    for r in rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        table[names.index(r["lang"]), r["bucket"]] += r["n"]
    table = np.log(table / table.sum(axis=1, keepdims=True))
    table[-1] = -math.log(BUCKETS)
    return TextModel(names, table)


def language_code(column: Column) -> Column:
    """The primary subtag of a declared language (``en-GB`` -> ``en``), else null."""
    code = F.lower(F.regexp_extract(column, r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1))
    return F.when(code != "", code)


def address_parts(url: Column) -> dict[str, Column]:
    """Host, parent domain and suffix of an address; the suffix is a two-letter first path part, else the host's last label."""
    rest = F.regexp_extract(url, r"^[^:]*://([^/?#]*)", 1)
    host = F.when(rest != "", F.lower(rest))
    path = F.lower(F.regexp_extract(url, r"^[^:]*://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1))
    return {
        "host": host,
        "parent": F.substring_index(host, ".", -2),
        "suffix": F.when(path != "", path).otherwise(F.substring_index(host, ".", -1)),
    }


def page_text(html: Column) -> Column:
    """The articles of a page if it has any, else the page, without scripts, styles, comments and tags.

    Several articles are joined, nested ones are part of the outer one; one
    that is not closed goes to the end.
    """
    body = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>|<!--.*?-->", " ")
    mark = r"(?i)</?article(?=[\s/>])[^>]*>"
    texts = F.split(body, mark)
    steps = F.transform(F.regexp_extract_all(body, F.lit(f"({mark})"), F.lit(1)), lambda t: F.when(t.startswith("</"), -1).otherwise(1))
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("inside"))

    # the text after each mark is inside where more articles are open than closed
    def follow(s, x):
        depth = F.greatest(s["depth"] + x["step"], F.lit(0))
        return F.struct(depth.alias("depth"), F.when(depth > 0, F.concat(s["inside"], F.array(x["text"]))).otherwise(s["inside"]).alias("inside"))

    pieces = F.zip_with(steps, F.slice(texts, 2, F.size(texts)), lambda step, text: F.struct(step.alias("step"), text.alias("text")))
    article = F.aggregate(pieces, start, follow, lambda s: F.array_join(s["inside"], " "))
    return F.regexp_replace(F.when(F.trim(article) != "", article).otherwise(body), r"(?s)<[^>]*>", " ")


def domains_of(host: Column, top: Column) -> Column:
    """The domains a host is in, from ``top`` (default: its last two labels) to the host itself."""
    labels = F.split(host, r"\.")
    size = F.size(labels)
    first = F.least(F.coalesce(F.size(F.split(top, r"\.")), F.lit(2)), size)
    return F.transform(F.sequence(first, size), lambda i: F.array_join(F.slice(labels, size - i + 1, i), "."))


def host_priors(rows: DataFrame, decided: DataFrame, counts: list[Column], overall: Column, smooth: float) -> DataFrame:
    """``(host, p)``: shares of the languages by host, smoothed along every domain above it.

    A domain's counts are those of all hosts in it.  From the outermost domain
    to the host, ``p = (counts + smooth * p of the domain above) / (rows + smooth)``,
    starting from all rows' shares, so a new or small host borrows from the
    nearest domain that has rows.  Counts are grouped by host before they are
    spread over domains; a host has as many domains as labels.
    """
    by_host = decided.where("host is not null").groupBy("host", "parent").agg(F.array(*counts).alias("c"))
    spread = by_host.select(F.explode(domains_of(F.col("host"), F.col("parent"))).alias("domain"), "c")
    by_domain = spread.groupBy("domain").agg(F.array(*[F.sum(F.col("c")[i]) for i in range(len(counts))]).alias("c"))
    hosts = rows.where("host is not null").groupBy("host").agg(F.max("parent").alias("parent"))
    chain = hosts.select("host", F.posexplode(domains_of(F.col("host"), F.col("parent"))).alias("level", "domain")).join(by_domain, "domain")
    chain = chain.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("level", "c"))).alias("chain"))
    size = len(counts)

    def narrower(p: Column, domain: Column) -> Column:
        n = F.aggregate(domain["c"], F.lit(0.0), lambda s, x: s + x) + smooth
        return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (F.get(domain["c"], i) + smooth * F.get(p, i)) / n)

    return chain.select("host", F.aggregate("chain", overall, narrower).alias("p"))


def _with_priors(rows: DataFrame, priors: DataFrame, salts: int = 32, hot: int = 1000) -> DataFrame:
    """``rows`` with their host's prior.  Hosts with over a ``hot``-th of the rows (so at most ``hot`` names) are dealt to ``salts`` tasks."""
    total = rows.count()
    large = rows.where("host is not null").groupBy("host").count().where(F.col("count") * hot > total).select("host")
    names = [r["host"] for r in large.collect()]
    is_large = F.col("host").isin(names) if names else F.lit(False)
    left = rows.withColumn("salt", F.when(is_large, F.pmod(F.xxhash64("id", "tid"), F.lit(salts))).otherwise(F.lit(0).cast("bigint")))
    spread = F.when(is_large, F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).otherwise(F.array(F.lit(0).cast("bigint")))
    return left.join(priors.withColumn("salt", F.explode(spread)), ["host", "salt"], "left").drop("salt")


def identify(
    docs: DataFrame,
    model: TextModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared: Column | None = None,
    suffix: Column | None = None,
    host: Column | None = None,
    parent: Column | None = None,
    min_confidence: float = 0.5,
    smooth: float = 5.0,
) -> DataFrame:
    """One row per input row: ``id_col, lang, confidence, text_lang, declared, n_grams, accepted, lk_tid``.

    ``lang`` is the most probable class given all evidence and ``confidence``
    its probability; ``accepted`` is false for ``und`` and below
    ``min_confidence``.  Evidence that is null or not given has no effect.
    A host's prior is smoothed along all domains between it and ``parent``
    (default: its last two labels), see ``host_priors``.
    Null and empty texts have no trigrams: the other evidence decides, and
    without any they are ``und``.  Ties go to the first language in order.
    ``lk_tid`` (hash of the text) tells rows of one id apart; repeated rows
    get equal results.  Extra columns are not read.
    """
    bounded_batches(docs)
    names = [*model.languages, UND]
    k = len(names)
    none = F.lit(None).cast("string")
    prior = [math.log((1 - UND_PRIOR) / max(1, k - 1))] * (k - 1) + [math.log(UND_PRIOR)]

    def score(batches):
        for batch in small(batches):
            n, ll = [], []
            for count, scores in model.score(bytes_of(batch.column(2))):
                n.append(count)
                ll.append(scores.T * TEXT_WEIGHT)
            n, ll = (np.concatenate(x) if x else np.empty((0, *s)) for x, s in ((n, ()), (ll, (k,))))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * k, pa.int32()), pa.array(ll.ravel()))
            keep = [batch.column(i) for i in (0, 1, 3, 4, 5, 6)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(n, pa.int64()), lists], ["id", "tid", "declared", "suffix", "host", "parent", "n", "ll"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    evidence = [c if c is not None else none for c in (declared, suffix, host, parent)]
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("tid"), F.col(text_col).alias("text"),
        *[c.cast("string").alias(n) for c, n in zip(evidence, ("declared", "suffix", "host", "parent"))],
    )
    schema = "id bigint, tid bigint, declared string, suffix string, host string, parent string, n bigint, ll array<double>"
    rows = materialize(rows.mapInArrow(score, schema), "language-scores")

    def fused(*parts: str) -> Column:
        terms = " + ".join(f"{p}[i]" for p in parts)
        return F.expr(f"transform(sequence(0, {k - 1}), i -> {terms})")

    def best(column: str) -> Column:
        return F.expr(f"cast(array_position({column}, array_max({column})) as int) - 1")

    def certain(column: str) -> Column:
        return F.expr(f"1 / aggregate({column}, 0D, (s, x) -> s + exp(x - array_max({column})))")

    base = F.array(*[F.lit(p) for p in prior])
    rows = rows.withColumn("base", base).withColumn("alone", fused("ll", "base"))
    rows = rows.withColumn("pick", best("alone")).withColumn("sure", certain("alone"))
    decided = rows.where(f"n > 0 and sure >= 0.9 and pick < {k - 1}")
    counts = [F.sum((F.col("pick") == i).cast("double")) for i in range(k - 1)]

    # hosts, towards the domains they are in, one after the other, towards all rows
    total = decided.agg(F.array(*[F.coalesce(c, F.lit(0.0)) for c in counts]).alias("c")).first()["c"]
    share = [(c + 1) / (sum(total) + max(1, k - 1)) for c in total]
    overall = F.array(*[F.lit(float(s)) for s in share])

    def log_with_und(p: str) -> Column:
        return F.expr(f"concat(transform({p}, x -> ln(x * {1 - UND_PRIOR})), array({math.log(UND_PRIOR)}D))")

    out = rows
    if k > 1:
        priors = host_priors(rows, decided, counts, overall, smooth).select("host", log_with_und("p").alias("on_host"))
        out = _with_priors(out, priors)
        flat = F.array(*[F.lit(math.log(s * (1 - UND_PRIOR))) for s in share], F.lit(math.log(UND_PRIOR)))
        out = out.withColumn("on_host", F.coalesce("on_host", flat))
        for name in ("declared", "suffix"):
            # P(value | language), from the counts of all rows that have a value
            seen = decided.where(f"{name} is not null").groupBy(name).agg(F.array(*counts).alias("c"))
            whole = seen.agg(F.array(*[F.sum(F.col("c")[i]) for i in range(k - 1)]).alias("t"), F.count("*").alias("v")).first()
            t = F.array(*[F.lit(float(x or 0)) for x in (whole["t"] if whole["v"] else [0] * (k - 1))])
            per = F.expr(f"transform(sequence(0, {k - 2}), i -> ln((c[i] + 0.5) / (t[i] + 0.5 * {whole['v'] + 1})))")
            mean = F.expr("concat(p, array(aggregate(p, 0D, (s, x) -> s + x) / size(p)))")
            seen = seen.withColumn("t", t).withColumn("p", per).select(name, mean.alias(f"by_{name}"))
            out = out.join(seen, name, "left").withColumn(f"by_{name}", F.coalesce(f"by_{name}", F.array(*[F.lit(0.0)] * k)))
        out = out.withColumn("all", fused("ll", "on_host", "by_declared", "by_suffix"))
    else:
        out = out.withColumn("all", F.col("alone"))
    blank = (F.col("n") == 0) & F.col("declared").isNull() & F.col("suffix").isNull() & F.col("host").isNull()
    label = F.array(*[F.lit(n) for n in names])
    out = out.withColumn("best", F.when(blank, F.lit(k - 1)).otherwise(best("all"))).withColumn("confidence", F.when(blank, F.lit(1 - UND_PRIOR)).otherwise(certain("all")))
    return out.select(
        F.col("id").alias(id_col),
        F.get(label, F.col("best")).alias("lang"),
        "confidence",
        F.when(F.col("n") > 0, F.get(label, F.col("pick"))).alias("text_lang"),
        "declared",
        F.col("n").alias("n_grams"),
        ((F.col("best") < k - 1) & (F.col("confidence") >= min_confidence)).alias("accepted"),
        F.col("tid").alias("lk_tid"),
    )
