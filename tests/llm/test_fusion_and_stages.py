"""Language evidence against a plain version, alignments against unbanded ones, stages over rows that share an id."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakekit.llm import language_id, license_scan, ngram_join, queries
from lakekit.llm.common import words_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return language_id.fit_text_model(queries.documents(spark, SF))


def _fused(rows, model, smooth=5.0):
    """Language and confidence of each (text, declared, suffix, host) by the formula, in plain Python."""
    names, k = [*model.languages, "und"], len(model.languages) + 1
    prior = np.array([math.log((1 - language_id.UND_PRIOR) / (k - 1))] * (k - 1) + [math.log(language_id.UND_PRIOR)])
    ll, n = [], []
    for text, *_ in rows:
        (count, scores), = model.score([(text or "").encode()])
        n.append(int(count[0]))
        ll.append(scores[:, 0] * language_id.TEXT_WEIGHT)

    def probabilities(x):
        e = np.exp(x - x.max())
        return e / e.sum()

    picks = []
    for i in range(len(rows)):
        p = probabilities(ll[i] + prior)
        picks.append(int(p.argmax()) if n[i] and p.max() >= 0.9 and p.argmax() < k - 1 else None)
    decided = [(r, p) for r, p in zip(rows, picks) if p is not None]
    total = np.bincount([p for _, p in decided], minlength=k - 1)
    overall = (total + 1) / (total.sum() + k - 1)

    def domains(host):
        labels = host.split(".")
        return [".".join(labels[-i:]) for i in range(min(2, len(labels)), len(labels) + 1)]

    by_domain = defaultdict(lambda: np.zeros(k - 1))
    for (*_, host), p in decided:
        for d in domains(host) if host else []:
            by_domain[d][p] += 1
    seen = {}
    for at in (1, 2):
        seen[at] = defaultdict(lambda: np.zeros(k - 1))
        for r, p in decided:
            if r[at] is not None:
                seen[at][r[at]][p] += 1
    out = []
    for i, r in enumerate(rows):
        share = overall
        for d in domains(r[3]) if r[3] else []:
            if d in by_domain:
                share = (by_domain[d] + smooth * share) / (by_domain[d].sum() + smooth)
        x = ll[i] + np.append(np.log(share * (1 - language_id.UND_PRIOR)), math.log(language_id.UND_PRIOR))
        for at in (1, 2):
            if r[at] in seen[at]:
                sums = sum(seen[at].values())
                p = np.log((seen[at][r[at]] + 0.5) / (sums + 0.5 * (len(seen[at]) + 1)))
                x = x + np.append(p, p.mean())
        p = probabilities(x)
        out.append((names[int(p.argmax())], float(p.max())))
    return out


def test_fusion_matches_a_plain_version(spark, model):
    rng = random.Random(3)
    text = defaultdict(list)
    for r in queries.documents(spark, SF).where("n_chars between 200 and 2000").collect():
        text[r.lang].append(r.text[:400])
    langs = sorted(text)
    hosts = {"a.b.site.example": 0, "c.b.site.example": 0, "b.site.example": 1, "site.example": 1, "other.example": 2, "flat": 3 % len(langs)}
    rows = []
    for i in range(300):
        host = rng.choice([*hosts, None])
        lang = langs[hosts[host]] if host and rng.random() < 0.8 else rng.choice(langs)
        body = rng.choice(text[lang])
        rows.append((rng.choice([body, body, body[:12], "", None, "12 34"]), rng.choice([lang, None, rng.choice(langs)]), rng.choice([lang, "com", None]), host))
    rows += [("", None, None, "new.b.site.example"), ("", None, None, "x.y.other.example"), ("", None, None, "never.seen"), ("ab", "xx", "yy", None)]
    df = spark.createDataFrame([(i, *r, 1, "p") for i, r in enumerate(rows)], "doc_id bigint, text string, d string, s string, h string, salt int, host string")
    got = {r.doc_id: r for r in language_id.identify(df, model, declared=F.col("d"), suffix=F.col("s"), host=F.col("h")).collect()}
    for i, (lang, sure) in enumerate(_fused(rows, model)):
        if rows[i][0] and sum(c.isalpha() for c in rows[i][0]) or rows[i][1] or rows[i][2] or rows[i][3]:
            assert got[i].confidence == pytest.approx(sure, rel=1e-6)
            assert got[i].lang == lang or sure < 0.51
    assert got[300].lang == langs[0]  # from the domain next above, not from the outermost


def test_pages_query_on_odd_pages(spark, tmp_path):
    docs = queries.documents(spark, SF)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    text = {r.lang: r.text for r in docs.where("n_chars > 500").collect()}
    page = lambda lang, body: f'<html lang="{lang}"><body><article>{body}</article></body></html>'
    rows = [(1, "http://x.example.com/fr/a", page("fr", text["fr"]), 0), (1, "http://x.example.com/fr/a", page("fr", text["fr"]), 0), (2, None, None, 0), (3, "", "", 0), (None, "http://x.example.com/fr/b", page("fr", text["fr"]), 0)]
    rows += [(4, "http://x.example.com/q", "<html><article></article>", 0), (5, "no address", page("de-AT", text["de"]), 0)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string, lang int").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.pages_language_id(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by_id = defaultdict(set)
    for r in got:
        by_id[r.page_id].add((r.lang, r.accepted))
    assert by_id[1] == by_id[None] == {("fr", True)} and by_id[5] == {("de", True)}
    assert by_id[2] == by_id[3] == {("und", False)}
    whole = queries.pages_language_id(spark, "/root/testdata/sf0.001")
    assert whole.count() == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    assert whole.where("accepted and declared = lang").count() >= 0.9 * whole.where("declared is not null").count()


def _best_score(doc, template):
    """Score of the best local alignment, by the whole table: a match gains 2, a word left out on either side costs 1."""
    row, best = [0] * (len(template) + 1), 0
    for d in doc:
        before, row[0] = 0, 0
        for j, t in enumerate(template):
            before, row[j + 1] = row[j + 1], max(0, before + 2 if d == t else 0, row[j + 1] - 1, row[j] - 1)
            best = max(best, row[j + 1])
    return best


def test_alignments_are_as_good_as_unbanded_ones():
    rng = random.Random(9)
    for size in (40, 80, 200):
        template = [f"t{rng.randrange(3 * size)}" for _ in range(size)]
        index = license_scan.Index({"notice": " ".join(template)})
        for _ in range(25):
            edited = list(template)
            for _ in range(rng.randrange(size // 12)):
                at = rng.randrange(1, len(edited) - 1)
                kind = rng.randrange(3)
                edited[at : at + (kind > 0)] = [] if kind == 1 else [f"new{rng.randrange(1000)}"]
            noise = lambda n: [f"noise{rng.randrange(500)}" for _ in range(n)]
            doc = [*noise(rng.randrange(60)), *edited, *noise(rng.randrange(60))]
            text = " ".join(doc).encode()
            (found,) = index.scan(text, 0.75)
            _, coverage, matched, spans = found
            assert coverage == matched / size and spans == sorted(spans)
            assert sum(len(words_of(text[a:b])[0]) for a, b in spans) == matched
            # the same alignment, from its spans: words between them are left out in the document, the rest in the template
            starts = words_of(text)[1].tolist()
            at = [i for i, p in enumerate(starts) if any(a <= p < b for a, b in spans)]
            kept = [doc[i] for i in at]
            first = next(j for j in range(size) if template[j : j + 1] == kept[:1] and _follows(kept, template[j:]))
            last = first + _follows(kept, template[first:])
            score = 2 * matched - (at[-1] - at[0] + 1 - matched) - (last - first - matched)
            assert score == _best_score(doc, template)


def _follows(words, template):
    """How many words of the template hold ``words`` as a subsequence, from its start; 0 if they don't."""
    j = 0
    for w in words:
        while j < len(template) and template[j] != w:
            j += 1
        if j == len(template):
            return 0
        j += 1
    return j


def test_leaders_meet_in_bounded_parts(spark):
    rng = random.Random(12)
    passage = [f"p{i}" for i in range(60)]  # gives all sets one least shingle or another
    rows, sets = [], []
    for g in range(60):
        own = [f"g{g}x{i}" for i in range(40)]
        for _ in range(4):
            copy = own + [f"u{rng.randrange(10**6)}"]
            sets.append(g)
            rows.append((len(rows), " ".join(passage + copy)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    every = ngram_join._sets(docs, "doc_id", "text", 4, ngram_join.Threshold(85, 100))
    active = every.select(F.col("id").alias("rep"))
    whole = ngram_join._whole_sets(docs, active, "doc_id", "text", 4).dropDuplicates(["rep", "set"])
    for most in (5, 50, 10_000):
        links = ngram_join._leader_links(whole, ngram_join.Threshold(85, 100), most_rows=most).collect()
        assert links and all(sets[r.a] == sets[r.b] for r in links)
    got = ngram_join.ngram_groups(docs, words=4, num=85, den=100).collect()
    first = {g: sets.index(g) for g in range(60)}
    assert all(r.component_id == first[sets[r.doc_id]] for r in got)


def test_rows_of_one_id_with_different_texts_stay(spark):
    body = lambda s: " ".join(f"{s}{i}" for i in range(40))
    rows = [(1, body("a")), (1, body("b")), (1, body("a")), (2, body("a")), (3, body("c")), (3, None), (None, body("a")), (4, ""), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 9) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, tid int")
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_group(spark, docs, SF).collect())
    assert got == Counter([(1, body("a")), (1, body("b")), (3, body("c")), (3, None), (None, body("a")), (4, "")])
