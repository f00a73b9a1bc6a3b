"""URL filters, fingerprints, license scans, encoding, packing, language ID and the pipeline."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pytest
from brute import order, shingles
from pyspark.sql import functions as F

import corpus_pipeline
from lakekit.llm import fingerprints, language_id, license_scan, packing, piece_lattice, queries, url_filter

SF = "/root/testdata/sf0.001"

# --- URLs


def _fixed(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in url_filter.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


def test_url_rules_and_mined_verdicts(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1?x#y", "http://example.org", "http://org/", "ftp://x.com/de/", "a://b.com/fr/?q=1"]
    urls += [f"http://h{i % 7}.example.com/de/{i}" for i in range(30)] + [f"http://h{i % 7}.example.com/fr/{i}" for i in range(30)]
    urls += ["http://other.net/de/5", "http://other.net/fr/5", "http://example.net/zz", "http://notexample.org/es/1"] * 2
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(None, None, None)], "page_id bigint, url string, host string")
    got = url_filter.judge_urls(pages, min_support=0.05).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        host, path, rule, verdict = _fixed(urls[r.page_id] if r.page_id is not None else None)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    by_url = {urls[r.page_id]: r.verdict for r in got if r.page_id is not None}
    assert by_url["http://other.net/de/5"] == "block" and by_url["http://other.net/fr/5"] == "allow"
    assert url_filter.judge_urls(pages.where("false")).count() == 0


def test_url_verdicts_are_the_contract_s(spark):
    urls = {"http://example.org/en/12": "block", "http://w.example.org/en/1": "block", "http://example.org/en/2": "allow", "http://example.org/es/1": "block",
            "http://a.org/en/1": "allow", "http://a.com/fr/1": "allow", "http://a.com/de/1": "block"}
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert [got[i][1] for i in range(len(urls))] == list(urls.values())
    assert got[0][0] == got[1][0] == "example.org/en/1"


def test_mined_rules_match_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, sorted({rng.choice("abcdef") for _ in range(3)}), "block" if rng.random() < 0.5 else "allow") for i in range(200)]
    rows = [(i, t, "block" if "a" in t and "b" in t else v) for i, t, v in rows]
    df = spark.createDataFrame(rows, "i bigint, t array<string>, v string")
    rules = {(tuple(r.tokens), r.verdict): (r.confidence, r.support) for r in url_filter.mine_rules(df, "t", "v", 0.02, 0.7).collect()}
    assert rules[("a", "b"), "block"][0] == 1.0
    for (tokens, verdict), (confidence, support) in rules.items():
        have = [v for _, t, v in rows if set(tokens) <= set(t)]
        assert confidence == pytest.approx(have.count(verdict) / len(have)) and confidence >= 0.7
        assert support == pytest.approx(have.count(verdict) / len(rows)) and support >= 0.02
    fired = {tuple(r.set): (tuple(r.tokens), r.verdict) for r in url_filter.match_rules(df, ["i"], "t", spark.createDataFrame(
        [(k, list(t), v, *x) for k, ((t, v), x) in enumerate(rules.items())], "rule_id bigint, tokens array<string>, verdict string, confidence double, support double")).collect()}
    for _, t, _ in rows:
        fits = [rules[k] for k in rules if set(k[0]) <= set(t)]
        assert (tuple(t) in fired) == bool(fits)
        if fits:
            assert rules[fired[tuple(t)]] == max(fits)


def test_mined_rules_beat_the_base_rate_and_their_parts(spark):
    rng = random.Random(8)
    rows = []
    for i in range(2000):
        t = {x for x in "abcd" if rng.random() < 0.4}
        block = "a" in t and rng.random() < 0.95 or {"b", "c", "d"} <= t or rng.random() < 0.02
        t |= {"scheme"} | ({f"twin{j}" for j in range(25)} if "d" in t else set())  # 2^25 sets, if mined apart
        rows.append((i, sorted(t), "block" if block else "allow"))
    df = spark.createDataFrame(rows, "i bigint, t array<string>, v string")
    rules = {(tuple(r.tokens), r.verdict): r for r in url_filter.mine_rules(df, "t", "v", 0.01, 0.5).collect()}
    confidence = lambda tokens, v: np.mean([w == v for _, t, w in rows if set(tokens) <= set(t)])
    base = {v: np.mean([w == v for *_, w in rows]) for v in ("allow", "block")}
    assert (("a",), "block") in rules and (("b", "c", "d"), "block") in rules
    for (tokens, v), r in rules.items():
        assert r.confidence == pytest.approx(confidence(tokens, v)) and r.lift == pytest.approx(r.confidence / base[v])
        assert r.lift >= 1.1 or r.confidence == 1
        parts = [c for n in range(1, len(tokens)) for c in itertools.combinations(tokens, n)]
        assert all(confidence(c, v) < r.confidence for c in parts)
    assert not any("scheme" in tokens and len(tokens) > 1 or any(x.startswith("twin") for x in tokens) for tokens, _ in rules)


def test_urls_of_any_length(spark):
    urls = ["http://example.com/de/" + "x/" * 50_000, "http://example.com/fr/?" + "&".join(f"k{i}=1" for i in range(3000)), "http://" + "a." * 60 + "net/q"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(3, urls[0])], "page_id bigint, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(pages, min_support=0.5).collect()}
    assert (got[0], got[1], got[3]) == ("block", "allow", "block") and got[2] in ("allow", "block")


# --- fingerprints


def test_fingerprints(spark, sample, awkward, empty):
    rows = sorted(sample)
    docs = spark.createDataFrame(sample, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs).collect()}
    off = []
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b = shingles(text, 5), shingles(edited, 5)
        if min(len(a), len(b)) >= 200:
            off.append(abs(r.near_edited - len(a & b) / min(len(a), len(b))))
    assert np.mean(off) < 0.08
    assert len({r.fingerprint for r in got.values()}) >= len({tuple(sorted(shingles(t, 5))) for _, t in rows}) - 2
    for groups in (1, 2, 50):
        spare = fingerprints.with_next(docs, groups=groups).where("spare").count()
        held = fingerprints.with_next(docs, groups=groups).where("not spare").agg(F.count("*"), F.countDistinct("group")).first()
        assert held[0] == len(rows) and spare == held[1] <= groups
    odd = fingerprints.fingerprint_documents(awkward).collect()
    assert len(odd) == awkward.count()
    assert {r.fingerprint for r in odd if r.doc_id in (3, 4, 5)} == {""}
    assert len({r.fingerprint for r in odd if r.doc_id in (1, 2)}) == 1
    assert fingerprints.fingerprint_documents(empty).count() == 0


def test_sketches_merge():
    rng = np.random.default_rng(0)
    a, b = (np.unique(rng.integers(0, 1 << 64, 1000, dtype=np.uint64)) for _ in range(2))
    whole = fingerprints.scaled(np.union1d(a, b))
    assert (fingerprints.merge(fingerprints.scaled(a), fingerprints.scaled(b)) == whole).all()
    assert (fingerprints.from_text(fingerprints.to_text(whole)) == whole).all()
    assert fingerprints.containment(fingerprints.scaled(a), whole) == 1.0


def test_sketches_of_short_sets():
    rng = np.random.default_rng(1)
    numbers = lambda n: np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
    long, none = numbers(20_000), []
    for n in range(1, 201):
        short, other = numbers(n), numbers(n)
        half = np.union1d(short[: n // 2], other[n // 2 :])
        a, b = fingerprints.scaled(short), fingerprints.scaled(half)
        assert fingerprints.containment(a, b) == np.isin(short, half).mean() == n // 2 / n
        assert (fingerprints.merge(a, b) == fingerprints.scaled(np.union1d(short, half))).all()
        within = fingerprints.scaled(np.union1d(short, long))
        assert (fingerprints.merge(a, fingerprints.scaled(long)) == within).all()
        found = [fingerprints.containment(fingerprints.scaled(numbers(n)), fingerprints.scaled(long)), fingerprints.containment(a, within)]
        assert found[0] == 0.0 and found[1] in (1.0, 0.0)
        none += [n] * (found[1] == 0)
    assert len(none) <= 5 and max(none, default=0) < 12
    empty = np.empty(0, np.uint64)
    assert fingerprints.containment(empty, empty) == 1 and fingerprints.containment(empty, within) == fingerprints.containment(a, empty) == 0


def test_fingerprints_of_short_documents(spark, sample):
    long = max((t for _, t in sample), key=len)
    lines = [" ".join(f"w{n}x{i}" for i in range(n + 4)) for n in range(1, 201)]
    rows = [r for i, line in enumerate(lines) for r in ((2 * i, line), (2 * i + 1, line + " " + long))]
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, line in enumerate(lines):
        n = len(line) // 4
        a, b = shingles(line, 5), shingles(line[: len(line) - n] + rows[2 * i + 1][1][:n], 5)
        assert got[2 * i].near_edited == len(a & b) / min(len(a), len(b))
        assert got[2 * i].near_next == 1 or got[2 * i].near_next == 0 and i < 12


def test_fingerprints_of_whole_tables(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    got = queries.op2_fingerprints(spark, sf).collect()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    texts = {r.doc_id: r.text for r in queries.documents(spark, sf).collect()}
    long = [r for r in got if len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])) > 1000]
    assert len(long) > 20 and all(len(r.fingerprint) <= len(texts[r.doc_id]) / 4 for r in long)
    want = duckdb.sql(f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM read_parquet('{sf}/documents.parquet')),
        n AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id), first(t) OVER (ORDER BY doc_id)) AS u, length(t) // 4 AS k FROM d)
        SELECT doc_id, length(t), sha256(left(t, length(t) - k) || left(u, k)) FROM n""")
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(want.fetchall())


# --- licenses


def test_license_scan(spark, awkward, empty):
    mit = license_scan.TEMPLATES["MIT"]
    words = mit.split()
    changed = " ".join(words[:20] + ["now", "changed"] + words[21:])
    texts = ["x " * 500 + mit + " y", "Released  under THE MIT license!", changed, "no notice at all, released under nothing", "é " + license_scan.TEMPLATES["CC-BY-NC-4.0-line"]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {(r.doc_id, r.license): r for r in license_scan.scan_licenses(docs).collect()}
    assert set(got) == {(0, "MIT"), (1, "MIT-line"), (2, "MIT"), (4, "CC-BY-NC-4.0-line")}
    r = got[0, "MIT"]
    assert r.coverage == 1.0 and texts[0][r.start : r.end] == mit.rstrip(".") and len(r.spans) == 1
    assert 0.9 < got[2, "MIT"].coverage < 1 and len(got[2, "MIT"].spans) == 2
    assert texts[4][got[4, "CC-BY-NC-4.0-line"].start :].startswith("Licensed")
    assert license_scan.scan_licenses(awkward).count() == license_scan.scan_licenses(empty).count() == 0
    assert license_scan.scan_licenses(docs, {}).count() == 0


def test_every_copy_of_a_notice_is_found():
    template = "to any person the copies of this and the copies of that and the copies of all to any person without end"
    index = license_scan.Index({"notice": template})
    for gap in ("", "and the copies of ", "other words é in between "):
        text = (gap + template + " ") * 40
        got = index.scan(text.encode(), 0.75)
        assert [(n, c) for n, c, _, _ in got] == [("notice", 1.0)] * 40
        place = license_scan.code_points(text.encode(), (x for *_, spans in got for span in spans for x in span))
        assert {text[place[s[0][0]] : place[s[-1][1]]] for *_, s in got} == {template}


def test_license_lines_match_plain_search(spark):
    docs = queries.documents(spark, "/root/testdata/sf0.01")
    got = {(r.doc_id, r.license) for r in queries.op3_license_scan(spark, "/root/testdata/sf0.01").collect()}
    for name, text in license_scan.TEMPLATES.items():
        if name.endswith("-line"):
            want = {r.doc_id for r in docs.where(F.col("text").contains(text)).collect()}
            assert {d for d, n in got if n == name} == want


def test_every_license_line_has_a_row(spark):
    docs = queries.documents(spark, "/root/testdata/sf0.01")
    rows = queries.op3_license_scan(spark, "/root/testdata/sf0.01").collect()
    named = docs.where(F.col("text").rlike(r"(?i)\b(rights\s+reserved|licen[cs]ed?|copyright)\b"))
    assert {r.doc_id for r in named.collect()} == {r.doc_id for r in rows}
    got = Counter((r.doc_id, r.license) for r in rows)
    for r in docs.where(F.col("text").contains("All rights reserved.")).collect():
        assert got[r.doc_id, "All-rights-reserved-line"] == r.text.count("All rights reserved.")


def test_licenses_are_told_from_their_relatives():
    index = license_scan.Index(license_scan.TEMPLATES, license_scan.REQUIRED)
    for name, text in license_scan.TEMPLATES.items():
        assert [(n, c) for n, c, *_ in index.scan(f"Some words before. {text} Others after.".encode(), 0.75)] == [(name, 1.0)]
    for text, want in {
        "This work is licensed under the GNU Lesser General Public License, version 3.": ["LGPL-3.0-line"],
        "licensed under the GNU Lesser General Public License, version 2.1": ["LGPL-2.1-line"],
        "Licensed under the Apache License, Version 1.1.": ["Apache-1.1-line"],
        "Released under the Apache License, Version 2.0.": ["Apache-2.0-line"],
        "Distributed under the MIT license": ["MIT-line"],
        "Released under the Imagined License.": [],
        "Licensed under the Imagined License, Version 2.0.": [],
        "Licensed under CC BY-NC 5.0.": [],
        "Licensed under CC BY 4.0. All rights reserved. Licensed under CC BY-SA 4.0.": ["CC-BY-4.0-line", "All-rights-reserved-line", "CC-BY-SA-4.0-line"],
        "This work is licensed under the GNU Imagined General Public License, version 3.": [],
    }.items():
        assert [n for n, *_ in index.scan(text.encode(), 0.75)] == want


# --- pieces


def _k_best(pieces, s, n):
    best = [[(0.0, ())]] + [[] for _ in s]
    into = defaultdict(list)
    for i, j, p, score in pieces.edges(s):
        into[j].append((i, p, score))
    for j in range(1, len(s) + 1):
        every = [(t + score, path + tuple(pieces.ids_at(s, i, p))) for i, p, score in into[j] for t, path in best[i]]
        best[j] = sorted(every, key=lambda x: -x[0])[:n]
    return best[-1]


def test_n_best_matches_brute_force(sample):
    pieces = piece_lattice.Pieces(public.path("piece_bpe_32k.model"))
    texts = [t[:300] for _, t in sample[:40]] + ["", "a", " ", "  x ", "\n", "x\ny  z ", "é ₂ 𝔘 hello", "\t\ta\tb"]
    for text, found in zip(texts, pieces.encode_batch(texts, 4)):
        want = _k_best(pieces, "▁" + text.replace(" ", "▁"), 4) if text else []
        assert [s for s, _ in found] == [s for s, _ in want]
        assert len({tuple(ids) for _, ids in found}) == len(found)
        assert all(pieces.decode(ids.tolist()) == text for _, ids in found)


def test_encoding_awkward(awkward, empty):
    path = public.path("piece_bpe_32k.model")
    got = piece_lattice.encode_documents(awkward, path, with_ids=True).collect()
    assert len(got) == awkward.count() and all(r.round_trip for r in got)
    assert {(r.n_pieces, r.ids_crc32) for r in got if r.doc_id in (3, 4)} == {(0, 0)}
    assert all(r.scores == sorted(r.scores, reverse=True) for r in got)
    assert piece_lattice.encode_documents(empty, path).count() == 0


# --- packing


def test_plan_holds_all_pieces():
    rng = random.Random(5)
    for _ in range(150):
        capacity = rng.choice([10, 30, 100, 1024])
        histogram = Counter(rng.randint(1, capacity) for _ in range(rng.randrange(300)))
        used = Counter()
        for lengths, count in packing.plan_bins(histogram, capacity):
            assert sum(lengths) <= capacity and count > 0 and sum(3 * n > capacity for n in lengths) <= 2
            for n in lengths:
                used[n] += count
        assert used == histogram


def _assert_packed(rows, capacity=1024):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_round_trip(spark, sample):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rows = queries.op7_best_fit_packing(spark, SF).collect()
    used = _assert_packed(rows)
    assert used <= 1.03 * sum(r.length for r in rows) / 1024 + 1
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for doc, text in sample:
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for i, r in enumerate(sorted(pieces[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at) and (i == 0 or r.length == 1024)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_packing_awkward(spark, awkward, empty):
    v = queries.vocabulary()
    rows = packing.pack_documents(awkward, with_ids=True, **v).collect()
    _assert_packed(rows)
    assert [r.ids for r in rows if r.doc_id in (3, 4)] == [[2], [2]]
    assert packing.pack_documents(empty, **v).count() == 0
    special = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id bigint, text string")
    assert packing.pack_documents(special, with_ids=True, **v).first().ids == [64, 50256, 65, 2]
    few = packing.pack(packing.materialize(packing.token_pieces(awkward, **v), "t"), rows_per_group=2).collect()
    _assert_packed(few)


# --- languages


def test_language_accuracy_on_held_out(spark):
    docs = queries.documents(spark, "/root/testdata/sf0.01")
    model = language_id.fit_text_model(docs.where("doc_id % 2 = 0"), per_language=50)
    held = docs.where("doc_id % 2 = 1")
    got = language_id.identify(held, model).join(held.select("doc_id", F.col("lang").alias("truth")), "doc_id").collect()
    assert np.mean([r.lang == r.truth for r in got]) >= 0.98
    assert np.mean([r.accepted for r in got]) >= 0.99


def test_evidence_decides_where_text_does_not(spark, awkward, empty):
    model = language_id.fit_text_model(queries.documents(spark, "/root/testdata/sf0.01"))
    text = {r.lang: r.text for r in queries.documents(spark, "/root/testdata/sf0.01").where("n_chars > 500").collect()}
    rows = [(i, text["fr"], "http://a.site.example/fr/1", "fr") for i in range(40)] + [(i, text["de"], "http://b.site.example/de/1", "de") for i in range(40, 60)]
    rows += [(100, "", "http://a.site.example/x", None), (101, None, None, "de-AT"), (102, "12 34 %%", None, None), (103, None, "http://new.site.example/fr/2", None), (104, "zqxj vvkq wwxz kjqx zzxq " * 20, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, url string, lang string")
    parts = language_id.address_parts(F.col("url"))
    got = {r.doc_id: r for r in language_id.identify(docs, model, declared=language_id.language_code(F.col("lang")), **parts).collect()}
    assert [got[i].lang for i in (0, 50, 100, 101, 103)] == ["fr", "de", "fr", "de", "fr"]
    assert not got[102].accepted and got[102].lang == "und"
    assert got[104].lang == "und"
    assert language_id.identify(awkward, model).count() == awkward.count()
    assert language_id.identify(empty, language_id.fit_text_model(empty)).count() == 0


def test_page_evidence(spark):
    html = '<html lang="en"><script>x</script><body><nav>no</nav><article><p>yes <b>it</b></p><!-- c --></article>'
    row = spark.createDataFrame([(html, "https://www.A.example.co/fr?x"), (None, None)], "html string, url string")
    parts = language_id.address_parts(F.col("url"))
    one, none = row.select(F.trim(language_id.page_text(F.col("html"))).alias("t"), parts["host"].alias("h"), parts["parent"].alias("p"), parts["suffix"].alias("s")).collect()
    assert (one.t.split(), one.h, one.p, one.s) == (["yes", "it"], "www.a.example.co", "example.co", "fr")
    assert tuple(none) == (None, None, None, None)


def test_text_of_all_articles(spark):
    pages = {
        "no <article class='teaser'>das ist kurz</article> no <ARTICLE>this one is longer</article > no": "das ist kurz this one is longer",
        "no <article>outer <article>inner</article> <b>rest</b> of it</article> no <articles>no</articles>": "outer inner rest of it",
        "no <!-- <article>no</article> --><article>yes</article> no </article> no <article>open": "yes open",
        "<p>a page</p> <article></article>without": "a page without",
        "plain": "plain",
        "": "",
    }
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(pages)], "page_id bigint, html string").withColumn("text", language_id.page_text(F.col("html")))
    got = {r.html: " ".join(r.text.split()) for r in rows.collect()}
    assert got == pages
    docs = queries.documents(spark, "/root/testdata/sf0.01")
    model = language_id.fit_text_model(docs)
    en, de = (docs.where((F.col("lang") == x) & (F.length("text") > 600)).orderBy("doc_id").first() for x in model.languages[:2])
    both = f"<html><article>{en.text[:100]}</article><article>{de.text[:600]}</article></html>"
    page = spark.createDataFrame([(1, both)], "page_id bigint, html string").withColumn("text", language_id.page_text(F.col("html")))
    assert language_id.identify(page, model, "page_id").first().lang == de.lang


# --- the pipeline


def test_pipeline_stages(spark, empty):
    docs = queries.documents(spark, SF)
    twice = docs.withColumn("doc_id", F.col("doc_id") + 100_000)
    odd = spark.createDataFrame([(-1, "%% 12 ##", "en", "s", 9), (-2, None, None, None, None)], docs.schema)
    rows = docs.unionByName(twice).unionByName(odd)
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        last = name == corpus_pipeline.STAGES[-1][0]
        rows = stage(spark, rows, SF).cache()
        counts.append(rows.count())
        assert last or rows.columns == docs.columns
    assert counts[0] == 2 * docs.count()  # only the two odd rows go
    assert counts[1] < counts[0]  # second copies lose all their lines, but for short ones
    _assert_packed(rows.collect())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and order(set(r.doc_id for r in rows))
    _assert_packed(rows)
