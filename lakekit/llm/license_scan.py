"""License scans: winnowed fingerprints pick candidates, banded alignment reports coverage and spans.

Templates are cut into words; the hashes of their word runs are winnowed (the
least hash of each window of runs is kept) into an inverted index.  A
document's runs are winnowed alike, looked up, and hits on nearby diagonals of
(document word, template word) form a candidate.  Each candidate is aligned
with its template in a band around its diagonals.  Short templates are looked
up by all their runs.  Of alignments with the same words the best one counts.

The index is as large as the templates, not the documents, and goes with the
tasks' code.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import bounded_batches, bytes_of, grams_of, small, words_of
from lakekit.llm.license_templates import REQUIRED, TEMPLATES

#: Words in a run, and runs in a window: any common stretch of 5 words gives a hit.
RUN, WINDOW = 3, 3
#: Templates of at most so many words have all their runs in the index, so any common run gives a hit.
SHORT = 32


def winnowed(words: np.ndarray, run: int = RUN, window: int = WINDOW) -> np.ndarray:
    """Places of the runs kept: the last least hash of each window (of all runs, where they are fewer)."""
    hashes = grams_of(words, run)
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    return np.unique(np.arange(window - 1, len(hashes)) - views.argmin(axis=1))


def align(doc: np.ndarray, template: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """Matched ``(document word, template word)`` pairs of the best alignment on diagonals ``low..high``.

    A match gains 2, a word left out on either side costs 1; the alignment is
    local in the document and in the template.
    """
    best, where = 0, None
    above: dict[int, int] = {}
    trace: dict[tuple[int, int], int] = {}
    for t in range(len(template)):
        row: dict[int, int] = {}
        for d in range(max(0, t + low), min(len(doc), t + high + 1)):
            steps = (0, above.get(d - 1, 0) + 2 if doc[d] == template[t] else -1, above.get(d, 0) - 1, row.get(d - 1, 0) - 1)
            step = max(range(4), key=lambda i: (steps[i], -i))
            if steps[step] > 0:
                row[d], trace[t, d] = steps[step], step
                if steps[step] > best:
                    best, where = steps[step], (t, d)
        above = row
    pairs = []
    while where in trace:
        t, d = where
        step = trace[where]
        if step == 1:
            pairs.append((d, t))
        where = (t - (step in (1, 2)), d - (step in (1, 3)))
    return pairs[::-1]


def search(words: np.ndarray, template: np.ndarray, hits: list[tuple[int, int]], begin: int, end: int, band: int, least: float) -> list[list[tuple[int, int]]]:
    """Alignments in the words ``begin..end`` near hits ``(diagonal, word)``, none overlapping another, in order.

    The best one is taken first; what lies before and after it is searched on.
    """
    hits = [h for h in hits if begin <= h[1] < end]
    if not hits:
        return []
    low, high = min(hits)[0] - band, max(hits)[0] + band
    begin, end = max(begin, low), min(end, high + len(template))
    pairs = [(begin + d, t) for d, t in align(words[begin:end], template, low - begin, high - begin)]
    if len(pairs) < least * len(template):
        return []
    before = search(words, template, hits, begin, pairs[0][0], band, least)
    return [*before, pairs, *search(words, template, hits, pairs[-1][0] + 1, end, band, least)]


def notices(words: np.ndarray, template: np.ndarray, hits: list[tuple[int, int]], least: float):
    """The alignments of one template with a document, from all its hits ``(diagonal, word)``.

    Hits on nearby diagonals are met together.  A chain of them that is much
    longer than the template is met in windows that overlap by half, so the
    work follows the number of hits.
    """
    hits, n, band = sorted(hits), len(template), max(4, len(template) // 8)
    diagonal = [g for g, _ in hits]
    i = done = 0
    while i < len(hits):
        until = bisect_left(diagonal, diagonal[i] + 2 * n + 1)
        cut = next((j for j in range(i + 1, until) if diagonal[j] - diagonal[j - 1] > band), until)
        chained = cut == until < len(hits) and diagonal[until] - diagonal[until - 1] <= band
        for pairs in search(words, template, hits[i:cut], done, len(words), band, least):
            # one that starts in a window's second half lies whole in the next
            if not chained or pairs[0][0] - pairs[0][1] < diagonal[i] + n:
                yield pairs
                done = max(done, pairs[-1][0] + 1)
        i = max(i + 1, bisect_left(diagonal, diagonal[i] + n)) if chained else cut


def code_points(text: bytes, offsets) -> dict[int, int]:
    """Number of code points before each byte offset."""
    buf, out, at, n = np.frombuffer(text, np.uint8), {}, 0, 0
    for o in sorted(set(offsets)):
        n, at = n + int(np.count_nonzero((buf[at:o] & 0xC0) != 0x80)), o
        out[o] = n
    return out


class Runs:
    """Hashes of word runs, with the template and the place of each."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        rows = sorted(rows)
        self.hashes = np.array([r[0] for r in rows], np.uint64)
        self.owner = [r[1] for r in rows]
        self.place = [r[2] for r in rows]

    def hits(self, hashes: np.ndarray, places: np.ndarray):
        """``(template, diagonal, word)`` of the document's runs found here."""
        if not len(self.hashes) or not len(hashes):
            return
        lo = np.searchsorted(self.hashes, hashes)
        found = np.flatnonzero(self.hashes[np.minimum(lo, len(self.hashes) - 1)] == hashes)
        hi = np.searchsorted(self.hashes, hashes[found], "right")
        for p, a, b in zip(places[found].tolist(), lo[found].tolist(), hi.tolist()):
            for r in range(a, b):
                yield self.owner[r], p - self.place[r], p


def _phrase(words: np.ndarray, phrase: str) -> range:
    """The places of a phrase in a template."""
    want = words_of(phrase.encode(), alnum=True)[0]
    n = len(want)
    for i in range(len(words) - n + 1):
        if n and (words[i : i + n] == want).all():
            return range(i, i + n)
    raise ValueError(f"not in the template: {phrase!r}")


class Index:
    """The inverted index of the templates' winnowed runs, and of all runs of the short ones."""

    def __init__(self, templates: dict[str, str], required: dict[str, tuple[str, ...]] | None = None):
        self.names = sorted(templates)
        self.words = [words_of(templates[n].encode(), alnum=True)[0] for n in self.names]
        self.required = [[_phrase(w, p) for p in (required or {}).get(n, ())] for n, w in zip(self.names, self.words)]
        self.needs = [{int(w[t]) for places in phrases for t in places} for w, phrases in zip(self.words, self.required)]
        kept, every = [], []
        for i, w in enumerate(self.words):
            hashes = grams_of(w, RUN)
            if len(w) > SHORT:
                kept += [(int(hashes[p]), i, int(p)) for p in winnowed(w)]
            else:
                every += [(int(h), i, p) for p, h in enumerate(hashes)]
        self.kept, self.every = Runs(kept), Runs(every)

    def named(self, owner: int, pairs: list[tuple[int, int]]) -> bool:
        """Whether the template's required phrases are matched without a gap."""
        at = {t: d for d, t in pairs}
        return all(at.get(t, -1) - at.get(places[0], -1) == t - places[0] and t in at for places in self.required[owner] for t in places)

    def scan(self, text: bytes, min_coverage: float):
        """``(name, coverage, matched words, [(start, end) bytes])`` of each notice found."""
        words, starts, ends = words_of(text, alnum=True)
        hashes = grams_of(words, RUN)
        kept = winnowed(words)
        hits: dict[int, list[tuple[int, int]]] = {}
        for runs, places in ((self.kept, kept), (self.every, np.arange(len(hashes)))):
            for owner, diagonal, p in runs.hits(hashes[places], places):
                hits.setdefault(owner, []).append((diagonal, p))
        if not hits:
            return []
        there = set(words.tolist())
        found = []
        for owner, places in hits.items():
            template = self.words[owner]
            if not self.needs[owner] <= there:
                continue
            for pairs in notices(words, template, places, min_coverage):
                if self.named(owner, pairs):
                    # matches, less the words left out on either side
                    score = 4 * len(pairs) - len(template) - (pairs[-1][0] - pairs[0][0] + 1)
                    found.append((-score, -len(pairs) / len(template), self.names[owner], owner, pairs))
        out, taken = [], set()
        for *_, owner, pairs in sorted(found):
            # one with most of its words in a better one is a relative of that
            if 2 * sum(d in taken for d, _ in pairs) > len(pairs):
                continue
            taken.update(d for d, _ in pairs)
            spans: list[list[int]] = []
            for n, (d, t) in enumerate(pairs):
                if n and d == pairs[n - 1][0] + 1 and t == pairs[n - 1][1] + 1:
                    spans[-1][1] = int(ends[d])
                else:
                    spans.append([int(starts[d]), int(ends[d])])
            out.append((self.names[owner], len(pairs) / len(self.words[owner]), len(pairs), spans))
        return sorted(out, key=lambda x: (x[3][0][0], x[0]))


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_coverage: float = 0.75,
    required: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """One row per notice found: ``id_col, license, coverage, matched_words, start, end, spans``.

    ``coverage`` is the share of the template's words that are matched in
    order; ``start`` and ``end`` are code points, as are ``spans``, the
    stretches without a gap on either side.  Words are ASCII letters (A-Z
    lower-cased), digits and non-ASCII characters; all else separates.

    ``required`` lists phrases of a template that must be matched without a
    gap, as a version; the given templates come with theirs.  Where templates
    match the same words, the one with the most matches, less the words left
    out on either side, gives the row.

    Null and empty texts have no notices.  A notice that occurs several times
    gives several rows; one text may hold several notices.  Null ids and
    repeated rows are kept, extra columns are not read; without templates
    there are no rows.  Templates of fewer than ``RUN`` words match as a whole.
    """
    bounded_batches(docs)
    index = Index(TEMPLATES, REQUIRED if required is None else required) if templates is None else Index(templates, required)
    schema = f"`{id_col}` bigint, license string, coverage double, matched_words bigint, start bigint, end bigint, spans array<array<bigint>>"
    types = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64()))]
    names = [id_col, "license", "coverage", "matched_words", "start", "end", "spans"]

    def run(batches):
        for batch in small(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1))):
                found = index.scan(text, min_coverage)
                place = code_points(text, (x for *_, spans in found for span in spans for x in span))
                for name, coverage, matched, spans in found:
                    spans = [[place[a], place[b]] for a, b in spans]
                    rows.append((doc, name, coverage, matched, spans[0][0], spans[-1][1], spans))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 7, types)], names)

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(run, schema)
