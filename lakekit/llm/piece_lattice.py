"""SentencePiece encoding and decoding with exact N-best segmentation.

A text's segmentations are the paths of its piece lattice; a path's score is
the sum of its pieces' scores.  Forward Viterbi gives each position the score
of its best prefix; backward A-star search from the end uses these scores as
exact heuristics and so pops complete paths in order of score.

No piece spans the start of a run of spaces or a character that is in no
longer piece, so the lattice falls apart into segments there.  Forward and
backward scores of all distinct segments of a batch are computed together,
which gives each segment's best path and the loss of its second best.  The
``n`` best paths of a text deviate only in the ``n - 1`` segments with the least
loss, so A-star search runs on these alone.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import bounded_batches, mix64, runs_of, small, worker_cache

#: Stands for a space in pieces (fixed value).
SPACE = "▁"
#: Below the worst piece: score of a character that has no piece of its own.
UNKNOWN_LOSS = 10.0
_R = np.uint64(0xD6E8FEB86659FD93)


class Pieces:
    """The vocabulary: scores, a trie for whole batches, and the bytes that each id decodes to."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.bytes_of = [b""] * len(ids)
        self.byte_id: dict[int, int] = {}
        self.piece: dict[str, tuple[int, float]] = {}
        for i in ids:
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(text[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(text[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.piece[text] = (i, model.get_score(i))
                self.bytes_of[i] = text.replace(SPACE, " ").encode()
        usual = [s for _, s in self.piece.values() if s > -1e8]
        self.unknown = min(usual, default=0.0) - UNKNOWN_LOSS
        self.longest = max(map(len, self.piece), default=1)
        self.loose = not any(SPACE in p.lstrip(SPACE) for p in self.piece)  # may cut before a run of spaces
        inner = {c for p in self.piece if len(p) > 1 for c in p}
        self.alone = np.array(sorted({ord(c) for c in "\n\t\r"} - {ord(c) for c in inner}), np.uint32)
        # the trie: nodes by prefix, edges sorted by (node, character)
        node = {"": 0}
        for p in sorted(self.piece):
            for j in range(1, len(p) + 1):
                node.setdefault(p[:j], len(node))
        edges = sorted((node[p[:-1]] << 21 | ord(p[-1]), k) for p, k in node.items() if p)
        self.edge_key = np.array([e for e, _ in edges], np.int64)
        self.edge_to = np.array([k for _, k in edges], np.int64)
        self.node_id = np.full(len(node), -1, np.int64)
        self.node_score = np.zeros(len(node))
        for p, (i, s) in self.piece.items():
            self.node_id[node[p]], self.node_score[node[p]] = i, s

    # --- one text, one path at a time

    def edges(self, s: str):
        """``(start, end, id, score)`` of all pieces in ``s``; id -1 for a character without a piece."""
        for i in range(len(s)):
            for j in range(i + 1, min(len(s), i + self.longest) + 1):
                if (hit := self.piece.get(s[i:j])) is not None:
                    yield i, j, *hit
                elif j == i + 1:
                    yield i, j, -1, self.unknown

    def ids_at(self, s: str, start: int, piece: int) -> list[int]:
        return [piece] if piece >= 0 else [self.byte_id[b] for b in s[start].encode()]

    def n_best(self, s: str, n: int) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations of ``s`` (all, if there are fewer): forward Viterbi, backward A-star."""
        best = [0.0] + [-np.inf] * len(s)
        into: list[list] = [[] for _ in range(len(s) + 1)]
        for i, j, piece, score in self.edges(s):
            into[j].append((i, piece, score))
            best[j] = max(best[j], best[i] + score)
        found: list[tuple[float, list[int]]] = []
        # state: a path's end part; priority: its score plus the best score of what is before it
        heap: list = [(-best[len(s)], 0, len(s), 0.0, None)]
        made = 0
        while heap and len(found) < n:
            _, _, at, behind, path = heapq.heappop(heap)
            if at == 0:
                ids = []
                while path is not None:
                    ids += self.ids_at(s, path[0], path[1])
                    path = path[2]
                found.append((behind, ids))
                continue
            for i, piece, score in into[at]:
                made += 1
                heapq.heappush(heap, (-(best[i] + score + behind), made, i, score + behind, (i, piece, path)))
        return found

    # --- many segments of one length at once

    def _solve(self, chars: np.ndarray):
        """Best path and loss of the second best for each row of characters.

        Returns scores, losses, and pieces and starts of the best path by end
        position (-2 where no piece ends).
        """
        k, length = chars.shape
        alpha = np.full((k, length + 1), -np.inf)
        alpha[:, 0] = 0
        back = np.full((k, length + 1), -1, np.int32)
        made = np.full((k, length + 1), -1, np.int32)
        edges = []
        for i in range(length):
            rows, node = np.arange(k), np.zeros(k, np.int64)
            for j in range(i, min(length, i + self.longest)):
                key = (node << 21) | chars[rows, j]
                at = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
                hit = self.edge_key[at] == key
                rows, node = rows[hit], self.edge_to[at[hit]]
                ends = self.node_id[node] >= 0
                r, p, s = rows[ends], self.node_id[node[ends]], self.node_score[node[ends]]
                if j == i and len(r) < k:  # characters without a piece
                    none = np.ones(k, bool)
                    none[r] = False
                    none = np.flatnonzero(none)
                    r, p, s = np.concatenate([r, none]), np.concatenate([p, np.full(len(none), -1)]), np.concatenate([s, np.full(len(none), self.unknown)])
                if len(r):
                    edges.append((i, j + 1, r, p, s))
                    score = alpha[r, i] + s
                    more = score > alpha[r, j + 1]
                    r, p = r[more], p[more]
                    alpha[r, j + 1], back[r, j + 1], made[r, j + 1] = score[more], i, p
                if not len(rows):
                    break
        beta = np.full((k, length + 1), -np.inf)
        beta[:, length] = 0
        for i, j, r, _, s in reversed(edges):  # edges are in order of their start
            beta[r, i] = np.maximum(beta[r, i], beta[r, j] + s)
        piece, start = np.full((k, length + 1), -2, np.int32), np.zeros((k, length + 1), np.int32)
        at = np.full(k, length)
        rows = np.arange(k)
        while len(rows):
            piece[rows, at], start[rows, at] = made[rows, at], back[rows, at]
            at = back[rows, at]
            rows, at = rows[at > 0], at[at > 0]
        second = np.full(k, -np.inf)
        for i, j, r, p, s in edges:
            off = ~((piece[r, j] == p) & (start[r, j] == i))
            through = (alpha[r, i] + s + beta[r, j])[off]
            second[r[off]] = np.maximum(second[r[off]], through)
        return alpha[:, length], alpha[:, length] - second, piece, start

    def encode_batch(self, texts: list[str], n: int) -> list[list[tuple[float, np.ndarray]]]:
        """The ``n`` best ``(score, ids)`` of each text, best first; an empty text has none."""
        marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(codes):
            return [[] for _ in texts]
        sizes = np.array([len(m) for m in marked])
        heads = np.cumsum(sizes) - sizes
        cut = np.zeros(len(codes), bool)
        cut[heads[sizes > 0]] = True
        space = codes == ord(SPACE)
        if self.loose:
            cut[1:] |= space[1:] & ~space[:-1]
        single = np.isin(codes, self.alone)
        cut |= single
        cut[1:] |= single[:-1]
        at = np.flatnonzero(cut)
        length = np.diff(np.append(at, len(codes)))
        # distinct segments, by hash and length
        power = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(int(length.max()) - 1, _R, np.uint64)]))
        place = np.arange(len(codes)) - np.repeat(at, length)
        key = mix64(np.add.reduceat(mix64(codes.astype(np.uint64)) * power[place], at) + length.astype(np.uint64))
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        score, loss = np.empty(len(first)), np.empty(len(first))
        ids: list = [None] * len(first)
        size = np.empty(len(first), np.int64)
        by_length = np.argsort(length[first], kind="stable")
        bounds = np.flatnonzero(np.append(True, np.diff(length[first][by_length]) != 0))
        for lo, hi in zip(bounds, np.append(bounds[1:], len(by_length))):
            every, m = by_length[lo:hi], int(length[first[by_length[lo]]])
            step = max(1, 2_000_000 // (m + 1))
            for x in range(0, len(every), step):
                rows = every[x : x + step]
                chars = codes[at[first[rows]][:, None] + np.arange(m)].astype(np.int64)
                score[rows], loss[rows], piece, start = self._solve(chars)
                unknown = np.flatnonzero((piece == -1).any(axis=1))
                flat, count = piece[piece >= 0], (piece >= 0).sum(axis=1)
                parts = np.split(flat, np.cumsum(count)[:-1])
                for r, part in zip(rows.tolist(), parts):
                    ids[r] = part
                for q in unknown.tolist():
                    ends = np.flatnonzero(piece[q] != -2)
                    text = "".join(map(chr, chars[q]))
                    ids[rows[q]] = np.array([i for e in ends.tolist() for i in self.ids_at(text, int(start[q, e]), int(piece[q, e]))], np.int32)
                size[rows] = [len(ids[r]) for r in rows.tolist()]
        flat = np.concatenate(ids).astype(np.int32)
        base = np.cumsum(size) - size
        out, owner = [], np.searchsorted(at, heads)
        owner = np.append(owner, len(at))
        known: dict = {}
        for d in range(len(texts)):
            if not sizes[d]:
                out.append([])
                continue
            segments = which[owner[d] : owner[d + 1]]
            count = size[segments]
            shift = np.repeat(base[segments] - (np.cumsum(count) - count), count)
            best = flat[shift + np.arange(len(shift))]
            total = float(score[segments].sum())
            if n == 1:
                out.append([(total, best)])
                continue
            few = min(n - 1, len(segments))
            least = np.argpartition(loss[segments], few - 1)[:few]
            least = sorted((p for p in least.tolist() if np.isfinite(loss[segments[p]])))
            paths: list[tuple[float, tuple]] = [(total, ())]
            for p in least:
                seg = int(segments[p])
                if (seg, n) not in known:
                    f = at[first[seg]]
                    known[seg, n] = self.n_best("".join(map(chr, codes[f : f + length[first[seg]]])), n)
                top = known[seg, n][0][0]
                grown = [(t + s - top, c + (((p, i),) if i else ())) for t, c in paths for i, (s, _) in enumerate(known[seg, n])]
                paths = heapq.nlargest(n, grown, key=lambda x: x[0])
            ends = np.cumsum(count)
            found = []
            for t, changes in paths:
                parts, done = [], 0
                for p, i in changes:
                    parts += [best[done : ends[p] - count[p]], np.array(known[int(segments[p]), n][i][1], np.int32)]
                    done = ends[p]
                found.append((t, np.concatenate([*parts, best[done:]]) if changes else best))
            out.append(found)
        return out

    def decode(self, ids) -> str:
        """The text of ids: pieces and bytes joined, without the space put before the text."""
        data = b"".join(map(self.bytes_of.__getitem__, ids))
        return data.decode("utf-8", "replace")[1:] if data[:1] == b" " else data.decode("utf-8", "replace")


def pieces_of(path: str) -> Pieces:
    """The vocabulary, read once in a worker's life."""
    cache = worker_cache()
    if ("pieces", path) not in cache:
        cache["pieces", path] = Pieces(path)
    return cache["pieces", path]


def encode_documents(
    docs: DataFrame,
    model_path: str,
    n: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    batch_chars: int = 2 << 20,
) -> DataFrame:
    """``(id_col, n_pieces, ids_crc32, scores, nbest_crc32, round_trip[, nbest_ids])``, one row per input row.

    ``scores`` are those of the ``n`` best segmentations, best first, and
    ``nbest_crc32`` the checksums of their ids (little-endian 32-bit);
    ``n_pieces`` and ``ids_crc32`` are the best one's.  ``round_trip`` tells
    whether the best ids decode to the text (a text that holds the space
    mark U+2581 itself decodes with spaces there).

    Null and empty texts have no pieces, checksum 0 and empty lists.  Equal
    scores come in a fixed order for equal texts.  Null ids and repeated rows are
    kept, extra columns are not read.
    """
    bounded_batches(docs)
    schema = f"`{id_col}` bigint, n_pieces bigint, ids_crc32 bigint, scores array<double>, nbest_crc32 array<bigint>, round_trip boolean"
    types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.bool_()]
    if with_ids:
        schema, types = schema + ", nbest_ids array<array<int>>", [*types, pa.list_(pa.list_(pa.int32()))]
    names = [id_col, "n_pieces", "ids_crc32", "scores", "nbest_crc32", "round_trip"] + ["nbest_ids"] * with_ids

    def run(batches):
        pieces = pieces_of(model_path)
        for batch in small(batches):
            docs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in runs_of([len(t) + 1 for t in texts], batch_chars):
                rows = []
                for doc, text, found in zip(docs[lo:hi], texts[lo:hi], pieces.encode_batch(texts[lo:hi], n)):
                    sums = [zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in found]
                    best = found[0][1].tolist() if found else []
                    row = (doc, len(best), sums[0] if sums else 0, [s for s, _ in found], sums, pieces.decode(best) == text)
                    rows.append(row + (([ids.tolist() for _, ids in found],) if with_ids else ()))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(run, schema)
