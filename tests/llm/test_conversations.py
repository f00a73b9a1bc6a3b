"""Conversation prefix trie, source mix and structure repair."""

import hashlib
import heapq
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakekit.llm import prefix_trie, queries, source_mix, structure_repair

SF = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string"

# --- structure repair


def _moves(initial, fault):
    stays = fault not in (structure_repair.BLANK, structure_repair.DUPLICATE)
    more = 5 * (fault == structure_repair.TRUNCATED)
    return [("D", 2, "")] + stays * [("K", more, initial), ("R", 1 + more, "u"), ("R", 1 + more, "a")]


def _every_repair(turns):
    """(cost, audit) by trying all edits with up to two inserts in each gap."""
    inserts = [[("I", 5, c) for c in p] for n in range(3) for p in itertools.product("ua", repeat=n)]
    gaps = [inserts, *itertools.chain.from_iterable(([[m] for m in _moves(*t)], inserts) for t in turns)]
    found = []
    for choice in itertools.product(*gaps):
        edits = list(itertools.chain.from_iterable(choice))
        if re.fullmatch("(s?(ua)+)?", "".join(e[2] for e in edits)):
            found.append((sum(e[1] for e in edits), "".join(e[0] for e in edits)))
    return min(found)


def _searched_repair(turns):
    """(cost, audit) by uniform-cost search over (turns done, last role)."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "")], set()
    while True:
        cost, audit, i, last = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(turns) and last in ("", "a"):
            return cost, audit
        moves = [("I", 5, c, i) for c in "ua"] + [(*m, i + 1) for m in (_moves(*turns[i]) if i < len(turns) else [])]
        for edit, price, role, j in moves:
            if not role or role in follow[last] and edit != "I" or edit == "I" and role in follow[last]:
                heapq.heappush(heap, (cost + price, audit + edit, j, role or last))


def _parsed(turns):
    settled = []
    parser = structure_repair.Parser(settled.append)
    for initial, fault in turns:
        parser.take(initial, fault)
    cost = parser.finish()
    return cost, "".join(settled)


def test_repairs_are_cheapest():
    rng = random.Random(3)
    for n in (0, 1, 2, 2, 2):
        for _ in range(6):
            turns = [(rng.choice("suat"), rng.choice([0, 0, 1, 2, 3])) for _ in range(n)]
            assert _parsed(turns) == _searched_repair(turns) == _every_repair(turns)
    for _ in range(400):
        turns = [(rng.choice("suuaat "), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(12))]
        assert _parsed(turns) == _searched_repair(turns)
    for _ in range(5):
        turns = [("ua"[i % 2] if rng.random() < 0.9 else "s", rng.choice([0] * 9 + [1, 3])) for i in range(1000)]
        assert _parsed(turns) == _searched_repair(turns)


def test_settled_edits_leave_few_open():
    rng = random.Random(8)
    parser, most = structure_repair.Parser(lambda edits: None), 0
    for i in range(20_000):
        parser.take(rng.choice("ua") if rng.random() < 0.2 else "ua"[i % 2], rng.choice([0] * 9 + [1, 2, 3]))
        most = max(most, max(len(t[1]) for t in parser.tops.values()))
    assert most < 500 and len(parser.tops) <= 5


AWKWARD = [
    (1, 0, "system", "Be brief."),
    (1, 1, "user", "Hi."),
    (1, 1, "user", "Hi."),
    (1, 3, None, "No role."),
    (1, None, "user", "First of all."),
    (2, None, None, None),
    (2, None, "", ""),
    (3, 0, "user", "cut off"),
    (3, 5, "assistant", "done! \n\t"),
    (3, 5, "assistant", " \x0b\f\r"),
    (4, -2, "usher", "x" * 100_000 + "?"),
    (4, 2, "admin", "é漢."),
    (None, 1, "user", "No conversation."),
]


def test_repair_of_awkward_turns(spark, empty):
    rows = [(*r, 7, 8, "x", False) for r in AWKWARD] + [(5, 1, "user", "gone", 7, 8, "x", True)]
    turns = spark.createDataFrame(rows, TURNS + ", conv int, fault int, again string, gone boolean")
    got = {r.conv_id: r for r in structure_repair.repair_conversations(turns, gone_col="gone").collect()}
    assert got[1][1:8] == (1, 0, 1, 0, 4, 7, "DKKDIK") or (got[1].gaps, got[1].duplicate) == (1, 1)
    assert (got[2].blank, got[2].audit, got[2].gaps) == (2, "DD", 0)
    assert (got[3].gaps, got[3].blank, got[3].truncated, got[3].audit) == (4, 1, 1, "DDD")
    assert (got[4].gaps, got[4].illegal, got[4].cost, got[4].audit) == (3, 0, 0, "KK")
    assert got[4].repaired_sha256 == hashlib.sha256(f"usher:{'x' * 100_000}?\nadmin:é漢.".encode()).hexdigest()
    assert (got[None].audit, got[None].cost) == ("D", 2)
    assert got[5][1:8] == (0, 0, 0, 0, 0, 0, "") and got[5].repaired_sha256 == hashlib.sha256().hexdigest()
    whole = structure_repair.repair_conversations(turns).collect()
    assert {r.conv_id: r.audit for r in whole}[5] == "D"
    again = structure_repair.repair_conversations(turns.orderBy(F.rand(1)), gone_col="gone").collect()
    assert sorted(again, key=str) == sorted(got.values(), key=str)
    assert structure_repair.repair_conversations(turns.where("false")).count() == 0


def test_repaired_turns_follow_the_grammar(spark):
    turns = queries.damaged_conversations(spark.read.parquet(f"{SF}/conversations.parquet"))
    lines = defaultdict(list)
    for r in structure_repair.repaired_turns(turns, gone_col="gone").orderBy("conv_id", "place").collect():
        lines[r.conv_id].append(r)
    for r in structure_repair.repair_conversations(turns, gone_col="gone").collect():
        mine = lines[r.conv_id]
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[0] for x in mine))
        assert [x.place for x in mine] == list(range(len(mine))) and "".join(x.edit for x in mine) == r.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in mine).encode()).hexdigest() == r.repaired_sha256


# --- prefix trie


def _trie(sequences, sizes):
    """All nodes of {conversation: sequence} by brute force."""
    members = defaultdict(list)
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    out = []
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in convs if sequences[c] == p)))
        saved = sum((len(members[q]) - 1) * (sizes[q[-1]] if q else 0) for q in below)
        leaves = sum(1 for q in below if not kids[q])
        up = min(members[p[:-1]]) if p else None
        out.append((min(convs), len(p), up, len(convs), kids[p], leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("per_tree,per_piece", [(3, 2), (40, 4096)])
def test_trie_matches_brute_force(spark, per_tree, per_piece):
    rng = random.Random(per_tree)
    sizes = {i: rng.randrange(5) for i in range(4)}
    seqs = {c: tuple(rng.choice([0, 0, 1, 2, 3]) for _ in range(rng.randrange(7))) for c in range(90)}
    seqs |= {c: (0, 0, 1, 3) for c in range(100, 130)} | {500: (1,) * 60}
    rows = [(c, list(s), [sizes[x] for x in s]) for c, s in seqs.items()]
    df = spark.createDataFrame(rows, "conv bigint, seq array<bigint>, sizes array<bigint>")
    got = prefix_trie.prefix_trie(df, ids_per_tree=per_tree, convs_per_piece=per_piece).collect()
    assert sorted(map(tuple, got), key=str) == _trie(seqs, sizes)


def test_medians_balance_the_trees():
    tree = prefix_trie.TernaryTree()
    for i in prefix_trie.medians(1000):
        tree.insert((i,))

    def height(node):
        return 0 if not node else 1 + max(height(tree.less[node]), height(tree.more[node]))

    assert sorted(prefix_trie.medians(1000)) == list(range(1000)) and height(tree.equal[0]) == 10
    assert sorted(tree.symbol[n] for n in tree.top_down()) == list(range(1000))


def test_trie_of_awkward_turns(spark):
    turns = spark.createDataFrame([(*r, 1, "x") for r in AWKWARD], TURNS + ", digest int, id string")
    seqs = {r.conv: r for r in prefix_trie.turn_sequences(turns).collect()}
    assert set(seqs) == {1, 2, 3, 4} and seqs[1].sizes == [13, 9, 3, 3, 8] and seqs[1].seq[2] == seqs[1].seq[3]
    assert seqs[4].sizes == [100_001, 6] and seqs[2].seq[0] == seqs[2].seq[1] and seqs[2].sizes == [0, 0]
    root = prefix_trie.prefix_trie(queries.rebuilt_conversations(turns)).where("depth = 0").first()
    assert (root.conv_id, root.parent_conv_id, root.n_convs) == (1, None, 4)
    assert prefix_trie.prefix_trie(prefix_trie.turn_sequences(turns.where("false"))).count() == 0


# --- source mix


def _targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by resharing the excess round after round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, free, rest = dict.fromkeys(order, 0.0), list(order), share * sum(sizes.values())
    while free and rest > 1e-9:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += rest * weight[s] / total
        rest = sum(max(0.0, target[s] - most * sizes[s]) for s in order)
        target = {s: min(target[s], most * sizes[s]) for s in order}
        free = [s for s in free if target[s] < most * sizes[s]]
    return target


@pytest.fixture(scope="module")
def sourced(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(rng.randrange(60))), rng.choice(["a", "a", "a", "b", "Z", "é", "", None, "few"] if i % 50 == 0 else ["a", "b", "Z", "é", None])) for i in range(400)]
    rows += [(7, "one of two texts of an id", "a"), (7, "one of two texts of an id", "a"), (None, "no id \t\n here", "b"), (None, None, "nothing"), (900, " \x0b ", "b")]
    rows.append((901, "long " * 30_000, "Z"))
    return rows, spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, source string, size int, number int")


def test_mix_meets_targets(spark, sourced):
    rows, docs = sourced
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by_source = Counter()
    for _, text, source in rows:
        by_source[source] += size(text)
    targets = _targets(by_source)
    got = source_mix.taken_words(docs, block=16, shard_slots=32).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, size(t)) for i, t, _ in rows)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    taken, figures = Counter(), {}
    for r in got:
        figures[r.source_size, round(r.target, 3)] = r
        taken[r.source_size, round(r.target, 3)] += r.taken
    want = {(by_source[s], round(t, 3)): t for s, t in targets.items()}
    assert set(figures) == set(want)
    for key, t in want.items():
        same = [s for s in targets if (by_source[s], round(targets[s], 3)) == key]
        assert abs(taken[key] - t * len(same)) <= len(same)
    again = source_mix.taken_words(docs.repartition(5, "text"), block=16, shard_slots=32).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mix_is_made_of_whole_slots(spark, sourced):
    rows, docs = sourced
    parts = source_mix.mix_sources(docs, block=16, shard_slots=32, with_text=True).collect()
    texts = defaultdict(set)
    for i, t, _ in rows:
        texts[i].add(tuple(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
    slots = defaultdict(list)
    for p in parts:
        assert p.shard == p.slot // 32
        assert any(w[p.first_word : p.first_word + p.n_words] == tuple(p.text.split(" ")) for w in texts[p.doc_id])
        slots[p.slot].append(p)
    assert set(slots) == set(range(len(slots)))
    short = 0
    for mine in slots.values():
        places = sorted((p.place, p.n_words) for p in mine)
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))
        short += sum(n for _, n in places) < 16
    assert short <= 5 * 9  # last blocks and last slots of nine sources
    shares = [Counter(p.doc_id == 901 for p in parts if p.shard == s) for s in range(3)]
    assert len({tuple(sorted(x.items())) for x in shares}) > 1  # drawn, not dealt in turn


def test_mix_of_nothing(spark, empty):
    assert source_mix.taken_words(empty).count() == source_mix.mix_sources(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id bigint, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in source_mix.taken_words(blank).collect()] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97])
def test_permutations(spark, n):
    df = spark.range(n).select("id", *[source_mix.permuted(F.col("id"), F.lit(n), F.lit(k)).alias(f"p{k}") for k in (1, 2)])
    got = df.collect()
    assert sorted(r.p1 for r in got) == sorted(r.p2 for r in got) == list(range(n))
    if n > 10:
        assert [r.p1 for r in got] != [r.p2 for r in got] and sum(r.p1 == r.id for r in got) < n / 4
