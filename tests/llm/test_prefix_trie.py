"""The prefix trie against plain dictionaries, its parentheses against a stack."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sparktide.llm import prefix_trie


def plain_trie(rows, shared, family=100):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
        given[conv].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in given.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in turns.items():
        h = 0 if c is None or not shared else zlib.crc32(str(c).encode()) % shared
        base = [] if h == 0 else turns.get(c - int(np.fmod(c, family)), [])
        path = tuple(base[:h] + own[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    saved = {p: (len(m) - 1) * len(p[-1][1]) if p else 0 for p, m in members.items()}
    least = {p: min(m, key=lambda c: (c is not None, c or 0)) for p, m in members.items()}
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below) for q in below)
        ids = sorted(ends.get(p, []), key=lambda c: (c is not None, c or 0))
        joined = ",".join("" if c is None else str(c) for c in ids)
        out.append(
            (least[p], len(p), least[p[:-1]] if p else None, len(m), len(kids), leaves, sum(saved[q] for q in below), hashlib.sha256(joined.encode()).hexdigest())
        )
    return sorted(out, key=str)


def found_trie(spark, rows, shared=6):
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, depth string")
    nodes = prefix_trie.prefix_trie(*prefix_trie.sequences(prefix_trie.turns_of(frame), shared))
    return sorted([tuple(r) for r in nodes.collect()], key=str)


def _conversations():
    rng, rows = random.Random(8), []
    for conv in [*range(0, 120), *range(395, 412)]:
        text = [rng.choice("ab") for _ in range(rng.randint(0, 7))]
        rows += [(conv, t, "user" if t % 2 else "assistant", f"{x}{t % 3}é") for t, x in enumerate(text)]
    # One long conversation, an equal one and one that parts from them; copies of a short one.
    for conv in (700, 701, 702):
        rows += [(conv, t, "user", f"long {t}" if t < 50 or conv < 702 else f"other {t}") for t in range(90)]
    rows += [(conv, 0, "user", "same") for conv in range(800, 840)]
    odd = [(None, 1, "user", "x"), (None, None, None, None), (900, 1, None, "b"), (900, 1, "user", None), (900, None, "user", "a"), (900, 1, None, "b")]
    rows += odd + [(-5, 0, "user", "same"), (901, 0, "user", "<" * 300_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shared,shard", [(6, 4), (0, 30), (6, 2_048)])
def test_nodes_are_those_of_dictionaries(spark, monkeypatch, shared, shard):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard)
    monkeypatch.setattr(prefix_trie, "SLICE_TURNS", 1_024 if shard == 30 else 7)
    monkeypatch.setattr(prefix_trie, "JOINED_IDS", 3)
    rows = _conversations()
    assert found_trie(spark, rows, shared) == plain_trie(rows, shared)


def test_no_conversations(spark):
    assert found_trie(spark, []) == []


def test_conversations_without_turns_end_at_the_root(spark):
    """Conversations whose own turns are all replaced by those of one that isn't there."""
    rows = [(c, 0, "user", "a") for c in range(1, 20)]
    got = found_trie(spark, rows)
    assert got == plain_trie(rows, 6)
    assert any(r[1] == 0 and r[7] != hashlib.sha256().hexdigest() for r in got)


def test_parentheses_close_where_a_stack_says():
    rng = random.Random(1)
    for n in (1, 2, 31, 32, 33, 700, 5_000):
        bits, open_, left = [], 0, n
        while left or open_:
            up = left and (not open_ or rng.random() < (0.9 if n == 700 else 0.52))
            bits.append(bool(up))
            open_ += 1 if up else -1
            left -= bool(up)
        stack, close = [], {}
        for i, up in enumerate(bits):
            if up:
                stack.append(i)
            else:
                close[stack.pop()] = i
        opens = np.array(bits)
        shape, at = prefix_trie.Parentheses(opens), np.flatnonzero(opens)
        assert shape.find_close(at).tolist() == [close[i] for i in at]
        pairs = [bits[i] and not bits[i + 1] for i in range(len(bits) - 1)]
        got = shape.leaf_pairs(at, np.array([close[i] for i in at]))
        assert got.tolist() == [sum(pairs[i : close[i]]) for i in at.tolist()]
        assert shape.minima[-1][0] == 0 and shape.maxima[-1][0] == shape.excess.max()
