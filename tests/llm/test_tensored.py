"""MinHash near duplicates against all pairs."""

import random
import re

import numpy as np
import pytest

from llm.conftest import ODD
from sparktide.llm import tensored


def plain_set(text, width):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain_groups(rows, width, least):
    """(doc_id, n_shingles, component_id, kept) of every row; rows of one id are one vertex."""
    key = [-(2**63) if i is None else i for i, _ in rows]
    sets = [plain_set(t, width) for _, t in rows]
    up = {k: k for k in key}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= least * (len(sets[a]) + len(sets[b]) - common):
                x, y = top(key[a]), top(key[b])
                up[max(x, y)] = min(x, y)

    def named(k):
        return None if k == -(2**63) else k

    return sorted(((named(k), len(s), named(top(k)), top(k) == k) for k, s in zip(key, sets, strict=True)), key=str)


def found_groups(docs, width, least):
    found = tensored.near_duplicates(docs, width, least).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=str)


def _families():
    """Documents at 0.5 to 1 around templates, so that buckets hold several components, and copies of some."""
    rng, rows = random.Random(22), []
    for family in range(5):
        template = [f"t{family}w{i}" for i in range(120)]
        for i in range(40):
            words = list(template)
            for at in rng.sample(range(10, 110, 4), rng.randint(1, 9)):
                words[at] = f"{rng.choice('abc')}{at}"
            rows.append((100 * family + i, " ".join(words)))
    rows += [(1_000 + i, rows[0][1].upper()) for i in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width,least", [(2, 80), (5, 60)])
def test_groups_are_those_of_all_pairs(docs_of, width, least):
    rows = _families() + ODD
    assert found_groups(docs_of(rows), width, least) == plain_groups(rows, width, least)


def test_pairs_just_above_the_similarity_meet(docs_of):
    rng, rows = random.Random(21), []
    for d in range(200):
        words = [f"w{rng.randrange(10**9)}" for _ in range(200)]
        changed = list(words)
        for at in range(10, 190, 20):
            changed[at] = "changed" + str(d)
        rows += [(2 * d, " ".join(words)), (2 * d + 1, " ".join(changed))]
    one, other = plain_set(rows[0][1], 2), plain_set(rows[1][1], 2)
    assert 0.8 <= len(one & other) / len(one | other) < 0.85
    assert found_groups(docs_of(rows), 2, 80) == plain_groups(rows, 2, 80)


def test_one_template_at_point_six_costs_no_pairs(docs_of, monkeypatch):
    """Pairs that are tested grow in proportion to a family none of whose members are near copies."""
    tested = {}
    confirmed = tensored._confirmed

    def counting(pairs, sets, least):
        tested[n] = tested.get(n, 0) + pairs.count()
        return confirmed(pairs, sets, least)

    monkeypatch.setattr(tensored, "_confirmed", counting)
    rng = random.Random(5)
    template = [f"t{i}" for i in range(200)]
    for n in (60, 180):
        rows = []
        for i in range(n):
            words = list(template)
            for at in rng.sample(range(1, 199, 4), 25):
                words[at] = f"own{i}x{at}"
            rows.append((i, " ".join(words)))
        got = tensored.near_duplicates(docs_of(rows), 2, 80).collect()
        assert all(r.kept for r in got)
    assert tested[60] <= 60 and tested[180] <= 180


def test_chances_are_as_stated():
    assert tensored.chance(0.8) > 0.9999
    assert tensored.halves_for(0.8, 0.9999) == tensored.HALVES
    rng = np.random.default_rng(4)
    keys = tensored.HalfKeys(3, 14)
    sets = [rng.integers(0, 2**64, 450, np.uint64) for _ in range(300)]
    shared = np.mean([np.mean(keys.of(s[:425]) == keys.of(s[25:])) for s in sets])
    assert abs(shared - (400 / 450) ** 3) < 0.02


def test_nothing(docs_of):
    assert tensored.near_duplicates(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        tensored.near_duplicates(docs_of([]), 2, 0)
