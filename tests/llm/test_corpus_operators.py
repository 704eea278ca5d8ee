"""Deduplication, mixing, search, toxicity and language against plain versions."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from llm.conftest import ODD
from sparktide.llm import balltree, components, exact_dedup, language, mixing, simhash, toxicity
from sparktide.workspace import materialise


def test_exact_duplicates_of_odd_rows(docs_of):
    rows = ODD * 3 + [(i, f"text {i % 40}") for i in range(100, 400)]
    got = exact_dedup.exact_duplicates(docs_of(rows)).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
    assert len(got) == len(rows)
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    left = exact_dedup.drop_exact_duplicates(docs_of(rows))
    assert left.columns == docs_of(rows).columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r.keep_id) for r in kept)


def test_exact_duplicates_of_nothing(docs_of):
    assert exact_dedup.exact_duplicates(docs_of([])).count() == 0
    assert exact_dedup.drop_exact_duplicates(docs_of([])).count() == 0


def test_perfect_hash_is_minimal_and_rejects_strangers():
    raw = b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5_000))
    words = np.frombuffer(raw, "<u8").reshape(-1, 4)
    sizes, levels = exact_dedup._build(words)
    slots = exact_dedup._slots(words, sizes, levels)
    assert sorted(slots) == list(range(5_000))
    held = words[np.argsort(slots)]
    strangers = np.frombuffer(b"".join(hashlib.sha256(f"x{i}".encode()).digest() for i in range(5_000)), "<u8").reshape(-1, 4)
    at = exact_dedup._slots(strangers, sizes, levels)
    assert not ((at >= 0) & (held[at] == strangers).all(axis=1)).any()
    with pytest.raises(ValueError):
        exact_dedup._build(np.concatenate([words[:1], words[:1]]))


def test_history_and_batch_meet(spark):
    history = spark.createDataFrame([(1, 5, b"a" * 32), (2, 6, b"b" * 32), (3, 4, b"a" * 32)], "row long, key long, digest binary")
    batch = spark.createDataFrame([(4, 9, b"a" * 32), (5, 1, b"b" * 32), (6, 2, b"c" * 32)], "row long, key long, digest binary")
    got = {bytes(r.digest)[:1]: (r.key, r.row, r.size) for r in exact_dedup.dedup_groups(history, batch).collect()}
    assert got == {b"a": (9, 4, 3), b"b": (6, 2, 2), b"c": (2, 6, 1)}


def _components(pairs, nodes):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    assert got == _components([p for p in pairs if p[0] != p[1]], nodes)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _plain_print(text, width=4):
    from xxhash import xxh64_intdigest

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes) > 0)


def _near_docs():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(3_000)]
    rows = []
    for d in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(150, 300))]
        rows.append((10 * d, " ".join(words)))
        for c in range(rng.randint(0, 3)):
            changed = list(words)
            changed[rng.randrange(len(words))] = "changed"
            rows.append((10 * d + 1 + c, " ".join(changed)))
    return rows


def test_near_duplicates_are_those_of_all_pairs(docs_of, monkeypatch):
    rows = ODD + _near_docs()
    prints = [_plain_print(t) for _, t in rows]
    keys = [-(2**63) if i is None else i for i, _ in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = _components(pairs, range(len(rows)))
    least = {}
    for n, root in roots.items():
        least[root] = min(least.get(root, keys[n]), keys[n])
    expected = sorted((str(i), f"{p:016x}", str(least[roots[n]] if least[roots[n]] > -(2**63) else None)) for n, ((i, _), p) in enumerate(zip(rows, prints, strict=True)))
    for place in (simhash.PLACE_VARIANTS, 4_000):
        monkeypatch.setattr(simhash, "PLACE_VARIANTS", place)
        got = simhash.near_duplicates(docs_of(rows)).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected
    assert simhash.near_duplicates(docs_of([])).count() == 0


def test_places_hold_no_more_than_their_bound(spark, monkeypatch):
    """Varied copies of one template: those that visit a place one leading bit away count there."""
    monkeypatch.setattr(simhash, "PLACE_VARIANTS", 20_000)
    rng, template = random.Random(3), 0x0123456789ABCDEF
    prints = {template ^ sum(1 << b for b in rng.sample(range(40), 6)) for _ in range(3_000)}
    prints |= {rng.getrandbits(63) for _ in range(1_000)}
    frame = spark.createDataFrame([(i, 0, p) for i, p in enumerate(sorted(prints))], "id long, sketch int, fp long")
    plain = simhash._links_of

    def bounded(low, flips, *more):
        links = plain(low, flips, *more)
        held = [sum(math.comb(low, k) for k in range(flips - used + 1)) for used in range(flips + 1)]

        def check(table):
            assert sum(held[used] for used in table["used"].to_pylist()) <= 20_000
            return links(table)

        return check

    monkeypatch.setattr(simhash, "_links_of", bounded)
    assert simhash.near_links(materialise(frame)).count() > 0


def test_chunks_of_a_long_text_change_nothing(monkeypatch):
    text = " ".join(f"word{i % 977}" for i in range(5_000)) + "\n\tend"
    whole = simhash.fingerprint(text.encode(), 4)
    monkeypatch.setattr(simhash, "CHUNK", 700)
    assert simhash.fingerprint(text.encode(), 4) == whole
    assert whole % 2**64 == _plain_print(text)


def test_similar_documents_go_and_others_stay(docs_of):
    docs = docs_of(ODD + [(10_000 + i, t) for i, t in _near_docs()])
    heads = [str(r.doc_id) for r in simhash.near_duplicates(docs).collect() if r.doc_id == r.component_id]
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(heads)
    assert len(heads) < docs.count()
    assert simhash.drop_near_duplicates(docs_of([])).count() == 0


def _plain_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = left - sum(2 * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        target = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not over:
            return target | {s: 2 * sizes[s] for s in capped}
        capped |= over


def test_the_mix_meets_its_targets(docs_of):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 400)), "en", rng.choice(["a", "b", "c", "é", "tiny", None])) for i in range(600)]
    rows = [r for r in rows if r[3] != "tiny" or r[0] < 60] + [(1_000, None, "en", "b"), (1_001, "x " * 30_000, "en", "c"), (1_001, "x " * 30_000, "en", "c")]
    docs = docs_of(rows)
    got = mixing.mixed(docs).collect()
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len((t or "").split())
    targets = _plain_targets(sizes)
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and math.isclose(r.target, targets[r.source])
        assert 0 <= r.taken <= 2 * r.size
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 0.02 * target + 4
    again = mixing.mixed(docs.repartition(5)).collect()
    assert sorted((r.key, r.size, r.taken) for r in got) == sorted((r.key, r.size, r.taken) for r in again)
    texts = mixing.take(docs).collect()
    words = defaultdict(int)
    for r in texts:
        words[r.source] += len(r.text.split())
    assert words == {s: n for s, n in taken.items() if n}


def test_mixes_of_nothing(docs_of):
    assert mixing.mixed(docs_of([])).count() == 0
    none = mixing.mixed(docs_of([(1, None), (2, "")])).collect()
    assert [(r.taken, r.target) for r in none] == [(0, 0.0)] * 2
    assert mixing.take(docs_of([(1, None), (2, "")])).count() == 0


def test_quotas_of_very_unequal_votes(spark):
    """No number of doublings brings a divisor from the large vote to the small one."""
    cells = spark.createDataFrame([(0, 1_000.0, 5), (1, 0.000001, 100), (2, 0.0, 1_000)], "cell int, votes double, most long")
    assert sorted(r.quota for r in mixing.apportion(cells, 50, ["cell"]).collect()) == [0, 5, 45]
    assert sorted(r.quota for r in mixing.apportion(cells, 500, ["cell"]).collect()) == [0, 5, 100]


def test_highest_quotients(spark):
    rng = random.Random(4)
    cells = [(i, float(rng.choice([0, 1, 5, 5, 40])) * rng.random() ** (i % 2), rng.randint(0, 40)) for i in range(60)]
    frame = materialise(spark.createDataFrame(cells, "cell long, votes double, most long"))
    for seats in (0, 1, 7, 200, 500, 5_000):
        ranked = sorted((-v / (2 * j - 1), c, j) for c, v, m in cells for j in range(1, m + 1) if v > 0)[:seats]
        expected = {c: sum(1 for _, x, _ in ranked if x == c) for c, _, _ in cells}
        got = {r.cell: r.quota for r in mixing.apportion(frame, seats, ["cell"]).collect()}
        assert got == expected, seats


def test_ball_trees_find_the_best(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(900)]
    rows += [(1_000 + i, rows[i % 7][1]) for i in range(80)] + [(2_000, [0.0] * 8), (2_100, [1.0, 2.0]), (2_101, [3.0, 1.0])]
    bad = [(3_000, None), (3_100, [float("nan")] + [0.0] * 7), (3_200, [float("inf")] * 8), (3_300, [None] * 8), (None, [9.0] * 8), (3_400, [])]
    frame = spark.createDataFrame([(*r, 1) for r in rows + bad], "vec_id long, embedding array<float>, score int")
    for limit in (balltree.SHARD_ROWS, 100):
        monkeypatch.setattr(balltree, "SHARD_ROWS", limit)
        monkeypatch.setattr(balltree, "QUERY_ROWS", 3 if limit == 100 else 4_096)
        v = materialise(balltree.vectors(frame, "vec_id", "embedding", 1024))
        got = defaultdict(list)
        for r in balltree.top_k(v, v.where("id % 100 = 0"), 10).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.vec_id, r.score))
        whole = {i: [math.floor(1024 * x) for x in e] for i, e in rows}
        for q, a in whole.items():
            if q % 100 == 0:
                scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole.items() if i != q and len(a) == len(b))
                assert got[q] == [(i, -s) for s, i in scored[:10]]
    none = v.where("id < 0")
    assert balltree.top_k(none, none, 10).count() == 0


def test_shards_by_space_are_mostly_cut(spark, monkeypatch):
    """Of 25 far clusters a query that knows its k-th score meets few shards; copies of one vector stay searchable."""
    monkeypatch.setattr(balltree, "SHARD_ROWS", 40)
    monkeypatch.setattr(balltree, "DIRECTORY_ROWS", 7)
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 40, (25, 8))
    points = [(i, (centres[i % 25] + rng.normal(0, 0.5, 8)).tolist()) for i in range(2_000)] + [(i, [50.0] * 8) for i in range(2_000, 2_300)]
    v = materialise(balltree.vectors(spark.createDataFrame(points, "vec_id long, embedding array<double>"), "vec_id", "embedding", 16))
    trees = balltree.build_trees(v)
    sizes = trees.selectExpr("length(ids) div 8 AS n").collect()
    assert sum(r.n for r in sizes) == 2_300 and max(r.n for r in sizes) < 80
    asked = v.where("id % 50 = 0")
    got = balltree.top_k(v, asked, 10).collect()
    whole = {r.id: np.array(r.v) for r in v.collect()}
    floors = []
    for q in whole:
        if q % 50 == 0:
            best = sorted((-int(whole[q] @ x), i) for i, x in whole.items() if i != q)[:10]
            assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == best
            floors.append((q, -best[-1][0]))
    known = asked.join(spark.createDataFrame(floors, "id long, floor long"), "id").selectExpr("id", "dim", "v", "floor", "array(-1L) AS seen")
    met, all_pairs = balltree.pairs(trees, known).count(), len(floors) * len(sizes)
    assert met < all_pairs / 3, (met, all_pairs)


def test_large_scores_are_whole():
    big = np.array([[2.0**40, 1.0], [2.0**29, 3.0]])
    assert balltree._scores(big[1:], big[1:]).tolist() == [[2**58 + 9]]
    assert balltree._scores(big[:1], big[:1]).tolist() == [[2**63 - 1]]


def _plain_segments(scores):
    """Maximal segments by definition: the best one, then left and right of it."""

    def best(lo, hi):
        found = None
        for a in range(lo, hi):
            total = 0
            for b in range(a, hi):
                total += scores[b]
                if total > 0 and (found is None or total > found[0] + 1e-12):
                    found = (total, a, b + 1)
        return found

    def walk(lo, hi):
        found = best(lo, hi)
        if found:
            _, a, b = found
            walk(lo, a)
            made.append((a, b))
            walk(b, hi)

    made = []
    walk(0, len(scores))
    return made


def test_maximal_segments_by_definition():
    rng = random.Random(7)
    for _ in range(300):
        scores = [round(rng.uniform(-2, 2), 3) for _ in range(rng.randint(0, 25))]
        found, n = toxicity.maximal_segments((i, i + 1, s) for i, s in enumerate(scores))
        assert n == len(scores) and [(a, b) for a, b, _ in found] == _plain_segments(scores)


def test_toxicity_learns_and_tells(spark):
    rng = random.Random(8)
    plain = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(900):
        words = [rng.choice(plain) for _ in range(60)]
        if i % 6 == 0:
            words[20:24] = ["vile", "rotten", "scum", "vile"]
        rows.append((i, " ".join(words), int(i % 6 == 0)))
    docs = spark.createDataFrame([(i, t, 0) for i, t, _ in rows] + [(9_001, None, 0), (9_002, "", 0), (None, "x", 0)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(9_001, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == 903
    truth = {i: y for i, _, y in rows}
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == truth.get(r.doc_id, 0), r
    model = toxicity.train(toxicity.learnable(docs, labels))
    text = "All fine here. É vile rotten scum! Fine again, all of it"
    passages = toxicity.find(spark.createDataFrame([(text,)], "text string"), model).first().passages
    assert [text[p.start : p.end] for p in passages] == ["vile rotten scum"]


def test_toxicity_without_labels(spark, docs_of):
    docs = docs_of(ODD)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score_documents(docs, none).collect()} == {0}
    assert toxicity.score_documents(docs_of([]), none).count() == 0


SENTENCES = {
    "en": "the house and the garden were quiet when they came home that evening",
    "de": "das Haus und der Garten waren still als sie am Abend nach Hause kamen",
    "fr": "la maison et le jardin étaient calmes quand ils sont rentrés ce soir",
    "es": "la casa y el jardín estaban tranquilos cuando llegaron esa noche",
}


def test_language_from_all_evidence(docs_of):
    rows = [(10 * i + k, f"{text} {i}", lang, f"host.{lang}") for i in range(30) for k, (lang, text) in enumerate(SENTENCES.items())]
    odd = [(901, SENTENCES["de"], "en", "host.de"), (902, "la", None, "host.fr"), (903, "la", None, "host.es"), (904, "12 !!", "en", "host.en"), (905, None, "en", "host.en"), (906, "漢字 仮名 交じり文 " * 20, None, "host.en"), (907, "the garden", None, None)]
    docs = docs_of(rows + odd)
    judged = {r.key: r for r in language.fuse(language.document_rows(docs), language.train(docs)).collect()}
    for i, _, lang, _ in rows:
        assert judged[i].language == lang and judged[i].accepted
    assert judged[901].language == "de"
    assert judged[902].language == "fr" and judged[903].language == "es"
    assert [judged[i].accepted for i in (904, 905, 906)] == [False] * 3
    assert judged[904].language is None and judged[906].language == "und"
    kept = {r.doc_id for r in language.keep_identified(docs).collect()}
    assert kept == {r[0] for r in rows + odd} - {904, 905, 906}
    assert language.keep_identified(docs).columns == docs.columns
    assert language.keep_identified(docs_of([])).count() == 0


def test_language_model_counts_every_trigram(docs_of):
    docs = docs_of([(1, "aaaa", "en"), (2, "aaa", "de"), (3, "zzz", "xx"), (4, None, "fr")])
    model = language.train(docs)
    seen = np.zeros(language.BUCKETS)
    for grams in language.trigrams("aaaa"):
        seen += np.bincount(grams, minlength=language.BUCKETS)
    expected = np.log((seen + language.UNSEEN) / (seen + language.UNSEEN).sum())
    assert np.allclose(model[1], expected)
    assert np.allclose(model[3], np.log(1 / language.BUCKETS)) and np.allclose(model[-1], model[3])


def test_pages(spark):
    html = '<html  LANG="fr"><script>var english = "the of and"</script><body>la maison &amp; le jardin</body></html>'
    pages = spark.createDataFrame([(1, "http://u@www.a.co.fr:80/x?y", html, "k"), (2, None, None, "k"), (3, "odd", "<p", "k")], "page_id long, url string, html string, key string")
    got = {r.key: r for r in language.page_rows(pages).collect()}
    assert (got[1].declared, got[1].suffix, got[1].host) == ("fr", "fr", "www.a.co.fr")
    assert "english" not in got[1].text and "la maison" in got[1].text
    assert (got[2].declared, got[2].suffix, got[2].text) == ("", None, "")
