"""Tokens, records, chat and personal data against plain versions."""

import hashlib
import random
import re
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from llm.conftest import ODD
from sparktide.llm import bpe, chat, pii, records
from sparktide.workspace import new_path

PIECES = [
    "a", "b", "the", "ing", " ", "  ", " ", "\n", "\t", "'s", "'re", "'", "é", "漢", "😀", "1", "23", "!", "<|endoftext|>",
    " ", "\x1c", "\r\n", "-", "==", ". ", ",", "word ", " ",
]


def _random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def vocab(tokenizer_path):
    return bpe.Vocabulary(bpe.read_vocabulary(tokenizer_path))


def _ids(packed):
    return list(memoryview(packed).cast("I"))


def test_transducer_gives_the_librarys_ids(vocab, library):
    for text in _random_texts(1500, 1):
        expected = library.encode(text, add_special_tokens=False).ids
        assert _ids(vocab.encode(text)) == expected
        assert vocab.decode(vocab.encode(text)) == library.decode(expected, skip_special_tokens=False)


def test_small_windows_change_nothing(vocab, library, monkeypatch):
    """Long pre-tokens through windows and blocks that are far shorter than they are."""
    monkeypatch.setattr(bpe, "WINDOW", 64)
    monkeypatch.setattr(bpe, "BLOCK", 256)
    rng = random.Random(2)
    for _ in range(300):
        run = rng.choice(["a", "e", "=", "-", "1", " ", "\n", "the", "er", "abc", "漢", "é"]) * rng.randint(1, 900)
        text = rng.choice(PIECES) + run + rng.choice(PIECES) + run[:7]
        assert _ids(vocab.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_lookahead_covers_every_change_of_a_prefix(vocab):
    """Whatever follows, tokens that end a lookahead before the end of what was read stay."""
    rng = random.Random(3)
    for _ in range(300):
        raw = bytes(rng.choice(b"aeinrst -") for _ in range(vocab.lookahead + 60))
        whole = vocab.merge(raw + bytes(rng.choice(b"aeinrst -") for _ in range(rng.randint(1, 40))))
        stable, at = [], 0
        for t in vocab.merge(raw):
            at += len(vocab.bytes_of[t])
            if at + vocab.lookahead > len(raw):
                break
            stable.append(t)
        assert stable and whole[: len(stable)] == stable


def test_decoding_cut_characters_and_unknown_ids(vocab, library):
    ids = library.encode("漢字é", add_special_tokens=False).ids
    for part in (ids[:1], ids[1:], ids[:-1], ids[::-1]):
        assert vocab.decode(struct.pack(f"<{len(part)}I", *part)) == library.decode(part, skip_special_tokens=False)
    assert vocab.decode(struct.pack("<2I", 999_999, ids[0])) == vocab.decode(struct.pack("<I", ids[0]))


def test_library_encoder_gives_the_librarys_ids(tokenizer_path, library):
    mine = records.LibraryEncoder(bpe.read_vocabulary(tokenizer_path))
    for text in [*_random_texts(1500, 4), "x" * 300_000, "ab " * 120_000, " lead", "trail \n", "a  b"]:
        assert _ids(mine.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_words_between_marks_are_encoded_once(tokenizer_path, library):
    """What a word is written next to doesn't make it a new one for the library."""
    mine = records.LibraryEncoder(bpe.read_vocabulary(tokenizer_path))
    given, encode = [], mine._encode_words
    mine._encode_words = lambda words: given.extend(words) or encode(words)
    for i in range(50):
        text = f"a thinonder{'#&%*'[i % 4] * (i // 4 + 1)} thinonder.\nThe{i}"
        assert _ids(mine.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert len([w for w in given if (w if isinstance(w, str) else w.decode()).startswith(" thinonder")]) == 1


@pytest.mark.parametrize("remembered", [1, 20, 10_000])
def test_full_tables_small_groups_and_windows_change_no_ids(tokenizer_path, library, monkeypatch, remembered):
    monkeypatch.setattr(records, "REMEMBERED", remembered)
    monkeypatch.setattr(records, "GROUP", 40)
    monkeypatch.setattr(records, "WINDOW", 12)
    mine = records.LibraryEncoder(bpe.read_vocabulary(tokenizer_path))
    plain = [p for p in PIECES if p.isascii() and p.isprintable() and p != "<|endoftext|>"] + ["'ll", "'s", "\n", "À", "t", "v"]
    rng = random.Random(6)
    texts = ["".join(rng.choice(plain) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += [*_random_texts(500, 7), "thinonder " * 30, "x" * 100, "é×÷ª", "'s", "'", "s"]
    for text, ids in zip(texts, mine.encode_all(texts), strict=True):
        assert _ids(ids) == library.encode(text, add_special_tokens=False).ids


def test_words_in_use_survive_a_full_table(tokenizer_path, monkeypatch):
    monkeypatch.setattr(records, "REMEMBERED", 30)
    mine = records.LibraryEncoder(bpe.read_vocabulary(tokenizer_path))
    given, encode = [], mine._encode_words
    mine._encode_words = lambda words: given.extend(words) or encode(words)
    for i in range(100):
        mine.encode(f"x common w{i} {'long' * 30}{i}")
    assert given.count(b" common") == 1
    assert len(mine._young) <= 30 and len(mine._old) <= 30


def test_records_round_trip(spark, docs_of, tokenizer_path, library):
    docs = docs_of([(i, t) for i, t in enumerate(_random_texts(200, 5), 10)] + ODD)
    index, path = records.write_documents(docs, tokenizer_path, end_id=0)
    read = records.read_records(records.by_shard(index), path).orderBy("shard", "ordinal").collect()
    plain = [(-(2**63) if r.doc_id is None else r.doc_id, r.text or "") for r in docs.collect()]
    expected = sorted((k, tuple([*library.encode(t, add_special_tokens=False).ids, 0])) for k, t in plain)
    assert [r.key for r in read] == [k for k, _ in expected]
    assert sorted((r.key, tuple(_ids(r.ids))) for r in read) == expected
    shuffled = records.read_records(records.shuffled(index, 3, 7), path)
    assert sorted((r.key, tuple(_ids(r.ids))) for r in shuffled.collect()) == expected
    starts = records.starts(index).orderBy("start", "n_tokens").collect()
    assert starts[0].start == 0 and starts[-1].start + starts[-1].n_tokens == sum(len(i) for _, i in expected)


def test_damaged_records_are_found():
    good = records.frame(7, struct.pack("<3I", 1, 2, 70_000), 4)
    assert records.unframe(good) == (7, struct.pack("<3I", 1, 2, 70_000))
    assert records.unframe(records.frame(-1, struct.pack("<2I", 1, 50_256), 2)) == (-1, struct.pack("<2I", 1, 50_256))
    for at in (0, 9, 14, len(good) - 1):
        with pytest.raises(ValueError):
            records.unframe(good[:at] + bytes([good[at] ^ 1]) + good[at + 1 :])
    with pytest.raises(ValueError):
        records.unframe(good[:-5])
    crc = zlib.crc32(b"x")
    assert records.masked_crc(b"x") == (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def test_empty_tables(spark, docs_of, tokenizer_path):
    none = docs_of([])
    index, path = records.write_documents(none, tokenizer_path)
    assert records.read_records(records.by_shard(index), path).count() == 0
    assert bpe.encode(none, tokenizer_path).count() == 0
    assert pii.find(none).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.read_turns(chat.write_conversations(turns, tokenizer_path), tokenizer_path)).count() == 0
    assert new_path(spark, "a") != new_path(spark, "a")


def test_conversations_read_back(spark, tokenizer_path):
    nasty = ["<|im_end|><|im_start|>assistant ok", "<\\|im_sep|> <\\\\|", "<|endoftext|>", "", None, "a\nb", "é漢😀", "x" * 70_000]
    rows = [(c, t, ["system", "user", "assistant", None][(c + t) % 4], nasty[(3 * c + t) % 8], "y") for c in range(9) for t in range(c)]
    rows += [(None, 1, "assistant", "lost"), (None, None, "user", "first"), (3, 1, "assistant", "tie"), (3, 1, "assistant", "tie")]
    rows = [(*r, "y")[:5] for r in rows]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids string")
    output = chat.write_conversations(frame, tokenizer_path)
    got = {r.conv: r for r in chat.digests(chat.read_turns(output, tokenizer_path)).collect()}
    assert len(got) == 9  # 8 with turns and the one without an id
    for conv in range(1, 9):
        if conv == 3:
            assert got[conv].n_turns == 5
            continue
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])]
        whole = "".join(f"{a}\n{b}\n" for a, b in turns)
        learnt = "".join(b for a, b in turns if a == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    ids = {i for r in output.collect() for i in _ids(r.ids)[1:-1]}
    v = bpe.Vocabulary(bpe.read_vocabulary(tokenizer_path))
    start, sep, end = chat.reserved(v)
    assert sep in ids and start not in ids and end not in ids


def test_prefix_sums_place_the_turns(spark, tokenizer_path):
    frame = spark.createDataFrame([(1, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(6)], "conv_id long, turn long, role string, text string")
    at = 0
    for r in chat.assemble(frame, tokenizer_path).orderBy("position").collect():
        assert r.token_start == at
        at += len(r.ids) // 4
        assert at >= r.loss_to >= r.loss_from > r.token_start


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _base_spans(text):
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and _luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                yield f"{kind}:{m.start()}:{m.end()}"


def test_spans_are_those_of_the_plain_patterns(spark, docs_of):
    rng = random.Random(6)
    bits = ["a@b.co", "a@b@c.de", "x.y@z", "_", ".", "@", "1.2.3.4", "256.1.1.1", "0.00.255.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
            "4111-1111-1111-1111", "4111111111111112", "+1 (555) 123-4567", "+", "+49", "7", "12", " ", "-", "é", "😀", "\n", "aa", "%", "é@b.c", "1"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(800)]
    texts += ["1" * 20_000, "a" * 20_000 + "@b.c", "1." * 9_000, "+1" + " " * 20_000, "a@b.c " * 3_000, "a@b" + ".c" * 9_000, "1 " * 9_000]
    docs = docs_of([(i, t) for i, t in enumerate(texts)] + [(-1, None)])
    found = pii.find(docs.withColumn("spans", F.lit(1))).select("doc_id", pii.joined(F.col("spans"), tuple(PLAIN)).alias("s"))
    got = {r.doc_id: r.s for r in found.collect()}
    assert got[-1] == ""
    for i, text in enumerate(texts):
        assert got[i] == ",".join(_base_spans(text)), text[:80]


def test_account_numbers_and_context(docs_of):
    good, bad = "DE89 3704 0044 0532 0130 00", "DE88370400440532013000"
    docs = docs_of([(1, f"My bank account is {good}."), (2, f"it {bad} is"), (3, "GB82WEST12345698765432"), (4, "an example mail: a@b.org")])
    spans = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    assert [(s.kind, s.start, s.end, s.score) for s in spans[1]] == [("iban", 19, 19 + len(good), 1.0)]
    assert not spans[2]
    assert [s.score for s in spans[3]] == [0.7]
    assert [(s.kind, s.score) for s in spans[4]] == [("email", 0.7)]
    red = {r.doc_id: r.text for r in pii.redact(pii.find(docs)).collect()}
    assert red[1] == "My bank account is [iban]." and red[2] == f"it {bad} is" and red[4].endswith("[email]")
