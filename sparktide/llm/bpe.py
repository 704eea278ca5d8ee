"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

What stands right of a text can change the tokens left of its end only along a
chain of merges: a merge at the end takes the symbol a1 in front of it, which a
later merge, whose right part starts with a1, can answer by taking the symbol a2
in front of that, and so on, with ever later ranks. The longest such chain, found
by one pass over the merge list, is the sufficient lookahead: a token that ends
that many bytes before the end of what was read never changes. The transducer
holds one block and the lookahead, whatever the length of the text.

Pre-tokens are cut the same way: a match is final once the pattern can't look
beyond what was read, and a match that fills the window is fed on piece by piece.

Decoding joins the bytes of the ids and runs them through an incremental UTF-8
state machine that replaces what is no text by U+FFFD.

The texts of added tokens in a text become their ids, as the vocabulary's own
library does. Tokens of recent pieces are kept in a bounded table per Python
worker; a piece ends where a single blank follows and precedes other characters,
which is a token boundary in any context.

Defined results: a null text is empty and has no ids. Ids without a token decode
to nothing. An empty table gives an empty result. Columns of the input stay, except
those named like an output, which are replaced.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktide.llm.common import brought_back, map_batches, set_aside, text_of

#: Characters that are cut into pre-tokens at once.
WINDOW = 262_144
#: Bytes of one pre-token that are merged at once, besides the lookahead.
BLOCK = 4_096
#: Pieces whose tokens a worker remembers.
REMEMBERED = 300_000

_NEVER = 1 << 60
# Token boundaries in any context: between two other characters, in front of a single blank ...
CUT = re.compile(r"(?<=\S)(?= \S)")
# ... from a letter to a mark or a newline, from a mark to a newline, behind a single newline.
FINE_CUT = re.compile(
    r"(?<=\S)(?= \S)|(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[.,;:!?)\n])|(?<=[.,;:!?)])(?=\n)|(?<=\S\n)(?=\S)"
)
# A blank next to any other white space, as far as either library may call it that.
_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)
_BESIDE = [p for c in _SPACES for p in {f" {c}", f"{c} "}]
_BESIDE_ASCII = [p for p in _BESIDE if p.isascii()]
_MARKS = ".,;:!?)\n"
_LETTERS = frozenset(c for c in map(chr, range(0x41, 0x100)) if c.isalpha() and c not in "\xaa\xb5\xba")


def _fine(piece: str):
    """The words of a piece, cut like ``FINE_CUT``; marks at the end stay together."""
    word = piece.rstrip(_MARKS)
    if "\n" in word:
        return FINE_CUT.split(piece)
    if len(word) == len(piece) or word[-1:] not in _LETTERS:
        return (piece,)
    return word, piece[len(word) :]


def byte_alphabet() -> dict[str, int]:
    """The printable characters a byte-level vocabulary writes its bytes with."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Piecewise:
    """Encodes texts piece by piece and remembers the ids of recent pieces.

    A text is split at single blanks, a piece that isn't known into words, and only
    words that aren't known either are encoded, by ``_encode_words``.
    """

    def __init__(self):
        self._pieces: dict[str, bytes] = {}  # keyed without the blank in front
        self._words: dict[str, bytes] = {}

    def _encode_words(self, words: list[str]) -> list[bytes]:
        raise NotImplementedError

    def _long_piece(self, piece: str) -> bytes:
        """A piece longer than a window."""
        raise NotImplementedError

    def _join_words(self, found: list[str]) -> list[bytes]:
        """The ids of pieces, through their words."""
        split = [_fine(p) for p in found]
        words = self._words
        new = list({w for ws in split for w in ws if w not in words})
        if len(words) + len(new) > REMEMBERED:
            words.clear()
            new = list({w for ws in split for w in ws})
        words.update(zip(new, self._encode_words(new), strict=True))
        return [words[ws[0]] if len(ws) == 1 else b"".join([words[w] for w in ws]) for ws in split]

    def plain(self, text: str) -> bytes:
        """The packed ids of a text without added tokens."""
        beside = _BESIDE_ASCII if text.isascii() else _BESIDE
        if len(text) > WINDOW or text[:1] == " " or text[-1:] == " " or any([b in text for b in beside]):
            return b"".join(self._group(g) for g in _groups(pieces(text)))
        first, *rest = text.split(" ")
        known = self._pieces
        made = list(map(known.get, rest))
        if None in made:
            missing = [i for i, ids in enumerate(made) if ids is None]
            new = list({rest[i] for i in missing})
            fresh = dict(zip(new, self._join_words([" " + p for p in new]), strict=True))
            for i in missing:
                made[i] = fresh[rest[i]]
            if len(known) + len(new) > REMEMBERED:
                known.clear()
            known.update(fresh)
        return b"".join([*self._join_words([first]), *made])

    def _group(self, group: list[str]) -> bytes:
        short = [p for p in group if len(p) <= WINDOW]
        made = dict(zip(short, self._join_words(short), strict=True))
        return b"".join([made[p] if p in made else self._long_piece(p) for p in group])


def _groups(stream: Iterator[str]) -> Iterator[list[str]]:
    while group := list(islice(stream, 4_096)):
        yield group


class Vocabulary(Piecewise):
    """A byte-level BPE vocabulary from the JSON text of a tokenizer file."""

    def __init__(self, text: str):
        import regex

        spec = json.loads(text)
        model, steps = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or steps.get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("only byte-level BPE without a normaliser is supported")
        if steps.get("add_prefix_space") or not steps.get("use_regex", True) or model.get("ignore_merges"):
            raise ValueError("this vocabulary asks for a prefix space, no pattern or whole words first")
        # Fixed: the pattern of the byte-level pre-tokenizer.
        self.pattern = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        )
        self.runs = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\s+")]
        alphabet = byte_alphabet()
        self.bytes_of = {i: bytes(alphabet[c] for c in t) for t, i in model["vocab"].items() if all(c in alphabet for c in t)}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of.update((i, t.encode()) for t, i in self.added.items())
        longest_first = sorted(self.added, key=len, reverse=True)
        self.added_at = re.compile("|".join(map(re.escape, longest_first))) if self.added else None
        self.first = [self.id_of[bytes([b])] for b in range(256)]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = [tuple(self.id_of[bytes(alphabet[c] for c in p)] for p in m) for m in merges]
        self.merged = [self.id_of[self.bytes_of[a] + self.bytes_of[b]] for a, b in self.merges]
        self.rank = {(a << 32) | b: r for r, (a, b) in reversed(list(enumerate(self.merges)))}
        self.lookahead = self._lookahead()
        super().__init__()

    def _lookahead(self) -> int:
        """The farthest, in bytes, that what follows can reach back."""
        lefts: dict[int, list[int]] = {}
        reach: dict[int, int] = {}
        most = 0
        for (a, b), new in zip(self.merges, self.merged, strict=True):
            starts, todo, before = set(), [b], 0
            while todo:
                t = todo.pop()
                if t not in starts:
                    starts.add(t)
                    before = max(before, reach.get(t, 0))
                    todo += lefts.get(t, [])
            total = len(self.bytes_of[a]) + before
            reach[a] = max(reach.get(a, 0), total)
            most = max(most, total)
            lefts.setdefault(new, []).append(a)
        return most

    def merge(self, raw: bytes) -> list[int]:
        """The tokens of bytes that are seen whole."""
        ids = [self.first[b] for b in raw]
        if len(ids) > 48:
            return self._merge_long(ids)
        get, merged = self.rank.get, self.merged
        ranks = [get((a << 32) | b, _NEVER) for a, b in zip(ids, ids[1:])]  # noqa: B905
        while ranks:
            r = min(ranks)
            if r == _NEVER:
                break
            i = ranks.index(r)
            ids[i] = new = merged[r]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1] << 32) | new, _NEVER)
            if i < len(ranks):
                ranks[i] = get((new << 32) | ids[i + 1], _NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, get = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get((ids[i] << 32) | ids[i + 1], _NEVER)) < _NEVER]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or get((ids[i] << 32) | ids[j], _NEVER) != r:
                continue
            ids[i], ids[j] = self.merged[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (s := get((ids[i] << 32) | ids[k], _NEVER)) < _NEVER:
                    heapq.heappush(heap, (s, i))
            if (h := before[i]) >= 0 and (s := get((ids[h] << 32) | ids[i], _NEVER)) < _NEVER:
                heapq.heappush(heap, (s, h))
        return [t for t in ids if t >= 0]

    def _word(self, word: str) -> list[int]:
        """The tokens of one pre-token."""
        raw = word.encode()
        return self.merge(raw) if len(raw) <= BLOCK else list(self.stream([raw]))

    def _encode_words(self, words: list[str]) -> list[bytes]:
        made = []
        for word in words:
            ids: list[int] = []
            for pre_token in self.pattern.findall(word):
                ids += self._word(pre_token)
            made.append(_packed(ids))
        return made

    def _long_piece(self, piece: str) -> bytes:
        return _packed(self._long(piece))

    def stream(self, parts) -> Iterator[int]:
        """Tokens of one pre-token that arrives in parts, each as soon as it is stable."""
        held, full = bytearray(), BLOCK + self.lookahead
        for part in parts:
            at = 0
            while at < len(part):
                take = full - len(held)
                held += part[at : at + take]
                at += take
                if len(held) < full:
                    break
                end = 0
                for t in self.merge(bytes(held)):
                    if end + len(self.bytes_of[t]) > BLOCK:
                        break
                    end += len(self.bytes_of[t])
                    yield t
                del held[:end]
        yield from self.merge(bytes(held))

    def _long(self, text: str) -> Iterator[int]:
        """Tokens of a text that is longer than a window, window by window."""
        at = 0
        while at < len(text):
            window = text[at : at + WINDOW]
            if at + WINDOW >= len(text):
                for word in self.pattern.findall(window):
                    yield from self._word(word)
                return
            used = 0
            for m in self.pattern.finditer(window):
                # The pattern looks at most one character behind a match and two behind its start.
                if m.end() > len(window) - 2 or m.start() > len(window) - 3:
                    break
                yield from self._word(m.group())
                used = m.end()
            if used:
                at += used
                continue
            ends: list[int] = []
            yield from self.stream(self._run(text, at, ends))
            at = ends[0]

    def _run(self, text: str, at: int, ends: list[int]) -> Iterator[bytes]:
        """The parts of the one pre-token that starts at ``at`` and fills a window."""
        kind = next(run for run in self.runs if run.match(text, at + (text[at] == " " and not text[at + 1].isspace())))
        stop = at + (text[at] == " " and kind is not self.runs[3])
        start = at
        while stop < len(text):
            m = kind.match(text, stop, min(len(text), stop + WINDOW))
            if not m:
                break
            stop = m.end()
            if kind is self.runs[3]:
                # The last blank belongs to the next pre-token if one follows.
                yield text[start : stop - 1].encode()
                start = stop - 1
            else:
                yield text[start:stop].encode()
                start = stop
        if start < stop and stop == len(text):
            yield text[start:].encode()
            start = stop
        ends.append(start)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not self.added_at or not (found := list(self.added_at.finditer(text))):
            return self.plain(text)
        parts, at = [], 0
        for m in found:
            parts += [self.plain(text[at : m.start()]), struct.pack("<I", self.added[m.group()])]
            at = m.end()
        return b"".join([*parts, self.plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        """The text of packed ids."""
        machine = codecs.getincrementaldecoder("utf-8")(errors="replace")
        held, get = [], self.bytes_of.get
        for at in range(0, len(ids), 4 * 65_536):
            block = ids[at : at + 4 * 65_536]
            held.append(machine.decode(b"".join([get(i, b"") for i in memoryview(block).cast("I")])))
        held.append(machine.decode(b"", final=True))
        return "".join(held)


def _packed(ids) -> bytes:
    made = array("I", ids)
    return made.tobytes()


def pieces(text: str) -> Iterator[str]:
    """The text in pieces that can be encoded apart, a window at a time."""
    if len(text) <= WINDOW:
        yield from CUT.split(text)
        return
    at = 0
    while at < len(text):
        end = at + WINDOW
        if end >= len(text):
            yield from CUT.split(text[at:])
            return
        cut = text.rfind(" ", at + 1, end - 1)
        while cut > at and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.rfind(" ", at + 1, cut)
        if cut <= at:  # no boundary in the window: on to the next one
            m = CUT.search(text, end - 1)
            cut = m.start() if m else len(text)
            yield text[at:cut]
        else:
            yield from CUT.split(text[at:cut])
        at = cut


@lru_cache(maxsize=2)
def vocabulary(text: str) -> Vocabulary:
    return Vocabulary(text)


def read_vocabulary(path: str) -> str:
    """The text of a tokenizer file, read on the driver; its size doesn't depend on the data."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _with(df: DataFrame, source: F.Column, name: str, kind: T.DataType, make) -> DataFrame:
    """``df`` with the column ``name`` made value by value from ``source``."""

    def each():
        one = make()
        return lambda values: [one(x) for x in values]

    return _with_lists(df, source, name, kind, each)


def _with_lists(df: DataFrame, source: F.Column, name: str, kind: T.DataType, make) -> DataFrame:
    """``df`` with the column ``name`` made batch by batch from the list of the values of ``source``."""
    plain, names = set_aside(df.withColumn(_free(df), source))
    *kept, read_from = names.values()
    schema = T.StructType([*plain.schema.fields[:-1], T.StructField("made", kind)])

    def once():
        all_of = make()

        def step(batch: pa.RecordBatch) -> dict:
            made = all_of(batch.column(read_from).to_pylist())
            return {c: batch.column(c) for c in kept} | {"made": made}

        return step

    given = {c: names[c] for c in df.columns if c != name}
    return map_batches(plain, once, schema).select(*brought_back(given), F.col("made").alias(name))


def _free(df: DataFrame) -> str:
    """A name that no column of ``df`` has."""
    return "read_" + "_".join(df.columns)


def encode(df: DataFrame, vocabulary_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the text's ids in ``ids_col``, packed as little-endian unsigned 32-bit integers."""
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    return _with(df, text_of(text_col), ids_col, T.BinaryType(), lambda: vocabulary(shared.value).encode)


def decode(df: DataFrame, vocabulary_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``df`` with the text of packed ids in ``text_col``."""
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    ids = F.coalesce(ids_col, F.lit(b""))
    return _with(df, ids, text_col, T.StringType(), lambda: vocabulary(shared.value).decode)


def encode_checked(df: DataFrame, vocabulary_path: str, text_col: str = "text", ids_col: str = "ids", same_col: str = "round_trip") -> DataFrame:
    """``encode``, and in ``same_col`` whether decoding the ids gives the text back; one pass over the texts."""
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    plain, names = set_aside(df)
    kept = list(names.values())
    schema = T.StructType([*plain.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("same", T.BooleanType())])
    read_from = names[text_col]

    def make():
        v = vocabulary(shared.value)

        def step(batch: pa.RecordBatch) -> dict:
            texts = [x or "" for x in batch.column(read_from).to_pylist()]
            ids = [v.encode(t) for t in texts]
            same = [v.decode(i) == t for i, t in zip(ids, texts, strict=True)]
            return {c: batch.column(c) for c in kept} | {"ids": ids, "same": same}

        return step

    given = {c: n for c, n in names.items() if c not in (ids_col, same_col)}
    made = map_batches(plain, make, schema)
    return made.select(*brought_back(given), F.col("ids").alias(ids_col), F.col("same").alias(same_col))


def count_ids(ids_col: str = "ids") -> F.Column:
    return (F.octet_length(ids_col) / 4).cast("long")
