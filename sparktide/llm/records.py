"""Token ids in length-delimited binary records with a separate offset index.

A record file is a run of frames

    length    8 bytes, unsigned, little-endian: bytes of the payload
    check     4 bytes: masked CRC-32 of the length's bytes
    payload   key (8 bytes, signed), width of an id (1 byte), ids
    check     4 bytes: masked CRC-32 of the payload

A checksum is masked (rotated by 15 bits plus a constant) so that checksums of
data that holds checksums stay good. Ids take 2 bytes where the vocabulary allows.

Rows are range-partitioned by key and sorted, one file per partition, so the files
in order of their number hold all records in ascending key order. The index is a
Parquet table with the file, offset and length of every record. It names the files
of finished tasks only: an attempt that was lost leaves a file no index row points
to. Readers go through the index, so records can be read in any order.

Defined results: a null text is empty, a null key is smaller than all others, rows
with equal keys stand next to each other, an empty table gives an empty index. A
damaged record raises ``ValueError``.
"""

from __future__ import annotations

import codecs
import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktide.llm.bpe import CUT, WINDOW, _with_lists, byte_alphabet, pieces, read_vocabulary, vocabulary
from sparktide.llm.common import map_batches, ordered, text_of
from sparktide.workspace import new_path

_HEAD, _KEY = struct.Struct("<QI"), struct.Struct("<qB")
# Fixed: the constant of the masked checksum.
_MASK = 0xA282EAD8

#: Words whose ids a worker remembers, in each of two generations, and the longest of them in bytes.
REMEMBERED = 300_000
KEPT = 64

#: Characters of texts that are cut and looked up at once.
GROUP = 4 * WINDOW

# Bytes beyond those of ASCII and the letters of Latin-1, whose class is the same in every library.
_OTHERS = re.compile(rb"[^\t\n\r -~\x80-\x96\x98-\xb6\xb8-\xbf\xc3]")
_LETTER, _DIGIT, _MARK, _BLANK, _SPACE = range(1, 6)
_KIND = np.array(
    [
        _LETTER if b > 127 or chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _BLANK if b == 32 else _SPACE if b in b"\t\n\r" else _MARK
        for b in range(256)
    ],
    np.uint8,
)
_CONTRACTED = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
# No UTF-8 has this byte; between words that are written in the byte-level alphabet it is a blank.
_BETWEEN = b"\xff"
_BYTE_LEVEL = "".join(sorted(byte_alphabet(), key=byte_alphabet().get))[:255] + " "

INDEX = "shard int, ordinal long, file string, offset long, length long, key long, n_tokens long"


def masked_crc(raw: bytes) -> int:
    crc = zlib.crc32(raw)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(key: int, ids: bytes, width: int) -> bytes:
    """The frame of packed 32-bit ids."""
    if width == 2:
        ids = np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    payload = _KEY.pack(key, width) + ids
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked_crc(length)) + payload + struct.pack("<I", masked_crc(payload))


def unframe(raw: bytes) -> tuple[int, bytes]:
    """Key and packed 32-bit ids of one whole frame, its checksums verified."""
    if len(raw) < _HEAD.size + 4:
        raise ValueError("a record is cut short")
    length, check = _HEAD.unpack_from(raw)
    payload = raw[_HEAD.size : -4]
    if check != masked_crc(raw[:8]) or length != len(payload):
        raise ValueError("the length of a record is damaged")
    if struct.unpack("<I", raw[-4:])[0] != masked_crc(payload):
        raise ValueError("the payload of a record is damaged")
    key, width = _KEY.unpack_from(payload)
    ids = payload[_KEY.size :]
    return key, np.frombuffer(ids, "<u2").astype("<u4").tobytes() if width == 2 else ids


class LibraryEncoder:
    """Whole texts by the tokenizers library, each distinct word of recent texts once.

    A word is a pre-token where the text has only characters that every library puts
    into the same class; else it is a piece between single blanks. The words of a group
    of texts are coded by Arrow and looked up once; two generations of them are
    remembered, so that those in use survive when a table is full.

    A word longer than a window goes through the streaming transducer, whose ids
    are the same and whose memory doesn't grow with the piece.
    """

    def __init__(self, text: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self._young: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}
        self._text = text
        self._library = Tokenizer.from_str(text)
        self._library.no_truncation()
        self._library.no_padding()
        # The same model for words that are cut and written in the byte-level alphabet already.
        self._model = Tokenizer.from_str(text)
        self._model.no_truncation()
        self._model.no_padding()
        self._model.pre_tokenizer = WhitespaceSplit()
        # A byte-level token has a character per byte, an added one its own text.
        self._bytes_in = np.zeros(1 + max(self._library.get_vocab().values()), np.int64)
        for token, i in self._library.get_vocab().items():
            self._bytes_in[i] = len(token)
        self._added = []
        for i, token in self._library.get_added_tokens_decoder().items():
            self._bytes_in[i] = len(token.content.encode())
            self._added.append(token.content.encode())
        spec = json.loads(text)
        steps = spec.get("pre_tokenizer") or {}
        self._by_pattern = (
            steps.get("type") == "ByteLevel"
            and steps.get("use_regex", True)
            and not steps.get("add_prefix_space")
            and not spec.get("normalizer")
        )

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of pre-tokens, given to the library's model as one text with a blank between two of them."""
        raw = _BETWEEN.join(words)
        (encoded,) = self._model.encode_batch_fast([codecs.charmap_decode(raw, "strict", _BYTE_LEVEL)[0]], add_special_tokens=False)
        ids = np.array(encoded.ids, "<u4")
        ends = np.cumsum(self._bytes_in[ids])
        wanted = np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) == _BETWEEN[0]), len(raw)) - np.arange(len(words))
        at = np.searchsorted(ends, wanted)
        if (ends[np.minimum(at, len(ends) - 1)] != wanted).any():
            raise ValueError("a token reaches over the end of a word")
        made, cuts = ids.tobytes(), [0, *(4 * (at + 1)).tolist()]
        return [made[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces that aren't pre-tokens, or of pre-tokens longer than a window."""
        short = [p for p in pieces if len(p) <= WINDOW]
        encoded = self._library.encode_batch_fast([p.decode() for p in short], add_special_tokens=False)
        made = {p: array("I", e.ids).tobytes() for p, e in zip(short, encoded, strict=True)}
        return [made[p] if p in made else vocabulary(self._text).encode(p.decode()) for p in pieces]

    def _plain(self, text: bytes) -> bool:
        """Whether ``pre_tokens`` cuts a text as the library does."""
        return self._by_pattern and not _OTHERS.search(text) and not any([a in text for a in self._added])

    def _units(self, text: str) -> list[bytes]:
        """The text in parts that ``pre_tokens`` cuts or that are a word each."""
        whole = text.encode()
        return [whole] if self._plain(whole) else [p.encode() for p in CUT.split(text)]

    def _look_up(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words, from what is remembered or from the library."""
        if len(self._young) + len(words) > REMEMBERED:
            self._young, self._old = {}, self._young
        found = dict(zip(words, map(self._young.get, words), strict=True))
        missing = [w for w, ids in found.items() if ids is None]
        fresh = dict(zip(missing, map(self._old.get, missing), strict=True))
        unknown = [w for w, ids in fresh.items() if ids is None]
        plain = unknown
        if not self._plain(b" ".join(unknown)) or max(map(len, unknown), default=0) > WINDOW:
            plain = [w for w in unknown if len(w) <= WINDOW and self._plain(w)]
        if plain:
            fresh.update(zip(plain, self._encode_words(plain), strict=True))
        others = [w for w in unknown if fresh[w] is None]
        if others:
            fresh.update(zip(others, self._encode_pieces(others), strict=True))
        self._young.update(fresh)
        for w in [w for w in fresh if len(w) > KEPT]:
            del self._young[w]
        found.update(fresh)
        return list(found.values())

    def _ids(self, texts: list[list[bytes]]) -> list[bytes]:
        """The ids of texts from their units; equal words are looked up once."""
        units = [u for text in texts for u in text]
        raw = b"".join(units)
        if not raw:
            return [b""] * len(texts)
        ends = np.cumsum([0, *map(len, units)])
        starts = pre_tokens(raw, ends[:-1])
        if not self._plain(raw):
            for u, a, b in zip(units, ends.tolist(), ends[1:].tolist(), strict=False):
                if not self._plain(u):
                    starts[a + 1 : b] = False
        cuts = np.append(np.flatnonzero(starts), len(raw)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(raw)])
        coded = words.dictionary_encode()
        ids = pa.array(self._look_up(coded.dictionary.to_pylist()), pa.binary()).take(coded.indices)
        bounds = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset :]
        packed = memoryview(ids.buffers()[2] or b"")
        of_text = ends[np.cumsum([0, *map(len, texts)])]
        at = bounds[np.searchsorted(cuts, of_text)].tolist()
        return [bytes(packed[a:b]) for a, b in zip(at, at[1:], strict=False)]

    def _long_text(self, text: str) -> bytes:
        """The ids of a text longer than a group, some pieces at a time."""
        made = []
        for group in _groups(pieces(text), GROUP):
            if len(group[0]) > GROUP:
                made.append(vocabulary(self._text).encode(group[0]))
            else:
                made += self._ids([[p.encode() for p in group]])
        return b"".join(made)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The packed ids of texts, a group of them at a time."""
        made: list[bytes] = []
        for group in _groups(texts, GROUP):
            if len(group[0]) > GROUP:
                made.append(self._long_text(group[0]))
            else:
                made += self._ids([self._units(t) for t in group])
        return made

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def pre_tokens(raw: bytes, firsts: np.ndarray) -> np.ndarray:
    """Where the byte-level pre-tokenizer's pattern starts a token in texts of plain characters that start at ``firsts``.

    Texts are runs of letters, digits and marks, each with one blank in front if there
    is one, contractions, and white space, of which the last character in front of
    anything else stands apart.
    """
    codes = np.frombuffer(raw, np.uint8)
    kind = _KIND[codes]
    first = np.zeros(len(raw) + 3, bool)
    first[firsts] = True
    first[len(raw) :] = True
    before, after = np.roll(kind, 1), np.roll(kind, -1)
    space = kind >= _BLANK
    last = (after < _BLANK) & ~first[1 : len(raw) + 1]
    starts = np.zeros(len(raw) + 3, bool)
    starts[: len(raw)] = np.where(space, (before < _BLANK) | last, (kind != before) & (before != _BLANK)) | first[: len(raw)]
    quotes = np.flatnonzero((codes == ord("'")) & starts[: len(raw)])
    for at in quotes.tolist():
        for end in _CONTRACTED:
            stop = at + 1 + len(end)
            if raw[at + 1 : stop] == end and not first[at + 1 : stop].any():
                starts[at + 1 : stop] = False
                starts[stop] = True
                break
    return starts[: len(raw)]


def _groups(texts: Iterable[str], most: int) -> Iterator[list[str]]:
    """Texts in order, in groups of at most ``most`` characters; a longer one is its own group."""
    group: list[str] = []
    size = 0
    for text in texts:
        if group and size + len(text) > most:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


@lru_cache(maxsize=2)
def _library(text: str) -> LibraryEncoder:
    return LibraryEncoder(text)


def library_ids(df: DataFrame, vocabulary_path: str, text_col: str = "text", ids_col: str = "ids", end_id: int | None = None) -> DataFrame:
    """``df`` with the library's ids of each text, packed, and ``end_id`` after them."""
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    tail = b"" if end_id is None else struct.pack("<I", end_id)

    def make():
        library = _library(shared.value)
        return lambda texts: [ids + tail for ids in library.encode_all(texts)]

    return _with_lists(df, text_of(text_col), ids_col, T.BinaryType(), make)


def in_order(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, text) in range partitions of ascending key, each sorted."""
    rows = df.select(ordered(F.col(id_col).cast("long")).alias("key"), text_of(text_col).alias("text"))
    tie = F.xxhash64("text")
    return rows.repartitionByRange("key", tie).sortWithinPartitions("key", tie)


def id_width(vocabulary_path: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(vocabulary_path).get_vocab_size() <= 65_536 else 4


def write_records(rows: DataFrame, width: int, path: str) -> DataFrame:
    """Write (key, ids) partition by partition under ``path``; returns the written index."""

    def run(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        store, folder = fs.FileSystem.from_uri(f"{path}/records")
        store.create_dir(folder, recursive=True)
        shard = TaskContext.get().partitionId()
        name = f"{shard:06d}-{uuid.uuid4().hex}.rec"
        offset = ordinal = 0
        out = None
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or store.open_output_stream(f"{folder}/{name}", buffer_size=1 << 20)
            made = {n: [] for n in ("offset", "length", "n_tokens")}
            keys = batch.column("key").to_pylist()
            for key, ids in zip(keys, batch.column("ids"), strict=True):
                ids = ids.as_py()
                framed = frame(key, ids, width)
                out.write(framed)
                for n, v in (("offset", offset), ("length", len(framed)), ("n_tokens", len(ids) // 4)):
                    made[n].append(v)
                offset += len(framed)
            n = len(keys)
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard] * n, pa.int32()),
                    "ordinal": pa.array(range(ordinal, ordinal + n), pa.int64()),
                    "file": pa.array([name] * n),
                    "offset": pa.array(made["offset"], pa.int64()),
                    "length": pa.array(made["length"], pa.int64()),
                    "key": pa.array(keys, pa.int64()),
                    "n_tokens": pa.array(made["n_tokens"], pa.int64()),
                }
            )
            ordinal += n
        if out:
            out.close()

    spark = rows.sparkSession
    rows.select("key", "ids").mapInArrow(run, INDEX).write.parquet(f"{path}/index")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def read_records(index: DataFrame, path: str) -> DataFrame:
    """The records of index rows in the order they come: shard, ordinal, key, packed 32-bit ids."""
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("ordinal", T.LongType()),
            T.StructField("key", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def make():
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(f"{path}/records")
        opened: dict = {}

        def step(batch: pa.RecordBatch) -> dict:
            made = {"shard": batch.column("shard"), "ordinal": batch.column("ordinal"), "key": [], "ids": []}
            for name, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                if name not in opened:
                    if len(opened) >= 16:
                        opened.pop(next(iter(opened))).close()
                    opened[name] = store.open_input_file(f"{folder}/{name}")
                key, ids = unframe(opened[name].read_at(length, offset))
                made["key"].append(key)
                made["ids"].append(ids)
            return made

        return step

    return map_batches(index.select("shard", "ordinal", "file", "offset", "length"), make, schema)


def by_shard(index: DataFrame) -> DataFrame:
    """Index rows for reading front to back: a file's records in order in one task."""
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    return index.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "ordinal")


def shuffled(index: DataFrame, parts: int, seed: int) -> DataFrame:
    """Index rows dealt to ``parts`` tasks and ordered there by a seeded hash; only index rows are shuffled."""
    mixed = F.xxhash64(F.lit(seed), "shard", "ordinal")
    return index.repartition(parts, mixed).sortWithinPartitions(F.xxhash64(F.lit(seed + 1), "shard", "ordinal"))


def starts(read: DataFrame) -> DataFrame:
    """Written rows (shard, ordinal, n_tokens, ...) with ``start``: ids of all records in front."""
    before = Window.partitionBy("shard").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    files = read.groupBy("shard").agg(F.sum("n_tokens").alias("_ids"))
    over = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("shard", F.coalesce(F.sum("_ids").over(over), F.lit(0)).alias("_front"))
    inside = read.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return inside.join(files, "shard").withColumn("start", (F.col("start") + F.col("_front")).cast("long")).drop("_front")


def write_documents(df: DataFrame, vocabulary_path: str, path: str | None = None, end_id: int | None = None) -> tuple[DataFrame, str]:
    """Encode whole texts and write them in ascending id order; the index and the folder."""
    path = path or new_path(df.sparkSession, "token_records")
    encoded = library_ids(in_order(df), vocabulary_path, end_id=end_id)
    return write_records(encoded, id_width(vocabulary_path), path), path
