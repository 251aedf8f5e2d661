"""Token ids of documents in binary shards that can be read in part.

A shard holds the ids of documents of one range of doc_ids, ascending, as little-endian unsigned 32-bit integers:

* independent Zstandard frames of about ``FRAME_BYTES`` of ids each; a long document goes on in the next frame,
* a skippable frame with the directory: doc_id and number of tokens per document (a compressed Arrow stream),
* a skippable frame with the seek table of the public seekable format: compressed size, size and checksum (low
  32 bits of XXH64 of the content) per frame, then the number of frames and a magic number.

A reader takes the seek table from the end, finds its documents in the directory and decompresses only the frames
that hold them; a frame whose checksum differs is an error. Any Zstandard tool unpacks a shard to its plain ids.

Documents are range-partitioned by id, so shards follow each other in order; a task writes its shard as it encodes
and keeps one frame in memory. A shard appears under its name when it is complete, so a repeated task does no harm.

Names of special tokens that stand in a text are taken as the tokenizer library takes them: as the special token.
Null and empty texts have the end id only. Rows that repeat an id are all kept, ordered by text; a null id comes
first. An empty table gives no shard. Only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.llm.files import new_file, open_file

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
FRAME_BYTES = 1 << 20
CACHE_UNITS = 1_000_000  # what a worker keeps; beyond that it starts anew
STEP_BYTES = 1 << 21  # text that is encoded at once
WORD_END = "</w>"  # how vocabulary entries that end a word end
SKIPPABLE, DIRECTORY, SEEKABLE = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1  # fixed values of the format
LEVEL = 3
# what bytes are: blanks end words; letters, marks and digits are plain; all else, and apostrophes, are odd
BLANK, LETTER, MARK, DIGIT, ODD = range(5)
KINDS = np.full(256, ODD, np.uint8)
KINDS[[0x20, 0x0A]] = BLANK
KINDS[0x21:0x7F] = MARK
KINDS[0x30:0x3A] = DIGIT
KINDS[0x41:0x5B] = KINDS[0x61:0x7B] = LETTER
KINDS[0x27] = ODD
# of U+00C0 to U+017F, what is no letter or does not become one letter in lower case
ODD_LETTER = np.zeros(192, bool)
ODD_LETTER[[ord(c) - 0xC0 for c in "\u00d7\u00f7\u0130\u0149\u017f"]] = True
KNOWN = re.compile(
    b"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|\xc5[\x80-\x88\x8a-\xbe])+"
    b"|[0-9]|(?:(?!<\\|)[!-&(-/:-@\\[-`{-~])+"
).fullmatch


class WordEncoder:
    """Encodes texts with a tokenizer that drops white space, has no token across it, and lower-cases.

    Texts are cut at blanks and line ends into words, and words of plain characters (``KINDS``) into units: runs of
    letters, runs of marks and single digits, which the tokenizer's own pattern separates too. A word with anything else,
    an apostrophe or the name of a special token is one unit. Equal units of a batch are brought together before
    anything is looked up, and a unit is encoded once for as long as the cache holds it. Many plain units are encoded as
    one text: each is a word to the tokenizer, and the last id of a word tells where it ends.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(1 + max(names.values()), bool)
        self.ends_word[[n for name, n in names.items() if name.endswith(WORD_END)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.counts = self.ids = np.zeros(0, np.int64)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        content = [text.encode() for text in texts]
        if any(len(c) > STEP_BYTES for c in content):
            return [b"".join(self._encode([part.encode()])[0] for part in _parts(text)) for text in texts]
        return self._encode(content)

    def _encode(self, content: list[bytes]) -> list[bytes]:
        different, which, ends = _units(content)
        if len(self.known) > CACHE_UNITS:
            self._forget()
        if new := [unit for unit in different if unit not in self.known]:
            self._learn(new)
        numbers = np.fromiter(map(self.known.__getitem__, different), np.int64, len(different))[which]
        counts = self.counts[numbers]
        done = np.append(0, np.cumsum(counts))
        starts = np.cumsum(self.counts) - self.counts
        places = np.repeat(starts[numbers] - done[:-1], counts) + np.arange(done[-1])
        ids = self.ids[places].astype("<u4").tobytes()
        bounds = [0, *(4 * done[ends]).tolist()]
        return [ids[start:end] for start, end in zip(bounds, bounds[1:])]

    def _learn(self, units: list[bytes]) -> None:
        plain, odd = [], []
        for unit in units:
            (plain if KNOWN(unit) else odd).append(unit)
        texts = [b" ".join(plain[at : at + 1000]).decode() for at in range(0, len(plain), 1000)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.int64)
        counts = np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1)
        if len(counts) != len(plain):
            raise ValueError("a run of letters or marks is not one word to this tokenizer")
        lists = [e.ids for e in self.tokenizer.encode_batch_fast([u.decode() for u in odd], add_special_tokens=False)]
        more = np.fromiter(map(len, lists), np.int64, len(lists))
        for unit in chain(plain, odd):
            self.known[unit] = len(self.known)
        self.counts = np.concatenate([self.counts, counts, more])
        self.ids = np.concatenate([self.ids, ids, np.fromiter(chain.from_iterable(lists), np.int64)])


def _parts(text: str) -> Iterator[str]:
    """A long text in parts that end before a blank; a word is never cut."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + STEP_BYTES // 2)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end + 1


def _units(content: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Different units, the unit at each place, and the number of places up to the end of each text."""
    joined = b"\n".join(content) + b"\n"
    byte = np.frombuffer(joined, np.uint8)
    kinds = KINDS[byte]
    # letters of two bytes: a first byte of some and its second; single ones are excepted
    lead = np.flatnonzero((byte >= 0xC3) & (byte <= 0xC5))
    letter = ~ODD_LETTER[(byte[lead].astype(np.int64) - 0xC3) * 64 + (byte[lead + 1] & 0x3F)]
    kinds[lead[letter]] = kinds[lead[letter] + 1] = LETTER
    special = np.flatnonzero((byte[:-1] == 0x3C) & (byte[1:] == 0x7C))  # how names of special tokens begin
    kinds[special] = ODD
    blank = kinds == BLANK
    inside = ~blank
    word_starts = inside.copy()
    word_starts[1:] &= blank[:-1]
    word = np.cumsum(word_starts)
    odd_words = np.zeros(int(word[-1]) + 1, bool)
    odd_words[word[kinds == ODD]] = True
    changes = np.append(True, kinds[1:] != kinds[:-1]) | (kinds == DIGIT)
    starts = word_starts | (inside & changes & ~odd_words[word])
    kept = byte[inside]
    offsets = np.append(np.flatnonzero(starts[inside]), len(kept))
    units = pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(kept)]
    ).dictionary_encode()
    text_ends = np.cumsum([len(c) + 1 for c in content]) - 1
    done = np.cumsum(starts)
    return units.dictionary.to_pylist(), units.indices.to_numpy(), done[text_ends]


_worker: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker; tasks that follow each other share its cache."""
    if path not in _worker:
        _worker[path] = WordEncoder(path)
    return _worker[path]


class FrameWriter:
    """Writes one shard to an open file."""

    def __init__(self, out, id_type: pa.DataType, frame_bytes: int = FRAME_BYTES):
        self.out, self.frame_bytes, self.id_type = out, frame_bytes, id_type
        self.pack = zstandard.ZstdCompressor(level=LEVEL)
        self.rest = bytearray()
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list = []
        self.tokens: list[int] = []

    def add(self, doc_id, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.tokens.append(len(ids) // 4)
        self.rest += ids
        while len(self.rest) >= self.frame_bytes:
            self._flush(self.frame_bytes)

    def _flush(self, size: int) -> None:
        content = bytes(self.rest[:size])
        del self.rest[:size]
        packed = self.pack.compress(content)
        self.out.write(packed)
        self.frames.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.rest:
            self._flush(len(self.rest))
        stream = pa.BufferOutputStream()
        table = pa.table({"id": pa.array(self.ids, self.id_type), "tokens": pa.array(self.tokens, pa.int64())})
        with pa.ipc.new_stream(stream, table.schema) as writer:
            writer.write_table(table)
        directory = self.pack.compress(stream.getvalue().to_pybytes())
        self.out.write(struct.pack("<II", DIRECTORY, len(directory)) + directory)
        entries = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)


class FrameReader:
    """Reads documents of one shard; decompresses only the frames that hold them."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        size = file.size()
        frames, kind, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or not kind & 0x80:
            raise ValueError("not a shard of token ids with checksums")
        end = size - 9 - 12 * frames
        table = np.frombuffer(self._at(end, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.checks = np.cumsum(np.append(0, table[:, 0])), table[:, 2]
        self.content = np.cumsum(np.append(0, table[:, 1]))
        mark, length = struct.unpack("<II", self._at(int(self.packed[-1]), 8))
        if mark != DIRECTORY:
            raise ValueError("the shard has no directory")
        directory = zstandard.decompress(self._at(int(self.packed[-1]) + 8, length))
        documents = pa.ipc.open_stream(directory).read_all()
        self.ids = documents.column("id")
        self.ends = np.cumsum(np.append(0, documents.column("tokens").to_numpy()))
        self.frames_read = 0

    def _at(self, offset: int, length: int) -> bytes:
        return self.file.read_at(length, offset)

    def _frame(self, n: int) -> bytes:
        packed = self._at(int(self.packed[n]), int(self.packed[n + 1] - self.packed[n]))
        content = zstandard.decompress(packed)
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.checks[n]:
            raise ValueError(f"frame {n} has a wrong checksum")
        self.frames_read += 1
        return content

    def documents(self, places: Sequence[int] | None = None) -> Iterator[tuple[int, bytes]]:
        """Place and ids of the documents at ``places`` (ascending), or of all; one frame is held at a time."""
        held, content = -1, b""
        for place in range(len(self.ids)) if places is None else places:
            start, end = int(self.ends[place]) * 4, int(self.ends[place + 1]) * 4
            parts = []
            n = int(np.searchsorted(self.content, start, side="right")) - 1
            while start < end:
                if n != held:
                    held, content = n, self._frame(n)
                base = int(self.content[n])
                parts.append(content[start - base : end - base])
                start = min(end, base + len(content))
                n += 1
            yield place, b"".join(parts)


def write_shards(
    documents: DataFrame,
    path: str,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    frame_bytes: int = FRAME_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode every whole text and write the shards and their list (``path/shards``) in ascending order of ids."""
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((batch for batch in batches if batch.num_rows), None)
        if first is None:
            return
        shard = TaskContext.get().partitionId()
        name = f"{path}/ids/{shard:08d}.zst"
        encoder = word_encoder(vocabulary)
        with new_file(name) as out:
            writer = FrameWriter(out, first.schema.field(0).type, frame_bytes)
            for batch in _chain(first, batches):
                for some in _steps(batch):
                    texts = encoder.encode([text or "" for text in some.column(1).to_pylist()])
                    for doc_id, ids in zip(some.column(0).to_pylist(), texts, strict=True):
                        writer.add(doc_id, ids + end)
            writer.close()
        row = {"shard": [shard], "file": [name], "documents": [len(writer.ids)], "tokens": [sum(writer.tokens)]}
        yield pa.RecordBatch.from_pydict(row, SHARDS)

    rows = documents.select(documents[id_column].alias("id"), documents[text_column].alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    shards = ordered.mapInArrow(run, "shard long, file string, documents long, tokens long")
    shards.write.mode("overwrite").parquet(f"{path}/shards")


SHARDS = pa.schema({"shard": pa.int64(), "file": pa.string(), "documents": pa.int64(), "tokens": pa.int64()})


def _steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in steps of about ``STEP_BYTES`` of text."""
    size = np.cumsum([len(text or "") for text in batch.column(1).to_pylist()])
    edges = np.flatnonzero(np.diff(size // STEP_BYTES, prepend=-1)).tolist()
    for start, end in zip(edges, [*edges[1:], batch.num_rows], strict=True):
        yield batch.slice(start, end - start)


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def read_shards(
    spark: SparkSession, path: str, id_column: str = "doc_id", id_type: str = "bigint", only: Sequence | None = None
) -> DataFrame:
    """Id, ``start`` (tokens of all documents before it) and ``ids`` (binary) of every document, or of ``only`` some.

    There is one row per shard in the list of shards; a task reads one shard.
    """
    shards = spark.read.parquet(f"{path}/shards")
    count = max(1, shards.count())
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    wanted = None if only is None else set(only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_file(name) as file:
                    reader = FrameReader(file)
                    keys = reader.ids.to_pylist()
                    places = None if wanted is None else [n for n, key in enumerate(keys) if key in wanted]
                    part, size = [], 0
                    for place, ids in reader.documents(places):
                        part.append((keys[place], base + int(reader.ends[place]), ids))
                        size += len(ids)
                        if size > 4 * FRAME_BYTES:
                            yield _rows(part, reader.ids.type)
                            part, size = [], 0
                    if part:
                        yield _rows(part, reader.ids.type)

    numbered = shards.select("shard", "file", F.coalesce(before, F.lit(0)).alias("base"))
    dealt = numbered.repartitionById(count, F.col("shard").cast("int")).select("file", "base")
    found = dealt.mapInArrow(run, f"id {id_type}, start bigint, ids binary")
    return found.withColumnRenamed("id", id_column)


def _rows(part: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    ids, starts, content = zip(*part, strict=True)
    columns = [pa.array(ids, id_type), pa.array(starts, pa.int64()), pa.array(content, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["id", "start", "ids"])
