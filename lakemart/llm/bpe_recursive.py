"""Byte-level BPE: recursive DuckDB queries encode and decode the text of each partition.

Tokens that the split pattern finds are *words*. A word starts as one row per byte and position. Every turn of
the recursive query joins the rows with the merge table, takes each word's leftmost pair of least rank and
contracts it, until no word has a pair left to merge. Decoding joins the ids with the byte strings of the
vocabulary and adds them up in order.

Text is cut before a space that follows a plain character; no match of the pattern crosses such a place, so equal
pieces have equal tokens wherever they are, and a piece that repeats within a slice is looked up once. A Python worker encodes a word once for as long
as its bounded cache holds it. No row leaves its partition: there is no shuffle.

Null and empty texts have no tokens. Rows that repeat are encoded like any other; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

RANKS = "byte_bpe_50k.tiktoken"
CACHE_WORDS = 500_000  # words a worker keeps; beyond that it starts anew
SLICE_CHARS = 2_000_000  # text taken at a time
RUN = 128  # tokens that one aggregate decodes
NAMES = ["__id", "ids", "decoded", "same"]

# A turn makes one row per token position of the words that are not finished, joins it with the merge table and
# contracts the leftmost pair of least rank; a word without such a pair has its final ids in its last turn.
ENCODE = """
WITH RECURSIVE state(turn, word, ids) AS (
    SELECT 0, word, ids FROM bytes
  UNION ALL (
    WITH token AS (
        SELECT word, unnest(ids[:-2]) AS id, unnest(ids[2:]) AS next, generate_subscripts(ids[2:], 1) AS place FROM state
    ), best AS (
        SELECT word, min(merges.id::BIGINT << 32 | token.place) AS best
        FROM token JOIN merges ON merges.pair = (token.id::BIGINT << 32 | token.next)
        GROUP BY word
    )
    SELECT turn + 1, word, list_concat(
        list_append(ids[:(best & 4294967295) - 1], (best >> 32)::INTEGER), ids[(best & 4294967295) + 2:])
    FROM state JOIN best USING (word)
  )
)
SELECT word, arg_max(ids, turn) AS ids FROM state GROUP BY word ORDER BY word
"""

DECODE = """
SELECT run, array_to_string(list(vocabulary.text ORDER BY tokens.place), '') AS text
FROM tokens JOIN vocabulary USING (id) GROUP BY run ORDER BY run
"""


@lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}


def _merges(ranks: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """Every way to cut a token into two tokens: both ids in one number, and the id they merge into."""
    pairs, ids = [], []
    for word, rank in ranks.items():
        for cut in range(1, len(word)):
            left, right = ranks.get(word[:cut]), ranks.get(word[cut:])
            if left is not None and right is not None:
                pairs.append(left << 32 | right)
                ids.append(rank)
    return pairs, ids


def _pieces(content: list[bytes]) -> tuple[list[bytes], pa.Array, np.ndarray]:
    """Different pieces, the piece at each place, and the number of places up to the end of each text.

    A piece begins with a text, or with a space behind a printable ASCII character or a letter from U+00C0 to U+00FF.
    """
    joined = b"".join(content)
    byte = np.frombuffer(joined, np.uint8)
    starts = np.zeros(len(byte) + 1, bool)
    before = byte[1:-1]
    plain = (before >= 0x21) & (before <= 0x7E) | (byte[:-2] == 0xC3)  # 0xC3 leads U+00C0 to U+00FF
    starts[2:-1] = plain & (byte[2:] == 0x20)
    ends = np.cumsum([len(c) for c in content])
    starts[0] = True
    starts[ends] = True
    offsets = np.flatnonzero(starts)
    found = pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(joined)]
    ).dictionary_encode()
    return found.dictionary.to_pylist(), found.indices, np.searchsorted(offsets, ends)


class RecursiveBpe:
    """Encoder and decoder of one Python worker; its tables are in memory and hold one slice at a time."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        ranks = _ranks(path)
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.words: dict[str, bytes] = {}
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        pairs, ids = _merges(ranks)
        merges = pa.table({"pair": pa.array(pairs, pa.int64()), "id": pa.array(ids, pa.int32())})
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merges")
        # bytes travel as text with one character per byte, because string_agg joins text
        words = sorted((rank, word.decode("latin-1")) for word, rank in ranks.items())
        vocabulary = pa.table({"id": pa.array([r for r, _ in words], pa.int32()), "text": [w for _, w in words]})
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary")
        del merges, vocabulary

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word by the recursive query, as little-endian 32-bit integers."""
        edges = np.zeros(len(words) + 1, dtype=np.int32)
        np.cumsum([len(word) for word in words], out=edges[1:])
        ids = pa.array(self.byte_ids[np.frombuffer(b"".join(words), np.uint8)])
        rows = {"word": pa.array(np.arange(len(words), dtype=np.int32)), "ids": pa.ListArray.from_arrays(edges, ids)}
        found = self._ask(ENCODE, "bytes", rows).column("ids").combine_chunks()
        ends, flat = (found.offsets.to_numpy() * 4).tolist(), found.values.to_numpy().astype("<i4").tobytes()
        return [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def _ask(self, query: str, name: str, rows: dict[str, pa.Array]) -> pa.Table:
        self.con.register(name, pa.table(rows))
        try:
            return self.con.sql(query).to_arrow_table()
        finally:
            self.con.unregister(name)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; pieces that repeat are looked up once."""
        pieces, which, ends = _pieces([text.encode() for text in texts])
        split = [self.pattern.findall(piece.decode()) for piece in pieces]
        if len(self.words) > CACHE_WORDS:
            self.words = {}
        if new := list(set(chain.from_iterable(split)) - self.words.keys()):
            self.words.update(zip(new, self.encode_words([word.encode() for word in new]), strict=True))
        word = self.words.__getitem__
        ids = pa.array([b"".join(map(word, found)) for found in split], pa.large_binary()).take(which)
        if not len(ids):
            return [b""] * len(texts)
        bounds = np.frombuffer(ids.buffers()[1], np.int64)[: len(ids) + 1][np.append(0, ends)].tolist()
        content = memoryview(ids.buffers()[2] or b"")
        return [bytes(content[start:end]) for start, end in zip(bounds, bounds[1:], strict=False)]

    def decode(self, documents: list[bytes]) -> list[bytes]:
        """Bytes of each document's ids: tokens join the vocabulary, and runs of ``RUN`` tokens are put in order."""
        lengths = np.array([len(ids) // 4 for ids in documents], dtype=np.int64)
        ids = np.frombuffer(b"".join(documents), "<i4")
        if not len(ids):
            return [b""] * len(documents)
        runs = -(-lengths // RUN)
        place = np.arange(len(ids))
        within = place - np.repeat(np.cumsum(lengths) - lengths, lengths)
        run = within // RUN + np.repeat(np.cumsum(runs) - runs, lengths)
        rows = {"run": run.astype(np.int32), "place": place.astype(np.int32), "id": ids}
        texts = self._ask(DECODE, "tokens", {k: pa.array(v) for k, v in rows.items()}).column("text").to_pylist()
        ends = np.cumsum(runs).tolist()
        return ["".join(texts[a:b]).encode("latin-1") for a, b in zip([0, *ends], ends, strict=False)]


_worker: dict[tuple[str, str], RecursiveBpe] = {}


def codec(path: str, pattern: str = public_tokenizers.PATTERN) -> RecursiveBpe:
    """The codec of this Python worker; tasks that follow each other share its tables and its words."""
    if (path, pattern) not in _worker:
        _worker[path, pattern] = RecursiveBpe(path, pattern)
    return _worker[path, pattern]


def slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Texts in order, some at a time; a text longer than ``most`` comes alone."""
    part, chars = [], 0
    for text in texts:
        if part and chars + len(text) > most:
            yield part
            part, chars = [], 0
        part.append(text)
        chars += len(text)
    if part:
        yield part


def _lists(documents: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0, *[len(ids) // 4 for ids in documents]]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(documents), "<i4")))


def round_trip(
    documents: DataFrame,
    ranks_path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id_column``, ``ids`` (array of int), ``decoded`` (binary) and ``same`` (``decoded`` is the text) of every text."""
    path = ranks_path or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            at = 0
            for texts in slices([text or "" for text in batch.column(1).to_pylist()]):
                ids = bpe.encode(texts)
                decoded = bpe.decode(ids)
                same = [found == text.encode() for found, text in zip(decoded, texts, strict=True)]
                columns = [_lists(ids), pa.array(decoded, pa.binary()), pa.array(same)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *columns], NAMES)
                at += len(texts)

    source = documents.select(documents[id_column].alias(NAMES[0]), documents[text_column].alias("text"))
    kind = source.schema[NAMES[0]].dataType.simpleString()
    found = source.mapInArrow(run, f"{NAMES[0]} {kind}, ids array<int>, decoded binary, same boolean")
    return found.withColumnRenamed(NAMES[0], id_column)
