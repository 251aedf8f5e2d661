"""Alignment of two tokenizers by inverted pair bitmaps.

Tokens of both tokenizers over the same bytes are linked where their byte ranges overlap. Offsets where tokens of both end
cut the text into groups. The corpus tells how usual a pair of ids is: its count is the number of documents that
hold it linked.

* A task takes its documents in chunks of at most ``CHUNK_DOCUMENTS`` rows and about ``CHUNK_BYTES`` of text. Of each pair
  of ids it writes a compressed bitmap of the chunk's documents: sorted 16-bit numbers, or plain bits where those are
  shorter. A chunk is encoded in steps of about ``STEP_BYTES`` whose documents are OR-merged per pair; chunks hold
  different documents.
* A pair linked m times in a document has m - 1 in *multiplicity planes*: plane p is the bitmap of documents whose m - 1
  has bit p - 1. Plane 0 is the bitmap of all.
* Popcounts of plane 0 add up to document counts, those of the planes to link counts (``pair_counts``).
* Postings return the scores: every bitmap meets the count of its pair, goes to its chunk, and there count times
  multiplicity is added to each of its documents.

So no row per document and pair is shuffled. A pair has one entry per chunk and plane, however usual it is; a chunk
is bounded. The index is one written table that holds the documents' own figures too, so both come from the same run.

Both tokenizers meet a text in units that start at a blank behind an ASCII or Latin-1 letter, digit or mark. Neither has a
token across such a place (for the piece model this is tested when it is loaded; otherwise units are whole texts), so
the units' ids are the text's ids, and units that repeat within a chunk are encoded once.

Null and empty texts, and those whose tokens of either kind do not give the text's bytes back, have no tokens: all
figures are 0 and ``groups`` is empty. Rows that repeat an id are documents of their own. Rows with a null id are kept.
An empty table gives no rows. Only the id and text columns are read, so others cannot clash. A very long text is
encoded whole, in one task.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemart.session import new_table_path

BYTE_VOCABULARY, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_BYTES, CHUNK_DOCUMENTS = 8 << 20, 1 << 16
STEP_BYTES = 1 << 20  # text that is encoded at once
LONG_UNIT = 4096  # bytes; longer units go to the slower library, whose pattern matcher has no depth limit
BLANK = "▁"  # how pieces spell a blank


class BytePairs:
    """The byte-level vocabulary: ids of a unit, and the bytes of every id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True  # their names in a text are ordinary text
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        shown = _shown_bytes()
        ranks = {bytes(map(shown.__getitem__, entry)): n for entry, n in model["vocab"].items()}
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        # the fast library takes ids for ranks, which holds if merges come in the order of their ids
        ordered = [model["vocab"][m] for m in merged] == list(range(256, 256 + len(merged)))
        self.fast = ordered and tiktoken.Encoding(
            "ranks of the file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.spelled = [b""] * (1 + max(ranks.values()))
        for entry, n in ranks.items():
            self.spelled[n] = entry

    def encode(self, units: list[str]) -> list[list[int]]:
        if not self.fast:
            return [e.ids for e in self.slow.encode_batch_fast(units, add_special_tokens=False)]
        fast = self.fast.encode_ordinary
        return [fast(u) if len(u) < LONG_UNIT else self.slow.encode(u, add_special_tokens=False).ids for u in units]


def _shown_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for: printable ones themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Pieces:
    """The piece model: ids of a unit without its first blank, which the model adds, and the bytes of every id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(n) for n in range(len(self.model))]
        self.spelled = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(n) else name.replace(BLANK, " ").encode()
            for n, name in enumerate(names)
        ]
        inner = any(BLANK in name.lstrip(BLANK) for name in names)
        keeps = self.model.encode("a  b ", out_type=str)
        self.by_unit = not inner and "".join(keeps) == f"{BLANK}a{BLANK}{BLANK}b{BLANK}"
        self.blank = self.model.piece_to_id(BLANK)

    def encode(self, units: list[str]) -> list[list[int]]:
        found = self.model.encode([unit[1:] for unit in units], num_threads=1)
        return [ids if unit != " " else [self.blank] for unit, ids in zip(units, found, strict=True)]


class _Tokens:
    """Tokens of one kind of the units that a chunk has."""

    def __init__(self, spelled: list[bytes], found: list[list[int]], units: list[bytes]):
        self.table = pa.array(spelled, pa.large_binary())
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.counts = np.fromiter(map(len, found), np.int64, len(found))
        self.flat = np.fromiter(chain.from_iterable(found), np.int64, int(self.counts.sum()))
        self.starts = _before(self.counts)
        self.joined = _content(self.table.take(pa.array(self.flat)))
        self.ends = np.append(0, np.cumsum(self.lengths[self.flat]))[np.append(self.starts, len(self.flat))]
        self.exact = self.joined == b"".join(units)

    def spell(self, unit: int) -> bytes:
        return self.joined[self.ends[unit] : self.ends[unit + 1]]

    def of(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and byte ends of a row of units."""
        counts = self.counts[units]
        places = np.repeat(self.starts[units] - _before(counts), counts) + np.arange(counts.sum())
        ids = self.flat[places]
        return ids, np.cumsum(self.lengths[ids])


def _before(counts: np.ndarray) -> np.ndarray:
    """Sum of all counts before each."""
    return np.cumsum(counts) - counts


def _content(values: pa.Array) -> bytes:
    """All values of a string or binary array, joined."""
    if len(values) == 0:
        return b""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    return values.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes()


class Aligner:
    """Both tokenizers, and the spelling of groups."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = BytePairs(byte_path), Pieces(piece_path)
        ends = [(self.a, ",|"), (self.b, ",;")]
        self.written = pa.array([f"{n}{e}" for kind, two in ends for n in range(len(kind.spelled)) for e in two], pa.large_string())
        self.written_lengths = np.array([len(s) for s in self.written.to_pylist()], np.int64)

    def _units(self, content: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Different units, the unit at each place, and the number of places before each document."""
        joined = b"".join(content)
        sizes = np.array([len(c) for c in content], np.int64)
        byte = np.frombuffer(joined, np.uint8)
        starts = np.zeros(len(byte) + 1, bool)
        if self.b.by_unit:
            before = byte[1:-1]
            mark = (before >= 0x21) & (before <= 0x7E) | (byte[:-2] == 0xC3)  # 0xC3 leads U+00C0 to U+00FF
            starts[2:-1] = mark & (byte[2:] == 0x20)
        first = _before(sizes)
        starts[first] = True
        starts[-1] = True
        offsets = np.flatnonzero(starts)
        places = pa.Array.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(joined)]
        ).dictionary_encode()
        return places.dictionary.to_pylist(), places.indices.to_numpy(), np.append(np.searchsorted(offsets, first), len(offsets) - 1)

    def align(self, texts: list[str | None]) -> Alignment:
        """Figures of every text, and its links."""
        n = len(texts)
        found = Alignment(n)
        full = [i for i, text in enumerate(texts) if text]
        if not full:
            return found
        content = [b" " + texts[i].encode() for i in full]
        units, places, first = self._units(content)
        names = [unit.decode() for unit in units]
        a = _Tokens(self.a.spelled, self.a.encode(names), units)
        b = _Tokens(self.b.spelled, self.b.encode(names), units)
        if not (a.exact and b.exact):
            odd = np.array([a.spell(n) != unit or b.spell(n) != unit for n, unit in enumerate(units)])[places]
            odd_before = np.append(0, np.cumsum(odd))
            kept = []
            for n, text in enumerate(content):
                own = places[first[n] : first[n + 1]]
                whole = odd_before[first[n]] == odd_before[first[n + 1]] or all(
                    b"".join(map(kind.spell, own)) == text for kind in (a, b)
                )
                kept += [n] if whole else []
            places = np.concatenate([np.zeros(0, places.dtype), *(places[first[n] : first[n + 1]] for n in kept)])
            full, content = [full[n] for n in kept], [content[n] for n in kept]
        if full:
            found.fill(self, np.array(full), np.cumsum([len(c) for c in content]), a.of(places), b.of(places))
        return found


class Alignment:
    """Figures per document of a chunk, and the links as pairs (``a << 16 | b``) with the documents' places."""

    def __init__(self, documents: int):
        self.n_a, self.n_b, self.n_groups, self.n_links = np.zeros((4, documents), np.int64)
        self.groups = [b""] * documents
        self.pairs = self.places = np.zeros(0, np.int64)

    def fill(self, aligner: Aligner, documents: np.ndarray, ends: np.ndarray, a: tuple, b: tuple) -> None:
        (a_ids, a_ends), (b_ids, b_ends) = a, b
        is_a, is_b = np.zeros((2, int(ends[-1]) + 1), bool)
        is_a[a_ends], is_b[b_ends] = True, True
        cuts = np.flatnonzero(is_a | is_b)
        both = is_a & is_b
        # tokens and groups that have ended at or before each offset
        a_done, b_done, g_done = (np.cumsum(x, dtype=np.int32) for x in (is_a, is_b, both))
        # between two cuts there is one token of each kind: one link
        pairs = a_ids[a_done[cuts] - is_a[cuts]] << 16 | b_ids[b_done[cuts] - is_b[cuts]]
        links_done = np.searchsorted(cuts, ends, side="right")
        self.places, self.pairs = np.repeat(documents, np.diff(links_done, prepend=0)), pairs
        for figures, done in ((self.n_a, a_done[ends]), (self.n_b, b_done[ends]), (self.n_groups, g_done[ends])):
            figures[documents] = np.diff(done, prepend=0)
        self.n_links[documents] = np.diff(links_done, prepend=0)

        # groups in order, each with its tokens of the first kind and then those of the second
        group_ends = np.flatnonzero(both)
        group_starts = np.append(0, group_ends[:-1])
        a_group, b_group = (g_done[e] - both[e] for e in (a_ends, b_ends))
        order = np.empty(len(a_ids) + len(b_ids), np.int64)
        order[np.arange(len(a_ids)) + b_done[group_starts][a_group]] = 2 * a_ids + both[a_ends]
        order[np.arange(len(b_ids)) + a_done[group_ends][b_group]] = 2 * (len(aligner.a.spelled) + b_ids) + both[b_ends]
        text = memoryview(_content(aligner.written.take(pa.array(order))))
        written = np.append(0, np.cumsum(aligner.written_lengths[order]))[np.append(0, a_done[ends] + b_done[ends])]
        for document, start, end in zip(documents.tolist(), written[:-1].tolist(), written[1:].tolist(), strict=True):
            self.groups[document] = text[start : end - 1]


_worker: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str, piece_path: str) -> Aligner:
    """The tokenizers of this Python worker; they keep nothing of the texts."""
    key = (byte_path, piece_path)
    if key not in _worker:
        _worker[key] = Aligner(*key)
    return _worker[key]


def postings(pairs: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different (pair, place) entries as ``pair << 16 | place``, sorted, and how often each is linked."""
    return np.unique(pairs << 16 | places, return_counts=True)


def plane_rows(entries: np.ndarray, times: np.ndarray) -> Iterator[tuple[int, np.ndarray, pa.Array, np.ndarray]]:
    """Plane, different pairs, their bitmaps and popcounts of sorted postings."""
    more = times - 1
    plane, chosen = 0, entries
    while len(chosen):
        yield plane, *_bitmaps(chosen >> 16, (chosen & 0xFFFF).astype("<u2"))
        plane += 1
        left = more >> (plane - 1) > 0
        entries, more = entries[left], more[left]
        chosen = entries[more >> (plane - 1) & 1 == 1]
        while len(entries) and not len(chosen):  # no document has this bit, but some have a higher one
            plane += 1
            left = more >> (plane - 1) > 0
            entries, more = entries[left], more[left]
            chosen = entries[more >> (plane - 1) & 1 == 1]


def _bitmaps(pairs: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Different pairs (sorted), bitmap and popcount of each.

    A bitmap of n numbers is 2 n bytes, or one byte more than the bits take: an odd length tells the second form.
    """
    starts = np.flatnonzero(np.diff(pairs, prepend=-1))
    counts = np.diff(np.append(starts, len(pairs)))
    last = numbers[starts + counts - 1].astype(np.int64)
    bits = (last >> 4) * 2 + 2  # bytes of plain bits up to the last number, an even number
    dense = bits + 1 < 2 * counts
    sizes = np.where(dense, bits + 1, 2 * counts)
    offsets = np.append(0, np.cumsum(sizes))
    content = np.zeros(int(offsets[-1]), np.uint8)
    of_dense = np.repeat(dense, counts)
    at = np.repeat(offsets[:-1] - 2 * _before(counts), counts) + 2 * np.arange(len(numbers))
    raw, at = numbers.view(np.uint8).reshape(-1, 2)[~of_dense], at[~of_dense]
    content[at], content[at + 1] = raw[:, 0], raw[:, 1]
    for n in np.flatnonzero(dense):
        flags = np.zeros(int(bits[n]) * 8, bool)
        flags[numbers[starts[n] : starts[n] + counts[n]]] = True
        content[offsets[n] : offsets[n + 1] - 1] = np.packbits(flags, bitorder="little")
    array = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(content)])
    return pairs[starts], array, counts


def numbers_of(bitmap: bytes) -> np.ndarray:
    """Numbers that are in a bitmap."""
    if len(bitmap) % 2 == 0:
        return np.frombuffer(bitmap, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8, len(bitmap) - 1), bitorder="little"))


def build_index(
    documents: DataFrame,
    path: str,
    byte_vocabulary: str | None = None,
    piece_model: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    chunk_documents: int = CHUNK_DOCUMENTS,
) -> None:
    """Write the index of pairs: bitmaps (``pair`` is not null), and the figures of documents (``pair`` is null)."""
    files = (byte_vocabulary or public_tokenizers.path(BYTE_VOCABULARY), piece_model or public_tokenizers.path(PIECE_MODEL))
    rows = documents.select(documents[id_column].alias("id"), documents[text_column].alias("text"))
    schema = StructType.fromDDL(
        "chunk long, pair long, plane int, documents long, bitmap binary, "
        "place int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    ).add("id", rows.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for parts in _chunks(batches, chunk_bytes, chunk_documents):
            held, place = [], 0
            for some in parts:
                n, id_type = some.num_rows, some.schema.field("id").type
                found = aligner(*files).align(some.column("text").to_pylist())
                sha = [hashlib.sha256(g).hexdigest() if len(g) else "" for g in found.groups]
                yield from _batches(
                    n,
                    chunk=np.full(n, chunk), place=np.arange(place, place + n, dtype=np.int32), n_a=found.n_a,
                    n_b=found.n_b, n_groups=found.n_groups, n_links=found.n_links,
                    groups_sha256=pa.array(sha, pa.string()), id=some.column("id").combine_chunks(),
                )
                held.append(postings(found.pairs, found.places + place))
                place += n
                del found
            entries, times = map(np.concatenate, zip(*held, strict=True))
            order = np.argsort(entries)
            for plane, pairs, bitmaps, counts in plane_rows(entries[order], times[order]):
                yield from _batches(
                    len(pairs),
                    chunk=np.full(len(pairs), chunk), pair=pairs, plane=np.full(len(pairs), plane, np.int32),
                    documents=counts, bitmap=bitmaps, id=pa.nulls(len(pairs), id_type),
                )
            chunk += 1

    rows.mapInArrow(run, schema).write.mode("overwrite").parquet(path)


INDEX = [
    *[(c, pa.int64()) for c in ("chunk", "pair")],
    ("plane", pa.int32()),
    ("documents", pa.int64()),
    ("bitmap", pa.binary()),
    ("place", pa.int32()),
    *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
    ("groups_sha256", pa.string()),
    ("id", None),
]


def _batches(n: int, **columns) -> Iterator[pa.RecordBatch]:
    """Rows of the index in batches of bounded length; columns that are not given are null."""
    arrays = []
    for name, kind in INDEX:
        value = columns.get(name)
        arrays.append(pa.nulls(n, kind) if value is None else value if isinstance(value, pa.Array) else pa.array(value, kind))
    batch = pa.RecordBatch.from_arrays(arrays, [name for name, _ in INDEX])
    for at in range(0, n, 20_000):
        yield batch.slice(at, 20_000)


def _steps(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Table, int]]:
    """Rows in steps of about ``most`` characters, with their number of characters; a row is never cut."""
    held, size = [], 0
    for batch in batches:
        lengths = np.array([len(v or "") for v in batch.column("text").to_pylist()], np.int64)
        at = 0
        while at < batch.num_rows:
            n = max(1, int((np.cumsum(lengths[at:]) <= most - size).sum()))
            held.append(batch.slice(at, n))
            size, at = size + int(lengths[at : at + n].sum()), at + n
            if size >= most or at < batch.num_rows:
                yield pa.Table.from_batches(held), size
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held), size


def _chunks(batches: Iterator[pa.RecordBatch], most: int, most_rows: int) -> Iterator[Iterator[pa.Table]]:
    """The steps of each chunk; a chunk ends when it has ``most`` characters or ``most_rows`` rows."""
    steps = (
        (part.slice(at, most_rows), size)
        for part, size in _steps(batches, min(most, STEP_BYTES))
        for at in range(0, part.num_rows, most_rows)
    )
    following = next(steps, None)

    def chunk() -> Iterator[pa.Table]:
        nonlocal following
        size = rows = 0
        while following and (not rows or size + following[1] <= most and rows + following[0].num_rows <= most_rows):
            part, added = following
            following, size, rows = None, size + added, rows + part.num_rows
            yield part
            following = next(steps, None)

    while following:
        yield chunk()


def pair_counts(index: DataFrame) -> DataFrame:
    """``a``, ``b``, ``pair``, ``documents`` and ``links`` of every linked pair, and whether it is the ``best`` of its a.

    Popcounts are added up: those of plane 0 are the documents, those of the planes the further links.
    """
    worth = F.when(F.col("plane") == 0, F.lit(1)).otherwise(F.expr("shiftleft(1L, plane - 1)"))
    counts = index.where("pair IS NOT NULL").groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("documents"))).alias("documents"),
        F.sum(F.col("documents") * worth).alias("links"),
    )
    path = new_table_path(index.sparkSession, "pair_counts")
    counts.withColumn("a", F.shiftright("pair", 16)).write.parquet(path)
    counts = index.sparkSession.read.parquet(path)
    highest = counts.groupBy("a").agg(F.max("documents").alias("highest"))
    return counts.join(highest, "a").select(
        "a", F.col("pair").bitwiseAND(0xFFFF).alias("b"), "pair", "documents", "links",
        (F.col("documents") == F.col("highest")).alias("best"),
    )


def score_documents(index: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Figures of every document with ``n_best`` and ``count_sum``, which the postings of its pairs return."""
    figures = ["place", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    documents = index.where("pair IS NULL").select("chunk", *figures)
    counts = pair_counts(index).select("pair", F.col("documents").alias("count"), "best")
    returned = index.where("pair IS NOT NULL").select("chunk", "pair", "plane", "bitmap")
    # merged also where the counts would be few enough to broadcast: the number of pairs has no useful bound
    returned = returned.join(counts.hint("merge"), "pair")
    returned = returned.select(F.col("chunk").alias("of"), "plane", "bitmap", "count", "best")

    def score(own: pa.Table, held: pa.Table) -> pa.Table:
        sums, best = np.zeros((2, CHUNK_DOCUMENTS), np.int64)
        columns = [held.column(c).to_pylist() for c in ("plane", "bitmap", "count", "best")]
        for plane in set(columns[0]):
            worth = 1 << max(0, plane - 1)
            some = [row for row in zip(*columns, strict=True) if row[0] == plane]
            numbers = [numbers_of(row[1]) for row in some]
            lengths = np.fromiter(map(len, numbers), np.int64, len(numbers))
            places = np.concatenate(numbers).astype(np.int64)
            np.add.at(sums, places, np.repeat(np.array([worth * row[2] for row in some], np.int64), lengths))
            np.add.at(best, places, np.repeat(np.array([worth * row[3] for row in some], np.int64), lengths))
        places = own.column("place").to_numpy()
        arrays = [own.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
        arrays += [pa.array(best[places]), pa.array(sums[places]), own.column("groups_sha256")]
        return pa.table(arrays, ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    schema = StructType().add("id", documents.schema["id"].dataType)
    for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string")
    scored = documents.groupBy("chunk").cogroup(returned.groupBy("of")).applyInArrow(score, schema)
    return scored.withColumnRenamed("id", id_column)
