"""WARC archives with revisit records, and their capture index by external merge.

* Writing: a task writes one archive, a gzip member per record. Of captures with equal payloads that with the largest id is
  a response; the others are revisits that name it and carry the HTTP headers only. Payloads meet by their SHA-1.
* Reading: a task reads one archive, checks every payload against its digest, and writes the captures it found as a
  sorted run: blocks of rows, by URL key (host parts reversed, then path), timestamp, id and place.
* Merging: the first keys of the blocks give the bounds of key ranges; a task merges the parts of up to ``FAN_IN`` runs that
  lie in its range with a loser tree, one block of each run in memory. More runs than that are merged in several passes.
  A URL with any number of captures is split over ranges by timestamp. The result is ordered over all.

Files appear under their names when complete, so tasks may be repeated. The driver gets the ranges' bounds, one per
``RANGE_ROWS`` captures.

Null and empty payloads have no bytes; they are equal to each other. Rows that repeat an id are captures each; if the id is the
largest of its payload all of them are responses. A null id is smaller than any other. A null URL has the empty key. Pages have no
capture time, so the record's date counts seconds by the id from a fixed day. Other columns are not read.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.llm.files import new_file, open_file
from lakemart.session import new_table_path

LEVEL = 6  # of gzip
FIRST_DAY = 1_577_836_800
BLOCK_ROWS = 1024
RANGE_ROWS = 16_384
FAN_IN = 64
# fixed values of the format
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


class Capture(NamedTuple):
    url_key: str
    timestamp: str
    page_id: int | None
    file: str
    offset: int
    length: int
    record_type: str
    payload_bytes: int
    payload_digest: str
    refers_to: int | None

    def order(self) -> tuple:
        """Where the capture belongs; no two have the same."""
        first = self.page_id is not None
        return (self.url_key, self.timestamp, first, self.page_id or 0, self.file, self.offset)


KEY = ("url_key", "timestamp", "has_id", "id", "file", "offset")
CAPTURES = pa.schema(
    [
        ("url_key", pa.string()),
        ("timestamp", pa.string()),
        ("page_id", pa.int64()),
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
    ]
)
BLOCKS = pa.schema(
    [
        ("run", pa.int64()),
        ("part", pa.int64()),
        ("block", pa.int64()),
        ("name", pa.string()),
        ("rows", pa.int64()),
        *[(f"k_{c}", t) for c, t in zip(KEY, [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.int64()])],
    ]
)
PARTS = pa.schema([(c, pa.string() if c == "name" else pa.int64()) for c in "group run part block name range".split()])
_CAPTURE_DDL = (
    "url_key string, timestamp string, page_id long, file string, offset long, length long, record_type string, "
    "payload_bytes long, payload_digest string, refers_to long"
)
_BLOCK_DDL = (
    "run long, part long, block long, name string, rows long, k_url_key string, k_timestamp string, k_has_id boolean, "
    "k_id long, k_file string, k_offset long"
)


def url_key(url: str) -> str:
    """Host parts in reverse order, then path and query, so that a site's captures lie together."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}){path}" if host else url


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, uncompressed; a revisit if it refers to another."""
    seconds = FIRST_DAY + (page_id or 0) % 2**31
    date = dt.datetime.fromtimestamp(seconds, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    block = HTTP % len(payload)
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url or '', safe=_SAFE)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_SAFE = "".join(chr(n) for n in range(33, 127)) + " "


def members(file: pa.NativeFile, chunk: int = 1 << 20) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member."""
    data, base = b"", 0
    while data := data or file.read(chunk):
        unpack = zlib.decompressobj(31)
        parts, size = [], 0
        while True:
            parts.append(unpack.decompress(data))
            size += len(data)
            if unpack.eof:
                data = unpack.unused_data
                size -= len(data)
                break
            data = file.read(chunk)
            if not data:
                raise ValueError("the archive ends within a record")
        yield base, size, b"".join(parts)
        base += size


def parse(content: bytes, name: str, offset: int, length: int) -> Capture:
    """The capture a record tells of; a response whose payload does not have its digest is an error."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"wrong payload at {offset} of {name}")
    page, refers = (
        fields.get(field, "").removeprefix("<urn:page:").removesuffix(">") for field in ("WARC-Record-ID", "WARC-Refers-To")
    )
    stamp = "".join(c for c in fields["WARC-Date"] if c.isdigit())
    place = (url_key(fields["WARC-Target-URI"]), stamp, int(page) if page else None, name, offset, length)
    return Capture(*place, fields["WARC-Type"], size, digest, int(refers) if refers else None)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class LoserTree:
    """Merges sorted streams: an inner node keeps the loser of its match, so a row costs one match per level."""

    def __init__(self, streams: Sequence[Iterator[tuple]]):
        self.streams = list(streams)
        self.heads = [next(stream, None) for stream in self.streams]
        count = len(self.streams)
        self.losers = [-1] * count  # place 0 has the winner
        winners = [-1] * count + list(range(count))
        for node in range(count - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if count > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x[0] <= y[0])

    def __iter__(self) -> Iterator[tuple]:
        if not self.streams:
            return
        count = len(self.streams)
        while (head := self.heads[self.winner]) is not None:
            yield head
            at = self.winner
            self.heads[at] = next(self.streams[at], None)
            node = (at + count) // 2
            while node:
                if not self._before(at, self.losers[node]):
                    at, self.losers[node] = self.losers[node], at
                node //= 2
            self.winner = at


def _run_file(path: str, run: int, part: int, rows: Iterator[Capture], block_rows: int) -> Iterator[dict]:
    """Write sorted rows in blocks; yields what the list of blocks has of each."""
    name = f"{path}/{run:08d}-{part:08d}.arrow"
    found = []
    with new_file(name) as out, pa.ipc.new_file(out, CAPTURES) as writer:
        held: list[Capture] = []

        def flush() -> None:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), CAPTURES, strict=True)]
            writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=CAPTURES))
            first = {f"k_{c}": v for c, v in zip(KEY, held[0].order(), strict=True)}
            found.append({"run": run, "part": part, "block": len(found), "name": name, "rows": len(held), **first})
            held.clear()

        for row in rows:
            held.append(row)
            if len(held) == block_rows:
                flush()
        if held:
            flush()
    yield from found


def _stream(blocks: Sequence[tuple[str, int]], low: tuple | None, high: tuple | None) -> Iterator[tuple]:
    """(order, capture) of a run's blocks from ``low`` up to but without ``high``; one block is held."""
    name, file, reader = None, None, None
    try:
        for next_name, block in blocks:
            if next_name != name:
                if file is not None:
                    file.close()
                name, file = next_name, open_file(next_name)
                reader = pa.ipc.open_file(file)
            columns = [column.to_pylist() for column in reader.get_batch(block).columns]
            rows = [Capture(*values) for values in zip(*columns, strict=True)]
            keys = [row.order() for row in rows]
            a = 0 if low is None else bisect_left(keys, low)
            b = len(keys) if high is None else bisect_left(keys, high)
            yield from zip(keys[a:b], rows[a:b], strict=True)
    finally:
        if file is not None:
            file.close()


def _one_task_each(files: DataFrame, column: str) -> DataFrame:
    """One partition per row of a table with one row per file."""
    count = max(1, files.count())
    return files.repartitionById(count, F.col(column).cast("int"))


def write_archives(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    least_bytes: int = 0,
) -> None:
    """Archives under ``path/warc`` and their list ``path/archives``.

    Payloads of fewer than ``least_bytes`` bytes are responses all.
    """
    payload = F.encode(F.coalesce(F.col(html_column), F.lit("")), "utf-8")
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1("payload")))
    enough = F.octet_length("payload") >= least_bytes
    last = rows.where(enough).groupBy("sha1").agg(F.max("page_id").alias("last"))
    joined = rows.join(last, "sha1", "left")
    refers = F.when(~F.col("last").eqNullSafe(F.col("page_id")), F.col("last")).alias("refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, count, out, context = TaskContext.get().partitionId(), 0, None, None
        name = f"{path}/warc/{archive:08d}.warc.gz"
        for batch in batches:
            for n in range(batch.num_rows):
                if out is None:
                    context = new_file(name)
                    out = context.__enter__()
                page_id, url, content, sha1, other = (column[n].as_py() for column in batch.columns)
                pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                whole = record(page_id, url, content, base64.b32encode(sha1).decode(), other)
                out.write(pack.compress(whole) + pack.flush())
                count += 1
        if context is not None:
            context.__exit__(None, None, None)
            yield pa.RecordBatch.from_pydict({"archive": [archive], "file": [name], "records": [count]})

    listed = joined.select("page_id", "url", "payload", "sha1", refers)
    listed.mapInArrow(run, "archive long, file string, records long").write.parquet(f"{path}/archives")


def captures(
    spark: SparkSession, path: str, fan_in: int = FAN_IN, range_rows: int = RANGE_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Every capture of the archives, read back; ``part`` and ``place`` give the order over all."""
    archives = spark.read.parquet(f"{path}/archives").select("archive", "file")
    runs = f"{path}/runs"

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, name in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                with open_file(name) as file:
                    found = [parse(content, name, at, size) for at, size, content in members(file)]
                found.sort(key=Capture.order)
                yield pa.RecordBatch.from_pylist(list(_run_file(f"{runs}-0", archive, 0, iter(found), block_rows)), BLOCKS)

    _one_task_each(archives, "archive").mapInArrow(index, _BLOCK_DDL).write.parquet(f"{path}/blocks-0")
    level = 0
    blocks = spark.read.parquet(f"{path}/blocks-0")
    while blocks.agg(F.count_distinct("run")).first()[0] > fan_in:
        level += 1
        numbers = F.dense_rank().over(Window.orderBy("run")) - 1
        grouped = blocks.join(blocks.select("run").distinct().select("run", numbers.alias("number")), "run")
        grouped = grouped.withColumn("group", F.floor(F.col("number") / fan_in))
        target = f"{runs}-{level}"

        def again(group: int, part: int, rows: Iterator[tuple], target: str = target) -> pa.Table:
            return pa.Table.from_pylist(list(_run_file(target, group, part, (row for _, row in rows), block_rows)), BLOCKS)

        _merged(grouped, range_rows * fan_in, again, _BLOCK_DDL).write.parquet(f"{path}/blocks-{level}")
        blocks = spark.read.parquet(f"{path}/blocks-{level}")

    def last(group: int, part: int, rows: Iterator[tuple]) -> pa.Table:
        columns = list(zip(*(row for _, row in rows), strict=True)) or [()] * len(CAPTURES)
        table = pa.table([pa.array(c, f.type) for c, f in zip(columns, CAPTURES, strict=True)], schema=CAPTURES)
        table = table.append_column("part", pa.array([part] * len(table), pa.int64()))
        return table.append_column("place", pa.array(range(len(table)), pa.int64()))

    whole = blocks.withColumn("group", F.lit(0).cast("long"))
    return _merged(whole, range_rows, last, f"{_CAPTURE_DDL}, part long, place long")


def _merged(blocks: DataFrame, range_rows: int, finish: Callable[[int, int, Iterator[tuple]], pa.Table], out: str) -> DataFrame:
    """Merge the runs of each ``group`` in key ranges; ``finish`` makes a table of each range's rows."""
    keys = [f"k_{c}" for c in KEY]
    total = blocks.agg(F.sum("rows")).first()[0] or 0
    ranges = max(1, -(-total // range_rows))
    bounds: list[tuple] = []
    if ranges > 1:
        dealt = blocks.select(*keys).repartitionByRange(ranges, *keys)
        first = dealt.groupBy(F.spark_partition_id().alias("n")).agg(F.min(F.struct(*keys)).alias("k"))
        bounds = sorted(tuple(row["k"]) for row in first.collect())[1:]
    place = Window.partitionBy("run").orderBy("part", "block")
    key = F.struct(*keys)
    listed = blocks.select("group", "run", "part", "block", "name", key.alias("key"), F.lead(key).over(place).alias("next"))

    def in_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every block once per range that it may have rows in."""
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                key, following = (tuple(x.values()) if x else None for x in (row.pop("key"), row.pop("next")))
                last_range = len(bounds) if following is None else bisect_right(bounds, following)
                found += [row | {"range": n} for n in range(bisect_right(bounds, key), last_range + 1)]
            yield pa.RecordBatch.from_pylist(found, PARTS)

    wanted = listed.mapInArrow(in_ranges, "group long, run long, part long, block long, name string, range long")

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("run", "ascending"), ("part", "ascending"), ("block", "ascending")])
        group, part = table.column("group")[0].as_py(), table.column("range")[0].as_py()
        low, high = bounds[part - 1] if part else None, bounds[part] if part < len(bounds) else None
        per_run: dict[int, list[tuple[str, int]]] = {}
        for run, name, block in zip(*(table.column(c).to_pylist() for c in ("run", "name", "block")), strict=True):
            per_run.setdefault(run, []).append((name, block))
        return finish(group, part, iter(LoserTree([_stream(found, low, high) for found in per_run.values()])))

    return wanted.groupBy("group", "range").applyInArrow(merge, out)
