"""Exact top-k search by inner product with one KD-tree per shard.

Vectors are dealt to shards of about ``SHARD_ROWS`` rows by a hash of their id. Each shard becomes a tree: median
splits along the widest side of the box, down to leaves, with tight bounding boxes at every node. A query can score
no more in a box than the sum over components of the larger of component times lower and upper bound.

1. Trees are written once. Each query first searches the tree that holds it; its kth score so far is its bound.
2. Queries with their bounds meet all other shards in cells, each of a part of the queries and a part of the trees.
   A search takes the leaves by their bounds, highest first, in turns of 1, 2, 4 and so on; a query opens a leaf if
   the bound reaches the kth score, and stops at the first below it. A turn scores each leaf for all queries that open
   it at once and then raises the kth scores. They carry on from tree to tree within a cell.
3. The k best of what the cells return, ties to the smaller id, are the answer.

A cell holds about ``PART_BYTES`` of queries and as much of trees. Queries are copied once per part of the trees, trees
once per part of the queries; nothing is joined or broadcast. Only numbers of rows and bytes are sent to the driver.

Vectors that are null or hold a null or non-finite component take no part, as do null ids. Vectors are compared
with vectors of the same length. Rows that repeat an id are candidates each; a query never meets its own id. A
repeated query is answered once, from its row with the smallest vector. Scores must fit a long, else the search fails.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import new_table_path

SHARD_ROWS = 2048
LEAF_ROWS = 64
BLOCK_QUERIES = 512
PART_BYTES = 32 << 20  # of queries, and of trees, in a cell
CELLS_PER_CORE = 4  # where the tables are small
TURN_QUERIES = 4096  # that search a tree at once, if it has no more than
TURN_BOUNDS = 1 << 17  # bounds of leaves for them
MOST_OFFERS = 1 << 18  # that wait to be sorted
EXACT = ((np.float32, 2.0**24), (np.float64, 2.0**52))  # whole numbers below these are exact
LOWEST = -(2**63)  # stands for no bound


def build(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the points, and lower and upper bounds of the nodes; node n has the children 2n + 1 and 2n + 2."""
    depth = max(0, int(np.ceil(np.log2(max(1, len(points)) / LEAF_ROWS))))
    order = np.arange(len(points))
    low = np.zeros((2 ** (depth + 1) - 1, points.shape[1]), dtype=points.dtype)
    high = np.zeros_like(low)
    for node, a, b in nodes(len(points), depth):
        if a < b:
            part = points[order[a:b]]
            low[node], high[node] = part.min(axis=0), part.max(axis=0)
            if 2 * node + 1 < len(low):
                side = int(np.argmax(high[node] - low[node])) if points.shape[1] else 0
                if points.shape[1]:
                    order[a:b] = order[a:b][np.argpartition(part[:, side], (b - a) // 2)]
    return order, low, high


def nodes(count: int, depth: int) -> Iterator[tuple[int, int, int]]:
    """Number and row range of each node, parents first."""
    level = [(0, count)]
    node = 0
    for _ in range(depth + 1):
        below = []
        for a, b in level:
            yield node, a, b
            node += 1
            below += [(a, a + (b - a) // 2), (a + (b - a) // 2, b)]
        level = below


def narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest of the types they fit."""
    low, high = values.min(initial=0), values.max(initial=0)
    kinds = (k for k in ("<i2", "<i4") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return values.astype(next(kinds, "<i8"))


def widen(raw: bytes, count: int, dim: int) -> np.ndarray:
    """Rows of numbers from the bytes of ``narrow``."""
    if not dim:
        return np.zeros((count, 0), "<i2")
    return np.frombuffer(raw, f"<i{len(raw) // (count * dim)}").reshape(count, dim)


def _most(values: np.ndarray) -> float:
    return max(float(values.max(initial=0)), -float(values.min(initial=0)))


class Best:
    """The k best so far of every query, and the score a candidate must reach."""

    def __init__(self, kth: np.ndarray, k: int):
        self.kth, self.k = kth.astype("<i8"), k
        self.held = np.zeros(len(kth), np.int64)
        self.ids, self.scores = (np.zeros((len(kth), k), "<i8") for _ in range(2))
        self.offers: list[tuple] = []
        self.waiting = 0

    def offer(self, place: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Candidates of the queries at ``place``; those behind the k held, as with many equal vectors, go at once."""
        last = self.scores[place, -1]
        good = (self.held[place] < self.k) | (scores > last) | ((scores == last) & (ids < self.ids[place, -1]))
        self.offers.append((place[good], ids[good], scores[good]))
        self.waiting += int(good.sum())
        if self.waiting > MOST_OFFERS:
            self.settle()

    def settle(self) -> None:
        """Takes the best of the offers; raises ``kth`` of the queries that then have k."""
        if not self.waiting:
            return
        place, ids, scores = map(np.concatenate, zip(*self.offers, strict=True))
        self.offers, self.waiting = [], 0
        touched = np.unique(place)
        held = np.arange(self.k) < self.held[touched][:, None]
        place = np.concatenate([np.repeat(touched, self.held[touched]), place])
        ids = np.concatenate([self.ids[touched][held], ids])
        scores = np.concatenate([self.scores[touched][held], scores])
        order = np.lexsort((ids, ~scores, place))
        place, ids, scores = place[order], ids[order], scores[order]
        starts = np.searchsorted(place, touched)
        counts = np.diff(starts, append=len(place))
        rank = np.arange(len(place)) - np.repeat(starts, counts)
        top = rank < self.k
        self.ids[place[top], rank[top]] = ids[top]
        self.scores[place[top], rank[top]] = scores[top]
        self.held[touched] = np.minimum(counts, self.k)
        full = touched[counts >= self.k]
        self.kth[full] = np.maximum(self.kth[full], self.scores[full, self.k - 1])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the query, id and score of all that is held."""
        held = np.arange(self.k) < self.held[:, None]
        scores = self.scores[held]
        if (scores == LOWEST).any():
            raise OverflowError("a score does not fit a long")
        return np.repeat(np.arange(len(self.held)), self.held), self.ids[held], scores


class Tree:
    """A shard's tree, ready to search."""

    def __init__(self, ids: bytes, points: bytes, low: bytes, high: bytes, dim: int):
        self.ids = np.frombuffer(ids, "<i8")
        self.points = widen(points, len(self.ids), dim)
        size = max(1, dim) * self.points.itemsize
        self.low, self.high = (widen(x, max(1, len(x) // size), dim) for x in (low, high))
        depth = int(np.log2(len(self.low) + 1)) - 1
        self.first = 2**depth - 1  # of the leaves
        self.leaves = [(a, b) for n, a, b in nodes(len(self.ids), depth) if n >= self.first]
        self.most = _most(self.points)

    def search(self, queries: np.ndarray, own: np.ndarray, best: Best, asks: np.ndarray) -> None:
        """Adds to ``best`` what may be among the k best of the queries at ``asks``."""
        step = max(1, min(TURN_QUERIES, TURN_BOUNDS // len(self.leaves)))
        for at in range(0, len(asks), step):
            self._search(queries[asks[at : at + step]], own, best, asks[at : at + step])

    def _search(self, queries: np.ndarray, own: np.ndarray, best: Best, asks: np.ndarray) -> None:
        limit = self.most * _most(queries) * queries.shape[1]
        kind = next((k for k, most in EXACT if limit < most), object)
        points, low, high, queries = (x.astype(kind) for x in (self.points, self.low, self.high, queries))

        def product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            return np.maximum(x @ y.T, LOWEST) if kind is object else x @ y.T

        def bounds(x: np.ndarray, box: slice) -> np.ndarray:
            sums = np.maximum(x, 0) @ high[box].T + np.minimum(x, 0) @ low[box].T
            return np.maximum(sums, LOWEST) if kind is object else sums

        live = np.flatnonzero(bounds(queries, slice(1))[:, 0] >= best.kth[asks].astype(kind))
        queries, asks = queries[live], asks[live]
        bound = bounds(queries, slice(self.first, None))
        turn = np.empty(bound.shape, np.int32)
        np.put_along_axis(turn, np.argsort(-bound, axis=1), np.arange(len(self.leaves), dtype=np.int32)[None], axis=1)
        begin, end = 0, 1
        while begin < len(self.leaves):
            kth = best.kth[asks].astype(kind)
            opened = ((turn >= begin) & (turn < end) & (bound >= kth[:, None])).T.copy()
            if not opened.any():
                break
            for leaf in np.flatnonzero(opened.any(axis=1)):
                a, b = self.leaves[leaf]
                who = np.flatnonzero(opened[leaf])
                scores = product(queries[who], points[a:b])
                hits = np.flatnonzero(scores >= kth[who][:, None])
                at, place = np.divmod(hits, b - a)
                ids, asking = self.ids[a + place], asks[who[at]]
                other = ids != own[asking]
                best.offer(asking[other], ids[other], scores.ravel()[hits[other]].astype("<i8"))
            best.settle()
            begin, end = end, 2 * end + 1


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    scale: float,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The k best by inner product of floor(scale * component) for every row where ``is_query`` holds.

    ``is_query`` is an expression over ``id``. Returns query_id, rank, vec_id, score.
    """
    spark = vectors.sparkSession
    shards = max(1, -(-vectors.count() // shard_rows))
    vector = F.col("vector")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & _usable(vector)).select(
        "id",
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("vector"),
        F.size(vector).alias("dim"),
        F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"),
        is_query.alias("is_query"),
    )

    def plant(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dim = table.column("dim")[0].as_py()
        flat = pa.concat_arrays(table.column("vector").chunks).flatten().to_numpy(zero_copy_only=False)
        points = flat.astype("<i8").reshape(table.num_rows, dim)
        ids = table.column("id").to_numpy().astype("<i8")
        asks = table.column("is_query").to_numpy(zero_copy_only=False).astype(np.uint8)
        order, low, high = build(points)
        points = narrow(points[order])
        low, high = low.astype(points.dtype), high.astype(points.dtype)
        row = {"dim": [dim], "shard": table.column("shard").slice(0, 1), "ids": [ids[order].tobytes()]}
        row |= {"points": [points.tobytes()], "low": [low.tobytes()], "high": [high.tobytes()]}
        size = ids.nbytes + points.nbytes + low.nbytes + high.nbytes
        return pa.table(row | {"asks": [asks[order].tobytes()], "size": [size]}, TREE)

    path = new_table_path(spark, "kd_trees")
    tree_columns = "dim int, shard int, ids binary, points binary, low binary, high binary, asks binary, size bigint"
    rows.groupBy("dim", "shard").applyInArrow(plant, tree_columns).write.parquet(path)
    trees = spark.read.parquet(path)

    def search_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = Tree(row["ids"], row["points"], row["low"], row["high"], row["dim"])
                asks = np.flatnonzero(np.frombuffer(row["asks"], np.uint8))
                queries, own = tree.points[asks], tree.ids[asks]
                best = Best(np.full(len(asks), LOWEST), k)
                tree.search(queries, own, best, np.arange(len(asks)))
                hits: list[list] = [[] for _ in asks]
                for n, vec_id, score in zip(*(x.tolist() for x in best.rows()), strict=True):
                    hits[n].append({"vec_id": vec_id, "score": score})
                out = {"dim": [row["dim"]] * len(asks), "home": [row["shard"]] * len(asks), "query_id": own}
                out["vector"] = [q.tobytes() for q in queries.astype("<i8")]
                out["size"] = [queries.itemsize * row["dim"]] * len(asks)
                out |= {"kth": pa.array(best.kth, mask=best.kth == LOWEST), "hits": hits}
                yield pa.RecordBatch.from_pydict(out, SEED)

    seed_columns = "dim int, home int, query_id bigint, vector binary, size int, kth bigint"
    hit = "hits array<struct<vec_id: bigint, score: bigint>>"
    seeded = f"{path}-queries"
    first = trees.mapInArrow(search_home, f"{seed_columns}, {hit}")
    first.write.parquet(seeded)
    # rows with the same id share a shard and so have equal bounds to start from; one of them asks
    one = Window.partitionBy("query_id").orderBy("vector")
    seeds = spark.read.parquet(seeded).withColumn("n", F.row_number().over(one)).where("n = 1").drop("n")
    count, ask_bytes = spark.read.parquet(seeded).agg(F.count("*"), F.sum("size")).first()
    blocks = max(1, -(-count // BLOCK_QUERIES))
    ask_parts = min(blocks, max(1, -(-(ask_bytes or 0) // PART_BYTES)))
    tree_bytes = trees.agg(F.sum("size")).first()[0] or 0
    cells = CELLS_PER_CORE * spark.sparkContext.defaultParallelism
    tree_parts = min(shards, max(-(-tree_bytes // PART_BYTES), -(-cells // ask_parts)))

    def gather(table: pa.Table) -> pa.Table:
        columns = {c: [table.column(c).to_pylist()] for c in ("query_id", "home", "kth")}
        vectors_ = np.frombuffer(b"".join(table.column("vector").to_pylist()), "<i8")
        first = {c: table.column(c).slice(0, 1) for c in ("dim", "block")}
        return pa.table({**first, **columns, "vectors": [narrow(vectors_).tobytes()]}, BLOCK)

    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block")
    block_columns = "dim int, block int, query_id array<bigint>, home array<int>, kth array<bigint>, vectors binary"
    asked = seeds.select("dim", block, "query_id", "home", "kth", "vector")
    asked = asked.groupBy("dim", "block").applyInArrow(gather, block_columns)

    def copied(df: DataFrame, part: str, of: str, parts: int, copies: int, copy: str) -> DataFrame:
        copy_ = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(copy)
        return df.select("*", F.pmod(of, F.lit(parts)).alias(part), copy_)

    def search_rest(asked: pa.Table, trees: pa.Table) -> pa.Table:
        if not asked.num_rows or not trees.num_rows:
            return HIT.empty_table()
        dim = trees.column("dim")[0].as_py()
        own, home = (pc.list_flatten(asked.column(c)).to_numpy() for c in ("query_id", "home"))
        kth = pc.fill_null(pc.list_flatten(asked.column("kth")), LOWEST).to_numpy()
        sizes = pc.list_value_length(asked.column("query_id")).to_pylist()
        raw = zip(asked.column("vectors").to_pylist(), sizes, strict=True)
        queries = np.concatenate([widen(x, n, dim) for x, n in raw])
        best = Best(kth, k)
        for at in range(trees.num_rows):
            row = trees.slice(at, 1).to_pylist()[0]
            tree = Tree(row["ids"], row["points"], row["low"], row["high"], dim)
            tree.search(queries, own, best, np.flatnonzero(home != row["shard"]))
        place, ids, scores = best.rows()
        return pa.table({"query_id": own[place], "vec_id": ids, "score": scores}, HIT)

    cell = ["dim", "ask_part", "tree_part"]
    left = copied(asked, "ask_part", "block", ask_parts, tree_parts, "tree_part").groupBy(*cell)
    trees = trees.select("dim", "shard", "ids", "points", "low", "high")
    right = copied(trees, "tree_part", "shard", tree_parts, ask_parts, "ask_part").groupBy(*cell)
    rest = left.cogroup(right).applyInArrow(search_rest, "query_id bigint, vec_id bigint, score bigint")
    near = seeds.select("query_id", F.inline("hits"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.unionByName(rest).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_ITEMS = pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.int64())]))
_TREE_PARTS = [(c, pa.binary()) for c in ("ids", "points", "low", "high", "asks")]
TREE = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), *_TREE_PARTS, ("size", pa.int64())])
SEED = pa.schema(
    [
        ("dim", pa.int32()),
        ("home", pa.int32()),
        ("query_id", pa.int64()),
        ("vector", pa.binary()),
        ("size", pa.int32()),
        ("kth", pa.int64()),
        ("hits", _ITEMS),
    ]
)
BLOCK = pa.schema(
    [
        ("dim", pa.int32()),
        ("block", pa.int32()),
        ("query_id", pa.list_(pa.int64())),
        ("home", pa.list_(pa.int32())),
        ("kth", pa.list_(pa.int64())),
        ("vectors", pa.binary()),
    ]
)
HIT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
