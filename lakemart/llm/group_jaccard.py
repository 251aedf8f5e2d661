"""N-gram Jaccard join by a token-group matrix.

Tokens are 64-bit hashes of word shingles; equal token sets form one class, named by a hash of the set.

1. One pass gives the class of every document and counts all tokens in a sketch of fixed size.
2. Classes with the same three smallest tokens form a group: similar sets nearly always do.
3. Two sets that reach the threshold t share a token among the first n - ceil(t * n) + 1 of each, in any one order of
   all tokens. The order is by the sketch's count, so frequent tokens come last and hardly take part. These tokens
   against the groups that hold them are the matrix; a group's entries are the union over its members.
4. The number of entries that two groups share bounds the overlap of their members; only pairs of groups that qualify
   are opened. First each group is paired with the smallest group of each of its tokens, and with itself. A task
   opens a pair, bounds the overlap of each set with the union of the other side's tokens, and compares those that
   can still reach the threshold. Links make components.
5. What is left is compared class by class, with two exact bounds. A leading token at place i can be the first that a set of
   size n shares with another only if the n - i tokens from there on suffice for the threshold, which bounds the other's
   size (``reaches``); the matrix keeps it for each entry. The number of leading tokens that two sets share is counted
   in full. First each class is paired with one class per token, that with the fewest tokens before it; then all pairs of
   different components that share a token within reach. Members of a family that differ by tokens of their own do
   not reach each other, so large families make few pairs, and no link between components is missed.

Groups are cut into blocks of about ``BLOCK_TOKENS`` tokens. A task holds one block, the head, and a share of the blocks that
it meets, of about as many tokens. Who meets whom is settled with narrow tables, written to the shared folder between the
steps; then each set is made from its text and shuffled once, to the tasks that need it. Up to ``BROADCAST_CLASSES`` such
rows are sent to the texts, more are joined by a shuffle. The driver gets the sketch's ranks, 2 MB at any size of the
corpus, and counts.

Null and empty texts have an empty set, no links and their own id as component. Rows that repeat a text are one class;
rows that repeat an id keep their own sets, and the id stands for all. A document without an id links like any other,
but a null id is never a component's name, unless no member has an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.components import components
from lakemart.llm.spread import spread_join
from lakemart.session import new_table_path

WORDS = 3
PERCENT = 90
BLOCK_TOKENS = 1 << 16
BROADCAST_CLASSES = 200_000  # rows of seven numbers
SKETCH, SEGMENT = 1 << 21, 1 << 16
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)  # odd numbers that spread bits


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Distinct hashes of the text's shingles, ascending; ASCII letters in lower case, words between ASCII spaces."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    used = min(words, len(found))
    last = len(hashes) - used + 1
    total = np.full(last, used, np.uint64)
    for n in range(used):
        total = _mix(total * np.uint64(_FACTORS[n % 3]) + hashes[n : n + last])
    return np.unique(total)


def set_key(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def group_key(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens[:3].tobytes(), seed=1) - (1 << 63)


def leading(tokens: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """The tokens of which a set that reaches the threshold must share one."""
    n = len(tokens)
    count = n - -(-percent * n // 100) + 1
    order = np.lexsort((tokens, ranks[tokens & np.uint64(SKETCH - 1)]))
    return tokens[order[:count]]


def reaches(n: int, count: int, percent: int) -> np.ndarray:
    """For each of the ``count`` leading tokens of a set of size n, the largest set that may link if it is the first token
    that both hold: only the n - place tokens from there on can be common."""
    return (n - np.arange(count)) * (100 + percent) // percent - n


def links_between(
    keys: list[int], sets: list[np.ndarray], sides: list[int], known: list[int], percent: int
) -> list[tuple[int, int]]:
    """Links that connect what the threshold connects.

    ``sides`` are 0 and 1, or 0 alone for one group with itself; ``known`` are the components found before.
    """
    sides_ = np.array(sides)
    first = np.flatnonzero(sides_ == 0)
    second = np.flatnonzero(sides_ == 1) if sides_.any() else first
    sizes = np.array([len(s) for s in sets])
    tokens = np.concatenate([sets[n] for n in second])
    owners = np.repeat(np.arange(len(second)), sizes[second])
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    union = tokens[np.append(True, tokens[1:] != tokens[:-1])]
    label = np.unique(np.array(known), return_inverse=True)[1]
    links = []
    for n in first:
        open_ = label[second] != label[n]
        fits = open_ & (100 * sizes[second] >= percent * sizes[n]) & (100 * sizes[n] >= percent * sizes[second])
        if not fits.any():
            continue
        place = np.searchsorted(union, sets[n])
        bound = np.count_nonzero(union[np.minimum(place, len(union) - 1)] == sets[n])
        least = sizes[second][fits].min()
        if 100 * bound < percent * (sizes[n] + least - min(bound, least)):
            continue
        a, b = np.searchsorted(tokens, sets[n], "left"), np.searchsorted(tokens, sets[n], "right")
        lengths = b - a
        at = np.repeat(a - np.append(0, np.cumsum(lengths)[:-1]), lengths) + np.arange(lengths.sum())
        common = np.bincount(owners[at], minlength=len(second))
        near = fits & (100 * common >= percent * (sizes[n] + sizes[second] - common))
        for m in second[near]:
            if label[m] != label[n]:
                links.append((keys[n], keys[m]))
                label[label == label[m]] = label[n]
    return links


def _written(df: DataFrame, name: str) -> DataFrame:
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def link_components(
    documents: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """``id_column`` (long), ``n_shingles`` and ``component_id`` of every row."""
    spark = documents.sparkSession
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    # where a text is found again: its id, or a hash of the text where there is none
    texts = texts.withColumn("at", F.coalesce("id", F.xxhash64("text")))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                tokens = token_set(text, words)
                np.add.at(counts, tokens & np.uint64(SKETCH - 1), 1)
                rows.append((len(tokens), set_key(tokens), group_key(tokens)) if len(tokens) else (0, None, None))
            columns = [pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else ((), (), ()))]
            empty = [pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns, *empty], schema=DESCRIBED)
        for n in range(SKETCH // SEGMENT):
            part = counts[n * SEGMENT : (n + 1) * SEGMENT]
            if part.any():
                yield pa.RecordBatch.from_pylist([{"segment": n, "counts": part.tobytes()}], DESCRIBED)

    described = "id long, at long, n long, key long, grp long, segment int, counts binary"
    described = _written(texts.mapInArrow(describe, described), "described")
    sets = described.where("segment is null").select("id", "at", "n", "key", "grp")
    ranks = spark.sparkContext.broadcast(_ranks(described.where("segment is not null")))

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, int, int]] = []
        size = 0
        for batch in batches:
            for text in batch.column(1).to_pylist():
                tokens = token_set(text, words)
                if len(tokens):
                    held.append((leading(tokens, ranks.value, percent), set_key(tokens), len(tokens)))
                    size += len(held[-1][0])
                if size > 500_000:
                    yield _entries(held, percent)
                    held, size = [], 0
        if held:
            yield _entries(held, percent)

    # one shuffle serves the tokens that more than one class holds and the join with them, as both read all columns
    entries = texts.select("id", "text").mapInArrow(lead, "token long, key long, size int, reach int").repartition("token")
    bounds = [F.min("key").alias("x"), F.max("key").alias("y"), F.min("size").alias("size"), F.min("reach").alias("reach")]
    spread = entries.groupBy("token").agg(*bounds).where("x <> y and size > 0 and reach >= 0").select("token")
    matrix = entries.join(spread, "token").groupBy("token", "key")
    matrix = _written(matrix.agg(F.min("size").alias("size"), F.max("reach").alias("reach")), "matrix")

    classes = sets.where("key is not null").groupBy("key", "grp", "n").agg(F.min("id").alias("id"), F.min("at").alias("at"))
    classes = _written(classes, "classes")
    groups = classes.groupBy("grp").agg(
        F.count("*").alias("members"),
        F.ceil(F.sum("n") / F.lit(block_tokens)).cast("int").alias("blocks"),
        F.min("n").alias("low"),
        F.max("n").alias("high"),
    )
    groups = _written(groups, "groups")
    own = groups.where("members > 1").select(F.col("grp").alias("a"), F.col("grp").alias("b"), "blocks")
    a, b = (groups.select(*[F.col(c).alias(f"{side}_{c}") for c in groups.columns]) for side in "ab")
    held_by = matrix.select("token", "key").join(classes.select("key", "grp"), "key").select("token", "grp").distinct()
    held_by = _written(held_by, "held_by")
    heads = held_by.groupBy("token").agg(F.min("grp").alias("head"), F.max("grp").alias("last")).where("head <> last")
    star = held_by.join(heads.select("token", "head"), "token").where("head <> grp")
    star = star.groupBy(F.col("head").alias("a_grp"), F.col("grp").alias("b_grp"))
    star = star.agg(F.count("*").alias("common")).join(a, "a_grp").join(b, "b_grp").where(_may_link(percent))
    star = star.select(F.col("a_grp").alias("a"), F.col("b_grp").alias("b"), F.col("b_blocks").alias("blocks"))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("bi")
    first = own.select("a", each.alias("ai"), "b").withColumn("bi", F.col("ai"))
    first = first.unionByName(own.where("blocks > 1").select("a", F.lit(0).alias("ai"), "b", each).where("bi > 0"))
    first = _written(first.unionByName(star.select("a", F.lit(0).alias("ai"), "b", each)), "pairs")

    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("block")
    by_block = classes.join(groups.select("grp", "blocks"), "grp").select("key", "grp", "n", "at", block)
    by_class = classes.select("key", F.col("key").alias("grp"), "n", "at", F.lit(0).alias("block"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = set()  # rows that repeat an id and a text have the same set
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = [token_set(text, words) for text in some.column(0).to_pylist()]
                content = pa.array([tokens.tobytes() for tokens in found], pa.binary())
                filled = pa.RecordBatch.from_arrays([*some.columns[1:], content], [*some.schema.names[1:], "tokens"])
                new = []
                for tokens, *place, key in zip(found, *(some.column(n).to_pylist() for n in range(1, 6)), strict=True):
                    place = (*place, key)
                    new.append(place not in sent and set_key(tokens) == key)
                    if new[-1]:
                        sent.add(place)
                yield filled.filter(pa.array(new, pa.bool_()))

    def open_pair(table: pa.Table) -> pa.Table:
        keys, sides, known = (table.column(c).to_pylist() for c in ("key", "side", "root"))
        once = sorted({place: n for n, place in enumerate(zip(keys, sides, strict=True))}.values())
        keys, sides, known = ([x[n] for n in once] for x in (keys, sides, known))
        content = [np.frombuffer(table.column("tokens")[n].as_buffer(), np.uint64) for n in once]
        found = links_between(keys, content, sides, known, percent)
        return pa.table({"a": [a for a, _ in found], "b": [b for _, b in found]}, LINKS)

    def compare(pairs: DataFrame, roots: DataFrame, blocks: DataFrame) -> DataFrame:
        """Links of the opened pairs of blocks, or of classes that are a block each.

        The larger block of a pair is its head. A head's partners are dealt into shares of about ``block_tokens`` tokens,
        and the head goes once to each share, not once to each partner.
        """
        opened = pairs.select(F.col("a").alias("grp")).union(pairs.select("b")).distinct()
        placed = _written(blocks.join(opened, "grp", "left_semi").join(roots, "key"), "placed")
        sizes = _written(placed.groupBy("grp", "block").agg(F.sum("n").alias("size")), "sizes")
        weighed = pairs
        for side in "ab":
            of_side = sizes.select(
                F.col("grp").alias(side), F.col("block").alias(f"{side}i"), F.col("size").alias(f"{side}_size")
            )
            weighed = weighed.join(of_side, [side, f"{side}i"])
        larger = [F.when(F.col("b_size") > F.col("a_size"), F.col(y)).otherwise(F.col(x)) for x, y in (("a", "b"), ("ai", "bi"))]
        smaller = [F.when(F.col("b_size") > F.col("a_size"), F.col(x)).otherwise(F.col(y)) for x, y in (("a", "b"), ("ai", "bi"))]
        weighed = weighed.select(
            larger[0].alias("head"), larger[1].alias("hi"), smaller[0].alias("grp"), smaller[1].alias("block"),
            F.least("a_size", "b_size").alias("size"),
        )
        weighed = _written(weighed, "weighed")
        itself = (F.col("head") == F.col("grp")) & (F.col("hi") == F.col("block"))
        partners = weighed.where(~itself)
        shares = partners.groupBy("head", "hi").agg(
            F.greatest(F.ceil(F.sum("size") / block_tokens), F.lit(1)).alias("shares"), F.count("*").alias("pairs")
        )
        shares = _written(shares, "shares")
        dealt = spread_join(partners, shares, ["head", "hi"], "pairs")
        dealt = dealt.withColumn("share", F.pmod(F.xxhash64("grp", "block"), F.col("shares")))
        task = ["head", "hi", "share"]
        heads = dealt.select(*task, F.lit(0).alias("side"), F.col("head").alias("grp"), F.col("hi").alias("block")).distinct()
        alone = weighed.where(itself).select("head", "hi", F.lit(-1).cast("long").alias("share"), F.lit(0).alias("side"), "grp", "block")
        sides = heads.unionByName(alone).unionByName(dealt.select(*task, F.lit(1).alias("side"), "grp", "block"))
        # who meets whom is settled with narrow rows; the sets are made where their texts lie and shuffled once, to the tasks
        meeting = sides.join(placed, ["grp", "block"]).select("at", *task, "side", "key", "root")
        meeting = _written(meeting, "meeting")
        few = meeting.count() <= BROADCAST_CLASSES  # else the texts are shuffled to meet them
        content = texts.join(F.broadcast(meeting) if few else meeting, "at").select("text", *task, "side", "key", "root")
        place = "head long, hi int, share long, side int, key long, root long"
        return content.mapInArrow(fill, f"{place}, tokens binary").groupBy(*task).applyInArrow(open_pair, "a long, b long")

    def follow(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
        """Components of new links and of the ones found before."""
        if before is not None:
            links = links.unionByName(before.select(F.col("node").alias("a"), F.col("root").alias("b")))
        return _written(components(links), "components")

    def named(found: DataFrame) -> DataFrame:
        joined = classes.join(found, classes["key"] == found["node"], "left")
        return joined.select("key", "id", "grp", F.coalesce("root", "key").alias("root"))

    def apart(found: DataFrame) -> DataFrame:
        """The entries, with their components, of tokens that classes of different components hold."""
        left = matrix.join(named(found).select("key", "root"), "key")
        head = F.max_by("key", F.struct(F.col("reach") - F.col("size"), "key")).alias("head")
        mixed = left.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y"), head)
        return _written(left.join(mixed.where("x <> y").select("token", "head"), "token"), "left")

    def candidates(a: DataFrame, b: DataFrame, left: DataFrame, *more: Column) -> DataFrame:
        """Pairs of classes of different components, one of them in each table, that share enough tokens to link."""
        a, b = (t.select(*[F.col(c).alias(f"{side}_{c}") for c in t.columns]) for side, t in (("a", a), ("b", b)))
        reach = (F.col("a_size") <= F.col("b_reach")) & (F.col("b_size") <= F.col("a_reach"))
        apart = (F.col("a_token") == F.col("b_token")) & (F.col("a_root") != F.col("b_root"))
        sizes = [F.col(f"{side}_size").cast("long").alias(f"{side}_{c}") for side in "ab" for c in ("low", "high")]
        pairs = a.join(b, apart & reach & _sizes_of("size", "size", percent) & reduce(and_, more, F.lit(True)))
        pairs = _written(pairs.select("a_key", "b_key", *sizes).distinct(), "candidates")
        of_b = left.select(F.col("key").alias("b_key"), "token")
        common = pairs.join(of_b, "b_key").join(left.select(F.col("key").alias("a_key"), "token"), ["a_key", "token"])
        common = common.groupBy(*pairs.columns).agg(F.count("*").alias("common")).where(_may_link(percent))
        zero = F.lit(0)
        return common.select(F.col("a_key").alias("a"), zero.alias("ai"), F.col("b_key").alias("b"), zero.alias("bi"))

    found = follow(compare(first, classes.select("key", F.col("key").alias("root")), by_block))

    # now class by class, first with the class of each token that has the fewest tokens before it
    left = apart(found)
    again = _written(candidates(left.where("key = head"), left.where("key <> head"), left), "pairs")
    found = follow(compare(again, named(found).select("key", "root"), by_class), found)

    # then all pairs of classes that share a token and are not in one component
    left = apart(found)
    rest = candidates(left, left, left, F.col("a_key") < F.col("b_key")).join(again, ["a", "ai", "b", "bi"], "left_anti")
    rest = _written(rest, "pairs")
    found = follow(compare(rest, named(found).select("key", "root"), by_class), found)

    keyed = named(found)
    smallest = keyed.groupBy("root").agg(F.min("id").alias("component_id"))
    keyed = keyed.join(smallest, "root").select("key", "component_id")
    joined = sets.join(keyed, "key", "left")
    component = F.coalesce("component_id", "id").alias("component_id")
    return joined.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component)


def _sizes_of(high: str, low: str, percent: int) -> Column:
    highs = [F.col(f"{side}_{high}").cast("long") * 100 for side in "ab"]
    return (highs[0] >= F.col(f"b_{low}") * percent) & (highs[1] >= F.col(f"a_{low}") * percent)


def _sizes(percent: int) -> Column:
    """Whether two groups have members of sizes that may link."""
    return _sizes_of("high", "low", percent)


def _may_link(percent: int) -> Column:
    """Whether two groups share enough leading tokens (``common``) for any of their members to link.

    Of two sets' tokens in the common order, those behind the leading ones of the set whose leading ones end first
    are at most ceil(t * n) - 1; what the overlap needs beyond that must be among the leading ones of both.

    Over a range of sizes the ceilings make this bound jump by one, so the least of it is not at the ends. There the
    bound without ceilings holds, whose least is: ceil(t * n) is at most t * n + 99/100.
    """

    def least(x: Column, y: Column) -> Column:
        overlap = -F.floor(-(x + y) * percent / (100 + percent))
        return overlap - F.ceil(F.greatest(x, y) * percent / 100) + 1

    def below(x: Column, y: Column) -> Column:
        """Times 100 * (100 + percent), to stay with whole numbers."""
        return 100 * percent * (x + y) - percent * (100 + percent) * F.greatest(x, y) + (100 + percent)

    low, high = ([F.col(f"{side}_{c}") for side in "ab"] for c in ("low", "high"))
    one_size = (low[0] == high[0]) & (low[1] == high[1])
    of_range = F.least(below(low[0], high[1]), below(high[0], low[1]))
    enough = F.when(one_size, F.col("common") >= least(low[0], low[1]))
    return _sizes(percent) & enough.otherwise(F.col("common") * (100 * (100 + percent)) >= of_range)


DESCRIBED = pa.schema(
    [
        *[(c, pa.int64()) for c in ("id", "at", "n", "key", "grp")],
        ("segment", pa.int32()),
        ("counts", pa.binary()),
    ]
)
ENTRIES = pa.schema([("token", pa.int64()), ("key", pa.int64()), ("size", pa.int32()), ("reach", pa.int32())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _entries(held: list[tuple[np.ndarray, int, int]], percent: int) -> pa.RecordBatch:
    """Different (token, class) entries, so that copies in one task add nothing to the shuffle."""
    tokens = np.concatenate([tokens for tokens, _, _ in held]).view(np.int64)
    counts = [len(tokens) for tokens, _, _ in held]
    keys = np.repeat(np.array([key for _, key, _ in held], np.int64), counts)
    sizes = np.repeat(np.array([n for _, _, n in held], np.int32), counts)
    reach = np.concatenate([reaches(n, len(tokens), percent) for tokens, _, n in held]).astype(np.int32)
    order = np.lexsort((keys, tokens))
    tokens, keys = tokens[order], keys[order]
    new = np.append(True, (tokens[1:] != tokens[:-1]) | (keys[1:] != keys[:-1]))
    return pa.RecordBatch.from_arrays([pa.array(x[new]) for x in (tokens, keys, sizes[order], reach[order])], schema=ENTRIES)


def _ranks(segments: DataFrame) -> np.ndarray:
    """Logarithm of the sketch's counts in quarter steps; each task adds up its segments as they come."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums.setdefault(segment, np.zeros(SEGMENT, np.int64))
                sums[segment] += np.frombuffer(counts, np.uint32)
        for segment, counts in sums.items():
            steps = np.minimum(4 * np.log2(counts + 1), 255).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"segment": [segment], "ranks": [steps.tobytes()]})

    dealt = segments.select("segment", "counts").repartition(SKETCH // SEGMENT, "segment")
    ranks = np.zeros(SKETCH, np.uint8)
    for row in dealt.mapInArrow(add, "segment long, ranks binary").collect():
        at = row["segment"] * SEGMENT
        ranks[at : at + SEGMENT] = np.frombuffer(row["ranks"], np.uint8)
    return ranks
