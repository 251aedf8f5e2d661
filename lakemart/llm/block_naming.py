"""Exact copies by deterministic block naming.

A text is normalised (every run of blanks, tabs and line ends is one space) and its UTF-8 bytes are cut into blocks of
``BLOCK_BYTES``. All different blocks of all texts are sorted and numbered; a block's number is its name. Then adjacent
names of a text are paired, all different pairs are sorted and numbered, and so on: after about log2(blocks) turns
every text has one number. Two texts have the same number of the same turn if and only if their bytes are equal.

No identity rests on a hash. Fingerprints of 128 bits only bring names back to their blocks, and that they may is
tested: were two different blocks among all to share one, all would be taken anew with the next salt.

Blocks are counted before they are shuffled, so each travels once per task; names go back to hot blocks, pairs
and groups by a broadcast of at most ``spread.HOT_KEYS`` rows. Every turn's tables are written, so a lost executor costs
one turn at most. Only built-in functions are used.

Null counts as empty, and an empty text is one empty block. Of rows that repeat an id all are returned and counted; of a
group just one row stays, that with the smallest id, null ids last. If all ids of a group are null, ``keep_id`` is.
An empty table gives no rows. Columns other than id and text are not read, so they cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.held import held
from lakemart.llm.spread import spread_join
from lakemart.session import new_table_path

BLOCK_BYTES = 4096
# runs of the blanks that are not one space already
BLANKS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
ALONE = -1  # the name in place of a partner of the last block


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def fingerprint(block: Column, salt: int) -> list[Column]:
    """128 bits of a block."""
    return [F.xxhash64(F.lit(2 * salt + n), block) for n in range(2)]


def _blocks(content: str, size: int, of: Callable[[Column], Column]) -> Column:
    """``of`` of each block of the binary column ``content``."""
    last = F.greatest(F.ceil(F.octet_length(F.col(content)) / size), F.lit(1)).cast("int") - 1
    return F.transform(
        F.sequence(F.lit(0), last), lambda n: of(F.substring(F.col(content), n * size + 1, F.lit(size)))
    )


def _written(df: DataFrame, name: str) -> DataFrame:
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _block_names(texts: DataFrame, size: int, marks: Callable, salt: int) -> DataFrame:
    """``k1``, ``k2``, ``name`` and ``times`` of every different block."""
    blocks = texts.select(F.explode(_blocks("content", size, lambda block: block)).alias("block"))
    k1, k2 = marks(F.col("block"), salt)
    different = blocks.groupBy(k1.alias("k1"), k2.alias("k2"), "block").agg(F.count("*").alias("times"))
    return _numbered(different, ["block"]).drop("block")


def _numbered(different: DataFrame, by: list[str]) -> DataFrame:
    """A number per row: tasks sort their share of the rows, which are all different."""
    return different.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def exact_copies(
    documents: DataFrame,
    block_bytes: int = BLOCK_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
    marks: Callable[[Column, int], list[Column]] = fingerprint,
) -> DataFrame:
    """Every row's id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of the normalised text."""
    texts = documents.select(documents[id_column].alias("id"), documents[text_column].alias("text"))
    texts = held(texts, content=normalised(F.col("text")).cast("binary")).drop("text")

    salt = 0
    while True:
        names = _written(_block_names(texts, block_bytes, marks, salt), "block_names")
        if names.groupBy("k1", "k2").count().where("count > 1").isEmpty():
            break
        salt += 1

    def marked(block: Column) -> Column:
        k1, k2 = marks(block, salt)
        return F.struct(k1.alias("k1"), k2.alias("k2"))

    rows = _written(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            F.sha2("content", 256).alias("text_sha256"),
            _blocks("content", block_bytes, marked).alias("blocks"),
        ),
        "rows",
    )
    n = F.size("blocks").alias("n")
    places = rows.select("row", n, F.posexplode("blocks").alias("pos", "mark")).select("row", "n", "pos", "mark.*")
    named = _written(spread_join(places, names, ["k1", "k2"], "times").select("row", "n", "pos", "name"), "turn")
    longest = rows.agg(F.max(n)).first()[0] or 1

    whole = named.where("n = 1").select("row", F.lit(0).alias("turn"), "name")
    for turn in range(1, (longest - 1).bit_length() + 1):
        left, right = (F.max(F.when(F.col("pos") % 2 == side, F.col("name"))) for side in (0, 1))
        halves = [((F.col(c) + more) / 2).cast("int").alias(c) for c, more in (("n", 1), ("pos", 0))]
        pairs = named.where("n > 1").groupBy("row", *halves).agg(
            left.alias("a"), F.coalesce(right, F.lit(ALONE)).alias("b")
        )
        pairs = _written(pairs, "pairs")
        names = _written(_numbered(pairs.groupBy("a", "b").agg(F.count("*").alias("times")), ["a", "b"]), "pair_names")
        named = _written(spread_join(pairs, names, ["a", "b"], "times").select("row", "n", "pos", "name"), "turn")
        whole = whole.unionByName(named.where("n = 1").select("row", F.lit(turn).alias("turn"), "name"))

    known = _written(rows.drop("blocks").join(whole, "row"), "identities")
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))).alias("first")
    groups = _written(known.groupBy("turn", "name").agg(F.count("*").alias("group_size"), first), "groups")
    found = spread_join(known, groups, ["turn", "name"], "group_size")
    return found.select(
        F.col("id").alias(id_column),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )
