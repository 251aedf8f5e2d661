r"""Benchmark decontamination by canonical templates, with built-in functions only.

Texts of benchmark and corpus become sequences of words. A run of capitalised words is one name, also where a sentence
begins; a number is one word with its sign and separators (which are taken as alike); a unit's name behind a number, or
attached to it, is a unit. These three turn into typed placeholders, other words into lower case. Windows of ``WINDOW``
words with at least ``LEAST_WORDS`` real words of the benchmark are joined with the windows of the corpus by hash and
compared. Windows of the same item that lie at the same distance form an alignment. Its slots must be consistent: within
a type, equal values of the item meet equal values of the document and the other way round. Where values contradict each
other, the one in the most places holds, none on a tie, and windows with another go; windows without slots always stay.
So a question asked again with other numbers is found, a chance meeting of placeholders is not. An item leaks into a
document if what stays covers ``SHARE`` of its windows.

An item of fewer than ``WINDOW`` words is one window, its whole sequence; its first word is also looked for in lower case.
With fewer than ``LEAST_WORDS`` real words its slots must have its own values. An item of fewer than ``LEAST_WORDS`` words
in all is found only where it is a document's whole text, as such words meet by chance everywhere.

The benchmark's windows are sent to every executor if they are at most ``BROADCAST_WINDOWS``, else both sides are
shuffled by hash. Only windows that match are shuffled for the rest; a group holds the windows of one item in one
document. The driver learns how many words short items have, at most ``WINDOW`` - 1 numbers.

Null and empty texts, and texts without a word, match nothing. Rows with the same document and item id are taken
together. Columns other than id and text are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.held import held

WINDOW = 8
LEAST_WORDS = 4
SHARE = 0.5
BROADCAST_WINDOWS = 200_000
UNITS = (
    "mm cm m km g kg mg lb lbs oz l ml gal inch inches ft foot feet yd yards mile miles metre metres meter meters "
    "kilometre kilometres kilometer kilometers gram grams kilogram kilograms pound pounds litre litres liter liters "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "dollar dollars euro euros cent cents percent degree degrees"
).split()
# marks in front of a slot's value; the first also ends a name, the last stands for signs and separators within numbers
NAME, NUMBER, UNIT, JOIN = "\u0001", "\u0002", "\u0003", "\u0004"
MARKS = NAME + NUMBER + UNIT + JOIN
_NAMED = r"([^\p{L}\p{N}])(\p{Lu}\p{Ll}+)"
_JOINED = r"([\p{N} ])[-.,](\p{N})"
_BETWEEN = rf"[^\p{{L}}\p{{N}}{NAME}{JOIN}]+"
_ATTACHED = rf" ([\p{{N}}{JOIN}]+)({'|'.join(UNITS)}) "
_NUMBER = rf" ([\p{{N}}{JOIN}]+) "
_UNIT = rf" ({NUMBER}[\p{{N}}{JOIN}]+)  ({'|'.join(UNITS)}) "
_SLOT = rf"([{NAME}{NUMBER}{UNIT}])[\p{{L}}\p{{N}}{NAME}{JOIN}]+"


def _marked(text: Column) -> Column:
    """Words of the text in lower case, two spaces between them and around; slots begin with the mark of their type."""
    named = F.regexp_replace(F.concat(F.lit(" "), F.translate(text, MARKS, ""), F.lit(" ")), _NAMED, f"$1{NAME}$2{NAME}")
    named = F.replace(named, F.lit(f"{NAME} {NAME}"), F.lit(NAME))
    # twice, as a digit between two separators is in one match only
    joined = F.regexp_replace(F.regexp_replace(named, _JOINED, f"$1{JOIN}$2"), _JOINED, f"$1{JOIN}$2")
    joined = F.when(named.rlike(r"\p{N}"), joined).otherwise(named)
    return F.regexp_replace(F.lower(joined), _BETWEEN, "  ")


def _numbered(marked: Column) -> Column:
    """The words with marks at numbers and units, units apart from their numbers."""
    apart = F.regexp_replace(marked, _ATTACHED, " $1  $2 ")
    numbers = F.regexp_replace(apart, _NUMBER, f" {NUMBER}$1 ")
    return F.when(marked.rlike(r" [\p{N}" + JOIN + "]"), F.regexp_replace(numbers, _UNIT, f" $1  {UNIT}$2 ")).otherwise(marked)


def _split(text: Column) -> Column:
    return F.split(F.trim(text), "  ", -1)


def _typed(words: Column) -> Column:
    """Placeholders for slots, as ``windows`` hashes them."""
    first = F.transform(words, lambda w: F.when(_is_slot(w), w.substr(1, 1)).otherwise(w))
    return F.when(words.isNotNull(), first)


def _is_slot(word: Column) -> Column:
    return word.substr(1, 1).isin(NAME, NUMBER, UNIT)


def _sequences(texts: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id`` and the words of every text that has any: ``keys`` are hashes of the canonical words, odd for slots, and
    ``raw`` the words with their values, null without slots."""
    marked, canonical = F.col("marked"), F.col("canonical")
    rows = texts.select(F.col(id_column).alias("id"), _marked(F.col(text_column)).alias("marked"))
    rows = held(held(rows, marked=marked), marked=_numbered(marked)).where(F.length(F.trim(marked)) > 0)
    slots = marked.rlike(f"[{NAME}{NUMBER}]")
    words = _split(F.when(slots, F.regexp_replace(marked, _SLOT, "$1")).otherwise(marked))
    rows = held(rows, canonical=words, raw=F.when(slots, _split(marked)))

    def key(word: Column) -> Column:
        number = F.xxhash64(word)
        return F.when(word.isin(NAME, NUMBER, UNIT), number.bitwiseOR(F.lit(1))).otherwise(F.shiftleft(number, 1))

    return held(rows, keys=F.transform(canonical, key)).select("id", "keys", "raw")


def windows(sequences: DataFrame, sizes: list[int]) -> DataFrame:
    """``id``, ``place``, ``hash`` and ``raw`` of every window of each of ``sizes`` words.

    ``raw`` has the words with their values, null where a window has no slot: the hash then says all that is asked of it.
    Windows of fewer than ``LEAST_WORDS`` words are taken only of texts of just that many.
    """
    n = F.size("keys")
    most = max(sizes)
    # one row per word with those that follow it, null behind the end
    shifted = {f"{c}{k}": F.slice(c, F.lit(k + 1), n) for c in ("keys", "raw") for k in range(most)}
    present = [F.coalesce(c, F.array()) for c in shifted.values()]
    rows = sequences.select("id", F.inline(F.arrays_zip(F.sequence(F.lit(0), n - 1), *present)))
    rows = rows.toDF("id", "place", *shifted)

    def of_size(size: int) -> Column:
        keys, raw = ([F.col(f"{c}{k}") for k in range(size)] for c in ("keys", "raw"))
        own = reduce(Column.bitwiseOR, keys).bitwiseAND(F.lit(1)) == 1
        return F.struct(F.xxhash64(*keys).alias("hash"), F.when(own, F.array(*raw)).alias("raw"))

    def fits(size: int) -> Column:
        inside = F.col(f"keys{size - 1}").isNotNull()
        return inside & (F.col("place") == 0) & F.col(f"keys{size}").isNull() if size < min(LEAST_WORDS, most) else inside

    if len(sizes) == 1:
        return rows.where(fits(most)).select("id", "place", of_size(most).alias("w")).select("id", "place", "w.*")
    each = F.array(*[F.when(fits(size), of_size(size)) for size in sizes])
    return rows.select("id", "place", F.explode(F.array_compact(each)).alias("w")).select("id", "place", "w.*")


def _asked(long: DataFrame, short: DataFrame, window: int) -> DataFrame:
    """Windows of the long items, and the whole sequences of the short ones."""
    long = windows(long, [window])
    long = long.where(F.col("raw").isNull() | (_real_words(F.col("raw")) >= LEAST_WORDS))
    short = short.select("id", F.lit(0).alias("place"), F.xxhash64("keys").alias("hash"), "raw")
    return long.unionByName(short).where(F.col("id").isNotNull()).dropDuplicates()


def _real_words(words: Column) -> Column:
    return F.size(F.filter(words, lambda w: ~_is_slot(w)))


def _value(pair: Column) -> Column:
    return F.struct(*[pair[c].alias(c) for c in ("words", "of_item", "raw")])


def _lost(pairs: Column, values: Column) -> Column:
    """Values of slots that contradict others of their alignment which stand in as many places or more."""

    def different(*fields: str) -> Column:
        return F.size(F.array_distinct(F.transform(values, lambda v: F.struct(*[v[f] for f in fields]))))

    def counted(v: Column) -> Column:
        places = F.size(F.filter(pairs, lambda z: _value(z) == v))
        return F.struct(v.alias("value"), places.alias("places"))

    def contradicts(v: Column, w: Column) -> Column:
        return (v["words"] == w["words"]) & ((v["of_item"] == w["of_item"]) != (v["raw"] == w["raw"]))

    one_to_one = (different("words", "of_item") == F.size(values)) & (different("words", "raw") == F.size(values))
    # counted before they are compared: the optimizer takes counts of two lambda variables for one and the same
    counts = F.transform(values, counted)
    beaten = F.filter(
        counts,
        lambda v: F.exists(counts, lambda w: contradicts(v["value"], w["value"]) & (w["places"] >= v["places"])),
    )
    lost = F.transform(beaten, lambda v: v["value"])
    return F.when(~one_to_one, lost).otherwise(F.slice(values, 1, 0))


def leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    document_id: str = "doc_id",
    item_id: str = "item_id",
    text_column: str = "text",
    window: int = WINDOW,
    share: float = SHARE,
) -> DataFrame:
    """One row per document and item that leaks into it: ids, ``n_windows``, ``share`` and ``verbatim``.

    ``verbatim`` is true where all slots have the item's own values, also those of windows that went.
    """
    items = _sequences(benchmark, item_id, text_column)
    long, short = items.where(F.size("keys") >= window), items.where(F.size("keys") < window)
    # within a sentence the first word of a question may be no name
    text = F.col(text_column)
    lowered = F.concat(F.lower(F.substring(text, 1, 1)), F.substring(text, 2, 1 << 30))
    within = _sequences(benchmark.select(item_id, lowered.alias(text_column)), item_id, text_column)
    short = short.unionByName(within.where(F.size("keys") < window))
    lengths = short.select(F.size("keys").alias("n")).distinct()
    sizes = sorted(row["n"] for row in lengths.collect()) + [window]
    asked = _asked(long, short, window).toDF("item", "item_place", "hash", "of_item")
    total = asked.groupBy("item").agg(F.count_distinct("item_place").alias("total"))
    if asked.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS:
        asked, total = F.broadcast(asked), F.broadcast(total)
    found = windows(_sequences(documents, document_id, text_column), sizes).join(asked, "hash")
    # the words behind equal hashes: one null and one not cannot be equal
    found = held(found, words=_typed(F.col("raw")), item_words=_typed(F.col("of_item")))
    found = found.where(F.col("words").eqNullSafe(F.col("item_words")))
    few = F.coalesce(_real_words(F.col("of_item")) < LEAST_WORDS, F.lit(False))
    found = found.where(~few | F.col("raw").eqNullSafe(F.col("of_item")))
    places = F.sequence(F.col("item_place"), F.col("item_place") + F.size("words") - 1).alias("at")
    pairs = F.when(
        F.col("words").isNotNull(),
        F.filter(F.arrays_zip(places, "words", "of_item", "raw"), lambda z: z["words"].isin(NAME, NUMBER, UNIT)),
    ).alias("pairs")
    aligned = found.select("id", "item", "item_place", (F.col("place") - F.col("item_place")).alias("shift"), pairs)
    alignments = aligned.groupBy("id", "item", "shift").agg(
        F.collect_set(F.struct("item_place", "pairs")).alias("windows"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
    )
    alignments = held(alignments, values=F.array_distinct(F.transform("pairs", _value)))
    alignments = held(alignments, lost=_lost(F.col("pairs"), F.col("values")))
    stays = F.filter(
        "windows",
        lambda w: w["pairs"].isNull() | ~F.exists(w["pairs"], lambda z: F.array_contains("lost", _value(z))),
    )
    same = F.forall("pairs", lambda z: z["of_item"] == z["raw"])
    covered = (
        alignments.select("id", "item", same.alias("same"), F.explode(stays["item_place"]).alias("place"))
        .groupBy("id", "item")
        .agg(F.count_distinct("place").alias("n_windows"), F.min("same").alias("verbatim"))
    )
    part = F.col("n_windows") / F.col("total")
    return (
        covered.join(total, "item")
        .where(part >= share)
        .select(F.col("id").alias(document_id), F.col("item").alias(item_id), "n_windows", part.alias("share"), "verbatim")
    )


def leaks_sql(window: int = WINDOW, share: float = SHARE) -> str:
    """``leaks`` of documents and benchmark in DuckDB's SQL; windows are compared as text."""
    name, number, unit, join = (f"chr({ord(x)})" for x in MARKS)
    units = "|".join(UNITS)
    digits = rf"([\p{{N}}' || {join} || ']+)"

    def replaced(text: str, pattern: str, by: str) -> str:
        return f"regexp_replace({text}, '{pattern}', {by}, 'g')"

    def texts(table: str, key: str, text: str = "text") -> str:
        clean = f"' ' || translate({text}, {name} || {number} || {unit} || {join}, '') || ' '"
        named = replaced(clean, _NAMED, rf"'\1' || {name} || '\2' || {name}")
        named = f"replace({named}, {name} || ' ' || {name}, {name})"
        joined = replaced(replaced(named, _JOINED, rf"'\1' || {join} || '\2'"), _JOINED, rf"'\1' || {join} || '\2'")
        words = replaced(f"lower({joined})", rf"[^\p{{L}}\p{{N}}' || {name} || {join} || ']+", "'  '")
        apart = replaced(words, rf" {digits}({units}) ", r"' \1  \2 '")
        numbers = replaced(apart, rf" {digits} ", rf"' ' || {number} || '\1 '")
        marked = replaced(numbers, rf" (' || {number} || '{digits[1:-1]})  ({units}) ", rf"' \1  ' || {unit} || '\2 '")
        return f"""
    SELECT id, string_split(trim(marked), '  ') AS raw FROM (
        SELECT {key} AS id, {marked} AS marked FROM {table} WHERE text IS NOT NULL AND {key} IS NOT NULL)
    WHERE trim(marked) <> ''"""

    slots = f"[{name}, {number}, {unit}]"
    slot = f"list_contains({slots}, w[1])"
    typed = f"list_transform(raw, lambda w: CASE WHEN {slot} THEN w[1] ELSE w END)"
    real = f"len(list_filter(raw, lambda w: NOT {slot}))"

    def cut(table: str, fits: str, size: str) -> str:
        return f"""
    SELECT id, place, raw[place + 1:place + {size}] AS raw, {size} AS size FROM (
        SELECT id, raw, size, unnest(range(len(raw) - {size} + 1)) AS place FROM {table} WHERE {fits})"""

    return f"""
WITH items AS (
    SELECT *, len(raw) AS size FROM ({texts("benchmark", "item_id")})
    UNION ALL
    SELECT *, len(raw) AS size FROM ({texts("benchmark", "item_id", "(lower(text[1]) || text[2:])")})
    WHERE len(raw) < {window}
),
asked AS (
    SELECT DISTINCT id, place, raw, size, {typed} AS words, {real} AS n_real FROM (
        {cut("items", f"size >= {window}", str(window))} UNION ALL {cut("items", f"size < {window}", "size")})
    WHERE size < {window} OR {real} >= {LEAST_WORDS}
),
total AS (SELECT id AS item_id, count(DISTINCT place) AS total FROM asked GROUP BY id),
sizes AS (SELECT DISTINCT size FROM asked UNION SELECT {window}),
sequences AS ({texts("documents", "doc_id")}),
sized AS (
    SELECT id, raw, size FROM sequences, sizes
    WHERE len(raw) = size OR (len(raw) > size AND size >= {LEAST_WORDS})
),
cuts AS (SELECT id, place, raw, {typed} AS words FROM ({cut("sized", "true", "size")})),
found AS (
    SELECT DISTINCT d.id AS doc_id, a.id AS item_id, a.place, d.place - a.place AS shift, a.raw AS of_item, d.raw AS raw,
        a.words AS words
    FROM cuts d JOIN asked a ON a.words = d.words WHERE a.n_real >= {LEAST_WORDS} OR a.raw = d.raw
),
pairs AS (
    SELECT doc_id, item_id, shift, place, place + i AS spot, words[i] AS type, of_item[i] AS of_item, raw[i] AS raw
    FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM found) WHERE list_contains({slots}, words[i])
),
counts AS (
    SELECT doc_id, item_id, shift, type, of_item, raw, count(DISTINCT spot) AS places FROM pairs GROUP BY ALL
),
lost AS (
    SELECT DISTINCT v.doc_id, v.item_id, v.shift, v.type, v.of_item, v.raw
    FROM counts v JOIN counts w USING (doc_id, item_id, shift, type)
    WHERE (v.of_item = w.of_item) <> (v.raw = w.raw) AND w.places >= v.places
),
gone AS (
    SELECT DISTINCT doc_id, item_id, shift, place FROM pairs JOIN lost USING (doc_id, item_id, shift, type, of_item, raw)
),
same AS (SELECT doc_id, item_id, shift, bool_and(of_item = raw) AS same FROM pairs GROUP BY ALL),
stays AS (
    SELECT doc_id, item_id, place, coalesce(same, true) AS same
    FROM (SELECT DISTINCT doc_id, item_id, shift, place FROM found) f ANTI JOIN gone USING (doc_id, item_id, shift, place)
    LEFT JOIN same USING (doc_id, item_id, shift)
)
SELECT doc_id, item_id, n_windows, n_windows / total AS share, verbatim
FROM (SELECT doc_id, item_id, count(DISTINCT place) AS n_windows, bool_and(same) AS verbatim
      FROM stays GROUP BY doc_id, item_id)
JOIN total USING (item_id) WHERE n_windows / total >= {share!r}"""
