"""Secret scan with built-in functions only: patterns, and Shannon entropy over sliding windows.

Patterns give spans of the kinds assign, access and hex. Besides, every string of 24 or more characters of the base64
alphabet that has a letter and a digit is a candidate. A window of ``WINDOW`` characters slides over it; the counts of
its characters change by one in and one out at every step, and so does the sum of count * log2(count), from which
the entropy follows. A candidate whose windows reach its class's limit (hex or mixed) gives a span of kind entropy
from the first such window to the end of the last. Candidates that the allow list knows are left alone: identifiers, paths,
placeholder words that stand alone between separators, and mere alphabets; such a word inside a secret hides nothing.

Everything happens within a row: no shuffle, no Python. Positions are code points, ends exclusive.

Null and empty texts have no spans. Rows that repeat are scanned alike, other columns stay as they are; a column named
like one this module adds is replaced.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
# The patterns of the base kinds; the length each match, or its secret, must have.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LENGTH = 6

CANDIDATE = r"[A-Za-z0-9+/_=-]{24,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
HEX_LIMIT, MIXED_LIMIT = 3.05, 3.85  # bits
# Repeated groups are possessive, so that Java takes them in a loop: no deep stack and no second try for a long candidate.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    r"(?i)(^|[+/_=-])(example|sample|placeholder|x{4,})([+/_=-]|$)",  # as a word of its own
    r"(?i)^(?:0?1234567890?|abcdefgh(?:ijklmnopqrstuvwxyz)?|abcdef|[+/_=-])++$",  # nothing but alphabets and counting
    r"^[A-Za-z]++(?:[/_-][A-Za-z]++)*+(?:[/_-][0-9]++)++/?$",  # paths and slugs that end in a number
)
SUMS_BLOCK = 512


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _before(lengths: str) -> str:
    """Sum of the lengths before each element, in blocks so that a long list does not take quadratic time."""
    add = "(sums, n) -> concat(sums, array(element_at(sums, -1) + n))"
    blocks = (
        f"transform(sequence(0, cast((size(v) - 1) div {SUMS_BLOCK} as int)),"
        f" b -> slice(v, b * {SUMS_BLOCK} + 1, {SUMS_BLOCK}))"
    )
    first = f"aggregate(transform(z.blocks, b -> aggregate(b, 0, (s, n) -> s + n)), array(0), {add})"
    inside = f"flatten(transform(y.blocks, (b, i) -> slice(aggregate(b, array(y.first[i]), {add}), 1, size(b))))"
    return (
        f"flatten(transform(transform(transform(array({lengths}), v -> named_struct('blocks', {blocks})),"
        f" z -> named_struct('blocks', z.blocks, 'first', {first})), y -> {inside}))"
    )


def _matches(text: str, pattern: str, kind: int, keep: str = "true", group: int = 0) -> str:
    """Array of (start, kind, end, match) of the matches, if ``keep`` holds for its ``secret`` (the group's text)."""
    pattern = _quoted(pattern)
    found = f"regexp_extract_all({text}, {pattern}, 0)"
    secrets = f"regexp_extract_all({text}, {pattern}, {group})" if group else found
    # x: matches, their secrets, and the text before and between them
    x = f"named_struct('m', {found}, 'g', {secrets}, 'p', split({text}, {pattern}, -1))"
    lengths = "transform(x.m, (m, i) -> length(x.p[i]) + length(m))"
    rows = (
        "transform(y.x.m, (m, i) -> named_struct('start', y.before[i] + length(y.x.p[i]),"
        f" 'kind', {kind}, 'end', y.before[i] + length(y.x.p[i]) + length(m), 'match', m, 'secret', y.x.g[i]))"
    )
    spans = (
        f"flatten(transform(transform(array({x}), x -> named_struct('x', x, 'before', {_before(lengths)})), y -> {rows}))"
    )
    kept = f"filter({spans}, s -> {keep})" if keep != "true" else spans
    return f"CASE WHEN {text} RLIKE {pattern} THEN {kept} ELSE {NONE} END"


NONE = "cast(array() as array<struct<start:int,kind:int,end:int,match:string,secret:string>>)"


def _entropy_spans(candidates: str, window: int, hex_limit: float, mixed_limit: float) -> str:
    """The windows of each candidate that reach its limit, as one span."""
    weight = "array(" + ", ".join(f"{n * log2(n) if n else 0.0!r}D" for n in range(window + 2)) + ")"
    most = [window * (log2(window) - limit) for limit in (hex_limit, mixed_limit)]
    limit = f"IF(c.match RLIKE '^[0-9a-fA-F]+$', {most[0]!r}D, {most[1]!r}D)"
    # the characters' numbers, once per candidate
    codes = f"transform(regexp_extract_all(s.match, '.', 0), ch -> locate(ch, {_quoted(ALPHABET)}) - 1)"
    candidates = f"transform({candidates}, s -> named_struct('start', s.start, 'match', s.match, 'codes', {codes}))"
    enters = "c.codes[i - 1]"
    leaves = f"IF(i > {window}, c.codes[i - {window} - 1], -1)"
    # t: what comes in and goes out at this step; counts before it
    step = f"named_struct('a', a, 'i', i, 'e', {enters}, 'l', {leaves})"
    minus = "IF(t.l < 0, 0D, {w}[t.a.counts[t.l]] - {w}[t.a.counts[t.l] - 1])".replace("{w}", weight)
    had = "(t.a.counts[t.e] - IF(t.e = t.l, 1, 0))"
    total = f"(t.a.total - {minus} + {weight}[{had} + 1] - {weight}[{had}])"
    hit = f"(u.t.i >= {window} AND u.total <= u.t.a.most)"
    state = (
        "named_struct("
        "'counts', transform(u.t.a.counts, (n, j) -> n + IF(j = u.t.e, 1, 0) - IF(j = u.t.l, 1, 0)), 'total', u.total,"
        f" 'first', IF({hit} AND u.t.a.first = 0, u.t.i - {window} + 1, u.t.a.first),"
        f" 'last', IF({hit}, u.t.i, u.t.a.last), 'most', u.t.a.most)"
    )
    turn = (
        f"transform(transform(array({step}), t -> named_struct('t', t, 'total', {total})), u -> {state})[0]"
    )
    zero = f"named_struct('counts', array_repeat(0, {len(ALPHABET)}), 'total', 0D, 'first', 0, 'last', 0, 'most', {limit})"
    slide = f"aggregate(sequence(1, size(c.codes)), {zero}, (a, i) -> {turn})"
    windows = f"transform({candidates}, c -> named_struct('c', c, 'w', {slide}))"
    span = "named_struct('start', h.c.start + h.w.first - 1, 'kind', 3, 'end', h.c.start + h.w.last)"
    return f"transform(filter({windows}, h -> h.w.first > 0), h -> {span})"


def scan(
    documents: DataFrame,
    text_column: str = "text",
    window: int = WINDOW,
    hex_limit: float = HEX_LIMIT,
    mixed_limit: float = MIXED_LIMIT,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """``documents`` with ``spans``: an array of (start, kind, end), by start and then by kind; kind is an index into KINDS."""
    text = f"coalesce(`{text_column}`, '')"
    base = [
        _matches(text, ASSIGN, 0, f"length(s.secret) >= {ASSIGN_LENGTH}", group=2),
        _matches(text, ACCESS, 1),
        _matches(text, HEX, 2),
    ]
    keep = ["s.match RLIKE '[0-9]'", "s.match RLIKE '[A-Za-z]'"]
    keep += [f"NOT s.match RLIKE {_quoted(pattern)}" for pattern in allowed]
    entropy = _entropy_spans(_matches(text, CANDIDATE, 3, " AND ".join(keep)), window, hex_limit, mixed_limit)
    plain = "transform({}, s -> named_struct('start', s.start, 'kind', s.kind, 'end', s.end))"
    arrays = ", ".join([*[plain.format(spans) for spans in base], entropy])
    return documents.withColumn("spans", F.expr(f"array_sort(concat({arrays}))"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    one = F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"]))
    return F.array_join(one, ",")


def mask(scanned: DataFrame, text_column: str = "text", mark: str = "<secret>") -> DataFrame:
    """Texts of ``scan`` with ``mark`` in place of every span; spans that touch or overlap get one mark."""
    joined = """aggregate(spans, cast(array() as array<struct<start:int,end:int>>), (done, s) ->
        CASE WHEN size(done) > 0 AND s.start <= done[size(done) - 1].end
             THEN concat(slice(done, 1, size(done) - 1), array(named_struct(
                 'start', done[size(done) - 1].start, 'end', greatest(done[size(done) - 1].end, s.end))))
             ELSE concat(done, array(named_struct('start', s.start, 'end', s.end))) END)"""
    text = f"`{text_column}`"
    pieces = f"""transform({joined}, x -> x)"""
    masked = f"""CASE WHEN size(spans) = 0 THEN {text} ELSE array_join(flatten(transform(array({pieces}), m -> concat(
        transform(m, (x, i) -> concat(
            substring({text}, IF(i = 0, 0, m[i - 1].end) + 1, x.start - IF(i = 0, 0, m[i - 1].end)), {_quoted(mark)})),
        array(substring({text}, m[size(m) - 1].end + 1))))), '') END"""
    return scanned.withColumn(text_column, F.expr(masked))
