"""Surrogate keys and table-name parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A separator and a null mark that no business key contains, so ('a', null) and ('a-', '') differ.
SEPARATOR = chr(31)
NULL_MARK = "<null>"


def surrogate_key(*parts: Column | str) -> Column:
    """MD5 over the parts; null parts count, so the key itself is never null."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in cols]))


def packed(key: Column | str) -> Column:
    """A digest in hex as its 16 bytes, half as much to shuffle; other keys as their text after 17 zero bytes."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    is_digest = text.rlike(r"^[0-9a-f]{32}\z")
    return F.when(is_digest, F.unhex(text)).otherwise(F.concat(F.lit(bytearray(17)), F.encode(text, "UTF-8")))


def unpacked(key: Column | str) -> Column:
    """The text that ``packed`` was given."""
    data = F.col(key) if isinstance(key, str) else key
    text = F.decode(F.substring(data, F.lit(18), F.octet_length(data)), "UTF-8")
    return F.when(F.octet_length(data) == 16, F.lower(F.hex(data))).otherwise(text)


def source_of(name: Column | str) -> Column:
    """Last part of a ``layer__subject__source`` name."""
    return F.element_at(F.split(name, "__"), -1)


def name_parts(name: Column | str) -> Column:
    """``layer__subject__source`` as a struct; null unless there are exactly three parts."""
    parts = F.split(name, "__")
    return F.when(
        F.size(parts) == 3,
        F.struct(parts[0].alias("layer"), parts[1].alias("subject"), parts[2].alias("source")),
    )
