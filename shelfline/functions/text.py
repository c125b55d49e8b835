"""Text helpers that stay inside Spark's built-in functions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F


def _accents() -> tuple[str, str]:
    """Lower-case Latin letters with marks, and their bare letters."""
    marked, bare = [], []
    for code in range(0x00C0, 0x1F00):
        letter = chr(code)
        base = unicodedata.normalize("NFD", letter)[0]
        if letter.islower() and base != letter and base.isascii():
            marked.append(letter)
            bare.append(base)
    return "".join(marked) + "đ", "".join(bare) + "d"


_MARKED, _BARE = _accents()

# Unit spellings and their factor to the base unit (g, ml, piece).
UNITS = {
    "kg": ("g", 1000.0),
    "g": ("g", 1.0),
    "l": ("ml", 1000.0),
    "cl": ("ml", 10.0),
    "ml": ("ml", 1.0),
    "pcs": ("piece", 1.0),
}


def canonical_name(name: Column) -> Column:
    """Lower case, no accents or punctuation, tokens sorted."""
    plain = F.translate(F.lower(name), _MARKED, _BARE)
    words = F.split(F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " ")), " ")
    return F.array_join(F.array_sort(words), " ")


def parse_pack(name: Column) -> Column:
    """Struct (pack_count, unit_size, unit, content) read from a product name.

    "6 x 330ml" gives 6, 330, ml and 1980; a single size has count 1; a name
    without a size gives nulls. ``content`` is in g, ml or pieces.
    """
    text = F.lower(name)
    pattern = r"(?:(\d+)\s*x\s*)?(\d+(?:[.,]\d+)?)\s*(kg|g|ml|cl|l|pcs)\b"
    count = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    size = F.nullif(F.regexp_extract(text, pattern, 2), F.lit(""))
    unit = F.nullif(F.regexp_extract(text, pattern, 3), F.lit(""))
    size = F.replace(size, F.lit(","), F.lit(".")).try_cast("double")
    count = F.when(unit.isNotNull(), F.coalesce(count.try_cast("int"), F.lit(1)))
    factor = F.create_map(*[F.lit(x) for u, (_, f) in UNITS.items() for x in (u, f)])
    base = F.create_map(*[F.lit(x) for u, (b, _) in UNITS.items() for x in (u, b)])
    return F.struct(
        count.alias("pack_count"),
        size.alias("unit_size"),
        F.try_element_at(base, unit).alias("unit"),
        (count * size * F.try_element_at(factor, unit)).alias("content"),
    )


def near_keys(text: Column, distance: int) -> Column:
    """All strings left after deleting up to ``distance`` characters.

    Two strings within that edit distance always share one of them, so an
    equality join on these keys finds every close pair without comparing all.
    """
    keys = F.array(text)
    for _ in range(distance):
        shorter = F.flatten(F.transform(keys, lambda s: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))),
            lambda i: F.concat(F.substring(s, F.lit(1), i - 1),
                               F.substring(s, i + 1, F.length(s))))))
        keys = F.array_distinct(F.concat(keys, shorter))
    return keys
