"""Sharding into near-equal bytes by histogram sort.

Rows are ordered by (id, place in the input). Splitters that cut the order into parts of equal bytes are
sought by probing: each round counts, in one aggregate, the exact bytes and rows between all
candidate boundaries; every splitter keeps the two probes around its goal, and the next
round probes between them. When each splitter is within the tolerance (or no key lies between its
probes), rows are exchanged once, into parts whose places in their shard are already known.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.session import kept, width

SHARDS = 8
# Probes between the two bounds of a splitter in one round.
PROBES = 6
# A shard's splitter may miss its goal by this share of a shard's bytes.
TOLERANCE = 0.001
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
_ROWS = 1 << 63  # the input place fills the lower 63 bits of a key


def _pairs(keys: list[int]) -> Column:
    """Array of keys as structs (id, place), as one SQL text."""
    def part(key: int) -> str:
        number, row = divmod(key, _ROWS)
        # The least long cannot be written as a literal.
        text = f"{number}L" if number > _LOW else f"(-{_HIGH}L - 1L)"
        return f"struct({text} AS k, {row}L AS r)"

    return F.expr(f"array({', '.join(map(part, keys))})")


def _part(keys: list[int]) -> Column:
    """How many of the ascending keys are at or below the row's (k, r): a coarse look, then a fine one."""
    if not keys:
        return F.lit(0)
    step = max(1, isqrt(len(keys)))
    key = F.struct("k", "r")
    start = F.greatest(F.size(F.filter(_pairs(keys[::step]), lambda e: e <= key)) - 1, F.lit(0)) * step
    return F.transform(F.array(start), lambda s: s + F.size(
        F.filter(F.slice(_pairs(keys), s + 1, step), lambda e: e <= key)))[0]


def splitters(rows: DataFrame, shards: int, fine: int, tolerance: float = TOLERANCE,
              probes: int = PROBES) -> list[int]:
    """Keys that cut rows (k, r, size) into shards of near-equal bytes, and each into ``fine`` parts.

    A shard's splitter misses its goal by at most ``tolerance`` of a shard or, where one row is larger, by that
    row; those within a shard only spread the work and may miss theirs by a tenth of a part. The driver holds a
    few numbers per part.
    """
    parts = shards * fine
    ends = rows.agg(F.min("k"), F.max("k"), F.max("r"), F.sum("size")).first()
    total = int(ends[3] or 0)
    if not total:
        return []
    first, last = ends[0] * _ROWS, ends[1] * _ROWS + ends[2] + 1
    goals = [total * i / parts for i in range(1, parts)]
    # Bounds of each splitter: the largest known key with too few bytes below, the least with enough.
    low = [(first, 0)] * len(goals)
    high = [(last, total)] * len(goals)
    found: list[int | None] = [None] * len(goals)
    while None in found:
        tried: set[int] = set()
        for i, done in enumerate(found):
            if done is None:
                gap = high[i][0] - low[i][0]
                near = (goals[i] - low[i][1]) / max(1, high[i][1] - low[i][1])
                # Even probes, and two around where the goal would be if bytes were spread evenly.
                spots = [(j + 1) / (probes - 1) for j in range(probes - 2)] + [near * 0.98, near * 1.02]
                tried |= {min(max(low[i][0] + int(gap * min(spot, 1)), low[i][0] + 1), high[i][0] - 1)
                          for spot in spots}
        keys = sorted(tried)
        counts = {r["part"]: r["n"] for r in rows.groupBy(_part(keys).alias("part"))
                  .agg(F.sum("size").alias("n")).collect()}
        below, known = 0, []
        for j, key in enumerate(keys):
            below += int(counts.get(j, 0))
            known.append((key, below))
        for i, goal in enumerate(goals):
            if found[i] is not None:
                continue
            low[i] = max([low[i], *(k for k in known if k[1] < goal)])
            high[i] = min([high[i], *(k for k in known if k[1] >= goal)])
            best = min(low[i], high[i], key=lambda k: abs(k[1] - goal))
            miss = tolerance * total / shards if (i + 1) % fine == 0 else 0.1 * total / parts
            if abs(best[1] - goal) <= miss or high[i][0] - low[i][0] <= 1:
                found[i] = best[0]
    return sorted(found)


def shard(docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = SHARDS,
          tolerance: float = TOLERANCE, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: ``id``, size (UTF-8 bytes of the text, a null having none, plus 1), text_crc32,
    shard and slot (its place in the shard, from 0 without gaps), and the columns ``keep``.

    Shards follow the order of ids (a null id first; equal ids in input order), sizes are near equal
    however many rows share an id or a text: equal texts are not kept together. Each shard is
    cut into parts of its own, so no task sorts a whole shard. An empty table gives no rows.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    base = kept(docs.select(
        F.col(id).alias("id"), F.coalesce(F.col(id).cast("long"), F.lit(_LOW)).alias("k"),
        F.monotonically_increasing_id().alias("r"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]))
    slim = base.select("k", "r", "size")
    fine = -(-width(docs.sparkSession) // shards)
    keys = splitters(slim, shards, fine, tolerance)
    part = _part(keys).cast("long")
    counts = {r["part"]: r["n"] for r in slim.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    # Rows of the shard that stand before each of its parts: as many numbers as there are parts.
    offsets, before = [], 0
    for i in range(shards * fine):
        before = 0 if i % fine == 0 else before
        offsets.append(before)
        before += counts.get(i, 0)
    at = F.get(F.array(*[F.lit(n).cast("long") for n in offsets]), F.col("part").cast("int"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("k", "r")) - 1
    return (base.withColumn("part", part)
            .select(F.col("id").alias(id), "size", "text_crc32", F.floor(F.col("part") / fine).cast("int").alias("shard"),
                    (at + place).cast("long").alias("slot"),
                    *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)]))


def write_shards(docs: DataFrame, folder: str, **options) -> None:
    """Write whole documents as one folder per shard, in the order of their slots within each file.

    Columns named size, text_crc32, shard or slot give way to those of the shards. Null and empty texts, null ids and
    rows that repeat are written like any other; an empty table makes no folder.
    """
    keep = tuple(c for c in docs.columns if c not in {options.get("id", "doc_id"), "size", "text_crc32", "shard", "slot"})
    out = shard(docs, keep=keep, **options)
    out.write.mode("overwrite").partitionBy("shard").parquet(folder)
