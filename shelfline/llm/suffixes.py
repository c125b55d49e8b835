"""Removal of repeated byte strings by difference-cover sampling of suffixes.

A byte is removed if a string of LENGTH bytes that covers it starts anywhere else too. Deciding this takes the
suffix array only up to LENGTH bytes, and of it only which suffixes stand next to one that is equal
so far. The steps of the difference-cover algorithm serve that, adapted to many documents:

* *Triples, recursively.* The name of a suffix at level 0 is its byte; at each further level the
  names of three suffixes that follow each other are named together. Five levels name 243 bytes. A name is a hash of
  the triple rather than its rank, so naming needs no sort over all documents.
* *Sample.* Of each WINDOW neighbouring suffixes the one with the least level-3 name is sampled. Any two equal strings
  of LENGTH bytes hold a sampled suffix at the same distance, as with a difference cover of positions,
  but one in WINDOW / 2 suffixes is sampled instead of two in three. Sampled suffixes are
  brought together by name across all documents, and those with a name of their own are settled.
* *The rest.* The suffixes that have the same sampled one next to them form a class [lo, hi]. If the whole string of a class,
  from lo to hi + LENGTH, occurs again, all of them are repeated.
* *Adjacent prefixes.* Only where a name is shared but a class is not are single suffixes compared, on their first
  LENGTH bytes, with one representative of every other class of that name.

The same steps over words instead of bytes find passages of over 50 words that other documents hold too (``PASSAGES``); these
are reported, not removed. What strings are made of is a ``Unit``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.common import by_batches
from shelfline.session import dropped, kept, scratch

LENGTH = 400
# Start positions worked on at once: bounds the memory of a worker whatever the text's size.
_SLAB = 1 << 18
_PLACE = np.uint64((1 << 24) - 1)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_hashes(data: bytes) -> bytes:
    """A hash of 8 bytes for each word, worked out piece by piece."""
    parts, at = [], 0
    while at < len(data):
        gap = _SPACE.search(data, at + _SLAB)
        end = gap.start() if gap else len(data)
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, data[at:end].split()), np.uint64).tobytes())
        at = end
    return b"".join(parts)


class Unit(NamedTuple):
    """What strings are made of, and which of them count as repeated."""

    read: Callable[[bytes], bytes]  # the units of a text, one after the other
    size: int  # bytes of a unit
    length: int  # units of a string
    window: int  # suffixes of which one is sampled; window - 1 + 3 ** levels units must lie within length
    levels: int
    sampled_by: int
    apart: bool  # strings count if another document holds them, else if they start anywhere else


BYTES = Unit(bytes, 1, LENGTH, 128, 5, 3, False)
PASSAGES = Unit(word_hashes, 8, 51, 32, 2, 1, True)


def names(data: np.ndarray, levels: int) -> list[np.ndarray]:
    """Names of all suffixes at each level; a level's triple spans three times the units of the one before."""
    out, name, step = [], data.astype(np.uint64), 1
    for _ in range(levels):
        n = len(name) - 2 * step
        if n <= 0:
            break
        mixed = name[:n] * _A
        mixed ^= (name[step:step + n] + _B) * _C
        mixed ^= mixed >> np.uint64(29)
        mixed += name[2 * step:2 * step + n]
        mixed *= _B
        mixed ^= mixed >> np.uint64(32)
        out.append(mixed)
        name, step = mixed, 3 * step
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` (a power of two) neighbouring values."""
    step = 1
    while step < width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return values


def classes(data: bytes, starts: np.ndarray, unit: Unit = BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the ascending start positions: first, last, name of the sampled suffix."""
    levels = names(np.frombuffer(data, f"u{unit.size}"), unit.levels)
    by = levels[unit.sampled_by - 1]
    places = _PLACE - np.arange(len(by), dtype=np.uint64)  # of equal names, the rightmost is least
    least = _least(by & ~_PLACE | places, unit.window)[starts]
    sampled = (_PLACE - (least & _PLACE)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (np.diff(sampled) != 0) | (np.diff(starts) != 1)])
    return (starts[new], starts[np.r_[new[1:] - 1, len(starts) - 1]],
            levels[unit.levels - 1][sampled[new]].view(np.int64))


def _slabs(rows: Iterator[tuple[int, int, bytes]], unit: Unit):
    """Pieces of texts put together: units, start positions, and per piece where it begins, whose it is."""
    parts, owners, size = [], [], 0
    for k1, k2, data in rows:
        for at in range(0, len(data) // unit.size - unit.length + 1, _SLAB):
            piece = data[at * unit.size:(at + _SLAB + unit.length - 1) * unit.size]
            parts.append(piece)
            owners.append((size, k1, k2, at))
            size += len(piece) // unit.size
            if size >= _SLAB:
                yield b"".join(parts), owners
                parts, owners, size = [], [], 0
    if parts:
        yield b"".join(parts), owners


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def class_rows(docs: DataFrame, unit: Unit = BYTES) -> DataFrame:
    """Classes of all texts: name, whole (hash of the class's string), owner (k1, k2), lo and hi in the text."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (unit.read(t.encode()) for t in batch.column("text").to_pylist())
            for data, owners in _slabs(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), texts), unit):
                begins = np.array([o[0] for o in owners])
                ends = np.r_[begins[1:], len(data) // unit.size]
                starts = np.concatenate([np.arange(a, b - unit.length + 1) for a, b in zip(begins, ends)])
                lo, hi, name = classes(data, starts, unit)
                digest = xxhash.xxh3_64_intdigest
                whole = np.array([digest(data[a:b]) for a, b in zip((lo * unit.size).tolist(),
                                                                    ((hi + unit.length) * unit.size).tolist())], np.uint64)
                piece = np.searchsorted(begins, lo, side="right") - 1
                shift = np.array([o[3] for o in owners])[piece] - begins[piece]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name), pa.array(whole.view(np.int64)),
                     pa.array(np.array([o[1] for o in owners])[piece]), pa.array(np.array([o[2] for o in owners])[piece]),
                     pa.array((lo + shift).astype(np.int32)), pa.array((hi + shift).astype(np.int32))],
                    ["name", "whole", "k1", "k2", "lo", "hi"])

    return by_batches(docs.select("k1", "k2", "text"), work,
                      "name long, whole long, k1 long, k2 long, lo int, hi int")


# What goes with the string of a class: how many there are, whether they are repeated, the least and greatest holder.
_CLASS = ("name", "whole", "n", "repeated", "least", "most")


def _strings(docs: DataFrame, wanted: DataFrame, unit: Unit) -> DataFrame:
    """The strings of the wanted classes: _CLASS, k1, k2, lo, data."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for k1, k2, text, asked in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "text", "asked")]):
                data = unit.read(text.encode())
                rows += [(*[a[c] for c in _CLASS], k1, k2, a["lo"],
                          data[a["lo"] * unit.size:(a["hi"] + unit.length) * unit.size]) for a in asked]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(),
                     pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            columns = list(zip(*rows)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             [*_CLASS, "k1", "k2", "lo", "data"])

    asked = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct(*_CLASS, "lo", "hi")).alias("asked"))
    joined = docs.select("k1", "k2", "text").join(asked.hint("shuffle_hash"), ["k1", "k2"])
    return by_batches(joined, work, "name long, whole long, n long, repeated boolean, least long, most long, "
                      "k1 long, k2 long, lo int, data binary")


def _prefixes(strings: DataFrame, unit: Unit, carried: list[str], placed: bool = False) -> DataFrame:
    """Each suffix of the classes' strings with the hash of its first units, the carried columns and, if asked, its place."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, size, span = xxhash.xxh3_64_intdigest, unit.size, unit.length * unit.size
        for batch in batches:
            data = batch.column("data").to_pylist()
            counts = np.array([(len(d) - span) // size + 1 for d in data], np.int64)
            hashes = np.array([digest(d[i:i + span]) for d in data for i in range(0, len(d) - span + 1, size)], np.uint64)
            columns = {"prefix": hashes.view(np.int64)}
            columns |= {c: np.repeat(batch.column(c).to_numpy(), counts) for c in carried}
            if placed:
                within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                columns["at"] = within.astype(np.int32)
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns.values())), list(columns))

    kinds = [f"{c} {strings.schema[c].dataType.simpleString()}" for c in carried]
    return by_batches(strings.select(*carried, "data"), work, ", ".join(["prefix long", *kinds] + ["at int"] * placed))


def _of_shared_names(rows: DataFrame, told: str) -> DataFrame:
    """Class rows whose name is not settled by itself. All rows are worked out once and written until that is known."""
    spark, path = rows.sparkSession, scratch(rows.sparkSession)
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    # Written too, so that the join stands on two plain exchanges and Spark can split a hot name.
    names = kept(rows.groupBy("name").agg(F.expr(told).alias("told")).filter("told").select("name"))
    out = kept(rows.join(names.hint("shuffle_hash"), "name", "left_semi"))
    dropped(spark, path)
    return out


def repeated_spans(docs: DataFrame, unit: Unit = BYTES) -> DataFrame:
    """Strings of repeated units, as rows (k1, k2, start, end), of texts with keys k1 and k2.

    Spans of a text may overlap. Copies of a string are counted before anything is joined, and joins are on names
    and keys only, so a passage in a third of all documents is a hot key that Spark splits. Documents are told
    apart by k1.
    """
    rows = _of_shared_names(class_rows(docs, unit), "min(k1) <> max(k1)" if unit.apart else "count(1) > 1")
    holders = [F.min("k1").alias("least"), F.max("k1").alias("most")] if unit.apart else []
    found = kept(rows.groupBy("name", "whole").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("k1", "k2", "lo", "hi")], *holders))
    if unit.apart:
        found = found.withColumn("repeated", F.expr("least <> most"))
    else:  # each class is a holder of its own
        found = found.withColumns({"repeated": F.expr("n > 1"), "least": F.col("whole"), "most": F.col("whole")})
    mixed = found.groupBy("name").agg(F.min("least").alias("least"), F.max("most").alias("most"),
                                      F.min("repeated").alias("all")).filter("least <> most AND NOT all").select("name")
    wanted = kept(found.join(mixed, "name", "left_semi").select(*_CLASS, "k1", "k2", "lo", "hi"))
    strings = kept(_strings(docs, wanted, unit))
    held = ["name", "least", "most"] if unit.apart else ["name"]
    told = F.expr("min(least) <> max(most)" if unit.apart else "count(1) > 1").alias("told")
    shared = kept(_prefixes(strings, unit, held).groupBy("name", "prefix").agg(told).filter("told").select("name", "prefix"))
    single = (_prefixes(strings.filter("NOT repeated"), unit, ["name", "whole", "n", "k1", "k2", "lo"], True)
              .join(shared, ["name", "prefix"]))
    again = found.filter("repeated").select("name", "whole", F.lit(None).cast("int").alias("at"))
    if unit.apart:  # one document can hold several strings of a class that others hold in part
        single = kept(single)
        again = again.unionByName(single.filter("n > 1").select("name", "whole", "at"))
    settled = kept(rows.join(again, ["name", "whole"]).select(
        "k1", "k2", F.expr("lo + coalesce(at, 0)").alias("start"),
        (F.expr("coalesce(lo + at, hi)") + unit.length).alias("end")).distinct())
    return settled.unionByName(single.filter("n = 1").select(
        "k1", "k2", F.expr("lo + at").alias("start"), (F.expr("lo + at") + unit.length).alias("end")))


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``id``, n_bytes, n_removed, n_spans, spans (maximal removed runs), kept_bytes, n_shared_words and passages.

    Strings are judged on the input. Each of several equal strings goes, in one document or many, so all copies of a
    text of LENGTH bytes or more are emptied. A null text is empty, shorter texts stay whole; repeated rows
    count as copies and get a row each. What is kept may cut through characters, so it is binary.
    Passages are the maximal runs of words, by their numbers, covered by strings of over 50 words that another
    document holds too, whatever stands between the words and however many bytes they have. They are only
    reported. Rows that agree in id and text are one document.
    """
    taken = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                        F.xxhash64(id, text).alias("k1"), F.xxhash64(F.lit(1), text, id).alias("k2"))
    spans = [repeated_spans(taken.filter(F.octet_length("text") >= least), unit).withColumn("shared", F.lit(unit.apart))
             for unit, least in ((BYTES, LENGTH), (PASSAGES, 2 * PASSAGES.length - 1))]
    by_text = kept(spans[0].unionByName(spans[1]).groupBy("k1", "k2").agg(
        F.collect_list(F.struct("shared", "start", "end")).alias("found")))

    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def runs_of(row: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> tuple[pa.Array, np.ndarray]:
        """Maximal runs of the spans of n rows, as lists, and the units in them."""
        place = row << 32  # orders the spans of all rows, none reaches into the next row
        order = np.argsort(place + start)
        first, last = (place + start)[order], np.maximum.accumulate((place + end)[order])
        new = np.flatnonzero(np.r_[True, first[1:] > last[:-1]][:len(first)])
        first, last = first[new], last[np.r_[new[1:] - 1, len(last) - 1][:len(new)]]
        offsets = np.searchsorted(first, np.arange(n + 1) << 32)
        inside = np.diff(np.r_[0, np.cumsum(last - first)][offsets])
        pairs = pa.StructArray.from_arrays([pa.array((x & 0xFFFFFFFF).astype(np.int32)) for x in (first, last)], ["start", "end"])
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pairs).cast(span), inside

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, spans = batch.num_rows, batch.column("found").flatten()
            row = np.repeat(np.arange(n), batch.column("found").value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            start, end = (spans.field(c).to_numpy().astype(np.int64) for c in ("start", "end"))
            shared = spans.field("shared").to_numpy(zero_copy_only=False).astype(bool)
            gone, n_gone = runs_of(row[~shared], start[~shared], end[~shared], n)
            passages, n_words = runs_of(row[shared], start[shared], end[shared], n)
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            rest = list(texts)
            for i in np.flatnonzero(n_gone).tolist():
                edges = [0, *(e for run in gone[i].as_py() for e in run.values()), len(texts[i])]
                rest[i] = b"".join(texts[i][a:b] for a, b in zip(edges[::2], edges[1::2]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(n_gone),
                 gone.value_lengths().cast(pa.int64()), gone, pa.array(rest, pa.binary()), pa.array(n_words), passages],
                ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept_bytes", "n_shared_words", "passages"])

    kind = taken.schema["id"].dataType.simpleString()
    joined = taken.join(by_text.hint("shuffle_hash"), ["k1", "k2"], "left").select("id", "text", "found")
    return by_batches(joined, work, f"id {kind}, n_bytes long, n_removed long, n_spans long, "
                      "spans array<struct<start:int,end:int>>, kept_bytes binary, n_shared_words long, "
                      "passages array<struct<start:int,end:int>>").withColumnRenamed("id", id)
