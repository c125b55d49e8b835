"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of WINDOW words (all its words if it has fewer), and a window is the set of its shingles,
runs of SHINGLE words. A document holds a window only if it holds each of its shingles, so of the shingles in order of rarity
the first one is a necessary prefix: windows and documents are joined on it alone. How often each shingle of the
items occurs is counted over all documents before that. A shared prefix gives a place in the document where the window would
begin: the window must fit between the document's ends there (positions and lengths), and is then compared
word by word with the item-sized window around the place.

Documents are read twice, to count and to join. Both times only shingles that pass a bitmap of the wanted hashes become
rows; the bitmap has at most BITMAP bits, and its false positives go in the joins on the hashes. Windows that several
items share are one row, and items are listed once for each distinct set of windows that a text holds, so neither a passage
in many documents nor one in many items is paired out.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.session import kept

WINDOW = 10         # words
SHINGLE = 5         # words
# Words are runs of anything but 00-2F, 3A-60 and 7B-7F, said by what they hold: a pattern that matches faster.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
BITMAP = 1 << 22    # most bits of a bitmap: 512 KB


def words(text: Column) -> Column:
    """Words of a text in lower case (A-Z only); null has none."""
    text = F.coalesce(text, F.lit(""))
    small = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    ascii_only = F.octet_length(text) == F.length(text)
    return F.regexp_extract_all(F.when(ascii_only, F.lower(text)).otherwise(small), F.lit(WORD), F.lit(0))


def _named(value: Column, use) -> Column:
    """use(value) with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def shingles(found: Column, length: int, wanted=None) -> Column:
    """Array of (hash, at) of all runs of ``length`` words, those that ``wanted`` takes."""
    def hashed(h: Column) -> Column:
        places = F.when(F.size(h) >= length, F.sequence(F.lit(0), F.size(h) - length)).otherwise(
            F.array().cast("array<int>"))
        runs = F.transform(places, lambda i: F.struct(
            F.xxhash64(F.lit(length), *[F.get(h, i + j) for j in range(length)]).alias("hash"), i.alias("at")))
        return F.filter(runs, lambda run: wanted(run["hash"])) if wanted else runs

    return _named(F.transform(found, lambda w: F.xxhash64(w)), hashed)


def _bitmap(hashes: DataFrame) -> tuple[int, Column]:
    """The bitmap of a frame's column ``hash``: its number of bits, and its longs as a subquery."""
    bits = 1 << 12
    while bits < min(BITMAP, 64 * hashes.count()):
        bits *= 2
    at = F.col("hash").bitwiseAND(F.lit(bits - 1))
    masks = (hashes.select(F.shiftright(at, 6).alias("id"), F.expr("shiftleft(1L, cast(hash & 63 AS int))").alias("mask"))
             .groupBy("id").agg(F.bit_or("mask").alias("mask")))
    listed = F.array_sort(F.collect_list(F.struct("id", F.coalesce("mask", F.lit(0)).alias("mask"))))
    whole = kept(hashes.sparkSession.range(bits // 64).join(masks, "id", "left")
                 .agg(F.transform(listed, lambda x: x["mask"]).alias("bits")))
    return bits, whole.scalar()


def _found(docs: DataFrame, hashes: DataFrame, lengths: list[int], around: int | None = None) -> DataFrame:
    """``docs`` with ``found``, of its column text: n_words and runs, the shingles that may be among the hashes.

    A run is (hash, at) or, with ``around``, also the words up to so many places around it from place ``first`` on.
    """
    size, bits = _bitmap(hashes)

    def wanted(h: Column) -> Column:
        at = h.bitwiseAND(F.lit(size - 1))
        mask = F.get(F.col("bits"), F.shiftright(at, 6).cast("int"))
        shifted = F.call_function("shiftright", mask, at.bitwiseAND(F.lit(63)).cast("int"))
        return shifted.bitwiseAND(F.lit(1)) == 1

    def described(w: Column) -> Column:
        def run(x: Column) -> Column:
            if around is None:
                return x
            first = F.greatest(x["at"] - F.lit(around), F.lit(0))
            return F.struct(x["hash"].alias("hash"), x["at"].alias("at"), first.alias("first"),
                            F.slice(w, first + 1, 2 * around + 1).alias("around"))

        runs = [F.transform(shingles(w, n, wanted), run) for n in lengths]
        return F.struct(F.size(w).cast("long").alias("n_words"), F.concat(*runs).alias("runs"))

    return docs.withColumn("bits", bits).withColumn("found", _named(words(F.col("text")), described)).drop("bits")


def windows(items: DataFrame, id: str, text: str, length: int) -> DataFrame:
    """``words`` of each distinct window, its number of words ``n`` and ``owners``, a list of the items it occurs in."""
    found = items.select(F.col(id).cast("string").alias("item"), words(F.col(text)).alias("all"))
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - length + 1)))
    cut = (found.filter(F.size("all") > 0).select("item", "all", starts.alias("start"))
           .select("item", F.expr(f"slice(all, start, {length})").alias("words")))
    return cut.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("owners")).withColumn("n", F.size("words"))


def prefixes(docs: DataFrame, cut: DataFrame, shingle: int) -> tuple[DataFrame, list[int]]:
    """Each window with the ``hash`` and ``offset`` of its rarest shingle; and all lengths of shingles there are.

    The length is part of the hash. A window that has a shingle no document holds is left out.
    """
    lengths = [r[0] for r in cut.select(F.least("n", F.lit(shingle))).distinct().collect()] or [shingle]
    every = F.lit(None)
    for n in lengths:
        every = F.when(F.least("n", F.lit(shingle)) == n, shingles(F.col("words"), n)).otherwise(every)
    parts = kept(cut.select("words", F.explode(every).alias("part")).select("words", "part.*"))
    hashes = kept(parts.select("hash").distinct())
    # Outer, as a plain explode would look for the runs twice: once to leave out texts without any.
    counts = (_found(docs, hashes, lengths).select(F.explode_outer("found.runs").alias("run")).groupBy("run.hash")
              .agg(F.count(F.lit(1)).alias("n")))
    rarity = kept(hashes.join(counts, "hash", "left").select("hash", F.coalesce("n", F.lit(0)).alias("n")))
    rarest = F.min(F.struct("n", "hash", F.col("at").alias("offset"))).alias("rarest")
    rarest = parts.join(rarity, "hash").groupBy("words").agg(rarest).filter("rarest.n > 0")
    return rarest.select("words", "rarest.hash", "rarest.offset"), lengths


def decontaminate(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per document row ``id``, n_words, n_hit, spans, n_items, items and contaminated.

    A window is ``window`` words in a row of an item, or all words of a shorter one that has any. ``spans`` are the (start,
    end) of its occurrences in the document's words, in order; n_hit counts words inside any; ``items`` are the ids, as
    strings in order, of the items with such windows, n_items their number, and items_sha256 the digest of
    them joined by commas. A document with a hit is contaminated.

    Null texts have no words. Every row gets a row, also one that repeats, and a null id stays null. Items of one id are one
    item; an item without id makes hits but is not listed. Without items, or without documents, nothing is hit. Other columns
    are not read. Equal texts are worked out once behind the join.
    """
    taken = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    cut = kept(windows(items, item_id, item_text, window).select(
        "words", "n", "owners", F.md5(F.to_json("owners")).alias("owned")))
    probes, lengths = prefixes(taken.select("text"), cut, shingle)
    probes = kept(cut.select("words", "n", "owned").join(probes, "words"))
    found = _found(taken, probes.select("hash").distinct(), lengths, window)
    texts = kept(found.select("id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), "found")
                 .select("id", "k1", "k2", "found.*"))

    places = texts.filter(F.size("runs") > 0).select("k1", "k2", F.col("n_words").alias("of"), F.explode("runs").alias("r"))
    begin = F.col("r.at") - F.col("offset")
    hits = (places.join(probes, F.col("r.hash") == F.col("hash"))
            .filter((begin >= 0) & (begin + F.col("n") <= F.col("of")))
            .filter(F.slice("r.around", begin - F.col("r.first") + 1, F.col("n")) == F.col("words"))
            .groupBy("k1", "k2").agg(
                F.sort_array(F.collect_set(F.struct(begin.alias("start"), (begin + F.col("n")).alias("end")))).alias("spans"),
                F.sort_array(F.collect_set("owned")).alias("sets"))
            .withColumn("set", F.md5(F.array_join("sets", ","))))
    hits = kept(hits)
    lists = cut.select("owned", "owners").distinct()
    owned = (hits.select("set", "sets").distinct().select("set", F.explode("sets").alias("owned")).join(lists, "owned")
             .select("set", F.explode_outer("owners").alias("item")).groupBy("set")
             .agg(F.sort_array(F.collect_set("item")).alias("items")))
    hits = kept(hits.drop("sets").join(kept(owned), "set").drop("set"))

    none = F.array().cast("array<string>")
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("hit"), F.lit(0).alias("reach")), lambda so_far, span: F.struct(
        (so_far["hit"] + F.greatest(F.lit(0), span["end"] - F.greatest(span["start"], so_far["reach"]))).alias("hit"),
        F.greatest(so_far["reach"], span["end"]).alias("reach")))
    out = texts.select("id", "n_words", "k1", "k2").join(hits, ["k1", "k2"], "left")
    return out.select(
        F.col("id").alias(id), "n_words", F.coalesce(covered["hit"], F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        F.col("spans").isNotNull().alias("contaminated"), "spans", F.coalesce("items", none).alias("items"))
