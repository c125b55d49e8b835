"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments of 32. Of two fingerprints at most two bits apart, one
segment differs by at most one bit, so the two share a *variant* of that segment: its bits with one bit
blanked, plus that bit's place. Variants are an index that is joined by equality, and candidates are
verified on all 64 bits. Equal fingerprints are folded first, so copies cost nothing.

A variant that many fingerprints share is not paired out. Its members are linked through variants of
the whole fingerprint with two bits blanked instead: at most four fingerprints share such a key, and any
two within two bits do share one. Links make components by star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shelfline.llm.common import by_batches, widened
from shelfline.llm.components import components
from shelfline.session import kept, width

SHINGLE = 3     # words
SEED = 42
BITS = 2        # most differing bits of a link
# From this many fingerprints on a variant is linked through two-blank variants: about where those
# (2,016 a fingerprint) cost no more than the pairs of the 64 one-blank variants.
CROWD = 32
_SLAB = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: str) -> int:
    """SimHash of a text, unsigned: a bit is 1 if it is set in over half the shingle hashes."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(b"%b %b %b" % three, SEED) for three in zip(words, words[1:], words[2:])]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _SLAB):
        slab = np.array(hashes[i:i + _SLAB], ">u8")
        counts += np.unpackbits(slab.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``fingerprint`` (long, the 64 bits) of each document; a null text is empty."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t or "") for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found.view(np.int64))], ["id", "fingerprint"])

    taken = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    out = by_batches(taken, work, widened(taken.drop("text"), "fingerprint long"))
    return out.withColumnRenamed("id", id)


def _signed(bits: int) -> int:
    """The 64 bits as a signed long."""
    return bits - (1 << 64) if bits >> 63 else bits


def _variants() -> Column:
    """The 64 one-blank variants, a long each: the segment without one bit, and above it the bit's place."""
    halves = [F.col("fingerprint").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fingerprint", 32)]
    return F.explode(F.array(*[
        halves[i // 32].bitwiseAND(F.lit(0xFFFFFFFF ^ 1 << i % 32)).bitwiseOR(F.lit(i << 32)) for i in range(64)]))


def shared_variants(folded: DataFrame) -> DataFrame:
    """``fingerprint``, ``variant`` and ``n``, the fingerprints that share it, of variants that two or more share.

    Variants are made and shuffled once: they are counted where the shuffle has brought them together, and the
    counts meet the same rows again in place. So the plan is one at any size.
    """
    parts = width(folded.sparkSession)
    variants = folded.select("fingerprint", _variants().alias("variant")).repartition(parts, "variant")
    # That two fingerprints differ is read from them, not from the count: else their column were left out of the
    # shuffle that is counted, and it were another one.
    shared = (variants.groupBy("variant").agg(F.count(F.lit(1)).alias("n"), F.min("fingerprint").alias("least"),
                                              F.max("fingerprint").alias("most"))
              .filter("least <> most").select("variant", "n"))
    return variants.join(shared.hint("shuffle_hash"), "variant")


def links(folded: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints at most BITS bits apart; a link comes once for each key that has it.

    Every such pair is joined by a link or by a chain of links; crowded variants give stars
    instead of pairs.
    """
    members = kept(shared_variants(folded))
    near = lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= BITS
    group = F.col("group")
    later = lambda a, i: F.transform(
        F.filter(F.slice(group, i + 2, crowd), lambda b: near(a, b)),
        lambda b: F.struct(a.alias("a"), b.alias("b")))
    pairs = (members.filter(F.col("n") < crowd).groupBy("variant")
             .agg(F.collect_list("fingerprint").alias("group"))
             .select(F.explode(F.flatten(F.transform(group, later))).alias("l")).select("l.*"))

    crowded = members.filter(F.col("n") >= crowd).select("fingerprint").distinct()
    first = F.explode(F.array(*[F.lit(i) for i in range(63)]))
    second = F.explode(F.sequence(F.col("i") + 1, F.lit(63)))
    blanks = F.array(*[F.lit(_signed(1 << i)) for i in range(64)])
    blank = F.get(F.col("blanks"), F.col("i")).bitwiseOR(F.get(F.col("blanks"), F.col("j")))
    stars = (crowded.select("fingerprint", first.alias("i")).select("fingerprint", "i", second.alias("j"))
             .withColumn("blanks", blanks)
             .select("fingerprint", "i", "j", F.col("fingerprint").bitwiseAND(F.bitwise_not(blank)).alias("rest"))
             .groupBy("i", "j", "rest").agg(F.min("fingerprint").alias("a"),
                                            F.collect_set("fingerprint").alias("group"))
             .filter(F.size("group") > 1)
             .select("a", F.explode("group").alias("b")).filter("a <> b"))
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text",
                    crowd: int = CROWD) -> DataFrame:
    """``id``, ``fingerprint`` (16 hex digits) and ``component_id`` of each document.

    The component is the smallest ``id`` reachable over links, the document itself included. Texts without
    words have fingerprint zero and link like any other; repeated rows and ids stay; a null id gets a
    component too, which is null only if no other id is in it.
    """
    prints = kept(fingerprints(docs, id, text))
    found = components(links(prints.select("fingerprint").distinct(), crowd)).toDF("fingerprint", "_root")
    rooted = (prints.join(found, "fingerprint", "left")
              .withColumn("_root", F.coalesce("_root", "fingerprint")))
    # Written, so that both sides of the join on it come straight from a shuffle and Spark can split a hot root.
    firsts = kept(rooted.groupBy("_root").agg(F.min(id).alias("component_id")))
    return (rooted.join(firsts, "_root")
            .select(id, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                    "component_id"))
