"""Phrase collocations by counting in tiles.

Phrases grow by a word a round, from words to pairs to longer ones. In a round a task numbers its words and
looks at every place of its texts where the phrase without its last word and the one without its first
word are both frequent: no other place can hold a frequent phrase. Which phrases are frequent is told by a bitmap of
at most BITMAP bits; a false positive costs a row that a later filter on exact counts drops, never a result.

Frequent phrases are ranked by frequency anew each round, and so are words. The first HEAD of either have ranks that
address a table of HEAD x HEAD counts, cut into square tiles. Tiles that get many places are counted where they lie, by a
dense bincount; all other places are sorted and counted as coordinates with a number (COO). Both
are sums by task, which Spark adds up by phrase, so a frequent pair is a row a task and not a row a place.

A word is known by a hash of its language and itself, a phrase by the hashes of its words. The hash is checked against the
whole vocabulary: if two words of the corpus share one, the next salt is taken.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.llm.common import by_batches
from shelfline.session import kept, width

NO_LANG = "und"      # language of texts without one
MILLION = 1_000_000  # scores are in millionths
HEAD = 2048          # words, or phrases, that have ranks
TILE = 256           # ranks on a side of a tile
DENSE = TILE * TILE // 16   # places a slab must have in a tile that is counted densely
BITMAP = 1 << 26     # most bits of a bitmap: 8 MB
SLAB = 1 << 20       # words counted at once
WORDS = 1 << 19      # distinct words a task counts before it hands the counts on

# A-Z in lower case, tabs as blanks, marks that end a piece as line feeds.
_TABLE = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


class _Numbers:
    """Numbers of words met so far, from 1; 0 stands between pieces."""

    def __init__(self) -> None:
        counter = count(1)
        self.index: defaultdict[str, defaultdict[bytes, int]] = defaultdict(lambda: defaultdict(counter.__next__))
        self.places = array("q")

    def add(self, lang: str | None, text: str | None) -> None:
        number = self.index[NO_LANG if lang is None else lang].__getitem__
        for piece in (text or "").encode().translate(_TABLE).split(b"\n"):
            if words := piece.split():
                self.places.extend(map(number, words))
                self.places.append(0)

    def size(self) -> int:
        return sum(map(len, self.index.values())) + 1

    def listed(self) -> list[tuple[str, bytes]]:
        """Language and word of each number but 0, in order: numbers are dealt in the order words are met."""
        out: list = [None] * (self.size() - 1)
        for lang, known in self.index.items():
            for word, number in known.items():
                out[number - 1] = (lang, word)
        return out

    def taken(self) -> np.ndarray:
        """The numbers since the last time."""
        places, self.places = np.array(self.places, np.int64), array("q")
        return places


def vocabulary(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang``, ``word`` and ``a``, its number of occurrences, of all words."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, counts = _Numbers(), np.zeros(1, np.int64)

        def rows() -> pa.RecordBatch:
            known = numbers.listed()
            total = counts + np.bincount(numbers.taken(), minlength=len(known) + 1)
            words = pa.array([w for _, w in known], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in known], pa.string()), words, pa.array(total[1:])], ["lang", "word", "a"])

        for batch in batches:
            for tongue, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                numbers.add(tongue, value)
                if len(numbers.places) > SLAB:
                    counts = np.pad(counts, (0, numbers.size() - len(counts)))
                    counts += np.bincount(numbers.taken(), minlength=len(counts))
                if numbers.size() > WORDS:
                    counts = np.pad(counts, (0, numbers.size() - len(counts)))
                    yield rows()
                    numbers, counts = _Numbers(), np.zeros(1, np.int64)
        counts = np.pad(counts, (0, numbers.size() - len(counts)))
        yield rows()

    taken = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    return by_batches(taken, work, "lang string, word string, a long").groupBy("lang", "word").agg(F.sum("a").alias("a"))


def _salted(words: DataFrame) -> tuple[str, DataFrame]:
    """A salt by which no two words share a hash, and the words with their hash ``h1``."""
    for salt in map(str, range(8)):
        named = words.withColumn("h1", F.xxhash64(F.concat(F.lit(salt), "lang"), "word"))
        if named.groupBy("h1").count().filter("count > 1").isEmpty():
            return salt, named
    raise ValueError("eight hashes of 64 bits could not tell all words apart")


class _Bits:
    """The bitmap of the joint hashes of a table's phrases, and the ranks of its first HEAD ones."""

    def __init__(self, phrases: DataFrame, n: int) -> None:
        names = [f"h{i}" for i in range(1, n + 1)]
        joint = F.col("h1")
        for name in names[1:]:
            turned = F.shiftleft(joint, 17).bitwiseOR(F.shiftrightunsigned(joint, 47))
            joint = turned.bitwiseXOR(F.col(name))
        self.size = 1 << 12
        while self.size < min(BITMAP, 16 * phrases.count()):
            self.size *= 2
        at = joint.bitwiseAND(F.lit(self.size - 1))
        mask = F.expr("shiftleft(1L, cast(at & 63 AS int))")
        set_bits = (phrases.select(at.alias("at")).select(F.shiftright("at", 6).alias("at"), mask.alias("mask"))
                    .groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow())
        self.bits = np.zeros(self.size // 64, np.int64)
        self.bits[set_bits["at"].to_numpy()] = set_bits["mask"].to_numpy()
        first = phrases.orderBy(F.desc("a"), *names).limit(HEAD).select(*names).toArrow()
        self.head = [first[name].to_numpy() for name in names]
        head = self.joint(self.head)
        self.order = np.argsort(head)
        self.sorted = head[self.order]

    @staticmethod
    def joint(hashes: list[np.ndarray]) -> np.ndarray:
        """One hash of each phrase from the hashes of its words."""
        out = hashes[0].view(np.uint64)
        for h in hashes[1:]:
            out = (out << np.uint64(17) | out >> np.uint64(47)) ^ h.view(np.uint64)
        return out.view(np.int64)

    def may_hold(self, joint: np.ndarray) -> np.ndarray:
        at = joint & (self.size - 1)
        return (self.bits[at >> 6] >> (at & 63)) & 1 == 1

    def ranks(self, hashes: list[np.ndarray]) -> np.ndarray:
        """Rank of each phrase, -1 for those that are not of the head."""
        joint = self.joint(hashes)
        if not len(self.sorted):
            return np.full(len(joint), -1)
        rank = self.order[np.minimum(np.searchsorted(self.sorted, joint), len(self.sorted) - 1)]
        same = np.all([known[rank] == h for known, h in zip(self.head, hashes)], axis=0)
        return np.where(same, rank, -1)


class _Tiles:
    """Counts of phrases: the head's in dense tiles, which last as long as the task, all others as COO rows."""

    def __init__(self, levels: list[_Bits], salt: str) -> None:
        self.levels, self.salt, self.n = levels, salt, len(levels) + 1
        self.dense: dict[int, np.ndarray] = {}

    def _batch(self, hashes: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
        names = [f"h{i}" for i in range(1, self.n + 1)]
        return pa.RecordBatch.from_arrays([*map(pa.array, hashes), pa.array(counts.astype(np.int64))], [*names, "a"])

    def slab(self, numbers: _Numbers) -> pa.RecordBatch:
        """Count the phrases of the words taken; rows of those that are not in dense tiles."""
        tongue = {t: xxhash.xxh64_intdigest((self.salt + t).encode(), 42) for t in numbers.index}
        hashes = np.array([0, *(xxhash.xxh64_intdigest(w, tongue[t]) for t, w in numbers.listed())], np.uint64).view(np.int64)
        words, n = numbers.taken(), self.n
        known = self.levels[0].may_hold(hashes)
        known[0] = False
        rank_of = self.levels[0].ranks([hashes])
        valid, last = known[words], max(0, len(words) - n + 1)
        for m in range(2, n + 1):  # valid: the phrase of m words at a place may be counted
            valid = valid[:-1] & valid[1:]
            if m < n:
                at = np.flatnonzero(valid)
                joint = _Bits.joint([hashes[words[at + i]] for i in range(m)])
                valid[at] = self.levels[m - 1].may_hold(joint)
        at = np.flatnonzero(valid[:last])
        left = rank_of[words[at]] if n == 2 else self.levels[-1].ranks([hashes[words[at + i]] for i in range(n - 1)])
        right = rank_of[words[at + n - 1]]
        tile = np.where((left >= 0) & (right >= 0), left // TILE * (HEAD // TILE) + right // TILE, -1)
        rest = np.ones(len(at), bool)
        for number in np.flatnonzero(np.bincount(tile[tile >= 0], minlength=1) >= DENSE).tolist():
            here = tile == number
            rest &= ~here
            if number not in self.dense:
                self.dense[number] = np.zeros(TILE * TILE, np.int64)
            self.dense[number] += np.bincount(left[here] % TILE * TILE + right[here] % TILE, minlength=TILE * TILE)
        at = at[rest]
        names = words[at]
        for i in range(1, n):  # one number for each phrase, from those of its beginning and its next word
            coordinates = names * len(hashes) + words[at + i]
            if i < n - 1:
                names = np.unique(coordinates, return_inverse=True)[1]
        _, first, counts = np.unique(coordinates, return_index=True, return_counts=True)
        return self._batch([hashes[words[at[first] + i]] for i in range(n)], counts)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What the dense tiles hold."""
        for number, counts in self.dense.items():
            at = np.flatnonzero(counts)
            left = number // (HEAD // TILE) * TILE + at // TILE
            right = number % (HEAD // TILE) * TILE + at % TILE
            yield self._batch([*(h[left] for h in self.levels[-1].head), self.levels[0].head[0][right]], counts[at])


def counted(docs: DataFrame, text: str, lang: str, levels: list[_Bits], salt: str) -> DataFrame:
    """h1 to hn and ``a``, the occurrences of all phrases of n = len(levels) + 1 words that may be frequent."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, numbers = _Tiles(levels, salt), _Numbers()
        for batch in batches:
            for tongue, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                numbers.add(tongue, value)
                if len(numbers.places) > SLAB:
                    yield tiles.slab(numbers)
                    numbers = _Numbers()
        yield tiles.slab(numbers)
        yield from tiles.rows()

    names = [f"h{i}" for i in range(1, len(levels) + 2)]
    taken = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = by_batches(taken, work, ", ".join(f"{name} long" for name in names) + ", a long")
    return rows.groupBy(*names).agg(F.sum("a").alias("a"))


def _longer(found: DataFrame, shorter: DataFrame, n: int) -> DataFrame:
    """Phrases of n words with their words and the occurrences of what they begin and end with."""
    names = [f"h{i}" for i in range(1, n + 1)]
    head = shorter.select(*names[:-1], "lang", F.col("phrase").alias("before"), "prefixes")
    tail = shorter.select(*[F.col(a).alias(b) for a, b in zip(names, names[1:])], "last", "suffixes")
    both = found.join(head, names[:-1]).join(tail, names[1:])
    return both.select(*names, "lang", F.concat_ws(" ", "before", "last").alias("phrase"), "last", "a",
                       F.concat("prefixes", F.array("a")).alias("prefixes"),
                       F.concat("suffixes", F.array("a")).alias("suffixes"))


def _cut(n: int) -> Column:
    """The lowest-scoring cut of a phrase of n words, (score, k, l, r): of equal scores the one of the smallest k."""
    exact = lambda c: c.cast("decimal(15,0)")
    a, cuts = exact(F.col("a")), []
    for k in range(1, n):
        l, r = F.col("prefixes")[k - 1], F.col("suffixes")[n - k - 1]
        score = F.call_function("div", a * a * F.lit(MILLION).cast("decimal(7,0)"), exact(l) * exact(r))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10,
                 covered: int = 50, top: int = 2000) -> DataFrame:
    """The best phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n and score.

    Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and line ends, and those into words at blanks and tabs. ``n``
    counts a language's words, ``a`` a phrase's occurrences within pieces, those that overlap included;
    phrases met ``least`` times are candidates. A phrase cut after its first k words has l and r, the occurrences of the
    two parts, and the score floor(1,000,000 a a / (l r)), worked out in decimals (a below 10^15);
    the lowest cut counts. Candidates inside a longer one that is met ``covered`` per cent as often or more are left out.
    The first ``top`` of a language by score, occurrences and then phrase (bytes) are returned.

    Null texts are empty, a null language is NO_LANG. Every row counts, also one that repeats; other columns are not read,
    and an empty table has no phrases.
    """
    spark = docs.sparkSession
    salt, words = _salted(kept(vocabulary(docs, text, lang)))
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = kept(words.filter(F.col("a") >= least).select(
        "h1", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a",
        F.array("a").alias("prefixes"), F.array("a").alias("suffixes")))
    levels, tables = [_Bits(frequent, 1)], [frequent]
    for n in range(2, longest + 1):
        found = kept(counted(docs, text, lang, levels, salt).filter(F.col("a") >= least))
        tables.append(kept(_longer(found, tables[-1], n)))
        levels.append(_Bits(found, n))

    scored = []
    for n, table in enumerate(tables[1:], 2):
        names = [f"h{i}" for i in range(1, n + 1)]
        rows = table.withColumn("cut", _cut(n)).select(*names, "lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
        inside = [longer.select(*[F.col(f"h{i + at}").alias(f"h{i}") for i in range(1, n + 1)], "a")
                  for m, longer in enumerate(tables[n:], n + 1) for at in range(m - n + 1)]
        if inside:
            parts = inside[0]
            for more in inside[1:]:
                parts = parts.unionByName(more)
            most = parts.groupBy(*names).agg(F.max("a").alias("most"))
            rows = rows.join(most, names, "left").filter(F.expr(f"most IS NULL OR 100 * most < {covered} * a"))
        scored.append(rows.select("lang", "phrase", "a", "l", "r", "score"))
    found = scored[0]
    for more in scored[1:]:
        found = found.unionByName(more)
    # First within a share of the language's phrases, so that no task gets more than shares x top rows of a language.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    share = F.pmod(F.xxhash64("phrase"), F.lit(max(1, int(width(spark) ** 0.5))))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    found = found.withColumn("share", share).withColumn("rank", place("lang", "share")).filter(F.col("rank") <= top)
    found = found.withColumn("rank", place("lang").cast("long")).filter(F.col("rank") <= top)
    return found.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
