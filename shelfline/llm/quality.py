"""Quality rules: base rules on repetition and length, then distribution divergence.

Each document is measured in one pass: words, symbols, repeated lines and windows, a
histogram of character classes and one of its language's most common words. The references are the
same histograms summed over *all* documents of the language. A document is rejected when its Jensen-Shannon
distance from its language's reference is too large, unless it is too short to judge or
its language has too few words of its own for a reference. References are tables joined by language.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.llm.common import by_batches, widened
from shelfline.session import kept

WINDOW = 8              # words of a repeated window
MIN_WORDS = 20          # fewer fail the base rules
MAX_REPEATED = 30       # most per cent of words in repeated windows
GUARD_WORDS = 50        # documents with fewer are not compared with a reference
COMMON_WORDS = 40       # words of a language's histogram, besides "any other"
REFERENCE_WORDS = 5_000  # least words of a language to have a reference
MAX_CHARS = 0.30        # largest distance of a kept document's character classes
# A text without any common word has distance d0 from its language's reference. A kept document is nearer than NO_COMMON
# of it, and than MAX_COMMON of it with NOISE times the square that chance alone gives so many words:
# COMMON_WORDS / (8 ln 2 n). Documents in which fewer than EXPECTED common words are due can lack them by chance.
MAX_COMMON, NO_COMMON, NOISE, EXPECTED = 0.5, 0.95, 1.5, 10

# Symbols counted by the base rules.
SYMBOLS = b"#*$%&|<>"
# Character classes by byte: a-z, A-Z, 0-9, white space, sentence marks, other ASCII, beyond ASCII.
CLASSES = 7
_MARKS = b".,;:!?'\"-()"
_CLASS = bytes(
    0 if 97 <= b <= 122 else 1 if 65 <= b <= 90 else 2 if 48 <= b <= 57
    else 3 if b in b" \t\n\r\x0b\x0c" else 4 if b in _MARKS else 5 if b < 128
    else 6 if b >= 192 else 7 for b in range(256))  # 7: the rest of a character, not counted
# Letters in lower case, other ASCII as blanks: what common words are taken from.
_PLAIN = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32
               for b in range(256))
# Distinct words a task counts before it hands the counts on.
_COUNTED = 100_000


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of WINDOW words that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    windows = [line[a:b - 1] for a, b in zip([0, *ends[:n - 1]], ends[WINDOW - 1:])]
    if len(set(windows)) == n:
        return 0
    counts, total, free = Counter(windows), 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + WINDOW - max(i, free)
            free = i + WINDOW
    return total


def measures(text: str) -> tuple[int, int, int, int, int, list[int]]:
    """Words, characters in words, symbols, repeated lines, repeated words, character classes."""
    raw = text.encode()
    words = raw.split()
    seen: set[bytes] = set()
    dup_lines = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup_lines += 1
        elif line.strip():
            seen.add(line)
    classes = raw.translate(_CLASS)
    return (len(words), len(text) - len(raw) + sum(map(len, words)),
            sum(raw.count(s) for s in SYMBOLS), dup_lines, repeated_words(words),
            [classes.count(c) for c in range(CLASSES)])


def common_words(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang`` and ``listed``, its most common words over all documents in order, with blanks between.

    Languages of at least REFERENCE_WORDS words have a row.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()),
                 pa.array([k[1] for k in counts], pa.binary()),
                 pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for value, tongue in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                words = (value or "").encode().translate(_PLAIN).split()
                counts[tongue, b""] += len(words)
                for word, n in Counter(words).items():
                    counts[tongue, word] += n
                if len(counts) > _COUNTED:
                    yield rows()
        yield rows()

    taken = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang), F.lit("")).alias("lang"))
    counts = kept(by_batches(taken, count, "lang string, word binary, n long")
                  .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    totals = counts.filter(F.octet_length("word") == 0)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    # Each task cuts its counts to a language's first words before the shuffle; nothing may come between.
    top = (counts.filter(F.octet_length("word") > 0).withColumn("place", place).filter(F.col("place") <= COMMON_WORDS)
           .join(kept(totals.filter(F.col("n") >= REFERENCE_WORDS).select("lang")), "lang", "left_semi"))
    words = F.transform(F.array_sort(F.collect_list(F.struct("place", F.col("word").cast("string").alias("word")))),
                        lambda x: x["word"])
    return kept(top.groupBy("lang").agg(F.array_join(words, " ").alias("listed")))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of counts; null if one is empty."""
    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def of(n: Column, m: Column) -> Column:
        terms = F.zip_with(p, q, lambda x, y: (
            part(x / n, (x / n + y / m) / 2) + part(y / m, (x / n + y / m) / 2)) / 2)
        return F.when((n > 0) & (m > 0), F.sqrt(F.greatest(_total(terms), F.lit(0.0))))

    # The one-element transform names the totals, so that they are summed once and not for every element.
    totals = F.array(F.struct(_total(p).alias("n"), _total(q).alias("m")))
    return F.transform(totals, lambda t: of(t["n"], t["m"]))[0]


def lacking(ref: Column) -> Column:
    """Distance of a text without any common word from a reference."""
    return js_distance(F.array(*[F.lit(int(i == 0)) for i in range(COMMON_WORDS + 1)]), ref)


def max_common(common: Column, ref: Column, none: Column | None = None) -> Column:
    """Largest distance of a kept document's common words; null if too few are due to judge.

    ``none`` is what ``lacking`` gives for the reference, where it is known.
    """
    none = lacking(ref) if none is None else none

    def of(n: Column) -> Column:
        chance = F.lit(NOISE * COMMON_WORDS / (8 * math.log(2))) / n
        due = n * (1 - F.get(ref, F.lit(0)) / _total(ref))
        limit = F.least(NO_COMMON * none, F.sqrt((MAX_COMMON * none) ** 2 + chance))
        return F.when((n > 0) & (due >= EXPECTED), limit)

    return F.transform(F.array(_total(common)), of)[0]


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The document's measures and verdict, in place of its text.

    Returns ``id`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, chars_js, common_js,
    base_failed and kept. A null text has no words and fails; a null language is a language of its own;
    one with few words has no reference, so only the base rules decide. Repeated rows get a row each.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heard = batch.column("listed").dictionary_encode()
            lists = [{w: i for i, w in enumerate(words.encode().split(b" "), 1)} for words in heard.dictionary.to_pylist()]
            out: list[list] = [[] for _ in range(7)]
            for value, listed in zip(batch.column("text").to_pylist(), heard.indices.to_pylist()):
                found = measures(value or "")
                for column, x in zip(out, found):
                    column.append(x)
                if listed is None:
                    out[6].append(None)
                    continue
                places = lists[listed]
                words = (value or "").encode().translate(_PLAIN).split()
                bins = [0] * (COMMON_WORDS + 1)
                for word, n in Counter(words).items():
                    bins[places.get(word, 0)] += n
                out[6].append(bins)
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("lang"), *map(pa.array, out, kinds)],
                ["id", "lang", *names])

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", "common"]
    taken = docs.select(F.col(id).alias("id"), F.coalesce(F.col(lang), F.lit("")).alias("lang"),
                        F.col(text).alias("text")).join(common_words(docs, text, lang), "lang", "left")
    taken = taken.select("id", "lang", "text", "listed")
    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    stats = kept(by_batches(taken, work, widened(
        taken.drop("text", "listed"), *counts.split(", "), "chars array<long>", "common array<long>")))

    sums = [F.sum(F.get("chars", F.lit(i))).alias(f"c{i}") for i in range(CLASSES)]
    sums += [F.sum(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(COMMON_WORDS + 1)]
    refs = (stats.groupBy("lang").agg(*sums, F.sum("n_words").alias("size"))
            .filter(F.col("w0").isNotNull())
            .select("lang", F.array(*[f"c{i}" for i in range(CLASSES)]).alias("ref_chars"),
                    F.array(*[f"w{i}" for i in range(COMMON_WORDS + 1)]).alias("ref_common"))
            .withColumn("lacking", lacking(F.col("ref_common"))))
    n, n_repeat = F.col("n_words"), F.col("n_repeat_words")
    judged = F.col("n_words") >= GUARD_WORDS
    return (stats.join(kept(refs), "lang", "left")
            .withColumn("chars_js", F.when(judged, js_distance(F.col("chars"), F.col("ref_chars"))))
            .withColumn("common_js", F.when(judged, js_distance(F.col("common"), F.col("ref_common"))))
            .withColumn("base_failed", (n < MIN_WORDS) | (100 * n_repeat > MAX_REPEATED * n))
            .withColumn("kept", ~F.col("base_failed")
                        & (F.coalesce(F.col("chars_js"), F.lit(0.0)) <= MAX_CHARS)
                        & F.coalesce(F.col("common_js") <= max_common(
                            F.col("common"), F.col("ref_common"), F.col("lacking")), F.lit(True)))
            .select(F.col("id").alias(id), *names[:5], "chars_js", "common_js", "base_failed", "kept"))
