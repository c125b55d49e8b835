"""Periodic runs of words by seeds on diagonals.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least ``times`` q and
``least`` words long, that no neighbouring word extends. On the diagonal of lag q, where word i meets
word i + q, it is a stretch of at least overlap(q) = max(least, times * q) - q matches.

Seeds are runs of k words that occur twice in a document, an occurrence and the next one. Periods are taken in classes
from ``low`` to k + 1, where k is the least overlap of periods from ``low`` on, which all of them guarantee. The next
occurrence is enough: were the seed at i, inside a run of smallest period q <= k + 1, to occur again at i + d with d < q,
then k + d words would have both periods d and q, hence their common divisor (Fine and Wilf), and q were not the
smallest. For the same reason a lag found this way never is a multiple of the period. So a class costs one sort of
the seeds, and each class is about ``times`` - 1 times the one before.

A seed is extended along its diagonal both ways. A table of the furthest place covered per lag passes over all other
seeds of the same stretch. Seeds are named exactly, by doubling: the name of 2k words is that of the pair of names
of its halves. Places whose name is met once in the document are never named again, so a document without
repetition is done after the first class.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.common import by_batches, widened

LEAST = 6           # words of a run
TIMES = 4           # periods of a run
SLAB = 200_000      # words whose seeds are named together; a longer document makes a slab of its own
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _named(names: np.ndarray, apart: int) -> np.ndarray:
    """Names of the pairs of names ``apart`` places apart; -1 where a pair is met once or one of it has no name."""
    out = np.full(len(names), -1, np.int64)
    if len(names) <= apart:
        return out
    at = np.flatnonzero((names[:-apart] >= 0) & (names[apart:] >= 0))
    pairs = names[at] * (len(names) + 1) + names[at + apart]
    order = np.argsort(pairs, kind="stable")
    new = np.diff(pairs[order], prepend=-1) != 0
    group = np.cumsum(new) - 1
    many = np.bincount(group, minlength=1)[group] > 1
    out[at[order[many]]] = group[many]
    return out


def _reach(words: np.ndarray, at: int, lag: int, side: int) -> int:
    """Matches of words ``lag`` apart from place ``at`` on, to the right (1), or before it, to the left (-1)."""
    total, step = 0, 64
    while True:
        if side > 0:
            a = words[at + total:at + total + step]
            b = words[at + total + lag:at + total + lag + step]
            differ = np.flatnonzero(a[:len(b)] != b)
        else:
            end = at - total
            a = words[max(0, end - step):end][::-1]
            b = words[max(0, end - step) + lag:end + lag][::-1]
            differ = np.flatnonzero(a != b)
        if len(differ):
            return total + int(differ[0])
        total += len(b)
        if len(b) < step:
            return total
        step *= 2


def find_runs(words: np.ndarray, longest: int, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, in order, of numbered words.

    ``words`` may hold several documents one after another, of at most ``longest`` words, if no number is met in
    two of them: a run then never leaves its document.
    """
    def overlap(q: int) -> int:
        return max(least, times * q) - q

    found = []
    # Names stand for ``size`` words, a power of two: first for each word that is met twice.
    names, size, low = np.where(np.bincount(words, minlength=1)[words] > 1, words, -1), 1, 1
    while max(least, times * low) <= longest:
        k = min(map(overlap, range(low, max(low, least // times + 1) + 1)))
        while 2 * size <= k:
            names, size = _named(names, size), 2 * size
        seeds = names if size == k else _named(names, k - size)
        at = np.flatnonzero(seeds >= 0)
        if not (names >= 0).any():
            break
        order = at[np.argsort(seeds[at], kind="stable")]
        same = seeds[order[1:]] == seeds[order[:-1]]
        first, lag = order[:-1][same], (order[1:] - order[:-1])[same]
        fits = (lag >= low) & (lag <= k + 1)
        by_lag = np.lexsort((first[fits], lag[fits]))
        first, lag = first[fits][by_lag], lag[fits][by_lag]
        edges = np.flatnonzero(np.diff(lag, prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            places, q, i = first[a:b].tolist(), int(lag[a]), 0
            while i < len(places):
                place = places[i]
                start = place - _reach(words, place, q, -1)
                furthest = place + _reach(words, place, q, 1)
                if furthest - start >= overlap(q):
                    found.append((start, furthest - start + q, q))
                i = bisect_left(places, furthest, i + 1)
        low = k + 2
    return sorted(found, key=lambda run: (run[0], run[2]))


def _slabs(texts: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about SLAB words."""
    begin, total = 0, 0
    for i, words in enumerate(texts):
        if total and total + len(words) > SLAB:
            yield begin, i
            begin, total = i, 0
        total += len(words)
    if texts:
        yield begin, len(texts)


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    """Numbers of the words of all texts, one after another; each text has numbers of its own."""
    index: defaultdict[bytes, int] = defaultdict()
    index.default_factory = index.__len__
    number, total = [], 0
    for words in texts:
        number.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)) + total)
        total += len(index)
        index.clear()
    return np.concatenate(number) if number else np.empty(0, np.int64)


def runs_of(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """The runs of each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    starts = np.cumsum([0, *map(len, texts)])
    for start, length, period in find_runs(_numbered(texts), max(map(len, texts), default=0), least, times):
        text = int(np.searchsorted(starts, start, side="right")) - 1
        out[text].append((start - int(starts[text]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by blanks, without those that a run holds after its first period."""
    gone = bytearray(len(words))
    for start, length, period in runs:
        gone[start + period:start + length] = b"\1" * (length - period)
    return b" ".join([w for w, g in zip(words, gone) if not g])


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES,
                  edit: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per row ``id``, n_runs, runs (array of start, length, period, by start and then period), the greatest run's
    start, length, period and exponent_milli, collapsed (the words left) and two digests, runs_sha256 and collapsed_sha256.

    Words are cut at blanks. A run's exponent is length / period, in thousandths. The greatest run is the longest, of equal
    ones the first, of these the one of the smallest period; without a run its columns are null. ``edit(id, words)`` may
    change a text's words first. ``times`` is 3 or more. Each row stands for itself: rows that repeat give repeated
    rows, a null id stays null, a null or empty text has no words, other columns are left out. Rows
    are worked on where they are read; no more than one document is held beside a slab of words.
    """
    if times < 3 or least < times:
        raise ValueError("runs of at least three periods, and of at least as many words")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            texts = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
            if edit:
                texts = [edit(i, words) for i, words in zip(ids, texts)]
            for a, b in _slabs(texts):
                rows = [_described(words, runs) for words, runs in zip(texts[a:b], runs_of(texts[a:b], least, times))]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), _KINDS)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), *columns], ["id", *_NAMES])

    taken = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    added = ["n_runs long", "start long", "length long", "period long", "exponent_milli long", "runs_sha256 string",
             "collapsed_sha256 string", f"runs {RUNS}", "collapsed string"]
    return by_batches(taken, work, widened(taken.drop("text"), *added)).withColumnRenamed("id", id)


_NAMES = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed"]
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_KINDS = [*[pa.int64()] * 5, *[pa.string()] * 2, pa.list_(_RUN), pa.string()]


def _described(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """A row of ``periodic_runs``."""
    listed = "".join("%d,%d,%d\n" % run for run in runs)
    rest = collapsed(words, runs)
    best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=None)
    greatest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *greatest, sha256(listed.encode()).hexdigest(), sha256(rest).hexdigest(),
            [dict(zip(("start", "length", "period"), run)) for run in runs], rest.decode())
