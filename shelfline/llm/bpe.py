"""Byte-level BPE by backtracking over longest matches.

A text is cut by the tokenizer's pattern; each piece is encoded alone. An Aho-Corasick automaton
over the vocabulary (bytes mapped one to one to Latin-1 characters) finds the longest token that starts at
each byte. Encoding walks from left to right and takes the longest token that is *compatible* with the
token before it: two tokens are compatible if the merges, run on their joined bytes, end
in exactly these two. Where no token fits, the position is closed and the walk steps back; each
position is closed at most once, so the time is linear in the piece. Compatibility is memoised, and so are whole pieces.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.common import by_batches, widened, with_column

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Entries a worker keeps of each memo before it starts afresh.
MEMO = 600_000
# Longer pieces are not memoised.
_LONG_PIECE = 64


class Encoder:
    """Encodes by ranks, in which a lower rank is merged first; ids are the ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.text = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.fits: dict[int, bool] = {}
        # Ids by piece and by word, as 32-bit numbers.
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.most = max(map(len, ranks))
        self.sizes = {rank: len(token) for rank, token in self.text.items()}
        self.automaton = ahocorasick.Automaton()
        for rank in sorted(self.text):
            token = self.text[rank]
            if self._learn(rank, token):
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.shorter = {rank: self._prefix(self.text[rank]) for rank in self.halves}

    def _learn(self, rank: int, token: bytes) -> bool:
        """Note which two tokens the merges make a token of; False if they never make it."""
        if len(token) == 1:
            self.halves[rank] = (rank, rank)
            return True
        for cut in range(len(token) - 1, 0, -1):
            left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
            if left in self.halves and right in self.halves and self._compatible(left, right):
                self.halves[rank] = (left, right)
                self.joined[left, right] = rank
                return True
        return False

    def _prefix(self, token: bytes) -> int:
        """The longest shorter token that starts a token, or -1."""
        for cut in range(len(token) - 1, 0, -1):
            if (rank := self.ranks.get(token[:cut])) in self.halves:
                return rank
        return -1

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens side by side.

        Undoes the merges from the latest back along the seam; a merge across the seam
        that would have come before those undone so far breaks the pair.
        """
        before = 1 << 62
        while True:
            if self.joined.get((left, right), before) < before:
                return False
            if left > right:
                before, inner = left, self.halves[left][1]
                if inner != left:
                    left = inner
                    continue
                before, outer = right + 1, self.halves[right][0]
                if outer == right:
                    return True
                right = outer
            else:
                before, outer = right + 1, self.halves[right][0]
                if outer != right:
                    right = outer
                    continue
                before, inner = left, self.halves[left][1]
                if inner == left:
                    return True
                left = inner

    def longest(self, text: str, at: int) -> int:
        """The longest token that starts at a place: the automaton walks its trie as far as the
        text goes along, and the last token on that path is it."""
        text = text[at:at + self.most]
        end = self.automaton.longest_prefix(text)
        while (rank := self.automaton.get(text[:end], -1)) < 0:
            end -= 1
        return rank

    def piece(self, data: bytes) -> tuple[int, ...]:
        """The ids of one piece."""
        if (whole := self.ranks.get(data)) is not None:
            return (whole,)
        if len(self.fits) >= MEMO:
            self.fits.clear()
        size, sizes, fits, shorter = len(data), self.sizes, self.fits, self.shorter
        text, longest, find = data.decode("latin-1"), [-1] * size, self.longest
        closed, out, at, last = bytearray(size + 1), [], 0, -1
        token = find(text, 0)
        while True:
            end = at + sizes[token]
            if not closed[end]:
                if last < 0:
                    fit = True
                elif (fit := fits.get(pair := last << 32 | token)) is None:
                    fit = fits[pair] = self._compatible(last, token)
                if fit:
                    out.append(token)
                    if end == size:
                        return tuple(out)
                    at, last = end, token
                    if (token := longest[at]) < 0:
                        token = longest[at] = find(text, at)
                    continue
            if (token := shorter[token]) < 0:
                closed[at] = 1
                token = out.pop()
                at, last = at - sizes[token], out[-1] if out else -1

    def parts(self, text: str) -> bytes:
        """The ids of a text cut by the pattern, each part looked up in the memo."""
        memo, out = self.pieces, []
        for part in self.pattern.findall(text):
            if (found := memo.get(part)) is None:
                found = array("i", self.piece(part.encode())).tobytes()
                if len(part) <= _LONG_PIECE:
                    memo[part] = found
            out.append(found)
        return b"".join(out)

    def packed(self, text: str) -> bytes:
        """The ids of a text as 32-bit numbers.

        The pattern never joins a space to what stands before it if no white space follows,
        so what follows such a space is encoded, and memoised, by itself.
        """
        for memo in (self.words, self.pieces):
            if len(memo) > MEMO:
                memo.clear()
        first, *words = text.split(" ")
        found = list(map(self.words.get, words))
        if None in found:
            for i, word in enumerate(words):
                if found[i] is None:
                    if not word or word[0].isspace():
                        return self.parts(text)
                    found[i] = self.parts(" " + word)
                    if len(word) <= _LONG_PIECE:
                        self.words[word] = found[i]
        return self.parts(first) + b"".join(found)

    def encode(self, text: str) -> list[int]:
        """The ids of a text."""
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.text.__getitem__, ids))


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a rank file, built once per Python worker."""
    return Encoder(_ranks(path))


@lru_cache(maxsize=2)
def token_bytes(path: str) -> pa.Array:
    """The bytes of each id of a rank file."""
    ranks = _ranks(path)
    table: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return pa.array(table, pa.binary())


def bpe_encode(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Add ``token_ids`` (array of int), the ids of each whole text.

    A null or empty text has no ids. Repeated rows stay; other columns pass through, but a column
    named ``token_ids`` is replaced.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = encoder(public_tokenizers.path(vocabulary))
        for batch in batches:
            packed = [use.packed(value or "") for value in batch.column(text).to_pylist()]
            ends = pa.array(np.cumsum([0, *(len(p) // 4 for p in packed)]), pa.int32())
            column = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(packed), np.int32)))
            yield with_column(batch, "token_ids", column)

    return by_batches(docs, work, widened(docs, "token_ids array<int>"))


def bpe_decode(tokens: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Replace ``token_ids`` by ``decoded`` (binary), the bytes they stand for; no ids give no bytes."""
    rest = tokens.drop("decoded")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(public_tokenizers.path(vocabulary))
        for batch in batches:
            ids = batch.column("token_ids")
            parts = pa.ListArray.from_arrays(ids.offsets, table.take(ids.values))
            yield with_column(batch, "decoded", pc.binary_join(parts, pa.scalar(b"", pa.binary())))

    return by_batches(rest, work, widened(rest, "decoded binary"))


def digest(tokens: DataFrame) -> DataFrame:
    """Add ``n_tokens`` and ``ids_sha256`` of the column ``token_ids``."""
    ids = F.col("token_ids")
    return tokens.withColumns({
        "n_tokens": F.size(ids).cast("long"),
        "ids_sha256": F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)})
