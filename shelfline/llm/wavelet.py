"""Token files as wavelet matrices, one compressed file per shard.

A shard holds the ids of a run of documents in ascending order of their ids. Its file has one bit-plane per
bit of an id, from the highest down. Each plane lists that bit of all ids in the order left by the
planes before it, where ids with a 0 come first. With counts of ones per block of 512 bits, a rank
on a plane is one lookup and one population count, so the file answers, without unpacking the ids:
the id at a position (``access``), how often an id occurs before a position (``rank``) and
where its k-th occurrence is (``select``). Bit-planes, block counts and document table are compressed by zstd.
"""

from __future__ import annotations

import gc
import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer, pre_tokenizers

from shelfline.llm.common import by_batches
from shelfline.session import kept, scratch, width

VOCABULARY = "word_bpe_49k.json"
END = 2
# A file is closed after the document that brings it to this many ids.
SHARD_IDS = 1 << 20
_BLOCK = 512
_MAGIC = b"WVM1"
_MEMO = 800_000
# Marks that a word may end in; the tokenizer always cuts them from the letters before.
_MARKS = ".,;:!?#$%&*"


class WaveletMatrix:
    """Access, rank and select on a sequence of ids kept as bit-planes."""

    def __init__(self, size: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.size, self.planes, self.zeros, self.ranks = size, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        planes, zeros, ranks = [], [], []
        bits = max(1, int(ids.max(initial=0)).bit_length())
        ids = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        spare = np.empty_like(ids)
        for level in reversed(range(bits)):
            ones = (ids & ids.dtype.type(1 << level)).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            packed = np.pad(packed, (0, -len(packed) % (_BLOCK // 8) + _BLOCK // 8))
            counts = np.bitwise_count(packed.view(np.uint64)).reshape(-1, _BLOCK // 64).sum(axis=1, dtype=np.uint32)
            planes.append(packed)
            ranks.append(np.concatenate([[0], np.cumsum(counts[:-1])]).astype(np.uint32))
            zeros.append(len(ids) - int(np.count_nonzero(ones)))
            np.compress(~ones, ids, out=spare[:zeros[-1]])
            np.compress(ones, ids, out=spare[zeros[-1]:])
            ids, spare = spare, ids
        return cls(len(ids), planes, zeros, ranks)

    def _ones(self, level: int, at: int) -> int:
        """Ones of a plane before a place."""
        block = at // _BLOCK
        first = block * (_BLOCK // 8)
        whole = self.planes[level][first:at // 8]
        count = int(self.ranks[level][block]) + int(np.bitwise_count(whole).sum())
        if at % 8:
            count += (int(self.planes[level][at // 8]) & ((1 << at % 8) - 1)).bit_count()
        return count

    def access(self, at: int) -> int:
        """The id at a position."""
        value = 0
        for level in range(len(self.planes)):
            bit = self.planes[level][at // 8] >> (at % 8) & 1
            ones = self._ones(level, at)
            at = self.zeros[level] + ones if bit else at - ones
            value = value << 1 | int(bit)
        return value

    def _range(self, id: int, end: int) -> tuple[int, int]:
        """Where the id's occurrences before ``end`` stand below the last plane."""
        start = 0
        if id >> len(self.planes):
            return 0, 0
        for level in range(len(self.planes)):
            a, b = self._ones(level, start), self._ones(level, end)
            if id >> (len(self.planes) - 1 - level) & 1:
                start, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, end = start - a, end - b
        return start, end

    def rank(self, id: int, end: int | None = None) -> int:
        """How often an id occurs before a position."""
        start, end = self._range(id, self.size if end is None else end)
        return end - start

    def select(self, id: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of an id; -1 if there are fewer."""
        start, end = self._range(id, self.size)
        if not 0 <= k < end - start:
            return -1
        at = start + k
        for level in reversed(range(len(self.planes))):
            if id >> (len(self.planes) - 1 - level) & 1:
                wanted, of_ones = at - self.zeros[level], True
            else:
                wanted, of_ones = at, False
            low, high = 0, self.size
            while low < high:  # the last place with at most ``wanted`` such bits before it
                middle = (low + high + 1) // 2
                ones = self._ones(level, middle)
                if (ones if of_ones else middle - ones) <= wanted:
                    low = middle
                else:
                    high = middle - 1
            at = low
        return at

    def ids(self) -> np.ndarray:
        """The whole sequence, by undoing the split of each plane from the lowest up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        values = np.zeros(self.size, kind)
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            ones = np.unpackbits(plane, count=self.size, bitorder="little").view(bool)
            before = np.empty(self.size, kind)
            before[~ones] = values[:zeros]
            before[ones] = values[zeros:] | kind(1 << level)
            values = before
        return values


def pack(doc_ids: list, counts: list[int], ids: np.ndarray) -> bytes:
    """A shard file: magic, header length, JSON header, then zstd frames."""
    matrix, squeeze = WaveletMatrix.build(ids), zstandard.ZstdCompressor(level=1).compress
    frames = [squeeze(json.dumps([doc_ids, counts]).encode())]
    for plane, ranks in zip(matrix.planes, matrix.ranks):
        frames += [squeeze(plane.tobytes()), squeeze(ranks.tobytes())]
    head = json.dumps({"size": matrix.size, "zeros": matrix.zeros, "frames": [len(f) for f in frames]}).encode()
    return b"".join([_MAGIC, struct.pack("<I", len(head)), head, *frames])


def unpack(data: bytes) -> tuple[list, list[int], WaveletMatrix]:
    """Document ids, their numbers of tokens and the matrix of a shard file."""
    if data[:4] != _MAGIC:
        raise ValueError("not a shard file")
    at = 8 + struct.unpack("<I", data[4:8])[0]
    head, parts = json.loads(data[8:at]), []
    for length in head["frames"]:
        parts.append(zstandard.ZstdDecompressor().decompress(data[at:at + length]))
        at += length
    doc_ids, counts = json.loads(parts[0])
    planes = [np.frombuffer(p, np.uint8) for p in parts[1::2]]
    ranks = [np.frombuffer(p, np.uint32) for p in parts[2::2]]
    return doc_ids, counts, WaveletMatrix(head["size"], planes, head["zeros"], ranks)


class Words:
    """The tokenizer, with the ids of words memoised: it never joins across these blanks."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        # The same without what changes nothing in runs of small letters: normalising and cutting by the pattern.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.end = np.array([END], self.kind).tobytes()
        self.memo: dict[str, bytes] = {}
        # Nothing here makes cycles, but the many short lists would start the collector all the time.
        gc.set_threshold(200_000)

    def _each(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each word, encoded by itself."""
        for found in self.tokenizer.encode_batch_fast(words, add_special_tokens=False):
            yield np.array(found.ids, self.kind).tobytes()

    def _runs(self, words: list[str]) -> Iterator[bytes]:
        """The ids of runs of letters, encoded as one text and cut after tokens that end a run."""
        ids = np.array(self.letters.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, self.kind)
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words):
            yield from self._each(words)
            return
        data, size = ids.tobytes(), self.kind.itemsize
        ends = (cuts * size).tolist()
        for a, b in zip([0, *ends], ends):
            yield data[a:b]

    def _learn(self, unknown: set[str]) -> None:
        """Put words into the memo: letters of Latin scripts in lower case with the marks after
        them are put together from the two, the others encoded as they are."""
        memo, whole, stems, split = self.memo, set(), set(), []
        for word in unknown:
            stem = word.rstrip(_MARKS).lower()
            if stem.isalpha() and (stem.isascii() or max(stem) < "\u0250"):
                if stem not in memo:
                    stems.add(stem)
                if stem != word:
                    split.append((word, stem, tail := word[len(stem):]))
                    if tail not in memo:
                        whole.add(tail)
            else:
                whole.add(word)
        if stems:
            stems = list(stems)
            memo.update(zip(stems, self._runs(stems)))
        whole = list(whole)
        memo.update(zip(whole, self._each(whole)))
        memo.update([(word, memo[stem] + memo[tail]) for word, stem, tail in split])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, END appended."""
        if len(self.memo) > _MEMO:
            self.memo = {}
        memo, unknown, found = self.memo, set(), []
        for text in texts:
            words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            ids = list(map(memo.get, words))
            if None in ids:
                places = [i for i, known in enumerate(ids) if known is None]
                new = [words[i] for i in places]
                unknown.update(new)
                found.append((ids, places, new))
            else:
                found.append((b"".join(ids), None, None))
        self._learn(unknown)
        for data, places, new in found:
            if places is not None:
                for i, word in zip(places, new):
                    data[i] = memo[word]
                data = b"".join(data)
            yield np.frombuffer(data + self.end, self.kind)


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


def _store(path: str):
    """File system and path of a folder that all executors share."""
    system, inner = pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:")
                                                   else f"file://{path}")
    return system, inner


def write_shards(docs: DataFrame, folder: str, id: str = "doc_id", text: str = "text",
                 vocabulary: str = VOCABULARY, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode whole texts, append END to each and write them to shard files in ``folder``.

    Documents stand in ascending order of ``id`` (nulls first; equal ids in order of a hash of their
    texts); a null or empty text has only END. Returns the manifest: file, part, place, docs, ids. Texts are exchanged
    once, by ranges of (id, hash). A file gets its final name by one move, so a
    repeated task leaves the same files.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, task = words(public_tokenizers.path(vocabulary)), TaskContext.get()
        system, root = _store(folder)
        system.create_dir(root, recursive=True)
        doc_ids, parts, held, place = [], [], 0, 0

        def close() -> pa.RecordBatch:
            name = f"{root}/part-{task.partitionId():06d}-{place:06d}.wvm"
            draft = f"{name}.{task.taskAttemptId()}"
            with system.open_output_stream(draft) as out:
                out.write(pack(doc_ids, list(map(len, parts)), np.concatenate(parts)))
            system.move(draft, name)
            row = [name, task.partitionId(), place, len(parts), held]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], ["file", "part", "place", "docs", "ids"])

        for batch in batches:
            keys, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            for key, ids in zip(keys, use.encode([t or "" for t in texts])):
                doc_ids.append(key)
                parts.append(ids)
                held += len(ids)
                if held >= shard_ids:
                    yield close()
                    doc_ids, parts, held, place = [], [], 0, place + 1
        if parts:
            yield close()

    taken = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    order = [F.col("id"), F.xxhash64("text")]
    ordered = taken.repartitionByRange(width(docs.sparkSession), *order).sortWithinPartitions(*order)
    return kept(by_batches(ordered, write, "file string, part long, place long, docs long, ids long"))


def read_shards(manifest: DataFrame, folder: str, token_ids: bool = True) -> DataFrame:
    """Documents of the shard files: doc_id, start (ids of all documents before), n_tokens, ids_crc32
    (of the ids as little-endian 32-bit numbers) and, if wanted, token_ids.

    Ids per part are summed in one window over as many rows as there are parts, files within a
    part in windows of their own. Files are read in parallel, each unpacked by itself.
    """
    before = (Window.unboundedPreceding, -1)
    parts = (manifest.groupBy("part").agg(F.sum("ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*before)),
                                        F.lit(0)).alias("part_start")))
    earlier = F.sum("ids").over(Window.partitionBy("part").orderBy("place").rowsBetween(*before))
    files = (manifest.join(parts, "part")
             .select("file", (F.col("part_start") + F.coalesce(earlier, F.lit(0))).alias("start"))
             .repartition(width(manifest.sparkSession)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _store(folder)
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with system.open_input_stream(file) as stream:
                    doc_ids, counts, matrix = unpack(stream.read())
                ends, ids = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), matrix.ids().astype("<u4")
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])]
                columns = {"doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(start + ends[:-1]),
                           "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())}
                if token_ids:
                    columns["token_ids"] = pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return by_batches(files, read, schema + ", token_ids array<int>" * token_ids)


def token_table(docs: DataFrame, id: str = "doc_id", text: str = "text", token_ids: bool = True) -> DataFrame:
    """Write the shard files of ``docs`` to a new shared folder and read them back."""
    folder = scratch(docs.sparkSession)
    return read_shards(write_shards(docs, folder, id, text), folder, token_ids)
