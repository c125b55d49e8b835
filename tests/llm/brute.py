"""Plain versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from functools import cmp_to_key

import public_tokenizers
import tiktoken
import xxhash
from tokenizers import Tokenizer

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def tik() -> tiktoken.Encoding:
    import base64
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def op1(rows):
    enc = tik()
    for d, t, *_ in rows:
        ids = enc.encode_ordinary(t or "")
        yield d, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())


def fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def op2(rows):
    prints = [fingerprint(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, row in enumerate(rows):
        groups[root(i)].append(row[0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    for i, row in enumerate(rows):
        yield row[0], f"{prints[i]:016x}", least[root(i)]


def op4(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    start = 0
    for d, t, *_ in sorted(rows, key=lambda r: r[0]):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        yield d, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        start += len(ids)


def op5_targets(rows):
    sizes = Counter()
    for _, t, _, s, *_ in rows:
        sizes[s] += len(WORDS.findall(t or ""))
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            free.remove(s)
        left = sum(sizes.values()) - sum(target[s] for s in target)
    return sizes, target


def op7(rows, length=400):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    for (d, *_), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        yield d, len(t), sum(gone), runs, sha(bytes(b for b, g in zip(t, gone) if not g))


def shared_words(rows, length=51):
    """Words in strings of so many words that another document holds too; rows that agree in id and text are one."""
    words = [(r[1] or "").encode().split() for r in rows]
    holders = defaultdict(set)
    for (d, text, *_), w in zip(rows, words):
        for i in range(len(w) - length + 1):
            holders[tuple(w[i:i + length])].add((d, text))
    for (d, *_), w in zip(rows, words):
        hit = bytearray(len(w))
        for i in range(len(w) - length + 1):
            if len(holders[tuple(w[i:i + length])]) > 1:
                hit[i:i + length] = b"\1" * length
        yield d, sum(hit), [m.span() for m in re.finditer(b"\1+", bytes(hit))]


def op8_base(rows):
    for d, t, *_ in rows:
        t = t or ""
        words = WORDS.findall(t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORDS.search(line):
                dup += line in seen
                seen.add(line)
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        counts, marked = Counter(windows), set()
        for i, w in enumerate(windows):
            if counts[w] > 1:
                marked |= set(range(i, i + 8))
        n = len(words)
        yield (d, n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marked),
               n < 20 or 100 * len(marked) > 30 * n)


def op9_spans(text):
    text = text or ""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def op9_base(rows):
    for d, t, *_ in rows:
        found = op9_spans(t)
        names = ("assign", "access", "hex")
        yield (d, *[sum(s[1] == k for s in found) for k in range(3)],
               sha(",".join(f"{names[k]}:{a}:{b}" for a, k, b in found).encode()))


def op10(rows, k=5, window=4):
    def chosen(text):
        tokens = re.findall(r"[^\x20\x09-\x0D]{1,16}", text.lower())
        grams = [tuple(tokens[i:i + k]) for i in range(max(1, len(tokens) - k + 1))] if tokens else []
        return grams

    ordered = sorted(rows, key=lambda r: -r[0])
    for i, (d, t, *_) in enumerate(ordered):
        t, other = t or "", ordered[(i + 1) % len(ordered)][1] or ""
        tail = len(t) // 3
        yield d, len(t), sha((t[:len(t) - tail] + other[:tail]).encode()), chosen(t)
