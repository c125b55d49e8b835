"""Decontamination, periodic runs and collocations against plain versions, and on odd, repeated and empty rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfline.llm import collocations, decontamination, queries, runs

SF_DIR = "/root/testdata/sf0.001"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# Decontamination

def held(docs, items, length=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in items:
        w = word.findall(lower(text))
        for i in range(max(1, len(w) - length + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + length]), set()).add(item)
    for doc, text in docs:
        w, hit, found, spans = word.findall(lower(text)), set(), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (at := tuple(w[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[at]
                    spans.add((i, i + n))
        names = sorted(str(x) for x in found if x is not None)
        yield doc, len(w), len(hit), len(names), sha(",".join(names)), bool(hit), sorted(spans)


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans")
ITEM = "item_id long, text string, doc_id string, words string, hash long"


def items_of(spark, items):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in items], ITEM)


def contaminated(spark, docs, items, **more):
    out = rows_of(decontamination.decontaminate(docs, items_of(spark, items), **more), *COLUMNS)
    return sorted([(*r[:-1], [tuple(s) for s in r[-1] or ()]) for r in out], key=repr)


def test_windows_of_items(spark, docs, rows):
    texts = {r[0]: r[1] or "" for r in rows}
    base, passage = texts[7], texts[12]
    cut = lambda t, a, b: " ".join(t.split()[a:b])
    items = [(1, cut(base, 5, 40)), (2, cut(base, 20, 30)), (10, cut(passage, 0, 9)), (3, cut(passage, 30, 80).upper()),
             (4, "one, TWO"), (5, "ab"), (6, None), (7, " .,"), (8, "no such words here at all in any of the texts"),
             (9, cut(base, 5, 40)), (9, "ok"), (None, cut(texts[30], 100, 130)), (11, "thing the of x" * 9)]
    taken = docs.select("doc_id", "text", F.lit(3).alias("n_words"), F.lit("z").alias("k1"), F.lit(1).alias("found"))
    want = sorted(held([r[:2] for r in rows], items), key=repr)
    assert contaminated(spark, taken, items) == want
    assert sum(r[5] for r in want) > 30 and any(r[5] and not r[3] for r in want) and any(not r[5] for r in want)
    assert contaminated(spark, taken, items, window=4, shingle=2) == sorted(held([r[:2] for r in rows], items, 4), key=repr)


def test_windows_at_every_place(spark):
    rng = random.Random(6)
    words = lambda n: [rng.choice("abcd") for _ in range(n)]
    items = [(i, " ".join(words(rng.randint(1, 14)))) for i in range(30)]
    docs = [(i, " ".join(words(rng.randint(0, 60)) + items[rng.randrange(30)][1].split() + words(rng.randint(0, 3))))
            for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert contaminated(spark, df, items) == sorted(held(docs, items), key=repr)


def test_windows_with_a_full_bitmap_and_a_crowd(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BITMAP", 64)
    passage = " ".join(f"w{i}" for i in range(30))
    items = [(i, f"start{i} {passage} end{i}") for i in range(40)]
    docs = [(i, f"own{i % 50} {passage if i % 3 else 'clean'} tail") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert contaminated(spark, df, items) == sorted(held(docs, items), key=repr)


def test_windows_of_odd_and_empty(spark, odd, empty, rows):
    items = [(1, " ".join(rows[7][1].split()[5:40])), (2, "ok")]
    out = contaminated(spark, odd, items)
    assert out == sorted(held([(r["doc_id"], r["text"]) for r in odd.collect()], items), key=repr)
    assert contaminated(spark, empty, items) == []
    assert not any(r[5] for r in contaminated(spark, odd, []))


def test_windows_in_a_very_long_text(spark):
    words = [f"w{i % 9973}" for i in range(250_000)]
    docs = [(1, " ".join(words))]
    items = [(1, " ".join(words[200_000:200_020])), (2, "w1 w3 w5")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert contaminated(spark, df, items) == sorted(held(docs, items), key=repr)


# Periodic runs

def all_runs(words, least=6, times=4):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length, w = j - i + q, words[i:j + q]
            if length >= max(least, times * q) and not any(
                    all(a == b for a, b in zip(w, w[d:])) for d in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rng):
    words = [rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(0, 40))]
    for _ in range(rng.randint(0, 3)):
        unit = [rng.choice("abcd") for _ in range(rng.randint(1, 30))] * rng.choice([1, 1, 2])
        words += (unit * rng.randint(1, 9))[:rng.randint(1, 200)] + [rng.choice("ab")]
    return words


@pytest.mark.parametrize("least, times", [(6, 4), (3, 3), (12, 5)])
def test_runs_of_numbered_words(least, times):
    rng = random.Random(times)
    for _ in range(300):
        texts = [repetitive(rng) for _ in range(rng.randint(1, 4))]
        found = runs.runs_of([[w.encode() for w in t] for t in texts], least, times)
        assert found == [all_runs(t, least, times) for t in texts]


def run_rows(rows):
    for doc, text in rows:
        words = (text or "").encode().split()
        found = all_runs(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        gone = {i for a, n, q in found for i in range(a + q, a + n)}
        yield (doc, len(found), *best, 1000 * best[1] // best[2] if found else None,
               sha("".join("%d,%d,%d\n" % r for r in found)),
               sha(b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))


RUN_COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_runs_of_documents(spark, docs, odd, empty, rows):
    rng = random.Random(4)
    more = [(1000 + i, " ".join(repetitive(rng))) for i in range(60)]
    df = docs.select("doc_id", "text", F.lit(1).alias("period"), F.lit("a").alias("runs")).unionByName(
        spark.createDataFrame([(*r, 2, "b") for r in more], "doc_id long, text string, period int, runs string"))
    out = runs.periodic_runs(df)
    want = list(run_rows([r[:2] for r in rows] + more))
    assert rows_of(out, *RUN_COLUMNS) == sorted(want, key=repr) and sum(r[1] for r in want) > 60
    assert all(sha(r["collapsed"]) == r["collapsed_sha256"] and len(r["runs"]) == r["n_runs"] for r in out.collect())
    assert rows_of(runs.periodic_runs(odd), *RUN_COLUMNS) == sorted(
        run_rows([(r["doc_id"], r["text"]) for r in odd.collect()]), key=repr)
    assert runs.periodic_runs(empty).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, times=2)


def test_runs_of_a_very_long_text(spark):
    unit = [f"w{i * i % 997}" for i in range(499)] + ["end"]
    words = ["a"] * 1000 + unit * 300 + [f"x{i}" for i in range(100_000)] + ["b", "c"] * 40_000
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = runs.periodic_runs(df).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 1000, 1), (1000, 150_000, 500), (251_000, 80_000, 2)]
    assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == (1000, 150_000, 500, 300_000)


def test_runs_query(spark):
    def edited(doc, words):
        h = zlib.crc32(str(doc).encode())
        g, n = h // 10, len(words)
        if h % 10 or not n:
            return words
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows = [(r["doc_id"], " ".join(edited(r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", r["text"])))) for r in docs]
    want = sorted(run_rows(rows), key=repr)
    assert rows_of(queries.op12_runs(spark, SF_DIR), *RUN_COLUMNS) == want and sum(r[1] for r in want) > 10
    assert queries.with_period(None, [b"a"]) == [b"a"] and queries.with_period(5, []) == []


# Collocations

def phrases(rows, longest=3, least=10, covered=50, top=2000):
    counts = {}
    for text, lang in rows:
        f = counts.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            f.update(tuple(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    for lang, f in counts.items():
        total = sum(a for p, a in f.items() if len(p) == 1)
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i:i + n] for p, a in frequent.items() for n in range(2, len(p)) for i in range(len(p) - n + 1)
                if 100 * a >= covered * f[p[i:i + n]]}
        out = []
        for p, a in frequent.items():
            if p not in gone:
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                out.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(out)[:top], 1):
            yield lang, rank, p.decode(), -a, l, r, total, -score


PHRASE_COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def phrased(df, **more):
    return rows_of(collocations.collocations(df, **more), *PHRASE_COLUMNS)


def test_phrases(docs, odd, empty, rows):
    want = sorted(phrases([(r[1], r[2]) for r in rows]), key=repr)
    assert phrased(docs) == want and {r[0] for r in want} == {"en", "und"} and any(r[2].count(" ") == 2 for r in want)
    assert phrased(odd) == sorted(phrases([(r["text"], r["lang"]) for r in odd.collect()]), key=repr)
    assert phrased(empty) == []
    assert phrased(docs, longest=5, least=3, covered=80, top=40) == sorted(
        phrases([(r[1], r[2]) for r in rows], 5, 3, 80, 40), key=repr)


def test_phrases_in_dense_tiles_small_slabs_and_a_full_bitmap(docs, rows, monkeypatch):
    for name, value in (("SLAB", 500), ("WORDS", 200), ("DENSE", 2), ("TILE", 4), ("HEAD", 16), ("BITMAP", 1 << 12)):
        monkeypatch.setattr(collocations, name, value)
    want = sorted(phrases([(r[1], r[2]) for r in rows], least=4), key=repr)
    assert phrased(docs, least=4) == want


def test_phrases_of_equal_words_and_one_language(spark):
    df = spark.createDataFrame([("ha " * 50 + "; A b\tc, a B c", None)] * 12 + [("x y z", "und")] * 9 + [(None, "q")],
                               "text string, lang string")
    assert phrased(df) == sorted(phrases([tuple(r) for r in df.collect()]), key=repr)
