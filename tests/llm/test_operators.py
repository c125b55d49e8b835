"""Each operator against a plain version of its contract, and on odd, repeated and empty rows."""

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import (bpe, licenses, mixing, quality, queries, secrets, sharding, simhash, suffixes, wavelet, winnow)
from shelfline.llm import components as contraction
from shelfline.llm.components import components
from shelfline.session import kept


def found(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def round_trip(docs):
    out = bpe.bpe_decode(bpe.digest(bpe.bpe_encode(docs)))
    return out.withColumn("decoded_sha256", F.sha2("decoded", 256))


def test_bpe_equals_tiktoken(docs, rows):
    assert found(round_trip(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(brute.op1(rows), key=repr)


def test_bpe_of_odd_pieces():
    use, want, rng = bpe.encoder(bpe.public_tokenizers.path(bpe.VOCABULARY)), brute.tik(), random.Random(3)
    parts = ["a", "ab", "the", " ", "  ", "\n", "é", "日本", "1", "22", "'s", "…", "\x1c", " ", "😀", "ing", "=", "ﬁ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for text in [*texts, "a" * 5000, "ab" * 3000, " " * 2000 + "x", "=" * 4000]:
        ids = use.encode(text)
        assert ids == want.encode_ordinary(text)
        assert use.decode(ids) == text.encode()


def test_bpe_memo_may_be_small(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    use = bpe.encoder.__wrapped__(bpe.public_tokenizers.path(bpe.VOCABULARY))
    for text in ["some words are here and there", "others some here words", "x y z " * 9]:
        assert use.encode(text) == brute.tik().encode_ordinary(text)


def test_bpe_odd_and_empty(odd, empty):
    assert round_trip(odd).count() == odd.count()
    assert round_trip(empty).count() == 0


@pytest.mark.parametrize("crowd", [2, simhash.CROWD])
def test_simhash_components(docs, rows, crowd):
    out = simhash.near_duplicates(docs, crowd=crowd)
    assert found(out, "doc_id", "fingerprint", "component_id") == sorted(brute.op2(rows), key=repr)


def test_simhash_links_find_all_pairs(spark):
    rng = random.Random(8)
    seeds = [rng.getrandbits(64) for _ in range(6)] + [0, 1, (1 << 64) - 1, 1 << 63]
    prints = set(seeds)
    for seed in seeds:
        for _ in range(40):
            prints.add(seed ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    parent = {p[0]: p[0] for p in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if (prints[i] ^ prints[signed.index(b)]).bit_count() <= 2:
                x, y = root(a[0]), root(b[0])
                parent[max(x, y)] = min(x, y)
    want = {x: root(x) for x in parent}
    for crowd in (2, 8, 10_000):
        links = simhash.links(spark.createDataFrame(signed, "fingerprint long"), crowd)
        got = dict.fromkeys(parent) | {r["node"]: r["root"] for r in components(links).collect()}
        assert {k: k if v is None else v for k, v in got.items()} == want


def test_simhash_variants_are_shuffled_once(spark):
    folded = kept(spark.range(5000).select(F.xxhash64("id").alias("fingerprint")))
    for limit in (-1, 1 << 40):  # whatever could be broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        out = simhash.shared_variants(folded)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("+- Exchange") + plan.count(":- Exchange") == 1 and plan.count("ReusedExchange") == 1
        assert "Broadcast" not in plan and "SortMergeJoin" not in plan
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_simhash_odd_and_empty(odd, empty):
    out = simhash.near_duplicates(odd)
    assert out.count() == odd.count()
    assert out.filter("fingerprint = '0000000000000000'").select("component_id").distinct().count() == 1
    assert simhash.near_duplicates(empty).count() == 0


def test_components_of_a_chain(spark):
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    out = components(chain.union(spark.createDataFrame([(500, 501), (501, 500), (7, 7), (None, 3)], "a long, b long")))
    roots = {r["node"]: r["root"] for r in out.collect()}
    assert all(roots[i] == 0 for i in range(1, 201)) and roots[501] == 500


def test_components_of_odd_shapes(spark):
    rng = random.Random(11)
    names = rng.sample(range(-10_000, 10_000), 900)
    chain = list(zip(names[:150], names[1:150]))
    hubs = [(min(names[200:300]), n) for n in names[200:300]] + [(n, max(names[300:400])) for n in names[300:400]]
    ring = [(names[400 + i], names[400 + (i + 1) % 80]) for i in range(80)]
    some = [(rng.choice(names[500:]), rng.choice(names[500:])) for _ in range(300)]
    pairs = (chain + hubs + ring + some) * 2
    parent = {n: n for pair in pairs for n in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    rng.shuffle(pairs)
    got = found(components(spark.createDataFrame(pairs, "a long, b long")), "node", "root")
    assert got == sorted(((n, root(n)) for n in parent if root(n) != n), key=repr)


def test_components_need_few_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(contraction, "kept", lambda df: written.append(df) or kept(df))
    stars = spark.range(300).select((F.col("id") + 5).alias("a"), (F.col("id") % 5).alias("b"))
    assert components(stars.union(stars.select("b", "a"))).count() == 300
    assert len(written) == 1  # stars need no round
    written.clear()
    ids = random.Random(4).sample(range(1000), 128)
    links = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
    assert {r["root"] for r in components(links).collect()} == {min(ids)}
    assert len(written) <= 1 + 2 * 7  # log2 of the nodes


def test_simhash_writes_links_once(spark, monkeypatch):
    written = []
    for module in (simhash, contraction):
        monkeypatch.setattr(module, "kept", lambda df: written.append(df.columns) or kept(df))
    texts = ["one two three four", "one two three four", "another text of some words", None]
    few = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["component_id"] for r in simhash.near_duplicates(few).orderBy("doc_id").collect()] == [0, 0, 2, 3]
    # Fingerprints, shared variants, links and the least ids of the components.
    assert written == [["doc_id", "fingerprint"], ["variant", "fingerprint", "n"], ["u", "v"], ["_root", "component_id"]]


def test_licenses(docs, empty, odd):
    out = {r["doc_id"]: r for r in licenses.license_scan(docs).collect()}
    assert out[26]["licenses"] == ["MIT"] and out[27]["licenses"] == ["Apache-2.0"]
    assert sum(bool(r["licenses"]) for r in out.values()) == 2
    assert licenses.license_scan(odd).count() == odd.count() and licenses.license_scan(empty).count() == 0


def test_license_sentences_run_over_lines_and_rules_want_order(spark):
    grant, include = licenses.SENTENCES["mit-grant"], licenses.SENTENCES["mit-include"]
    wrap = lambda s: "\n".join(s[i:i + 60] for i in range(0, len(s), 60)).replace("\n ", "\n")
    words = lambda s: "\n".join(" ".join(s.split()[i:i + 9]) for i in range(0, len(s.split()), 9))
    texts = [words(grant).upper() + ":\n\n" + words(include) + ".", words(include) + ". " + words(grant) + "."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: (r["sentence_ids"], r["licenses"]) for r in licenses.license_scan(df).collect()}
    assert wrap(grant) and out[0] == (["mit-grant", "mit-include"], ["MIT"])
    assert out[1] == (["mit-include", "mit-grant"], [])


def test_sentences_marked_by_two_words_run_over_lines(spark):
    texts = ["All rights\nreserved.", "This is free and unencumbered software released into the public\n  domain."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["sentence_ids"] for r in licenses.license_scan(df).collect()}
    assert out == {0: ["reserved"], 1: ["unlicense"]}


GPL = """    This program is free software{} you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation{} either version {} of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details."""
NOTICES = {
    "GPL-3.0-or-later": GPL.format(":", ",", 3), "GPL-2.0-or-later": GPL.format(";", ";", 2).replace("Foundation;", "Foundation,"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was "
               "not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in '
                  "compliance with the License.\nYou may obtain a copy of the License at",
    "BSD": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the "
           "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n"
           "   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above "
           "copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other "
           "materials provided with the distribution.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby "
           "granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}


def test_original_notices(spark):
    df = spark.createDataFrame(list(NOTICES.items()), "doc_id string, text string")
    assert {r["doc_id"]: r["licenses"] for r in licenses.license_scan(df).collect()} == {k: [k] for k in NOTICES}


def test_short_notices(spark):
    texts = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under CC BY 4.0": "CC-BY-4.0",
             "This file is distributed under CC BY-SA 4.0.": "CC-BY-SA-4.0", "Released under CC0.": "CC0-1.0",
             "This project is licensed under the MIT License": "MIT", "Distributed under the BSD 3-Clause License.": "BSD-3-Clause",
             "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.":
                 "CC-BY-NC-ND-4.0", "Licensed under the GNU Affero General Public License v3.0": "AGPL-3.0"}
    df = spark.createDataFrame(list(texts.items()), "text string, want string")
    assert all(r["licenses"] == [r["want"]] for r in licenses.license_scan(df).collect())
    assert len(licenses.SENTENCES) == len(set(licenses.SENTENCES.values()))


def test_every_known_sentence_has_a_marker():
    import re
    for words in licenses.SENTENCES.values():
        assert re.search(licenses.MARKERS, words) and words == re.sub("[^a-z0-9]+", " ", words.lower()).strip()
    assert {i for _, ids in licenses.RULES for i in ids} <= set(licenses.SENTENCES)


def test_token_files(docs, rows):
    out = wavelet.token_table(docs)
    assert found(out, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(brute.op4(rows), key=repr)
    assert all(len(r["token_ids"]) == r["n_tokens"] for r in out.collect())


def test_token_files_in_many_shards(spark, docs, rows, tmp_path):
    manifest = wavelet.write_shards(docs, str(tmp_path / "shards"), shard_ids=500)
    assert manifest.count() > 10
    out = wavelet.read_shards(manifest, str(tmp_path / "shards"), token_ids=False)
    assert found(out, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(brute.op4(rows), key=repr)


def test_token_files_odd_and_empty(odd, empty):
    out = [tuple(r) for r in wavelet.token_table(odd).orderBy("start").select("doc_id", "start", "n_tokens").collect()]
    assert len(out) == odd.count() and out[0][0] is None
    assert all(a[1] + a[2] == b[1] for a, b in zip(out, out[1:]))
    assert wavelet.token_table(empty).count() == 0


def test_wavelet_matrix():
    rng = np.random.default_rng(4)
    for ids in ([], [0], [5, 5, 5], rng.integers(0, 49408, 5000), rng.integers(0, 7, 3000), [70_000, 3, 70_000]):
        ids = np.array(ids, np.uint32)
        matrix = wavelet.unpack(wavelet.pack([1], [len(ids)], ids))[2]
        assert (matrix.ids() == ids).all()
        for at in rng.integers(0, len(ids), 60) if len(ids) else []:
            value = int(ids[at])
            before = matrix.rank(value, int(at))
            assert matrix.access(int(at)) == value and before == (ids[:at] == value).sum()
            assert matrix.select(value, before) == at
        assert matrix.rank(60_001) == 0 and matrix.select(1, 10**9) == -1


def test_words_equal_the_tokenizer():
    from tokenizers import Tokenizer
    path = wavelet.public_tokenizers.path(wavelet.VOCABULARY)
    use, plain, rng = wavelet.Words(path), Tokenizer.from_file(path), random.Random(2)
    plain.encode_special_tokens = True
    parts = ["a", "B", "Thé", " ", "  ", "\n", "\x1c", " ", "É", "日本", "ΑΣ", "'s", "…", ".", ",", "#", "%&", "<|endoftext|>",
             "́", "ﬁ", "İ", "ª", "1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for text, ids in zip(texts, use.encode(texts)):
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 2], repr(text)


def test_mixing_of_a_crowded_bin_is_cut_and_takes_the_same(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, "12 34 " * rng.randint(1, 4) + str(i % 900), "ab"[i % 3 > 0]) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    columns = ("doc_id", "size", "source_size", "target", "taken")
    want = found(mixing.mix(df), *columns)
    for edge_rows, bins in ((20, 7), (1, 65_536)):
        monkeypatch.setattr(mixing, "EDGE_ROWS", edge_rows)
        if edge_rows > 1:
            monkeypatch.setattr(mixing, "BINS", bins)
        assert found(mixing.mix(df), *columns) == want
        monkeypatch.undo()
    assert {r[4] > 0 for r in want} == {True, False}


def test_common_words_are_cut_before_the_shuffle(spark, docs):
    for limit in (-1, 1 << 30):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        plans = []
        was = quality.kept

        def spy(df):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return was(df)

        quality.kept = spy
        try:
            quality.common_words(docs, "text", "lang")
        finally:
            quality.kept = was
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        last = plans[-1]
        assert last.count("WindowGroupLimit") == 2 and last.index("Final") < last.index("Partial")
        between = last[last.index("WindowGroupLimit", last.index("Final")):last.rindex("WindowGroupLimit")]
        assert "Join" not in between


def test_mix(docs, rows):
    sizes, target = brute.op5_targets(rows)
    source = {r[0]: r[3] for r in rows}
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    taken, largest = Counter(), Counter()
    for r in out:
        s = source[r["doc_id"]]
        assert r["size"] == len(brute.WORDS.findall(rows[r["doc_id"]][1] or ""))
        assert r["source_size"] == sizes[s] and abs(r["target"] - target[s]) < 1e-6
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in target)
    assert found(mixing.mix(docs.repartition(3)), "doc_id", "taken") == found(mixing.mix(docs), "doc_id", "taken")


def test_mix_takes_whole_epochs_first(docs):
    out = mixing.mix(docs, keep=("source",)).filter("size > 0").groupBy("source", "source_size", "target").agg(
        F.min("epochs").alias("least"), F.max("epochs").alias("most")).collect()
    for r in out:
        whole = int(r["target"] / r["source_size"] + 1e-9)
        assert whole <= r["least"] <= r["most"] <= whole + 1


def test_mix_targets_fill_up(spark):
    rng = random.Random(1)
    for _ in range(5):
        rows = [(i, "w " * rng.choice([0, 1, 5, 100, 1000]), None, rng.choice("abcdefgh") if i else None) for i in range(40)]
        sizes, target = brute.op5_targets(rows)
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        assert all(abs(got[s] - target[s]) < 1e-6 for s in target)


def test_mix_prefers_quality(spark):
    rows = [(i, "good words only " * 5 if i % 2 else "12 34 $$ " * 5 + "a", None, "a" if i < 1500 else "b") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    taken = mixing.mix(df, weights=(1, 4)).filter("epochs > 0 AND doc_id < 1500")
    good = taken.filter("doc_id % 2 = 1").count()
    assert good > 2 * (taken.count() - good)


def test_mix_odd_and_empty(odd, empty, docs):
    assert mixing.mix(odd).count() == odd.count()
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(docs.filter("text IS NULL")).select("taken").first()[0] == 0


def check_shards(df, out, shards=8):
    out = out.collect()
    assert len(out) == df.count()
    slots, sums = defaultdict(list), Counter()
    for r in out:
        slots[r["shard"]].append(r["slot"])
        sums[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    if out:
        goal, largest = sum(sums.values()) / shards, max(r["size"] for r in out)
        assert all(abs(sums[i] - goal) <= largest + 0.002 * goal for i in range(shards))


def test_shards(docs, odd, empty, rows):
    import zlib
    for df in (docs, odd, empty):
        check_shards(df, sharding.shard(df))
    for r in sharding.shard(docs).collect():
        raw = (rows[r["doc_id"]][1] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))


def test_shards_of_one_id_and_of_far_ids(spark):
    for ids in ("CAST(NULL AS LONG)", "7", "id * id * id * 1000003", "-9223372036854775807 - 1 + id", "CAST(pow(2, id % 62) AS LONG)"):
        df = spark.range(4000).selectExpr(f"{ids} AS doc_id", "'abc' AS text")
        check_shards(df, sharding.shard(df))


def test_written_shards_hold_the_texts(docs, spark, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert found(back, "doc_id", "text") == found(docs, "doc_id", "text")


def test_repeats_removed(docs, rows):
    out = suffixes.remove_repeats(docs).withColumn("kept_sha256", F.sha2("kept_bytes", 256))
    assert found(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.op7(rows), key=repr)


def test_repeats_removed_with_pieces_and_edges(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_SLAB", 1 << 12)
    rng = random.Random(11)
    letters = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared, texts = letters(3000), []
    for n in range(30):  # shared strings of lengths around the limit, within other text
        length, at = rng.choice([398, 399, 400, 401, 415, 500, 900]), rng.randrange(2000)
        texts.append(letters(rng.randint(0, 700)) + shared[at:at + length] + letters(rng.randint(0, 700)))
    texts += [shared[:1500] * 9, letters(30_000), "é" * 5000, "ab" * 9000]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = suffixes.remove_repeats(df).withColumn("kept_sha256", F.sha2("kept_bytes", 256))
    assert found(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.op7(rows), key=repr)


def test_planted_passages_go_by_bytes_not_words(spark):
    """Of passages of over 50 words in several documents those of 400 bytes go; n_bytes is the input's and tells nothing."""
    rng = random.Random(23)
    words = lambda n, size: " ".join("".join(rng.choices("abcdefghijklmnop", k=size)) for _ in range(n))
    long, short = words(60, 6), words(55, 5)
    assert len(long) >= 400 > len(short) + 2
    kinds = [(long, short, None)[i % 3] for i in range(30)]
    rows = [(i, f"{words(40 + i, 6)} {p or words(60, 6)} {words(50, 6)}") for i, p in enumerate(kinds)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = {r["doc_id"]: r for r in suffixes.remove_repeats(df).collect()}
    for (i, text), passage in zip(rows, kinds):
        assert out[i]["n_bytes"] == len(text.encode())
        assert (out[i]["n_removed"] > 0) == (passage is long)
        assert (long.encode() in out[i]["kept_bytes"]) is False
        assert (bytes(out[i]["kept_bytes"]) == text.encode()) == (passage is not long)


def test_repeats_odd_and_empty(odd, empty):
    plain = [(r["doc_id"], r["text"]) for r in odd.collect()]
    out = suffixes.remove_repeats(odd).withColumn("kept_sha256", F.sha2("kept_bytes", 256))
    assert found(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(brute.op7(plain), key=repr)
    assert suffixes.remove_repeats(empty).count() == 0


def shared(df):
    return sorted(((r["doc_id"], r["n_shared_words"], [tuple(p) for p in r["passages"]])
                   for r in suffixes.remove_repeats(df).collect()), key=repr)


def test_shared_passages(docs, rows, odd):
    assert shared(docs) == sorted(brute.shared_words(rows), key=repr)
    plain = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert shared(odd) == sorted(brute.shared_words(plain), key=repr)


def test_shared_passages_with_edges_and_own_repeats(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_SLAB", 1 << 8)
    rng = random.Random(31)
    words = lambda n: [rng.choice("abcdefgh") + rng.choice("ijklm") for _ in range(n)]
    text = lambda *parts: "".join(w + rng.choice([" ", "\n", " \t"]) for p in parts for w in p)
    common, own, rows = words(400), words(130), []
    for _ in range(40):  # shared strings of lengths around the limit, between other words
        length, at = rng.choice([49, 50, 51, 52, 60, 90, 200]), rng.randrange(200)
        rows.append(text(words(rng.randint(0, 90)), common[at:at + length], words(rng.randint(0, 90))))
    # Twice in one document only; twice in one and in part in another; a period; long words without a gap; copies.
    rows += [text(own, words(9), own), text(common, words(5), common), text(common[300:360]), text(words(90) * 3),
             text(words(4) * 40), "x" * 3000, text(["y" * 700] * 60), text(["y" * 700] * 55), *["z " * 51] * 2, "z " * 50]
    twice = words(200)
    rows += [text(words(3), twice, words(60), twice, words(8)), text(words(7), twice[70:150], words(7))]
    rows = [(i, t) for i, t in enumerate(rows)] + [(900, text(own[:20]) + "é")] * 2 + [(901, t := text(words(80)))] * 2 + [(902, t)]
    rows += [(903, text(words(70)))] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert shared(df) == sorted(brute.shared_words(rows), key=repr)


def test_words_hashed_in_pieces(monkeypatch):
    data = "".join(f"{'é' * (i % 23)}w{i}{' \n\t\r\v\f'[i % 6] * (1 + i % 3)}" for i in range(500)).encode() + b"\x1c \xc2\xa0"
    whole = suffixes.word_hashes(data)
    assert len(whole) == 8 * len(brute.WORDS.findall(data.decode()))
    for slab in (1, 7, 64):
        monkeypatch.setattr(suffixes, "_SLAB", slab)
        assert suffixes.word_hashes(data) == whole
    assert suffixes.word_hashes(b"") == suffixes.word_hashes(b" \n") == b""


def test_shared_passages_of_long_texts(spark):
    at = suffixes._SLAB
    rows = [(i, " ".join(f"{i}x{j}" if not at - 40 <= j - 3 * i < at + 30 else f"s{j - 3 * i}" for j in range(at + 2000)))
            for i in range(3)]
    rows = [*rows, (9, " ".join(f"s{j}" for j in range(at - 40, at + 10)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert shared(df) == [(i, 70, [(at - 40 + 3 * i, at + 30 + 3 * i)]) for i in range(3)] + [(9, 0, [])]


def test_query_reports_planted_passages_too_short_for_removal(spark, tmp_path):
    """Of 52 to 59 words in under 400 bytes, as the benchmark items in the test tables: reported, and kept as the contract asks."""
    rng = random.Random(29)
    words = lambda n: " ".join("".join(rng.choices("abcdefghijklmnop", k=5)) for _ in range(n))
    items = [words(52 + i) for i in range(8)]
    planted = {i: items[i % 8] for i in range(0, 60, 2)}
    rows = [(i, f"{words(30 + i)} {planted.get(i, words(57))} {words(80)}") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in queries.op7_suffixes(spark, str(tmp_path)).collect()}
    for i, text in rows:
        assert out[i]["n_shared_words"] == len(planted.get(i, "").split())
        assert (out[i]["n_removed"], out[i]["kept_text"]) == (0, text)


def test_quality_base(docs, rows):
    out = quality.measured(docs)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert found(out, *columns) == sorted(brute.op8_base(rows), key=repr)
    assert out.filter("base_failed AND kept").count() == 0


def test_quality_odd_and_empty(odd, empty):
    assert quality.measured(odd).count() == odd.count()
    assert quality.measured(empty).count() == 0


def test_quality_divergence(spark):
    rng = random.Random(4)
    common = "the of and to in is it on that for".split()
    prose = lambda: " ".join(rng.choice(common) if rng.random() < 0.5 else
                             "".join(rng.choice("abcdefghilmnoprstu") for _ in range(6)) for _ in range(200))
    rows = [(i, prose(), "en") for i in range(60)]
    rows += [(100, " ".join("".join(rng.choice("0123456789#%{}[]~^@") for _ in range(6)) for _ in range(200)), "en"),
             (101, " ".join("".join(rng.choice("XQZJKW") for _ in range(6)) for _ in range(200)), "en"),
             (102, " ".join("".join(rng.choice("0123456789#") for _ in range(6)) for _ in range(30)), "en")]
    out = {r["doc_id"]: r for r in quality.measured(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [i for i, r in out.items() if not r["kept"]] == [100, 101]
    assert out[102]["chars_js"] is None


def _tongues():
    rng = random.Random(9)
    common = {"en": "the of and to in is it on that for was as with be by".split(),
              "fr": "le de la et les des un une que pour dans qui sur pas au".split()}
    letters = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 9)))
    return lambda tongue, n: " ".join(rng.choice(common[tongue]) if tongue in common and rng.random() < 0.33 else letters()
                                      for _ in range(n))


def test_quality_rejects_texts_without_their_languages_words(spark):
    text = _tongues()
    rows = [(100 * (t == "fr") + i, text(t, n), t) for t in ("en", "fr") for i, n in enumerate([60, 90, 150, 300, 600] * 12)]
    rows += [(1000 + i, text("gibberish", n), "en") for i, n in enumerate([60, 150, 600])]
    rows += [(2000 + i, text("fr", n), "en") for i, n in enumerate([60, 150, 600])]
    out = quality.measured(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert sorted(r["doc_id"] for r in out if not r["kept"]) == [1000, 1001, 1002, 2000, 2001, 2002]


def test_quality_judges_a_language_of_small_share(spark):
    text = _tongues()
    rows = [(i, text("fr", 300), "fr") for i in range(30)] + [(100 + i, text("gibberish", 300), "fr") for i in range(2)]
    other = spark.range(20).selectExpr("id + 1000 AS doc_id", "array_join(transform(sequence(1, 600000), x -> "
                                       "'word'), ' ') AS text", "'en' AS lang")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").unionByName(other)
    out = quality.measured(df).filter("doc_id < 1000").collect()
    assert sorted(r["doc_id"] for r in out if not r["kept"]) == [100, 101]


def test_js_distance(spark):
    def plain(p, q):
        p, q = np.array(p) / sum(p), np.array(q) / sum(q)
        m = (p + q) / 2
        part = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m) if a)
        return np.sqrt(max(0, (part(p) + part(q)) / 2))

    cases = [([1, 2, 3], [1, 2, 3]), ([1, 0], [0, 1]), ([5, 1, 0], [2, 2, 9])]
    df = spark.createDataFrame(cases, "p array<long>, q array<long>")
    got = [r[0] for r in df.select(quality.js_distance(F.col("p"), F.col("q"))).collect()]
    assert np.allclose(got, [plain(*c) for c in cases], atol=1e-7)


def test_secrets_base(docs, rows):
    out = secrets.find_secrets(docs)
    counts = [secrets.counted("base_spans", k).alias(k) for k in ("assign", "access", "hex")]
    assert found(out, "doc_id", *counts, F.sha2(secrets.listed("base_spans"), 256)) == sorted(brute.op9_base(rows), key=repr)


def test_secret_parts_are_linked(spark):
    key = "aB3dE5fG7hJ9kL1mN4"
    texts = [f"user: bob99 then {key} end", f"only {key} here", "user: bob99 only", f"see https://h.example/a {key}",
             "user: bob99 " + "x " * 200 + key, f"user: bob99 {key} " + "pad " * 300 + f"{key} alone",
             f"{'é😀' * 80} login=me@x {key}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in secrets.find_secrets(df).select("doc_id", secrets.listed("spans").alias("s")).collect()}
    assert got[0] == f"id:0:11,secret:17:{17 + len(key)}"
    assert got[1] == got[2] == got[4] == ""
    at = texts[3].index(key)
    assert got[3] == f"secret:{at}:{at + len(key)}"
    assert got[5] == f"id:0:11,secret:12:{12 + len(key)}"
    assert got[6].startswith("id:161:") and got[6].endswith(f":{len(texts[6])}")


def test_short_runs_are_no_secrets_and_hide_none(spark):
    texts = ["AKIAKIA" + "B" * 10, "AKIA" + "B" * 11, "AKIAB AKIA" + "C" * 12, "a" * 31 + "g" + "b" * 32,
             "secret: token: abcdefghij", "f" * 31, "AKIAAKIAAKIAAKIA"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in secrets.find_secrets(df).collect():
        assert [tuple(s) for s in row["base_spans"]] == brute.op9_spans(texts[row["doc_id"]]), row


def test_many_spans_in_one_text(spark):
    text = "ab token=12345678 " * 1500 + "f" * 40
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = secrets.find_secrets(df).select("base_spans").first()[0]
    assert [tuple(s) for s in spans] == brute.op9_spans(text)


def test_redaction_of_many_overlapping_spans(spark):
    rng = random.Random(3)
    rows = []
    for doc, n in enumerate((1, 5, 63, 64, 65, 400)):
        text = "".join(rng.choice("aé😀 日") for _ in range(3000))
        starts = sorted(rng.randrange(2900) for _ in range(n))
        rows.append((doc, text, [(a, 0, a + rng.randint(1, 60 if i % 9 else 4)) for i, a in enumerate(starts)]))
    kind = "doc_id long, text string, spans array<struct<start:int,kind:int,end:int>>"
    df = spark.createDataFrame(rows, kind)
    for r in df.select("doc_id", secrets.redacted("text", "spans").alias("t")).collect():
        _, text, spans = rows[r["doc_id"]]
        want, at = "", 0
        for i, (start, _, _) in enumerate(spans):
            ended = max((e for _, _, e in spans[:i]), default=0)
            if ended <= start:
                want, at = want + text[ended:start] + "<SECRET>", start
        assert r["t"] == want + text[max(e for _, _, e in spans):], r["doc_id"]


def test_redaction_of_a_file_full_of_keys(spark):
    text = "".join(f"k{i} token=12345678{i} ;" for i in range(45_000))
    df = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    found = df.select(secrets.redacted("text", "spans")).first()[0]
    assert len(text) > 1_000_000 and found.count("<SECRET>") == 45_000 and "12345678" not in found


def test_redaction(docs, rows, spark):
    out = secrets.find_secrets(docs).select("doc_id", secrets.redacted("text", "spans").alias("t"), "spans", "text").collect()
    for r in out:
        want, at = "", 0
        for s in r["spans"]:
            if s["start"] >= at:
                want += (r["text"] or "")[at:s["start"]] + "<SECRET>"
            at = max(at, s["end"])
        assert r["t"] == (want + r["text"][at:] if r["text"] is not None else None)
    assert any(r["spans"] for r in out)


def test_secrets_odd_and_empty(odd, empty):
    assert secrets.find_secrets(odd).count() == odd.count()
    assert secrets.find_secrets(empty).count() == 0


def plain_winnow(hashes, window=winnow.WINDOW):
    w = min(window, len(hashes))
    picked = set()
    for i in range(len(hashes) - w + 1 if hashes else 0):
        part = hashes[i:i + w]
        picked.add(i + max(j for j in range(w) if part[j] == min(part)))
    return [(hashes[i], i) for i in sorted(picked)]


def test_winnowing(docs, rows):
    out = docs.select("doc_id", winnow.grams(F.coalesce("text", F.lit(""))).alias("g"),
                      winnow.winnowed(F.coalesce("text", F.lit(""))).alias("w")).collect()
    sizes = {d: len(g) for d, _, _, g in brute.op10(rows)}
    for r in out:
        assert [tuple(x) for x in r["w"]] == plain_winnow(r["g"])
        assert len(r["g"]) == sizes[r["doc_id"]]


def test_winnowing_probes(docs, rows):
    out = winnow.probes(docs).withColumn("edited_sha256", F.sha2("edited", 256))
    assert found(out, "doc_id", "n_chars", "edited_sha256") == sorted((r[:3] for r in brute.op10(rows)), key=repr)
    for r in out.collect():
        a, b = ({h["hash"] for h in r[c]} for c in ("fingerprint", "edited_fingerprint"))
        assert r["near_edited"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert 0 <= r["near_next"] <= 1
    # Ids up to 56 are copies and near copies of their neighbours.
    long = out.filter("n_chars > 400 AND doc_id BETWEEN 58 AND 95").agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert long[0] > 0.3 > long[1]


def test_winnowing_odd_and_empty(odd, empty, docs):
    out = winnow.with_next(odd, "doc_id")
    rows = out.collect()
    assert len(rows) == odd.count()
    nexts = Counter(r["next_text"] for r in rows)
    assert nexts == Counter(r["text"] for r in rows)  # each document is the next of one
    assert winnow.probes(odd).count() == odd.count()
    assert winnow.probes(empty).count() == 0
    one = winnow.probes(docs.filter("doc_id = 7")).first()
    assert one["near_next"] == 1.0
