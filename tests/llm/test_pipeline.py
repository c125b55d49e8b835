"""The pipeline stage by stage against plain versions, and as a whole."""

import random
from collections import Counter

import brute
import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from shelfline.llm import mixing, quality
from shelfline.session import kept

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*pipeline.COLUMNS).collect()), key=repr)


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = kept(pipeline.quality_rules(spark, docs, SF_DIR))
    verdict = {r["doc_id"]: r["kept"] for r in quality.measured(docs).collect()}
    base = {r[0]: r[-1] for r in brute.op8_base([(r["doc_id"], r["text"]) for r in docs.collect()])}
    assert rows_of(good) == [r for r in rows_of(docs) if verdict[r[0]]]
    assert not any(base[r[0]] for r in rows_of(good)) and len(rows_of(good)) > 100

    single = kept(pipeline.near_copies(spark, good, SF_DIR))
    first = {d for d, _, c in brute.op2([(r[0], r[1]) for r in rows_of(good)]) if c == d}
    assert rows_of(single) == [r for r in rows_of(good) if r[0] in first]

    clean = kept(pipeline.without_secrets(spark, single, SF_DIR))
    assert len(rows_of(clean)) == len(rows_of(single))
    for old, new in zip(rows_of(single), rows_of(clean)):
        assert not brute.op9_spans(new[1]) and new[4] == len(new[1])
        assert brute.op9_spans(old[1]) or old[1] == new[1]

    mix = kept(pipeline.mixed(spark, clean, SF_DIR))
    times = {r["doc_id"]: r["epochs"] for r in mixing.mix(clean).collect()}
    assert Counter(rows_of(mix)) == Counter({r: times[r[0]] for r in rows_of(clean) if times[r[0]]})

    tokens, enc = pipeline.tokens(spark, mix, SF_DIR).collect(), brute.tik()
    text = {r[0]: r[1] for r in rows_of(mix)}
    assert len(tokens) == mix.count()
    assert all(r["token_ids"] == enc.encode_ordinary(text[r["doc_id"]]) for r in tokens)


def test_stages_on_odd_and_empty_rows(spark, odd, empty):
    for docs, some in ((odd, True), (empty, False)):
        for name, stage in pipeline.STAGES:
            docs = kept(stage(spark, docs, SF_DIR))
            assert name == "tokens" or set(pipeline.COLUMNS) == set(docs.columns)
        assert (docs.count() > 0) == some


def test_whole_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = kept(stage(spark, docs, SF_DIR))
    out = pipeline.run(spark, SF_DIR)
    key = lambda df: Counter(map(tuple, df.select("doc_id", "n_tokens", F.hash("token_ids")).collect()))
    assert key(out) == key(docs)


def words_of(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]


def test_one_row_of_each_component(spark):
    a, b, c, d = (" ".join(words_of(i, 60)) for i in range(4))
    texts = [(1, a), (1, a), (2, a), (1, b), (None, c), (None, c), (None, d), (5, d), (0, b)]
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in texts],
                               "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    found = Counter((r[0], r[1]) for r in rows_of(pipeline.near_copies(spark, df, SF_DIR)))
    assert found == Counter([(1, a), (0, b), (None, c), (5, d)])


def test_texts_that_share_a_passage_stay(spark):
    shared = " ".join(words_of(1, 40))
    rows = [(i, f"{shared} {' '.join(words_of(100 + i, 90))}", "en", "a", 0) for i in range(150)]
    rows += [(1000 + i, rows[i][1], "en", "a", 0) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    first = {d for d, _, c in brute.op2([(r[0], r[1]) for r in rows]) if c == d}
    assert {r[0] for r in rows_of(pipeline.near_copies(spark, df, SF_DIR))} == first and len(first) > 140
