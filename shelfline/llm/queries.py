"""Registered queries of the corpus operators and, where SQL can say the same, their oracle SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.llm import (bpe, collocations, decontamination, licenses, mixing, quality, runs, secrets, sharding,
                           simhash, suffixes, wavelet, winnow)
from shelfline.llm.common import documents


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE there and back."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    tokens = bpe.digest(bpe.bpe_encode(docs).select("doc_id", "token_ids"))
    return bpe.bpe_decode(tokens).select("doc_id", "n_tokens", "ids_sha256",
                                         F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components."""
    return simhash.near_duplicates(documents(spark, sf_dir))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of each document."""
    found = licenses.license_scan(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.array_join("licenses", ",").alias("licenses"))


def op4_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written and read back."""
    return wavelet.token_table(documents(spark, sf_dir), token_ids=False)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to target weights."""
    return mixing.mix(documents(spark, sf_dir)).drop("epochs")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of near-equal bytes."""
    out = sharding.shard(documents(spark, sf_dir))
    return out.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated byte strings removed; ``kept_text`` is what is left, cut characters replaced.

    ``n_shared_words`` counts the words in passages of over 50 words that other documents hold too, also where they are too short for removal.
    """
    out = suffixes.remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"),
                      F.make_valid_utf8(F.col("kept_bytes").cast("string")).alias("kept_text"), "n_shared_words")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdicts."""
    return quality.measured(documents(spark, sf_dir))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets with linked parts."""
    found = secrets.find_secrets(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    return found.select(
        "doc_id", *[secrets.counted("base_spans", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.listed("base_spans"), 256).alias("base_sha256"), secrets.listed("spans").alias("spans"))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of texts, edited texts and their likeness."""
    out = winnow.probes(documents(spark, sf_dir))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                      winnow.digest(F.col("fingerprint")).alias("fingerprint"),
                      winnow.digest(F.col("edited_fingerprint")).alias("edited_fingerprint"),
                      "near_edited", "near_next")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold windows of benchmark items."""
    docs = documents(spark, sf_dir)
    out = decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def with_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents get a period: by the checksum of the id, words from place a on repeat those of one period."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    period = words[a:a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (period * ((n - a) // len(period) + 1))[:n - a]


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words and what is left without their repetitions."""
    out = runs.periodic_runs(documents(spark, sf_dir), edit=with_period)
    return out.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language."""
    return collocations.collocations(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe, op2_simhash, op3_licenses, op4_wavelet, op5_mixing, op6_sharding,
                            op7_suffixes, op8_quality, op9_secrets, op10_winnowing, op11_decontamination,
                            op12_runs, op13_collocations)}


def _license_sql() -> str:
    """The license scan in SQL, from the same fixed values."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({text(words)}, {text(name)})" for name, words in licenses.SENTENCES.items())
    rules = ", ".join(f"({text(name)}, {text(',' + ','.join(ids) + ',')})" for name, ids in licenses.RULES)
    normal = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
    return f"""WITH known(words, name) AS (VALUES {known}), rules(license, ids) AS (VALUES {rules}),
        sentences AS (SELECT doc_id, s, i FROM (SELECT doc_id, unnest(parts) AS s, generate_subscripts(parts, 1) AS i
            FROM (SELECT doc_id, regexp_split_to_array(regexp_replace(text, '[.;:!?]+([ \\t\\r\\n]|$)',
                chr(30) || '\\1', 'g'), chr(30) || '|\\n[ \\t\\r]*\\n') AS parts FROM documents))),
        whole AS (SELECT doc_id, i, 0 AS j, name FROM sentences JOIN known ON words = {normal.format('s')}),
        lines AS (SELECT doc_id, i, unnest(string_split(s, chr(10))) AS l,
                generate_subscripts(string_split(s, chr(10)), 1) AS j
            FROM sentences WHERE (doc_id, i) NOT IN (SELECT (doc_id, i) FROM whole)),
        found AS (SELECT * FROM whole UNION ALL
            SELECT doc_id, i, j, name FROM lines JOIN known ON words = {normal.format('l')}),
        listed AS (SELECT doc_id, string_agg(name, ',' ORDER BY i, j) AS ids FROM found GROUP BY doc_id),
        held AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
            FROM listed JOIN rules ON contains(',' || listed.ids || ',', rules.ids) GROUP BY doc_id)
        SELECT doc_id, coalesce(listed.ids, '') AS sentence_ids, coalesce(licenses, '') AS licenses
        FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN held USING (doc_id)"""


# Words of each document and item, then every window of an item wherever its words stand in a document.
_DECONTAMINATION_SQL = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM (
        SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i
        FROM b WHERE len(w) > 0)),
    places AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d JOIN (SELECT DISTINCT n FROM windows) ON len(w) >= n)),
    hits AS (SELECT doc_id, item_id, i, n FROM places JOIN windows USING (n, phrase)),
    covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
        SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
    listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
        SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)"""

# Every word with the next two of its piece; phrases are counted as they stand.
_COLLOCATIONS_SQL = r"""
    WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p FROM documents),
    worded AS (SELECT lang, regexp_extract_all(unnest(p), '[^\x20\x09]+') AS w FROM pieces),
    places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
    grams AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM places),
    f1 AS (SELECT lang, x, count(*) AS a FROM grams GROUP BY ALL),
    f2 AS (SELECT lang, x, y, count(*) AS a FROM grams WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
    f3 AS (SELECT lang, x, y, z, count(*) AS a FROM grams WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
    cuts AS (SELECT lang, x || ' ' || y AS phrase, f2.a, 1 AS k, p.a AS l, q.a AS r
            FROM f2 JOIN f1 p USING (lang, x) JOIN f1 q ON q.lang = f2.lang AND q.x = f2.y
            WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.a >= 50 * f2.a AND (
                (f3.x = f2.x AND f3.y = f2.y) OR (f3.y = f2.x AND f3.z = f2.y)))
        UNION ALL SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.a, 1, p.a, q.a
            FROM f3 JOIN f1 p USING (lang, x) JOIN f2 q ON q.lang = f3.lang AND q.x = f3.y AND q.y = f3.z
        UNION ALL SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.a, 2, p.a, q.a
            FROM f3 JOIN f2 p USING (lang, x, y) JOIN f1 q ON q.lang = f3.lang AND q.x = f3.z),
    scored AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
    SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
    FROM ranked JOIN (SELECT lang, sum(a) AS n FROM f1 GROUP BY lang) USING (lang) WHERE rank <= 2000"""

ORACLES: dict[str, str] = {"op3_licenses": _license_sql(), "op11_decontamination": _DECONTAMINATION_SQL,
                           "op13_collocations": _COLLOCATIONS_SQL}
