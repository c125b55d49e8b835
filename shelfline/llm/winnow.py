"""Document fingerprints by winnowing.

A text is a row of tokens: words in lower case, longer ones cut every 16 characters so that a text without
blanks has tokens too. Every run of K tokens is hashed from the hashes of its tokens, and of each
window of WINDOW neighbouring runs the least hash is chosen, the rightmost if several are equal. Any run of
K + WINDOW - 1 tokens that two texts share therefore leaves a common fingerprint. Positions are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.functions.ordered import _edges, with_slice
from shelfline.session import width

K = 5
WINDOW = 4
TOKEN = r"[^\x20\x09-\x0D]{1,16}"


def _named(value: Column, use) -> Column:
    """use(value) with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def grams(text: Column, k: int = K) -> Column:
    """Hashes of all runs of k tokens; of all tokens if there are fewer; none for no tokens."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    hashes = F.transform(tokens, lambda t: F.xxhash64(t))

    def runs(h: Column) -> Column:
        whole = F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(h)))
        return F.when(F.size(h) < k, whole).otherwise(F.transform(
            F.sequence(F.lit(0), F.size(h) - k),
            lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)])))

    return _named(hashes, runs)


def winnowed(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """Array of (hash, position) chosen from the text's runs, in order of positions.

    A run is chosen if some window has it as its rightmost least: going left from it over runs not
    smaller and right over larger ones must span a window.
    """
    def chosen(g: Column) -> Column:
        n = F.size(g)

        def reach(at: Column, i: Column, side: int) -> Column:
            """Runs passed on one side before a better one comes, or the text ends."""
            stop = F.lit(window - 1)
            for d in reversed(range(1, window)):
                other = F.get(g, i + side * d)
                passed = (other > at) if side > 0 else (other >= at)
                stop = F.when(F.coalesce(passed, F.lit(False)), stop).otherwise(F.lit(d - 1))
            return stop

        picked = F.transform(g, lambda at, i: F.when(
            reach(at, i, -1) + reach(at, i, 1) + 1 >= F.least(F.lit(window), n),
            F.struct(at.alias("hash"), i.alias("position"))))
        return F.filter(picked, lambda p: p.isNotNull())

    return _named(grams(text, k), chosen)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness (0 to 1) of the hashes of two fingerprints; 1 if both are empty."""
    left, right = F.transform(a, lambda p: p["hash"]), F.transform(b, lambda p: p["hash"])
    both = F.size(F.array_intersect(left, right))
    return _named(both, lambda n: F.when(F.size(F.array_distinct(left)) + F.size(F.array_distinct(right)) == 0, F.lit(1.0))
                  .otherwise(n / (F.size(F.array_distinct(left)) + F.size(F.array_distinct(right)) - n)))


def digest(print: Column) -> Column:
    """A fingerprint as text: SHA-256 of its hashes and positions."""
    return F.sha2(F.concat_ws(",", F.transform(print, lambda p: F.concat_ws(":", p["position"], F.hex(p["hash"])))), 256)


def fingerprints(docs: DataFrame, text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """Add ``fingerprint``, the array of (hash, position) of each whole text, in place of a column of that name.

    A null or empty text has an empty one, equal texts have equal ones; rows, null ids and other columns stay as they are.
    """
    return docs.withColumn("fingerprint", winnowed(F.coalesce(F.col(text), F.lit("")), k, window))


def with_next(docs: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """Add ``next_text``, the text of the following document in descending order of ids.

    The last is followed by the first. A null id comes last, equal ids in order of a hash of their texts. The
    order is cut into slices that windows handle in parallel; the first text of each slice is handed to
    the slice before, so the only single window sees one row per slice.
    """
    base = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"),
                       F.xxhash64(text).alias("tie"))
    slim = base.select("id", "tie")
    rows = slim.count()
    n = width(docs.sparkSession)
    marks = _edges(slim, ["id", "tie"], n, rows) if rows else [[], []]
    cut = with_slice(base, ["id", "tie"], marks, descending=("id", "tie"))
    # Null ids belong after all others, in slices by their hashes.
    last = F.lit(1 << 62) - F.shiftright("tie", 56)
    cut = cut.withColumn("_slice", F.when(F.col("id").isNull(), last).otherwise(F.col("_slice")))
    order = [F.col("id").desc_nulls_last(), F.col("tie").desc()]
    heads = (cut.groupBy("_slice").agg(F.max(F.struct("id", "tie", "text"))["text"].alias("head")))
    along = Window.orderBy("_slice")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select("_slice", F.coalesce(F.lead(F.struct("head")).over(along),
                                              F.first(F.struct("head")).over(whole))["head"].alias("head"))
    here = F.lead(F.struct("text")).over(Window.partitionBy("_slice").orderBy(*order))
    return (cut.withColumn("near", here).join(after, "_slice")
            .select("id", "text", F.when(F.col("near").isNull(), F.col("head"))
                    .otherwise(F.col("near.text")).alias("next_text")))


def edited(text: Column, other: Column) -> Column:
    """The text with its last third replaced by as many characters of the start of another."""
    n = F.length(text)
    tail = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - tail), F.substring(other, F.lit(1), tail))


def probes(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next document, with their likenesses.

    Returns ``id``, n_chars, edited, fingerprint, edited_fingerprint, next_fingerprint, near_edited and
    near_next. A null text is empty; a single document is its own next one; an empty table gives no rows.
    """
    pairs = with_next(docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    out = (pairs.withColumn("edited", edited(F.col("text"), F.col("next_text")))
           .select("id", F.length("text").cast("long").alias("n_chars"), "edited",
                   winnowed(F.col("text")).alias("fingerprint"),
                   winnowed(F.col("edited")).alias("edited_fingerprint"),
                   winnowed(F.col("next_text")).alias("next_fingerprint")))
    return out.select(F.col("id").alias(id), "n_chars", "edited", "fingerprint", "edited_fingerprint",
                      "next_fingerprint",
                      likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
