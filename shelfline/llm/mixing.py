"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources get shares of all words by weight; a target stops at a multiple of what its source holds and
the excess is shared anew (water filling). A source first gives its whole epochs, then a sample
of documents for what is left: each document draws an exponential key scaled by its quality,
documents go in ascending order of keys, and those whose running size stays within the budget are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.llm.common import n_words
from shelfline.session import kept

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
# Keys of a source are counted in so many bins; only the bin the budget ends in is sorted.
BINS = 65_536
EDGE_ROWS = 100_000  # rows of a source that are sorted in one task
ROUNDS = 16          # most rounds in which a crowded bin is cut
_UNIT = float(1 << 53)


def quality(text: str = "text") -> Column:
    """Weight of a document, 0.05 to 1: the share of letters among its characters other than blanks."""
    solid = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.greatest(F.coalesce(letters / F.nullif(solid, F.lit(0)), F.lit(0.0)), F.lit(0.05))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """Add ``target`` to one row per source with ``source`` and ``source_size``.

    With level L a source of weight w aims at min(w L, most x source_size). Sources in ascending order of
    most x source_size / w are filled up one after the other, until the level of the rest is
    below the next one's limit. Sources are numbered by code point, null last. The windows see one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    limit, w = F.col("limit"), F.col("weight")
    order = Window.orderBy(limit / w, "place")
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    listed = (sizes.withColumn("place", place).withColumn("weight", weight)
              .withColumn("limit", F.col("source_size") * F.lit(float(most)))
              .withColumn("total", F.sum("source_size").over(whole).cast("double"))
              .withColumn("rest", F.col("total") - F.coalesce(F.sum("limit").over(below), F.lit(0.0)))
              .withColumn("weights", F.sum("weight").over(
                  order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
              .withColumn("level", F.col("rest") / F.col("weights"))
              .withColumn("free", F.max(F.when(limit / w >= F.col("level"), F.col("level"))).over(whole)))
    return listed.select("source", "source_size",
                         F.least(limit, w * F.coalesce("free", F.lit(0.0))).alias("target"))


def _refined(edge: DataFrame, names: list[str]) -> list[DataFrame]:
    """The rows in whose bin a source's budget ends, in frames with ``more``: 1 for those that are taken once more.

    ``before`` is the size of all rows of the source before the bin. A crowded bin is cut into BINS parts between its least
    and greatest key; the part in which the budget ends is the next round's bin. Rows of one key are not cut.
    """
    out = []
    for _ in range(ROUNDS):
        edge = kept(edge)
        spans = kept(edge.groupBy("source").agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")))
        if spans.filter((F.col("n") > EDGE_ROWS) & (F.col("low") < F.col("high"))).isEmpty():
            break
        same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
        place = F.least(F.floor((F.col("key") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0)) * BINS),
                        F.lit(BINS - 1))
        parts = (edge.alias("e").join(spans.alias("s"), same("e", "s")).select("e.*", "low", "high")
                 .withColumn("part", F.coalesce(place, F.lit(0))).drop("low", "high"))
        sums = parts.groupBy("source", "part").agg(F.sum("size").alias("sum"), F.max("before").alias("start"),
                                                   F.max("budget").alias("goal"))
        so_far = F.col("start") + F.sum("sum").over(Window.partitionBy("source").orderBy("part")) - F.col("sum")
        ends = kept(sums.withColumn("from", so_far).filter(F.col("from") + F.col("sum") >= F.col("goal"))
                    .groupBy("source").agg(F.min(F.struct("part", "from")).alias("end")))
        joined = parts.alias("p").join(ends.alias("l"), same("p", "l"), "left").select("p.*", "end")
        here = F.col("part").eqNullSafe(F.col("end.part"))
        out.append(joined.filter(~here).withColumn("more", F.coalesce(
            F.col("part") < F.col("end.part"), F.lit(True)).cast("long")).drop("part", "end"))
        edge = joined.filter(here).withColumn("before", F.col("end.from").cast("double")).drop("part", "end")
    up_to = F.sum("size").over(Window.partitionBy("source").orderBy("key", "id", *names)
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    taken = F.col("before") + up_to - F.col("size") / 2 < F.col("budget")
    return [*out, edge.withColumn("more", taken.cast("long"))]


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = WEIGHTS, most: float = MOST_EPOCHS, seed: int = 42,
        keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: ``id``, size (words), source_size, target of its source, epochs (times it is taken)
    and taken (words), with the columns ``keep``.

    Draws are hashes of the seed, id and text, so reruns agree. A null text has no words and is
    taken like any other document at no cost; a null source is a source. Repeated rows draw alike and are
    ordered by a second hash of nothing else, so all copies of a row stand together. A source's words come within half a
    document of its target: the last document is taken if that brings the sum nearer.

    Only sizes are summed to source and bin; of the one bin per source in which the budget ends the rows are binned again
    by their own range of keys until few are left, which are sorted. So low quality, which crowds the last bin, or
    a hot source puts no more than EDGE_ROWS rows, or rows of one key, into a task.
    """
    draw = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id), F.col(text)), 11) + 1) / F.lit(_UNIT + 1)
    key = -F.log(draw) / quality(text)
    base = docs.select(
        F.col(id).alias("id"), F.col(source).alias("source"), n_words(text).alias("size"),
        key.alias("key"), *[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)])
    # 1 - exp(-key) spreads the keys over (0, 1) without changing their order.
    base = kept(base.withColumn("bin", F.least(F.floor((1 - F.exp(-F.col("key"))) * BINS), F.lit(BINS - 1))))
    bins = kept(base.groupBy("source", "bin").agg(F.sum("size").alias("size")))
    goals = kept(targets(bins.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most))
    share = F.col("target") / F.nullif(F.col("source_size"), F.lit(0))
    epochs = F.coalesce(F.floor(share + F.lit(1e-12)), F.lit(0)).cast("long")
    goals = (goals.withColumn("epochs", epochs)
             .withColumn("budget", F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0))))
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    running = F.sum("size").over(Window.partitionBy("source").orderBy("bin")) - F.col("size")
    last = (bins.withColumn("before", running).alias("b").join(goals.alias("g"), same("b", "g"))
            .filter(F.col("before") + F.col("b.size") >= F.col("budget"))
            .groupBy("g.source").agg(F.min(F.struct("bin", "before")).alias("last")))
    goals = kept(goals.alias("g").join(last.alias("l"), same("g", "l"), "left").select("g.*", "l.last"))

    names = [f"keep_{i}" for i in range(len(keep))]
    placed = (base.alias("d").join(goals.alias("g"), same("d", "g"))
              .select("d.*", "source_size", "target", "epochs", "budget", "last"))
    at, end = F.col("bin"), F.col("last.bin")
    edge = placed.filter(at == end).withColumn("before", F.col("last.before").cast("double")).drop("bin", "last")
    rest = placed.filter(~at.eqNullSafe(end)).withColumn("more", F.coalesce(at < end, F.lit(True)).cast("long"))
    rest = rest.withColumn("before", F.lit(None).cast("double")).drop("bin", "last")
    for decided in _refined(edge, names):
        rest = rest.unionByName(decided.select(rest.columns))
    times = F.col("epochs") + F.when(F.col("budget") > 0, F.col("more")).otherwise(0)
    return (rest.withColumn("epochs", times)
            .select(F.col("id").alias(id), "size", "source_size", "target", "epochs",
                    (F.col("size") * F.col("epochs")).alias("taken"),
                    *[F.col(n).alias(c) for n, c in zip(names, keep)]))
