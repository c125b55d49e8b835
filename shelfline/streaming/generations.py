"""Tables that streams write batch by batch and that folding keeps small.

Below its path a table has

* ``batches/<stream>/<batch>``: the rows of one micro-batch. A batch that is run again replaces its own folder, and
  each stream has folders of its own, named by its id, which the checkpoint keeps: a new checkpoint
  starts its batch numbers anew and still meets no old folder.
* ``tables/<name>``: all batches folded so far, merged by key, one table a generation.
* ``manifests/<number>``: one row that says which table is current and up to which batch of each stream it holds. The
  manifest with the greatest number counts, so readers go over to a new generation in one step.

A batch counts once its folder has Spark's mark of success; a half-written one is not there yet.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfline.operators.quality import dedup
from shelfline.session import CODEC, dropped

DONE = "_SUCCESS"
_MANIFEST = "number bigint, table string, folded map<string,bigint>"


Merge = Callable[[DataFrame], DataFrame]


def listed(spark: SparkSession, pattern: str, cut: str | None = None) -> list[str]:
    """Paths that fit a pattern, on whatever file system they lie; with ``cut`` only what follows its last place."""
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    paths = sorted(str(status.getPath()) for status in found or [])
    return [p.rsplit(cut, 1)[1] for p in paths] if cut else paths


def newest(keys: Sequence[str], order: Sequence[str], by_batch: bool = False) -> Merge:
    """Of each key the latest row by ``order``; with ``by_batch`` later batches come after earlier ones whatever they hold."""
    return lambda rows: dedup(rows, keys, [*(["_batch"] if by_batch else []), *order])


def replaced(keys: Sequence[str], until: str, since: str) -> Merge:
    """Of each key the rows that no later batch with that key replaces, for rows that follow each other along time.

    A row ends at ``until``, null for the last of a key. ``since`` is the time, the same in all rows of a batch, up to which
    the batch leaves earlier rows alone: it has of each of its keys the last row and all others that end at that time
    or later; a batch without that time has all rows of its keys. So rows that end before it stay without being moved, and
    the others are compared with the last rows of later batches. Merged rows count as one batch.
    """
    def merge(rows: DataFrame) -> DataFrame:
        marks = sorted(map(tuple, rows.groupBy("_batch").agg(F.min(F.unix_micros(since))).collect()))
        if len(marks) < 2:
            return rows
        # From each batch back, the first time from which a later one replaces rows; none if one replaces all.
        top, first = marks[-1]
        stays = F.col("_batch") == top
        for batch, mark in reversed(marks[:-1]):
            if first is not None:
                stays = stays | ((F.col("_batch") == batch) & (F.unix_micros(until) < first))
                first = None if mark is None else min(first, mark)
        stays = F.coalesce(stays, F.lit(False))
        later = rows.filter(F.col(until).isNull() & (F.col("_batch") > marks[0][0])).select(*keys, "_batch", since)
        on = [F.col(f"r.{c}").eqNullSafe(F.col(f"l.{c}")) for c in keys]
        on += [F.col("l._batch") > F.col("r._batch"), F.coalesce(F.col(f"r.{until}") >= F.col(f"l.{since}"), F.lit(True))]
        left = rows.filter(~stays).alias("r").join(later.alias("l"), on, "left_anti")
        return left.unionByName(rows.filter(stays)).withColumns({
            "_batch": F.lit(top).cast("bigint"), since: F.timestamp_micros(F.lit(first).cast("bigint"))})

    merge.whole = True  # the rows of one batch are merged as they are
    return merge


def added_up(keys: Sequence[str], measures: dict[str, Callable[[str], Column]]) -> Merge:
    """Of each key one row with every measure merged by its function, a sum, minimum or maximum."""
    return lambda rows: rows.groupBy(*keys).agg(
        *[merge(name).alias(name) for name, merge in measures.items()], F.max("_batch").alias("_batch"))


class BatchTable:
    """Rows of ``schema`` that batches bring, merged by ``keys``; keys may be null.

    ``merge`` takes stacked rows with the number of their batch in ``_batch`` to fewer rows of the same columns. It
    must not matter in how many steps rows are merged.

    ``zone`` names a key column of few values, such as a month. Rows of a value that only one batch or table has are merged
    already, so they are not shuffled when a table is read or folded.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], merge: Merge,
                 zone: str | None = None):
        self.spark, self.path, self.keys, self.rows, self.zone = spark, path.rstrip("/"), list(keys), schema, zone
        self.whole = getattr(merge, "whole", False)
        self.schema = StructType([*schema.fields, StructField("_batch", LongType())])
        self.merge = lambda rows: merge(rows).select(*self.schema.names)

    def put(self, rows: DataFrame, stream: str, batch: int) -> None:
        """Store the merged rows of a batch in place of what the same batch stored before."""
        numbered = rows.select(*self.rows.names).withColumn("_batch", F.lit(batch).cast("bigint"))
        merged = numbered if self.whole else self.merge(numbered)
        merged.write.mode("overwrite").option("compression", CODEC).parquet(f"{self.path}/batches/{stream}/{batch}")

    def _listed(self, pattern: str) -> list[str]:
        """Paths below the table that fit a pattern."""
        return listed(self.spark, f"{self.path}/{pattern}")

    def _current(self) -> tuple[int, str | None, dict[str, int]]:
        """Number, table and folded batches of the current generation."""
        found = [p.rsplit("/", 1)[0] for p in self._listed(f"manifests/*/{DONE}")]
        if not found:
            return 0, None, {}
        newest = max(found, key=lambda p: int(p.rsplit("/", 1)[1]))
        row = self.spark.read.schema(_MANIFEST).json(newest).first()
        return row["number"], row["table"], row["folded"] or {}

    def batches(self, folded: dict[str, int] | None = None,
                before: tuple[str, int] | None = None) -> list[tuple[str, int]]:
        """(stream, batch) of the whole batches on disk, those after ``folded`` and before a stream's batch if given."""
        parts = [p.rsplit("/", 3)[1:3] for p in self._listed(f"batches/*/*/{DONE}")]
        found = [(s, int(b)) for s, b in parts if int(b) > (folded or {}).get(s, -1)]
        return [(s, b) for s, b in found if not before or s != before[0] or b < before[1]]

    def _read(self, table: str | None, batches: list[tuple[str, int]], among: DataFrame | None = None) -> DataFrame:
        """The merged rows of a table and batches. Each of them is merged in itself, so one alone is only read."""
        paths = [f"{self.path}/batches/{s}/{b}" for s, b in batches]
        paths += [f"{self.path}/tables/{table}"] if table else []
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        read = self.spark.read.schema(self.schema)

        def asked(rows: DataFrame) -> DataFrame:
            if among is None:
                return rows
            on = [F.col(f"t.{k}").eqNullSafe(F.col(f"k.{k}")) for k in self.keys]
            return rows.alias("t").join(among.alias("k"), on, "left_semi")

        rows = asked(read.parquet(*paths))
        if len(paths) == 1:
            return rows
        if self.zone is None:
            return self.merge(rows)
        seen = [{r[0] for r in read.parquet(path).select(self.zone).distinct().collect()} for path in paths]
        shared = [z for z, n in Counter(z for zones in seen for z in zones).items() if n > 1]
        if not shared:
            return rows
        several = F.col(self.zone).isin([z for z in shared if z is not None]) | F.col(self.zone).isNull()
        several = F.coalesce(several, F.lit(False))
        return self.merge(rows.filter(several)).unionByName(rows.filter(~several))

    def read(self, before: tuple[str, int] | None = None, among: DataFrame | None = None) -> DataFrame:
        """The merged rows; ``before`` leaves out that batch of a stream and its later ones.

        ``among`` has the keys that are asked for: a few of them are sent to where the table is read, so that
        only their rows are shuffled.
        """
        _, table, folded = self._current()
        return self._read(table, self.batches(folded, before), among).select(*self.rows.names)

    def fold(self, before: tuple[str, int] | None = None, drop: bool = True) -> int:
        """Fold all whole batches into a new generation; returns its number, or the current one if there is none.

        ``before`` leaves out that batch of a stream and its later ones: a batch that may run again must not be in the
        state it starts from. With ``drop`` the folders that the new generation replaces are removed, so a frame that was read before and runs
        after it fails and is read again; without, ``drop_folded`` removes them later.
        """
        number, table, folded = self._current()
        batches = self.batches(folded, before)
        if batches:
            name = uuid.uuid4().hex
            self._read(table, batches).write.option("compression", CODEC).parquet(f"{self.path}/tables/{name}")
            for stream, batch in batches:
                folded[stream] = max(batch, folded.get(stream, -1))
            number += 1
            (self.spark.createDataFrame([(number, name, folded)], _MANIFEST).coalesce(1)
             .write.mode("overwrite").json(f"{self.path}/manifests/{number}"))
        if drop:
            self.drop_folded()
        return number

    def drop_folded(self) -> None:
        """Remove what the current generation has replaced: folded batches, older tables and manifests."""
        number, table, folded = self._current()
        if table is None:
            return
        gone = [f"{self.path}/batches/{s}/{b}" for s, b in self.batches() if b <= folded.get(s, -1)]
        gone += [p for p in self._listed("tables/*") if p.rsplit("/", 1)[1] != table]
        gone += [p for p in self._listed("manifests/*") if int(p.rsplit("/", 1)[1]) < number]
        for path in gone:
            dropped(self.spark, path)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the streaming query of a checkpoint; it lasts as long as the checkpoint does."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
