"""Malformed messages and file rows go aside instead of turning into rows of nulls."""

import pytest
from pyspark.sql import functions as F

from shelfline.schemas import PRICE_EVENT
from shelfline.session import scratch
from shelfline.sources import tables, topics
from shelfline.streaming import changes


def test_malformed_messages_are_no_events(spark):
    good = '{"event_id": 1, "product_id": 2, "retailer_id": 3, "new_price": 4.5}'
    raw = spark.createDataFrame([(good,), ("{broken",), ('{"event_id": "x"}',), (None,)], "value string")
    events, malformed = topics.parse_messages(raw.select(F.col("value").cast("binary")), "price-changes")
    assert {f.name for f in PRICE_EVENT} <= set(events.columns)
    assert [(r["event_id"], r["new_price"], r["topic"]) for r in events.collect()] == [(1, 4.5, "price-changes")]
    assert sorted(r["value"] for r in malformed.collect()) == ['{"event_id": "x"}', "{broken"]


@pytest.mark.parametrize("fmt,lines,bad", [
    ("json", ['{"n": 1, "c": "a"}', '{"n": ', '{"n": "x", "c": "b"}'], ['{"n": ', '{"n": "x", "c": "b"}']),
    ("csv", ["n,c", "1,a", "x,b", "2,c,d"], ["2,c,d", "x,b"])])
def test_malformed_rows_of_files(spark, fmt, lines, bad):
    path = scratch(spark)
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    kind = spark.createDataFrame([], "n long, c string").schema
    rows, malformed = tables.read_checked(spark, path, kind, fmt)
    assert [tuple(r) for r in rows.collect()] == [(1, "a")]
    assert sorted(r["record"] for r in malformed.collect()) == bad
    assert malformed.count() == len(bad)


def test_replayed_messages_keep_the_contract(spark, tmp_path):
    lines = ['{"event_id": 1, "event_time": "2024-01-01T10:00:00", "product_id": 7, "retailer_id": 2, "new_price": 3.5}',
             '{"event_id": 2, "new_price": "dear"}', "no json", '{"event_id": 3']
    (tmp_path / "a.json").write_text("\n".join(lines))
    for streaming in (False, True):
        events, malformed = topics.replay(spark, "price-changes", str(tmp_path), streaming)
        if streaming:
            events, malformed = changes.drained(events), changes.drained(malformed)
        assert [(r["event_id"], r["product_id"], r["new_price"], r["topic"]) for r in events.collect()] == [
            (1, 7, 3.5, "price-changes")]
        assert sorted(r["value"] for r in malformed.collect()) == sorted(lines[1:])
    with pytest.raises(ValueError):
        topics.replay(spark, "alerts", str(tmp_path))
