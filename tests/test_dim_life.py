"""Dimension tables made, dropped and made anew by rule changes in the stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemill.session import scratch
from tidemill.sources import schemas, streams
from tidemill.streaming import dims


def rule(op, ts, old=None, new=None, source="t"):
    def whole(r):
        return r and {"source_table": source, "sink_table": r[0], "sink_columns": r[1], "sink_row_key": "id"}

    return {"op": op, "before": whole(old), "after": whole(new), "source": {"table": dims.RULE_TABLE}, "ts_ms": ts}


def row(ts, table="t", op="c", **fields):
    return {"op": op, "before": None, "after": fields, "source": {"table": table}, "ts_ms": ts}


def parsed(spark, records):
    return streams.parsed(spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "value string"), schemas.ENVELOPE)


def filled(spark, *batches):
    tables = dims.DimTables(spark, scratch(spark, "dims"))
    for n, records in enumerate(batches):
        tables.add(parsed(spark, records), n)
    return tables


def held(tables, as_rows, version=None):
    return as_rows(tables.read(version).select("sink_table", "row_key", F.to_json("columns")))


BATCHES = [
    [rule("r", 1, new=("d", "id,name")), row(1, id="1", name="a", x="x"), row(1, "unknown", id="9"), "{broken", row(1, name="without key")],
    [row(2, id="1", name="b"), row(0, id="2", name="late"), row(3, op="d", id="2")],
    [rule("u", 5, old=("d", "id,name"), new=("d", "id,x")), row(4, id="3", x="z", name="c")],
    [rule("d", 6, old=("d", "id,x")), row(7, id="4", x="lost")],
    [rule("c", 8, new=("d", "id,name")), row(8, id="5", name="e")],
]


def test_made_dropped_and_made_anew(spark, as_rows):
    tables = filled(spark, *BATCHES)
    assert held(tables, as_rows, 0) == [("d", "1", '{"id":"1","name":"a"}')]
    assert held(tables, as_rows, 1) == [("d", "1", '{"id":"1","name":"b"}'), ("d", "2", '{"id":"2","name":"late"}')]
    assert held(tables, as_rows, 2) == [("d", "3", '{"id":"3","x":"z"}')]  # old rows and the old column are gone
    assert held(tables, as_rows, 3) == [] and tables.tables(3).count() == 0
    assert held(tables, as_rows) == [("d", "5", '{"id":"5","name":"e"}')]
    assert tables.table("d").columns == ["id", "name"] and as_rows(tables.table("d", 2)) == [("3", "z")]
    with pytest.raises(ValueError):
        tables.table("d", 3)
    with pytest.raises(ValueError):
        tables.read(17)


def test_a_batch_run_again_changes_nothing(spark, as_rows):
    tables = filled(spark, *BATCHES)
    before = [held(tables, as_rows, v) for v in tables.versions()]
    for n in (4, 2):
        tables.add(parsed(spark, BATCHES[n]), n)
    assert [held(tables, as_rows, v) for v in tables.versions()] == before


def test_rows_without_a_published_list_are_not_seen(spark, as_rows):
    tables = filled(spark, *BATCHES[:1])
    spark.createDataFrame([("7", {"id": "7"}, 9, "d", 0, 1)], dims.ROWS).write.mode("append").partitionBy("sink_table", "since", "batch").parquet(f"{tables.path}/rows")
    assert held(tables, as_rows) == [("d", "1", '{"id":"1","name":"a"}')]


def test_steps_of_one_batch(spark, as_rows):
    first = [rule("c", 1, new=("d", "id")), row(1, id="1")]
    kept = filled(spark, first, [rule("c", 2, new=("d", "id,n")), row(2, id="2", n="n")])
    assert [r[1] for r in held(kept, as_rows)] == ["1", "2"] and kept.table("d").columns == ["id", "n"]
    anew = filled(spark, first, [rule("c", 3, new=("d", "id")), rule("d", 2, old=("d", "id")), row(2, id="2")])
    assert [r[1] for r in held(anew, as_rows)] == ["2"]
    gone = filled(spark, first, [rule("c", 2, new=("d", "id")), rule("d", 3, old=("d", "id"))])
    assert held(gone, as_rows) == []
    moved = filled(spark, first, [rule("u", 2, old=("d", "id"), new=("e/1 =%", "id")), row(2, id="2")])
    assert held(moved, as_rows) == [("e/1 =%", "2", '{"id":"2"}')]
    two = filled(spark, first, [rule("c", 2, new=("e", "id,n")), row(2, id="2", n="n")])
    assert held(two, as_rows) == [("d", "1", '{"id":"1"}'), ("d", "2", '{"id":"2"}'), ("e", "2", '{"id":"2","n":"n"}')]
    nothing = filled(spark, [rule("c", 1, new=(None, "id")), rule("d", 1), {"op": "c", "source": {"table": dims.RULE_TABLE}}])
    assert nothing.tables().count() == 0 and held(nothing, as_rows) == []


def test_old_versions_are_removed(spark, as_rows):
    tables = filled(spark, *BATCHES, [rule("u", 9, old=("f", "id"), new=("e/1 =%", "id")), row(9, id="6")])
    now = held(tables, as_rows)
    assert tables.remove_old(2) == 2 and tables.versions() == [4, 5]
    assert held(tables, as_rows) == now and held(tables, as_rows, 4) == [("d", "5", '{"id":"5","name":"e"}')]
    assert {r[0] for r in spark.read.schema(dims.ROWS).parquet(f"{tables.path}/rows").select("since").distinct().collect()} == {4, 5}
    assert tables.remove_old(2) == 0 and tables.remove_old(0) == 0 and held(tables, as_rows) == now


def test_rows_being_written_are_not_removed(spark):
    tables = filled(spark, BATCHES[0])
    spark.createDataFrame([("7", {"id": "7"}, 9, "new", 1, 1)], dims.ROWS).write.mode("append").partitionBy("sink_table", "since", "batch").parquet(f"{tables.path}/rows")
    assert tables.remove_old() == 0


def test_empty(spark, as_rows):
    tables = dims.DimTables(spark, scratch(spark, "dims"))
    assert tables.versions() == [] and held(tables, as_rows) == [] and tables.tables().count() == 0 and tables.remove_old() == 0
    tables.add(parsed(spark, []), 0)
    assert held(tables, as_rows) == []


def test_stream(spark, tmp_path, as_rows):
    for n, records in enumerate(BATCHES):
        f = tmp_path / f"{n}.txt"
        f.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))
        os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))
    stream = streams.json_stream(spark, "text", str(tmp_path), schemas.ENVELOPE, files_per_batch=1)
    tables = dims.dim_lifecycle_job(stream, scratch(spark, "dims"))
    assert tables.versions() == [0, 1, 2, 3, 4]
    assert held(tables, as_rows) == [("d", "5", '{"id":"5","name":"e"}')]
