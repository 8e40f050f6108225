"""The index of ids: exact answers, only the buckets it needs, loads that end anywhere."""

import pytest
from pyspark.sql import functions as F

from opsloom.sources import lake as L
from opsloom.sources.idindex import IdIndex

START = "2026-01-01 00:00:00"


def ids(spark, *numbers):
    return spark.createDataFrame([(f"E{i}",) for i in numbers], "event_id string")


def events(spark, numbers):
    rows = [(f"E{i}" if i is not None else None, f"C{i}", 200) for i in numbers]
    made = spark.createDataFrame(rows, "event_id string, customer_id string, status_code long")
    return made.withColumn("timestamp", F.lit(START).cast("timestamp"))


def held(spark, path):
    return sorted((r.event_id or "" for r in L.read_event_lake(spark, path).collect()))


def names(*numbers):
    return sorted(f"E{i}" for i in numbers)


def test_known_ids_over_runs_and_compaction(spark, scratch):
    index = IdIndex(spark, f"{scratch}/ids", buckets=8)
    assert index.known(ids(spark, 1)).count() == 0
    for run in range(2):
        index.record(index.begin(ids(spark, *range(run * 200, run * 200 + 200))))
    asked = ids(spark, *range(350, 450))
    assert sorted(r[0] for r in index.known(asked).collect()) == names(*range(350, 400))
    # Few ids beyond those held pass the filter, none that is held fails it.
    assert index.suspects(ids(spark, *range(400))).count() == 400
    assert index.suspects(ids(spark, *range(1000, 3000))).count() <= 20
    # A small load opens one file of a run at most for each id it may meet, none for ids the filter rules out.
    every = index.held_in(list(range(8))).select(F.input_file_name()).distinct().count()
    few = [r.bucket for r in index.suspects(ids(spark, 7, 9001, 9002)).collect()]
    assert every == 16 and len(few) == 1
    assert index.held_in(few).select(F.input_file_name()).distinct().count() == 2
    assert index.suspects(ids(spark, 9001, 9002, 9003)).count() == 0
    assert [r[0] for r in index.known(ids(spark, 7, 9001)).collect()] == ["E7"]
    index.compact(most=1)
    index = IdIndex(spark, f"{scratch}/ids")
    assert len(index.runs()) == 1 and index.buckets == 8
    assert index.held_in(few).select(F.input_file_name()).distinct().count() == 1
    assert sorted(r[0] for r in index.known(asked).collect()) == names(*range(350, 400))


def test_loads_append_what_is_new(spark, scratch):
    lake, index = f"{scratch}/lake", f"{scratch}/ids"
    for load in ([1, 2, 2, None], [], [3, 1, 4]):
        L.write_event_lake(events(spark, load), lake, index=index)
    assert held(spark, lake) == ["", *names(1, 2, 3, 4)]
    L.write_event_lake(events(spark, [4, 5]), lake, whole_days=True, index=index)
    L.write_event_lake(events(spark, [1, 4]), lake, index=index)
    assert held(spark, lake) == names(1, 4, 5)


def test_an_index_for_a_lake_that_has_rows(spark, scratch):
    L.write_event_lake(events(spark, [1, 2]), f"{scratch}/lake")
    L.write_event_lake(events(spark, [2, 3]), f"{scratch}/lake", index=f"{scratch}/ids")
    assert held(spark, f"{scratch}/lake") == names(1, 2, 3)


@pytest.mark.parametrize("before,end", [([], "rows"), ([9], "rows"), ([9], "record")])
def test_a_load_that_ends_between_its_writes(spark, scratch, monkeypatch, before, end):
    """Ended before the rows or before the record: the same load again completes it."""
    lake, index = f"{scratch}/lake", f"{scratch}/ids"
    if before:
        L.write_event_lake(events(spark, before), lake, index=index)

    def stop(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(*((L, "_write_days", stop) if end == "rows" else (IdIndex, "record", stop)))
        with pytest.raises(RuntimeError):
            L.write_event_lake(events(spark, [1, 2]), lake, index=index)
    L.write_event_lake(events(spark, [1, 2, 3]), lake, index=index)
    assert held(spark, lake) == names(*before, 1, 2, 3)
    L.write_event_lake(events(spark, [2, 3, 4]), lake, index=index)
    assert held(spark, lake) == names(*before, 1, 2, 3, 4) and IdIndex(spark, index).pending() == []
