import base64
import datetime as dt
import json
import os

import pytest

from fxlake.streaming import ingest as ST

RUN_TS = dt.datetime(2024, 1, 1)


def _drop(folder, name, numbers, day="2024-01-31"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for n in numbers:
            event = {"journal_id": f"J{n}", "journal_line_num": "1", "ledger_id": "L", "effective_date": day and f"{day}T00:00:00",
                     "currency_code": "USD", "entered_dr": str(n), "fx_rate": "1", "legal_entity": "E"}
            f.write((base64.b64encode(json.dumps(event).encode()).decode() if n is not None else "%%%") + "\n")


def _bronze(spark, root):
    return sorted(r.journal_id for r in ST.read_bronze(spark, root).collect())


def test_restart_and_replaced_checkpoint_lose_and_repeat_nothing(spark, tmp_dir):
    inbox, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "lake")
    _drop(inbox, "a.txt", [1, 2, 3, 3, None])
    ST.run_available(spark, inbox, root, RUN_TS)
    _drop(inbox, "b.txt", [2, 4])
    ST.run_available(spark, inbox, root, RUN_TS)
    assert _bronze(spark, root) == ["J1", "J2", "J3", "J4"]
    counters = sorted((r.epoch, r.accepted, r.skipped, r.corrupt) for r in ST.read_counters(spark, root).collect())
    assert counters == [(0, 3, 1, 1), (1, 1, 1, 0)]
    # Another checkpoint starts again at epoch 0 and sees all files once more.
    _drop(inbox, "c.txt", [1, 5])
    ST.run_available(spark, inbox, root, RUN_TS, checkpoint=os.path.join(tmp_dir, "second"))
    assert _bronze(spark, root) == ["J1", "J2", "J3", "J4", "J5"]
    assert ST.read_silver(spark, root).count() + spark.read.parquet(os.path.join(root, "quarantine")).count() == 5


def test_replayed_micro_batch_overwrites_itself(spark, tmp_dir):
    inbox, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "lake")
    _drop(inbox, "a.txt", [1, 2])
    rows = ST.branches(spark.read.text(inbox), RUN_TS)
    for _ in range(2):
        ST.process_batch(spark, rows, "r1", 0, root, RUN_TS)
    assert _bronze(spark, root) == ["J1", "J2"]


def test_any_streaming_source(spark, tmp_dir):
    stream = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 3).option("numPartitions", 1).load()
    root = os.path.join(tmp_dir, "lake")
    try:
        ST.run_stream(stream.selectExpr("'!' AS value"), root, RUN_TS)
    finally:
        pass
    assert ST.read_bronze(spark, root).count() == 0
    assert spark.read.parquet(os.path.join(root, "corrupt")).count() > 0


def _counters(spark, root):
    return sorted((r.epoch, r.accepted, r.skipped, r.corrupt) for r in ST.read_counters(spark, root).collect())


@pytest.mark.parametrize("bound", [None, "10 days"])
def test_a_crash_in_any_epoch_loses_no_counter(spark, tmp_dir, bound):
    """Three micro-batches; the outputs of one are written, but its commit never comes. The restart repeats it."""
    want = [(0, 3, 1, 1), (1, 2, 2, 0), (2, 1, 1, 1)]
    for dies in range(3):
        inbox, root = os.path.join(tmp_dir, f"in{dies}"), os.path.join(tmp_dir, f"lake{dies}")
        for k, numbers in enumerate([[1, 2, 3, 3, None], [2, 4, 5, 5], [1, 6, None]]):
            _drop(inbox, f"{k}.txt", numbers)
            os.utime(os.path.join(inbox, f"{k}.txt"), (1_700_000_000 + k, 1_700_000_000 + k))

        def die(epoch):
            if epoch == dies:
                raise RuntimeError("killed")

        with pytest.raises(Exception, match="killed"):
            ST.run_available(spark, inbox, root, RUN_TS, max_files_per_trigger=1, bound=bound, after_epoch=die)
        ST.run_available(spark, inbox, root, RUN_TS, max_files_per_trigger=1, bound=bound)
        assert _counters(spark, root) == want
        assert _bronze(spark, root) == [f"J{n}" for n in range(1, 7)]
        assert ST.read_corrupt(spark, root).count() == 2


def test_dead_letters_stay_out_of_the_state(spark, tmp_dir):
    inbox, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "lake")
    _drop(inbox, "a.txt", [1, 2, 2, None, None])
    query = ST.run_available(spark, inbox, root, RUN_TS)
    assert [s.numRowsTotal for s in query.lastProgress.stateOperators] == [2]
    _drop(inbox, "b.txt", [None] * 50 + [3])
    query = ST.run_available(spark, inbox, root, RUN_TS)
    assert [s.numRowsTotal for s in query.lastProgress.stateOperators] == [3]
    assert ST.read_corrupt(spark, root).count() == 52
    # A replaced checkpoint reads everything again and adds no dead letter.
    ST.run_available(spark, inbox, root, RUN_TS, checkpoint=os.path.join(tmp_dir, "second"))
    assert ST.read_corrupt(spark, root).count() == 52
    assert _bronze(spark, root) == ["J1", "J2", "J3"]


def test_bounded_state_loses_and_repeats_nothing(spark, tmp_dir):
    """Days go on while repeats of old events and old events never seen before come late, also without a date."""
    inbox, root = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "lake")
    totals = []
    for k in range(12):
        _drop(inbox, f"{k}.txt", range(10 * k, 10 * k + 10), day=f"2024-{k + 1:02d}-15")
        totals.append(ST.run_available(spark, inbox, root, RUN_TS, bound="20 days").lastProgress.stateOperators[0].numRowsTotal)
    assert max(totals[2:]) <= 20
    _drop(inbox, "late.txt", [*range(0, 10), 500, 500], day="2024-01-15")
    _drop(inbox, "none.txt", [600, 600], day="")
    ST.run_available(spark, inbox, root, RUN_TS, bound="20 days")
    _drop(inbox, "again.txt", [500, 3], day="2024-01-15")
    _drop(inbox, "none2.txt", [600, 601], day="")
    ST.run_available(spark, inbox, root, RUN_TS, bound="20 days")
    assert _bronze(spark, root) == sorted(f"J{n}" for n in [*range(120), 500, 600, 601])
    assert [c[1:] for c in _counters(spark, root)][12:] == [(2, 12, 0), (1, 3, 0)]


def test_broken_payloads_are_told_by_the_short_schema(spark):
    texts = ['{"journal_id": "a"}', '{"journal_id": 1, "description": {"x": [1, "y"]}}', '{"account_segments": {"entity": 3}}', '{"account_segments": [1]}',
             '{"account_segments": "text", "effective_date": "2024-01-02"}', '{"account_segments": null}', '[{"journal_id": "a"}]', '[{"a": 1}, {"b": 2}]', "[]", "null", "7",
             '"x"', "", " ", "{", '{"journal_id": "a"', '{"other": {"x": ]}}', '{"other": tru}', '{"other": "\\q"}', '{"other": 01}', "{}", '{"a": 1} {"b": 2}', '{"a": 1} tail',
             "{'journal_id': 'a'}", '{"journal_id": NaN}', '{"other": "a\tb"}', '{"effective_date": "2024-01-31T10"}', '{"effective_date": 7}', '{"effective_date": {"x": 1}}']
    df = spark.createDataFrame([(base64.b64encode(t.encode()).decode(),) for t in texts] + [("%%%",), ("",), (None,)], "value string")
    whole, short = (ST.parse_events(df, *schema).selectExpr("raw_value", "is_corrupt", "e.effective_date").collect() for schema in ((), (ST.JUDGED_SCHEMA,)))
    assert whole == short and 5 < sum(r.is_corrupt for r in whole) < len(texts)


def test_a_payload_is_parsed_once_for_the_state_and_briefly_for_the_counts(spark):
    df = spark.createDataFrame([("%%%",)], "value string")
    plan = ST.branches(df, RUN_TS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2 and plan.count("from_json(StructField(journal_id") == 1


def test_events_are_dropped_by_many_tasks(spark, monkeypatch, tmp_dir):
    from fxlake.plans import catalog
    from tests.conftest import SMOKE_DIR

    monkeypatch.setattr(catalog, "_scratch", lambda spark, label: f"{tmp_dir}/{label}")
    catalog.stream_watermark(spark, SMOKE_DIR)
    assert len(os.listdir(f"{tmp_dir}/stream-watermark/inbox")) > 6
    counters = ST.read_counters(spark, f"{tmp_dir}/stream-watermark").orderBy("epoch").collect()
    n = spark.read.parquet(f"{SMOKE_DIR}/events.parquet").count()
    assert len(counters) == 3 and sum(c.accepted for c in counters) == n and counters[-1].skipped == n
