import json
import random
from datetime import datetime, timedelta

from tenure.contracts import EVENTS
from tenure.streaming.events import drop_redelivered, event_stream, late_rows, stream_session, undated, write_available
from tests.conftest import rows

START = datetime(2025, 1, 1)


def event(i, minutes):
    at = (START + timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return {"event_id": f"e{i}", "event_type": "invoice_paid", "event_ts": at,
            "payload": {"customer_id": f"c{i % 3}", "amount": i, "failure_reason": None}}


def deliver(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps(e) + "\n" for e in events))


def run(spark, stream, tmp_path, name="out"):
    out = str(tmp_path / name)
    query = write_available(stream, out, str(tmp_path / f"{name}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(out), query


def test_stream_equals_the_batch(spark, tmp_path):
    deliver(tmp_path / "in", "a", [event(i, i) for i in range(20)])
    out, _ = run(spark, event_stream(spark, str(tmp_path / "in")).drop("arrival"), tmp_path)
    assert [(r.event_id, r.event_ts, r.customer_id) for r in out.orderBy("amount").collect()] == [
        (f"e{i}", START + timedelta(minutes=i), f"c{i % 3}") for i in range(20)
    ]


def test_repeated_deliveries_over_many_files_and_batches(spark, tmp_path):
    """Shuffled, repeated and in several micro-batches; one event holds a third of all deliveries."""
    rng = random.Random(3)
    deliveries = [event(i, i) for i in range(60)] * 2 + [event(7, 7)] * 60
    rng.shuffle(deliveries)
    for n in range(6):
        deliver(tmp_path / "in", f"f{n}", deliveries[n::6])
    stream = drop_redelivered(event_stream(spark, str(tmp_path / "in"), max_files_per_trigger=2), "3 hours", salts=4)
    out, query = run(spark, stream, tmp_path)
    assert sorted(r.event_id for r in out.collect()) == sorted(f"e{i}" for i in range(60))
    assert late_rows(query) == 0
    assert "arrival" not in out.columns and "salt" not in out.columns


def test_restart_remembers_what_it_has_seen(spark, tmp_path):
    source = tmp_path / "in"
    deliver(source, "a", [event(1, 0), event(2, 1)])
    for _ in range(2):
        out, _ = run(spark, drop_redelivered(event_stream(spark, str(source)), "1 hour"), tmp_path)
        deliver(source, "b", [event(2, 1), event(3, 2)])
    assert sorted(r.event_id for r in out.collect()) == ["e1", "e2", "e3"]


def test_state_partitions_belong_to_the_query(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    deliver(tmp_path / "in", "a", [event(1, 0), event(1, 0)])
    stream = drop_redelivered(event_stream(stream_session(spark, 3), str(tmp_path / "in")), "1 hour")
    query = write_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert {s["numShufflePartitions"] for p in query.recentProgress for s in p["stateOperators"]} == {3}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_rows_beyond_the_watermark_are_dropped_and_counted(spark, tmp_path):
    source = tmp_path / "in"
    deliver(source, "a", [event(1, 0), event(2, 600)])
    run(spark, drop_redelivered(event_stream(spark, str(source)), "1 hour"), tmp_path)
    deliver(source, "b", [event(3, 10), event(4, 601)])
    out, query = run(spark, drop_redelivered(event_stream(spark, str(source)), "1 hour"), tmp_path)
    assert sorted(r.event_id for r in out.collect()) == ["e1", "e2", "e4"]
    assert late_rows(query) == 1


def test_undated_rows_have_their_own_way_out(spark, tmp_path):
    broken = {**event(5, 0), "event_ts": "yesterday"}
    deliver(tmp_path / "in", "a", [event(1, 0), broken])
    kept, _ = run(spark, drop_redelivered(event_stream(spark, str(tmp_path / "in")), "1 hour"), tmp_path)
    aside, _ = run(spark, undated(event_stream(spark, str(tmp_path / "in"))), tmp_path, "aside")
    assert [r.event_id for r in kept.collect()] == ["e1"]
    assert [r.event_id for r in aside.collect()] == ["e5"]
    assert len(rows(kept)) == 1 and EVENTS.key == ("event_id",)
