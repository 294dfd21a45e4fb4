"""Events told apart as they arrive, against a plain computation, also after replays."""

import json
import random
from datetime import datetime, timedelta

import pytest

from tenure.jobs import Layout, events_come_too_late, load_event_stream
from tenure.sources.files import delete
from tenure.sources.tables import read_table
from tenure.streaming.arrivals import Arrivals, told_apart
from tenure.streaming.events import late_rows, stream_session
from tests.conftest import rows

START = datetime(2025, 1, 1)


def line(event_id, minutes):
    at = (START + timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return json.dumps({"event_id": event_id, "event_ts": at, "payload": {"customer_id": "c"}})


def test_runs_equal_a_plain_computation_and_read_new_files_only(spark, tmp_path):
    rng = random.Random(11)
    layout, folder = Layout(str(tmp_path)), tmp_path / "landing/event_stream"
    folder.mkdir(parents=True)
    latest, kept, late = None, set(), []
    for k in range(4):
        events = [(f"e{k}-{i}", 300 * k + rng.randrange(-500, 300)) for i in range(60)]
        events += rng.sample(events, 10)
        if latest is not None:
            events.append((f"edge{k}", latest - 240))  # at the watermark itself: late
            events.append((f"after{k}", latest - 239))
        (folder / f"{k}.json").write_text("".join(line(*e) + "\n" for e in events))
        run = load_event_stream(spark, layout, "4 hours", 2)
        missed = [e for e, m in events if latest is not None and m <= latest - 240]
        late += missed
        kept |= {e for e, m in events if latest is None or m > latest - 240}
        latest = max([m for _, m in events] + ([] if latest is None else [latest]))
        assert run.n_late == late_rows(run) == len(missed)
        # What was read once is not read again.
        (folder / f"{k}.json").unlink()
    assert any(e.startswith("edge") for e in late) and len(late) > 20
    stored = [r.event_id for r in read_table(spark, layout.silver("event_stream")).collect()]
    assert len(stored) == len(set(stored)) and set(stored) == kept
    assert sorted(r.event_id for r in read_table(spark, layout.silver("event_stream_late")).collect()) == sorted(late)
    assert [r[0] for r in rows(events_come_too_late(spark, layout).select("event_id"))] == sorted(set(late) - kept)


def test_copies_of_kept_events_are_late_deliveries_but_not_missing(spark, tmp_path):
    layout, folder = Layout(str(tmp_path)), tmp_path / "landing/event_stream"
    folder.mkdir(parents=True)
    (folder / "1.json").write_text(line("a", 0) + "\n" + line("b", 900) + "\n")
    load_event_stream(spark, layout, "1 hour", 2)
    (folder / "2.json").write_text(line("a", 0) + "\n" + line("x", 1) + "\n" + line("x", 2) + "\n")
    assert load_event_stream(spark, layout, "1 hour", 2).n_late == 3
    assert load_event_stream(spark, layout, "1 hour", 2).n_late == 0  # nothing new
    assert [r.event_id for r in events_come_too_late(spark, layout).collect()] == ["x"]


@pytest.mark.parametrize("lost", ["mark", "nothing", "everything"])
def test_a_replayed_batch_writes_the_same_again(spark, tmp_path, lost):
    """The last batch stopped at some place before it was noted as done."""
    folder = tmp_path / "in"
    folder.mkdir()
    own = stream_session(spark, 2)
    arrivals = Arrivals(own, str(folder), str(tmp_path / "s"), str(tmp_path / "late"), str(tmp_path / "odd"), "1 hour")

    def state():
        admitted = own.read.parquet(str(tmp_path / "s/rows/*/kind=admitted"))
        return [sorted(r.event_id for r in df.collect()) for df in (admitted, read_table(own, str(tmp_path / "late")), read_table(own, str(tmp_path / "odd")))]

    for name, text in (("1", line("a", 0) + "\n" + line("b", 600)), ("2", line("c", 10) + "\n" + line("d", 700) + "\n" + '{"event_id":"z"}')):
        (folder / f"{name}.json").write_text(text + "\n")
        arrivals.run()
    before = state()
    assert before == [["a", "b", "d"], ["c"], ["z"]] and arrivals.n_late() == 1
    last = max(int(p.name) for p in (tmp_path / "s/checkpoint/commits").iterdir() if p.name.isdigit())
    delete(own, f"{tmp_path}/s/checkpoint/commits/{last}")
    for path in {"nothing": [], "mark": [f"s/marks/{last:010d}"], "everything": [f"s/marks/{last:010d}", f"s/rows/{last:010d}", f"late/batch={last}"]}[lost]:
        delete(own, str(tmp_path / path))
    arrivals.run()
    assert state() == before


def test_lines_of_all_kinds(spark):
    lines = [line("a", 0), "  ", "", "no json", '{"event_id":"u"}', '{"event_id":"s","event_ts":"soon"}', f"[{line('p', 5)}, {line('q', 6)}]",
             line("cut", 1)[:30], "[]", line("b", -1), line("b", -1)]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    mark = spark.createDataFrame([(START,)], "mark timestamp")
    got = sorted((r.kind, r.event_id or "", r.reason or "", r.value or "") for r in told_apart(frame, mark).collect())
    assert [(k, e, w) for k, e, w, _ in got if k != "unreadable"] == [("admitted", "p", ""), ("admitted", "q", ""), ("late", "a", ""), ("late", "b", ""), ("late", "b", "")]
    assert sorted((w, v) for k, _, w, v in got if k == "unreadable") == sorted([
        ("not_json", "no json"), ("not_json", line("cut", 1)[:30]), ("timestamp", '{"event_id":"u"}'),
        ("timestamp", '{"event_id":"s","event_ts":"soon"}'), ("timestamp", "[]")])
    none = spark.createDataFrame([(None,)], "mark timestamp")
    assert told_apart(frame, none).filter("kind = 'late'").count() == told_apart(frame).filter("kind = 'late'").count() == 0
    assert told_apart(frame.limit(0), mark).count() == 0


def test_an_empty_landing_folder(spark, tmp_path):
    layout, folder = Layout(str(tmp_path)), tmp_path / "landing/event_stream"
    folder.mkdir(parents=True)
    assert load_event_stream(spark, layout, "1 hour", 2).n_late == 0
    (folder / "1.json").write_text(line("a", 0) + "\n")
    assert load_event_stream(spark, layout, "1 hour", 2).n_late == 0
    assert [r.event_id for r in read_table(spark, layout.silver("event_stream")).collect()] == ["a"]
