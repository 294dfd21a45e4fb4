"""Engagement from a stream against the batch mart, also after a replay."""

import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tenure.operators.bitmaps import numbered
from tenure.plans import cohorts
from tenure.sources.files import delete
from tenure.streaming.engagement import EngagementStream
from tenure.streaming.events import event_stream, stream_session
from tests.conftest import rows


def test_stream_equals_batch_and_survives_a_replay(spark, tmp_path):
    rng = random.Random(2)
    customers = spark.createDataFrame([(f"c{i}", datetime(2025, 1, 1) + timedelta(rng.randrange(60))) for i in range(80)], "customer_id string, created_at timestamp")
    own = cohorts.customer_cohorts(customers)
    members = own.join(numbered(own.select("customer_id"), "customer_id", None, str(tmp_path / "n")), "customer_id").select("customer_id", "cohort_month", "number")
    members.write.parquet(str(tmp_path / "members"))
    session = stream_session(spark, 2)
    engaged = EngagementStream(session, str(tmp_path / "mart"), session.read.parquet(str(tmp_path / "members")))
    folder = tmp_path / "landing"
    folder.mkdir()
    events = []
    for k in range(3):
        batch = [(f"e{rng.randrange(500)}", f"c{rng.randrange(90)}", datetime(2025, 1, 1) + timedelta(rng.randrange(140))) for _ in range(150)]
        batch += batch[:20]  # delivered twice
        events += batch
        (folder / f"{k}.json").write_text("\n".join(json.dumps({"event_id": e, "event_ts": t.strftime("%Y-%m-%dT%H:%M:%SZ"), "payload": {"customer_id": c}}) for e, c, t in batch))
        engaged.run(event_stream(session, str(folder)))
        seen = spark.createDataFrame([(c, t) for _, c, t in events], "customer_id string, event_ts timestamp")
        want = rows(cohorts.retention_engagement(customers, seen, "2025-08-01"))
        assert rows(engaged.read("2025-08-01")) == want and any(r[5] for r in want)
    # The last batch did its work, and the stream stopped before it noted so: it is replayed.
    last = max(int(p.name) for p in (tmp_path / "mart/checkpoint/commits").iterdir() if p.name.isdigit())
    delete(spark, f"{tmp_path}/mart/checkpoint/commits/{last}")
    engaged.run(event_stream(session, str(folder)))
    assert rows(engaged.read("2025-08-01")) == want
    assert rows(EngagementStream(session, str(tmp_path / "none"), members).read("2025-08-01").agg(F.sum("retained_users"))) == [(0,)]
