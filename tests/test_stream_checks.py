import datetime as dt

from checks.registry import QUERIES
from checks import load

START = dt.datetime(2024, 1, 1)
KINDS = ("purchase", "signup", "view", "click", "error")


def test_files_arrive_in_id_order(spark, tmp_path):
    """Events that several tasks read, ids dealt over their files: the guard still sees them in id order."""
    load()
    # Times rise with the id but for every seventh event.
    rows = [(i, START + dt.timedelta(hours=i - (9 * i if i % 7 == 3 else 0)), i, KINDS[i // 5 % 5], float(i % 50), "{}") for i in range(400)]
    for k in range(5):
        part = spark.createDataFrame(rows[4 - k :: 5], "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    latest, want = {}, {}
    for i, ts, _, kind, _, _ in rows:
        want[i] = kind not in latest or ts > latest[kind]
        latest[kind] = max(latest.get(kind, ts), ts)
    got = {r.datastream_id: r.is_newest for r in QUERIES["stream_gate"](spark, str(tmp_path)).collect()}
    assert got == want
