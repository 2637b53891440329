"""What op5 asks of the driver: broadcasts of bounded size only."""

from colonnade import session
from colonnade.llm import chosen_path

TEXTS = [" ".join(f"w{i}x{k}" for k in range(30)) for i in range(6)]
ROWS = list(enumerate(TEXTS + [f"{t} last" for t in TEXTS]))
WANT = {i: i % 6 for i in range(12)}


def near(spark):
    out = chosen_path.near_duplicates(spark.createDataFrame(ROWS, "doc_id long, text string"))
    return out, {r["doc_id"]: r["component_id"] for r in out.collect()}


def test_no_step_broadcasts_more_than_its_bound(spark, monkeypatch):
    held, write = [], chosen_path.materialize
    monkeypatch.setattr(chosen_path, "materialize", lambda *a: held.append(int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))) or write(*a))
    with session.held_conf(spark, session.BROADCAST, str(64 << 20)):
        before = spark.conf.get(session.BROADCAST)
        out, got = near(spark)
        assert spark.conf.get(session.BROADCAST) == before
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()  # as many rows as sets
    assert got == WANT and len(held) > 3 and max(held) <= chosen_path.RELATION
    with session.held_conf(spark, session.BROADCAST, "-1"):
        assert session.least_broadcast(spark, chosen_path.RELATION) == "-1"
