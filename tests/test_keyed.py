"""Keyed tables: parts rewritten, replays, conflicts; the streams that merge into them."""

from datetime import datetime, timedelta

import pytest

from gridmill.sources.keyed import Conflict, KeyedTable
from gridmill.streaming import streams as X

SCHEMA = "id string, seq int, v int"


@pytest.fixture
def rows(spark):
    return lambda *r: spark.createDataFrame(list(r), SCHEMA)


def content(table, *parts):
    return sorted((r.id or "", r.seq, r.v) for r in table.read(list(parts) or None).collect())


def test_only_touched_parts_are_rewritten(spark, rows, tmp_path):
    t = KeyedTable(spark, f"{tmp_path}/t", ["id"], "seq", buckets=16)
    assert t.manifest() is None
    first = t.upsert(rows(*[(f"k{i}", 1, i) for i in range(200)]))
    assert first["version"] == 0 and len(first["parts"]) == 16
    before = t.manifest()["parts"]
    made = t.upsert(rows(("k7", 2, -7), ("k7", 3, 70), ("k8", 0, -8)))
    after = t.manifest()["parts"]
    assert made["version"] == 1 and 1 <= len(made["parts"]) <= 2
    assert {p for p in after if after[p] != before[p]} == {f"p{p}" for p in made["parts"]}
    assert content(t) == sorted([(f"k{i}", 1, i) for i in range(200) if i != 7] + [("k7", 3, 70)])
    assert content(KeyedTable.open(spark, f"{tmp_path}/t"), made["parts"][0]) == content(t, made["parts"][0])
    files = len(list((tmp_path / "t" / "data" / "1").rglob("*.parquet")))
    assert files == len(made["parts"])


def test_a_batch_that_comes_again_changes_nothing(spark, rows, tmp_path):
    t = KeyedTable(spark, f"{tmp_path}/t", ["id"], "seq")
    t.upsert(rows(("a", 1, 1)), "one", 0)
    t.upsert(rows(("a", 2, 2)), "one", 1)
    assert t.upsert(rows(("a", 9, 9)), "one", 1) == {"version": 1, "parts": []}
    assert t.upsert(rows(("a", 9, 9)), "one", 0) == {"version": 1, "parts": []}
    assert content(t) == [("a", 2, 2)]
    assert t.upsert(rows(("b", 1, 1)), "two", 0)["version"] == 2 and t.manifest()["applied"] == {"one": 1, "two": 0}


def test_the_second_of_two_writers_fails_and_leaves_the_table(spark, rows, tmp_path):
    t = KeyedTable(spark, f"{tmp_path}/t", ["id"], "seq", buckets=2)
    t.upsert(rows(("a", 1, 1)))
    stale = t.manifest()
    t.upsert(rows(("a", 2, 2)))
    late = KeyedTable(spark, f"{tmp_path}/t", ["id"], "seq", buckets=2)
    late._log.write_new = lambda name, text, f=late._log.write_new: f("1", text)
    late.manifest = lambda: stale
    with pytest.raises(Conflict):
        late.upsert(rows(("b", 1, 1)))
    assert t.manifest()["version"] == 1


def test_odd_keys_columns_and_rules(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    t = KeyedTable(spark, path, ["id"], "seq", part="id")
    odd = ["a/b", "50%", "{x}*", "ü =", "", "null", None, "p"]
    t.upsert(rows(*[(k, 1, i) for i, k in enumerate(odd)]))
    assert set(t.upsert(rows(*[(k, 2, i) for i, k in enumerate(odd)]))["parts"]) == set(odd)
    assert content(t) == sorted((k or "", 2, i) for i, k in enumerate(odd))
    assert [content(t, k) for k in odd] == [[(k or "", 2, i)] for i, k in enumerate(odd)]
    with pytest.raises(ValueError):
        t.upsert(rows(("a", 1, 1)).drop("v"))
    with pytest.raises(ValueError):
        KeyedTable(spark, path, ["id"], "seq", part="upper(id)").upsert(rows(("a", 1, 1)))
    with pytest.raises(ValueError):
        KeyedTable.open(spark, f"{tmp_path}/none")
    assert t.upsert(rows().filter("false")) == {"version": 2, "parts": []}
    empty = KeyedTable(spark, f"{tmp_path}/e", ["id"], "seq")
    empty.upsert(rows(("a", 1, 1)).filter("false"))
    assert empty.read().count() == 0 and empty.read().columns == ["id", "seq", "v"]


def test_vacuum_keeps_what_the_newest_manifest_names(spark, rows, tmp_path):
    t = KeyedTable(spark, f"{tmp_path}/t", ["id"], "seq", part="substr(id, 1, 1)")
    assert t.vacuum() == 0
    t.upsert(rows(("a1", 1, 1), ("b1", 1, 1)))
    t.upsert(rows(("a1", 2, 2)))
    t.upsert(rows(("a2", 2, 2)))
    assert t.vacuum() == 2 and t.vacuum() == 0
    assert content(t) == [("a1", 2, 2), ("a2", 2, 2), ("b1", 1, 1)]
    assert t.upsert(rows(("b1", 5, 5)))["version"] == 3


EVENTS = "ts timestamp, kind string, value double"


def test_late_rows_and_bounded_state(spark, tmp_path):
    landed, checkpoint, start = f"{tmp_path}/in", f"{tmp_path}/c", datetime(2024, 1, 1)
    table = X.windows_table(spark, f"{tmp_path}/t", "kind")
    states, rewritten = [], []

    def land(*rows):
        spark.createDataFrame(list(rows), EVENTS).coalesce(1).write.mode("append").parquet(landed)
        stream = X.read_files(spark, landed, spark.createDataFrame([], EVENTS).schema).selectExpr("*", "value / 100 AS severity_score")
        before = (table.manifest() or {"parts": {}})["parts"]
        query = X.windows_to(X.hourly_counts(stream, "ts", "kind", "1 day"), table, checkpoint)
        query.awaitTermination()
        states.append(max(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators))
        rewritten.append(sorted(p for p, v in table.manifest()["parts"].items() if before.get(p) != v))

    for day in range(6):
        land(*[(start + timedelta(days=day, hours=h), "k", 10.0 * h) for h in range(24)])
    assert max(states) <= 24 * 3, states  # a day that is new, the day of the lateness, and what the next batch evicts
    assert rewritten[-1] == ["p2024-01-06"]
    inside, outside = start + timedelta(days=5, hours=3, minutes=5), start + timedelta(days=1, hours=3)
    land((inside, "k", 90.0), (outside, "k", 90.0), (start + timedelta(days=6), "k", 1.0))
    assert rewritten[-1] == ["p2024-01-06", "p2024-01-07"]
    got = {(r.hour, r.n, r.total, r.severe_document_count) for r in table.read().collect()}
    assert len(got) == 6 * 24 + 1
    assert (start + timedelta(days=5, hours=3), 2, 120, 1) in {(h, n, int(t), s) for h, n, t, s in got}
    assert (start + timedelta(days=1, hours=3), 1, 30, 0) in {(h, n, int(t), s) for h, n, t, s in got}


def test_a_stream_of_upserts_rewrites_what_it_touches(spark, rows, tmp_path):
    landed, table = f"{tmp_path}/in", KeyedTable(spark, f"{tmp_path}/t", ["id"], "seq", buckets=32)
    counts = []
    for batch in ([(f"k{i}", 1, i) for i in range(300)], [("k5", 2, 50), ("k5", 3, 51)], [("k5", 1, 0)]):
        rows(*batch).coalesce(1).write.mode("append").parquet(landed)
        X.upsert_to(X.read_files(spark, landed, rows().schema), table, f"{tmp_path}/c").awaitTermination()
        counts.append(sum(v.startswith(f"{table.manifest()['version']}/") for v in table.manifest()["parts"].values()))
    assert counts == [32, 1, 1]
    assert content(table) == sorted([(f"k{i}", 1, i) for i in range(300) if i != 5] + [("k5", 3, 51)])
    assert table.manifest()["applied"] == {f"{tmp_path}/c": 2}
