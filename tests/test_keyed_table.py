"""The keyed table: pieces merged and split, writers side by side, earlier versions."""

import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.sinks import keyed_table as K
from ordermill.sinks.files import _hadoop, _rename, create_file

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


@pytest.fixture
def table(spark, tmp_path):
    return lambda **more: K.KeyedTable(spark, str(tmp_path / "t"), "id", SCHEMA, **({"buckets": 4} | more))


def rows_of(table, version=None):
    return {r["id"]: r["n"] for r in table.read(table.snapshot(version)).collect()}


def change(table, rows, action, tag=None, base=None):
    base = base or table.snapshot()
    changes = table.spark.createDataFrame(rows, SCHEMA).withColumn("action", F.lit(action))
    return table.commit(base, table.stage(changes, base), tag=tag)


def test_small_deliveries_leave_few_pieces(table, monkeypatch):
    monkeypatch.setattr(K, "PIECES", 4)
    made = table()
    for run in range(14):
        change(made, [(f"{run}-{i}", i) for i in range(12 + 40 * (run == 3))], K.INSERTED)
    for version in range(1, 15):
        pieces = made.pieces(made.snapshot(version))
        assert max(sum(p.serves(b) for p in pieces) for b in range(4)) <= 4
        assert len(pieces) >= 4
    assert len(rows_of(made)) == 14 * 12 + 40
    # Earlier versions stay readable, their pieces as they were.
    assert rows_of(made, 2) == {f"{run}-{i}": i for run in range(2) for i in range(12)}
    sizes = {p.path for v in range(1, 15) for p in made.pieces(made.snapshot(v))}
    assert len(sizes) < 14 * 4 * 2.5


def test_buckets_double_and_old_pieces_are_split_when_rewritten(table):
    made = table(bucket_bytes=900)
    first = [(f"k{i}", i) for i in range(300)]
    assert change(made, first, K.INSERTED).buckets > 4
    grown = made.snapshot().buckets
    assert {p.buckets for p in made.pieces(made.snapshot())} == {4}
    one = made.read(buckets={3}).select(made.bucket(F.col("id"), grown)).distinct().collect()
    assert [r[0] for r in one] == [3]
    change(made, [(f"k{i}", -i) for i in range(0, 300, 7)], K.UPDATED)
    state = made.snapshot()
    assert {p.buckets for p in made.pieces(state)} == {grown}
    assert rows_of(made) == {f"k{i}": -i if i % 7 == 0 else i for i in range(300)}
    parts = [made.read(state, {b}).count() for b in range(state.buckets)]
    assert sum(parts) == 300
    assert rows_of(made, 1) == dict(first)


def test_runs_side_by_side_both_arrive(table):
    made, other = table(), table()
    change(made, [(f"k{i}", 0) for i in range(40)], K.INSERTED)
    base = made.snapshot()
    # Both start from the same state; the one that commits second takes the next version.
    assert change(made, [("a", 1)], K.INSERTED, "first", base).version == 2
    assert change(other, [("b", 2)], K.INSERTED, "second", base).version == 3
    assert rows_of(made) == {f"k{i}": 0 for i in range(40)} | {"a": 1, "b": 2}
    assert made.tagged("first").version == 2 and made.tagged("none") is None
    assert [(r["id"], r["version"]) for r in made.changes(1, 3).orderBy("version").collect()] == [("a", 2), ("b", 3)]


@pytest.mark.parametrize("mine, theirs", [
    (("a", K.INSERTED), ("a", K.INSERTED)),  # the same new key twice
    (("k1", K.UPDATED), ("k1", K.UPDATED)),
    (("k1", K.UPDATED), ("k1", K.UNCHANGED)),  # compared with a row that has changed since
])
def test_the_same_key_conflicts(table, mine, theirs):
    made = table()
    change(made, [(f"k{i}", 0) for i in range(10)], K.INSERTED)
    base = made.snapshot()
    change(made, [(mine[0], 1)], mine[1], base=base)
    changes = made.spark.createDataFrame([(theirs[0], 2), ("new", 3)], SCHEMA)
    changes = changes.withColumn("action", F.when(F.col("id") == "new", K.INSERTED).otherwise(theirs[1]))
    with pytest.raises(K.Conflict):
        made.commit(base, made.stage(changes, base))
    assert made.snapshot().version == 2 and "new" not in rows_of(made)


def test_a_piece_rewritten_by_another_run_conflicts(table):
    made = table(buckets=1)
    change(made, [("k1", 0), ("k2", 0)], K.INSERTED)
    base = made.snapshot()
    change(made, [("k1", 1)], K.UPDATED, base=base)
    with pytest.raises(K.Conflict):
        change(made, [("k2", 2)], K.UPDATED, base=base)
    assert rows_of(made) == {"k1": 1, "k2": 0}


def test_threads_that_retry_lose_nothing(table):
    made, errors = table(buckets=2), []

    def writer(name):
        own = table(buckets=2)

        def once():
            base = own.snapshot()
            held = {r["id"]: r["n"] for r in own.read(base).where("id = 'sum'").collect()}
            rows = own.spark.createDataFrame([("sum", held.get("sum", 0) + 1), (name, 1)], SCHEMA)
            known = F.when((F.col("id") == "sum") & F.lit(bool(held)), K.UPDATED).otherwise(K.INSERTED)
            return own.commit(base, own.stage(rows.withColumn("action", known), base))

        try:
            K.retried(once)
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=writer, args=(f"w{n}",)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert rows_of(made) == {"sum": 4} | {f"w{n}": 1 for n in range(4)}


def test_a_file_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/c/1.json"
    assert create_file(spark, path, "one") and not create_file(spark, path, "two")
    assert open(path).read() == "one"
    for name in ("a", "b"):
        (tmp_path / name).write_text(name)
    a, b, new = (_hadoop(spark, f"{tmp_path}/{name}")[0] for name in ("a", "b", "new"))
    _rename(spark, a, new)
    with pytest.raises(FileExistsError):
        _rename(spark, b, new)
    assert (tmp_path / "new").read_text() == "a"


def test_large_change_set_shuffles_the_survivors_once(table, monkeypatch):
    monkeypatch.setattr(K, "BROADCAST_KEYS", 0)
    made = table(buckets=8)
    change(made, [(f"k{i}", i) for i in range(100)], K.INSERTED)
    after = change(made, [(f"k{i}", -i) for i in range(0, 100, 3)], K.UPDATED)
    assert rows_of(made) == {f"k{i}": i if i % 3 else -i for i in range(100)}
    # One piece of new rows and one of survivors in a bucket.
    assert max(sum(p.bucket == b for p in made.pieces(after)) for b in range(8)) <= 2
    staged, pieces = made._sets([after.change_set]), made.pieces(made.snapshot(1))

    def plan(buckets):
        kept = made._survivors(staged, pieces, 34, buckets, False)
        assert sorted(r["n"] for r in kept.collect()) == [i for i in range(100) if i % 3]
        return kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]

    threshold = made.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    made.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # The rows and the keys; not the rows again by bucket.
        assert plan(8).count("Exchange hashpartitioning") == 2
        # Fewer buckets than the session's shuffles are wide: a join by key would scatter them.
        assert "Exchange hashpartitioning(bucket" in plan(3)
    finally:
        made.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_files_of_a_change_set_are_the_pieces_of_its_rows(table, tmp_path):
    made = table()
    first = change(made, [(f"k{i}", i) for i in range(60)], K.INSERTED)
    pieces = made.pieces(first)
    # Written once, unsorted, a bucket to a file.
    assert len(pieces) == 4 and all(p.path.startswith("changes/") for p in pieces)
    assert not (tmp_path / "t" / "data").exists()
    # Rows that are not in the table lie next to the new ones.
    both = made.spark.createDataFrame([("k1", -1, K.UPDATED), ("k2", None, K.DELETED), ("k60", 60, K.INSERTED),
                                       ("k3", None, K.UNCHANGED)], "id string, n long, action string")
    made.commit(first, made.stage(both, first))
    expected = {f"k{i}": i for i in range(61) if i != 2} | {"k1": -1}
    assert rows_of(made) == expected and rows_of(made, 1) == {f"k{i}": i for i in range(60)}
    # Mostly others: the new rows get files of their own.
    base = made.snapshot()
    rest = made.spark.createDataFrame([(f"k{i}", None, K.UNCHANGED) for i in range(10, 50)] + [("k61", 61, K.INSERTED)],
                                      "id string, n long, action string")
    last = made.commit(base, made.stage(rest, base))
    assert {p.path.split("/")[0] for p in set(made.pieces(last)) - set(made.pieces(base))}.isdisjoint({"changes"})
    assert rows_of(made) == expected | {"k61": 61}


def test_files_with_several_buckets_are_no_pieces(table):
    made = table()
    base = made.snapshot()
    rows = made.spark.createDataFrame([(f"k{i}", i) for i in range(60)], SCHEMA)
    after = made.commit(base, made.stage(rows.withColumn("action", F.lit(K.INSERTED)), base, tasks=3))
    assert rows_of(made) == {f"k{i}": i for i in range(60)}
    own = made.spark.range(1).select(made.bucket(F.lit("k7"), 4)).first()[0]
    assert "k7" in {r["id"] for r in made.read(after, {own}).collect()}
    assert len(made.pieces(after)) == 4


@pytest.mark.parametrize("task_keys, parts", [(100, 64), (0, 2)])
def test_large_change_set_copies_survivors_without_a_shuffle(table, monkeypatch, task_keys, parts):
    monkeypatch.setattr(K, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(K, "TASK_KEYS", task_keys)
    monkeypatch.setattr(K, "PARTS", parts)
    monkeypatch.setattr(K.KeyedTable, "_survivors", None)
    made = table(bucket_bytes=900)
    # Pieces of 4 buckets serve those of the grown table; buckets without a changed key keep their rows.
    change(made, [(f"k{i}", i) for i in range(300)] + [(None, -5)], K.INSERTED)
    buckets = made.snapshot().buckets
    assert buckets > 4
    changed = [i for i in range(300) if i % 7 == 0]
    after = change(made, [(f"k{i}", -i) for i in changed] + [("gone", 0)], K.UPDATED)
    assert rows_of(made) == {f"k{i}": -i if i % 7 == 0 else i for i in range(300)} | {None: -5, "gone": 0}
    change(made, [(f"k{i}", None) for i in changed[:5]], K.DELETED)
    assert sorted(r["n"] for r in made.read().where("n > 0").collect()) == [i for i in range(300) if i % 7]
    assert made.read(after, set(range(after.buckets))).count() == 302


def test_survivors_of_a_large_change_set_stay_in_their_tasks(table, monkeypatch):
    monkeypatch.setattr(K, "BROADCAST_KEYS", 0)
    made, plans = table(buckets=8), []
    change(made, [(f"k{i}", i) for i in range(100)], K.INSERTED)
    write = K.reduce

    def seen(function, parts):
        rows = write(function, parts)
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows

    monkeypatch.setattr(K, "reduce", seen)
    change(made, [(f"k{i}", -i) for i in range(0, 100, 3)], K.UPDATED)
    assert len(plans) == 1 and "Exchange" not in plans[0] and plans[0].count("ShuffledHashJoin") == 8
    assert rows_of(made) == {f"k{i}": i if i % 3 else -i for i in range(100)}
