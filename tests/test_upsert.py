import datetime as dt

import pytest

from martlet.operators.upsert import (DuplicateKeyError, PartitionedMerge, check_mergeable, incremental_bound,
                                      merge_rows)
from martlet.plans.silver import incremental_lower_bound
from martlet.sources.tables import TableStore

from helpers import rows

D = dt.date


def test_null_safe_is_idempotent_plain_doubles_null_keys(spark):
    t = spark.createDataFrame([("a", 1, 10), (None, 2, 20), ("c", None, 30)], "k1 string, k2 int, v int")
    once = merge_rows(t, t, ["k1", "k2"], null_safe=True)
    assert rows(once) == rows(t)
    plain = merge_rows(t, t, ["k1", "k2"], null_safe=False)
    assert plain.count() == 5  # the two NULL-key rows are inserted again
    assert rows(merge_rows(plain, t, ["k1", "k2"], null_safe=False)).count(("c", None, 30)) == 3


def test_merge_replaces_matches_keeps_others_and_syncs_columns(spark):
    t = spark.createDataFrame([(1, "old", "x"), (2, "keep", "y")], "k int, v string, gone string")
    s = spark.createDataFrame([(1, "new", True), (3, "add", False)], "k int, v string, extra boolean")
    m = merge_rows(t, s, ["k"])
    assert m.columns == ["k", "v", "extra"]
    assert rows(m) == [(1, "new", True), (2, "keep", None), (3, "add", False)]


def test_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    dup_hit = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(DuplicateKeyError):
        check_mergeable(t, dup_hit, ["k"])
    dup_new = spark.createDataFrame([(5, "x"), (5, "y")], "k int, v string")
    check_mergeable(t, dup_new, ["k"])  # new keys: inserted twice, no error
    null_dups = spark.createDataFrame([(None, "x"), (None, "y")], "k int, v string")
    check_mergeable(spark.createDataFrame([(None, "a")], "k int, v string"), null_dups, ["k"], null_safe=False)
    with pytest.raises(DuplicateKeyError):
        check_mergeable(spark.createDataFrame([(None, "a")], "k int, v string"), null_dups, ["k"], null_safe=True)


def test_incremental_bound():
    assert incremental_lower_bound(D(2024, 1, 20), D(2024, 1, 10)) == D(2024, 1, 2)
    assert incremental_lower_bound(D(2023, 12, 1), D(2024, 1, 10)) == D(2023, 12, 1)
    # order_date > least(max, as_of - 8)  <=>  order_date > max OR order_date >= as_of - 7
    for mx in range(0, 40):
        for od in range(0, 40):
            m, o, a = D(2024, 1, 1) + dt.timedelta(mx), D(2024, 1, 1) + dt.timedelta(od), D(2024, 1, 25)
            assert (o > incremental_lower_bound(m, a)) == (o > m or o >= a - dt.timedelta(7))


def test_partitioned_upsert_moves_rows_and_drops_emptied_partition(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    t = spark.createDataFrame([(1, D(2024, 1, 1), 10), (2, D(2024, 1, 1), 20), (3, D(2024, 1, 2), 30)],
                              "order_id bigint, order_date date, v int")
    store.upsert("o", t, ["order_id"], partition_by="order_date")
    s = spark.createDataFrame([(3, D(2024, 1, 5), 31), (4, D(2024, 1, 5), 40)], "order_id bigint, order_date date, v int")
    out = rows(store.upsert("o", s, ["order_id"], partition_by="order_date"), "order_id", "order_date", "v")
    assert out == [
        (1, D(2024, 1, 1), 10), (2, D(2024, 1, 1), 20), (3, D(2024, 1, 5), 31), (4, D(2024, 1, 5), 40)]
    # order 3 left 2024-01-02, which is now empty and removed; 2024-01-01 was not touched
    import os
    assert not os.path.exists(f"{tmp_dir}/silver/o/order_date=2024-01-02")
    pm = PartitionedMerge.plan(store.read("o"), s, ["order_id"], "order_date")
    assert sorted(pm.touched) == [D(2024, 1, 5)]
    # running the same source again changes nothing
    again = store.upsert("o", s, ["order_id"], partition_by="order_date")
    assert rows(again, "order_id", "order_date", "v") == out


def test_plain_table_upsert_and_bound(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    assert incremental_bound(store.read("x"), D(2024, 1, 10)) is None
    store.upsert("x", spark.createDataFrame([(1, D(2024, 1, 3))], "k int, order_date date"), ["k"])
    assert incremental_bound(store.read("x"), D(2024, 1, 10)) == D(2024, 1, 2)
    out = store.upsert("x", spark.createDataFrame([(1, D(2024, 1, 4)), (2, D(2024, 1, 4))], "k int, order_date date"), ["k"])
    assert rows(out) == [(1, D(2024, 1, 4)), (2, D(2024, 1, 4))]


def test_partitioned_upsert_with_new_column_rewrites_all_partitions(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    t = spark.createDataFrame([(1, D(2024, 1, 1), 10), (2, D(2024, 1, 2), 20)], "order_id bigint, order_date date, v int")
    store.upsert("o", t, ["order_id"], partition_by="order_date")
    s = spark.createDataFrame([(2, D(2024, 1, 2), 21, "x")], "order_id bigint, order_date date, v int, note string")
    out = store.upsert("o", s, ["order_id"], partition_by="order_date")
    assert rows(out, "order_id", "v", "note") == [(1, 10, None), (2, 21, "x")]


def test_merge_deletes_named_rows(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    s = spark.createDataFrame([(1, "new")], "k int, v string")
    gone = spark.createDataFrame([(3,)], "k int")
    assert rows(merge_rows(t, s, ["k"], deletes=gone)) == [(1, "new"), (2, "b")]


def test_merge_leaves_untouched_partitions_alone(spark, tmp_dir):
    import os
    store = TableStore(spark, tmp_dir)
    t = spark.createDataFrame([(i, D(2024, 1, 1 + i % 5), i) for i in range(20)], "order_id bigint, order_date date, v int")
    store.upsert("o", t, ["order_id"], partition_by="order_date")

    def files():
        return {d: sorted(os.listdir(f"{tmp_dir}/silver/o/{d}")) for d in os.listdir(f"{tmp_dir}/silver/o") if "=" in d}
    before = files()
    s = spark.createDataFrame([(0, D(2024, 1, 1), 100)], "order_id bigint, order_date date, v int")
    store.upsert("o", s, ["order_id"], partition_by="order_date")
    after = files()
    assert {d for d in before if before[d] != after[d]} == {"order_date=2024-01-01"}


def test_a_write_that_dies_leaves_the_old_table(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    store.overwrite("t", spark.createDataFrame([(1,)], "k int"))

    def dies(name):
        raise OSError("lost")
    store._switch = dies
    try:
        store.overwrite("t", spark.createDataFrame([(2,)], "k int"))
    except OSError:
        pass
    del store._switch
    assert rows(store.read("t")) == [(1,)]
    # died between the two renames: the reader finishes the switch
    store._rename(store.path("t"), store.path("t") + "__last")
    assert rows(store.read("t")) == [(2,)]


def test_only_a_missing_table_reads_as_none(spark, tmp_dir):
    import os
    import pytest as pt
    from pyspark.errors import AnalysisException
    store = TableStore(spark, tmp_dir)
    assert store.read("none") is None
    os.makedirs(store.path("empty"))
    with pt.raises(AnalysisException):
        store.read("empty")


def test_key_index_names_exactly_the_partitions_that_hold_keys(spark):
    import random

    from martlet.operators.keyindex import key_bitmaps, merged, partitions_holding

    rng = random.Random(6)
    far = [-70_000, -1, 0, 32_767, 32_768, 10 ** 12, -(10 ** 12), None]
    held = [(rng.choice(far) if rng.random() < 0.3 else rng.randrange(-100_000, 400_000),
             None if rng.random() < 0.1 else D(2024, 1, 1 + rng.randrange(9))) for _ in range(400)]
    t = spark.createDataFrame(held, "order_id bigint, order_date date")
    index = key_bitmaps(t, "order_id", "order_date")
    for _ in range(3):
        wanted = [(k,) for k in rng.sample([h[0] for h in held], 3)] + [(777_777,), (rng.choice(far),)]
        got = partitions_holding(index, spark.createDataFrame(wanted, "order_id bigint"), "order_id", "order_date")
        assert {r[0] for r in got.collect()} == {d for k, d in held if k in {w[0] for w in wanted}}
    both = merged(key_bitmaps(t.limit(150), "order_id", "order_date"), index, "order_date")
    assert rows(both) == rows(index.select("order_date", "block", "keys"))


def test_weekly_merge_reads_only_candidate_partitions(spark, tmp_dir):
    """A moved order is found, the scan is pruned, and the table equals a merge without index."""
    store, plain = TableStore(spark, tmp_dir), TableStore(spark, tmp_dir + "/plain")
    t = spark.createDataFrame([(i, D(2024, 1, 1 + i // 10), i) for i in range(200)], "order_id bigint, order_date date, v int")
    s = spark.createDataFrame([(35, D(2024, 2, 1), 1), (199, D(2024, 1, 20), 2), (500, D(2024, 2, 1), 3)], t.schema)
    for st in (store, plain):
        st.upsert("o", t, ["order_id"], "order_date")
    plain._delete(plain.path("o") + "__keys")
    assert plain.candidates("o", s, "order_id", "order_date") is None
    assert sorted(store.candidates("o", s, "order_id", "order_date")) == [D(2024, 1, 4), D(2024, 1, 20)]
    pm = PartitionedMerge.plan(store.read("o"), s, ["order_id"], "order_date",
                               candidates=store.candidates("o", s, "order_id", "order_date"))
    assert sorted(pm.touched) == [D(2024, 1, 4), D(2024, 1, 20), D(2024, 2, 1)]
    assert rows(store.upsert("o", s, ["order_id"], "order_date")) == rows(plain.upsert("o", s, ["order_id"], "order_date"))
    # the index follows: order 35 is found under its new day only, deletes are looked up as well
    again = s.where("order_id = 35")
    assert store.candidates("o", again, "order_id", "order_date") == [D(2024, 2, 1)]
    gone = spark.createDataFrame([(35,), (500,), (7,)], "order_id bigint")
    out = store.upsert("o", again.limit(0), ["order_id"], "order_date", deletes=gone)
    assert out.count() == 198 and sorted(store.last_touched["o"]) == [D(2024, 1, 1), D(2024, 2, 1)]
    assert store.candidates("o", gone, "order_id", "order_date") == []


def test_a_merge_that_dies_leaves_an_index_ahead_of_the_table(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    t = spark.createDataFrame([(1, D(2024, 1, 1), 1), (2, D(2024, 1, 2), 2)], "order_id bigint, order_date date, v int")
    store.upsert("o", t, ["order_id"], "order_date")
    s = spark.createDataFrame([(1, D(2024, 1, 2), 9)], t.schema)
    write = store._write_index
    calls = []

    def dies(*a):
        calls.append(a)
        if len(calls) == 2:  # after the partitions, before the old keys are taken off
            raise OSError("lost")
        write(*a)
    store._write_index = dies
    try:
        store.upsert("o", s, ["order_id"], "order_date")
    except OSError:
        pass
    store._write_index = write
    assert len(calls) == 2 and D(2024, 1, 2) in store.candidates("o", s, "order_id", "order_date")
    assert rows(store.upsert("o", s, ["order_id"], "order_date"), "order_id", "order_date", "v") == [
        (1, D(2024, 1, 2), 9), (2, D(2024, 1, 2), 2)]


def test_a_partition_that_the_index_does_not_know_may_hold_any_key(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    t = spark.createDataFrame([(1, D(2024, 1, 1), 1), (2, D(2024, 1, 2), 2)], "order_id bigint, order_date date, v int")
    store.upsert("o", t, ["order_id"], "order_date")
    store._delete(store.path("o") + "__keys/order_date=2024-01-02")
    wanted = spark.createDataFrame([(1,)], "order_id bigint")
    assert sorted(store.candidates("o", wanted, "order_id", "order_date")) == [D(2024, 1, 1), D(2024, 1, 2)]


def test_a_key_with_the_partition_column_needs_no_search(spark):
    t = spark.createDataFrame([(1, D(2024, 1, 1), 1)], "k int, order_date date, v int")
    s = spark.createDataFrame([(1, D(2024, 1, 2), 5)], t.schema)
    pm = PartitionedMerge.plan(t, s, ["k", "order_date"], "order_date")
    assert pm.touched == [D(2024, 1, 2)]
    assert rows(pm.full_result(t, "order_date")) == [(1, D(2024, 1, 1), 1), (1, D(2024, 1, 2), 5)]


def test_merge_of_tagged_rows_equals_the_join(spark):
    import random

    from pyspark.sql import functions as F

    from martlet.operators.upsert import merge_tagged

    rng = random.Random(1)
    data = [(rng.choice([1, 2, 3, 4, None]), rng.choice(["a", "b", None]), i, rng.random() < 0.4) for i in range(60)]
    t = spark.createDataFrame(data, "k int, c string, v int, new boolean").repartition(3)
    target, source = t.where("not new"), t.where("new")
    for null_safe in (True, False):
        got = merge_tagged(t, F.col("new"), ["k", "c"], null_safe)
        assert rows(got) == rows(merge_rows(target, source, ["k", "c"], null_safe))
