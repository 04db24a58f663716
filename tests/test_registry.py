"""Every registered core query against its SQL, on the smallest tables."""

import datetime as dt

import duckdb
import pytest

from tidelake.plans import inputs, registry

SF = "/root/testdata/sf0.001"
#: Queries that rightly find nothing in the smallest tables.
EMPTY: set[str] = set()

def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)


def value(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v


def rows(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(value(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in inputs.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(registry.ORACLE_SQL[name])
    want = rows([d[0] for d in found.description], found.fetchall())
    df = registry.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(d[0] for d in found.description)
    assert rows(df.columns, df.collect()) == want
    assert want or name in EMPTY


def test_streams_go_on_after_a_restart(spark, tmp_path):
    from tidelake.streaming import streams

    source, table = str(tmp_path / "in"), streams.Snapshot(spark, str(tmp_path / "out"))
    merge = lambda old, batch: batch if old is None else old.unionByName(batch)
    for part in (range(3), range(3, 5)):
        spark.createDataFrame([(i,) for i in part], "n long").coalesce(1).write.mode("append").parquet(source)
        stream = streams.read_table_stream(spark, source, "n long")
        streams.foreach_batch_sink(stream, table.merging(merge), str(tmp_path / "ck"), f"q{part.start}").awaitTermination()
    assert sorted(r.n for r in table.read().collect()) == [0, 1, 2, 3, 4]


def test_late_pings_are_split_from_the_batch(spark):
    from tidelake.streaming import streams

    at = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(1, at), (2, at - dt.timedelta(hours=6))], "n int, event_ts timestamp")
    good, late = streams.split_late(df, at)
    assert ([r.n for r in good.collect()], [r.n for r in late.collect()]) == ([1], [2])
    assert streams.split_late(df, None)[0].count() == 2


def test_state_as_of_a_step_takes_all_orders(spark):
    test_query_equals_its_sql(spark, "state_as_of_step")
    found = {r.order_id: r.lsn for r in registry.QUERIES["state_as_of_step"](spark, SF).collect()}
    last = {r.order_id: r.lsn for r in registry.order_rows(spark, SF).groupBy("order_id").max("lsn").toDF("order_id", "lsn").collect()}
    assert found.keys() == last.keys()
    assert sum(found[k] < last[k] for k in last) > len(last) / 4


@pytest.mark.parametrize("name, joins", [("fact_order_item", 2), ("assert_line_totals", 2)])
def test_order_lines_are_written_once_and_joined_once(spark, monkeypatch, name, joins):
    """Of all that the lines come from only the items and the heads of the orders are stored.  Lines meet the menu without a join: one is
    that with the orders, the other is within the log of the menu, or that of sums and orders, which need no menu."""
    from tidelake.sources import tables

    paths, where = [], tables.scratch_dir
    monkeypatch.setattr(tables, "scratch_dir", lambda spark: paths.append(where(spark)) or paths[-1])
    df = registry.QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(paths) == 2 and plan.count("Join ") == joins


def test_newest_changes_by_a_key_beside_the_image(spark):
    """As those by the key inside it."""
    from tidelake.operators import decode
    from tidelake.plans import spec

    log = registry.change_log(spark, SF, "order_changes", spec.ORDERS, key="order_id")
    beside, inside = decode.latest_changes(log, spec.ORDERS, key="pk"), decode.latest_changes(log.drop("pk"), spec.ORDERS)
    assert beside.columns == inside.columns and sorted(map(str, beside.collect())) == sorted(map(str, inside.collect()))
