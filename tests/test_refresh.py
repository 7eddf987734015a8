"""Loads that commit as one, marts rebuilt by touched days and published after their checks."""

import datetime as dt
import json
import os
import random

import pytest
from helpers import T0, item, page_doc, pages_df, snapshot, snapshots_df

from pricelens.operators.ordered import number_rows
from pricelens.plans import ingest, jobs, marts, quality
from pricelens.sources import landed, store
from pricelens.streaming.incremental import start_incremental_load

MARTS = ["price_history", "price_movers", "category_summary", "daily_deals", "price_carry", "item_days"]


def captured(rng, day, items, n):
    """Snapshots of one day; items, prices, times and keywords may coincide."""
    out = []
    for _ in range(n):
        i, price = rng.choice(items), rng.choice(["0", "90", "100", "100", "110.50", "180"])
        out.append(snapshot(item_id=f"SKU-{i}", price=price, original="200", discount=55.0, reviews=60 + i,
                            category=rng.choice(["Lighting", None]), keyword=rng.choice(["lamp", "desk"]),
                            at=T0 + dt.timedelta(days=day, minutes=rng.randint(0, 5)), page=rng.randint(1, 2)))
    return out


def rows_of(df):
    return sorted(map(str, df.collect()))


def same_as_full(spark, warehouse, tmp_path, loads):
    """Every mart equals one built from scratch over the same snapshots."""
    fresh = str(tmp_path / f"fresh-{random.random()}")
    store.append_snapshots(snapshots_df(spark, [r for rows in loads for r in rows]), fresh)
    jobs.transform(spark, fresh)
    for name in MARTS:
        assert rows_of(store.read_mart(spark, warehouse, name)) == rows_of(store.read_mart(spark, fresh, name)), name
    assert store.read_mart(spark, fresh, "price_history").count() > 0


def versions(spark, warehouse, name="price_history"):
    return store.published(spark, warehouse)["marts"][name]


def test_late_loads_equal_a_full_rebuild(spark, warehouse, tmp_path):
    rng = random.Random(1)
    loads = [[r for d in (0, 1, 3, 6, 9) for r in captured(rng, d, range(6), 12)],
             captured(rng, 2, [1, 2, 8], 6),  # a new day between others, a new item
             captured(rng, 0, [3], 2) + captured(rng, 12, [1, 9], 4),  # an old day and a new last one
             captured(rng, 3, range(6), 5)]
    for k, rows in enumerate(loads):
        store.append_snapshots(snapshots_df(spark, rows), warehouse, f"load-{k}")
        report = jobs.transform(spark, warehouse)
        assert len(report) == 29 and not any(r.failures for r in report)
        same_as_full(spark, warehouse, tmp_path, loads[:k + 1])


def test_only_touched_days_and_followers_are_rebuilt(spark, warehouse):
    day = lambda d: str((T0 + dt.timedelta(days=d)).date())
    first = [snapshot(item_id=f"SKU-{i}", price=str(100 + d), at=T0 + dt.timedelta(days=d))
             for i, days in enumerate([(0, 4), (0, 5, 8), (1, 2, 7)]) for d in days]
    store.append_snapshots(snapshots_df(spark, first), warehouse, "a")
    jobs.transform(spark, warehouse)
    assert set(versions(spark, warehouse).values()) == {1}
    late = snapshot(item_id="SKU-1", price="50", at=T0 + dt.timedelta(days=2))  # its next day is 5
    store.append_snapshots(snapshots_df(spark, [late]), warehouse, "b")
    jobs.transform(spark, warehouse)
    rebuilt = {d for d, v in versions(spark, warehouse).items() if v == 2}
    assert rebuilt == {day(2), day(5)}
    assert {d for d, v in versions(spark, warehouse, "category_summary").items() if v == 2} == {day(2)}
    # the same close again: no other day has a new first row
    same = snapshot(item_id="SKU-1", price="50", at=T0 + dt.timedelta(days=2, minutes=9))
    store.append_snapshots(snapshots_df(spark, [same]), warehouse, "c")
    jobs.transform(spark, warehouse)
    assert {d for d, v in versions(spark, warehouse).items() if v == 3} == {day(2)}
    # the files of those days alone are read
    files = store.read_snapshots(spark, warehouse, [day(2)])
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "snapshot_day" in plan.partition("PartitionFilters")[2][:120]
    before = store.published(spark, warehouse)
    jobs.transform(spark, warehouse)  # nothing new: nothing is written
    assert store.published(spark, warehouse) == before


def test_replaced_load_is_rebuilt(spark, warehouse, tmp_path):
    rng = random.Random(2)
    a, b = ([r for d in (0, 2, 5) for r in captured(rng, d, range(4), 8)] for _ in range(2))
    late, fewer = captured(rng, 1, range(4), 6) + captured(rng, 3, range(4), 6), captured(rng, 3, range(3), 4)
    store.append_snapshots(snapshots_df(spark, a + b), warehouse, "a")
    store.append_snapshots(snapshots_df(spark, late), warehouse, "late")
    jobs.transform(spark, warehouse)
    store.append_snapshots(snapshots_df(spark, fewer), warehouse, "late")  # retried, without day 1
    jobs.transform(spark, warehouse)
    same_as_full(spark, warehouse, tmp_path, [a, b, fewer])
    store.append_snapshots(snapshots_df(spark, []), warehouse, "late")  # and once more, with nothing
    jobs.transform(spark, warehouse)
    same_as_full(spark, warehouse, tmp_path, [a, b])


def test_status_and_latest_are_kept_up_to_date(spark, warehouse):
    """Before and after a refresh, also where a load was replaced; published days are not read again."""
    rng = random.Random(5)
    loads = {"a": [r for d in (0, 2, 5) for r in captured(rng, d, range(4), 9)], "b": captured(rng, 2, [4, 9], 5)}

    def check():
        snap = store.read_snapshots(spark, warehouse)
        assert rows_of(jobs.status(spark, warehouse)) == rows_of(marts.status(snap))
        assert rows_of(jobs.latest_snapshot(spark, warehouse)) == rows_of(marts.latest_snapshot(snap))

    check()
    for load_id, rows in [*loads.items(), ("b", loads["b"][:1]), ("b", [])]:
        store.append_snapshots(snapshots_df(spark, rows), warehouse, load_id)
        check()
        jobs.transform(spark, warehouse)
        check()
        for df in (jobs.status(spark, warehouse), jobs.latest_snapshot(spark, warehouse)):
            assert df.inputFiles() and not any("/raw/" in f for f in df.inputFiles())


def test_history_of_days_splits_a_hot_item(spark):
    from pricelens.plans import refresh

    rng = random.Random(3)
    rows = [r for d in (0, 1, 4) for r in captured(rng, d, [1, 1, 1, 2], 60)]
    stg = marts.stg_prices(snapshots_df(spark, rows))
    carry = refresh.chained(refresh.closes(stg))
    want = rows_of(marts.price_history(stg))
    assert rows_of(refresh.history(stg, carry)) == want
    assert rows_of(refresh.history(stg, carry, num_parts=8, min_rows=1)) == want


def test_a_failing_check_publishes_nothing(spark, warehouse, monkeypatch):
    store.append_snapshots(snapshots_df(spark, [snapshot()]), warehouse, "a")
    jobs.transform(spark, warehouse)
    store.append_snapshots(snapshots_df(spark, [snapshot(item_id="SKU-8")]), warehouse, "b")
    good = marts.price_history(marts.stg_prices(store.read_snapshots(spark, warehouse)))
    monkeypatch.setitem(quality.RULES["price_history"], "not_null", ["item_id", "prev_price"])  # fails on a first price
    with pytest.raises(quality.QualityError):
        jobs.transform(spark, warehouse)
    assert store.read_mart(spark, warehouse, "price_history").count() == 1
    monkeypatch.undo()
    jobs.transform(spark, warehouse)
    assert rows_of(store.read_mart(spark, warehouse, "price_history")) == rows_of(good)


def test_a_load_that_stops_midway_is_invisible(spark, warehouse):
    load = store.Load(spark, warehouse, "a")
    load.append(snapshots_df(spark, [snapshot()]))
    assert store.row_count(spark, warehouse) == 0 and jobs.transform(spark, warehouse)
    store.append_snapshots(snapshots_df(spark, [snapshot(), snapshot(item_id="SKU-8")]), warehouse, "a")
    assert store.row_count(spark, warehouse) == 2


def test_a_load_belongs_to_its_writer(spark, warehouse):
    load = store.Load(spark, warehouse, "a", owner="stream-1")
    load.append(snapshots_df(spark, [snapshot()]))
    load.commit()
    for owner in ("", "stream-2"):
        with pytest.raises(ValueError):
            store.Load(spark, warehouse, "a", owner)
    with pytest.raises(ValueError):
        store.Load(spark, warehouse, "../a")
    assert store.row_count(spark, warehouse) == 1


def page(p, **other):
    return {"run_id": "R1", "keyword": "lamp", "page": p, "captured_at": "2024-06-01T10:00:00Z",
            "mods": {"listItems": [{"itemId": f"A{p}{k}", "name": "n", "price": "1", "itemUrl": "u"} for k in range(p)]}} | other


def landing(tmp_path, name, lines):
    folder = tmp_path / name
    os.makedirs(folder, exist_ok=True)
    (folder / "a.json").write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))
    return str(folder)


def test_two_streams_keep_all_rows(spark, warehouse, tmp_path):
    for k in (1, 2):
        folder = landing(tmp_path, f"land-{k}", [page(k)])
        for _ in range(2):  # a restart finds nothing new
            start_incremental_load(spark, folder, warehouse, str(tmp_path / f"ckpt-{k}")).awaitTermination(180)
    ids = {r.item_id for r in store.read_snapshots(spark, warehouse).collect()}
    assert ids == {"A10", "A20", "A21"} and store.row_count(spark, warehouse) == 3
    assert len({r["owner"] for r in store.commits(spark, warehouse).values()}) == 2


@pytest.mark.parametrize("bad", [page(2, captured_at="not a time"), page(2, page="two"), '{"run_id": "R1", "pa'])
def test_accounts_with_a_bad_line_and_a_cap(spark, warehouse, tmp_path, bad):
    """A malformed page is missing: what follows it is beyond the prefix, with or without more broken lines."""
    folder = landing(tmp_path, "land", [page(1), bad, page(3), page(4), "{", page(5, mods=None)])
    cut = jobs.run(spark, folder, warehouse, ["lamp"], transforms=False, max_pages=3, load_id="cut")
    assert (cut["appended"], cut["rejected"], cut["skipped_items"], cut["malformed_pages"]) == (1, 0, 7, 2)
    folders = store.commits(spark, warehouse)["cut"]["tables"]
    skipped = spark.read.parquet(folders[store.SKIPPED_TABLE]).collect()
    assert sorted((r.page, r.reason) for r in skipped) == [(3, "after a missing page"), (4, "beyond the page cap")]
    assert spark.read.parquet(folders[store.MALFORMED_TABLE]).count() == 2
    fates = {r["fate"]: r["count"] for r in spark.read.parquet(folders[store.PAGES_TABLE]).groupBy("fate").count().collect()}
    assert fates == {landed.FULL: 3, landed.EMPTY: 1, landed.MALFORMED: 2}
    whole = jobs.run(spark, folder, warehouse + "-2", transforms=False)
    assert (whole["appended"], whole["skipped_items"], whole["malformed_pages"]) == (8, 0, 2)


def test_a_malformed_page_is_missing_from_the_prefix(spark):
    docs = pages_df(spark, [page_doc("R1", "tv", p, [item(itemId="x")]) for p in (1, 3)])
    assert [r.reason for r in ingest.page_fates(docs, None, 3).orderBy("page").collect()] == [None, "after a missing page"]


def test_number_rows(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    from pyspark.sql import functions as F

    out = number_rows(df, [F.col("a").desc(), F.col("b").asc()])
    want = {r: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), 1)}
    assert {(r.a, r.b): r.position for r in out.collect()} == want
    assert number_rows(df.limit(0), [F.col("a").desc()]).count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "Aggregate" in plan.partition("Window")[2]  # over one row a partition
