"""The page cap over several loads: any order of pages ends as the batch job does."""

import json
import os
import random

import pytest

from pricelens.plans import ingest, jobs, open_runs
from pricelens.sources import landed, store
from pricelens.streaming.incremental import close_runs, start_incremental_load

CAP = 4
LONG = 86_400


def line(run, keyword, page, n_items=2, at="2024-06-01T10:00:00Z"):
    items = [{"itemId": f"{run}-{keyword}-{page}-{i}", "name": "n", "price": "1", "itemUrl": "u"} for i in range(n_items)]
    return json.dumps({"run_id": run, "keyword": keyword, "page": page, "captured_at": at, "mods": {"listItems": items}})


def some_lines():
    """Gaps, empty pages, pages beyond the cap, odd numbers, NULL keys, repeated and broken lines."""
    out = [line("R1", "lamp", p) for p in (1, 2, 3, 4, 5, 6)]
    out += [line("R2", "lamp", p) for p in (1, 2, 4)] + [line("R2", "desk", 2)]
    out += [line("R3", "lamp", 1), line("R3", "lamp", 2, 0), line("R3", "lamp", 3)]
    out += [line(None, "lamp", 2), line(None, "lamp", 1), line("R4", None, 1), line("R4", None, None), line("R4", "lamp", 0)]
    out += [line("R1", "lamp", 2), line("R2", "lamp", 4), line("R5", "sofa", 1)]
    return out + ['{"run_id": "R1", "pa', line("R6", "lamp", 1, at="no time"), line("R6", "lamp", 2)]


def land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    (folder / name).write_text("".join(x + "\n" for x in lines))


def outcome(spark, warehouse):
    """Item ids that are in the warehouse, and pages left out with their reasons."""
    skipped = [r["tables"][store.SKIPPED_TABLE] for r in store.commits(spark, warehouse).values()]
    return (sorted(r.item_id for r in store.read_snapshots(spark, warehouse).collect()),
            sorted(map(str, spark.read.parquet(*skipped).collect())))


@pytest.mark.parametrize("seed, keywords", [(1, None), (2, ["lamp", "desk", ""])])
def test_any_order_over_several_triggers_equals_the_batch_job(spark, warehouse, tmp_path, seed, keywords):
    lines = some_lines()
    random.Random(seed).shuffle(lines)
    for k in range(4):
        land(tmp_path / "land", f"{k}.json", lines[k::4])
    args = (spark, str(tmp_path / "land"), warehouse, str(tmp_path / "ckpt"), keywords)
    start_incremental_load(*args, max_pages=CAP, max_files=1).awaitTermination(300)
    assert len(store.commits(spark, warehouse)) == 4
    close_runs(spark, warehouse, str(tmp_path / "ckpt"), CAP, keywords)
    batch = warehouse + "-batch"
    jobs.run(spark, str(tmp_path / "land"), batch, keywords, transforms=False, max_pages=CAP)
    assert outcome(spark, warehouse) == outcome(spark, batch)


def load(spark, warehouse, folder, load_id, resume, patience=LONG):
    return jobs.load_pages(spark, landed.read_pages(spark, folder), warehouse, None, CAP, load_id, resume=resume,
                           patience=patience)


def test_a_page_waits_is_kept_and_a_retry_starts_from_the_same_state(spark, warehouse, tmp_path):
    for name, lines in {"a": [line("R1", "lamp", 2), line("R1", "lamp", 4)], "b": [line("R1", "lamp", 1)],
                        "c": [line("R1", "lamp", 2)]}.items():
        land(tmp_path / name, "x.json", lines)
    first = load(spark, warehouse, str(tmp_path / "a"), "l-1", None)
    assert (first["appended"], first["held_items"], first["skipped_items"]) == (0, 4, 0)
    for _ in range(2):  # the second replaces the first
        second = load(spark, warehouse, str(tmp_path / "b"), "l-2", "l-1")
        assert (second["appended"], second["held_items"], second["skipped_items"]) == (4, 2, 0)
        assert store.row_count(spark, warehouse) == 4
    again = load(spark, warehouse, str(tmp_path / "c"), "l-3", "l-2")  # a page landed twice is kept twice
    assert (again["appended"], again["held_items"]) == (2, 2)


def test_closing_by_patience(spark, warehouse, tmp_path):
    land(tmp_path / "a", "x.json", [line("R1", "lamp", 1), line("R1", "lamp", 3)])
    land(tmp_path / "b", "x.json", [line("R2", "lamp", 1)])
    load(spark, warehouse, str(tmp_path / "a"), "l-1", None)
    second = load(spark, warehouse, str(tmp_path / "b"), "l-2", "l-1", patience=0)  # R1 had no page in this load
    assert (second["appended"], second["held_items"], second["skipped_items"]) == (2, 0, 2)
    skipped = spark.read.parquet(store.commits(spark, warehouse)["l-2"]["tables"][store.SKIPPED_TABLE]).collect()
    assert [(r.run_id, r.page, r.reason) for r in skipped] == [("R1", 3, ingest.AFTER_GAP)]
    _, progress = open_runs.left_by(spark, store.commits(spark, warehouse)["l-2"])
    assert [(r.run_id, r.reached) for r in progress.collect()] == [("R2", 1)]


def test_patience_needs_a_cap_and_closing_needs_a_finished_batch(spark, warehouse, tmp_path):
    land(tmp_path / "a", "x.json", [line("R1", "lamp", 2)])
    with pytest.raises(ValueError):
        jobs.load_pages(spark, landed.read_pages(spark, str(tmp_path / "a")), warehouse, patience=1)
    ckpt = str(tmp_path / "ckpt")
    start_incremental_load(spark, str(tmp_path / "a"), warehouse, ckpt, max_pages=CAP).awaitTermination(300)
    closed = [close_runs(spark, warehouse, ckpt, CAP) for _ in range(2)]  # the second finds nothing more
    assert [(r["skipped_items"], r["held_items"]) for r in closed] == [(2, 0), (0, 0)]
    os.remove(f"{ckpt}/commits/0")
    with pytest.raises(ValueError):
        close_runs(spark, warehouse, ckpt, CAP)
