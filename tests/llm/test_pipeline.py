"""The pipeline's stages, each on its own input, and the registered queries."""

import random
from pathlib import Path

import brute
import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F
from test_simhash import expected as simhash_expected
from test_texts import plain_lines

import __spark_entry__ as entry
from pricelens.llm.common import scratch_tables, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGES = dict(corpus_pipeline.STAGES)


def made_up(documents, extra=()):
    rng = random.Random(8)
    en, de = "the cat and dog of house on hill".split(), "der die und das ist nicht mit Haus".split()
    rows = []
    for i in range(120):
        words, lang = (en, "en") if i % 3 else (de, "de")
        lines = [" ".join(rng.choice(words) + rng.choice(["", "s", "er"]) for _ in range(9)) for _ in range(3)]
        rows.append(("\n".join(lines + ["Home | About"] * (i % 2)), lang, rng.choice(["a", "a", "b", None])))
    rows += [rows[4]] * 5 + [(None, "en", "a"), ("", None, "b"), ("12 34", "en", "a"), ("Home | About", "en", "b"),
                             (rows[7][0].replace("cat", "hat", 1), "en", "c")]
    return documents(rows, extra), rows


def rows_of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


def test_stage_names_and_columns(spark, documents):
    assert [n.split("_")[0] for n in STAGES] == ["language", "line", "simhash", "source", "bpe"]
    df, _ = made_up(documents, ("id", "row", "score"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, None).columns == df.columns
        assert stage(spark, df.limit(0), None).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, df, None)
    assert last.columns == df.columns + ["n_tokens", "ids", "round_trip"]


def test_staged_tables_of_a_scope_are_deleted(spark):
    outside = staged(spark.range(3), "outside")
    with scratch_tables(spark):
        gone = staged(spark.range(5), "inside")
        path = gone.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        lasting = staged(gone.filter("id > 1"), "result", lasting=True)
        assert Path(path).exists()
    assert not Path(path).exists()
    assert lasting.count() == 3 and outside.count() == 3
    with pytest.raises(ValueError), scratch_tables(spark):
        path = staged(spark.range(2), "failed").inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        raise ValueError
    assert not Path(path).exists()


def test_language_stage_keeps_clean_documents(spark, documents):
    df, rows = made_up(documents)
    kept = {r.doc_id for r in STAGES["language_id"](spark, df, None).collect()}
    assert kept == set(range(len(rows))) - {125, 126, 127}  # no text, or no letter


def test_line_stage(spark, documents):
    df, rows = made_up(documents)
    out = STAGES["line_dedup"](spark, df, None).collect()
    got = {r.doc_id: r.text for r in out}
    assert all(r.n_chars == len(r.text or "") for r in out)
    want = {i: k for i, (_, d, k) in enumerate(plain_lines([r[0] for r in rows])) if not d or brute.WORD.search(k)}
    assert {i: t or "" for i, t in got.items()} == want


def test_simhash_stage_keeps_one_of_each_group(spark, documents):
    df, rows = made_up(documents)
    want = simhash_expected({i: r[0] for i, r in enumerate(rows)})
    got = [r.doc_id for r in STAGES["simhash_near_dedup"](spark, df.unionAll(df), None).collect()]
    assert sorted(got) == [i for i, (_, c) in want.items() if c == i]
    no_ids = documents([("a b c", None, None, None), ("a b c", None, None, None), ("x y z w", None, None, None)])
    assert sorted(r.text for r in STAGES["simhash_near_dedup"](spark, no_ids, None).collect()) == ["a b c", "x y z w"]


def test_mixing_stage_repeats_documents(spark, documents):
    from pricelens.llm import mixing

    df, rows = made_up(documents)
    copies = {r.id: r.copies for r in mixing.mix_copies(df).collect()}
    got = [r.doc_id for r in STAGES["source_mixing"](spark, df, None).collect()]
    assert {i: got.count(i) for i in copies} == copies


def test_mixing_stage_writes_shuffled_shards(spark, documents):
    from pricelens.llm import mixing

    df, _ = made_up(documents)
    place = {(r.row.doc_id, r["copy"]): (r.shard, r.order_key) for r in mixing.mix(df).collect()}
    files = {}
    for r in staged(STAGES["source_mixing"](spark, df, None), "mix-test").select("doc_id", F.input_file_name().alias("f")).collect():
        files.setdefault(r.f, []).append(r.doc_id)
    shards = {s: sorted((k, i) for (i, _), (t, k) in place.items() if t == s) for s, _ in place.values()}
    assert sorted(files.values()) == sorted([i for _, i in keys] for keys in shards.values()) and len(shards) > 8


def test_the_whole_pipeline_equals_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert whole.count() == docs.count() > 0
    assert whole.filter("NOT round_trip OR n_tokens <> size(ids)").isEmpty()
    assert rows_of(whole) == rows_of(docs)


def test_queries_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert names["pipeline"] is corpus_pipeline.run
    assert {"op2_line_dedup", "op10_source_mixing"} <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.LLM_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(entry.LLM_SQL[name])
    columns = sorted(d[0] for d in result.description)
    want = result.df()[columns].sort_values(columns).reset_index(drop=True)
    got = entry.LLM_QUERIES[name](spark, sf_dir).toPandas()
    assert sorted(got.columns) == columns
    got = got[columns].sort_values(columns).reset_index(drop=True)
    assert got.astype(str).equals(want.astype(str))
