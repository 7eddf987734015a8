"""Ranked search: against scores computed document by document, and its SQL."""

import random

import brute
import duckdb
import pytest
from pyspark.sql import types as T

from pricelens.llm import lexical, oracle, queries

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def found(df):
    return {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in df.collect()}


def corpus(n=600):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(200)] + ["Été", "été", "漢字", "x-y", "A_B", "\x00z", "ｗide", "42"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [" ".join(rng.choices(words, weights, k=rng.choice([0, 3, 20, 200]))) for _ in range(n)]
    items = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(25)]
    return docs, items + ["w0 w0 w1", "none of these", "", "W0 W199"]


@pytest.mark.parametrize("shard_docs, share, block", [(37, 16, 1 << 20), (50, 4, 300), (8192, 16, 1 << 20), (64, 10**9, 900)])
def test_equals_the_plain_scores(spark, documents, monkeypatch, shard_docs, share, block):
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(lexical, "SHORT_SHARE", share)
    docs, items = corpus()
    out = lexical.ranked_search(documents(docs, ("score", "rank", "row")).repartition(2),
                                spark.createDataFrame(list(enumerate(items)), ITEMS), top=7, block_bytes=block)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(out) == brute.ranked(list(enumerate(docs)), list(enumerate(items)), top=7)


def test_search_of_a_shard_keeps_all_at_the_threshold():
    """Skipping never loses a document whose score reaches the floor."""
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(40):
        n_docs, n_terms = 60, 12
        held = rng.random((n_terms, n_docs)) < rng.choice([0.03, 0.2, 0.9], (n_terms, 1))
        held[:, 0] = True
        owners = [np.nonzero(h)[0].astype(np.int32) for h in held]
        tf = [rng.integers(1, 9, len(o)).astype(np.int32) for o in owners]
        row = {"docs": list(range(n_docs)), "terms": list(range(n_terms)), "sizes": [len(o) for o in owners],
               "owners": np.concatenate(owners).tobytes(), "tfs": np.concatenate(tf).tobytes(),
               "lengths": rng.integers(10, 90, n_docs).tobytes()}
        shard = lexical.Shard(row, rng.integers(0, 5000, n_terms), n_docs, 50 * n_docs)
        query = np.sort(rng.choice(n_terms, 6, replace=False))
        live, score = shard.search(query, 1)
        whole = dict(zip(live.tolist(), score.tolist()))
        plain = np.zeros(n_docs, np.int64)
        for t in query.tolist():
            docs, adds = shard.postings(int(shard.slot[t]))
            plain[docs] += adds
        assert whole == {d: s for d, s in enumerate(plain.tolist()) if s > 0}
        for floor in sorted(whole.values())[::7]:
            live, score = shard.search(query, floor)
            assert dict(zip(live.tolist(), score.tolist())) == {d: s for d, s in whole.items() if s >= floor}


def test_nulls_ties_and_repeats(spark, documents):
    docs = [("same words", None, None, 5), ("same words", None, None, 3), ("same words", None, None, None),
            ("same words", None, None, 3), (None, None, None, 9), ("other", None, None, 1), ("more", None, None, 2)]
    items = spark.createDataFrame([(1, "same"), (1, "same"), (1, "other"), (None, "words"), (4, None)], ITEMS)
    rows = lexical.ranked_search(documents(docs), items).orderBy("item_id", "rank", "doc_id").collect()
    same = [(r["rank"], r.doc_id) for r in rows if r.item_id is None]
    assert same == [(1, 3), (2, 3), (3, 5), (4, None)]
    assert sorted((r["rank"], r.doc_id) for r in rows if r.item_id == 1) == [(1, 1), (1, 3), (2, 3), (3, 5), (4, None)]
    assert not [r for r in rows if r.item_id == 4]


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "same")], ITEMS)
    assert lexical.ranked_search(documents([]), items).count() == 0
    assert lexical.ranked_search(documents(["same"]), items.limit(0)).count() == 0
    assert lexical.ranked_search(documents([None, "", " - "]), items).count() == 0


def test_op12_equals_its_sql_and_the_plain_scores(spark, sf_dir):
    got = found(queries.op12_lexical_search(spark, sf_dir))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rows = con.execute(oracle.ORACLE["op12_lexical_search"]).fetchall()
    assert got == {(i, r): (d, s) for i, r, d, s in rows} and got
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    assert got == brute.ranked(docs, con.execute("SELECT item_id, text FROM benchmark").fetchall())
