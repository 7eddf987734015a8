"""Conversation repair: against a plain search over all edits."""

import random
from collections import defaultdict

import brute
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm import conversations, queries

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def expected(rows):
    """rows: (conv_id, turn, role, text) -> {conv_id: columns}."""
    held = defaultdict(list)
    for r in rows:
        held[r[0]] += brute.damaged(*r)
    by = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {k: brute.repair(sorted(v, key=by)) for k, v in held.items()}


def found(df):
    out = {r[0]: tuple(r)[1:] for r in df.collect()}
    assert df.count() == len(out)
    return out


def chat(rng, n, conv):
    roles = ["system", "user", "assistant", "user", "assistant", "other", "Usher", "", None]
    texts = ["Yes.", "no", "Why?  ", "", " \t", None, "a\nb!", "x" * 70 + ".", "x" * 70 + "!", "ok. then"]
    return [(conv, rng.choice([i, i, i, i // 2, None]), rng.choice(roles), rng.choice(texts) if rng.random() < .5 else f"t{i}.")
            for i in range(n)]


def test_solver_equals_the_search_over_all_edits():
    rng = random.Random(3)
    for _ in range(1500):
        rows = [(i, rng.choice(["system", "user", "assistant", "other", ""]), rng.choice(["a.", "b", "c!", "", "  ", "d?"]))
                for i in range(rng.randint(0, 9))]
        want, seen = brute.repair(rows), []
        is_seen = lambda *r: r in seen or seen.append(r)
        codes, *counts = conversations._judge([r[1:] for r in rows], lambda *r: bool(is_seen(*r)))
        audit, cost, _ = conversations.solve(codes)
        assert (*counts, cost, audit) == (*want[1:4], *want[5:7])


def test_blocks_of_a_walk_join_to_the_whole():
    rng = random.Random(5)
    for _ in range(300):
        codes = bytes(rng.choice([0, 1, 2, 3, 5, 6, 8]) for _ in range(rng.randint(1, 60)))
        cut = rng.randint(0, len(codes))
        middle = conversations.start_costs(codes[cut:], conversations.LAST)
        a, cost_a, state = conversations.solve(codes[:cut], 0, middle, False)
        b, cost_b, _ = conversations.solve(codes[cut:], state)
        assert (a + b, cost_a + cost_b) == conversations.solve(codes)[:2]


@pytest.mark.parametrize("block_rows", [conversations.BLOCK_ROWS, 3])
def test_equals_brute_force(spark, block_rows):
    rng = random.Random(11)
    rows = [r for c in range(60) for r in chat(rng, rng.randint(1, 12), c)]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), *rows[:20]]
    df = spark.createDataFrame(rows, ROWS).withColumn("key", F.lit("x")).withColumn("audit", F.lit(1)).repartition(3)
    pieces = conversations.repair(conversations.damaged(df), block_rows)
    assert found(conversations.summaries(pieces)) == expected(rows)


def test_a_conversation_that_holds_most_rows(spark):
    """It is cut over tasks and blocks; also one whose rows are all alike."""
    rng = random.Random(13)
    rows = [(7, i, rng.choice(["user", "assistant"]), f"t{i % 150}{rng.choice(['.', ''])}") for i in range(600)]
    rows += [(8, 1, "user", "Again.")] * 300 + [r for c in range(9, 30) for r in chat(rng, 5, c)]
    pieces = conversations.repair(conversations.damaged(spark.createDataFrame(rows, ROWS).repartition(4)), 50)
    assert pieces.filter("conv_id = 7").count() > 10 and pieces.filter("whole").count() > 10
    assert found(conversations.summaries(pieces)) == expected(rows)
    turns = pieces.filter("conv_id = 7").orderBy("piece").collect()
    roles = [t.role[0] for p in turns for t in p.turns]
    assert roles == ["u", "a"] * (len(roles) // 2)


def test_a_very_long_text(spark):
    rows = [(1, 1, "user", "word " * 500_000 + "."), (1, 2, "assistant", "Yes."), (2, 1, "user", "x" * 100_000)]
    pieces = conversations.repair(conversations.damaged(spark.createDataFrame(rows, ROWS)))
    assert found(conversations.summaries(pieces)) == expected(rows)


def test_nothing_left_and_empty_table(spark):
    lost = [(c, 1, "user", "Hi.") for c in range(400) if not brute.damaged(c, 1, "user", "Hi.")]
    out = found(conversations.summaries(conversations.repair(conversations.damaged(spark.createDataFrame(lost, ROWS)))))
    assert len(out) == len(lost) > 5 and set(out.values()) == {(0, 0, 0, 0, 0, 0, "", brute.sha(""))}
    empty = conversations.repair(conversations.damaged(spark.createDataFrame([], ROWS)))
    assert conversations.summaries(empty).count() == 0


def test_op11_on_the_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select(*ROWS.names).collect()]
    out = queries.op11_conversation_repair(spark, sf_dir)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found(out) == expected(rows)
