"""Lines, mixing, language, secrets, quality: edge rows, and queries against brute force."""

import collections
import hashlib
import random
import time

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import langid, lines, mixing, quality, queries, secrets

CLASH = ("row", "id", "h", "n_lines", "drop", "kept", "size", "copies", "base", "w", "t", "score", "shard", "ids")


def plain_lines(texts, min_docs=10):
    keys = [[x.strip(brute.SPACE).translate({c: c + 32 for c in range(65, 91)}) for x in (t or "").split("\n")] for t in texts]
    seen = {}
    for own in keys:
        for k in set(own):
            seen[k] = seen.get(k, 0) + 1
    out = []
    for t, own in zip(texts, keys):
        kept = [x for x, k in zip((t or "").split("\n"), own) if not k or seen[k] < min_docs]
        out.append((len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup_against_brute_force(spark, documents):
    rng = random.Random(2)
    pool = ["Menu", " menu\t", "MENU", "É", "é", "", "  ", "a b", "\x0bx\x0c", "\x85", "z" * 300]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(0, 6))) for _ in range(60)] + [None, "", "\n" * 50]
    texts += ["line\n" * 20000 + "own"] + ["line"] * 9
    got = {r.row.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in lines.line_dedup(documents(texts, CLASH)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_lines(texts)
    assert lines.line_dedup(documents([])).count() == 0


def test_line_dedup_null_and_repeated_ids(spark, documents):
    rows = [("x\ny%d" % i, None, None, None if i % 2 else 7) for i in range(12)]
    got = lines.line_dedup(documents(rows)).collect()
    assert sorted(r.kept_text for r in got) == sorted(f"y{i}" for i in range(12))
    assert {r.n_dropped for r in got} == {1}


def mixed(df, **kw):
    return {r.id: (r.size, r.source_size, r.target, r.copies) for r in mixing.mix_copies(df, **kw).collect()}


def test_mixing_targets(spark):
    sizes = {"a": 1000, "b": 100, "c": 10, "d": 500, None: 390}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    weight = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}
    free, total, want = set(sizes), sum(sizes.values()), {}
    while True:  # cut and share again until none is above
        rest = total - sum(want.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            break
        want |= {s: 3.0 * sizes[s] for s in over}
        free -= set(over)
    assert got == pytest.approx(want | share) and sum(got.values()) == pytest.approx(total)


def test_mixing_takes_near_the_target_and_agrees_with_itself(spark, documents):
    rng = random.Random(3)
    rows = [("w " * rng.randint(0, 40), None, rng.choice(["a", "a", "a", "b", "c", "", None])) for _ in range(3000)]
    df = documents(rows, CLASH)
    got = mixed(df)
    by = {}
    for i, (size, source_size, target, copies) in got.items():
        own = by.setdefault(rows[i][2], [0, target, source_size])
        own[0] += size * copies
        assert 0 <= copies <= 3 and size == rows[i][0].count("w")
    for taken, target, source_size in by.values():
        assert taken <= 3 * source_size and abs(taken - target) <= 40
    assert mixed(df.repartition(7)) == got
    placed = mixing.mix(df, shards=5).collect()
    copies = {}
    for r in placed:
        copies[r.row.doc_id] = copies.get(r.row.doc_id, 0) + 1
    assert copies == {i: c[3] for i, c in got.items() if c[3]}
    assert {r.shard for r in placed} == set(range(5))


def test_mixed_rows_lie_in_shuffled_shards(spark, documents):
    rng = random.Random(4)
    rows = [("w " * rng.randint(1, 9) + str(i), None, rng.choice(["a", "b", "c"]), i if i % 3 else None) for i in range(600)]
    for shards, ranges in ((2, 2), (5, 1)):  # four shuffle partitions
        placed = mixing.mix(documents(rows), shards=shards).withColumn("part", F.spark_partition_id()).collect()
        own = {}
        for r in placed:
            own.setdefault(r.part, []).append((r.shard, r.order_key))
        assert len(own) == shards * ranges and {r.shard for r in placed} == set(range(shards))
        assert all(len({s for s, _ in keys}) == 1 for keys in own.values())
        assert sum((own[p] for p in sorted(own)), []) == sorted((r.shard, r.order_key) for r in placed)


def test_mixing_query_counts_rows_dealt_by_the_tree(spark, sf_dir, monkeypatch):
    calls, tree = [], mixing.splitting_tree
    monkeypatch.setattr(mixing, "splitting_tree", lambda *a: calls.append(tree(*a)) or calls[-1])
    got = queries.op10_source_mixing(spark, sf_dir).collect()
    assert len(calls) == 1 and calls[0].shape[1] == mixing.SHARDS and calls[0].all()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    size = {r.doc_id: r.size for r in got}
    taken = dict.fromkeys(size, 0)
    for r in mixing.mix(docs).select("row.doc_id").collect():
        taken[r.doc_id] += size[r.doc_id]
    assert {r.doc_id: r.taken for r in got} == taken


def test_mixing_edges(spark, documents):
    assert mixed(documents([])) == {}
    assert mixed(documents([(None, None, "a"), ("", None, None)])) == {0: (0, 0, 0.0, 0), 1: (0, 0, 0.0, 0)}
    assert mixed(documents([("one", None, None)])) == {0: (1, 1, 1.0, 1)}
    repeated = documents([("a b", None, "s", 4), ("a b", None, "s", 4), ("a b c", None, "t", None)])
    assert len(mixing.mix_copies(repeated).collect()) == 3


def test_splitting_tree_is_exact():
    quotas = np.array([0, 1, 7, 4096, 12000])
    for shards in (1, 2, 7, 16):
        dealt = mixing.splitting_tree(quotas, shards, 1)
        assert (dealt.sum(axis=1) == quotas).all() and (dealt >= 0).all()
        assert abs(dealt.sum(axis=0) - quotas.sum() / shards).max() <= shards
    assert mixing.splitting_tree(np.zeros(0, np.int64), 4, 1).shape == (0, 4)


def test_language_edges(spark, documents):
    rows = [("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 30
    rows += [(None, "en"), ("", "de"), ("123 !?", "en"), ("the the the", None), ("η γλώσσα", None), ("x" * 100_000, None)]
    got = {r.row.doc_id: (r.lang_pred, r.score) for r in langid.identify(documents(rows, CLASH)).collect()}
    assert all(got[i][0] == rows[i][1] for i in range(60))
    assert [got[i] for i in (60, 61, 62)] == [("und", 0.0)] * 3
    assert got[63][0] == "en" and got[64][1] == 0.0
    assert all(0 <= s <= 1 for _, s in got.values())
    assert langid.identify(documents([])).count() == 0
    assert {r.lang_pred for r in langid.identify(documents([("abc", None)])).collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    got = queries.op4_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = got.filter("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98


def test_language_ignores_its_label(spark, documents):
    rows = [("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 30
    profiles = langid.learn(documents(rows).withColumnRenamed("doc_id", "id"))
    one = documents([("the dog", "de", "en")])
    assert langid.identify(one, profiles=profiles).first().lang_pred == "en"


def test_secrets_against_brute_force(spark, documents):
    rng = random.Random(5)
    parts = ["password", "Token", "api_key", "APIKEY", "=", ": ", "'", '"', "abc", "deadbeef" * 3, "AKIA", "ABCDEFGH12345678",
             " ", "é", "😀", "x9", "0123456789abcdef" * 2, "\n", "secret", "AKIAAKIA", "zQ8+x/Lm2"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)] + [None, "", "x" * 200_000]
    out = secrets.scan_secrets(documents(texts, CLASH))
    got = out.select("row.doc_id", secrets.spans_text(F.col("base")).alias("b"),
                     *[secrets.count_kind(F.col("base"), k).alias(k) for k in ("assign", "access", "hex")]).collect()
    for r in got:
        counts, spans = brute.secrets(texts[r.doc_id])
        assert (r.b, r.assign, r.access, r["hex"]) == (spans, *counts.values())
    assert secrets.scan_secrets(documents([])).count() == 0


def test_many_secrets_in_one_text(spark, documents):
    """80,000 findings: more than a part of the fold, and more than squared work would allow."""
    hexes = "0123456789abcdef01234567"
    texts = [f"é{hexes} " * n for n in (secrets.PART - 1, secrets.PART, secrets.PART + 1, 80_000)]
    texts += [f"token={hexes} " * 700]
    start = time.monotonic()
    rows = secrets.scan_secrets(documents(texts)).select(
        "row.doc_id", secrets.count_kind(F.col("base"), "hex").alias("n"), secrets.count_kind(F.col("spans"), "entropy").alias("more"),
        F.md5(secrets.spans_text(F.col("base"))).alias("base")).collect()
    assert time.monotonic() - start < 60
    for r in rows:
        counts, spans = brute.secrets(texts[r.doc_id])
        assert (r.n, r.more, r.base) == (counts["hex"], 0, hashlib.md5(spans.encode()).hexdigest())


def test_entropy_findings_inside_base_findings(spark):
    """The running end equals a comparison with every base finding."""
    rng = random.Random(8)
    rows = []
    for i in range(60):
        spans = [(a := rng.randint(0, 60), rng.choice([0, 1, 2, 3, 3]), a + rng.randint(1, 30)) for _ in range(rng.randint(0, 12))]
        rows.append((i, sorted(spans)))
    df = spark.createDataFrame(rows, "i int, s array<struct<start:bigint,kind:int,end:bigint>>")
    for r in df.select("i", secrets._uncovered(F.col("s")).alias("s")).collect():
        spans = rows[r.i][1]
        want = [s for s in spans if s[1] != 3 or not any(b[1] != 3 and b[0] <= s[0] and b[2] >= s[2] for b in spans)]
        assert [tuple(s) for s in r.s] == want


def test_entropy_spans(spark, documents):
    value = "".join(random.Random(1).choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=40))
    flat = "abababababababababab1" * 2
    texts = [f"key é {value}, end", "word-" * 10, "1" * 40, "123e4567-e89b-12d3-a456-426614174000", flat, value + "EXAMPLE"]
    rows = secrets.scan_secrets(documents(texts)).orderBy("row.doc_id").collect()
    spans = [[(s.start, s.end) for s in r.spans if s.kind == secrets.KINDS.index("entropy")] for r in rows]
    assert [bool(s) for s in spans] == [True, False, False, False, False, False]
    bits = next(b for n, _, b in secrets.CLASSES if n == "alnum")
    hit = [i for i, h in enumerate(brute.window_entropies(value, secrets.WINDOW)) if h >= bits]
    assert spans[0] == [(6 + hit[0], 6 + hit[-1] + secrets.WINDOW)]


def test_quality_base_against_brute_force(spark, documents):
    rng = random.Random(6)
    vocab = ["a", "b#", "c%$", "\x0b", "é", "<x>", "dog"]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += ["\n".join(rng.choice(["x y", "x y ", "", " \t", "z"]) for _ in range(9)) for _ in range(50)]
    texts += ["one two three four five six seven eight " * 3, "1 2 3 4 5 6 7 8", None, "", "\n", "q " * 30_000]
    got = quality.quality_rules(documents(texts, CLASH)).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == \
            brute.quality_base(texts[r.row.doc_id])
        assert r.kept == (not r.base_failed)  # no language to compare with
    assert quality.quality_rules(documents([])).count() == 0


def test_quality_references_count_every_row(spark, documents, monkeypatch):
    seen = []
    fit = quality.references
    monkeypatch.setattr(quality, "references", lambda *a, **kw: seen.append(fit(*a, **kw)) or seen[-1])
    rng = random.Random(8)
    vocab = ["the", "The", "Οδός", *[f"w{i}" for i in range(40)]]
    rows = [(" ".join(rng.choice(vocab) for _ in range(24)), "xx", None, i if i % 9 else None) for i in range(2600)]
    odd = [("few words", "xx"), (None, "xx"), ("w1 " * 60, "xx"), ("no language " + rows[1][0], None)]
    assert quality.quality_rules(documents(rows + odd).repartition(3)).count() == 2604
    counts = collections.Counter(w.lower() for r in rows for w in r[0].split())
    (shares, words), = seen[0]
    assert words == {w: n / (24 * 2600) for w, n in counts.items()}
    whole = "".join(r[0] for r in rows)
    assert shares[0] == sum(c.isupper() for c in whole) / len(whole)
    assert shares[4] == 23 * 2600 / len(whole)


def test_quality_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op9_quality_rules(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    met = got.join(labels, "doc_id").filter("NOT base_failed").groupBy("quality").agg(
        F.sum((~F.col("kept")).cast("int")).alias("gone")).collect()
    gone = {r.quality: r.gone for r in met}
    assert gone[1] == 0 and gone[0] > 0


def test_jensen_shannon_distance(spark):
    runs = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(n).alias("n")) for w, n in (("the", 2), ("cat", 9))])
    n_words = 8
    shares = {"the": 0.5, "of": 0.3}
    got = spark.range(1).select(quality.word_distance(runs, F.lit(n_words), shares)).first()[0]
    a = np.array([2 / 8, 0, 6 / 8])
    b = np.array([0.5, 0.3, 0.2])
    m = (a + b) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        want = (np.nansum(a * np.log2(a / m)) + np.nansum(b * np.log2(b / m))) / 2
    assert got == pytest.approx(want)


def test_language_equals_plain_distances(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()]
    want = brute.languages(docs)
    got = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in queries.op4_language_id(spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    for i, (held, lang, score) in want.items():
        assert got[i][:2] == (held, lang) and got[i][2] == pytest.approx(score)


def test_mixing_near_the_target_where_rows_share_an_id(spark, documents):
    """Rows without an id, or with one id, are told apart by their texts."""
    rng = random.Random(8)
    rows = [("w " * 10 + str(i), None, "null ids", None) for i in range(3000)]
    rows += [("w " * rng.randint(5, 15) + str(i), None, "one id", 5) for i in range(1500)]
    rows += [("w " * 20 + str(i), None, "large", i) for i in range(6000)]
    sums = {}
    for r in mixing.mix_copies(documents(rows)).collect():
        own = sums.setdefault(r.source, [0, r.target])
        own[0] += r.size * r.copies
    assert len(sums) == 3
    for taken, target in sums.values():
        assert abs(taken - target) <= 0.01 * target
