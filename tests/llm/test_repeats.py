"""Suffix arrays and the dedup built on them."""

import hashlib
import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from pricelens.llm import queries, repeats, suffixes


def test_suffix_arrays():
    rng = random.Random(5)
    for n in range(1500):
        k = rng.choice([1, 2, 3, 6, 300])
        x = [rng.randint(1, k) for _ in range(rng.randint(0, 40))]
        x = (x[:8] * rng.randint(1, 6) if n % 5 == 0 else x) + [0]
        want = sorted(range(len(x)), key=lambda i: x[i:])
        sa = suffixes.suffix_array(np.array(x))
        assert sa.tolist() == want
        shared = suffixes.common_prefixes(np.array(x), sa, 5)
        for a, b in zip(want, want[1:]):
            same = next((d for d in range(5) if x[a + d:a + d + 1] != x[b + d:b + d + 1] or a + d >= len(x) or b + d >= len(x)), 5)
            assert shared[b] == same


def test_suffix_arrays_of_runs():
    rng = random.Random(6)
    for _ in range(600):
        x = [c for _ in range(rng.randint(1, 9)) for c in [rng.randint(1, 3)] * rng.choice([1, 2, 9, 40])] + [0]
        assert suffixes.suffix_array(np.array(x)).tolist() == sorted(range(len(x)), key=lambda i: x[i:])
    run = [1] * 300_000 + [0]  # would take 300,000 rounds, one character each
    assert suffixes.suffix_array(np.array(run)).tolist() == [len(run) - 1, *range(len(run) - 2, -1, -1)]
    two = np.array([2, *[1] * 200_000, 2, *[1] * 200_000, 2, 0])  # two equal long substrings
    sa = suffixes.suffix_array(two)
    assert sa[0] == len(two) - 1 and len(set(sa.tolist())) == len(two)


def test_joined_spans():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = rng.integers(0, 30)
        docs, starts, sizes = rng.integers(0, 4, n) * 10, rng.integers(0, 60, n), rng.integers(1, 20, n)
        want = []
        for d in sorted(set(docs.tolist())):
            spans = [(int(a), int(a + k)) for i, a, k in zip(docs, starts, sizes) if i == d]
            want += [(d, a, b - a) for a, b in repeats.merged(spans, 1000)]
        assert list(zip(*[x.tolist() for x in repeats.joined(docs, starts, sizes)])) == want


def test_segments_cover_every_window():
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab \xc3\xa9") for _ in range(rng.choice([0, 10, 49, 50, 51, 400]))) for _ in range(40)]
    texts += [b"x" * 500, bytes(range(256)) * 3]
    p = repeats.segments(texts, np.arange(len(texts)))
    seen = sorted((int(r["doc"]), int(r["start"]) + k) for r in p for k in range(r["n"]))
    assert seen == [(i, a) for i, t in enumerate(texts) for a in range(len(t) - 49)]
    minimizer = {}
    for r in p:  # equal windows have the same minimizer
        for k in range(r["n"]):
            a = int(r["start"]) + k
            assert minimizer.setdefault(texts[r["doc"]][a:a + 50], int(r["mh"])) == int(r["mh"])


def made_up(rng, n):
    """Copies, near copies, shared passages, runs, short and odd texts."""
    words = ["lorem", "ipsum", "dolor", "é", "sit-amet", "x" * 30, "\x00", "漢字"]
    text = lambda m: " ".join(rng.choice(words) + str(rng.randint(0, 99)) for _ in range(m))
    passages = [text(14) for _ in range(4)]
    out = [text(rng.randint(0, 40)) for _ in range(n)]
    for i in range(0, n, 3):
        a = rng.randint(0, len(out[i]))
        out[i] = out[i][:a] + rng.choice(passages) + out[i][a:]
    for i in range(5, n, 7):
        out[i] = out[i - 5]
    for i in range(6, n, 11):
        t = list(out[i - 6])
        for _ in range(3):
            if t:
                t[rng.randrange(len(t))] = "#"
        out[i] = "".join(t)
    return out + ["z" * 300, "z" * 120, "z" * 49, "é" * 40, "é" * 40, "", None, "k" * 50, "k" * 50, "k" * 51]


def check(df, texts, **kw):
    want = brute.suffix_dedup({i: (t or "").encode() for i, t in enumerate(texts)})
    for r in repeats.suffix_dedup(df, **kw).collect():
        spans = [(s.start, s.end) for s in r.spans]
        assert (r.n_bytes, sum(b - a for a, b in spans), len(spans), bytes(r.kept)) == want[r.row.doc_id]
        assert all(a < b for a, b in spans) and all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


@pytest.mark.parametrize("shard", [repeats.SHARD_SEGMENTS, 20])
def test_suffix_dedup_against_brute_force(spark, documents, monkeypatch, shard):
    monkeypatch.setattr(repeats, "SHARD_SEGMENTS", shard)  # 20: hot minimizers are cut into windows
    texts = made_up(random.Random(shard), 120)
    check(documents(texts, ("row", "doc", "spans", "kept", "key")).repartition(5), texts)


def test_many_copies_and_a_very_long_text(spark, documents):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    texts = [passage] * 60 + ["".join(rng.choice("abcdefgh ") for _ in range(60_000)) + passage]
    check(documents(texts).repartition(6), texts)


def test_a_passage_in_many_contexts_fills_no_shard(spark, documents, monkeypatch):
    sort = repeats._sort_shard

    def bounded(window):
        inner = sort(window)

        def run(table):
            assert table.num_rows < 100, "a shard grows with the documents of one window"
            return inner(table)

        return run

    monkeypatch.setattr(repeats, "SHARD_SEGMENTS", 20)
    monkeypatch.setattr(repeats, "_sort_shard", bounded)
    rng = random.Random(12)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = some(120) + "-" * 70
    texts = [some(rng.randint(0, 60)) + passage + some(rng.randint(0, 60)) for _ in range(900)]
    check(documents(texts).repartition(3), texts)


def test_equal_segments_whatever_their_order():
    rng = np.random.default_rng(8)
    for low in (1 << 63, 3):  # 3: many keys are shared by segments that differ
        p = np.zeros(600, repeats.PART)
        p["mh"] = rng.integers(0, 12, 600)
        p["sh"] = rng.integers(0, 3, 600).astype(np.uint64) << np.uint64(40) | rng.integers(0, low, 600).astype(np.uint64) % np.uint64(5)
        p["doc"], p["start"] = rng.integers(0, 9, 600), np.arange(600)
        least = {}
        for r in p:
            k = int(r["mh"]), int(r["sh"])
            least[k] = min(least.get(k, 99), int(r["doc"]))
        want = sorted(int(r["start"]) for r in p if r["doc"] > least[int(r["mh"]), int(r["sh"])])
        q, covered = repeats.covered_by_equal(p)
        assert sorted(q["start"].tolist()) == list(range(600))
        assert sorted(q["start"][covered].tolist()) == want
        assert (np.diff(repeats.bucket_of(q["mh"], 7).astype(int)) >= 0).all()


def test_segment_hashes_tell_bytes_and_length():
    rng = random.Random(15)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(50, 130))) for _ in range(60)]
    texts += [t[:i] + b"#" + t[i + 1:] for t in texts[:20] for i in range(len(t))] + [b"z" * n for n in range(50, 130)] + texts
    data = b"".join(texts)
    size = np.array([len(t) for t in texts])
    got = repeats.span_hashes(repeats.gram_hashes(data), np.cumsum(size) - size, size, repeats.GRAM)
    assert len(set(got.tolist())) == len(set(texts)) == len(set(zip(got.tolist(), texts)))


def test_narrowed_segments_keep_every_shared_window():
    rng = random.Random(16)
    some = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))
    shared = dropped = 0
    for _ in range(200):
        phrase, left, right = some(rng.randint(24, 50)), [some(40) for _ in range(3)], [some(40) for _ in range(3)]
        texts = [rng.choice(left)[rng.randint(0, 40):] + phrase + rng.choice(right)[:rng.randint(0, 40)] for _ in range(6)]
        texts += [b"xyz" * rng.randint(17, 30), b"z" + b"xyz" * 20]  # the minimizer stands in them more than once
        docs = np.array([0, 0, 1, 2, 3, 4, 5, 6])
        p = repeats.segments(texts, np.arange(len(texts)))
        bodies = [texts[r["doc"]][r["start"]:r["start"] + r["n"] + 49] for r in p]
        own = docs[p["doc"]]
        d, s, kept = repeats.narrowed(own, p["start"], bodies)
        windows = lambda d, s, b: [(i, a + k, t[k:k + 50]) for i, a, t in zip(d.tolist(), s.tolist(), b) for k in range(len(t) - 49)]
        before, after = windows(own, p["start"], bodies), windows(d, s, kept)
        where = {}
        for i, _, w in before:
            where.setdefault(w, set()).add(i)
        need = {x for x in before if len(where[x[2]]) > 1}
        assert need <= set(after) <= set(before)
        shared, dropped = shared + len(need), dropped + len(before) - len(after)
    assert shared > 1000 and dropped > 1000


def test_a_common_phrase_alone_is_not_sorted(spark, documents, monkeypatch):
    sort = repeats._sort_shard

    def bounded(window):
        inner = sort(window)

        def run(table):
            assert sum(len(b) for b in table["body"].to_pylist()) < 1500, "segments that share a phrase only are sorted"
            return inner(table)

        return run

    monkeypatch.setattr(repeats, "_sort_shard", bounded)
    rng = random.Random(17)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    phrase, passage = some(36), some(70)
    texts = [some(80) + phrase + some(80) for _ in range(300)]
    for i in (3, 90, 200):
        texts[i] = some(10) + passage + some(10)
    check(documents(texts).repartition(3), texts)


def test_segments_leave_in_bounded_lots():
    rng = np.random.default_rng(4)
    texts = [rng.integers(97, 123, 1 << 19, np.uint8).tobytes() for _ in range(20)]  # one batch
    batch = pa.RecordBatch.from_arrays([pa.array(range(20), pa.int64()), pa.array(texts, pa.binary())], ["doc", "text"])
    got = [(k, b) for out in repeats._parts(8, 50, 24)(iter([batch])) for k, b in zip(out["kind"], out["body"])]
    sizes = [len(b.as_buffer()) for k, b in got if k.as_py() == repeats.CANDIDATE]
    assert sum(sizes) == repeats.PART.itemsize * len(repeats.segments(texts, np.arange(20)))
    most = (repeats.LOT_SEGMENTS + repeats.BATCH_BYTES // 8) * repeats.PART.itemsize  # for all eight buckets
    assert max(sizes) < most / 7


def test_buckets_grow_with_the_bytes(spark, documents, monkeypatch):
    meet = repeats._meet

    def bounded(table):
        assert sum(len(b.as_buffer()) for b in table["body"]) < 100_000, "a bucket grows with the input"
        return meet(table)

    monkeypatch.setattr(repeats, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(repeats, "_meet", bounded)
    rng = random.Random(14)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(40_000)) for _ in range(40)]
    texts[7] = texts[3][:500] + texts[7]
    check(documents(texts).repartition(3), texts)


def test_null_repeated_and_no_documents(spark, documents):
    text = "0123456789" * 6
    rows = [(text, None, None, 5), (text, None, None, 5), (text, None, None, None), (text, None, None, None)]
    got = sorted(((r.row.doc_id, r.n_bytes - len(r.kept)) for r in repeats.suffix_dedup(documents(rows)).collect()), key=str)
    assert got == [(5, 0), (5, 0), (None, 60), (None, 60)]
    assert repeats.suffix_dedup(documents([])).count() == 0
    assert [bytes(r.kept) for r in repeats.suffix_dedup(documents([None, ""])).collect()] == [b"", b""]


def test_different_texts_of_one_id(spark, documents):
    rng = random.Random(18)
    texts = made_up(rng, 90) + ["", None, "ab", "x" * 20]
    ids = [rng.choice([None, *range(25)]) for _ in texts]
    rows = [((t or "").encode(), len(ids) if i is None else i) for t, i in zip(texts, ids)]
    first, gone = {}, {}
    for t, i in rows:
        for a in range(len(t) - 49):
            first[t[a:a + 50]] = min(first.get(t[a:a + 50], i), i)
    for t, i in rows:
        for a in range(len(t) - 49):
            if first[t[a:a + 50]] < i:
                gone.setdefault(i, set()).update(range(a, a + 50))
    want = sorted((i, bytes(c for a, c in enumerate(t) if a not in gone.get(i, ()))) for t, i in rows)
    got = repeats.suffix_dedup(documents([(t, None, None, i) for t, i in zip(texts, ids)]).repartition(4)).collect()
    assert sorted((len(ids) if r.row.doc_id is None else r.row.doc_id, bytes(r.kept)) for r in got) == want


def test_query_on_the_whole_table(spark, sf_dir):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = brute.suffix_dedup(docs)
    for r in queries.op3_suffix_dedup(spark, sf_dir).collect():
        n, removed, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, hashlib.sha256(kept).hexdigest())
