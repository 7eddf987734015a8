import random
import re

import brute
import numpy as np
import pytest
import xxhash

from pricelens.llm import queries, simhash


def plain_fingerprint(text):
    words = brute.WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(texts):
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    comp = brute.groups(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    return {i: (f"{fps[i]:016x}", comp[i]) for i in fps}


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    x = rng.integers(0, 1 << 63, 200, np.uint64)
    x[100:] = x[:100] ^ np.uint64(0b1011011)
    near = simhash.near_rows(simhash.bit_planes(x), x[:37], radius)[:, :len(x)]
    want = np.bitwise_count(x[:37, None] ^ x[None, :]) <= radius
    assert (near == want).all()


def test_every_near_pair_shares_two_bands():
    rng = random.Random(4)
    masks = simhash.band_masks(3)
    for _ in range(2000):
        flips = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(flips & m == 0 for m in masks)


@pytest.mark.parametrize("block_rows", [8192, 4])
def test_links_of_fingerprints(spark, block_rows):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = set(base)
    for b in base:  # a chain and a dense group around each
        for _ in range(8):
            fps.add(b ^ sum(1 << k for k in rng.sample(range(12), rng.randint(1, 3))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.links(df, 3, block_rows).collect()]
    ids = sorted(fps)
    want = brute.groups(ids, lambda a, b: (a ^ b).bit_count() <= 3)
    both = set(edges) | {(b, a) for a, b in edges}
    assert brute.groups(ids, lambda a, b: (a, b) in both) == want


def test_edge_texts(spark, documents):
    texts = {0: None, 1: "", 2: " \t\n", 3: "One", 4: "one", 5: "one two", 6: "ONE  two\x0b", 7: "é È one two",
             8: "a b c d " * 5000, 9: "a b c d " * 5000, 10: "\x85 \xa0"}
    df = documents(list(texts.values()), ("fp", "id", "component_id"))
    got = {r.id: (f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in simhash.simhash_groups(df).collect()}
    assert got == expected(texts)
    assert simhash.simhash_groups(documents([])).count() == 0


def test_null_and_repeated_ids(spark, documents):
    rows = [("a b c", None, None, None), ("a b c", None, None, 5), ("a b c", None, None, 5), ("x y z", None, None, None)]
    got = sorted(((r.id, r.component_id) for r in simhash.simhash_groups(documents(rows)).collect()), key=str)
    assert got == [(5, 5), (5, 5), (None, 5), (None, None)]
    kept = simhash.simhash_groups(documents(rows)).filter("kept").collect()
    assert sorted(((r.id, r.component_id) for r in kept), key=str) == [(5, 5), (5, 5), (None, None)]


def test_query_on_the_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op8_simhash_near_dedup(spark, sf_dir).collect()}
    assert got == expected(docs)
