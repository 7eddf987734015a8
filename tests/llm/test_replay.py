"""Merge replay codec: against the library."""

import base64
import hashlib
import random

import numpy as np
import pytest
from test_tokens import texts

from pricelens.llm import queries, replay

tiktoken = pytest.importorskip("tiktoken")
PATH, PATTERN = queries.tokenizer_path(queries.BYTE_RANKS), queries.byte_pattern()


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(encoded):
    return [np.frombuffer(i, "<u4").tolist() for i in encoded]


def test_equals_the_library(library):
    own = replay.Replay(PATH, PATTERN)
    for batch in (texts(), texts()[::-1], []):
        found = own.encode(batch)
        assert ids_of(found) == [library.encode_ordinary(t) for t in batch]
        assert own.decode(found).to_pylist() == [t.encode() for t in batch]


def test_with_little_memory(library, monkeypatch):
    monkeypatch.setattr(replay, "REMEMBERED", 5)
    monkeypatch.setattr(replay, "PAIRS", 5)
    own, all_texts = replay.Replay(PATH, PATTERN), texts(300)
    for i in range(0, len(all_texts), 7):
        batch = all_texts[i:i + 7]
        assert ids_of(own.encode(batch)) == [library.encode_ordinary(t) for t in batch]


def plain_merge(ranks, piece):
    """The lowest pair first, the leftmost of equal ones."""
    parts = [bytes([b]) for b in piece]
    while len(parts) > 1:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            break
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_merges_that_uncover_a_lower_rank(tmp_path):
    """Ranks in no sensible order: a merge often makes a pair that should have come before it."""
    rng = random.Random(4)
    for _ in range(60):
        longer = list({bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(25)})
        rng.shuffle(longer)
        tokens = [bytes([b]) for b in range(256)] + longer
        path = tmp_path / f"{rng.random()}"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
        own = replay.Replay(str(path), PATTERN)
        pieces = [bytes(rng.choices(b"abc", k=rng.randint(1, 14))) for _ in range(60)]
        ranks = {t: i for i, t in enumerate(tokens)}
        assert ids_of(own.merge(pieces)) == [[ranks[p]] if p in ranks else plain_merge(ranks, p) for p in pieces]


def test_a_long_piece(library):
    own = replay.Replay(PATH, PATTERN)
    text = "ab" * 100_000
    assert ids_of(own.encode([text, "é" * 1000])) == [library.encode_ordinary(t) for t in (text, "é" * 1000)]


def test_frames(spark, documents, library):
    rows = [None, "", "one two", "one two", "x y " * 20_000]
    ids = replay.encode(documents(rows, ("ids", "row", "n_tokens")), PATH, PATTERN)
    for r in replay.decode(ids, PATH, PATTERN).collect():
        text = rows[r.row.doc_id] or ""
        want = library.encode_ordinary(text)
        assert (ids_of([r.ids])[0], r.n_tokens, bytes(r.decoded)) == (want, len(want), text.encode())
        assert r.row.ids == "x"
    both = replay.encode(documents(rows), PATH, PATTERN, decoded=True).select("ids", "decoded").collect()
    assert sorted(map(tuple, both)) == sorted(map(tuple, replay.decode(ids, PATH, PATTERN).select("ids", "decoded").collect()))
    assert replay.decode(replay.encode(documents([]), PATH, PATTERN), PATH, PATTERN).count() == 0


def test_op13_on_the_whole_table(spark, sf_dir, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op13_merge_replay_codec(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
