"""Plain Python versions of the operators' contracts, for small fixtures."""

import functools
import hashlib
import math
import re
import zlib
from collections import Counter

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def groups(keys, linked):
    """Smallest key reachable by links."""
    parent = {k: k for k in keys}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def secrets(text):
    text = text or ""
    kinds = {
        "assign": [(m.start(), m.end()) for m in re.finditer(
            r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.A)
            if len(m[1]) >= 6],
        "access": [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20],
        "hex": [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24],
    }
    order = list(kinds)
    spans = sorted((s, order.index(k), e) for k, found in kinds.items() for s, e in found)
    return {k: len(v) for k, v in kinds.items()}, ",".join(f"{order[k]}:{s}:{e}" for s, k, e in spans)


def window_entropies(value, window):
    for i in range(len(value) - window + 1):
        counts = Counter(value[i:i + window])
        yield -sum(c / window * math.log2(c / window) for c in counts.values())


def quality_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    repeated = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            repeated.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated),
            n < 20 or 100 * len(repeated) > 30 * n)


def suffix_dedup(docs, window=50):
    """docs: {id: bytes} -> {id: (bytes, removed, spans, kept)}."""
    first = {}
    for i in sorted(docs):
        for a in range(len(docs[i]) - window + 1):
            first.setdefault(docs[i][a:a + window], i)
    out = {}
    for i, b in docs.items():
        gone = bytearray(len(b))
        for a in range(len(b) - window + 1):
            if first[b[a:a + window]] < i:
                gone[a:a + window] = b"\1" * window
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g))
    return out


def damaged(conv_id, turn, role, text):
    """The contract's damage: the rows that stay of one row."""
    of = lambda v: " " if v is None else str(v)
    kind = zlib.crc32(f"{of(conv_id)}:{of(turn)}".encode()) % 20
    role, text = of(role), of(text)
    text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
    return [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)


def repair(rows):
    """rows: (turn, role, text) in order -> the contract's columns but conv_id."""
    turns = [t for t, _, _ in rows if t is not None]
    faults, seen = [], set()
    for _, role, text in rows:
        said = WORD.findall(text)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen
                      else "truncated" if said[-1][-1] not in ".!?" else None)
        seen.add((role, text))

    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(i, state, inserts):
        """Least (cost, letters, turns) from row i on."""
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        ways = []
        if inserts < 4:
            ways += [(3, "I", i, r, inserts + 1, (r, "")) for r in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            ways.append((4, "D", i + 1, None, 0, None))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                ways += [(3 + more, "R", i + 1, r, 0, (r, text)) for r in ("user", "assistant")]
                ways.append((more, "K", i + 1, role, 0, (role, text)))
        for cost, letter, to, role, n, turn in ways:
            then = state if role is None else moves.get((state, role[:1]))
            if then is not None:
                rest = best(to, then, n)
                if rest:
                    found.append((cost + rest[0], letter + rest[1], ((turn,) if turn else ()) + rest[2]))
        return min(found, default=None)

    for i in range(len(rows), 0, -1):  # from behind, so that no call goes deep
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    cost, audit, left = best(0, "", 0)
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in (
        "blank", "duplicate", "truncated")], sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, sha("\n".join(f"{r}:{t}" for r, t in left)))


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def ranked(docs, items, top=50):
    """docs, items: [(id, text)] -> {(item, rank): (doc, score)}; ids differ."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = {}
    for item, text in items:
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set(terms(text))}
        scores = []
        for doc, c in held:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms if n_terms else 50
            score = sum(w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t, w in weights.items())
            if score > 0:
                scores.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scores)[:top], 1):
            out[item, rank] = doc, -score
    return out


def letter_grams(text):
    """N-grams of one to three letters of the padded words, as numbers (a leading blank adds nothing)."""
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
        padded = f" {word} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i:i + n]
                if gram != " ":
                    out[functools.reduce(lambda a, c: a << 21 | (0 if c == " " else ord(c)), gram, 0)] += 1
    return out


def languages(rows, size=400):
    """rows: (id, text, lang) -> {id: (held out, language, score)} by the out-of-place distance."""
    ranked_grams = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:size]]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in rows}
    counts = {}
    for i, text, lang in rows:
        if not held[i] and lang is not None and text is not None:
            counts.setdefault(lang, Counter()).update(letter_grams(text))
    profiles = {lang: {g: p for p, g in enumerate(ranked_grams(c))} for lang, c in counts.items()}
    out = {}
    for i, text, _ in rows:
        own = ranked_grams(letter_grams(text))
        if not own:
            out[i] = held[i], "und", 0.0
            continue
        far = {lang: sum(abs(p[g] - k) if g in p else size for k, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        out[i] = held[i], best, 1 - far[best] / (size * len(own))
    return out
