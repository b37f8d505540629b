"""Periodic runs against looking at every period at every place."""

import random
import time
import zlib

from hypothesis import given, settings, strategies as st

from tallyloom.llm import periodic_runs as pr


def plain(words, least=6):
    """All runs as (start, length, period), from every period and every stretch of equal words."""
    n, seen = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= 3 * q:
                seen.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((a, b, q) for (a, b), q in seen.items() if b >= max(least, 4 * q))


def plain_rest(words, runs):
    gone = {i for a, b, q in runs for i in range(a + q, a + b)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def made(rng, pieces):
    """Text of repeated units, also of units that are themselves repetitive."""
    out = []
    for _ in range(pieces):
        unit = [b"%d" % rng.randrange(3) for _ in range(rng.randrange(1, 12))]
        if rng.random() < 0.4:
            unit = unit * rng.randrange(2, 6) + [b"x"]
        out += unit * rng.randrange(1, 7) + unit[: rng.randrange(len(unit))]
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=80), max_size=6))
def test_short_texts_over_few_words(texts):
    assert pr.runs_of(texts) == [plain(t) for t in texts]


def test_made_repetitions_of_all_sizes():
    rng = random.Random(7)
    texts = [made(rng, rng.randrange(1, 9)) for _ in range(150)] + [[], [b"a"], [b"a"] * 5, [b"a"] * 6, [b"a", b"b"] * 4]
    got = pr.runs_of(texts)
    assert got == [plain(t) for t in texts]
    assert [pr.collapsed(t, r) for t, r in zip(texts, got)] == [plain_rest(t, r) for t, r in zip(texts, got)]
    assert max(q for runs in got for _, _, q in runs) > 20


def test_chunks_do_not_matter(monkeypatch):
    rng = random.Random(9)
    texts = [made(rng, 4) for _ in range(40)]
    whole = pr.runs_of(texts)
    monkeypatch.setattr(pr, "CHUNK", 50)
    assert pr.runs_of(texts) == whole


def test_long_texts_take_time_in_proportion():
    """One word, a period of thousands, Fibonacci words, and a unit of many repeated words."""
    def fibonacci(n):
        a, b = [b"a"], [b"a", b"b"]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]

    def taken(n):
        texts = [
            [b"a"] * n, [b"%d" % (i % 4001) for i in range(n)], fibonacci(n), ([b"a"] * 500 + [b"b"] * 500 + [b"c"]) * (n // 1001),
            [b"%d" % (i * i % 7919) for i in range(n)],
        ]
        began = time.perf_counter()
        runs = pr.runs_of(texts)
        return time.perf_counter() - began, runs

    _, runs = taken(20_000)
    assert runs[0] == [(0, 20_000, 1)] and runs[1] == [(0, 20_000, 4001)]
    assert (0, 1001 * 19, 1001) in runs[3] and len(runs[3]) == 1 + 2 * 19
    small, large = taken(40_000)[0], taken(160_000)[0]
    assert large < 10 * small + 2


def test_odd_rows_and_extra_columns(make_docs, odd_rows):
    rows = odd_rows + [(20, "x " * 5000, "en", "a"), (21, "a b a b a b a b", "en", "a"), (22, "la li\tla li\nla li la  li end", "fr", "b")]
    got = pr.find_runs(make_docs(rows)).collect()
    want = []
    for i, text, *_ in rows:
        words = (text or "").encode().split()
        runs = plain(words) if len(set(words)) > 1 or len(words) < 50 else [(0, len(words), 1)]
        want.append((i, runs, plain_rest(words, runs).decode()))
    assert sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=str) == sorted(want, key=str)
    assert pr.digest(pr.find_runs(make_docs([]))).count() == 0
    none = pr.digest(pr.find_runs(make_docs([(1, None, "en", "a")]))).first()
    assert none.n_runs == 0 and none.start is None and none.runs_sha256 == none.collapsed_sha256 != ""


def test_planted_tails(make_docs):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, " ".join(f"w{k}" for k in range(1 + i % 37)), "en", "a") for i in ids] + [(ids[0], None, "en", "a"), (ids[0], " \t", "en", "a"), (None, "a b", "en", "a")]
    from pyspark.sql import functions as F

    got = make_docs(rows).select("doc_id", "text", pr.planted(F.col("doc_id"), F.col("text")).alias("new")).collect()
    assert len(got) == len(rows)
    for r in got:
        words = (r.text or "").split()
        if r.doc_id is not None and words:
            g, n = zlib.crc32(str(r.doc_id).encode()) // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert (r.new or "").split() == words
