"""Personal data: base spans against plain matching, added spans by their votes."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import personal_data as pii
from tallyloom.session import durable

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    out = []
    for order, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(out)]


def found(docs):
    spans = durable(pii.candidates(docs), "test-spans")
    return pii.detect(spans, pii.learn(spans))


def check(make_docs, texts):
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    detected = found(make_docs(rows))
    got = {r.doc_id: r.spans for r in detected.collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert [(s.kind, s.start, s.end) for s in got[i] if s.base] == plain(text), text
        added = [(s.start, s.end) for s in got[i] if not s.base]
        taken = [(a, b) for _, a, b in plain(text)]
        assert all(b <= x or a >= y for a, b in added for x, y in taken)
    digests = {r.doc_id: r for r in pii.digest(detected).collect()}
    for i, text in enumerate(texts):
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(text))
        assert digests[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [digests[i][f"n_{k}"] for k in RULES] == [sum(k == x for x, _, _ in plain(text)) for k in RULES]
        assert all(part in digests[i].spans.split(",") for part in listed.split(",") if part)
    return got


def test_base_spans_equal_plain_matching(make_docs):
    rng = random.Random(5)
    bits = [
        "a.b+c@d-e.f.gh", "x@y", "@", "u@1.2.3.4.5", "a@b.cd_e@x.y.z", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.0255", "1.2.3",
        "4111 1111 1111 1111", "4111-1111-1111-1112", "79927398713", "0000 0000 0000", "+1 (234) 567-8901", "+12", "++49 30 1234567.", "+1-2-3(",
        "été", "\U0001F600", " ", "\t", ".", "-", "password=", "abc123def", "7", "(", "Dr. Smith", "你好",
    ]
    check(make_docs, ["".join(rng.choice(bits) + rng.choice(["", " ", ", "]) for _ in range(rng.randrange(14))) for _ in range(400)])


def test_nulls_empties_repeats_and_clashing_columns(make_docs, odd_rows):
    rows = odd_rows + [(30, "me@home.org", "en", "a"), (30, "me@home.org", "en", "a"), (None, "me@home.org", "en", "a")]
    got = [(r.doc_id, [s.kind for s in r.spans]) for r in found(make_docs(rows)).collect()]
    assert len(got) == len(rows) and got.count((30, ["email"])) == 2 and got.count((None, ["email"])) == 1
    assert pii.digest(found(make_docs([]))).count() == 0
    nothing = pii.digest(found(make_docs([(1, None, "en", "a"), (2, "plain words only", "en", "a")]))).collect()
    assert all(r.spans == "" and r.n_added == 0 and r.n_email == 0 for r in nothing)


def test_long_and_hostile_texts_take_time_in_proportion(make_docs):
    def taken(n):
        texts = ["a" * n, "1" * n, "1." * n, "+1" * (n // 2), "a@" * (n // 2), "x@y.z " * (n // 40) + "(212) 555-0199 " * (n // 40), "1 " * n, "A" * n]
        docs = make_docs([(i, t, "en", "a") for i, t in enumerate(texts)])
        began = time.perf_counter()
        sizes = {r.doc_id: r.n for r in durable(pii.candidates(docs), "hostile").select("doc_id", F.size("spans").alias("n")).collect()}
        return time.perf_counter() - began, sizes

    taken(1000)
    small, large = taken(20_000), taken(160_000)
    assert large[1][5] == 2 * (160_000 // 40)
    assert large[0] < 12 * small[0] + 20


def test_running_equals_plain_sums(spark):
    lists = [list(range(n)) for n in (0, 1, 2, 3, 7, 16, 17, 100)]
    df = spark.createDataFrame([(x,) for x in lists], "x array<int>")
    got = df.select("x", pii.running(F.col("x"), pii._added, F.lit(0)).alias("y")).collect()
    assert sorted(map(tuple, (r.y for r in got))) == sorted(tuple(np.cumsum(x).tolist()) for x in lists)


def test_added_spans_follow_the_votes(make_docs):
    """Clear cases of added kinds stay, look-alikes go; no label is given."""
    rng = random.Random(1)
    texts = []
    for i in range(400):
        name = "".join(rng.choice("bcdfghklmnp") for _ in range(6))
        texts.append(rng.choice([
            f"write to {name}@mail{i % 9}.org or call +1 (212) 555-{i:04d} today", f"host at 91.{i % 250}.7.{i % 199} of {name}@site.com",
            f"phone (212) 555-{i:04d} or mail {name}@work.net please", f"user {name}@host.io password={name}{i}zz and more",
            f"mail {name} [at] home [dot] com, tel (415) 555-{i:04d}",
        ]))
    good = [
        "account DE89 3702 0502 0000 0123 00 and mail kim@home.org", "Dear Maria Lopez, call +1 (415) 555-0101",
        "tel (303) 555-0142 or lee@work.org", "login kim@home.org password=9f8e7d6c5b4a here",
    ]
    bad = ["order part4155550142x 000-00-0000 page", "item 666-00-0000_x of this version"]
    got = check(make_docs, texts + good + bad)
    kinds = [{s.kind for s in got[len(texts) + i] if not s.base} for i in range(len(good))]
    assert "phone" in kinds[2] and "secret" in kinds[3] and "person" in kinds[1]
    assert all(not [s for s in got[len(texts) + len(good) + i] if not s.base] for i in range(len(bad)))
    added = sum(1 for i, t in enumerate(texts) if "[at]" in t and any(s.kind == "email" and not s.base for s in got[i]))
    assert added == sum("[at]" in t for t in texts)


def test_estimation_recovers_reliabilities():
    """Votes made with known rates; the estimates come near and the better labelers count more."""
    rng = np.random.default_rng(3)
    n, rates = 20_000, np.array([(0.95, 0.1), (0.85, 0.3), (0.7, 0.2), (0.9, 0.15), (0.6, 0.4), (0.8, 0.25)])
    truth, kinds = rng.random(n) < 0.6, rng.integers(0, 2, n)
    votes = np.where(rng.random((n, 6)) < np.where(truth[:, None], rates[:, 0], rates[:, 1]), pii.YES, pii.NO)
    votes[rng.random((n, 6)) < 0.2] = pii.NOTHING
    patterns, where, counts = np.unique(np.column_stack([kinds, votes]), axis=0, return_inverse=True, return_counts=True)
    p, got, share = pii.estimate(patterns[:, 0], patterns[:, 1:], counts.astype(float))
    assert np.abs(got - rates).max() < 0.05 and np.abs(share[:2] - 0.6).max() < 0.05
    right = ((p[where.ravel()] > 0.5) == truth).mean()
    majority = ((votes == pii.YES).sum(1) > (votes == pii.NO).sum(1)) == truth
    assert right > 0.9 and right > majority.mean()


def test_classifier_fits_probabilities():
    rng = np.random.default_rng(4)
    values = np.column_stack([rng.integers(0, size, 3000) for _, size in pii.FEATURES])
    target = 1 / (1 + np.exp(-(1.5 * (values[:, 5] == 1) - 2.0 * (values[:, 4] == 2) + 0.5)))
    bias, weights = pii.fit(values, target, np.full(3000, 5.0))
    got = bias + sum(w[values[:, n]] for n, w in enumerate(weights))
    assert np.abs(1 / (1 + np.exp(-got)) - target).max() < 0.03
    with pytest.raises(IndexError):
        weights[0][len(pii.KINDS)]
