"""Licence scan, decontamination, source mix and token rollup against brute force."""

import collections
import hashlib
import random
import re

from tallyloom.llm import decontamination, license_scan, source_mix, token_rollup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def test_license_phrases_and_notices(make_docs, odd_rows):
    mit = next(t for t in license_scan.NOTICES if t.label == "mit-notice").text
    filler = " ".join(f"x{i}" for i in range(61))
    rows = odd_rows + [
        (20, filler + " the GNU General\nPublic-License, MIT License. mit license", "en", "a"),
        (21, f"{filler} {mit.replace('charge', 'fee')}", "en", "a"), (22, "gnu general license public", "en", "a"),
        (23, "cc by-nc and CC BY", "en", "a"), (23, "cc by-nc and CC BY", "en", "a"),
    ]
    got = license_scan.digest(license_scan.scan(make_docs(rows))).collect()
    assert len(got) == len(rows)
    expected = collections.Counter()
    for i, text, *_ in rows:
        w = words(text)
        places = [
            (s, t.label) for t in license_scan.BASE_PHRASES for s in range(len(w))
            if w[s : s + len(t.words)] == t.words
        ]
        starts = [s for s, _ in places]
        expected[(i, len(w), len(places), min(starts, default=None), max(starts, default=None),
                  ",".join(sorted({name for _, name in places})))] += 1
    assert collections.Counter(
        (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got
    ) == expected
    by_id = {r.doc_id: r for r in got}
    assert by_id[20].labels == "gpl,mit" and by_id[20].score == 1.0
    assert by_id[21].labels == "mit-notice" and 0.85 <= by_id[21].score < 1
    assert by_id[22].labels == "" and by_id[22].score == 0
    assert by_id[23].labels == "cc-by,cc-by-nc"
    assert license_scan.scan(make_docs([])).count() == 0


def brute_contamination(rows, items):
    result = []
    for i, text, *_ in rows:
        w, hit, found = words(text), set(), set()
        for item, item_text in items:
            v = words(item_text)
            n = min(10, len(v))
            windows = {tuple(v[s : s + n]) for s in range(len(v) - n + 1)} if n else set()
            for s in range(len(w) - n + 1):
                if n and tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    found.add(item)
        ids = ",".join(sorted(str(x) for x in found))
        result.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return result


def test_contamination_equals_every_window(spark, make_docs, odd_rows):
    rng = random.Random(4)
    item = lambda n: [f"q{rng.randrange(40)}" for _ in range(n)]
    items = [(k, " ".join(item(n))) for k, n in enumerate([30, 12, 10, 9, 3, 1, 25])]
    items += [(50, None), (51, "!!"), (52, "a a a a a a a a a a a a a a"), (53, items[0][1])]
    rows = list(odd_rows)
    for k in range(60):
        text = item(rng.randrange(0, 60))
        if k % 3:
            v = items[k % len(items)][1] or ""
            cut = v.split()
            a = rng.randrange(max(1, len(cut)))
            at = rng.randrange(len(text) + 1)
            text[at:at] = [x.upper() for x in cut[a : a + rng.choice([9, 10, 11, 30])]]
        rows.append((100 + k, ", ".join(text), "en", "a"))
    rows.append((200, "a " * 40, "en", "a"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs(rows)
    got = decontamination.contamination(docs, bench).drop("text_hash").collect()
    expected = brute_contamination(rows, items)
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    kept = decontamination.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((e[0] for e in expected if not e[-1]), key=str)
    assert not any(r.contaminated for r in decontamination.contamination(docs, bench.limit(0)).collect())
    assert decontamination.contamination(make_docs([]), bench).count() == 0


def test_long_benchmark_items_are_not_broadcast(spark, make_docs, monkeypatch):
    sent = []
    broadcast = decontamination.F.broadcast
    monkeypatch.setattr(decontamination.F, "broadcast", lambda df: sent.append(df.columns) or broadcast(df))
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 30_000, raising=False)
    long = " ".join(f"b{i}" for i in range(3000))
    docs = make_docs([(1, "before " + " ".join(f"b{i}" for i in range(100, 140)), "en", "a")])
    for text, small in ((long, False), (long[:900], True)):
        sent.clear()
        hits = decontamination.hit_windows(docs, spark.createDataFrame([(1, text)], "item_id long, text string"))
        assert hits.count() == 31 and any("i_window" in columns for columns in sent) == small


def test_repetitive_texts_take_time_in_proportion(spark, make_docs):
    """One word many times, in documents and in items: each place is looked at once."""
    items = spark.createDataFrame([(1, "a " * 14), (2, "a " * 5000), (3, "a b " * 3000), (4, "a " * 3)], "item_id long, text string")
    docs = make_docs([(1, "a " * 100_000, "en", "a"), (2, "a b " * 50_000, "en", "a"), (3, "b", "en", "a")] + [(4, "a " * 20_000, "en", "a")] * 5)
    got = {r.doc_id: r for r in decontamination.contamination(docs, items).collect()}
    assert [got[i].n_hit for i in (1, 2, 3, 4)] == [100_000, 100_000, 0, 20_000]
    assert [got[i].n_items for i in (1, 2, 3, 4)] == [3, 1, 0, 3]


def fill_by_turns(sizes, weights, cap=3):
    """Share by weight, cap, share the rest anew until none is above."""
    full, left = {}, dict(zip(range(len(sizes)), sizes))
    total = float(sum(sizes))
    while left:
        rate = (total - sum(full.values())) / sum(weights[i] for i in left)
        over = [i for i in left if rate * weights[i] >= cap * sizes[i]]
        if not over:
            return [full.get(i, rate * weights[i]) for i in range(len(sizes))]
        for i in over:
            full[i] = cap * left.pop(i)
    return [full[i] for i in range(len(sizes))]


def test_mix_targets_and_takes(spark, make_docs, odd_rows):
    rng = random.Random(8)
    rows = odd_rows + [
        (1000 + i, "w " * rng.randrange(0, 30), "en", rng.choice(["a", "b", "c", "d", "e", None, "B"])) for i in range(400)
    ]
    labels = spark.createDataFrame([(1000 + i, i % 2, 0) for i in range(200)] + [(1000, None, None)], "doc_id long, quality int, toxic int")
    docs = make_docs(rows)
    got = source_mix.plan_mix(docs, labels).collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for _, text, _, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted((s for s in size if s is not None)) + [None]
    targets = dict(zip(order, fill_by_turns([size[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])))
    taken = collections.Counter()
    for r in got:
        assert r.source_size == size[r.source]
        assert abs(r.target - targets[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for source, target in targets.items():
        assert target - 1.001 <= taken[source] <= target + 1e-6
    again = source_mix.plan_mix(docs.repartition(5), labels).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    mixed = source_mix.mix_sources(docs, labels)
    assert mixed.columns == [*docs.columns, "mix_size", "mix_taken"]
    assert source_mix.plan_mix(make_docs([]), labels).count() == 0


def test_mix_of_one_row_that_holds_a_third_of_all(spark, make_docs, monkeypatch):
    monkeypatch.setattr(source_mix, "COPIES_PER_TASK", 7)
    rows = [(5, "one two three", "en", "a")] * 100 + [(5, "another text here", "en", "a")] * 2 + [
        (10 + i, "w " * (i % 9), "en", "ab"[i % 2]) for i in range(200)
    ]
    labels = spark.createDataFrame([(5, 0, 0)], "doc_id long, quality int, toxic int")
    docs = make_docs(rows)
    alike = source_mix._alike(docs, labels, (5, 2, 1), 3, 1, "doc_id")
    assert sorted(r.copies for r in alike.where("doc_id = 5").collect()) == [2, 100]
    got = source_mix.plan_mix(docs, labels).collect()
    assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((i, len(t.split())) for i, t, _, _ in rows)
    for source in "ab":
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) < 1.001
        epochs = int(mine[0].target // mine[0].source_size)
        assert all(epochs * r.size <= r.taken <= min(3, epochs + 1) * r.size for r in mine)
        # Only one row is taken in part.
        assert sum(r.taken % r.size > 0 for r in mine if r.size) <= 1
    mixed = source_mix.mix_sources(docs, labels)
    copies = [r.mix_taken for r in mixed.where("text = 'one two three'").collect()]
    per_copy = [r.taken for r in got if r.doc_id == 5]
    assert len(copies) in (0, 100) and len(set(copies)) <= 1
    assert not copies or min(per_copy) <= copies[0] <= max(per_copy)


def test_rollup_counts_each_batch_once(spark, make_docs, odd_rows, tmp_path):
    from pyspark.sql import functions as F

    store = token_rollup.Rollup(spark, str(tmp_path / "store"))
    assert store.totals().count() == 0
    docs = make_docs(odd_rows)
    first = token_rollup.changes(docs, 1, "t1", F.lit(10))
    store.commit(1, first)
    store.commit(1, first)
    assert store.totals().agg(F.sum("docs")).first()[0] == len(odd_rows)
    store.commit(2, token_rollup.changes(docs, -1, "t1", F.lit(10)).union(token_rollup.changes(docs, 1, "t1", F.lit(None))))
    store.fold(2)
    store.fold(2)
    store.commit(1, first)
    totals = {(r.source, r.lang): (r.docs, r.tokens) for r in store.totals().collect()}
    assert totals == {k: (n, 0) for k, n in collections.Counter((s, lang) for _, _, lang, s in odd_rows).items()}
    store.commit(3, token_rollup.changes(docs, -1, "t1", F.lit(0)))
    assert store.totals().count() == 0
