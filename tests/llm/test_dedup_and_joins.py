"""Duplicate finding against brute force."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tallyloom.llm import components, exact_dedup, ngram_join, passage_dedup


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("budget", [1, 64 << 20])
def test_exact_dedup_with_and_without_spills(make_docs, odd_rows, budget):
    rows = exact_dedup.mark_copies(make_docs(odd_rows), budget=budget).collect()
    assert len(rows) == len(odd_rows)
    classes = collections.defaultdict(list)
    for i, text, *_ in odd_rows:
        classes[hashlib.sha256(normal(text).encode()).hexdigest()].append(i)
    for row in rows:
        ids = classes[row.text_sha256]
        named = [i for i in ids if i is not None]
        assert row.group_size == len(ids)
        assert row.keep_id == (min(named) if named else None)
    for sha, ids in classes.items():
        assert sum(r.kept for r in rows if r.text_sha256 == sha) == 1


def test_exact_dedup_keeps_columns_and_one_row_per_text(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [normal(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({normal(t) for _, t, *_ in odd_rows})
    assert {r["__row"] for r in kept.collect()} == {"own"}
    assert exact_dedup.mark_copies(make_docs([])).count() == 0


def test_grace_buckets_go_deeper_until_they_fit(tmp_path):
    records = [(h, f"text {k}", k, 1) for k in range(300) for h in (k % 3,)]
    found = list(exact_dedup.grace_classes(records + records, 1, str(tmp_path)))
    assert sorted((e[1], e[2], e[3]) for e in found) == sorted((f"text {k}", k, 2) for k in range(300))


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_components(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            label[find(j)] = find(i)
    ids = collections.defaultdict(list)
    for i, row in enumerate(rows):
        if row[0] is not None:
            ids[find(i)].append(row[0])
    return sorted(
        ((row[0], len(sets[i]), min(ids[find(i)], default=None)) for i, row in enumerate(rows)), key=str
    )


def near_copies(seed, families=12, size=9):
    rng = random.Random(seed)
    rows, common = [], " ".join(f"c{i}" for i in range(60))
    for f in range(families):
        words = [f"f{f}x{rng.randrange(400)}" for _ in range(rng.choice([4, 20, 90, 160]))]
        for _ in range(size):
            copy = list(words)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"n{rng.random()}"
            rows.append((len(rows), " ".join(copy) + (f" {common}" if rng.random() < 0.4 else ""), "en", "a"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_matches_all_pairs(make_docs, seed):
    rows = near_copies(seed)
    got = ngram_join.near_components(make_docs(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(rows)


def test_ngram_join_on_odd_rows(make_docs, odd_rows):
    got = ngram_join.near_components(make_docs(odd_rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(odd_rows)
    assert ngram_join.near_components(make_docs([])).count() == 0


def test_one_document_of_each_component_stays(make_docs):
    rows = near_copies(5, families=5, size=6)
    docs = make_docs(rows)
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute_components(rows)})


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in components.components(links, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_compact_windows_are_those_of_every_stretch():
    import numpy as np

    rng = np.random.default_rng(3)
    for n, width in ((1, 1), (5, 6), (40, 7), (200, 46)):
        hashes = rng.integers(0, 1 << 60, n, dtype=np.uint64)
        first, center, last = passage_dedup.compact_windows(hashes, width)
        held = {int(c): (int(a), int(b)) for a, c, b in zip(first, center, last)}
        keys = [(int(h) >> 26, i) for i, h in enumerate(hashes)]
        for a in range(n - width + 1):
            for b in range(a + width - 1, n):
                c = min(range(a, b + 1), key=keys.__getitem__)
                assert held[c][0] <= a and b <= held[c][1]
        assert all(b - a + 1 >= width for a, b in held.values())


def test_repeated_passages_are_found_and_near_ones_verified(make_docs):
    rng = random.Random(9)
    word = lambda: f"v{rng.randrange(5000)}"
    passage = [word() for _ in range(70)]
    edited = passage[:30] + ["other"] + passage[31:]
    rows = []
    for i in range(30):
        text = [word() for _ in range(rng.randrange(60, 200))]
        if i < 8:
            at = rng.randrange(len(text))
            text[at:at] = passage if i % 2 else edited
        rows.append((i, " ".join(text), "en", "a"))
    rows += [(90, None, None, None), (91, "", "en", "a"), (92, " ".join(passage[:49]), "en", "a")]
    got = passage_dedup.repeated_passages(make_docs(rows)).collect()
    assert {x for r in got for x in (r.doc_id, r.other_id)} == set(range(8))
    texts = {i: (t or "").split() for i, t, *_ in rows}
    for r in got:
        a = shingles(" ".join(texts[r.doc_id][r.first_word : r.last_word]))
        b = shingles(" ".join(texts[r.other_id][r.other_first : r.other_last]))
        assert len(a & b) / len(a | b) == pytest.approx(r.similarity) and r.similarity >= 0.75
    assert passage_dedup.repeated_passages(make_docs([])).count() == 0


def shared_runs(rows, size=50):
    """For each text, the words inside a run of ``size`` words that another text holds."""
    held = collections.defaultdict(set)
    texts = [(i, t.split()) for i, t, *_ in rows]
    for i, w in texts:
        for s in range(len(w) - size + 1):
            held[tuple(w[s : s + size])].add(i)
    inside = collections.defaultdict(set)
    for i, w in texts:
        for s in range(len(w) - size + 1):
            if len(held[tuple(w[s : s + size])]) > 1:
                inside[i].update(range(s, s + size))
    return inside


def test_passages_are_found_among_many_that_share_a_part(make_docs):
    rng = random.Random(4)
    fresh = lambda n: [f"u{rng.random()}" for _ in range(n)]
    boiler, rows = fresh(35), []
    tails = [fresh(15) for _ in range(12)]
    for i in range(72):
        tail = tails[i // 6] if i % 6 in (1, 4) else fresh(15)
        rows.append((i, " ".join(fresh(40) + boiler + tail + fresh(40)), "en", "a"))
    got = passage_dedup.repeated_passages(make_docs(rows)).collect()
    expected = shared_runs(rows)
    assert len(expected) == 24
    seen = collections.defaultdict(set)
    for r in got:
        seen[r.doc_id].update(range(r.first_word, r.last_word))
        seen[r.other_id].update(range(r.other_first, r.other_last))
    for i, places in expected.items():
        assert places <= seen[i]
    texts = {i: t.split() for i, t, *_ in rows}
    for r in got:
        if r.similarity == 1:
            assert texts[r.doc_id][r.first_word : r.last_word] == texts[r.other_id][r.other_first : r.other_last]


@pytest.mark.parametrize("repeated, gap", [(1, 3), (12, 3), (12, 30), (30, 90)])
def test_passage_whose_beginning_stands_earlier_is_one_segment(repeated, gap):
    import numpy as np

    rng = np.random.default_rng(6)
    fresh = lambda n: rng.integers(-(1 << 62), 1 << 62, n)
    passage = fresh(46)
    edited = np.concatenate([passage[:20], fresh(2), passage[22:]])
    for shown in (passage, edited):
        x = np.concatenate([fresh(9), shown, fresh(9)])
        y = np.concatenate([fresh(5), passage[:repeated], fresh(gap), passage, fresh(7)])
        at = 5 + repeated + gap
        assert [s[:4] for s in passage_dedup.segments(x, y, 46, 0.75)] == [(9, 55, at, at + 46)]
    twice = np.concatenate([passage[:20], fresh(5), passage, fresh(5), passage[20:]])
    assert [s[:4] for s in passage_dedup.segments(passage, twice, 46, 0.75)] == [(0, 46, 25, 71)]
    same = np.full(5000, 7)
    assert passage_dedup.segments(same, same[:4000], 46, 0.75)[0][4] == 1


def test_many_members_of_one_group_are_rows_of_their_own(make_docs, monkeypatch):
    from pyspark.sql import types as T

    stored = []
    durable = ngram_join.durable
    monkeypatch.setattr(ngram_join, "durable", lambda df, *a: stored.append(durable(df, *a)) or stored[-1])
    words = [f"g{i}" for i in range(200)]
    rows = [(i, " ".join(words[:100] + [f"n{i}"] + words[101:]), "en", "a") for i in range(60)]
    got = ngram_join.near_components(make_docs(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(rows)
    kinds = [f.dataType for df in stored for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    assert kinds and not any(isinstance(k.elementType, T.StructType) for k in kinds)


def test_large_buckets_come_in_pieces_and_blocks():
    import numpy as np
    import pandas as pd

    token = np.repeat([3, 5, 9], [1, 40, 4])
    frame = pd.DataFrame({"token": token, "gid": np.arange(45)})
    pieces = [p for p in ngram_join._buckets((frame.iloc[a : a + 7] for a in range(0, 45, 7)), 10) if len(p)]
    assert max(map(len, pieces)) < 20 and sorted({g for p in pieces for g in p["gid"]}) == list(range(45))
    for before, after in zip(pieces, pieces[1:]):
        if before["token"].iloc[-1] == after["token"].iloc[0]:
            assert before["gid"].iloc[-1] == after["gid"].iloc[0]
    main = (np.arange(45) % 40) > 3
    frame = frame.assign(main=main).sort_values(["token", "main", "gid"])
    sides = list(ngram_join._sides((frame.iloc[a : a + 7] for a in range(0, 45, 7)), ["gid"], 10))
    assert [g for *_, (c,) in sides for g in c] == list(frame["gid"]) and sum(fresh for fresh, *_ in sides) == 3
    assert all(len(c) < 20 for _, is_main, (c,) in sides if is_main)


def test_rows_repeated_over_batches_are_compared_once(make_docs, monkeypatch):
    stored = collections.defaultdict(list)
    for module in (ngram_join, passage_dedup):
        durable = module.durable
        monkeypatch.setattr(module, "durable", lambda df, label, f=durable: stored[label].append(f(df, label)) or stored[label][-1])
    words = [f"r{i}" for i in range(150)]
    texts = [" ".join(words), " ".join(words[:70] + ["other"] + words[71:])]
    docs = make_docs([(7, texts[0], "en", "a"), (None, texts[1], "en", "a")]).repartition(1)
    docs = docs.union(docs).union(docs).union(docs)
    got = ngram_join.near_components(docs).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == [("7", 7)] * 4 + [("None", 7)] * 4
    found = passage_dedup.repeated_passages(docs).collect()
    assert {x for r in found for x in (r.doc_id, r.other_id)} == {7, None}
    for label, name in (("pair-sets", "key"), ("passage-shingles", "id"), ("passage-cuts", "doc_id")):
        for df in stored[label]:
            assert df.count() == df.select(name).distinct().count() <= 2
    assert max(df.count() for df in stored["pairs"]) == 1


def test_sketches_never_rule_out_what_two_sets_share():
    draw = np.random.default_rng(3)
    sizes = (1, 60, 500, 700, 1500, 3000, 90_000)
    sets, packed = [], []
    for size in sizes:
        shared = draw.integers(0, 1 << 40, size // 2)
        for _ in range(2):
            sets.append(np.unique(np.append(shared, draw.integers(0, 1 << 40, size - size // 2))))
            packed.append(ngram_join._sketch(sets[-1]))
    # A hot cell needs steps above one.
    sets.append(np.arange(1000) * ngram_join.CELLS[-1])
    packed.append(ngram_join._sketch(sets[-1]))
    sketches = ngram_join._Sketches(np.array(packed, object))
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    met = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
    bound = sketches.common(i, j)
    assert (bound >= met).all()
    # Sets of one size that have nothing in common are told apart from near copies.
    for size in (60, 500, 700, 1500):
        apart = [ngram_join._sketch(draw.integers(0, 1 << 40, size)) for _ in range(2)]
        bound = ngram_join._Sketches(np.array(apart, object)).common(np.array([0]), np.array([1]))
        assert 7 * bound[0] < 6 * size


@pytest.mark.parametrize("piece", [4096, 8])
def test_edited_passages_are_found_among_many_that_share_a_part(make_docs, monkeypatch, piece):
    monkeypatch.setattr(passage_dedup, "PIECE", piece)
    rng = random.Random(14)
    fresh = lambda n: [f"e{rng.random()}" for _ in range(n)]
    boiler, rows = fresh(35), []
    tails = [fresh(25) for _ in range(12)]
    for i in range(72):
        tail = tails[i // 6] if i % 6 in (1, 4) else fresh(25)
        if i % 6 == 4:
            tail = tail[:12] + fresh(1) + tail[13:]
        rows.append((i, " ".join(fresh(40) + boiler + tail + fresh(40)), "en", "a"))
    assert not shared_runs(rows)
    got = passage_dedup.repeated_passages(make_docs(rows)).collect()
    assert {frozenset((r.doc_id, r.other_id)) for r in got} == {frozenset((6 * g + 1, 6 * g + 4)) for g in range(12)}
    texts = {i: t.split() for i, t, *_ in rows}
    for r in got:
        a, b = (shingles(" ".join(texts[i][p:q])) for i, p, q in (
            (r.doc_id, r.first_word, r.last_word), (r.other_id, r.other_first, r.other_last)
        ))
        assert len(a & b) / len(a | b) == pytest.approx(r.similarity) and r.similarity >= 0.75


def test_every_text_of_many_edited_passages_is_connected(make_docs):
    rng = random.Random(15)
    fresh = lambda n: [f"c{rng.random()}" for _ in range(n)]
    passage, rows = fresh(60), []
    for i in range(50):
        at = rng.randrange(15, 45)
        rows.append((i, " ".join(fresh(45) + passage[:at] + fresh(1) + passage[at + 1 :] + fresh(45)), "en", "a"))
    # Edited twice, so like some of the others only.
    rows.append((50, " ".join(fresh(45) + passage[:20] + fresh(1) + passage[21:40] + fresh(1) + passage[41:] + fresh(45)), "en", "a"))
    # Any two shared shingle sets of the passage, cut to 50 words or more, that meet the threshold.
    texts = [t.split() for _, t, *_ in rows]

    def alike(x, y):
        return any(
            len(a & b) * 4 >= 3 * len(a | b)
            for first in range(45, 56) for last in range(first + 50, 106)
            for a, b in [(shingles(" ".join(x[first:last])), shingles(" ".join(y[first:last])))]
        )

    links = [(i, j) for i in range(51) for j in range(i) if (i + j) % 3 == 0 and alike(texts[i], texts[j])]
    got = passage_dedup.repeated_passages(make_docs(rows)).collect()
    label = list(range(51))
    for r in got:
        a, b = label[r.doc_id], label[r.other_id]
        label = [min(a, b) if v in (a, b) else v for v in label]
    assert links and all(label[i] == label[j] for i, j in links)


def test_zones_of_repeated_words_are_compared_only_where_they_can_be_similar(monkeypatch):
    rng = np.random.default_rng(8)
    numbers, zones = {}, []
    for _ in range(90):
        words = [0] * rng.integers(24, 48)
        while len(words) < 57:
            words += [int(rng.integers(1, 7))] * rng.integers(1, 14)
        row = [numbers.setdefault(tuple(words[k : k + 5]), len(numbers)) for k in range(53)]
        zones.append(np.array(row, "<u4").tobytes())
    keys, none = np.arange(90), np.zeros(90, np.int64)
    calls, segments = [], passage_dedup.segments
    monkeypatch.setattr(passage_dedup, "segments", lambda *a: calls.append(1) or segments(*a))
    run = passage_dedup._shared(46, 0.75)[1]
    made = passage_dedup._Zones(keys, none, keys, none, none, np.array(zones, object), 46, 0.75, run)
    rows = made.rows()
    assert len(calls) < 400
    # Every zone shares the run of the first word; pairs that link whichever of the two comes first.
    plain = [np.frombuffer(z, "<u4").astype(np.int64) for z in zones]
    alike = lambda i, j: segments(plain[i], plain[j], 46, 0.75)
    links = {(i, j) for i in range(90) for j in range(i) if alike(i, j) and alike(j, i)}
    assert len(links) > 10 and all(made._root(i) == made._root(j) for i, j in links)
    assert len(rows) < len(links) + 90


def test_words_of_connected_zones_are_all_in_rows():
    rng = np.random.default_rng(21)
    fresh = lambda n: rng.integers(0, 1 << 32, n, dtype="<u4")
    zones = []
    for _ in range(6):
        passage, other = fresh(105), fresh(50)
        edited = passage[20:].copy()
        edited[36:41] = fresh(5)
        # Rows join the first two by the beginning of the passage and the last two by other words.
        zones += [passage, np.concatenate([passage[:50], other]), np.concatenate([edited, other])]
    n = len(zones)
    keys, at, none = np.arange(n), np.arange(n) * 1000, np.zeros(n, np.int64)
    run = passage_dedup._shared(46, 0.75)[1]
    made = passage_dedup._Zones(keys, at, keys, at, none, np.array([z.tobytes() for z in zones], object), 46, 0.75, run)
    held = collections.defaultdict(set)
    for x, y, a, b, c, d, _ in made.rows():
        held[x].update(range(a - at[x], b - at[x] - 4))
        held[y].update(range(c - at[y], d - at[y] - 4))
    found = 0
    for i in range(n):
        for j in range(i):
            for a, b, c, d, _ in passage_dedup.segments(zones[i].astype(np.int64), zones[j].astype(np.int64), 46, 0.75):
                found += 1
                assert held[i] >= set(range(a, b)) and held[j] >= set(range(c, d))
    assert found == 6 * 3
