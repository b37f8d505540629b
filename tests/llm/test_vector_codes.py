"""Vector codes against comparing every part with every entry."""

import math

import numpy as np
import pytest

from tallyloom.llm import vector_codes as vc


def plain(rows, parts, k, rounds):
    """Codes, errors and entries of (id, vector) rows, by all comparisons in Python integers."""
    kept = sorted(
        ((i, [math.floor(256 * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)),
        key=lambda r: (r[0] is None, r[0] or 0, r[1]),
    )
    if not kept:
        return [], []
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in kept]
    books = [[c[p] for c in cut[:k]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            mine = [near(c[p], book)[1] for c in cut]
            books[p] = [
                [sum(col) // len(col) for col in zip(*own)] if (own := [c[p] for c, m in zip(cut, mine) if m == n]) else e
                for n, e in enumerate(book)
            ]
    best = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    return [(i, [e for _, e in b], sum(d for d, _ in b)) for (i, _), b in zip(kept, best)], books


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, label, "own", 1.5) for i, v, label in rows],
        "vec_id long, embedding array<float>, label int, ints string, error double",
    )


def same(spark, rows, **options):
    options = {"parts": 4, "n_entries": 5, "rounds": 2, "n_pivots": 2} | options
    coded, books = vc.compress(frame(spark, rows), **options)
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v, _ in rows]
    want, entries = plain(exact, options["parts"], options["n_entries"], options["rounds"])
    got = sorted(((r.vec_id, r.code, r.error) for r in coded.collect()), key=str)
    assert got == sorted(want, key=str)
    if want:
        assert books.entries.tolist() == entries
    return coded, books


@pytest.mark.parametrize("pivots", [1, 3, 9])
def test_codes_equal_all_comparisons(spark, pivots):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(0, 0.2, 8).tolist(), int(i) % 3) for i in rng.permutation(300)]
    same(spark, rows, n_pivots=pivots)


def test_nulls_ties_repeats_and_infinite_components(spark):
    flat = [0.5] * 8
    rows = [(i, flat, 1) for i in range(6)] + [
        (7, None, 1), (8, [None] + flat[1:], 1), (9, [float("nan")] + flat[1:], None), (10, [float("inf")] + flat[1:], None),
        (11, [], 2), (3, [-x for x in flat], None), (3, [-x for x in flat], None), (None, [0.25] * 8, None), (12, [0.1, -0.1] * 4, 2),
    ]
    coded, _ = same(spark, rows)
    sums = {}
    for r in vc.with_group_error(coded).collect():
        sums.setdefault(r.label, set()).add(r.label_error)
    by_label = {}
    for r in coded.collect():
        by_label[r.label] = by_label.get(r.label, 0) + r.error
    assert sums == {k: {v} for k, v in by_label.items()} and None in sums


def test_fewer_vectors_than_entries_and_empty_tables(spark):
    same(spark, [(2, [1.0, 2.0, 3.0, 4.0], 0), (1, [-1.0, 0.0, 0.5, 2.5], 0)], n_entries=64, n_pivots=4)
    coded, books = same(spark, [])
    assert coded.count() == 0 and books.entries.size == 0 and vc.with_group_error(coded).count() == 0
    only_null, _ = same(spark, [(1, None, 0)])
    assert only_null.count() == 0


def test_other_lengths_are_left_out_and_uneven_ones_refused(spark):
    coded, _ = vc.compress(frame(spark, [(1, [1.0] * 4, 0), (2, [1.0] * 8, 0)]), parts=4)
    assert [r.vec_id for r in coded.collect()] == [1]
    with pytest.raises(ValueError):
        vc.compress(frame(spark, [(1, [1.0] * 5, 0)]), parts=4)


def test_huge_components_are_held_within_bounds(spark):
    coded, _ = vc.compress(frame(spark, [(1, [3e38] * 4, 0), (2, [-3e38] * 4, 0), (3, [0.0] * 4, 0)]), parts=4, n_entries=1)
    assert all(r.error >= 0 for r in vc.with_group_error(coded).collect())


def test_bounds_leave_most_comparisons_out():
    rng = np.random.default_rng(5)
    x = rng.normal(0, 60, (400, 4, 4)).astype(np.int64)
    entries = x[:64].transpose(1, 0, 2)
    pivots = vc._pivots(entries, 4)
    chosen, best, tried = vc.nearest(x, vc._to_pivots(x, pivots).astype(np.float32), entries, pivots)
    away = ((x[:, :, None] - entries[None]) ** 2).sum(-1)
    assert (chosen == away.argmin(-1)).all() and (best == away.min(-1)).all()
    assert tried < 0.35 * away.size
