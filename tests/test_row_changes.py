import random
import shutil
from collections import Counter

import pytest

from tallyloom.operators.row_changes import changed_rows, differing_buckets, publish_state

SCHEMA = "id long, part string, row string, bucket int"


def published(spark, root, name, rows, depth=2):
    path = f"{root}/{name}"
    publish_state(spark.createDataFrame(rows, SCHEMA), path, ["id", "part"], depth)
    return path


def expected(before, after):
    old, new = Counter(before), Counter(after)
    found = []
    for row in {*old, *new}:
        if old[row] != new[row]:
            key = row[:2]
            in_old, in_new = (any(r[:2] == key for r in side) for side in (old, new))
            change = "edit" if in_old and in_new else "insert" if in_new else "delete"
            found.append((change, "before" if old[row] > new[row] else "after", abs(old[row] - new[row]), row))
    return sorted(found, key=repr)


def found(spark, before, after):
    rows = changed_rows(spark, before, after).collect()
    return sorted(((r.change, r.side, r.copies, tuple(r.row)) for r in rows), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_changes_equal_those_of_counted_rows(spark, tmp_path, seed):
    draw = random.Random(seed)

    def rows():
        return [
            (draw.choice([None, *range(20)]), draw.choice(["a", "", None]), draw.choice(["x", None]), draw.choice([1, None]))
            for _ in range(60)
        ]

    kept = rows() * 2
    before, after = kept + rows(), kept + rows()
    a, b = (published(spark, tmp_path, n, r) for n, r in (("a", before), ("b", after)))
    assert found(spark, a, b) == expected(before, after)


def test_one_edit_reads_one_bucket(spark, tmp_path):
    before = [(i, "p", f"v{i}", i) for i in range(2000)]
    after = [(i, "p", "new" if i == 77 else f"v{i}", i) for i in reversed(range(2000))]
    a, b = (published(spark, tmp_path, n, r) for n, r in (("a", before), ("b", after)))
    buckets = differing_buckets(spark, a, b)
    assert len(buckets) == 1
    read = spark.read.parquet(f"{a}/rows").where(f"bucket = {buckets[0]}").count()
    assert 1 <= read < 40
    # The other buckets are not even opened.
    for path in (a, b):
        for folder in (tmp_path / path.rsplit("/", 1)[1] / "rows").glob("bucket=*"):
            if folder.name != f"bucket={buckets[0]}":
                for file in folder.glob("*.parquet"):
                    file.write_bytes(b"unreadable")
                for check in folder.glob(".*.crc"):
                    check.unlink()
    assert found(spark, a, b) == expected(before, after)


def test_equal_empty_and_unlike_states(spark, tmp_path):
    rows = [(1, "a", "x", 1), (1, "a", "x", 1), (None, None, None, None)]
    a, b, none = (published(spark, tmp_path, n, r, 1) for n, r in (("a", rows), ("b", rows[::-1]), ("none", [])))
    assert differing_buckets(spark, a, b) == [] and found(spark, a, b) == []
    assert found(spark, none, a) == expected([], rows)
    assert found(spark, a, none) == expected(rows, [])
    assert found(spark, none, none) == []
    deeper = published(spark, tmp_path, "deeper", rows, 2)
    with pytest.raises(ValueError):
        changed_rows(spark, a, deeper)
    with pytest.raises(ValueError):
        publish_state(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/c", ["absent"])
