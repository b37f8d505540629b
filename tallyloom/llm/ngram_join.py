"""Near duplicates by a grouped prefix join on five-word shingles.

Two texts link when 100 times their common shingles is at least 75 times all their shingles, or
7 * common >= 3 * (n1 + n2).  With shingles in one order, rarest first, linked texts share one of
their first n - ceil(3 n / 4) + 1.

*Order.*  Tasks hash the shingles of their texts and deal them out by hash in packed rows; there
the texts that hold a shingle are counted, and only shingles held twice go back.  A text learns so
how many of its shingles are its own, which come first and match nothing, and which of the others
belong to its prefix.  Copies within a task are dealt out once.

*Groups.*  Texts with the same prefix and size form one group, and groups meet in the bucket of each
prefix shingle.

*Verification.*  First every group is compared with the smallest of its bucket and a few others, and
every member with its group: a few pairs per entry, however large a bucket is.  What links joins
components.  Members outside the largest component of a bucket next meet their nearest partners by
sketch.  Then every pair left in a bucket whose ends lie in different components is compared too,
if sizes, places and sketches of the shared shingles allow a link.  All pairs of a bucket are so
decided: compared, ruled out or known to be connected, and no component misses a link.  Comparisons
use whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm.components import components
from tallyloom.llm.packing import pack, unpack
from tallyloom.llm.registry import query, table
from tallyloom.llm.shingles import SpanHasher, run_hashes, space_words
from tallyloom.llm.text import row_name, unused
from tallyloom.session import durable

BATCH_SHINGLES = 1 << 19
BATCH_DOCS = 1 << 15
BROADCAST_ROWS = 200_000
NO_ID = -(1 << 63)
KEY_BITS = 20
DRAWS = 4
CELLS = (64, 128, 256)
CELL_LOAD = 8
BLOCK_ROWS = 1 << 14
_DEALT = "part int, batch long, kind int, payload binary"


def shingle_set(hasher: SpanHasher, text: str | None) -> np.ndarray:
    return np.unique(run_hashes(hasher, space_words(text)))


def _deal(parts: int):
    """Packed postings by part of the hash, and one row per batch with its documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = SpanHasher()
        first = TaskContext.get().partitionId() << 24
        batches = 0
        ids, hashes, sizes, same, sets, seen, total = [], [], [], [], [], {}, 0
        same_slot: dict[int, int] = {}

        def rows() -> pd.DataFrame:
            batch = first + batches
            docs = pack(np.array(ids, "<i8"), np.array(hashes, "<i8"), np.array(sizes, "<u4"), np.array(same, "<u4"))
            found = [(-1 - batch % parts, batch, 1, docs)]
            if total:
                tokens = np.concatenate(sets)
                owner = np.repeat(
                    np.array([i for i, s in enumerate(same) if s == i and sizes[i]], "<u4"), [len(s) for s in sets]
                )
                part = (tokens % np.uint64(parts)).astype(np.int64)
                value = (tokens >> np.uint64(32)).astype("<u4")
                order = np.lexsort((value, part))
                part, value, owner = part[order], value[order], owner[order]
                bounds = np.searchsorted(part, np.arange(parts + 1))
                for k in range(parts):
                    a, b = bounds[k], bounds[k + 1]
                    if a < b:
                        gaps = np.diff(value[a:b], prepend=np.uint32(0))
                        found.append((k, batch, 0, pack(gaps, owner[a:b].astype("<u2"))))
            return pd.DataFrame(found, columns=["part", "batch", "kind", "payload"])

        for frame in frames:
            for id_, hash_, text in zip(frame["id"], frame["hash"], frame["text"]):
                found = shingle_set(hasher, text)
                place, mark = len(ids), (len(found), found.tobytes() if len(found) < 64 else hash(found.tobytes()))
                rep = seen.setdefault(mark, place) if len(found) else place
                if rep != place and not np.array_equal(found, sets[same_slot[rep]]):
                    rep = place
                if rep == place and len(found):
                    same_slot[place] = len(sets)
                    sets.append(found)
                    total += len(found)
                ids.append(id_)
                hashes.append(hash_)
                sizes.append(len(found))
                same.append(rep)
                if total >= BATCH_SHINGLES or len(ids) >= BATCH_DOCS:
                    yield rows()
                    batches += 1
                    ids, hashes, sizes, same, sets, seen, total = [], [], [], [], [], {}, 0
                    same_slot.clear()
        if ids:
            yield rows()

    return run


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each part, the shingles that two texts or more hold go back to their batches."""

    def replies(part: int, held: list[tuple[int, bytes]]) -> Iterator[tuple]:
        values, owners, sources = [], [], []
        for place, (_, payload) in enumerate(held):
            gaps, owner = unpack(payload, "<u4", "<u2")
            values.append(np.cumsum(gaps, dtype=np.uint32))
            owners.append(owner)
            sources.append(np.full(len(owner), place, np.uint32))
        value, owner, source = (np.concatenate(x) for x in (values, owners, sources))
        order = np.argsort(value, kind="stable")
        value, owner, source = value[order], owner[order], source[order]
        starts = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
        counts = np.diff(np.append(starts, len(value)))
        held_by = np.repeat(counts, counts).astype("<u4")
        live = held_by > 1
        value, owner, source, held_by = value[live], owner[live], source[live], held_by[live]
        order = np.argsort(source, kind="stable")
        value, owner, source, held_by = value[order], owner[order], source[order], held_by[order]
        bounds = np.searchsorted(source, np.arange(len(held) + 1))
        for place, (batch, _) in enumerate(held):
            a, b = bounds[place], bounds[place + 1]
            if a < b:
                yield part, batch, 2, pack(owner[a:b], value[a:b], held_by[a:b])

    def rows() -> Iterator[tuple]:
        # Rows come sorted by part, so one part's postings are held at a time.
        part, held = None, []
        for frame in frames:
            for p, batch, kind, payload in zip(frame["part"], frame["batch"], frame["kind"], frame["payload"]):
                if kind == 1:
                    yield p, batch, kind, payload
                    continue
                if p != part:
                    if held:
                        yield from replies(part, held)
                    part, held = p, []
                held.append((batch, payload))
        if held:
            yield from replies(part, held)

    yield from _framed(rows(), ["part", "batch", "kind", "payload"], 64)


def _framed(rows: Iterator[tuple], columns: list[str], size: int) -> Iterator[pd.DataFrame]:
    block = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield pd.DataFrame(block, columns=columns)
            block = []
    if block:
        yield pd.DataFrame(block, columns=columns)


_INDEX = "key long, doc_id long, hash long, n long, same long, own long, prefix array<long>, sketch binary"


def _sketch(mixed: np.ndarray) -> bytes:
    """Numbers of shingles by cell of their hash, a byte a cell: the multiple of a step, rounded up."""
    cells = next((c for c in CELLS if len(mixed) <= CELL_LOAD * c), CELLS[-1])
    counts = np.bincount(mixed % cells, minlength=cells)
    step = -(-int(counts.max()) // 255)
    return np.uint32(step).astype("<u4").tobytes() + (-(-counts // step)).astype("u1").tobytes()


class _Sketches:
    """Sketches of several widths; all compare at the smallest width, long ones at their own as well."""

    def __init__(self, packed: np.ndarray):
        widths = np.fromiter(map(len, packed), np.int64, len(packed)) - 4
        self.cells: dict[int, np.ndarray] = {}
        self.row: dict[int, np.ndarray] = {}
        for width in CELLS:
            # A cell of a narrow sketch sums the cells of a wide one that leave the same rest.
            rows = np.flatnonzero(widths >= width)
            cells = np.zeros((len(rows), width), np.int32)
            for own in CELLS[CELLS.index(width) :]:
                at = widths[rows] == own
                if at.any():
                    raw = np.frombuffer(b"".join(packed[rows[at]]), "u1").reshape(-1, own + 4)
                    step = np.ascontiguousarray(raw[:, :4]).view("<u4").astype(np.int32)
                    folded = raw[:, 4:].reshape(len(raw), own // width, width).sum(axis=1, dtype=np.int32)
                    cells[at] = folded * step
            self.cells[width] = cells
            self.row[width] = np.full(len(packed), -1)
            self.row[width][rows] = np.arange(len(rows))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """An upper bound of the shingles that ``i`` and ``j`` share, pair by pair."""
        most = np.full(len(i), np.iinfo(np.int64).max)
        for width in CELLS:
            a, b = self.row[width][i], self.row[width][j]
            both = np.flatnonzero((a >= 0) & (b >= 0))
            for low in range(0, len(both), 1 << 15):
                part = both[low : low + (1 << 15)]
                met = np.minimum(self.cells[width][a[part]], self.cells[width][b[part]]).sum(axis=1)
                most[part] = np.minimum(most[part], met)
        return most


def _prefixes(batch_rows: pd.DataFrame) -> pd.DataFrame:
    """One row per document of a batch; the prefix lists what two texts or more hold, rarest first."""
    batch = int(batch_rows["batch"].iloc[0])
    docs = batch_rows.loc[batch_rows["kind"] == 1, "payload"].iloc[0]
    ids, hashes, sizes, same = unpack(docs, "<i8", "<i8", "<u4", "<u4")
    sizes, same = sizes.astype(np.int64), same.astype(np.int64)
    owner, token, held_by = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for part, kind, payload in zip(batch_rows["part"], batch_rows["kind"], batch_rows["payload"]):
        if kind == 2:
            o, v, h = unpack(payload, "<u2", "<u4", "<u4")
            owner.append(o.astype(np.int64))
            token.append((np.int64(part) << 32) | v.astype(np.int64))
            held_by.append(h.astype(np.int64))
    owner, token, held_by = (np.concatenate(x) for x in (owner, token, held_by))
    order = np.lexsort((token, held_by, owner))
    owner, token = owner[order], token[order]
    bounds = np.searchsorted(owner, np.arange(len(ids) + 1))
    shared = np.diff(bounds)
    own = sizes - shared
    length = np.where(same == np.arange(len(ids)), np.maximum(0, sizes - (3 * sizes + 3) // 4 + 1 - own), 0)
    prefix = [token[a : a + k] for a, k in zip(bounds[:-1], np.minimum(length, shared))]
    key = (np.int64(batch) << KEY_BITS) | np.arange(len(ids))
    mixed = token ^ (token >> 32)
    sketch = [_sketch(mixed[a:b]) if len(p) else None for a, b, p in zip(bounds[:-1], bounds[1:], prefix)]
    return pd.DataFrame({
        "key": key, "doc_id": ids, "hash": hashes, "n": sizes, "same": (np.int64(batch) << KEY_BITS) | same,
        "own": own, "prefix": prefix, "sketch": sketch,
    })


def prefix_index(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents with their size and the part of their prefix that can match, stored."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("hash"), "text"
    )
    dealt = rows.mapInPandas(_deal(parts), _DEALT).repartition(parts, "part").sortWithinPartitions("part")
    counted = dealt.mapInPandas(_count, _DEALT)
    return durable(counted.groupBy("batch").applyInPandas(_prefixes, _INDEX), "prefix-index")


def _buckets(frames: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Rows that come sorted by token, cut into whole buckets; one of more than about ``most`` rows comes in
    pieces, each of which begins with the last row of the one before."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        tokens = frame["token"].to_numpy()
        cut = np.searchsorted(tokens, tokens[-1])
        if held and held[0]["token"].iloc[0] == tokens[-1]:
            held.append(frame)
            if sum(map(len, held)) >= most:
                yield pd.concat(held, ignore_index=True)
                held = [frame.iloc[-1:]]
            continue
        yield pd.concat([*held, frame.iloc[:cut]], ignore_index=True)
        held = [frame.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def _sides(frames: Iterator[pd.DataFrame], columns: list[str], most: int) -> Iterator[tuple[bool, bool, list[np.ndarray]]]:
    """Whether a token begins, whether rows are of its main component, and their ``columns``.

    Rows come sorted by token with the main component last, which is handed on in blocks of about ``most``.
    """
    at, begun, held, rows = None, None, [], 0

    def handed() -> tuple[bool, bool, list[np.ndarray]]:
        return begun != at[0], bool(at[1]), [np.concatenate(c) if len(c) > 1 else c[0] for c in zip(*held)]

    for frame in frames:
        token, main, *rest = (frame[c].to_numpy() for c in ("token", "main", *columns))
        cuts = np.flatnonzero((token[1:] != token[:-1]) | (main[1:] != main[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(token)]):
            if a == b:
                continue
            here = (token[a], main[a])
            if held and (here != at or (main[a] and rows >= most)):
                yield handed()
                begun, held, rows = at[0], [], 0
            at, rows = here, rows + b - a
            held.append([c[a:b] for c in rest])
    if held:
        yield handed()


def _may_link(n: np.ndarray, place: np.ndarray, sketches: _Sketches, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether sizes, places of a common shingle and sketches allow the pairs ``i, j`` to link.

    A sketch counts a member's shared shingles by cell of their hash, or says a little more; two
    members have at most the sum of the smaller counts in common.
    """
    need = 3 * (n[i] + n[j])
    both = np.minimum(place[i], place[j]) + np.minimum(n[i] - place[i], n[j] - place[j])
    fits = (4 * np.minimum(n[i], n[j]) >= 3 * np.maximum(n[i], n[j])) & (7 * both >= need)
    at = np.flatnonzero(fits)
    fits[at] = 7 * sketches.common(i[at], j[at]) >= need[at]
    return fits


def _pair_frame(x: np.ndarray, y: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)}).drop_duplicates()


def _stars(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each group of a bucket, or of a piece of a large one, with the first of its size range and a few others.

    Groups ascend by size within a token.  The others are drawn by a rule fixed by the token.
    """
    for frame in _buckets(frames, BLOCK_ROWS):
        token, group, n, place = (frame[c].to_numpy() for c in ("token", "gid", "n", "place"))
        if not len(token):
            continue
        sketches = _Sketches(frame["sketch"].to_numpy())
        count = np.arange(len(token))
        fresh = np.append(True, token[1:] != token[:-1])
        start = np.maximum.accumulate(np.where(fresh, count, 0))
        size = np.diff(np.append(np.flatnonzero(fresh), len(token)))[np.cumsum(fresh) - 1]
        center, centers = 0, np.zeros(len(token), np.int64)
        for k in range(1, len(token)):
            if fresh[k] or 3 * n[k] > 4 * n[center]:
                center = k
            centers[k] = center
        i, j = [count], [centers]
        for draw in range(DRAWS):
            # Neighbours by size first, then anyone of the bucket.
            step = 1 + draw if draw < 2 else 1 + (token ^ (token >> 17) ^ (group * (2 * draw + 1))) % np.maximum(size - 1, 1)
            i.append(count)
            j.append(start + (count - start + step) % size)
        i, j = np.concatenate(i), np.concatenate(j)
        other = group[i] != group[j]
        i, j = i[other], j[other]
        may = _may_link(n, place, sketches, i, j)
        yield _pair_frame(group[i[may]], group[j[may]])


def _across(best: bool):
    """Pairs of a bucket from different components that may link.

    With ``best``, each member outside the main component gives its nearest partner by sketch in that
    component and its nearest outside; otherwise all pairs come out.  The members outside are held, those
    of the main component pass by in blocks.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        outside: list[np.ndarray] | None = None
        nearest: dict[int, tuple[int, int]] = {}

        def settled() -> None:
            if nearest:
                found.append(tuple(np.array(c, np.int64) for c in ([*nearest], [k for _, k in nearest.values()])))
                nearest.clear()

        for fresh, main, (key, n, place, label, sketch) in _sides(frames, ["key", "n", "place", "label", "sketch"], BLOCK_ROWS):
            if fresh:
                settled()
                outside = None
            if not main:
                outside, sketches = [key, n, place, sketch], _Sketches(sketch)
                for i in range(len(key)):
                    j = np.flatnonzero((label != label[i]) & (key > key[i] if not best else True))
                    j = j[_may_link(n, place, sketches, np.full(len(j), i), j)]
                    if best and len(j):
                        j = j[[sketches.common(np.full(len(j), i), j).argmax()]]
                    if len(j):
                        found.append((np.full(len(j), key[i]), key[j]))
            elif outside is not None:
                held = len(outside[0])
                key, n, place, sketch = (np.concatenate(c) for c in zip(outside, (key, n, place, sketch)))
                sketches = _Sketches(sketch)
                for i in range(held):
                    j = np.arange(held, len(key))
                    j = j[_may_link(n, place, sketches, np.full(len(j), i), j)]
                    if best and len(j):
                        common = sketches.common(np.full(len(j), i), j)
                        top = int(common.argmax())
                        nearest[key[i]] = max(nearest.get(key[i], (0, 0)), (int(common[top]), int(key[j[top]])))
                    elif len(j):
                        found.append((np.full(len(j), key[i]), key[j]))
            if sum(len(x) for x, _ in found) >= 1 << 16:
                yield _pair_frame(*(np.concatenate(x) for x in zip(*found)))
                found.clear()
        settled()
        if found:
            yield _pair_frame(*(np.concatenate(x) for x in zip(*found)))

    return run


def _sets_of(rows: DataFrame) -> DataFrame:
    """``key, n, shingles`` from ``key, text``, one row per key; rows of one key have the same text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = SpanHasher()
        seen: set[int] = set()
        for frame in frames:
            frame = frame[~frame["key"].isin(seen)].drop_duplicates("key")
            seen.update(frame["key"].tolist())
            sets = [shingle_set(hasher, t).view(np.int64) for t in frame["text"]]
            yield pd.DataFrame({"key": frame["key"], "n": [len(s) for s in sets], "shingles": sets})

    return rows.mapInPandas(run, "key long, n long, shingles array<long>").dropDuplicates(["key"])


def repeated_keys(index: DataFrame) -> DataFrame:
    """``key, first``: keys whose id and text stand under a smaller key of another batch already."""
    names = ["doc_id", "hash"]
    firsts = index.groupBy(*names).agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("keys")).where("keys > 1")
    found = index.select("key", *names).join(firsts, names).where("key <> first").select("key", "first")
    return durable(found, "repeated-keys")


def _linked(docs: DataFrame, index: DataFrame, pairs: DataFrame, id_col: str) -> DataFrame:
    """The pairs of keys whose whole shingle sets link."""
    pairs = durable(pairs.distinct(), "pairs")
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    need = durable(index.join(keys, "key", "left_semi").select("key", "doc_id", "hash"), "pair-keys")
    small = F.broadcast(need) if need.count() <= BROADCAST_ROWS else need
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("hash"), "text"
    )
    # One exchange by key serves both sides: it drops repeats, and the join reads it as it is.
    sets = _sets_of(texts.join(small, ["doc_id", "hash"]).select("key", "text"))
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    met = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("s_a", "s_b"))
    return durable(met.where(7 * common >= 3 * (F.col("n_a") + F.col("n_b"))).select("a", "b"), "near-links")


def near_components(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, hash, n_shingles, component_id, label``, one row per document, repeated rows included.

    ``component_id`` is the smallest id in reach; rows without an id link like others and count only
    if a component has no id at all (then it is null).  Null texts and texts without words have no
    shingles and no link.  ``docs`` should be a stored table: its rows are read twice.
    """
    index = prefix_index(docs, id_col)
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    repeated = repeated_keys(index.where("same = key AND n > 0"))
    ready = index.where(F.size("prefix") > 0).join(repeated, "key", "left_anti")
    shape = ["n", "own", "prefix"]
    members = ready.join(ready.groupBy(*shape).agg(F.min("key").alias("gid")), shape)
    members = durable(members.select("gid", "key", "sketch", *shape), "prefix-members")
    grouped = members.where("gid = key")
    members = members.select("gid", "key", "sketch")
    entries = grouped.select("gid", "n", "own", "sketch", F.posexplode("prefix").alias("at", "token")).select(
        "token", "gid", "n", (F.col("own") + F.col("at")).alias("place"), "sketch"
    )
    laid = entries.repartition(parts, "token").sortWithinPartitions("token", "n", "gid")
    inside = members.where("gid <> key").select(F.col("gid").alias("a"), F.col("key").alias("b"))
    links = _linked(docs, index, laid.mapInPandas(_stars, "a long, b long").union(inside), id_col)
    places = entries.drop("sketch")
    for best in (True, False):
        labels = durable(components(links, "a", "b"), "labels")
        sized = labels.join(labels.groupBy("label").agg(F.count(F.lit(1)).alias("size")), "label")
        held = members.join(sized, members["key"] == sized["node"], "left").select(
            "gid", "key", "sketch", F.coalesce("label", "key").alias("label"), F.coalesce("size", F.lit(1)).alias("size")
        )
        held = durable(held, "labelled-members")
        # Only buckets whose members lie in several components have pairs left to compare.
        largest = F.max(F.struct("size", "label"))
        several = held.groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"), largest.alias("most"))
        unsettled = (
            places.join(several, "gid").groupBy("token")
            .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("most").alias("most"))
            .where("low <> high").select("token", F.col("most.label").alias("most"))
        )
        rest = places.join(unsettled, "token").join(held, "gid").select(
            "token", "key", "n", "place", "label", "sketch", (F.col("label") == F.col("most")).alias("main")
        )
        rest = rest.repartition(parts, "token").sortWithinPartitions("token", "main", "key")
        more = _linked(docs, index, rest.mapInPandas(_across(best), "a long, b long"), id_col)
        links = links.union(more)
    labels = durable(components(links, "a", "b"), "labels")

    firsts = repeated.select(F.col("key").alias("same"), "first")
    index = index.join(firsts, "same", "left").withColumn("same", F.coalesce("first", "same"))
    rows = index.join(labels, index["same"] == labels["node"], "left").select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "hash", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("label", "same")).otherwise(F.col("key")).alias("label"),
    )
    rows = durable(rows, "near-rows")
    smallest = rows.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return rows.join(smallest, "label").select("doc_id", "hash", "n_shingles", "component_id", "label")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Of several texts under that id the one with the smallest hash stays; rows alike in id and text
    count as one document and stay together.
    """
    rows = durable(near_components(docs, id_col), "near-components")
    row = unused(docs, "__row")
    smallest = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = rows.where(smallest).groupBy("label").agg(F.min("hash").alias("first"))
    gone = rows.join(first, "label").where(~smallest | (F.col("hash") != F.col("first")))
    gone = gone.select(row_name(F.col("doc_id"), F.col("hash")).alias(row)).distinct()
    named = docs.withColumn(row, row_name(F.col(id_col), F.xxhash64("text")))
    return named.join(gone, row, "left_anti").drop(row)


@query("op6_ngram_join")
def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
