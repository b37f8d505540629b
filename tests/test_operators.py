import datetime
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from tallyloom.operators import quality as Q, stats as S
from tallyloom.operators.changes import (
    reconcile, refresh_if_changed, states_differ, table_fingerprint,
)
from tallyloom.operators.entity import canonical_spellings, lookup_by_name_key, most_used_per_key
from tallyloom.operators.history import apply_snapshot, empty_history
from tallyloom.operators.joins import attach_group_values, count_unlisted, without_mirrored
from tallyloom.operators.keys import content_key, member_set_key
from tallyloom.operators import automaton, linkage, quality
from tallyloom.plans.official_results import stage_results
from tallyloom.operators.linkage import LinkRules, best_links, match_names
from tallyloom.operators.numbering import number_rows
from tallyloom.operators.reshape import columns_with_suffix, unpivot_columns
from tallyloom.operators.windows import day_gaps, first_per_key, moving_average, typical_gap
from tallyloom.session import scratch_path

DAY = datetime.date(2026, 5, 1)


def shifted(days):
    return None if days is None else DAY + datetime.timedelta(days=days)


def brute_links(left, right, rules):
    found = {}
    for lid, pattern, ls, le, ln in left:
        if le is None or not pattern:
            continue
        best = None
        for rid, name, rs, re_, rn in right:
            if re_ is None or name is None or not re.search(pattern, name):
                continue
            end = abs((le - re_).days)
            start = None if rs is None else abs(((ls or le) - rs).days)
            sizes = ln is not None and rn is not None
            near = end <= rules.end_days and start is not None and start <= rules.start_days
            strict = end <= rules.strict_end_days and sizes and abs(ln - rn) * 100 <= max(
                rules.strict_size * 100, rules.strict_percent * rn)
            if not (near or strict):
                continue
            close = sizes and abs(ln - rn) * 100 <= max(rules.close_size * 100, rules.close_percent * rn)
            distance = None if ls is None or rs is None else (
                abs((ls - rs).days) + end + (0 if close else rules.far_penalty))
            rank = (-1 if distance is None else distance, rid)
            if best is None or rank < best[0]:
                best = (rank, rid, distance)
        if best:
            found[lid] = best[1:]
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_linkage_equals_comparing_all_pairs(spark, seed):
    rng = random.Random(seed)
    patterns = ["alfa", "beta|gama", "a", "data", "", "gam+a", "delta|x"]
    names = ["institutoalfa", "betapesquisas", "gamadata", "deltax", "zeta", "gammma"]

    def size():
        return rng.choice([None, 20, 900, 1000, 1010, 1049, 1051, 1900, 2000, 2019, 2021, 2100, 50000, 52400])

    def maybe(days):
        return None if rng.random() < 0.15 else shifted(days)

    left = [(i, rng.choice(patterns), maybe(rng.randint(-6, 6)), maybe(rng.randint(-6, 8)), size())
            for i in range(150)]
    right = [(1000 + i, rng.choice(names), maybe(rng.randint(-6, 6)), maybe(rng.randint(-6, 8)), size())
             for i in range(150)]
    rules = LinkRules()
    schema = "{0}_id long, {1} string, start date, end date, size int"
    got = best_links(
        spark.createDataFrame(left, schema.format("left", "pattern")),
        spark.createDataFrame(right, schema.format("right", "name")), rules,
    ).collect()
    assert {r.left_id: (r.right_id, r.distance) for r in got} == brute_links(left, right, rules)
    assert len(got) == len({r.left_id for r in got})


def test_linkage_of_one_hot_institute(spark):
    rng = random.Random(7)
    left = [(i, "alfa", shifted(i % 3), shifted(2 + i % 3), 1000 + i % 40) for i in range(400)]
    right = [(9000 + i, "alfa", shifted(rng.randint(0, 3)), shifted(rng.randint(1, 5)), 990 + rng.randint(0, 80))
             for i in range(300)]
    schema = "{0}_id long, {1} string, start date, end date, size int"
    got = best_links(
        spark.createDataFrame(left, schema.format("left", "pattern")),
        spark.createDataFrame(right, schema.format("right", "name")),
    ).collect()
    assert {r.left_id: (r.right_id, r.distance) for r in got} == brute_links(left, right, LinkRules())


@pytest.mark.parametrize("chars", [10**6, 0])
def test_regexes_need_not_be_listed(spark, monkeypatch, chars):
    """By the automaton and by substrings, with regexes that require a text and some that do not."""
    monkeypatch.setattr(linkage, "AUTOMATON_CHARS", chars)
    patterns = ["a.b", "x+y", "^za|wab+$", "[0-9]{3}", "(ab|cd)ef", "(?i)QU", "q|b", "no.*pe", "a|", r"\.c", "aa", "", "\\d+z", "u?"]
    names = ["axb", "xxy", "zab", "wabb", "id123", "cdef", "quo", "no rope", "a.c", "aaa", "7z", "", None, "ba" * 30]
    rows = match_names(spark.createDataFrame([(p,) for p in patterns * 2], "pattern string"), spark.createDataFrame([(n,) for n in names * 2], "name string"))
    want = set()
    for p in patterns:
        words = [w for w in p.split("|") if w] if re.search(automaton.PLAIN, p) else [p]
        want |= {(p, n) for n in names if n is not None for w in words if re.search(w, n)}
    got = [(r.pattern, r.name) for r in rows.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_required_texts():
    cases = {
        "abc": ["abc"], "ab*c": ["a"], "ab+cd": ["bcd"], "x(ab|cd)efg": ["efg"], "a|bc": ["a", "bc"], "a.|b?": [], "[ab]cd": ["cd"],
        r"\bdata ?folha\.br": ["folha.br"], r"a\|b": ["a|b"], "(?i)abc": [], "ab{2}cde": ["cde"], r"ab\x41": ["ab"], "[^]]ab": ["ab"], r"\Qa|b\E": [],
    }
    assert {regex: automaton.required_texts(regex) for regex in cases} == cases


def test_automaton_equals_looking_for_each_word():
    rng = random.Random(2)
    make = lambda n: "".join(rng.choice("abc") for _ in range(rng.randrange(n)))
    for _ in range(60):
        words = [make(7) for _ in range(rng.randrange(30))]
        machine = automaton.Automaton(words)
        for _ in range(20):
            text = make(60)
            assert machine.words_in(text) == {w for w in words if w and w in text}


def test_linkage_plan_has_no_nested_loop(spark):
    left = spark.createDataFrame([(1, "a", DAY, DAY, 10)], "left_id long, pattern string, start date, end date, size int")
    right = spark.createDataFrame([(2, "a", DAY, DAY, 10)], "right_id long, name string, start date, end date, size int")
    plan = best_links(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_numbering_equals_the_global_window(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "b", "b", None]), rng.randint(0, 5), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    order = [F.desc_nulls_last("k"), F.asc("v"), F.asc("i")]
    numbered = number_rows(df, order, "n", partitions=7)
    wrong = numbered.withColumn("w", F.row_number().over(Window.orderBy(*order))).filter("n <> w")
    assert wrong.count() == 0 and numbered.count() == 3000


def test_fingerprint_ignores_order_only(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 2)], "s string, n int")
    first = table_fingerprint(df).first()
    assert first == table_fingerprint(df.orderBy(F.desc("n")).repartition(3)).first()
    assert first != table_fingerprint(df.union(df.limit(1))).first()
    swapped = spark.createDataFrame([(None, "a")], "s string, t string")
    other = spark.createDataFrame([("a", None)], "s string, t string")
    assert table_fingerprint(swapped).first() != table_fingerprint(other).first()
    empty = spark.createDataFrame([("", "a")], "s string, t string")
    assert table_fingerprint(swapped).first() != table_fingerprint(empty).first()


def test_refresh_is_remembered_only_after_success(spark):
    df, state = spark.range(3), scratch_path(spark, "state")

    def fails(_):
        raise OSError("no")

    with pytest.raises(OSError):
        refresh_if_changed(df, "t", state, fails, datetime.datetime(2024, 1, 1))
    seen = []
    assert refresh_if_changed(df, "t", state, seen.append, datetime.datetime(2024, 1, 2))
    assert not refresh_if_changed(df, "t", state, seen.append, datetime.datetime(2024, 1, 3))
    assert refresh_if_changed(spark.range(4), "t", state, seen.append, datetime.datetime(2024, 1, 4))
    assert len(seen) == 2


def test_reconcile_keeps_first_seen_day(spark):
    reference = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "cid string, doc_id string")
    current = spark.createDataFrame([("1", "a"), ("1", "z"), ("2", "x"), ("4", "q")], "cid string, doc_id string")
    previous = spark.createDataFrame([("2", DAY)], "cid string, desde date")
    got = {r.cid: (r.status, r.desde) for r in reconcile(reference, current, previous, shifted(9)).collect()}
    assert got == {"2": ("changed", DAY), "3": ("only_reference", None), "4": ("only_current", None)}
    state = reconcile(reference, current, previous, shifted(9))
    assert not states_differ(state, reconcile(reference, current, previous, shifted(20)))


def test_history(spark):
    def state(*rows):
        return spark.createDataFrame(rows, "id int, v string, extra int")

    times = [datetime.datetime(2024, m, 1) for m in range(1, 6)]
    history = empty_history(state((0, "", 0)))
    for rows, at in zip(
        ([(1, "a", 0), (2, "b", 0), (3, None, 0)], [(1, "a", 9), (3, "x", 0)], [(1, "a", 9), (3, "x", 0)],
         [(1, "a", 9), (2, "b", 0), (3, None, 0)]), times,
    ):
        history = apply_snapshot(history, state(*rows), "id", ["v"], at)
    got = {(r.id, r.v, r.valid_from.month, r.valid_to.month if r.valid_to else None, r.is_deleted)
           for r in history.collect()}
    assert got == {
        (1, "a", 1, None, False),
        (2, "b", 1, 2, False), (2, "b", 2, 4, True), (2, "b", 4, None, False),
        (3, None, 1, 2, False), (3, "x", 2, 4, False), (3, None, 4, None, False),
    }


def test_checks(spark):
    df = spark.createDataFrame(
        [(1, "A", 5), (1, "B", None), (None, None, -1), (None, None, -1)], "k int, c string, v int")
    other = spark.createDataFrame([(2,)], "k int")
    checks = [
        Q.not_null("k"), Q.accepted_values("c", ["A"]), Q.accepted_range("v", 0, 10),
        Q.expression_is_true("v_small", F.col("v") < 3, severity=Q.WARN),
        Q.not_null("v", where=F.col("c").isNotNull()), Q.unique("k"),
        Q.unique_combination(["k", "c"]), Q.relationships("k", other, "k"),
    ]
    got = [(r.check, r.failures) for r in Q.run_checks(df, checks).collect()]
    assert got == [
        ("not_null_k", 2), ("accepted_values_c", 1), ("accepted_range_v", 2), ("expression_v_small", 1),
        ("not_null_v", 1), ("unique_k", 1), ("unique_k_c", 1), ("relationships_k", 2),
    ]
    assert checks[0].failing_rows(df).count() == 2


def test_fallback_raises_when_nothing_is_accepted(spark):
    with pytest.raises(RuntimeError):
        Q.first_accepted([lambda: spark.range(1)], lambda df: False)
    stale = Q.source_freshness(spark.createDataFrame([], "t timestamp"), "t", datetime.datetime(2024, 1, 1))
    assert stale.first()["status"] == "warn"


def test_first_per_key_with_null_key_and_missing_order(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 2), ("a", None, 3), ("a", 1, 4)], "k string, o int, i int")
    got = {r.i for r in first_per_key(df, ["k"], [F.desc_nulls_last("o"), F.asc("i")]).collect()}
    assert got == {2, 4}


def test_group_values_treat_null_as_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 2)], "k string, v int")
    got = sorted((r.v, r.top) for r in attach_group_values(df, ["k"], top=F.max("v")).collect())
    assert got == [(1, 3), (2, 2), (3, 3)]


def test_unlisted_and_mirrored(spark):
    df = spark.createDataFrame([("s", "x"), ("s", "y"), ("s", None)], "g string, m string")
    listed = spark.createDataFrame([("x",), (None,)], "m string")
    row = count_unlisted(df, ["g"], "m", listed, "m", F.lit(True), all=F.lit(True)).first()
    assert (row["all"], row["unlisted"]) == (3, 1)
    twins = spark.createDataFrame([(None, 1)], "a int, b int")
    assert without_mirrored(spark.createDataFrame([(None, 1)], "a int, b int"), twins, ["a", "b"]).count() == 1


def test_entities(spark):
    names = ["DataFolha", "Datafolha", "Datafolha", "Futura/Apex", "Apex/Futura", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.spelling: r.canonical for r in canonical_spellings(df, "n").collect()}
    assert got == {"DataFolha": "Datafolha", "Datafolha": "Datafolha",
                   "Futura/Apex": "Apex/Futura", "Apex/Futura": "Apex/Futura"}
    lookup = spark.createDataFrame([("apex futura", "B"), ("APEX/Futura", "A")], "o string, s string")
    mapped = lookup_by_name_key(df, "n", lookup, "o", "s", "m")
    assert {r.n: r.m for r in mapped.collect() if r.m} == {"Futura/Apex": "A", "Apex/Futura": "A"}
    assert mapped.count() == len(names)
    spelled = spark.createDataFrame([("1", "b", DAY), ("1", "a", DAY)], "k string, n string, d date")
    assert most_used_per_key(spelled, "k", ["n"], "d").first()["n"] == "a"


def test_keys(spark):
    df = spark.createDataFrame([("a", None, "c"), ("a", "c", None)], "x string, y string, z string")
    plain = [r[0] for r in df.select(content_key(*map(F.col, "xyz"))).collect()]
    marked = [r[0] for r in df.select(content_key(*map(F.col, "xyz"), null_marker="?")).collect()]
    assert plain[0] == plain[1] and marked[0] != marked[1]
    rows = spark.createDataFrame([("p", "b"), ("p", "a"), ("q", "a"), ("q", "b"), ("q", "a")], "g string, m string")
    keys = member_set_key(rows, ["g"], "m", None, "key").select("key").distinct()
    assert keys.count() == 1


def test_reshape(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "id int, `x_S` string, `Y_s` string, `Z_S` string")
    chosen = columns_with_suffix(df, "_s", ["Z_S"])
    got = {(r.coluna_origem, r.valor) for r in unpivot_columns(df, ["id"], chosen, upper_names=True).collect()}
    assert got == {("X_S", "a"), ("Y_S", "b")}
    none = unpivot_columns(df, ["id"], [])
    assert none.count() == 0 and none.columns == ["id", "coluna_origem", "valor"]


def test_gaps_and_smoothing(spark):
    days = spark.createDataFrame([("a", shifted(d)) for d in (0, 0, 1, 4, 10)], "g string, d date")
    row = day_gaps(days, ["g"], "d").agg(typical_gap(F.col("gap"), 7).alias("t")).first()
    assert row["t"] == 3
    series = spark.createDataFrame(
        [("long", i, float(i)) for i in range(15)] + [("short", i, 1.0) for i in range(14)], "s string, d int, v double")
    got = {(r.s, r.d): r.m for r in moving_average(series, ["s"], "d", "v", "m").collect()}
    assert got[("long", 0)] == 1.0 and got[("long", 7)] == 7.0 and got[("short", 7)] is None


def test_statistics(spark):
    rows = [("p1", DAY, "A", "Candidato", 40), ("p1", DAY, "B", "Candidato", 40), ("p1", DAY, "Indecisos", "Não-resposta", 20),
            ("p1", DAY, "Nulos", "Não-resposta", 0), ("p2", DAY, "A", "Candidato", 30)]
    df = spark.createDataFrame(rows, "poll string, day date, label string, kind string, v int").withColumn(
        "v", F.col("v").cast("decimal(9,2)"))
    scaled = S.rescale_polls(S.poll_means(df, ["poll", "day"], "label", "kind", "v"), ["poll", "day"], "label", "kind", "v")
    assert {(r.poll, r.label): int(r.v) for r in scaled.collect()} == {
        ("p1", "A"): 40, ("p1", "B"): 40, ("p1", "NR"): 20, ("p2", "A"): 100}
    means = {r.label: int(r.v) for r in S.day_means(scaled, ["poll"], "day", "label", "v").collect()}
    assert means == {"A": 70, "B": 20, "NR": 10}
    thirds = spark.createDataFrame([("g", x) for x in "abc"], "g string, l string").withColumn(
        "v", (F.lit(100) / F.lit(3)).cast("decimal(18,6)"))
    shown = {r.l: r.s for r in S.largest_remainder(thirds, ["g"], "l", "v", "s").collect()}
    assert shown == {"a": Decimal("33.4"), "b": Decimal("33.3"), "c": Decimal("33.3")}


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo", "UTC"])
def test_published_history_in_any_zone_of_the_driver(spark, tmp_path, monkeypatch, zone):
    import time
    from datetime import datetime

    from tallyloom.operators import history as type_2

    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        root = str(tmp_path / "history")
        kept = type_2.empty_history(spark.createDataFrame([], "k long, v string"))
        for hour, value in enumerate(["a", "b", "c", "c"]):
            source = spark.createDataFrame([(1, value), (2, "same")], "k long, v string")
            as_of = datetime(2024, 5, 1, 10 + hour)
            kept = type_2.apply_snapshot(kept, source, "k", ["v"], as_of).localCheckpoint()
            type_2.publish_history(kept, root, as_of)
            got = type_2.read_history(spark, root, kept.schema).select("k", "v").collect()
            assert sorted(map(tuple, got)) == sorted(map(tuple, kept.select("k", "v").collect()))
    finally:
        monkeypatch.undo()
        time.tzset()


def test_results_are_typed_below_the_unpivot(spark):
    raw = spark.createDataFrame(
        [("01/10/2022 10:00:00", "1", "0,5", "0,4", "x")],
        "DT_TOTALIZACAO string, TURNO string, A_PE_VOTOS_TOT_ACUMULADO string, b_pe_votos_tot_acumulado string, _ingerido_em string",
    )
    plan = stage_results(raw)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Expand")]
    assert "DT_TOTALIZACAO" not in above and "TURNO" not in above.replace("nr_turno", "")
    assert {r.coluna_origem for r in stage_results(raw).collect()} == {"A_PE_VOTOS_TOT_ACUMULADO", "B_PE_VOTOS_TOT_ACUMULADO"}


def test_a_header_without_dated_lines_stays(spark):
    header = spark.createDataFrame([(7, "2026-09-29 00:00:00", "2026-09-20")], "n int, campo_recente string, campo_inicio string")
    block = lambda *lines: spark.createDataFrame([(x,) for x in lines], "linha string")
    dates = quality.header_dates_from_lines([(block("x;1", ""), 1)])
    assert tuple(quality.repair_header(header, dates).first()) == (7, "2026-09-29 00:00:00", "2026-09-20", "")
    same = quality.header_dates_from_lines([(block("2026-09-29;2026-09-25", "2026-09-29;n/a", "2026-09-01;2026-08-30"), 1)])
    assert tuple(quality.repair_header(header, same).first()) == (7, "2026-09-29 00:00:00", "2026-09-29", "campo_inicio")


def test_key_checks_of_a_table_share_one_scan_and_one_exchange(spark):
    draw = random.Random(5)
    rows = [
        (draw.choice([None, *range(30)]), draw.choice([None, "a", "b:", "1:b"]), draw.choice([None, 0.0, -0.0, float("nan"), 1.5]), i % 3)
        for i in range(200)
    ]
    df = spark.createDataFrame(rows, "id long, name string, part double, nr int")
    known = spark.createDataFrame([(i,) for i in [*range(0, 30, 2), 2]] + [(None,)], "known long")
    narrow = known.select(F.col("known").cast("int").alias("known"))
    checks = [
        Q.unique("id"), Q.unique("part"), Q.unique("id", where=F.col("nr") == 1), Q.unique_combination(["id", "name"]),
        Q.unique_combination(["part", "name"]), Q.relationships("id", known, "known"),
        Q.relationships("id", known, "known", where=F.col("name") == "a"), Q.relationships("id", narrow, "known"),
    ]
    result = Q.run_checks(df, checks)
    got = sorted((r["check"], r["failures"]) for r in result.collect())
    assert got == sorted((c.name, c.failing_rows(df).count()) for c in checks)
    # One scan of the table, whatever the number of key checks; the known ones are scanned once each.
    plan = Q.run_checks(df, checks[:5])._jdf.queryExecution().executedPlan().toString()
    first = plan.split("== Initial Plan ==")[-1]
    assert first.count("hashpartitioning(nr") == 1 and first.count("Exchange") == 2
    empty = Q.run_checks(df.limit(0), checks).collect()
    assert len(empty) == len(checks) and not any(r["failures"] for r in empty)
