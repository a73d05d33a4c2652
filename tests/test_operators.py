"""Operators on small frames: edges that the driver's tables don't hold."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import audit, grade, graph, match, resolve, sample, spatial, text
from millrace.operators.order import ranked, running, slices


def one(spark, expr, **cols):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in cols.items())).select(expr).first()[0]


def test_floor_ratio(spark):
    df = spark.createDataFrame([(19999, 20000), (0, 0), (1, 1), (1, 3)], "m int, e int").select(S.floor_ratio(F.col("m"), F.col("e")))
    assert [r[0] for r in df.collect()] == [0.9999, None, 1.0, 0.3333]


def test_bag_match_uses_each_once(spark):
    a = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4)], "name string, id int")
    b = spark.createDataFrame([("a", 11), ("a", 12), ("c", 13)], "name string, id int")
    rows = match.bag_match(a, b, ["name"], ["id"], ["id"]).collect()
    assert sum(r.l is not None and r.r is not None for r in rows) == 2
    assert [r.r.id for r in rows if r.l is None] == [13] and sorted(r.l.id for r in rows if r.r is None) == [3, 4]
    counts = {r.name: (r.matched, r.missing, r.extra) for r in match.match_counts(a, b, ["name"]).collect()}
    assert counts == {"a": (2, 1, 0), "b": (0, 1, 0), "c": (0, 0, 1)}


def test_sorted_pairs_only_in_equal_groups(spark):
    a = spark.createDataFrame([("x", 3.0), ("x", 1.0), ("y", 1.0), ("y", 2.0)], "k string, v double")
    b = spark.createDataFrame([("x", 10.0), ("x", 30.0), ("y", 5.0)], "k string, v double")
    assert sorted((r.l.v, r.r.v) for r in match.sorted_pairs(a, b, ["k"], ["v"], ["v"]).collect()) == [(1.0, 10.0), (3.0, 30.0)]


@pytest.mark.parametrize("seed", range(3))
def test_matching_against_plain_python(spark, seed):
    rng = random.Random(seed)
    a = [(rng.choice("pqr"), float(rng.randrange(9)), i) for i in range(20)]
    b = [(rng.choice("pqrs"), float(rng.randrange(9)), i) for i in range(20)]
    x, y = (spark.createDataFrame(t, "k string, v double, id int") for t in (a, b))
    got = sorted((r.l.id, r.r.id) for r in match.bag_match(x, y, ["k"], ["v", "id"], ["v", "id"], "inner").collect())
    want = []
    for k in "pqr":
        left, right = (sorted((v, i) for kk, v, i in t if kk == k) for t in (a, b))
        want += [(i, j) for (_, i), (_, j) in zip(left, right)]
    assert got == sorted(want)


def test_adaptive_mode(spark):
    rows = [(49, 100, 100, 100, 100, 100), (50, 100, 100, 0, 100, 100), (0, 0, 5, 97, 100, 98), (0, 0, 5, 99, 100, 98), (0, 0, 0, 0, 0, 3)]
    df = spark.createDataFrame(rows, "h int, l int, r int, m int, e int, f int")
    got = [r[0] for r in df.select(match.adaptive_mode(*map(F.col, "hlrmef"))).collect()]
    assert got == ["name", "id", "name", "name", "none"]
    assert match.adaptive_mode and [r[0] for r in spark.createDataFrame([(0, 0, 5, 90, 100, 98)], "h int, l int, r int, m int, e int, f int").select(match.adaptive_mode(*map(F.col, "hlrmef"))).collect()] == ["count"]


def test_solid(spark):
    rows = [(0, 9.0, None), (1, 1.0, None), (1, -5.0, None), (1, None, None), (1, 9.0, True), (None, 9.0, False)]
    df = spark.createDataFrame(rows, "s int, v double, d boolean").select(S.is_solid(F.col("s"), F.col("v"), F.col("d")))
    assert [r[0] for r in df.collect()] == [False, False, True, True, False, False]


def test_band_edges(spark):
    rows = [(951.0, 1000.0, False, 5.0), (1049.0, 1000.0, False, 5.0), (949.0, 1000.0, False, 5.0), (900.0, 1000.0, True, 5.0), (899.0, 1000.0, True, 5.0), (999.0, 999.9, False, 5.0), (1000.0, 1000.0, False, 0.99), (None, 1000.0, False, 5.0), (5.0, 0.0, False, None)]
    df = spark.createDataFrame(rows, "v double, e double, c boolean, w double").select(grade.band(F.col("v"), F.col("e"), F.col("c"), F.col("w")))
    assert [r[0] for r in df.collect()] == ["within", "within", "outside", "curved", "curved_gross", "sliver", "sliver", "unchecked", "unchecked"]


def test_lower_rank(spark):
    for n in (1, 20, 21):
        values = [float((7 * i) % n) for i in range(n)]
        got = sample.lower_rank(spark.createDataFrame([(1, v) for v in values], "g int, v double"), ["g"], "v", {"p5": 0.05, "p95": 0.95}).first()
        assert (got.p5, got.p95) == (sorted(values)[int(0.05 * (n - 1))], sorted(values)[int(0.95 * (n - 1))])


def test_resolution(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "sha string")
    t = lambda *r: spark.createDataFrame(list(r), "sha string, loc string")
    got = {r.sha: (r.loc, r.how) for r in resolve.priority_resolve(wanted, "sha", [("real", t(("a", "z"), ("a", "y"))), ("prior", t(("a", "p"), ("b", "q")))], "loc").collect()}
    assert got == {"a": ("y", "real"), "b": ("q", "prior"), "c": (None, "unresolved")}
    asks = spark.createDataFrame([(1, 10, "x"), (2, 10, "y"), (3, 11, "x")], "id int, size int, sha string")
    offers = spark.createDataFrame([(10, "x"), (10, "z"), (10, "x")], "size int, sha string")
    assert {r.id: r.reason for r in resolve.proof_gate(asks, offers, ["size"], "sha").collect()} == {1: "proven", 2: "proof_differs", 3: "no_candidate"}
    peers = spark.createDataFrame([("n", 1), ("m", 2), ("m", 3), ("k", 4), ("k", 5)], "name string, peer int")
    ask = spark.createDataFrame([("n", None), ("m", None), ("k", 5), ("z", None)], "name string, hit int")
    got = {r.name: (r.status, r.choice) for r in resolve.ambiguous_lookup(ask, peers, "name", "peer", F.col("hit")).collect()}
    assert got == {"n": ("unique", 1), "m": ("ambiguous", None), "k": ("exact", 5), "z": ("not_found", None)}


def test_sibling_join(spark):
    a = spark.createDataFrame([(1, "/p/q/x.db")], "id int, path string")
    b = spark.createDataFrame([("/p/q/y.ifc",), ("/p/z.ifc",), ("/p/q/IFC/w.ifc",), ("/o/v.ifc",)], "path string")
    got = {(r.scope, r.peer_path) for r in resolve.sibling_join(a, b, "path", {"same": "", "parent": "..", "ifc": "IFC"}).collect()}
    assert got == {("same", "/p/q/y.ifc"), ("parent", "/p/z.ifc"), ("ifc", "/p/q/IFC/w.ifc")}


def test_classes_and_verdicts(spark):
    rows = [(1, 1.0, 0), (0, 0.49, 0), (0, 0.5, 0), (0, 1.0, 1), (0, 1.0, 0), (0, None, 0)]
    df = spark.createDataFrame(rows, "r int, c double, s int").select(grade.model_class(F.col("r"), F.col("c"), F.lit(None).cast("double"), F.col("s"), F.lit(0), F.lit(0)))
    assert [r[0] for r in df.collect()] == [3, 3, 2, 2, 1, 1]
    m = spark.createDataFrame([(1, "WARN", True), (1, "WARN", False), (1, None, False), (1, "PASS", False), (1, "FAIL", True), (3, "PASS", True)], "k int, v string, o boolean")
    assert [r[0] for r in m.select(grade.verify_merge(F.col("k"), F.col("v"), F.col("o"))).collect()] == [1, 2, 2, 1, 2, 3]
    assert one(spark, grade.partial_kind(F.array(F.lit("source_data_absent")), F.array(F.lit("brep_open_surface")))) == "complete_to_source"
    assert one(spark, grade.partial_kind(F.array(F.lit("other")), F.array().cast("array<string>"))) == "approximated"


def test_dedup_keeps_references(spark):
    rows = spark.createDataFrame([("s", "b", 0), ("s", "a", 0), ("s", "z", 1), ("t", "q", 0)], "sha string, path string, native int")
    got = {r.path: (r.keep_id, r.n_copies, r.kept) for r in audit.content_dedup(rows, ["sha"], [-F.col("native"), F.col("path")], "path").collect()}
    assert got == {"a": ("z", 3, False), "b": ("z", 3, False), "z": ("z", 3, True), "q": ("q", 1, True)}


def test_delta(spark):
    cur = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, etag string")
    old = spark.createDataFrame([("b", "2"), ("c", "x"), ("d", "4")], "k string, etag string")
    assert {r.k: r.action for r in audit.delta_plan(cur, old, "k", "etag").collect()} == {"a": "add", "b": "keep", "c": "refresh", "d": "remove_pending"}


def test_majority_and_modes(spark):
    rows = [("a", "x")] * 16 + [("a", "y")] * 4 + [("b", "p"), ("b", "o")]
    got = {r.k: (r.mode, r.mode_n, r.variants, r.n) for r in sample.mode_of(spark.createDataFrame(rows, "k string, v string"), ["k"], "v").collect()}
    assert got == {"a": ("x", 16, 2, 20), "b": ("o", 1, 2, 2)}


def test_chunks(spark):
    rows = [("a", 1, 4), ("a", 2, 4), ("a", 3, 25), ("a", 4, 3), ("b", 1, None), ("b", 2, 10), ("b", 3, 1)]
    got = sample.bounded_chunks(spark.createDataFrame(rows, "g string, i int, w int"), ["g"], ["i"], "w", 10).collect()
    assert sorted((r.g, r.i, r.chunk, r.parts) for r in got) == [("a", 1, 0, 1), ("a", 2, 0, 1), ("a", 3, 1, 3), ("a", 4, 4, 1), ("b", 1, 0, 1), ("b", 2, 0, 1), ("b", 3, 1, 1)]


def test_paths_with_a_cycle_and_a_guard(spark):
    rows = [("b", "a"), ("a", None), ("x", "y"), ("y", "x")] + [(f"n{i}", f"n{i - 1}") for i in range(1, 60)] + [("n0", None)]
    got = {r.node: r for r in graph.paths_to_root(spark.createDataFrame(rows, "c string, p string"), "c", "p").collect()}
    assert got["b"].path == "a/b" and not got["b"].cut and got["x"].cut and got["n59"].cut and got["n40"].depth == 40 and not got["n40"].cut


def test_redaction_longest_first(spark):
    v = F.array(*map(F.lit, ("Anna", "Anna Bell", "abc")))
    assert one(spark, text.redact_values(F.lit("Anna Bell met Anna, abc"), v)) == "[X] met [X], abc"


def test_one_to_one_equals_greedy(spark):
    rng = random.Random(4)
    pts = [(i, rng.random(), rng.random()) for i in range(60)]
    df = spark.createDataFrame(pts, "id int, x double, y double")
    pairs = spatial.radius_join(df.filter("id < 30"), df.filter("id >= 30"), ["x", "y"], 0.3).select("l_id", "r_id", "dist")
    got = {(r.l_id, r.r_id) for r in spatial.greedy_one_to_one(pairs, "l_id", "r_id").collect()}
    want, used = set(), set()
    for d, a, b in sorted((((x1 - x2) ** 2 + (y1 - y2) ** 2) ** 0.5, i, j) for i, x1, y1 in pts[:30] for j, x2, y2 in pts[30:]):
        if d <= 0.3 and a not in used and b not in used:
            want.add((a, b))
            used |= {a, b}
    assert got == want


def test_sort_largest_keeps_all_rows(spark, tmp_path):
    from millrace.plans.q_joins import o1

    sizes = [(i, None if i % 97 == 0 else 5 if i < 1200 else i % 50) for i in range(1500)]  # one size held by most rows
    spark.createDataFrame(sizes, "doc_id long, n_chars long").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    want = [(d, n, i + 1) for i, (d, n) in enumerate(sorted(sizes, key=lambda r: (r[1] is None, -(r[1] or 0), r[0])))]
    assert [tuple(r) for r in o1(spark, str(tmp_path)).select("doc_id", "n_chars", "pos").collect()] == want


def test_ranks_within_groups(spark):
    rows = [("a" if i % 10 else None, i * 7 % 1000) for i in range(1000)]
    got = ranked(spark.createDataFrame(rows, "g string, v int"), ["g"], [F.col("v")]).collect()
    by = {g: sorted(v for h, v in rows if h == g) for g in ("a", None)}
    assert len(got) == 1000 and all(by[r.g][r["rank"] - 1] == r.v for r in got)


def greedy_by_hand(left, right, radius):
    want, used_l, used_r = set(), set(), set()
    dist = lambda p, q: sum((a - b) * (a - b) for a, b in zip(p, q, strict=True)) ** 0.5
    for d, a, b in sorted((dist(p, q), i, j) for i, *p in left for j, *q in right):
        if d <= radius and a not in used_l and b not in used_r:
            want.add((a, b))
            used_l.add(a), used_r.add(b)
    return want


def test_one_to_one_goes_on_until_none_is_left(spark):
    left, right = [(i, 0.5) for i in range(24)], [(100 + i, 0.5) for i in range(25)]
    a, b = (spark.createDataFrame(x, "id int, x double") for x in (left, right))
    pairs = spatial.radius_join(a, b, ["x"], 0.1).select("l_id", "r_id", "dist")
    got = {(r.l_id, r.r_id) for r in spatial.greedy_one_to_one(pairs, "l_id", "r_id").collect()}
    assert got == greedy_by_hand(left, right, 0.1) and len(got) == 24
    assert spatial.greedy_one_to_one(pairs.limit(0), "l_id", "r_id").count() == 0


def test_points_match_with_copies(spark):
    rng = random.Random(8)
    spots = [(0.25 * rng.randrange(4), 0.25 * rng.randrange(4)) for _ in range(8)]  # exact ties between points, too
    rows = [(i, *rng.choice(spots)) for i in range(60)] + [(i, 9.0, -0.0 if i % 3 else 0.0) for i in range(60, 180)]
    rows += [(i, 20.0 + i % 2 / 10, 0.0) for i in range(180, 280)]  # copies whose nearest are copies of another point
    rng.shuffle(rows)
    df = spark.createDataFrame([*rows, (900, float("nan"), 0.0), (901, float("nan"), 0.0), (902, None, 0.0), (903, float("inf"), 0.0), (904, float("inf"), 0.0)], "id int, x double, y double")
    got = [(r.l_id, r.r_id) for r in spatial.match_points(df.filter("id % 2 = 0"), df.filter("id % 2 = 1"), ["x", "y"], 0.3, "id").collect()]
    want = greedy_by_hand([r for r in rows if r[0] % 2 == 0], [r for r in rows if r[0] % 2], 0.3)
    assert len(got) == len(set(got)) and set(got) == want and len(got) == 130


def test_mesh_and_overlap(spark):
    t = [(1, 0, 0, 0, 1, 0, 0, 0, 1, 0), (1, 0, 0, 0, 0, 1, 0, 0, 0, 1), (1, 0, 0, 0, 0, 0, 1, 1, 0, 0), (1, 1, 0, 0, 0, 0, 1, 0, 1, 0)]
    cols = "m int, ax double, ay double, az double, bx double, by double, bz double, cx double, cy double, cz double"
    rows = [(r[0], *map(float, r[1:])) for r in t]
    assert abs(spatial.mesh_volume(spark.createDataFrame(rows, cols), ["m"]).first().volume - 1 / 6) < 1e-12


def test_scalars(spark):
    names = spark.createDataFrame([("a/b.JPG",), ("x.j123",), ("noext",), ("q.p_9",), ("z.veryverylongext",), ("a.b-c",)], "p string").select(S.ext_norm(F.col("p")))
    assert [r[0] for r in names.collect()] == ["jpg", "j###", "(none)", "p_*", "(other)", "(other)"]
    f = spark.createDataFrame([("4 1/2",), ("3/8",), ("4-1/4",), ("4.5",), ("1/0",), ("x",)], "s string").select(S.fraction(F.col("s")))
    assert [r[0] for r in f.collect()] == [4.5, 0.375, 4.25, 4.5, None, None]
    sections = {"hss 6.00x4.0x0.250": "HSS6X4X0.25", "L4x3 1/2x3/8": "L4X3.5X0.375", "HSS12x12x1/2": "HSS12X12X0.5", "HSS12X12X.500": "HSS12X12X0.5", "PI8.625X0.375": "ROUND8.625X0.375", "TS4x4x1/4": "HSS4X4X0.25", "W30x99": "W30X99", "pl 2-1/2x7": "PL2.5X7", "W12 X a": "W12XA", "12x4": "12X4", "": "", "BEAM": "BEAM", "C10x1/0": "C10X1/0"}
    got = spark.createDataFrame([(k, v) for k, v in sections.items()], "s string, want string").select("want", S.section_canon(F.col("s")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    assert one(spark, S.canon_name(F.lit("B'eam \\X2\\00E4\\X0\\ \\X\\41"), escapes=True)) == "beamäa"
    coded = {"a\\X2\\00E400DF\\X0\\b": "aäßb", "\\X2\\D83DDE00\\X0\\": "😀", "\\X4\\0001F600\\X0\\!": "😀!", "\\X\\E9t\\X\\E9": "été", "c:\\\\d": "c:\\d", "\\X2\\00E\\X0\\": "\\X2\\00E\\X0\\", "plain": "plain", "\\X2\\0041": "\\X2\\0041", "": ""}
    got = spark.createDataFrame([(k, v) for k, v in coded.items()], "s string, want string").select("want", S.exchange_text(F.col("s")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    bores = [("0.125", "in", 6.0), ("3.5", "inch", 90.0), ("14", '"', 350.0), ("24.0004", " IN ", 600.0), ("7", "in", 175.0), ("88.94", "mm", 88.9), ("0", "in", None), ("x", "in", None), (None, "in", None), ("5", None, 5.0)]
    got = spark.createDataFrame(bores, "v string, u string, want double").select("want", S.bore_mm(F.col("v"), F.col("u")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    kinds = spark.createDataFrame([("tsc",), ("stp",), ("p_*",), ("j###",), ("pdf",), ("zzz",), (None,)], "e string").select(S.category_of(F.col("e")))
    assert [r[0] for r in kinds.collect()] == ["Tekla model files", "3D model", "Tekla model files", "Tekla model files", "PDF", "Other", "Other"]
    assert one(spark, S.category_of(F.lit("x"), {"x": "mine"})) == "mine"
    assert one(spark, S.round_sig(F.lit(123456.789), 3)) == 123000.0
    assert len(one(spark, S.safe_component(F.lit("a b" * 60), 40))) == 40
    assert one(spark, S.key_kind(F.lit("sha256:ff"))) == "marker" and one(spark, S.key_kind(F.lit(""))) == "empty" and one(spark, S.key_kind(F.lit("k"))) == "real"
    assert one(spark, S.first_match([(F.lit(True), "a"), (F.lit(True), "b")])) == "a"
    assert one(spark, S.shoelace(F.array(*map(F.lit, (0.0, 2.0, 2.0, 0.0))), F.array(*map(F.lit, (0.0, 0.0, 3.0, 3.0))))) == 6.0
    assert one(spark, S.base64_to_hex(F.lit("/w=="))) == "ff" and one(spark, S.inch_to_dn(F.lit(2))) == 50


def test_profile_areas(spark):
    import math

    v = {"x": 20, "y": 30, "r": 10, "w": 2, "b": 40, "h": 100, "tw": 3, "tf": 5, "fillet": 4, "outer": 6, "inner": 4, "girth": 7}
    dims = {k: F.lit(float(x)) for k, x in v.items()}
    want = {"Rectangle": 600, "RectangleHollow": 600 - 16 * 26 - (4 - math.pi) * 20, "Circle": 100 * math.pi, "CircleHollow": 36 * math.pi, "I": 400 + 90 * 3 + (4 - math.pi) * 16, "L": 2 * 138 + (1 - math.pi / 4) * 16, "U": 670, "T": 200 + 95 * 3 + (2 - math.pi / 2) * 16, "C": 2 * (100 + 80 + 14 - 8), "Z": 670, "Other": None}
    for kind, area in want.items():
        got = one(spark, S.profile_area(F.lit(kind), dims))
        assert got == area if area is None else abs(got - area) < 1e-9, kind
    for slope in ("flange_slope", "web_slope"):
        assert one(spark, S.profile_area(F.lit("T"), dims | {slope: F.lit(0.1)})) == 485
    assert one(spark, S.profile_area(F.lit("L"), {k: dims[k] for k in ("h", "w")})) == 2 * 198
    assert one(spark, S.profile_area(F.lit("I"), {})) is None


def test_small_functions(spark):
    assert one(spark, S.expected_measure(F.lit(5.0), F.lit(7.0), F.lit(1), F.lit("T"))) == 7.0 and one(spark, S.expected_measure(F.lit(5.0), F.lit(7.0), F.lit(2), F.lit("T"))) == 5.0
    assert one(spark, S.expected_measure(F.lit(0.0), F.lit(7.0), F.lit(2), F.lit("I"))) == 7.0
    assert one(spark, S.token(F.lit("a.b.c"), 1)) == "c" and one(spark, S.token(F.lit("a.b.c"), 4)) is None
    now = F.to_timestamp(F.lit("2024-01-01 00:10:00"))
    assert one(spark, S.fresh(F.to_timestamp(F.lit("2024-01-01 00:00:00")), 601, now)) and not one(spark, S.fresh(F.to_timestamp(F.lit("2024-01-01 00:00:00")), 600, now))
    import zlib

    assert one(spark, S.shard_of(F.lit("key"), 7)) == zlib.crc32(b"key") % 7
    turned = one(spark, S.rotate_z(F.array(*map(F.lit, (1.0, 0.0, 5.0))), F.radians(F.lit(90.0))))
    assert abs(turned[0]) < 1e-12 and abs(turned[1] - 1) < 1e-12 and turned[2] == 5.0
    assert [one(spark, grade.level_rank(F.lit(x))) for x in grade.LEVELS] == [1, 2, 3]


def test_typed_union_and_text_records(spark):
    a, b = spark.createDataFrame([(1, 2, 3, 4.5)], "oid int, iid int, dispid int, value double"), spark.createDataFrame([(1, 2, 4, "x")], "oid int, iid int, dispid int, value string")
    assert sorted((r.type, r.value) for r in graph.union_typed({"num": a, "str": b}).collect()) == [("num", "4.5"), ("str", "x")]
    rows = [(1, i, x) for i, x in enumerate(["head", "  a", "  b", "next", "  c"])]
    got = text.record_blocks(spark.createDataFrame(rows, "f int, i int, line string"), ["f"], "i", "line").orderBy("i").collect()
    assert [r.block for r in got] == [1, 1, 1, 2, 2]
    rows = [(1, i, x) for i, x in enumerate(["x", "BEGIN", "a", "b", "END", "y", "BEGIN", "c"])]
    got = text.bracketed(spark.createDataFrame(rows, "f int, i int, line string"), ["f"], "i", "line", "BEGIN", "END").orderBy("i").collect()
    assert [r.line for r in got] == ["a", "b", "c"]


def test_phone_pattern_is_linear(spark):
    import time

    t = time.time()
    assert one(spark, F.length(text.mask(F.lit("1" * 200_000 + " x"), {"PHONE": text.PHONE}))) == 200_002
    assert time.time() - t < 20
    assert one(spark, text.mask(F.lit("call +49 30 1234-5678 now"), {"PHONE": text.PHONE})) == "call [PHONE] now"


def test_descendants(spark):
    rng = random.Random(3)
    rows = [(i, rng.randrange(i) if i and rng.random() < 0.9 else None) for i in range(120)] + [(200, 201), (201, 200)]
    got = {int(r.node): (r.depth, r.n_descendants, r.n_leaves) for r in graph.descendants(spark.createDataFrame(rows, "c int, p int"), "c", "p").collect()}
    up = dict(rows)

    def way(i):
        out = []
        while up.get(i) is not None and up[i] in up and up[i] not in out:
            i = up[i]
            out.append(i)
        return out

    inner = set(up.values())
    for i in up:
        own = [j for j in up if i in way(j) and j != i]
        assert got[i] == (len([x for x in way(i) if x != i]), len(own), sum(j not in inner for j in own))


def test_a_large_hierarchy(spark):
    """More rows than a recursive query may make."""
    n = 400_000
    nodes = spark.range(n).select(F.col("id").alias("c"), F.when(F.col("id") > 0, F.floor((F.col("id") - 1) / 3)).alias("p"))
    got = graph.paths_to_root(nodes, "c", "p").agg(F.count("*"), F.max("depth"), F.sum("depth"), F.max(F.col("cut").cast("int"))).first()
    depth = [0] * n
    for i in range(1, n):
        depth[i] = depth[(i - 1) // 3] + 1
    assert tuple(got) == (n, max(depth), sum(depth), 0) and sum(depth) > 1_000_000


def test_running_sums_and_slices(spark):
    rng = random.Random(9)
    rows = [(rng.choice(("a", "b", None)), i, rng.randrange(5)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, i int, w int").repartition(5)
    got = running(df, ["g"], [F.col("i")], F.col("w"), "upto", "all").collect()
    for r in got:
        own = [(i, w) for g, i, w in rows if g == r.g]
        assert r["upto"] == sum(w for i, w in own if i <= r.i) and r["all"] == sum(w for _, w in own)
    for by in (["g"], []):
        tiles = slices(df, by, [F.col("i")], 7).collect()
        for g in ("a", "b", None) if by else (0,):
            own = sorted((r.i, r.tile) for r in tiles if not by or r.g == g)
            sizes = [sum(t == k for _, t in own) for k in range(1, 8)]
            assert [t for _, t in own] == sorted(t for _, t in own) and max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)
    assert slices(df.limit(0), [], [F.col("i")], 3).count() == 0


def test_matching_keeps_null_keys_apart(spark):
    a, b = (spark.createDataFrame([(None, i), ("x", i)], "k string, id int") for i in (1, 2))
    got = match.bag_match(a, b, ["k"], ["id"], ["id"]).collect()
    assert sorted((r.k or "", r.l is not None, r.r is not None) for r in got) == [("", False, True), ("", True, False), ("x", True, True)]
    assert sorted(r.status for r in match.reconcile(a, b, ["k"]).collect()) == ["both", "only_left", "only_right"]
    assert sorted((r.expected, r.found) for r in match.match_counts(a, b, ["k"]).collect()) == [(0, 1), (1, 0), (1, 1)]
    assert match.sorted_pairs(a, b, ["k"], ["id"], ["id"]).count() == 1


@pytest.mark.parametrize("block", [1, 7, 1_000_000])
def test_bag_overlap(spark, block):
    from collections import Counter

    rng = random.Random(6)
    bag = lambda n: [rng.choice("abcdefgh") for _ in range(n)]
    q, rows = [(i, bag(rng.randrange(6))) for i in range(6)], [(i, bag(rng.randrange(12))) for i in range(20)] + [(99, None)]
    got = match.bag_overlap(spark.createDataFrame(q, "q long, w array<string>"), spark.createDataFrame(rows, "r long, w array<string>"), "q", "r", "w", 0.5, block).collect()
    want = {}
    for i, x in q:
        for j, y in rows:
            n = (Counter(x) & Counter(y or ())).total()
            if n and n >= 0.5 * min(len(x), len(y)):
                want[i, j] = (n, round(n / min(len(x), len(y)), 4), round(n / (len(x) + len(y) - n), 4))
    assert {(r.q, r.r): (r.shared, r.overlap, r.jaccard) for r in got} == want and len(got) == len(want)


def test_one_to_one_on_a_whole_table(spark, small):
    from millrace.plans.catalogue import QUERIES

    rows = [(r.vec_id, *map(float, r.embedding[:3])) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    want = greedy_by_hand([r for r in rows if r[0] % 2 == 0], [r for r in rows if r[0] % 2], 0.05)
    assert {(r.l_vec_id, r.r_vec_id) for r in QUERIES["x7_one_to_one"](spark, small).collect()} == want


def test_a_chain_of_points(spark):
    pts, x = [], 0.0
    for i in range(120):
        pts.append((i, x))
        x += 1.0 - i * 0.004  # each point is nearer to the next one
    left, right = ([p for p in pts if p[0] % 2 == k] for k in (0, 1))
    a, b = (spark.createDataFrame(t, "id int, x double") for t in (left, right))
    got = {(r.l_id, r.r_id) for r in spatial.match_points(a, b, ["x"], 2.0, "id").collect()}
    assert got == greedy_by_hand(left, right, 2.0) and len(got) == 60


def test_match_passes(spark):
    import math

    rng = random.Random(12)
    a, b = ([(i, rng.uniform(0, 4), rng.uniform(0, 4), rng.choice((0.0, 1.0, 1.01, 2.0))) for i in range(40)] for _ in range(2))
    x, y = (spark.createDataFrame(t, "id int, x double, y double, v double") for t in (a, b))
    got = {(r.l_id, r.r_id, r["pass"]) for r in spatial.match_passes(x, y, ["x", "y"], "id", "v", 0.5, 0.05, 1.0, 3).collect()}
    cand = []
    for j, bx, by, bv in b:
        near = sorted((((ax - bx) * (ax - bx) + (ay - by) * (ay - by)) ** 0.5, i, av) for i, ax, ay, av in a)
        for d, i, av in [n for n in near if n[0] <= 1.0][:3]:
            ratio = av / bv if bv > 0 else 1.0 if av == 0 else None
            cand.append((d, abs(math.log(ratio)) if ratio else 99.0, i, j, ratio))
    cand.sort(key=lambda c: c[:4])
    want, ua, ub = set(), set(), set()
    for kind in ("exact", "near"):
        for d, _, i, j, ratio in cand:
            if i not in ua and j not in ub and (kind == "near" or (d <= 0.5 and ratio is not None and abs(ratio - 1) <= 0.05)):
                want.add((i, j, kind))
                ua.add(i), ub.add(j)
    assert got == want


def test_tolerance_join(spark):
    rng = random.Random(13)
    rows = lambda: [(i, rng.choice((1, -1)) * 10 ** rng.uniform(-1, 5), rng.uniform(0, 40)) for i in range(150)]
    a, b = rows(), rows()
    b += [(200 + i, v * rng.uniform(0.94, 1.06), w) for i, v, w in a]
    x, y = (spark.createDataFrame(t, "id int, v double, w double") for t in (a, b))
    near = lambda p, q, absolute, relative: abs(p - q) <= max(absolute, relative * abs(q))
    for tolerances in ({"v": (10.0, 0.05), "w": (3.0, 0.0)}, {"w": (0.5, 0.0)}):
        got = {(r.l_id, r.r_id) for r in spatial.tolerance_join(x, y, tolerances).collect()}
        at = {"v": 1, "w": 2}
        assert got == {(p[0], q[0]) for p in a for q in b if all(near(p[at[c]], q[at[c]], *t) for c, t in tolerances.items())}


def test_quota_with_truth(spark):
    rows = [("a", i, i % 10 == 0) for i in range(100)] + [("b", 1000, False)]
    got = sample.quota_sample(spark.createDataFrame(rows, "s string, id int, t boolean"), "s", "id", 20, "q", F.col("t")).collect()
    assert sum(r.t for r in got if r.s == "a") >= 9 and sum(r.s == "a" for r in got) == 19 and sum(r.s == "b" for r in got) == 1


def test_refresh_and_residual(spark):
    src = spark.createDataFrame([("k1", 5, 10), ("k2", 9, 10), ("k3", 1, 11)], "key string, modified long, size long")
    cop = spark.createDataFrame([("p", "k1", 6, 10), ("p", "k2", 6, 10), ("q", "k3", 6, 10), ("q", "k4", 1, 1)], "project string, key string, modified long, size long")
    assert {r.key: r.state for r in audit.refresh_plan(src, cop, "key", "project").collect()} == {"k1": "fresh", "k2": "stale", "k3": "stale", "k4": "missing"}
    packs = spark.createDataFrame([("a", "s1", 3), ("b", "s2", 1), ("c", None, 1), ("d", "s4", 0), ("e", "s5", 2), ("f", "s6", 2)], "id string, source string, n_rows long")
    mapped = spark.createDataFrame([("s1", "r1", 10), ("s2", "r2", 10), ("s5", "r5", 1)], "source string, rel string, size long")
    later = spark.createDataFrame([("r1", 10), ("r2", 11)], "rel string, size long")
    got = {r.id: r.reason for r in audit.residual(packs, mapped, later, "source").collect()}
    assert got == {"a": "same_size_on_later_disk", "b": "later_copy_differs_size", "c": "unknown_source", "d": "no_rows", "e": "not_on_later_disk", "f": "source_not_mapped"}
