"""Packages, findings, comparisons, covers, names, extents and adapters on small frames."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import extents, names
from millrace.operators import adapters, compare, cover, finding_rules, package, resolve
from millrace.sources import io


def test_package_checks_one_by_one(spark):
    m = "route string, project string, relpath string, etag string, bytes long, step_source string, converted_from string, source_key string"
    rows = [
        ("3d", "good", "model/step/a.stp", "e1", 5, "conv", None, "k1"), ("3d", "good", "doc/a.pdf", "e2", 6, None, None, None),
        ("2d", "flat", "model/step/b.stp", '"e3"', 5, None, "doc/missing.ifc", "k2"), ("2d", "flat", "model/step/c.stp", "e3", 5, "conv", "model/step/b.stp", "k2"), ("2d", "flat", "model/step/c.stp", "e4", 9, "conv", None, None),
        ("3d", "both", "doc/x", "", None, None, None, None), ("3d", "dark", "doc/x", "e", 1, None, None, None),
    ]
    o = [("3d", "good", "model/step/a.stp", 5), ("3d", "good", "doc/a.pdf", 6), ("3d", "good", "project.json", 1), ("2d", "flat", "model/step/b.stp", 7), ("2d", "flat", "spare", 1), ("3d", "none", "project.json", 1), ("3d", "more", "x", 1), ("3d", "both", "doc/x", 3)]
    p = [("3d", "good", 2, "3d", 1, True, True), ("2d", "flat", 3, "3d", 0, True, True), ("3d", "flat", 0, None, None, True, False), ("3d", "none", 0, None, None, False, True), ("3d", "more", 0, None, None, False, True), ("3d", "dark", 1, None, None, False, False), ("3d", "both", 1, "3d", 0, True, True)]
    frames = [spark.createDataFrame(rows, m), spark.createDataFrame(o, "route string, project string, relpath string, size long"), spark.createDataFrame(p, "route string, project string, files long, declared_route string, model_step long, manifest_ok boolean, project_ok boolean")]
    got = {(r.check, r.route, r.project): (r.n, r.example) for r in package.package_checks(*frames).collect()}
    assert not [k for k in got if k[2] == "good"]
    assert {k[0] for k in got if k[1:] == ("2d", "flat")} == {"duplicate_relpath_rows", "rows_without_object", "objects_without_row", "step_in_2d", "project_json_route_mismatch", "step_row_without_source", "converted_from_missing", "bytes_mismatch", "projects_with_content_duplicates", "projects_with_conversion_placed_twice"}
    assert got["rows_without_object", "2d", "flat"] == (1, "model/step/c.stp") and got["objects_without_row", "2d", "flat"] == (1, "spare") and got["converted_from_missing", "2d", "flat"] == (1, "doc/missing.ifc")
    assert {k[0] for k in got if k[1:] == ("3d", "flat")} == {"project_json_unreadable", "project_json_route_mismatch", "slots_model_step_mismatch", "3d_without_step", "project_in_both_routes"}
    assert {k[0] for k in got if k[2] == "none"} == {"empty_packages"} and {k[0] for k in got if k[2] in ("more", "dark")} == {"manifest_unreadable"}
    assert {k[0] for k in got if k[2] == "both"} == {"3d_without_step"}
    assert {k[0] for k in got} <= set(package.CHECKS) and len(package.CHECKS) == 16
    report = {r.check: r for r in package.package_report(package.package_checks(*frames), 1).collect()}
    assert report["manifest_unreadable"].n_projects == 2 and report["manifest_unreadable"].examples == "3d/dark"


CLEAN = {
    "kind": "step", "end_marker": True, "schema_class": "geometry", "solid_entities": 3, "surface_entities": 0, "manifest_found": True, "manifest_sha": "x", "sha": "x", "manifest_bytes": 5, "bytes": 5, "is_conversion": True, "match_precision": 1.0,
    "missing_pipeline": 0, "missing_source": 0, "missing_by_design": 0, "extra_parts": 0, "geometry_skipped": False, "geometry_error": False, "solid": 3, "impossible_solid": 0, "open_shell": 0, "brepcheck_invalid": 0, "brepcheck_checked": 100,
    "size_ratio_1": 1.0, "size_ratio_2": 1.0, "size_ratio_3": 1.0, "elements_meshed": 3, "volume": 10.0, "source_volume": 10.0, "impossible_elements": 0,
    **{f"n_{i}_{c.lower()}": 0 for i in finding_rules.PART_ISSUES for c in finding_rules.PART_CAUSES},
}


def test_finding_rules_edges(spark):
    cases = [
        ({}, []), ({"kind": "empty", "match_precision": None}, ["F_EMPTY"]), ({"end_marker": False, "schema_class": "cis2"}, ["F_TRUNCATED", "F_NOT_GEOMETRY"]), ({"manifest_found": None, "manifest_sha": None}, []), ({"manifest_found": False}, ["W_NOT_IN_MANIFEST"]),
        ({"manifest_sha": None}, ["F_SHA_MISMATCH"]), ({"manifest_bytes": 6}, ["F_SIZE_MISMATCH"]), ({"manifest_bytes": None}, []), ({"is_conversion": False, "extra_parts": 9}, ["I_NOT_IFC_CONVERSION"]), ({"match_precision": None, "extra_parts": 9}, ["W_NO_SOURCE"]),
        ({"match_precision": 0.9}, []), ({"match_precision": 0.8999, "missing_source": 2}, ["W_WEAK_SOURCE", "I_MISSING_SOURCE"]), ({"brepcheck_invalid": 1}, ["I_BREPCHECK"]), ({"brepcheck_invalid": 2}, ["W_BREPCHECK"]), ({"size_ratio_2": 1.02}, ["W_SIZE"]), ({"size_ratio_2": None}, []),
        ({"volume": 10.4}, []), ({"volume": 10.6}, ["W_VOLUME"]), ({"volume": 20.0, "open_shell": 1}, []), ({"solid": 0, "open_shell": 4, "n_open_shell_source": 4}, ["W_SURFACES_ONLY", "W_OPEN_SHELL_SOURCE"]), ({"n_broken_solid_unclassified": 2, "impossible_elements": 1}, ["W_BROKEN_SOLID_UNCLASSIFIED", "I_SOURCE_BROKEN"]),
    ]
    rows = [{"id": i} | CLEAN | c for i, (c, _) in enumerate(cases)]
    schema = ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'long' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for k, v in ({"id": 1} | CLEAN).items())
    got = finding_rules.model_findings(spark.createDataFrame([tuple(r.values()) for r in rows], schema), ["id"]).orderBy("id", "pos").collect()
    for i, (c, want) in enumerate(cases):
        assert [r.code for r in got if r.id == i] == want, c
    assert len(finding_rules.CODES) == 34
    own = [r for r in got if r.code == "W_SURFACES_ONLY"]
    assert [(r.cause, r.n) for r in own] == [("SOURCE", 4)]


def test_part_comparison(spark):
    p = lambda *xyz, bore=50.0: (*map(float, xyz), bore)
    schema = "uci string, ord int, type string, skey string, points array<struct<x: double, y: double, z: double, bore: double>>, branches array<struct<x: double, y: double, z: double, bore: double>>"
    left = [("a", 1, "PIPE", "", [p(0, 0, 0), p(5, 0, 0)], []), ("a", 2, "PIPE", "", [p(5, 0, 0), p(9, 0, 0)], []), ("b", 1, "BEND", "EL**", [p(0, 0, 0), p(0, 3, 0)], []), ("c-P1", 1, "TEE-STUB", "TE", [p(1, 1, 1)], [p(2, 2, 2)]), ("d", 1, "WELD", None, [], []), ("e", 1, "VALVE-X", "VAxx", [p(0, 0, 0)], []), ("m", 1, "DIMENSION", None, [], []), (None, 1, "PIPE", None, [], [])]
    right = [("a", 1, "PIPE", "", [p(0, 0, 0), p(9, 0, 0.5)], []), ("b", 1, "ELBOW", "ELBW", [p(0, 0, 0), p(0, 30, 0)], []), ("c", 1, "TEE-STUB", "TE", [p(1, 1, 1, bore=51.0)], [p(2, 2, 2.5)]), ("d", 1, "WELD", None, [], []), ("f", 1, "FLANGE", "FL", [p(0, 0, 0)], [])]
    got = {r.part: r for r in compare.compare_parts(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)).collect()}
    assert set(got) == {"a", "b", "d", "e", "f", "c"} and got["c"].status == "both"
    assert got["a"].max_dev == 0.5 and got["a"].same_kind and got["a"].key_state is None  # the split pipe's inner points don't count
    assert (got["b"].key_state, got["b"].max_dev, got["b"].bore_ok) == ("wildcard", 27.0, True) and got["b"].same_kind
    assert (got["c"].bore_ok, got["c"].branch_ok, got["c"].key_state) == (False, True, "exact")
    assert (got["d"].status, got["d"].item, got["d"].same_kind) == ("both", True, None)
    assert got["e"].status == "only_left" and got["f"].status == "only_right" and got["f"].kind == "FLANGE"
    sums = {r.kind: r for r in compare.part_counters(compare.compare_parts(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema))).collect()}
    assert (sums["ELBOW"].beyond_10, sums["ELBOW"].within_25, sums["PIPE"].points_ok, sums["WELD"].matched) == (1, 0, 1, 1)


def plain_cover(want, offers, least):
    need, total = Counter(want), len(want)
    chosen, held = [], Counter()
    covered = lambda bag: sum(min(bag[k], need[k]) for k in need)
    while True:
        gains = sorted((covered(held) - covered(held + Counter(b)), s) for s, b in offers.items() if s not in [c[0] for c in chosen])
        if not gains or -gains[0][0] / total <= least:
            return chosen
        held += Counter(offers[gains[0][1]])
        chosen.append((gains[0][1], -gains[0][0]))


def test_set_cover(spark):
    for seed in range(3):
        rng = random.Random(seed)
        want = [rng.choice("abcdefghijkl") for _ in range(150)]
        offers = {f"s{i}": [rng.choice("abcdefghijklmno") for _ in range(rng.randrange(40))] for i in range(12)}
        got = cover.greedy_cover(spark.createDataFrame([(w,) for w in want], "k string"), spark.createDataFrame([(s, w) for s, ws in offers.items() for w in ws], "s string, k string"), "k", "s", 0.02).orderBy("rank").collect()
        assert [(r.s, round(r.gain * len(want))) for r in got] == plain_cover(want, offers, 0.02)
    empty = spark.createDataFrame([], "k string")
    assert cover.greedy_cover(empty, spark.createDataFrame([], "s string, k string"), "k", "s").count() == 0


def test_set_cover_of_a_whole_table(spark, small):
    from millrace.plans.catalogue import QUERIES

    words = lambda t: [w for w in re.split("[^A-Za-z]+", t) if w]
    want = [w for r in spark.read.parquet(f"{small}/benchmark.parquet").collect() for w in words(r.text)]
    offers = {}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        offers.setdefault(r.source, []).extend(words(r.text))
    got = QUERIES["w13_set_cover"](spark, small).orderBy("rank").collect()
    assert [(r.source, round(r.gain * len(want))) for r in got] == plain_cover(want, offers, 0.001)


def test_names(spark):
    cases = {
        "JOIST 24K4 #12 (joist_envelope)": ("member", "JOIST", 12, None, "24K4", None, False, ["joist_envelope"]),
        "BEAM W12x40 #7": ("member", "BEAM", 7, None, "W12x40", None, False, []),
        "#1 / RB5/8 (piece 1)": ("piece", "", 1, 1, "RB5/8", None, False, []),
        "COL A #3 / PL 1/2 (piece 4, inst 2, approx, x y) member envelope": ("piece", "COL A", 3, 4, "PL 1/2", 2, True, ["approx", "x", "member_envelope"]),
        "JOIST #5 / 24K4 (member envelope)": ("piece", "JOIST", 5, 0, "24K4", None, False, ["member_envelope"]),
        "BOLT A325 0.75 x 2.5 (grip 1.25)": ("bolt", "BOLT", None, None, "BOLT 0.75", None, False, []),
        "BOLT 0.75 x 2.5 grip (nominal heavy hex) (inst 3)": ("bolt", "BOLT", None, None, "BOLT 0.75", None, False, ["bolt_guessed"]),
        "": ("unknown", "", None, None, "", None, False, []),
        "nothing": ("unknown", "", None, None, "", None, False, []),
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "name string").select("name", names.parse_name(F.col("name")).alias("n"))
    got = {r["name"]: tuple(r.n) for r in df.collect()}
    assert {k: v for k, v in got.items() if k is not None} == cases and got[None][0] == "unknown"


def test_extents(spark):
    rng = np.random.default_rng(4)
    rows, want = [], []
    for i in range(40):
        s = rng.uniform(-5, 5, 3)
        a = rng.normal(size=3)
        a /= np.linalg.norm(a)
        length, w, h = rng.uniform(2, 6), rng.uniform(0.1, 0.4), rng.uniform(0.1, 0.6)
        up = np.array([0, 0, 1.0])
        y = up - a * (up @ a)
        y /= np.linalg.norm(y)
        u = np.cross(a, y)
        card = int(rng.choice([1, 5, 8, 10, 0]))
        col, row = ((card - 1) % 3 - 1, (card - 1) // 3 - 1) if 1 <= card <= 9 else (0, 0)
        base = s - u * col * w / 2 - y * row * h / 2
        t0, t1 = rng.uniform(-0.3, 0.3), length + rng.uniform(-0.3, 0.3)
        pts = np.array([base + u * p * w / 2 + y * q * h / 2 + a * t for p in (-1, 1) for q in (-1, 1) for t in (t0, t1)])
        box = [*map(float, pts.min(0)), *map(float, pts.max(0))]
        off = 0.5 if i % 7 == 0 else 0.0
        rows.append((i, s.tolist(), (s + a * length).tolist(), None if i % 2 else [0.0, 0.0, 2.0], 0.0, False, card, w, h, box, float(t1 - t0 + off)))
        want.append((t0, t1, off == 0.0))
    rows += [(100, [0.0] * 3, [0.0] * 3, None, None, None, None, 0.1, 0.1, [0.0] * 6, None), (101, [0.0] * 3, [1.0, 0.0, 0.0], None, None, None, 5, None, 0.1, [0.0] * 6, None), (102, [0.0] * 3, [1.0, 0.0, 0.0], None, None, None, 5, 0.1, 0.1, None, None)]
    schema = "id long, start array<double>, end array<double>, up array<double>, roll double, mirror boolean, cardinal int, width double, depth double, box array<double>, cut_length double"
    got = {r.id: r for r in extents.fit_extents(spark.createDataFrame(rows, schema), "id").collect()}
    for i, (t0, t1, ok) in enumerate(want):
        assert math.isclose(got[i].t0, t0, abs_tol=2e-5) and math.isclose(got[i].t1, t1, abs_tol=2e-5) and got[i].ok == ok and got[i].residual < 1e-4
    assert all(got[i].t0 is None and not got[i].ok for i in (100, 101, 102)) and len(got) == 43


def test_adapters(spark):
    jobs = spark.createDataFrame([(i,) for i in range(5)], "id long")

    def verifier(job):
        if job["id"] == 1:
            raise RuntimeError("broken")
        return [{"verdict": "PASS"}, None, {"verdict": "MAYBE"}, None, {"verdict": "FAIL", "findings": [{"code": "c", "level": "FAIL", "cause": "SOURCE", "count": 2, "detail": "d"}]}][job["id"]]

    got = {r.id: r for r in adapters.verify(jobs, verifier, "id", "v").collect()}
    assert [got[i].verdict for i in range(5)] == ["PASS", "ERROR", "ERROR", "ERROR", "FAIL"] and got[1].findings[0].detail == "RuntimeError: broken" and got[4].findings[0]["count"] == 2

    class Mine(adapters.Disk):
        name, prefix = "mine", "root/"

        def files(self):
            rows = [("p", "a", 1, "s1", "root/a"), ("p", "b", 1, "s2", "src:x/b"), ("q", "c", 5, "s3", "disk12:z"), ("q", "d", 6, "s3", "prior:z"), ("q", "e", 0, "s9", ""), ("q", "f", 3, "s8", None), ("q", "g", 3, "s7", "else/g")]
            return spark.createDataFrame(rows, "project string, path string, size long, sha256 string, key string")

        def sources(self):
            return [("map", spark.createDataFrame([("s3", "m1", 5), ("s3", "m0", 5)], "sha256 string, place string, size long"), True), ("list", spark.createDataFrame([("s3", "l", 1), ("s7", "k", 1)], "sha256 string, place string, size long"), False)]

    got = {r.path: (r.place, r.how) for r in Mine().resolve().collect()}
    assert got == {"a": ("root/a", "mine"), "b": ("x/b", "mine_source"), "c": ("m0", "map"), "d": ("l", "list"), "e": (None, "empty"), "f": (None, "unresolved"), "g": ("k", "list")}
    assert {r.project: (r.files, r["size"]) for r in Mine().projects().collect()} == {"p": (2, 2), "q": (5, 17)}
    work = spark.createDataFrame([(1, "x", "small"), (2, "x", "large"), (3, "y", "small"), (4, None, "small")], "id int, kind string, cls string")
    stages = {("x", "small"): lambda df: df.withColumn("out", F.lit("s")), ("x", "large"): lambda df: df.withColumn("out", F.lit("l"))}
    got = {r.id: (r.out, r.error is None) for r in adapters.run_stages(work, stages).collect()}
    assert got == {1: ("s", True), 2: ("l", True), 3: (None, False), 4: (None, False)}


def test_resolve_keys_in_order(spark):
    rows = [("a", 5, ["src:s", "root/b", "root/a"]), ("b", 5, ["src:z", "src:y"]), ("c", 5, ["sha256:c"]), ("d", 5, ["sha256:d"]), ("e", 6, ["x"]), ("f", 7, []), ("g", 1, None)]
    contents = spark.createDataFrame(rows, "id string, size long, keys array<string>")
    frame = lambda *r: spark.createDataFrame(list(r), "id string, place string, size long")
    out = resolve.resolve_keys(contents, "id", "keys", "size", "root/", frame(("c", "m", 0), ("a", "n", 0)), [("map", frame(("d", "p", 5), ("e", "q", 5)), True), ("list", frame(("e", "r", 0), ("g", "t", 0)), False)])
    got = {r.id: (r.place, r.how) for r in out.collect()}
    assert got == {"a": ("root/a", "disk_real"), "b": ("y", "disk_source"), "c": ("m", "disk_marker"), "d": ("p", "map"), "e": ("r", "list"), "f": (None, "unresolved"), "g": ("t", "list")}


def test_ranged_reads_and_reload(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"0123456789")
    (tmp_path / "b.bin").write_bytes(b"xy")
    got = {r.path.rsplit("/", 1)[1]: (r.length, bytes(r.head), bytes(r.tail)) for r in io.read_ranges(io.list_files(spark, str(tmp_path)), 4).collect()}
    assert got == {"a.bin": (10, b"0123", b"6789"), "b.bin": (2, b"xy", b"xy")}
    now, loads = [0.0], []
    held = io.Reloaded(spark, str(tmp_path), lambda s, p: loads.append(1) or len(loads), 300, lambda: now[0])
    assert held.get() == 1 and held.get() == 1
    (tmp_path / "c.bin").write_bytes(b"x")
    assert held.get() == 1
    now[0] = 301.0
    assert held.get() == 2
    now[0] = 700.0
    assert held.get() == 2


def test_graph_identity_needs_distinct_ids(spark):
    f = lambda *r: spark.createDataFrame([("f", *x) for x in r], "file string, id long, type string, args string")
    assert io.same_graph(f((1, "P", "1."), (2, "L", "#1,#1")), f((5, "P", "1."), (9, "L", "#5,#5")))
    assert not io.same_graph(f((1, "P", "1."), (2, "L", "#1,#1")), f((5, "P", "1."), (9, "L", "#5,#9")))
    with pytest.raises(ValueError):
        io.same_graph(f((1, "P", "1."), (1, "L", "#1")), f((5, "P", "1.")))


def test_match_passes_on_a_whole_table(spark, small):
    from millrace.plans.catalogue import QUERIES

    pts = [(r.vec_id, *map(float, r.embedding[:3]), float(r.label)) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    a, b = ([p for p in pts if p[0] % 2 == k] for k in (0, 1))
    cand = []
    for j, *q, bv in b:
        near = sorted(((sum((x - y) * (x - y) for x, y in zip(p, q, strict=True)) ** 0.5, i, av) for i, *p, av in a))
        for d, i, av in [n for n in near if n[0] <= 0.05][:12]:
            ratio = av / bv if bv > 0 else 1.0 if av == 0 else None
            cand.append((d, abs(math.log(ratio)) if ratio else 99.0, i, j, ratio))
    want, ua, ub = set(), set(), set()
    for kind in ("exact", "near"):
        for d, _, i, j, ratio in sorted(cand, key=lambda c: c[:4]):
            if i not in ua and j not in ub and (kind == "near" or (d <= 0.03 and ratio is not None and abs(ratio - 1) <= 0.05)):
                want.add((i, j, kind))
                ua.add(i), ub.add(j)
    assert {(r.l_id, r.r_id, r["pass"]) for r in QUERIES["x9_match_passes"](spark, small).collect()} == want
