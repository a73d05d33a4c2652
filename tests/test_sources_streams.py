import gzip

import pytest
from pyspark.sql import functions as F

from millrace.sources import io
from millrace.streaming import streams


def test_jsonl(spark, tmp_path):
    rows = '{"path": "a b", "size": 1, "sha256": "x"}\n\n{bad\n{"path": "c"}\n'
    (tmp_path / "m.jsonl").write_text(rows, encoding="utf-8")
    with gzip.open(tmp_path / "n.jsonl.gz", "wt", encoding="utf-8") as f:
        f.write('{"path": "z", "sha256": "y"}\n')
    got = io.read_jsonl(spark, str(tmp_path), io.MANIFEST).collect()
    assert {r.path for r in got} == {"a b", None, "c", "z"} and [r._corrupt for r in got if r._corrupt] == ["{bad"]
    assert {r.path for r in io.read_manifest(spark, str(tmp_path)).collect()} == {"a b", "z"}


def test_binary_heads_and_gzip(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"0123456789")
    (tmp_path / "b.dat").write_bytes(gzip.compress(b"one\n\ntwo"))
    got = {r.path.rsplit("/", 1)[1]: r for r in io.head_tail(io.read_binary(spark, str(tmp_path)), 4).collect()}
    assert bytes(got["a.bin"].head) == b"0123" and bytes(got["a.bin"].tail) == b"6789"
    assert {r.line for r in io.read_maybe_gzip(spark, str(tmp_path)).collect()} == {"0123456789", "one", "two"}
    assert {r.size for r in io.list_files(spark, str(tmp_path), "*.bin").collect()} == {10}


def test_guards():
    assert io.guard_path("/out/x/y", ["/out/x"]) == "/out/x/y"
    for bad in ("/out/xy", "/out/x/../z", "/other"):
        with pytest.raises(PermissionError):
            io.guard_path(bad, ["/out/x"])
    assert io.guard_sql("select 'drop table t' from x -- delete\n; insert into #tmp select 1")
    for good in ("select * into #t from x", "create table #t (a int); insert #t select 1; insert into [#t] values (2); drop table if exists #t", "create nonclustered index i on #t (a)", "truncate table #t", "select [delete], \"into\" from x", "select a from #t where b in (select c from real)"):
        assert io.guard_sql(good) == good
    for bad in ("delete from t", "select 1; drop table t", "select * into t from x", "DELETE FROM real WHERE id IN (SELECT id FROM #t)", "insert into real select * from #t", "insert real select * from #t", "deny select on #t to x", "exec sp_x #t", "create view v as select * from #t", "create index i on real (a) -- #t", "update #t set a = 1", "merge real using #t on 1 = 1", "select * into [real] from #t"):
        with pytest.raises(PermissionError):
            io.guard_sql(bad)


def test_record_texts(spark, tmp_path):
    (tmp_path / "a.nc").write_text("ST\n** note\nO1\nD1\n1\nM7\nS355\n4\nHEA\nI\n1000\nBO\n v 1 2\n v 3 4\nSI\n x\nEN\n")
    (p,) = io.cutting_parts(io.text_lines(spark, f"{tmp_path}/a.nc")).collect()
    assert (p.order, p.mark, p.qty, p.section, p.length, p.holes) == ("O1", "M7", "4", "HEA", "1000", 2)
    (tmp_path / "k.csv").write_text("H,x\nD,m1,S355,2,W8,120\nD,m2,,x,W9,\n")
    got = io.bill_lines(io.text_lines(spark, f"{tmp_path}/k.csv"), scale=25.4).collect()
    assert [(r.mark, r.qty, r.length) for r in got] == [("m1", 2, 3048.0), ("m2", None, None)]


def test_exchange_files(spark, tmp_path):
    (tmp_path / "1.stp").write_text("#1 = POINT (1.);\n#2 = LINE (#1,\n #1);\n")
    (tmp_path / "2.stp").write_text("#5 = POINT (1.);\n#9 = LINE (#5, #5);\n")
    r = io.exchange_records(io.text_lines(spark, str(tmp_path))).cache()
    a, b = r.filter(F.col("file").endswith("1.stp")), r.filter(F.col("file").endswith("2.stp"))
    squeeze = lambda df: df.withColumn("args", F.regexp_replace("args", r"\s+", ""))
    assert io.same_graph(squeeze(a), squeeze(b)) and not io.same_graph(squeeze(a), squeeze(b).filter("id > 5"))
    guards = spark.createDataFrame([("a", "X", "mm"), ("b", "X", "mm")], "file string, schema string, unit string")
    got = sorted((x.id, x.args.replace(" ", "")) for x in io.concat_records(r, guards, ["schema", "unit"]).collect())
    assert got == [(1, "1."), (2, "#1,#1"), (7, "1."), (11, "#7,#7")]
    with pytest.raises(ValueError):
        io.concat_records(r, guards.withColumn("unit", F.col("file")), ["schema", "unit"])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", bytearray(b"x")), (2, "b", None)], "id int, s string, b binary")
    assert io.export_tables({"t": df, "u": df}, str(tmp_path), {"u": 9}) == ["u", "t"]
    assert spark.read.json(f"{tmp_path}/t").columns == ["id", "s"]
    io.write_csv(df, f"{tmp_path}/csv", ["s", "missing"])
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").columns == ["s", "missing"]
    io.write_csv(df, f"{tmp_path}/tsv", ["id", "s"])
    assert io.read_delimited(spark, f"{tmp_path}/tsv", "id int, s string", ",", True).count() == 2


def test_upsert_and_tokens(spark):
    a = spark.createDataFrame([(1, 1, "old"), (2, 5, "kept")], "k int, t int, v string")
    b = spark.createDataFrame([(1, 2, "new"), (2, 4, "late"), (3, 1, "add")], "k int, t int, v string")
    assert {r.k: r.v for r in io.upsert(a, b, ["k"], ["t"]).collect()} == {1: "new", 2: "kept", 3: "add"}
    assert spark.range(1).select(io.token_count(F.lit("a\nb a\nb"), "a\nb")).first()[0] == 2


def test_stream_rounds_equal_the_batch(spark, tmp_path):
    src, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    frame = lambda rows: spark.createDataFrame(rows, "k string, size long")
    out = []
    for i, rows in enumerate(([("a", 1), ("b", 2)], [("a", 5)], [])):
        if rows:
            frame(rows).coalesce(1).write.mode("append").parquet(src)
        s = streams.incremental_totals(streams.read_folder(spark, src, "k string, size long"), ["k"], "size")
        streams.run_round(s, ck + str(i), "memory", f"round{i}").awaitTermination()
        out.append({r.k: (r.n, r["size"]) for r in spark.table(f"round{i}").collect()})
    assert out[0] == {"a": (1, 1), "b": (1, 2)} and out[1] == out[2] == {"a": (2, 6), "b": (1, 2)}


def test_each_content_once_across_rounds(spark, tmp_path):
    src, ck, got = str(tmp_path / "in"), str(tmp_path / "ck"), []
    for rows in ([("x",), ("x",), ("y",)], [("y",), ("z",)]):
        spark.createDataFrame(rows, "sha string").coalesce(1).write.mode("append").parquet(src)
        stream = streams.first_per_content(streams.read_folder(spark, src, "sha string"), "sha")
        streams.each_batch(stream, ck, lambda df, i: got.append(sorted(r.sha for r in df.collect()))).awaitTermination()
    assert [x for x in got if x] == [["x", "y"], ["z"]]


def test_rules(spark):
    rows = [("done", 9, True, "small"), ("failed", 1, True, "small"), ("failed", 1, True, "large"), ("failed", 3, False, "small"), ("queued", 0, False, "small")]
    df = spark.createDataFrame(rows, "s string, n int, m boolean, c string")
    assert [r[0] for r in df.select(streams.next_status(*map(F.col, "snmc"))).collect()] == ["done", "escalate", "retry", "given_up", "queued"]
    assert streams.may_finish(0, 0, 5.0, 4.0) and not streams.may_finish(0, 0, 3.0, 4.0) and not streams.may_finish(1, 0, 5.0, 4.0)
    seen = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, tag string")
    now = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "1")], "k string, tag string")
    assert sorted(r.k for r in streams.changed(now, seen, "k", "tag").collect()) == ["b", "c"]


def test_jdbc(spark, tmp_path):
    """Against the embedded database that Spark brings along."""
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    driver = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark.createDataFrame([(i, f"v{i}") for i in range(20)], "id int, v string").write.jdbc(url, "t", properties=driver)
    got = io.read_jdbc(spark, url, {"all": "select * from t", "few": 'select "id" from t where "id" < 3'}, driver)
    assert got["all"].count() == 20 and sorted(r[0] for r in got["few"].collect()) == [0, 1, 2]
    parts = io.read_jdbc(spark, url, {"t": "select * from t"}, driver, "id", (0, 20, 4))["t"]
    assert parts.rdd.getNumPartitions() == 4 and parts.count() == 20
    with pytest.raises(PermissionError):
        io.read_jdbc(spark, url, {"x": "delete from t"}, driver)


def test_union_of_frames(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2, 0.5)], "i int, f double")
    assert sorted((r.i, r.s, r.f) for r in io.union_all([a, b]).collect()) == [(1, "x", None), (2, None, 0.5)]


def test_owned_tables_go(spark):
    import os

    from millrace.session import Stash, owned

    with owned(spark):
        stash = Stash(spark, "mine")
        assert stash.put(spark.range(3)).count() == 3
        plain = lambda s: s.base.removeprefix("file://")
        here = plain(stash)
        assert os.path.isdir(here)
        with owned(spark):
            inner = Stash(spark, "inner")
            inner.put(spark.range(1))
        assert not os.path.isdir(plain(inner)) and os.path.isdir(here)
    assert not os.path.isdir(here)
    free = Stash(spark, "free")
    assert free.put(spark.range(2)).count() == 2 and os.path.isdir(plain(free))
