"""Sources and sinks: JSON lines, delimited text, record texts, JDBC, binary heads, spreadsheets' rows, guarded writers."""

from __future__ import annotations

import gzip
import io
import itertools
import re
import time
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.order import ranked

#: The manifest's fields.
MANIFEST = T.StructType([T.StructField(n, t) for n, t in (("path", T.StringType()), ("size", T.LongType()), ("sha256", T.StringType()), ("key", T.StringType()), ("dedup", T.StringType()))])
CORRUPT = "_corrupt"


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType, encoding: str = "UTF-8") -> DataFrame:
    """JSON lines, gzip by extension, split at line feeds alone; blank lines are skipped and bad ones kept in _corrupt."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("lineSep", "\n").option("encoding", encoding)
    return reader.json(path)


def read_manifest(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Manifest rows that have a hash."""
    return read_jsonl(spark, path, MANIFEST).filter("sha256 is not null and sha256 <> ''").drop(CORRUPT)


def prefiltered_json(rows: DataFrame, value: str, pattern: str, schema: str) -> DataFrame:
    """Rows whose raw text fits a pattern, and only those parsed (`j`)."""
    return rows.filter(F.rlike(F.col(value), F.lit(pattern))).withColumn("j", F.from_json(value, schema))


def read_binary(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files below a folder as rows, by any filesystem that Spark reads: path, modificationTime, length, content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """A listing without contents: the content column is pruned from the scan. Empty files are no rows of such a scan."""
    return read_binary(spark, path, glob).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def head_tail(files: DataFrame, size: int = 65536) -> DataFrame:
    """The first and last bytes of each file."""
    return files.select("path", "length", F.expr(f"substring(content, 1, {size})").alias("head"), F.expr(f"substring(content, greatest(1, cast(length - {size} + 1 as int)), {size})").alias("tail"))


def read_ranges(files: DataFrame, size: int = 65536) -> DataFrame:
    """(path, length, head, tail) of a listing: only these bytes are read, by ranged reads of any pyarrow filesystem."""

    def run(batches):
        from pyarrow import fs

        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                store, at = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                with store.open_input_file(at) as f:
                    n = f.size()
                    head = f.read_at(min(size, n), 0)
                    rows.append((path, n, head, f.read_at(min(size, n), max(0, n - size))))
            yield pd.DataFrame(rows, columns=["path", "length", "head", "tail"])

    return files.select("path").mapInPandas(run, "path string, length long, head binary, tail binary")


class Reloaded:
    """Support files that are loaded anew when their listing (path, length, time) changes, looked at no more often than every `seconds`. For a batch function of a stream, or a driver's loop."""

    def __init__(self, spark: SparkSession, path: str, load, seconds: float = 300, clock=time.monotonic):
        self.spark, self.path, self.load, self.seconds, self.clock = spark, path, load, seconds, clock
        self.at, self.seen, self.value = None, None, None

    def get(self):
        if self.at is None or self.clock() - self.at >= self.seconds:
            self.at = self.clock()
            now = sorted((r["path"], r["size"], r["modified"]) for r in list_files(self.spark, self.path).collect())
            if now != self.seen:
                self.seen, self.value = now, self.load(self.spark, self.path)
        return self.value


def is_gzip(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 2)) == "1F8B"


def read_maybe_gzip(spark: SparkSession, path: str, rows: int = 10_000) -> DataFrame:
    """(path, line) of texts that may be compressed whatever their name; a file is decompressed as a stream, and lines are handed on `rows` at a time."""

    def run(batches):
        for pdf in batches:
            for p, c in zip(pdf["path"], pdf["content"], strict=True):
                stream = io.BytesIO(c)
                text = io.TextIOWrapper(gzip.GzipFile(fileobj=stream) if c[:2] == b"\x1f\x8b" else stream, "utf-8", "replace", newline="\n")
                lines = (x.removesuffix("\n") for x in text)
                while part := list(itertools.islice((x for x in lines if x.strip()), rows)):
                    yield pd.DataFrame({"path": p, "line": part})

    return read_binary(spark, path).select("path", "content").mapInPandas(run, "path string, line string")


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = "\t", header: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The named columns in order; missing ones are null, others are left out."""
    df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns)).write.mode("overwrite").option("header", True).csv(path)


def write_jsonl(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """JSON lines under Spark's commit protocol: readers see all of it or nothing."""
    df.write.mode("overwrite").option("compression", compression).json(path)


def guard_path(path: str, allowed: list[str]) -> str:
    """The path, if it lies under an allowed prefix and doesn't climb out of it."""
    if ".." in path.split("/") or not any(path == a.rstrip("/") or path.startswith(a.rstrip("/") + "/") for a in allowed):
        raise PermissionError(f"not under an allowed prefix: {path}")
    return path


#: Verbs that change something.
VERBS = ("insert", "update", "delete", "merge", "drop", "alter", "create", "truncate", "exec", "execute", "grant", "revoke", "deny")

_QUIET = re.compile(r"'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/", re.S)
_NAMED = re.compile(r'\[([^\]]*)\]|"([^"]*)"')
_INDEX = r"(?:unique\s+)?(?:(?:non)?clustered\s+)?index"
#: What may follow a verb: the object that is written, which must be a temporary one. Other verbs may not be used at all.
_ALLOWED = {"insert": r"(?:into\s+)?#", "create": rf"(?:table\s+#|{_INDEX}\s+\w+\s+on\s+#)", "drop": rf"(?:table\s+(?:if\s+exists\s+)?#|{_INDEX}\s+\w+\s+on\s+#)", "alter": r"table\s+#", "truncate": r"table\s+#"}


def guard_sql(sql: str) -> str:
    """The text, if it only reads, or what it writes is a temporary table (#name): by the object behind each verb, not by names elsewhere in the statement."""
    bare = _NAMED.sub(lambda m: (m[1] or m[2] or "") if (m[1] or m[2] or "").startswith("#") else "q", _QUIET.sub(" ", sql))
    for m in re.finditer(rf"\b({'|'.join(VERBS)}|into)\b\s*", bare, re.I):
        verb, rest = m[1].lower(), bare[m.end() :]
        if verb == "into":
            fine = rest.startswith("#") or re.search(r"\binsert\s+$", bare[: m.start()], re.I)  # insert judges its own
        else:
            fine = verb in _ALLOWED and re.match(_ALLOWED[verb], rest, re.I)
        if not fine:
            raise PermissionError(f"only SELECT, and temporary tables: {bare[max(0, m.start() - 20) : m.end() + 60].strip()}")
    return sql


def read_jdbc(spark: SparkSession, url: str, queries: dict[str, str], properties: dict[str, str] | None = None, key: str | None = None, bounds: tuple[int, int, int] | None = None) -> dict[str, DataFrame]:
    """Named result sets over JDBC; with a numeric key and bounds (low, high, parts) reads are split. Needs the database's driver on the class path."""
    out = {}
    for name, sql in queries.items():
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({guard_sql(sql)}) q").options(**(properties or {}))
        if key and bounds:
            reader = reader.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", bounds[2])
        out[name] = reader.load()
    return out


def export_tables(tables: dict[str, DataFrame], path: str, sizes: dict[str, int] | None = None) -> list[str]:
    """Each table as JSON lines with a schema beside it, the largest first; binary columns are left out."""
    done = []
    for name in sorted(tables, key=lambda t: (-(sizes or {}).get(t, 0), t)):
        df = tables[name]
        keep = [f.name for f in df.schema if not isinstance(f.dataType, T.BinaryType)]
        write_jsonl(df.select(*keep), f"{path}/{name}")
        df.sparkSession.createDataFrame([(df.select(*keep).schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}.schema")
        done.append(name)
    return done


def upsert(base: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Insert or replace by key: of both tables' rows the last by `order`."""
    from millrace.operators.resolve import latest

    return latest(base.unionByName(changes), keys, order)


def text_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """(file, pos, line) of text files: each is split in the JVM, by line feeds."""
    body = F.decode("content", encoding)
    rows = read_binary(spark, path).select(F.col("path").alias("file"), F.posexplode(F.split(body, "\n")).alias("pos", "line"))
    return rows.withColumn("line", F.regexp_replace("line", "\r$", ""))


#: Header lines of a cutting file by position.
NC_HEADER = ("order", "drawing", "phase", "mark", "grade", "qty", "section", "code", "length")


def cutting_parts(lines: DataFrame) -> DataFrame:
    """Header fields by position after the ST line (comments apart), and the lines within BO blocks as `holes`."""
    w = Window.partitionBy("file").orderBy("pos")
    body = lines.withColumn("v", F.trim("line")).filter("v <> '' and not startswith(v, '**')")
    n = body.withColumn("i", F.row_number().over(w) - 2)
    block = F.last(F.when(F.rlike("v", F.lit("^[A-Z][A-Z]$")), F.col("v")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    n = n.withColumn("block", block)
    field = lambda i, name: F.max(F.when(F.col("i") == i, F.col("v"))).alias(name)
    holes = F.sum(((F.col("block") == "BO") & (F.col("v") != "BO")).cast("long")).alias("holes")
    return n.groupBy("file").agg(*(field(i, name) for i, name in enumerate(NC_HEADER)), holes)


def bill_lines(lines: DataFrame, kind: str = "D", scale: float = 1.0) -> DataFrame:
    """Comma-separated records of one kind: mark, material, qty, section and length (scaled)."""
    p = F.split("line", ",")
    rows = lines.filter(F.startswith("line", F.lit(f"{kind},"))).withColumn("p", p)
    at = lambda i: F.trim(F.get("p", F.lit(i)))
    return rows.select("file", "pos", at(1).alias("mark"), at(2).alias("material"), at(3).try_cast("int").alias("qty"), at(4).alias("section"), (at(5).try_cast("double") * scale).alias("length"))


def exchange_records(lines: DataFrame) -> DataFrame:
    """Entities `#id = TYPE(args);` of an exchange file, which may run over lines."""
    whole = lines.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), " ").alias("t"))
    found = whole.select("file", F.explode(F.regexp_extract_all("t", F.lit(r"(#[0-9]+\s*=\s*[A-Z0-9_]+\s*\([^;]*\)\s*;)"), 1)).alias("r"))
    part = lambda i: F.regexp_extract("r", r"#([0-9]+)\s*=\s*([A-Z0-9_]+)\s*\((.*)\)\s*;", i)
    return found.select("file", part(1).cast("long").alias("id"), part(2).alias("type"), part(3).alias("args"))


def concat_records(records: DataFrame, guards: DataFrame, guard_columns: list[str]) -> DataFrame:
    """Records of several files under new ids past the ids before; refused where the files' guards (schema, unit) differ."""
    differ = guards.agg(*(F.countDistinct(c).alias(c) for c in guard_columns)).first()
    if any(differ[c] > 1 for c in guard_columns):
        raise ValueError("schema or unit differ between the files")
    tops = records.groupBy("file").agg(F.max("id").alias("top"))
    base = tops.withColumn("base", F.coalesce(F.sum("top").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row per file
    out = records.join(base.select("file", "base"), "file")
    # References move by the file's base too: the text between them stays.
    parts = F.split("args", "#")
    moved = F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.concat((F.regexp_extract(p, "^[0-9]+", 0).cast("long") + F.col("base")).cast("string"), F.regexp_replace(p, "^[0-9]+", ""))))
    return out.select("file", (F.col("id") + F.col("base")).alias("id"), "type", F.array_join(moved, "#").alias("args"))


def same_graph(a: DataFrame, b: DataFrame) -> bool:
    """Are two files' records the same up to numbering? Ids become places in the order of ids; then records must agree one by one, and no place stand for two ids."""

    def told(r):
        rank = ranked(r.select("id"), [], [F.col("id")])
        if rank.groupBy("id").count().filter("count > 1").isEmpty() is False:
            raise ValueError("an id stands for two records")
        refs = r.select("id", "type", F.posexplode(F.split("args", "#")).alias("i", "p"))
        ref = F.when(F.col("i") > 0, F.regexp_extract("p", "^[0-9]+", 0).try_cast("long"))
        known = refs.withColumn("ref", ref).join(rank.select(F.col("id").alias("ref"), F.col("rank").alias("to")), "ref", "left")
        text = F.when(F.col("i") == 0, F.col("p")).otherwise(F.concat(F.lit("#"), F.coalesce(F.col("to").cast("string"), F.lit("?")), F.regexp_replace("p", "^[0-9]+", "")))
        args = known.withColumn("s", text).groupBy("id", "type").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]), "").alias("args"))
        return args.join(rank, "id").select("rank", "type", "args")

    x, y = told(a), told(b)
    return x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()


def token_count(text: Column, token: str) -> Column:
    """How often a literal occurs, without overlaps, line breaks included."""
    return F.size(F.split(text, re.escape(token))) - 1


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
