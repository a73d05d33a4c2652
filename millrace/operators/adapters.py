"""Plug-in points: verifiers with a fixed set of verdicts, disks by subclassing, and stages by kind and size class."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import key_kind

#: Verdicts, and the finding that stands where a verifier gave none.
VERDICTS = ("PASS", "WARN", "FAIL", "CANNOT_VERIFY", "ERROR")
NO_VERDICT = ("verifier_no_verdict", "error", "unclassified")
FINDING = "struct<code: string, level: string, cause: string, count: bigint, detail: string>"


def verify(jobs: DataFrame, verifier: Callable[[dict], dict], ident: str, name: str) -> DataFrame:
    """(ident, verifier, verdict, findings): one row per job, by a function from a job's row to a dict with verdict and findings.

    A function that raises, gives no dict or a verdict that is none of VERDICTS has verdict ERROR, with a finding that says why: no job is lost, and none fails the others.
    """

    def run(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            rows = []
            for job in pdf.to_dict("records"):
                detail, got = None, None
                try:
                    got = verifier(job)
                except Exception as e:  # a verifier's failure is its job's result
                    detail = f"{type(e).__name__}: {e}"
                if isinstance(got, dict) and got.get("verdict") in VERDICTS:
                    found = [{"code": None, "level": None, "cause": None, "count": None, "detail": None} | f for f in got.get("findings") or []]
                    rows.append((job[ident], name, got["verdict"], found))
                else:
                    code, level, cause = NO_VERDICT
                    rows.append((job[ident], name, "ERROR", [{"code": code, "level": level, "cause": cause, "count": 1, "detail": (detail or f"verdict {got!r}")[:300]}]))
            yield pd.DataFrame(rows, columns=[ident, "verifier", "verdict", "findings"])

    return jobs.mapInPandas(run, f"`{ident}` {jobs.schema[ident].dataType.simpleString()}, verifier string, verdict string, findings array<{FINDING}>")


class Disk:
    """A disk's contents as frames; a new disk overrides what is its own.

    files() gives the manifest: project, path, size, sha256, key. sources() gives more places of contents by sha256, in the order in which they are asked: (name, frame of sha256, place and
    size, must the size agree). resolve() adds place and how to each file.
    """

    name = "disk"
    #: Keys that are places on this disk begin with it.
    prefix = ""

    def files(self) -> DataFrame:
        raise NotImplementedError

    def projects(self) -> DataFrame:
        return self.files().groupBy("project").agg(F.count("*").alias("files"), F.sum("size").alias("size"))

    def sources(self) -> list[tuple[str, DataFrame, bool]]:
        return []

    def resolve(self) -> DataFrame:
        """Own objects, then own sources, then each of sources(); empty files need none, and the rest is unresolved."""
        kind, key = key_kind(F.col("key")), F.col("key")
        own = (kind == "real") & F.startswith(key, F.lit(self.prefix))
        out = self.files().withColumns({"place": F.when(own, key).when(kind == "source", F.substring_index(key, ":", -1)), "how": F.when(own, self.name).when(kind == "source", f"{self.name}_source")})
        for name, places, sized in self.sources():
            by = ["sha256", "size"] if sized else ["sha256"]
            one = places.groupBy(*by).agg(F.min("place").alias("_place"))
            out = out.join(one, by, "left").withColumns({"how": F.coalesce("how", F.when(F.col("_place").isNotNull(), name)), "place": F.coalesce("place", "_place")}).drop("_place")
        return out.withColumn("how", F.coalesce("how", F.when(F.col("size") == 0, "empty"), F.lit("unresolved")))


Stage = Callable[[DataFrame], DataFrame]


def run_stages(jobs: DataFrame, stages: dict[tuple[str, str], Stage], kind: str = "kind", size_class: str = "cls") -> DataFrame:
    """Each job through the stage that is injected for its kind and size class; `error` tells of jobs without one. Stages keep the jobs' columns and may add others."""
    each = F.struct(F.col(kind), F.col(size_class))
    done = [stage(jobs.filter((F.col(kind) == k) & (F.col(size_class) == c))).withColumn("error", F.lit(None).cast("string")) for (k, c), stage in stages.items()]
    known = reduce(lambda a, b: a | b, ((F.col(kind) == k) & (F.col(size_class) == c) for k, c in stages), F.lit(False))
    rest = jobs.filter(~F.coalesce(known, F.lit(False))).withColumn("error", F.concat(F.lit("no stage for "), F.to_json(each)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), done, rest)
