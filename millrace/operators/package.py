"""Verification of delivered packages: manifest, stored objects and project records against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The checks.
CHECKS = (
    "empty_packages",
    "manifest_unreadable",
    "project_json_unreadable",
    "duplicate_relpath_rows",
    "rows_without_object",
    "objects_without_row",
    "step_in_2d",
    "3d_without_step",
    "project_json_route_mismatch",
    "slots_model_step_mismatch",
    "project_in_both_routes",
    "step_row_without_source",
    "converted_from_missing",
    "bytes_mismatch",
    "projects_with_content_duplicates",
    "projects_with_conversion_placed_twice",
)
#: Folder of the converted models, and files that need no row.
MODELS, META = "model/step/", ("manifest.jsonl", "project.json")


def package_checks(manifest: DataFrame, objects: DataFrame, projects: DataFrame) -> DataFrame:
    """(check, route, project, n, example): one row for each check that a project fails, with the size of the fault and the least example.

    manifest: route, project, relpath, etag, bytes, step_source, converted_from, source_key. objects: route, project, relpath, size. projects: route, project,
    files, declared_route, model_step (both null where the record can't be read), manifest_ok, project_ok. Each check is an aggregate or an equi-join by project; the
    faults meet in one row a project, and one scan tells them.
    """
    per = ["route", "project"]
    n = lambda c: F.count(F.when(c, 1))
    step = F.startswith("relpath", F.lit(MODELS))
    told = lambda c: F.coalesce(c, F.lit("")) != ""
    extras = lambda df, by: df.groupBy(*per, *by).agg(F.count("*").alias("_c")).groupBy(*per).agg(F.sum(F.col("_c") - 1).alias("n"))

    rows = manifest.groupBy(*per, "relpath").agg(F.count("*").alias("_rows"), F.min("bytes").alias("_lo"), F.max("bytes").alias("_hi"))
    stored = objects.groupBy(*per, "relpath").agg(F.max("size").alias("_size"))
    both = rows.join(stored, [*per, "relpath"], "full")
    lost, spare = F.col("_size").isNull(), F.col("_rows").isNull() & ~F.col("relpath").isin(*META)
    differ = F.coalesce((F.col("_lo") != F.col("_size")) | (F.col("_hi") != F.col("_size")), F.lit(False))
    first = lambda c: F.min(F.when(c, F.col("relpath")))
    files = both.groupBy(*per).agg(
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("dup"), n(lost).alias("lost"), first(lost).alias("lost_x"), n(spare).alias("spare"), first(spare).alias("spare_x"),
        n(differ).alias("differ"), first(differ).alias("differ_x"), n(F.col("_size").isNotNull() & (F.col("relpath") != "project.json")).alias("stored"),
    )
    steps = manifest.filter(step).groupBy(*per).agg(F.count("*").alias("steps"), n(F.col("step_source").isNull()).alias("unsourced"))
    known = rows.select(*per, F.col("relpath").alias("converted_from"))
    orphans = manifest.filter(step & told(F.col("converted_from"))).join(known, [*per, "converted_from"], "left_anti").groupBy(*per).agg(F.count("*").alias("orphans"), F.min("converted_from").alias("orphans_x"))
    channel = F.array_join(F.slice(F.split("relpath", "/"), 1, 2), "/")
    etag = F.trim(F.col("etag"), F.lit('"'))
    same = extras(manifest.filter(told(etag)).select(*per, channel.alias("_ch"), etag.alias("_tag"), "bytes"), ["_ch", "_tag", "bytes"]).withColumnRenamed("n", "same")
    twice = extras(manifest.filter(step & told(F.col("converted_from")) & told(F.col("source_key"))), ["source_key"]).withColumnRenamed("n", "twice")
    flat = projects.filter("route = '2d'").select("project").distinct().withColumn("_flat", F.lit(True))
    p = projects.join(flat, "project", "left")
    for df in (files, steps, orphans, same, twice):
        p = p.join(df, per, "left")
    counts = ("dup", "lost", "spare", "differ", "stored", "steps", "unsourced", "orphans", "same", "twice")
    p = p.fillna(0, list(counts))

    c, one, none = F.col, F.lit(1).cast("long"), F.lit(None).cast("string")
    solid = c("route") == "3d"
    empty = c("project_ok") & (F.coalesce("files", F.lit(0)) == 0) & (c("stored") == 0)
    faults = {
        "project_json_unreadable": (~c("project_ok"), one, none),
        "duplicate_relpath_rows": (c("dup") > 0, c("dup"), none),
        "rows_without_object": (c("lost") > 0, c("lost"), c("lost_x")),
        "objects_without_row": (c("spare") > 0, c("spare"), c("spare_x")),
        "step_in_2d": ((c("route") == "2d") & (c("steps") > 0), c("steps"), none),
        "3d_without_step": (solid & (c("steps") == 0), one, none),
        "project_json_route_mismatch": (~c("declared_route").eqNullSafe(c("route")), one, c("declared_route")),
        "slots_model_step_mismatch": (solid & ~c("model_step").eqNullSafe(c("steps")), one, F.concat_ws(" ", c("model_step"), c("steps"))),
        "project_in_both_routes": (solid & F.coalesce("_flat", F.lit(False)), one, none),
        "step_row_without_source": (c("unsourced") > 0, c("unsourced"), none),
        "converted_from_missing": (c("orphans") > 0, c("orphans"), c("orphans_x")),
        "bytes_mismatch": (c("differ") > 0, c("differ"), c("differ_x")),
        "projects_with_content_duplicates": (c("same") > 0, c("same"), none),
        "projects_with_conversion_placed_twice": (c("twice") > 0, c("twice"), none),
    }
    fault = lambda name, cond, size, x: F.when(cond, F.struct(F.lit(name).alias("check"), size.cast("long").alias("n"), x.alias("example")))
    unread = F.array(fault("empty_packages", empty, one, none), fault("manifest_unreadable", ~empty, one, none))
    found = F.when(c("manifest_ok"), F.array(*(fault(k, *v) for k, v in faults.items()))).otherwise(unread)
    return p.select(*per, F.explode(F.filter(found, lambda x: x.isNotNull())).alias("f")).select("f.check", *per, "f.n", "f.example")


def package_report(found: DataFrame, most: int = 50) -> DataFrame:
    """(check, n_projects, total, examples): each check's failing projects, the first `most` of them by name."""
    name = F.concat_ws("/", "route", "project")
    rn = F.row_number().over(Window.partitionBy("check").orderBy("route", "project"))
    firsts = found.withColumn("rn", rn).filter(F.col("rn") <= most).groupBy("check").agg(F.array_join(F.array_sort(F.collect_list(name)), ",").alias("examples"))
    return found.groupBy("check").agg(F.count("*").alias("n_projects"), F.sum("n").alias("total")).join(firsts, "check")
