"""Grades, verdicts and decisions. Rules are data; one pass over the rows applies them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tolerance, thin parts, and the band of curved parts.
TOLERANCE, LEAST_MEASURE, LEAST_EDGE, CURVED_BAND = 0.05, 1000.0, 1.0, (0.90, 1.05)
#: Coverage below which a model is in the worst class.
WORST_BELOW = 0.5
#: Stand-ins that are faithful copies of the source's own geometry.
FAITHFUL = ("v6_L4-surface", "v6_open-surface", "v6_L3-partial-surface", "reference_open_surface", "brep_open_surface")
LEVELS = ("FAIL", "WARN", "INFO")
SEVERITIES = ("ok", "info", "degraded", "blocking", "excluded")


def band(measure: Column, expected: Column, curved: Column, edge: Column | None = None) -> Column:
    """unchecked, sliver, within, outside, curved (outside, but as tessellation makes it) or curved_gross."""
    ratio = measure / expected
    thin = expected < LEAST_MEASURE if edge is None else (expected < LEAST_MEASURE) | (edge < LEAST_EDGE)
    bad = measure.isNull() | expected.isNull() | (measure == 0) | (expected <= 0)
    return (
        F.when(bad, "unchecked")
        .when(F.coalesce(thin, F.lit(False)), "sliver")
        .when(F.abs(ratio - 1) <= TOLERANCE, "within")
        .when(~curved, "outside")
        .when(ratio.between(*CURVED_BAND), "curved")
        .otherwise("curved_gross")
    )


def model_class(reasons: Column, coverage: Column, all_coverage: Column, standins: Column, needs: Column, issues: Column) -> Column:
    """3: a hard reason, or coverage (without one: of all parts) below half. 2: anything short of complete. 1: the rest.

    reasons, standins (those not tolerated), needs and issues are counts.
    """
    main = F.coalesce(coverage, all_coverage)
    worst = (reasons > 0) | F.coalesce(main < WORST_BELOW, F.lit(False))
    short = F.coalesce(coverage < 1.0, F.lit(False)) | F.coalesce(all_coverage < 1.0, F.lit(False)) | (standins > 0) | (needs > 0) | (issues > 0)
    return F.when(worst, 3).when(short, 2).otherwise(1)


def corpus(klass: Column, in_scope: Column, connected: Column) -> Column:
    return F.when((klass == 3) | ~in_scope, None).when(~connected, "C").when(klass == 1, "A").otherwise("B")


def partial_kind(shortfalls: Column, standins: Column) -> Column:
    """complete_to_source where each shortfall is the source's own and each stand-in is faithful; else approximated."""
    own = F.forall(shortfalls, lambda s: s == "source_data_absent") & F.forall(standins, lambda s: s.isin(*FAITHFUL))
    return F.when(own, "complete_to_source").otherwise("approximated")


def findings(df: DataFrame, keys: list[str], rules: list[tuple[str, str, str, Column]]) -> DataFrame:
    """(keys, code, level, cause) of each rule that holds, from one scan: an array of rules, filtered and exploded."""
    hits = F.array(*(F.when(cond, F.struct(F.lit(code).alias("code"), F.lit(level).alias("level"), F.lit(cause).alias("cause"))) for code, level, cause, cond in rules))
    return df.select(*keys, F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("f")).select(*keys, "f.code", "f.level", "f.cause")


def verdict(found: DataFrame, keys: list[str], everyone: DataFrame) -> DataFrame:
    """FAIL if any finding fails, else WARN if any warns, else PASS; pipeline_issue if one of those is the pipeline's."""
    bad = F.col("level").isin("FAIL", "WARN")
    agg = found.groupBy(*keys).agg(
        F.bool_or(F.col("level") == "FAIL").alias("_f"),
        F.bool_or(F.col("level") == "WARN").alias("_w"),
        F.bool_or(bad & F.col("cause").isin("PIPELINE", "PACKAGING")).alias("pipeline_issue"),
        F.count("*").alias("n_findings"),
    )
    out = everyone.select(*keys).join(agg, keys, "left")
    no = F.lit(False)
    return out.select(
        *keys,
        F.when(F.coalesce("_f", no), "FAIL").when(F.coalesce("_w", no), "WARN").otherwise("PASS").alias("verdict"),
        F.coalesce("pipeline_issue", no).alias("pipeline_issue"),
        F.coalesce("n_findings", F.lit(0)).alias("n_findings"),
    )


def level_rank(level: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, LEVELS)), level)


def verify_merge(klass: Column, checked: Column, own_causes: Column) -> Column:
    """The class after verification: 1 only if the verdict is PASS, or WARN with all causes the source's or by design."""
    return F.when(klass != 1, klass).when(checked.isNull(), 2).when((checked == "PASS") | ((checked == "WARN") & own_causes), 1).otherwise(2)


def merge_note(klass: Column, merged: Column, checked: Column) -> Column:
    return F.when((klass == 1) & checked.isNull(), "class1_pending_verification").when((klass == 1) & (merged == 2), "verifier_disagrees")


def ship_decision(failed: Column, hard: tuple[str, ...], known: tuple[str, ...]) -> Column:
    """hold if a hard check failed; ship_fixable if all failed checks are known; ship if none failed; else review."""
    lits = lambda v: F.array(*map(F.lit, v))
    return (
        F.when(F.size(failed) == 0, "ship")
        .when(F.size(F.array_intersect(failed, lits(hard))) > 0, "hold")
        .when(F.forall(failed, lambda c: c.isin(*known)), "ship_fixable")
        .otherwise("review")
    )


def worst_severity(severity: Column) -> Column:
    """An aggregate: the worst of ok < info < degraded < blocking < excluded."""
    rank = F.array_position(F.array(*map(F.lit, SEVERITIES)), severity)
    return F.element_at(F.array(*map(F.lit, SEVERITIES)), F.max(rank).cast("int"))


def evidence_patch(base: DataFrame, new: DataFrame, events: DataFrame, key: str, value: str) -> DataFrame:
    """keep, replace, keep_warn, add or keep_missing for each key of both versions; a change needs a logged event."""
    a, b = base.select(key, F.col(value).alias("_b"), F.lit(True).alias("_ib")), new.select(key, F.col(value).alias("_n"), F.lit(True).alias("_in"))
    both = a.join(b, key, "full").join(events.select(key).distinct().withColumn("_ev", F.lit(True)), key, "left")
    action = (
        F.when(F.col("_ib").isNull(), "add")
        .when(F.col("_in").isNull(), "keep_missing")
        .when(F.col("_b").eqNullSafe(F.col("_n")), "keep")
        .when(F.coalesce("_ev", F.lit(False)), "replace")
        .otherwise("keep_warn")
    )
    return both.select(key, action.alias("action"), F.when(action.isin("add", "replace"), F.col("_n")).otherwise(F.col("_b")).alias(value))


def finding_policy(found: DataFrame, softened: dict[str, str], evidence: dict[str, str]) -> DataFrame:
    """Levels softened by code, causes that default to PIPELINE, and each finding's strength of evidence."""
    pick = lambda m, c: F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in m.items() for x in kv)), c), F.lit(None))
    return found.withColumns(
        {
            "level": F.coalesce(pick(softened, F.col("code")), F.col("level")),
            "cause": F.coalesce("cause", F.lit("PIPELINE")),
            "evidence": F.coalesce(pick(evidence, F.col("code")), F.lit("integrity")),
        }
    )


def fix_plan(issues: DataFrame, rules: list[tuple[str, str, str, str]], families: list[tuple[str, str, str, str]], group: str, default: tuple[str, str, str]) -> DataFrame:
    """(needed, category, grp, n_models, n): what has to be done, from issues (model, type, n), the most parts first in `pos`.

    rules: type, needed, category, and what the group is called after the issues' `group` column; families: the same by how a type begins; default: for all others. The first that fits counts.
    """
    def pick(i):
        out = None
        for cond, rule in [*((F.col("type") == r[0], r[1:]) for r in rules), *((F.startswith("type", F.lit(r[0])), r[1:]) for r in families)]:
            out = F.when(cond, rule[i]) if out is None else out.when(cond, rule[i])
        return F.lit(default[i]) if out is None else out.otherwise(default[i])

    told = issues.select("model", "n", pick(0).alias("needed"), pick(1).alias("category"), F.concat_ws(" ", F.col(group), pick(2)).alias("grp"))
    return told.groupBy("needed", "category", "grp").agg(F.countDistinct("model").alias("n_models"), F.sum("n").alias("n"))


def class1_gate(found: DataFrame, verdicts: DataFrame, keys: list[str], tier: str = "tier") -> DataFrame:
    """Adds class1_ok: verdict PASS or WARN, the highest tier (A), no failing finding, and no warning but the source's own or by design."""
    bad = (F.col("level") == "FAIL") | ((F.col("level") == "WARN") & ~F.coalesce(F.lower("cause").isin("source", "by_design"), F.lit(False)))
    agg = found.groupBy(*keys).agg(F.count(F.when(bad, 1)).alias("_bad"))
    ok = F.coalesce(F.col("verdict").isin("PASS", "WARN") & (F.col(tier) == "A"), F.lit(False)) & (F.coalesce("_bad", F.lit(0)) == 0)
    return verdicts.join(agg, keys, "left").withColumn("class1_ok", ok).drop("_bad")
