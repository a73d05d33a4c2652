"""Findings about a converted model from a table of rules: 34 codes with level, cause and threshold. Rules are SQL conditions, so they are data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Thresholds.
NAME_MATCH_MIN, BREPCHECK_SHARE, SIZE_TOL, VOLUME_TOL = 0.90, 0.01, 0.01, 0.05
#: Issues of parts by column, with their codes, and causes in order.
PART_ISSUES = {"open_shell": "OPEN_SHELL", "broken_solid": "BROKEN_SOLID", "empty_part": "EMPTY_PART"}
PART_CAUSES = ("PIPELINE", "UNCLASSIFIED", "SOURCE")

_PLAIN = "kind NOT IN ('empty', 'compressed', 'not_step')"
_LISTED = "manifest_found"
_SOLIDS = "solid = 0 AND impossible_solid = 0 AND open_shell > 0"
_OWN = "coalesce(n_open_shell_pipeline, 0) = 0 AND coalesce(n_open_shell_unclassified, 0) = 0"
_INVALID = f"brepcheck_invalid > {BREPCHECK_SHARE} * greatest(1, brepcheck_checked)"
_OFF = " OR ".join(f"coalesce(abs(size_ratio_{i} - 1) > {SIZE_TOL}, false)" for i in (1, 2, 3))

#: Code, level, cause, condition, and the count that goes with it, by stage. The file and its manifest entry come first; without a failure there, the
#: match with a source; with a source, contents and geometry.
FILE_RULES = [
    ("F_EMPTY", "FAIL", "PIPELINE", "kind = 'empty'", None),
    ("F_COMPRESSED", "FAIL", "PACKAGING", "kind = 'compressed'", None),
    ("F_NOT_STEP", "FAIL", "PACKAGING", "kind = 'not_step'", None),
    ("F_TRUNCATED", "FAIL", "PIPELINE", f"{_PLAIN} AND NOT end_marker", None),
    ("F_NOT_GEOMETRY", "FAIL", "SOURCE", f"{_PLAIN} AND schema_class = 'cis2'", None),
    ("F_SCHEMA", "FAIL", "PIPELINE", f"{_PLAIN} AND schema_class NOT IN ('cis2', 'geometry')", None),
    ("F_NO_GEOMETRY", "FAIL", "PIPELINE", f"{_PLAIN} AND solid_entities = 0 AND surface_entities = 0", None),
    ("W_NOT_IN_MANIFEST", "WARN", "PACKAGING", f"NOT {_LISTED}", None),
    ("F_SHA_MISMATCH", "FAIL", "PACKAGING", f"{_LISTED} AND coalesce(manifest_sha, '') <> sha", None),
    ("F_SIZE_MISMATCH", "FAIL", "PACKAGING", f"{_LISTED} AND manifest_sha = sha AND manifest_bytes <> bytes", None),
    ("I_NOT_IFC_CONVERSION", "INFO", "SCOPE", "kind = 'step' AND NOT is_conversion", None),
]
SOURCE_RULES = [("W_NO_SOURCE", "WARN", "FILES", "match_precision IS NULL", None)]
MATCH_RULES = [
    ("W_WEAK_SOURCE", "WARN", "FILES", f"match_precision < {NAME_MATCH_MIN}", None),
    ("W_MISSING_PIPELINE", "WARN", "PIPELINE", "missing_pipeline > 0", "missing_pipeline"),
    ("I_MISSING_SOURCE", "INFO", "SOURCE", "missing_source > 0", "missing_source"),
    ("I_MISSING_BY_DESIGN", "INFO", "BY_DESIGN", "missing_by_design > 0", "missing_by_design"),
    ("W_EXTRA_PARTS", "WARN", "UNCLASSIFIED", "extra_parts > 0", "extra_parts"),
    ("I_GEOMETRY_SKIPPED", "INFO", "SCOPE", "geometry_skipped", None),
    ("W_GEOMETRY_ERROR", "WARN", "UNCLASSIFIED", "geometry_error", None),
    ("W_SURFACES_ONLY", "WARN", "SOURCE", f"{_SOLIDS} AND {_OWN}", "open_shell"),
    ("W_SURFACES_ONLY", "WARN", "PIPELINE", f"{_SOLIDS} AND NOT ({_OWN})", "open_shell"),
    *((f"W_{code}_{cause}", "WARN", cause, f"n_{issue}_{cause.lower()} > 0", f"n_{issue}_{cause.lower()}") for issue, code in PART_ISSUES.items() for cause in PART_CAUSES),
    ("W_BREPCHECK", "WARN", "PIPELINE", f"brepcheck_invalid > 0 AND {_INVALID}", "brepcheck_invalid"),
    ("I_BREPCHECK", "INFO", "PIPELINE", f"brepcheck_invalid > 0 AND NOT ({_INVALID})", "brepcheck_invalid"),
    ("W_SIZE", "WARN", "PIPELINE", f"elements_meshed > 0 AND ({_OFF})", None),
    ("W_VOLUME", "WARN", "UNCLASSIFIED", f"elements_meshed > 0 AND solid > 0 AND open_shell = 0 AND source_volume > 0 AND abs(volume / source_volume - 1) > {VOLUME_TOL}", None),
    ("I_SOURCE_BROKEN", "INFO", "SOURCE", "elements_meshed > 0 AND impossible_elements > 0", "impossible_elements"),
]
CODES = tuple(dict.fromkeys(r[0] for r in FILE_RULES + SOURCE_RULES + MATCH_RULES))


def stages() -> list[tuple[str, list]]:
    """Each stage's condition and rules."""
    failed = " OR ".join(f"coalesce({r[3]}, false)" for r in FILE_RULES if r[1] == "FAIL")
    on = f"NOT ({failed}) AND coalesce(kind <> 'step' OR is_conversion, false)"
    return [("true", FILE_RULES), (on, SOURCE_RULES), (f"({on}) AND match_precision IS NOT NULL", MATCH_RULES)]


def model_findings(models: DataFrame, keys: list[str], order: tuple[str, ...] = ("FAIL", "WARN", "INFO")) -> DataFrame:
    """(keys, code, level, cause, n, pos) of each rule that holds for a model: failures first. A condition over a null doesn't hold. One scan."""
    hits, at = [], 0
    for on, rules in stages():
        for code, level, cause, cond, n in rules:
            entry = F.struct(F.lit(order.index(level)).alias("rank"), F.lit(at).alias("at"), F.lit(code).alias("code"), F.lit(level).alias("level"), F.lit(cause).alias("cause"), (F.expr(n).cast("long") if n else F.lit(None).cast("long")).alias("n"))
            hits.append(F.when(F.expr(f"coalesce(({on}) AND ({cond}), false)"), entry))
            at += 1
    found = F.array_sort(F.filter(F.array(*hits), lambda x: x.isNotNull()))
    return models.select(*keys, F.posexplode(found).alias("pos", "f")).select(*keys, "f.code", "f.level", "f.cause", "f.n", (F.col("pos") + 1).alias("pos"))
