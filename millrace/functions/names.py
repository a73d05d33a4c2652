"""Names of exported parts, read by form into typed fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The forms of names, in the order in which they are tried, and the groups that hold their fields.
BOLT = r"^BOLT (?:(\S+) )?([\d.]+) x ([\d.]+) \(grip ([\d.]+)\)(?: \(inst \d+\))?$"
BOLT_NOMINAL = r"^BOLT ([\d.]+) x ([\d.]+) grip \(nominal heavy hex\)(?: \(inst \d+\))?$"
ENVELOPE = r"^\s*(?:(.+?) )?#(\d+) / (.+) \(member envelope\)$"
PIECE = r"^\s*(?:(.+?) )?#(\d+) / (.+) \(piece (\d+)(?:, inst (\d+))?((?:, [^,()]+)*)\)( member envelope)?$"
MEMBER = r"^(.+?) (\S+) #(\d+)(?: \(([^()]*)\))?$"


def parse_name(name: Column) -> Column:
    """A struct of stage (bolt, piece, member or unknown), member_type, member_id, piece_id, section, inst, approx and tags (the first word of each)."""
    part = lambda form, i: F.regexp_extract(name, form, i)
    number = lambda form, i: part(form, i).try_cast("long")
    none, text = F.lit(None).cast("long"), F.lit("")
    split = lambda c: F.filter(F.transform(F.split(F.replace(c, F.lit("member envelope"), F.lit("member_envelope")), ","), lambda t: F.split(F.trim(t), r"\s+")[0]), lambda t: t != "")

    def made(stage, kind, member, piece, section, inst, tags):
        return F.struct(F.lit(stage).alias("stage"), kind.alias("member_type"), member.alias("member_id"), piece.alias("piece_id"), section.alias("section"), inst.alias("inst"), F.array_contains(tags, "approx").alias("approx"), tags.alias("tags"))

    empty = F.array().cast("array<string>")
    tag = lambda t: F.array(F.lit(t))
    bolt = lambda d, tags: made("bolt", F.lit("BOLT"), none, none, F.concat(F.lit("BOLT "), d), none, tags)
    extra = F.when(part(PIECE, 7) != "", tag("member_envelope")).otherwise(empty)
    hit = lambda form: F.rlike(name, F.lit(form))
    return (
        F.when(name.isNull(), made("unknown", text, none, none, text, none, empty))
        .when(hit(BOLT), bolt(part(BOLT, 2), empty))
        .when(hit(BOLT_NOMINAL), bolt(part(BOLT_NOMINAL, 1), tag("bolt_guessed")))
        .when(hit(ENVELOPE), made("piece", part(ENVELOPE, 1), number(ENVELOPE, 2), F.lit(0).cast("long"), part(ENVELOPE, 3), none, tag("member_envelope")))
        .when(hit(PIECE), made("piece", part(PIECE, 1), number(PIECE, 2), number(PIECE, 4), part(PIECE, 3), number(PIECE, 5), F.concat(split(part(PIECE, 6)), extra)))
        .when(hit(MEMBER), made("member", part(MEMBER, 1), number(MEMBER, 3), none, part(MEMBER, 2), none, split(part(MEMBER, 4))))
        .otherwise(made("unknown", text, none, none, text, none, empty))
    )
