"""Expressions over ``;``-delimited lineages. The four shared-depth functions differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequence import trim

#: Tokens that name no lineage component.
INVALID = ("", "unknown", "unclassified", "na", "n/a", "none", "null", "nan", "missing")


def normalize(c: Column) -> Column:
    """Components trimmed, empty ones kept."""
    return F.array_join(F.transform(F.split(c, ";"), trim), ";")


def parts(c: Column) -> Column:
    """Trimmed components without empty ones; null gives an empty list."""
    return F.coalesce(F.filter(F.transform(F.split(c, ";"), trim), lambda x: x != ""), F.array().cast("array<string>"))


def domain(c: Column) -> Column:
    return F.get(parts(c), F.lit(0))


def depth(c: Column) -> Column:
    return F.size(parts(c))


def rank(c: Column, place: int) -> Column:
    """Component by position from 1, empty beyond the end."""
    return F.coalesce(F.get(F.split(c, ";"), F.lit(place - 1)), F.lit(""))


def last(c: Column) -> Column:
    return F.try_element_at(F.split(c, ";"), F.lit(-1))


def _matches(a: Column, b: Column) -> Column:
    return F.slice(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(1), F.least(F.size(a), F.size(b)))


def shared_positions(a: Column, b: Column) -> Column:
    """Equal components at equal places, mismatches in between notwithstanding."""
    return F.size(F.filter(_matches(a, b), lambda x: x))


def shared_prefix(a: Column, b: Column) -> Column:
    """Equal components before the first mismatch."""
    p = F.array_position(_matches(a, b), F.lit(False))
    return F.when(p == 0, F.least(F.size(a), F.size(b))).otherwise(p - 1).cast("int")


def loose_parts(c: Column) -> Column:
    """Several delimiters, white space collapsed, lower case."""
    return F.filter(F.split(F.lower(trim(F.regexp_replace(c, r"\s+", " "))), r"\s*[;\\>/]\s*"), lambda x: x != "")


def compact(c: Column, cap: int = 5) -> Column:
    """Invalid components dropped, neighbours that repeat merged, cut at ``cap``."""
    good = F.filter(parts(c), lambda x: ~F.lower(x).isin(*INVALID))
    kept = F.filter(F.transform(good, lambda x, i: F.struct(x.alias("x"), F.get(good, i - 1).alias("before"))), lambda s: ~s["x"].eqNullSafe(s["before"]))
    return F.slice(F.transform(kept, lambda s: s["x"]), 1, cap)


def kingdom(c: Column) -> Column:
    p = parts(c)
    return F.when((F.lower(F.get(p, F.lit(0))) == "eukaryota") & (F.size(p) > 1), F.get(p, F.lit(1))).otherwise(F.get(p, F.lit(0)))


def safe_component(c: Column) -> Column:
    return F.when(c.isNull() | F.lower(trim(c)).isin(*INVALID), F.lit("Unknown")).otherwise(c)


def token_pattern(taxa: list[str], ordered: bool = False) -> str:
    """Whole-component, case-insensitive pattern: one component, or several in order."""
    import re

    quoted = [re.escape(t).replace(r"\ ", " ") for t in taxa]
    one = [rf"(?:^|;)\s*{q}\s*(?=;|$)" for q in quoted]
    return "(?i)" + (".*".join(one) if ordered else one[0])


def boundary_match(c: Column, taxon: str) -> Column:
    import re

    return c.rlike(rf"(?i)(?<![A-Za-z0-9]){re.escape(taxon)}(?![A-Za-z0-9])")


def distance_category(shared: Column, places: int = 5) -> Column:
    return F.when(shared == 0, 0).otherwise(F.least(F.floor((shared + 1) / 2), F.lit(places))).cast("int")

LINEAGE_JSON = "taxid bigint, name string, lineage array<struct<rank:string,name:string>>"


def from_document(c: Column) -> Column:
    """A taxon document (JSON): taxid, name, and its ranked names in order, unranked ones left out."""
    d = F.from_json(c, LINEAGE_JSON)
    ranks = F.filter(d["lineage"], lambda x: x["rank"].isNotNull() & x["name"].isNotNull())
    return F.struct(d["taxid"].alias("taxid"), d["name"].alias("name"), F.coalesce(F.transform(ranks, lambda x: F.concat_ws(":", x["rank"], x["name"])), F.array().cast("array<string>")).alias("ranks"))
