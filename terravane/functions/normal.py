"""Identities, road references, postal designations and statuses out of free text, as expressions.

A null text gives what an empty one gives, unless a docstring says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .texts import MARKED, PLAIN, once

_UPPER, _UPPER_PLAIN = MARKED.upper(), PLAIN.upper()

# What stands for an identity that is hidden or absent.
MASKED = ["n/a", "n a", "na", "unknown", "blank", "private", "blocked", "suppressed", "no registration", "noregistration", "no callsign", "nocallsign", ""]

# Bands of road numbers, both ends included, and words for the class of a road.
ROAD_BANDS = [(1, 99, "primary_band"), (100, 299, "secondary_band"), (300, 9999, "tertiary_band")]
ROAD_CLASSES = [("primary", "PRIMARIA|PRIMARY|PRINCIPAL"), ("secondary", "SECUNDARIA|SECONDARY"), ("tertiary", "TERCIARIA|TERTIARY|LOCAL|RURAL")]
KILOMETRE = r"(?i)\b(?:KM|K\.M\.?|KILOMETRO)\s*\.?\s*(\d{1,3}(?:[.,]\d{1,2})?)(?:\s*(?:HM|HEC?TOMETRO)\s*\.?\s*(\d))?"

# Words for a case that is closed, and what undoes them before a match.
DEAD = r"\b(?:fallecid[oa]s?|muert[oa]s?|cadaver(?:es)?|sin\s+vida|deceso|occis[oa]|restos\s+(?:humanos|mortales))\b"
FOUND = r"\b(?:resuelt[oa]s?|encontrad[oa]s?|localizad[oa]s?|hallad[oa]s?|aparecid[oa]s?|sana?\s+y\s+salv[oa]|con\s+vida|en\s+buenas?\s+condiciones)\b"
DENIED = r"\b(?:no|sin|nunca|jamas|tampoco|ni)\b"


def plain_letters(text: Column) -> Column:
    """Letters with marks as letters without, case kept."""
    return F.translate(F.coalesce(text, F.lit("")), MARKED + _UPPER, PLAIN + _UPPER_PLAIN)


def masked_key(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(F.lower(F.trim(F.coalesce(text, F.lit("")))), F.lit("ñ"), F.lit("n")), "[^a-z0-9]+", " "))


def is_masked(text: Column) -> Column:
    """Whether an identity is hidden, absent or said to be unknown."""
    key = masked_key(text)
    return key.isin(*MASKED) | F.replace(key, F.lit(" "), F.lit("")).isin(*MASKED)


def identity(tail: Column) -> Column:
    """status and canonical form of the mark on a tail."""
    raw = F.trim(F.coalesce(tail, F.lit("")))
    compact = F.replace(masked_key(tail), F.lit(" "), F.lit(""))
    mark = compact.rlike("^n[0-9a-z]+$")
    status = F.when(is_masked(tail), "masked_or_unresolved").when(mark, "tail_candidate").otherwise("unresolved_text")
    canonical = F.when(is_masked(tail), F.lit(None)).when(mark, F.replace(F.upper(raw), F.lit(" "), F.lit(""))).otherwise(raw)
    return F.struct(status.alias("status"), canonical.alias("canonical"))


def registration(text: Column) -> Column:
    """Upper case, ASCII only, without blanks, tabs, hyphens, points and slashes; for comparison by equality."""
    ascii_only = F.regexp_replace(F.upper(plain_letters(text)), r"[^\x00-\x7F]", "")
    return F.regexp_replace(F.regexp_replace(ascii_only, r"^\s+|\s+$", ""), r"[ \t\-./]", "")


def namespaced(raw: Column, prefix: str) -> Column:
    """prefix:raw, once; null for a null or blank id, which has no name to give."""
    s = F.trim(raw)
    return F.when(s.startswith(f"{prefix}:"), s).when(s != "", F.concat(F.lit(f"{prefix}:"), s))


def has_namespace(value: Column, prefix: str) -> Column:
    return F.coalesce(value.startswith(f"{prefix}:") & (F.char_length(value) > len(prefix) + 1), F.lit(False))


def road_band(number: Column) -> Column:
    """The band a road's number lies in, or unknown."""
    n = F.nullif(F.regexp_extract(F.trim(F.coalesce(number.cast("string"), F.lit(""))), r"^\d{1,9}$", 0), F.lit("")).cast("int")

    def read(n: Column) -> Column:
        out = F.lit("unknown")
        for low, high, name in reversed(ROAD_BANDS):
            out = F.when(n.between(low, high), name).otherwise(out)
        return out

    return once(n, read)


def road_parts(number: Column) -> Column:
    """base, suffix and is_ramal of a road number such as 3R; empty if it is none."""
    p = r"^(\d{1,5})([A-Z]?)$"
    s = F.upper(F.trim(F.coalesce(number, F.lit(""))))
    base, suffix = F.regexp_extract(s, p, 1), F.regexp_extract(s, p, 2)
    stripped = F.when(base != "", F.coalesce(F.nullif(F.regexp_replace(base, "^0+", ""), F.lit("")), F.lit("0"))).otherwise("")
    return F.struct(stripped.alias("base"), suffix.alias("suffix"), (suffix == "R").alias("is_ramal"))


def kilometre(text: Column) -> Column:
    """The kilometre, hectometres included, that a text names first, to three digits; null if none."""

    def read(t: Column) -> Column:
        km, hm = F.regexp_extract(t, KILOMETRE, 1), F.regexp_extract(t, KILOMETRE, 2)
        return F.when(km != "", F.round(F.replace(km, F.lit(","), F.lit(".")).cast("double") + F.coalesce(F.nullif(hm, F.lit("")).cast("double"), F.lit(0.0)) / 10.0, 3))

    return once(plain_letters(text), read)


def road_class(text: Column) -> Column:
    """primary, secondary or tertiary if a text says so, else empty."""

    def read(t: Column) -> Column:
        out = F.lit("")
        for name, words in reversed(ROAD_CLASSES):
            out = F.when(t.rlike(words), name).otherwise(out)
        return out

    return once(F.upper(plain_letters(text)), read)


def road_id(family: Column, record: Column, number: Column, name: Column) -> Column:
    """A stable id of a road out of where it comes from and what it is called."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    family = blank(family)
    short = F.lower(family)
    for old, new in (("_roads", ""), ("_route_data", ""), ("_", "-")):
        short = F.replace(short, F.lit(old), F.lit(new))
    return F.concat(F.lit("road:"), short, F.lit(":"), F.substring(F.sha1(F.concat_ws("|", family, blank(record), blank(number), blank(name))), 1, 16))


def designation(raw: Column) -> Column:
    """kind, route, box, normalized and class of a postal designation; only HC and RR with a number are candidates."""
    s = F.upper(F.regexp_replace(F.regexp_replace(F.coalesce(raw, F.lit("")), r"^\s+|\s+$", ""), r"\s+", " "))

    def read(t: Column) -> Column:
        plain, label = r"^(HC|RR) ([0-9]+[A-Z]?)(?: BOX ([0-9]+[A-Z]?))?$", r"^RURAL ROUTE HC ([0-9]+[A-Z]?)(?: ([0-9]+[A-Z]?))?$"
        a = [F.nullif(F.regexp_extract(t, plain, i), F.lit("")) for i in (1, 2, 3)]
        b = [F.nullif(F.regexp_extract(t, label, i), F.lit("")) for i in (1, 2)]
        kind = F.coalesce(a[0], F.when(b[0].isNotNull(), "HC"))
        route, box = F.coalesce(a[1], b[0]), F.coalesce(a[2], b[1])
        state = F.when(a[0].isNotNull(), "candidate").when(b[0].isNotNull(), "ambiguous").otherwise("unrecognized")
        text = F.concat(kind, F.lit(" "), route, F.coalesce(F.concat(F.lit(" BOX "), box), F.lit("")))
        return F.struct(kind.alias("kind"), route.alias("route"), box.alias("box"), text.alias("normalized"), state.alias("state"))

    return once(s, read)


def binding_eligible(state: Column, system: Column, route_id: Column, source_id: Column) -> Column:
    """Whether a designation may go to review as a binding: a candidate with a route and a source that are named."""
    named = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    return F.coalesce((state == "candidate") & (system == "USPS"), F.lit(False)) & named(route_id) & named(source_id)


def case_status(text: Column) -> Column:
    """resolved_deceased, resolved_alive or active, from Spanish words that are not denied within 24 characters before."""

    def said(t: Column, words: str) -> Column:
        # What stands before each match: the text cut at the matches, each piece followed by one.
        before = F.split(t, words)
        head = F.slice(before, F.lit(1), F.size(before) - 1)
        at = F.regexp_extract_all(t, F.lit(f"({words})"), F.lit(1))
        spread = F.zip_with(head, at, lambda h, m: F.struct(h.alias("h"), m.alias("m")))
        first = F.struct(F.lit("").alias("s"), F.lit(False).alias("ok"))
        step = lambda acc, x: F.struct(F.right(F.concat(acc["s"], x["h"], x["m"]), F.lit(120)).alias("s"), (acc["ok"] | ~F.right(F.concat(acc["s"], x["h"]), F.lit(24)).rlike(DENIED)).alias("ok"))
        return F.aggregate(spread, first, step)["ok"]

    return once(F.lower(plain_letters(text)), lambda t: F.when(said(t, DEAD), "resolved_deceased").when(said(t, FOUND), "resolved_alive").otherwise("active"))


#: A cue of time gone by with up to three words after it, at the end of what stands before a number (fixed values).
GONE_BY = r"\b(hace|lleva|desde|por)\b(?:\s+\w+){0,3}\s*$"


def age(text: Column) -> Column:
    """The age a Spanish text names, as text: after `edad`, else the first years that are not time gone by; else empty.

    Years are time gone by if a cue stands within the 30 characters before the number, three words away at most.
    """

    def read(t: Column) -> Column:
        said = F.regexp_extract(t, r"edad\s*:?\s*(\d{1,3})", 1)
        years = r"\d{1,3}\s*anos"
        before = F.split(t, years)
        head = F.slice(before, F.lit(1), F.size(before) - 1)
        spread = F.zip_with(head, F.regexp_extract_all(t, F.lit(f"({years})"), F.lit(1)), lambda h, m: F.struct(h.alias("h"), m.alias("m")))
        first = F.struct(F.lit("").alias("s"), F.lit("").alias("age"))

        def step(acc: Column, x: Column) -> Column:
            gone = F.right(F.concat(acc["s"], x["h"]), F.lit(30)).rlike(GONE_BY)
            found = F.when((acc["age"] == "") & ~gone, F.regexp_extract(x["m"], r"\d{1,3}", 0)).otherwise(acc["age"])
            return F.struct(F.right(F.concat(acc["s"], x["h"], x["m"]), F.lit(60)).alias("s"), found.alias("age"))

        return F.when(said != "", said).otherwise(F.aggregate(spread, first, step)["age"])

    return once(F.lower(plain_letters(text)), read)


def clean_query(text: Column, most: int = 1000) -> Column:
    """Without control characters but tabs and line ends, without white space around, at most so many characters."""
    return F.substring(F.regexp_replace(F.regexp_replace(text, r"[\x00-\x08\x0B-\x1F]", ""), r"^\s+|\s+$", ""), 1, most)


def cut_context(text: Column, most: int = 4000) -> Column:
    """A text of at most so many characters, with a mark where it was cut."""
    return F.when(F.char_length(text) > most, F.concat(F.substring(text, 1, most), F.lit("\n... [context truncated]"))).otherwise(text)
