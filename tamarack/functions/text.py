"""Text rules as column expressions: types, contexts, years, names. Patterns come from a pack of tamarack.rules."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import domain

YEAR = "(?:19|20)[0-9]{2}"
PLAIN = re.compile("[A-Za-z0-9 ,'/#%@-]+").fullmatch


def any_of(text: Column, patterns: Iterable[str]) -> Column:
    """Whether any of the patterns is found; those that are plain words are looked for as such, which is faster."""
    out, rest = F.lit(False), []
    for p in patterns:
        if PLAIN(p):
            out = out | F.contains(text, F.lit(p))
        else:
            rest.append(p)
    return out | text.rlike("|".join(f"(?:{p})" for p in rest)) if rest else out


def lowered(*parts: Column) -> Column:
    """The parts joined by line ends, in lower case; nulls are empty."""
    return F.lower(F.concat_ws("\n", *[F.coalesce(p, F.lit("")) for p in parts]))


def type_and_reason(title: Column, description: Column, duration: Column, url: Column, pack=domain) -> Column:
    """struct(type, reason) of a source: long form against highlight wording by duration, then the pack's order, then duration, URL and hints."""
    names = [name for name, _, _ in pack.PRIORITY]
    patterns = [*(p for _, p, _ in pack.PRIORITY), pack.HINTS]
    minutes = F.bround(F.floor(duration / 60), 0).cast("int").cast("string")

    def decided(found: Column) -> Column:
        has = {name: found[k] for k, name in enumerate(names)}
        highlights, hinted = has["general_highlights"], found[len(names)]
        tier = F.when(hinted, "pitching_highlights").otherwise("general_highlights")
        rules: list[tuple[Column, Column, Column]] = []
        earlier = F.lit(False)
        for name, seconds in pack.LONG_FORMS:
            said, long = name.replace("_", " "), F.coalesce(duration >= seconds, F.lit(False))
            # The wording of reasons.
            why = F.when(long, F.concat(F.lit(f"{said} + highlights suffix but duration consistent ("), minutes, F.lit("min)"))).otherwise(f"{said} claim contradicted by highlights wording at short/unknown duration")
            rules.append((highlights & has[name] & ~earlier, F.when(long, name).otherwise(tier), why))
            earlier = earlier | has[name]
        for name, _, why in pack.PRIORITY:
            raised = name == "general_highlights"
            rules.append((has[name], tier if raised else F.lit(name), F.when(hinted, f"{why} + pitching context -> pitching_highlights").otherwise(why) if raised else F.lit(why)))
        rules += [
            (F.coalesce(duration <= 65, F.lit(False)), F.lit("short"), F.lit("duration <= 65s")), (F.coalesce(F.contains(url, F.lit("/shorts/")), F.lit(False)), F.lit("short"), F.lit("shorts URL")),
            (hinted, F.lit("pitching_highlights"), F.lit("pitching context only")),
        ]
        none = F.struct(F.lit("unknown").alias("type"), F.lit("no type signal").alias("reason"))
        return F.coalesce(*[F.when(when, F.struct(then.alias("type"), why.alias("reason"))) for when, then, why in rules], none)

    # The text is lowered once and each wording looked for once, whatever the number of rules that ask.
    found = F.transform(F.array(lowered(title, description)), lambda t: F.array(*[any_of(t, p) for p in patterns]))[0]
    return F.transform(F.array(found), decided)[0]


def source_type(title: Column, description: Column, duration: Column, url: Column, pack=domain) -> Column:
    return type_and_reason(title, description, duration, url, pack)["type"]


def context(title: Column, description: Column, channel: Column, pack=domain) -> Column:
    """Inside or outside the league, or unknown."""
    outside, inside, unknown = pack.CONTEXTS
    text = F.regexp_replace(lowered(title, description), pack.RELIEF, " ")
    return F.when(any_of(text, pack.OUTSIDE), outside).when(any_of(lowered(title, channel), pack.INSIDE), inside).otherwise(unknown)


def head(title: Column, description: Column, pack=domain) -> Column:
    """The title and the description up to its boilerplate, 300 characters at most."""
    text = F.coalesce(description, F.lit(""))
    cuts = [F.nullif(F.locate(mark, text), F.lit(0)) - 1 for mark in pack.BOILERPLATE]
    return F.concat_ws("\n", F.coalesce(title, F.lit("")), F.left(text, F.least(F.length(text), F.lit(300), *cuts)))


def first_year(text: Column, pattern: str, group: int = 1) -> Column:
    """The year a pattern's group holds where it is first found, else null."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).cast("int")


def year_and_confidence(title: Column, description: Column, published: Column, pack=domain) -> Column:
    """struct(year, confidence): explicit dates and years are high, seasons and titles medium, the publication date low."""
    core, text = head(title, description, pack), F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit("")))
    months = "|".join(pack.MONTHS)
    named = core.rlike(rf"(?i)\b(?:{months})\b\.?\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+{YEAR}")
    found = [
        (F.when(named, first_year(core, f"({YEAR})")), "high"),
        (first_year(core, rf"\b({YEAR})[-/]\d{{1,2}}[-/]\d{{1,2}}\b"), "high"),
        (first_year(core, rf"\b\d{{1,2}}[-/]\d{{1,2}}[-/]({YEAR})\b"), "high"),
        (first_year(core, rf"(?i)\b({YEAR})\s+(?:highlights|outing|start|game)\b"), "high"),
        (first_year(F.coalesce(title, F.lit("")), rf"\b({YEAR})\b"), "medium"),
        (first_year(text, rf"(?i)\bseason\s+({YEAR})\b"), "medium"),
        (first_year(published, r"^(\d{4})-\d{2}-\d{2}"), "low"),
    ]
    none = F.struct(F.lit(None).cast("int").alias("year"), F.lit("null").alias("confidence"))
    return F.coalesce(*[F.when(y.isNotNull(), F.struct(y.alias("year"), F.lit(c).alias("confidence"))) for y, c in found], none)


def reliable_year(year: Column, confidence: Column) -> Column:
    return F.when((year != 0) & confidence.isin("high", "medium"), year)


def safe_name(name: Column, empty: str = "UnknownPitcher") -> Column:
    """A name for files: letters, digits and single underscores."""
    joined = F.regexp_replace(F.trim(F.regexp_replace(name, r"\s+", " ")), " ", "_")
    kept = F.regexp_replace(F.regexp_replace(joined, "[^A-Za-z0-9_]", ""), "_+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(kept, "^_+|_+$", ""), F.lit("")), F.lit(empty))


def file_stem(name: Column, year: Column, confidence: Column) -> Column:
    return F.concat_ws("_", safe_name(name), F.coalesce(reliable_year(year, confidence).cast("string"), F.lit("UnknownYear")))


def slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def iso_date(digits: Column) -> Column:
    """yyyyMMdd as yyyy-MM-dd, null for any other length."""
    return F.when(F.length(digits) == 8, F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2)))


def error_tail(log: Column, most: int = 300) -> Column:
    """What to keep of a tool's log: its error lines, else its last three, and no more than `most` characters."""
    lines = F.filter(F.transform(F.split(F.coalesce(log, F.lit("")), "\\R"), lambda x: F.trim(x)), lambda x: x != "")
    errors = F.filter(lines, lambda x: x.startswith("ERROR"))
    last = F.slice(lines, F.greatest(F.size(lines) - 2, F.lit(1)), F.lit(3))
    return F.right(F.array_join(F.when(F.size(errors) > 0, errors).otherwise(last), " | "), F.lit(most))
