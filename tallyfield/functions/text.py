"""Text keys as columns: names, numbers, money, paths, classifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = r"[ \t\n\r\f\x0B]"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(c, WHITE + "+", " "), "^ | $", "")


def clean_task_name(c: Column) -> Column:
    """Leading numbering such as ``1. `` or ``10B. `` removed, ASCII white space trimmed; a trailing number stays."""
    bare = F.regexp_replace(c, rf"^([0-9]+[A-Za-z]?\.{WHITE}*)+", "")
    return F.regexp_replace(bare, rf"^{WHITE}+|{WHITE}+$", "")


def project_number(c: Column) -> Column:
    return blank_to_null(F.regexp_extract(c, r"TS(\d+)", 1)).try_cast("int")


def longest_number(c: Column, least: int = 6, most: int = 9) -> Column:
    """The longest run of ``least`` to ``most`` digits, ties to the smallest; null without one."""
    runs = F.regexp_extract_all(c, F.lit(rf"(?<![0-9])([0-9]{{{least},{most}}})(?![0-9])"), F.lit(1))
    ranked = F.array_sort(F.transform(runs, lambda s: F.struct((-F.length(s)).alias("n"), s.alias("s"))))
    return F.try_element_at(ranked, F.lit(1))["s"]


def name_norm(c: Column) -> Column:
    return blank_to_null(F.upper(collapse(c)))


def quote_norm(c: Column) -> Column:
    return blank_to_null(F.upper(collapse(F.regexp_replace(c, "[/_-]", " "))))


def email_canon(c: Column) -> Column:
    """Addresses split at commas and semicolons, lower-cased, without repeats, in order."""
    found = F.filter(F.transform(F.split(c, "[,;]"), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    return blank_to_null(F.array_join(F.array_sort(F.array_distinct(found)), ","))


def money(c: Column) -> Column:
    return blank_to_null(F.regexp_replace(c, "[^0-9.]", "")).try_cast("decimal(18,2)")


def signature(path: Column, anchor: str, follow: int = 2) -> Column:
    """First segment of a path that matches ``anchor`` and the ``follow`` segments after it; null without one."""
    parts = F.split(path, "/")
    at = F.array_position(F.transform(parts, lambda s: s.rlike(anchor)), True).cast("int")
    return F.when(at > 0, F.array_join(F.slice(parts, F.greatest(at, F.lit(1)), follow + 1), "/"))


def first_rule(c: Column, rules: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    """Ordered case-insensitive regular expressions; the first match decides."""
    out = F.lit(otherwise)
    for pattern, value in reversed(rules):
        out = F.when(c.rlike(f"(?i){pattern}"), F.lit(value)).otherwise(out)
    return out


def stable_id(*columns: Column) -> Column:
    """60 bits of the md5 of the joined columns, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *columns)), 1, 15), 16, 10).cast("long")


def display_name(name: Column, emp_id: Column) -> Column:
    """The name without ``_id`` at its end."""
    tail = F.concat(F.lit("_"), emp_id)
    return F.when(F.endswith(name, tail), F.substr(name, F.lit(1), F.length(name) - F.length(tail))).otherwise(name)


def path_parts(df, path: str, markets: list[str]):
    """Host, market (first segment that is one of ``markets``) and number (first segment that begins with digits) of a path."""
    parts = F.split(path, "/")
    number = F.nullif(F.regexp_extract(path, "/([0-9]+)", 1), F.lit("")).try_cast("int")
    return df.withColumns({
        "host": F.get(parts, F.lit(0)), "market": F.get(F.filter(parts, lambda x: x.isin(markets)), F.lit(0)), "number": number,
    })


def leave_label(code: Column, labels: dict[str, str]) -> Column:
    """Label of a leave code, whatever its case; parts of a code with a slash are joined by `` + ``; unknown codes stand for themselves."""
    known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    key = F.upper(F.regexp_replace(F.trim(code), " ", ""))
    one = lambda p: F.coalesce(F.try_element_at(known, p), p)
    parts = F.filter(F.split(key, "/"), lambda p: p != "")
    label = F.when(F.contains(key, F.lit("/")),
        F.array_join(F.transform(parts, one), " + ")).otherwise(F.coalesce(F.try_element_at(known, key), F.trim(code)))
    return F.when(F.trim(code) != "", label)


# Words that tell the kind of a calendar entry, and leaves that sound like birthdays.
HOLIDAY_WORDS, HOLIDAY_COUNTRIES = ("holiday",), ("PH", "US")
BIRTHDAY_WORDS, BIRTHDAY_LEAVES = ("birthday", "bday", "b-day", "anniversary"), ("birthday leave", "bday leave")
TRAINING_WORDS = ("refresher", "training", "walkthrough", "course", "webinar")


def calendar_summary(summary: Column, codes: list[str], teams: list[str]) -> Column:
    """A calendar entry's text as (kind, code, team, person, note, needs_review).

    Holidays, birthdays (a birthday leave is none) and trainings are told by their words.  Else ``code - team - person (note)``:
    a leave if its code is known or names several; one that is not of three parts, or whose code or team is unknown, needs review.
    """
    s, low = F.trim(summary), F.lower(F.trim(summary))
    has = lambda words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w))
    parts = F.split(F.regexp_replace(s, r"\s*[-–—]\s+|\s+[-–—]\s*", " - "), " - ")
    full = F.size(parts) >= 3
    code, team = F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))
    raw = F.array_join(F.slice(parts, 3, 100), " - ")
    known = F.regexp_replace(F.upper(code), "/", "").isin(codes) | F.contains(code, F.lit("/"))
    told = (
        F.when(has(HOLIDAY_WORDS) | s.rlike(f"^({'|'.join(HOLIDAY_COUNTRIES)}):"), "holiday")
        .when(has(BIRTHDAY_WORDS) & ~has(BIRTHDAY_LEAVES), "birthday").when(has(TRAINING_WORDS), "training")
    )
    kind = F.coalesce(told, F.when(full & known, "leave").otherwise("other"))
    leave = told.isNull() & full
    only = lambda c: F.when(leave, c)
    review = F.coalesce(told.isNull() & (s != "") & ~(full & known & F.upper(team).isin(teams)), F.lit(False))
    return F.struct(
        kind.alias("kind"), only(code).alias("code"), only(team).alias("team"),
            only(F.trim(F.regexp_replace(raw, r"\(.*\)\s*$", ""))).alias("person"),
        only(F.nullif(F.regexp_extract(raw, r"\((.*)\)\s*$", 1), F.lit(""))).alias("note"), review.alias("needs_review"),
    )


def path_fields(path: Column, carriers: str, end: str) -> Column:
    """Fields of a folder path around its carrier segment: (subcon, gc, carrier, market, project, needs_review).

    The carrier is the first segment that matches ``carriers``; the one before it is the contractor, the one before that its
    sub-contractor, the ones after it market and project.  Without a carrier, what follows a segment ``end`` is the market.
    """
    parts = F.filter(F.transform(F.split(path, "/"), lambda p: F.trim(p)), lambda p: p != "")
    place = lambda p: F.array_position(F.transform(parts, lambda s: s.rlike(f"(?i){p}")), True).cast("int")
    at, other = place(carriers), place(end)
    get = lambda i: F.when(i > 0, F.get(parts, i - 1))
    market = F.when(at > 0, get(at + 1)).when(other > 0, get(other + 1))
    return F.struct(
        F.when(at > 0, get(at - 2)).alias("subcon"), F.when(at > 0, get(at - 1)).alias("gc"), F.when(at > 0, get(at)).alias("carrier"),
        market.alias("market"), F.when(at > 0, get(at + 2)).alias("project"), market.isNull().alias("needs_review"),
    )
