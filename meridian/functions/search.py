"""Filter conditions built from what a caller asks: search text, tag rules, targeting, optional bounds."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_TERM = re.compile(r'(-?)"([^"]*)"|(-?)([^\s,"]+)|(,)')


def every(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def matches_search(fields: Sequence[Column], asked: str) -> Column:
    """Whether a row's fields meet a search text.

    ``"quoted"`` must appear in one of the fields, ``-"x"`` and ``-x`` in none. Plain terms must all appear; a comma
    anywhere between terms makes one of them enough. Comparison ignores case; null fields hold nothing; an empty text asks nothing.
    """
    found = lambda term: reduce(or_, [F.coalesce(F.contains(F.lower(f), F.lit(term.lower())), F.lit(False)) for f in fields])
    must, plain, any_of = [], [], False
    for m in _TERM.finditer(asked):
        minus, quoted, minus_plain, word, comma = m.groups()
        term = quoted if quoted is not None else word
        if comma:
            any_of = True
        elif term and (minus or minus_plain):
            must.append(~found(term))
        elif term:
            (must if quoted is not None else plain).append(found(term))
    return every(must) & (reduce(or_ if any_of else and_, plain) if plain else F.lit(True))


def prefix_or_contains(text: Column, asked: str | None) -> Column:
    """Case-insensitive prefix, or anywhere where ``asked`` starts with ``*``; nothing asked passes all rows."""
    asked = (asked or "").strip().lower()
    if not asked.strip("*"):
        return F.lit(True)
    return F.contains(F.lower(text), F.lit(asked[1:])) if asked.startswith("*") else F.startswith(F.lower(text), F.lit(asked))


def like_literal(text: Column, asked: str, mode: str = "contains") -> Column:
    """Case-insensitive prefix, suffix or contains; ``%`` and ``_`` of ``asked`` stand for themselves."""
    safe = re.sub(r"([!%_])", r"!\1", asked)
    pattern = {"prefix": f"{safe}%", "suffix": f"%{safe}", "contains": f"%{safe}%"}[mode]
    return F.ilike(text, F.lit(pattern), F.lit("!"))


def in_range(value: Column, least: float | None, most: float | None) -> Column:
    """Closed range; either bound may be absent."""
    bounds = ([value >= least] if least is not None else []) + ([value <= most] if most is not None else [])
    return every(bounds)


def when_given(value: Column, asked: object | None) -> Column:
    """Equality, or no condition where nothing is asked."""
    return F.lit(True) if asked is None else value == F.lit(asked)


def in_quad(shortlink: Column, quad: str) -> Column:
    """Whether a place code starts with ``quad``, where ``*`` stands for any one character."""
    return shortlink.rlike("^" + "".join("." if c == "*" else re.escape(c) for c in quad)) if "*" in quad else F.startswith(shortlink, F.lit(quad))


def tags_match(tags: Column, rules: Sequence[Mapping[str, str | Sequence[str]]]) -> Column:
    """One of the rules holds: each of its tags has the given value, or one of those given. No rules match nothing."""
    one = lambda tag, v: F.coalesce(tags[tag].isin([v] if isinstance(v, str) else list(v)), F.lit(False))
    return reduce(or_, [every([one(t, v) for t, v in rule.items()]) for rule in rules], F.lit(False))


def version_key(version: Column) -> Column:
    """A dotted version as numbers, which compare position by position; parts that aren't numbers count as 0."""
    return F.transform(F.split(version, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(0)))


def targeted(row: Mapping[str, Column], rule: Mapping[str, object]) -> Column:
    """Targeting conditions; what a rule leaves out isn't asked.

    ``since`` and ``until`` on ``date``, ``countries`` on ``country``, ``least_<c>`` and ``most_<c>`` on a count,
    ``least_version`` on ``version``, and ``features``: names that must be among ``features``, or must not, with ``-``.
    """
    out = []
    for key, value in rule.items():
        if key == "since":
            out.append(row["date"] >= F.lit(value))
        elif key == "until":
            out.append(row["date"] < F.lit(value))
        elif key == "countries":
            out.append(row["country"].isin(list(value)))
        elif key == "least_version":
            out.append(version_key(row["version"]) >= version_key(F.lit(value)))
        elif key == "features":
            for name in value:
                held = F.array_contains(row["features"], name.lstrip("-"))
                out.append(~held if name.startswith("-") else held)
        else:
            bound, name = key.split("_", 1)
            out.append(row[name] >= F.lit(value) if bound == "least" else row[name] <= F.lit(value))
    return every(out)
