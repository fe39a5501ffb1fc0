"""Rule-based text columns: ordered classes, fuzzy names, keyword flags, trailing codes.

Rules are data; the functions turn them into one CASE expression that runs in generated code.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TextClass:
    """A class holds if (one of ``any_of`` and one of ``also`` and none of ``none_of``) or one of ``or_any``.

    ``unless_all`` vetoes only if all its patterns match. All are regular expressions.
    """

    label: str
    any_of: Sequence[str] = ()
    also: Sequence[str] = ()
    none_of: Sequence[str] = ()
    unless_all: Sequence[str] = ()
    or_any: Sequence[str] = ()


@dataclass(frozen=True)
class FuzzyName:
    """A canonical name with its spellings.

    ``near`` holds (spelling, largest edit distance); ``not_words`` and ``not_like`` veto a near
    match, ``words`` and ``like`` accept a text outright.
    """

    name: str
    near: Sequence[tuple[str, int]] = ()
    not_words: Sequence[str] = ()
    not_like: Sequence[str] = ()
    words: Sequence[str] = ()
    like: Sequence[str] = ()


_PLAIN = re.compile(r"(\^?)(?:\(([A-Z0-9 ,-]+(?:\|[A-Z0-9 ,-]+)*)\)|([A-Z0-9 ,-]+))(\$?)")


def _matches(x: Column, pattern: str) -> Column:
    """The text matches the pattern somewhere.

    Patterns made of plain words are looked for as byte strings, which is far cheaper on long
    texts than a regular expression.
    """
    plain = _PLAIN.fullmatch(pattern)
    if not plain:
        return x.rlike(pattern)
    start, many, one, end = plain.groups()
    words = (many or one).split("|")
    test = {
        ("", ""): x.contains,
        ("^", ""): x.startswith,
        ("", "$"): x.endswith,
        ("^", "$"): lambda w: x == w,
    }[start, end]
    return reduce(lambda a, b: a | b, [test(w) for w in words])


def _any(x: Column, patterns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [_matches(x, p) for p in patterns])


def _class_test(x: Column, rule: TextClass) -> Column:
    tests = []
    if rule.any_of:
        main = _any(x, rule.any_of)
        if rule.also:
            main = main & _any(x, rule.also)
        if rule.none_of:
            main = main & ~_any(x, rule.none_of)
        if rule.unless_all:
            main = main & ~reduce(lambda a, b: a & b, [_matches(x, p) for p in rule.unless_all])
        tests.append(main)
    if rule.or_any:
        tests.append(_any(x, rule.or_any))
    return reduce(lambda a, b: a | b, tests)


def classify_text(x: Column, rules: Sequence[TextClass], default: Column | None = None) -> Column:
    """Label of the first rule that holds, else ``default`` (the text itself if not given)."""
    out = None
    for rule in rules:
        test = _class_test(x, rule)
        out = F.when(test, rule.label) if out is None else out.when(test, rule.label)
    return out.otherwise(x if default is None else default)


def fuzzy_canonicalise(x: Column, rules: Sequence[FuzzyName], null_words: Sequence[str] = ()) -> Column:
    """Canonical name of the first rule that accepts the text, else the text."""
    out = None
    for rule in rules:
        tests = []
        if rule.near:
            near = reduce(lambda a, b: a | b, [F.levenshtein(x, F.lit(w), n) >= 0 for w, n in rule.near])
            if rule.not_words:
                near = near & ~x.isin(list(rule.not_words))
            if rule.not_like:
                near = near & ~_any(x, rule.not_like)
            tests.append(near)
        if rule.words:
            tests.append(x.isin(list(rule.words)))
        if rule.like:
            tests.append(_any(x, rule.like))
        test = reduce(lambda a, b: a | b, tests)
        out = F.when(test, rule.name) if out is None else out.when(test, rule.name)
    if null_words:
        out = out.when(x.isin(list(null_words)), F.lit(None))
    return out.otherwise(x)


def keyword_flag(any_of: Mapping[str, Sequence[str]], none_of: Mapping[str, Sequence[str]] | None = None) -> Column:
    """True if a column is like one of its patterns (case-insensitive LIKE) and no veto holds.

    Where a vetoing column is NULL the veto cannot be ruled out and the flag is false.
    """
    likes = [F.col(c).ilike(p) for c, patterns in any_of.items() for p in patterns]
    flag = reduce(lambda a, b: a | b, likes)
    for c, patterns in (none_of or {}).items():
        for p in patterns:
            flag = flag & ~F.col(c).ilike(p)
    return F.coalesce(flag, F.lit(False))


TRAILING_CODE = r"\(([^\)]+)\)$"


def trailing_code(x: Column) -> Column:
    """Text inside a closing ``(code)``, NULL if there is none."""
    return F.nullif(F.regexp_extract(x, TRAILING_CODE, 1), F.lit(""))


def strip_trailing_code(x: Column) -> Column:
    return F.regexp_replace(x, TRAILING_CODE, "")
