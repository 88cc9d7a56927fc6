"""Safety gate and translation of specification patterns.

Patterns are written for JavaScript.  ``gate`` runs once over a specification
table: it rejects patterns that could backtrack without bound, rewrites the few
constructs Java reads differently, and asks the JVM whether the result compiles.
"""

from __future__ import annotations

import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.deep import column_argument
from plumbline.functions.values import each, literal

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# fixed value: most repetitions a pattern may hold
REPETITION_LIMIT = 25
# fixed value: white space JavaScript's \s matches beyond the ASCII set
WIDE_SPACE = r"\u000b\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"

_TOKEN = re.compile(r"\\.|\[\^?\]|\[\^?(?:\\.|[^\]\\])*\]|[*+?]|\{\d+(?:,\d*)?\}|\(\?(?:[:=!]|<[=!]|<\w+>)|.", re.S)
_QUANTIFIER = re.compile(r"[*+?]|\{\d+(?:,\d*)?\}")


def is_safe(pattern: str) -> bool:
    """No repetition inside a repetition, and not more than the limit in all."""
    count = 0
    inner = [False]  # per open group: does it hold a repetition
    closed = False  # did the last atom hold one
    after_quantifier = False
    for token in _TOKEN.findall(pattern):
        if _QUANTIFIER.fullmatch(token) and not after_quantifier:
            if closed:
                return False
            count += 1
            inner[-1] = True
            after_quantifier = True
            continue
        if token in "?+" and after_quantifier:  # lazy or possessive mark
            after_quantifier = False
            closed = False
            continue
        after_quantifier = False
        closed = False
        if token.startswith("("):
            inner.append(False)
        elif token == ")":
            if len(inner) == 1:
                return False
            closed = inner.pop()
            inner[-1] = inner[-1] or closed
    return len(inner) == 1 and count <= REPETITION_LIMIT


def _class(token: str) -> str:
    """A character class; its members are single characters and escapes."""
    own = {r"\s": rf"\s{WIDE_SPACE}", r"\S": rf"[^\s{WIDE_SPACE}]", r"\0": r"\x00", "[": r"\["}
    negated = token.startswith("[^")
    members = re.findall(r"\\.|.", token[2 if negated else 1 : -1], re.S)
    body = "".join(own.get(m, m) for m in members).replace("&&", r"&\&")
    return ("[^" if negated else "[") + body + "]"


def to_java(pattern: str) -> str:
    """The same pattern for java.util.regex."""

    def one(token: str) -> str:
        if token == "$":
            return r"\z"
        if token == ".":
            return r"[^\n\r\u2028\u2029]"
        if token == r"\s":
            return rf"[\s{WIDE_SPACE}]"
        if token == r"\S":
            return rf"[^\s{WIDE_SPACE}]"
        if token == r"\0":
            return r"\x00"
        if token == "[]":
            return "(?!)"
        if token == "[^]":
            return r"[\s\S]"
        return _class(token) if token.startswith("[") else token

    return "".join(one(t) for t in _TOKEN.findall(pattern))


def _translate(patterns: pd.Series) -> pd.Series:
    return patterns.map(lambda p: [to_java(x) if is_safe(x) else None for x in p], na_action="ignore")


def translate(patterns: Column) -> Column:
    """Java form of each pattern in an array; NULL where unsafe."""
    return F.pandas_udf(_translate, T.ArrayType(T.StringType()))(column_argument(patterns))


def compiled_only(translated: str) -> str:
    """NULL for a translated pattern that the JVM cannot compile (SQL)."""
    compiles = lambda p: f"try_reflect('java.util.regex.Pattern', 'compile', {p}) IS NOT NULL"
    return each(translated, lambda p, _: f"CASE WHEN {p} IS NOT NULL AND {compiles(p)} THEN {p} END")


def matches(text: str, pattern: str, known: list[str]) -> str:
    """Unanchored match of ``text`` (SQL); patterns in ``known`` are compiled once per task."""
    if not known:
        return f"{text} RLIKE {pattern}"
    cases = " ".join(f"WHEN {literal(p)} THEN {text} RLIKE {literal(p)}" for p in known)
    return f"CASE {pattern} {cases} ELSE {text} RLIKE {pattern} END"
