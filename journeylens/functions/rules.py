"""First-match rules as data, rendered as one SQL CASE.

A rule is `(alternatives, result)`: it fires when any alternative holds. An alternative is a
list of tests that must all hold. A test is `(column, comparison, value)`, or
`(column, "holds")` for a flag, or `(column, "null")`. A result is a literal, or
`("copy", column)`, or `("part", column, n)` for the n-th piece, in lower case, of an
underscore-delimited name.

One expression text is much faster to build than hundreds of Column calls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(text: str | None) -> str:
    return "null" if text is None else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def condition(column: str, comparison: str, value: str | None = None) -> str:
    forms = {
        "like": f"{column} like {literal(value)}",
        "unlike": f"{column} not like {literal(value)}",
        "is": f"{column} = {literal(value)}",
        "is not": f"{column} != {literal(value)}",
        "null": f"{column} is null",
        "holds": column,
    }
    return forms[comparison]


def _result(result) -> str:
    if isinstance(result, str):
        return literal(result)
    if result[0] == "copy":
        return result[1]
    return f"lower(get(split({result[1]}, '_'), {result[2]}))"


def first_match(rules: list[tuple], otherwise: str = "null") -> Column:
    arms = []
    for alternatives, result in rules:
        either = " or ".join("(" + " and ".join(condition(*t) for t in tests) + ")" for tests in alternatives)
        arms.append(f"when {either} then {_result(result)}")
    return F.expr(f"case {' '.join(arms)} else {otherwise} end")


def contains(column: str, words: list[str], result=None, *guards: tuple) -> list[tuple]:
    """One rule per word: `column` contains the word; the result is the word itself by default."""
    return [([[(column, "like", f"%{word}%"), *guards]], result or word) for word in words]
