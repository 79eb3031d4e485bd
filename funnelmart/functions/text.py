"""Text matching and the compilation of word families and rule lists into SQL expressions.

Text is compared regardless of case, through ``lower``; trimming removes spaces only. Expressions are
built as SQL text and parsed in one go, which for long word lists is much cheaper than assembling them
literal by literal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(value) -> str:
    """A number or text as a SQL literal."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def literals(values) -> str:
    return ", ".join(literal(value) for value in values)


def match_key(text: str, trim: bool = True) -> str:
    """The form under which two labels count as the same."""
    return f"lower(trim({text}))" if trim else f"lower({text})"


def matches(key: str, words=(), patterns=()) -> str:
    """Whether ``key`` is one of ``words`` or fits one of the LIKE ``patterns``."""
    tests = [f"{key} in ({literals(word.lower() for word in words)})"] if words else []
    tests += [f"{key} like {literal(pattern)}" for pattern in patterns]
    return f"({' or '.join(tests)})"


def flag(key: str, words=(), patterns=()) -> Column:
    return F.expr(f"case when {matches(key, words, patterns)} then 1 else 0 end")


def first_match(key: str, rules, default: str) -> Column:
    """The answer of the first rule ``(answer, words, patterns)`` that fits, else ``default``."""
    cases = [f"when {matches(key, words, patterns)} then {literal(answer)}" for answer, words, patterns in rules]
    return F.expr(f"case {' '.join(cases)} else {default} end")


def family_value(key: str, families, other, pick) -> Column:
    """``pick(attributes)`` of the family that holds ``key``, or of ``other``.

    No two families share a word, so families with the same answer become one rule.
    """
    default = pick(list(other))
    words_of: dict = {}
    for words, *attributes in families:
        words_of.setdefault(pick(attributes), []).extend(words)
    rules = [(answer, words, ()) for answer, words in words_of.items() if answer != default]
    return first_match(key, rules, literal(default))
