"""Search clauses: a truth column and a score column, combined as boolean clauses.

Scores: a regex, wildcard or exists clause that holds is worth 1.0, a text clause its BM25
value when corpus statistics are given and 1.0 otherwise. ``filter`` and ``must_not`` add
nothing; ``must`` and ``should`` add the scores of the clauses that hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from logsieve.functions.patterns import FIND, WHOLE, Pattern, compile_pattern
from logsieve.functions.text import SIMPLE, has_words, query_terms, tokens


@dataclass(frozen=True)
class Clause:
    """``holds`` may be null where the value is missing; ``score`` counts only where it holds."""

    holds: Column
    score: Column

    @property
    def is_hit(self) -> Column:
        """Never null: a missing value is no hit."""
        return F.coalesce(self.holds, F.lit(False))

    @property
    def score_if_hit(self) -> Column:
        return F.when(self.is_hit, self.score).otherwise(F.lit(0.0))


def _constant(holds: Column) -> Clause:
    return Clause(holds, F.lit(1.0))


def _value(path: str, on: str) -> Column:
    if on == "value":
        return F.col(path)
    if on == "lower":
        return F.lower(F.col(path))
    raise ValueError(f"on must be 'value' or 'lower' here, not {on!r}")


def regex(path: str, pattern: str | Pattern, on: str = "value") -> Clause:
    """The whole value, or its lower-cased form, matches a whole-value pattern."""
    return _constant(compile_pattern(pattern, WHOLE).test(_value(path, on)))


def find(path: str, pattern: str | Pattern, options: str = "") -> Clause:
    """The pattern is found somewhere in the value."""
    return _constant(compile_pattern(pattern, FIND, options).test(F.col(path)))


def find_not(path: str, pattern: str | Pattern, options: str = "") -> Clause:
    """The pattern is not found; a missing value counts as a hit."""
    found = compile_pattern(pattern, FIND, options).test(F.col(path))
    return _constant(F.coalesce(~found, F.lit(True)))


def wildcard(path: str, query: str = "*") -> Clause:
    """``*`` stands for any text, ``?`` for one character; the whole value must fit."""
    value = F.col(path)
    if query and set(query) == {"*"}:
        return _constant(value.isNotNull())
    like, chars = "", iter(query)
    for char in chars:
        if char == "\\":
            char = next(chars, "\\")
        elif char in "*?":
            like += "%" if char == "*" else "_"
            continue
        like += "\\" + char if char in "%_\\" else char
    return _constant(value.like(like))


def exists(path: str) -> Clause:
    return _constant(F.col(path).isNotNull())


def contains(path: str, keyword: str) -> Clause:
    """Keyword containment, as LIKE '%keyword%': case-sensitive, ignores word borders."""
    return _constant(F.col(path).contains(keyword))


def text(path: str, query: str, mode: str = "any", stats: "object | None" = None, rule: str = SIMPLE) -> Clause:
    """The value holds any (or all) of the query's words, by the simple or the standard rule for words.

    ``stats`` from ``relevance.corpus_stats`` by the same rule makes the score BM25.
    """
    value = F.col(path)
    score = stats.score(tokens(value, rule), query_terms(query, rule)) if stats else F.lit(1.0)
    return Clause(has_words(value, query, mode, rule), score)


def clause(path: str, query: str, kind: str, on: str = "value") -> Clause:
    """A clause by name, for a path read as ``value``, ``lower`` or ``tokens``."""
    if on == "tokens":
        if kind != "text":
            raise ValueError("tokens can only be searched with a text clause")
        return text(path, query)
    if kind == "regex":
        return regex(path, query, on)
    if kind == "wildcard" and on == "value":
        return wildcard(path, query)
    raise ValueError(f"no clause {kind!r} on {on!r}")


def compound(filter: Sequence[Clause] = (), must: Sequence[Clause] = (),
             must_not: Sequence[Clause] = (), should: Sequence[Clause] = (),
             minimum_should: int | None = None) -> Clause:
    """All of ``filter`` and ``must`` hold, none of ``must_not``, and enough of ``should``.

    Clauses are tested in the order given, so put the cheapest selective one first. Those that
    have to hold stay plain conditions, which a scan can take over. With no ``filter`` and no
    ``must``, one ``should`` clause has to hold unless told otherwise.
    """
    if minimum_should is None:
        minimum_should = 1 if should and not filter and not must else 0
    tests = [c.holds for c in (*filter, *must)] + [~c.is_hit for c in must_not]
    if minimum_should == 1:
        tests.append(_join([c.is_hit for c in should], Column.__or__))
    elif minimum_should > 1:
        held = _join([c.is_hit.cast("int") for c in should], Column.__add__)
        tests.append(held >= F.lit(minimum_should))
    if not tests:
        raise ValueError("a compound clause needs at least one clause")
    scores = [c.score for c in must] + [c.score_if_hit for c in should]
    return Clause(_join(tests, Column.__and__), _join(scores, Column.__add__) if scores else F.lit(0.0))


def _join(columns: list[Column], combine) -> Column:
    joined = columns[0]
    for column in columns[1:]:
        joined = combine(joined, column)
    return joined
