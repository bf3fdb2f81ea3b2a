"""Word tokens and token tests, by two rules.

``simple``    a word is a maximal run of letters, marks, digits and underscores.
``standard``  words end at the word boundaries of Unicode (UAX #29): letters are joined across one of ``. ' : `` and the
              like between them, digits across one of ``. ' , ;`` and the like, so that ``can't``, ``3.14`` and
              ``example.com`` are words. Ideographs and Hiragana are words of one character, Katakana, Thai and
              related scripts words of one run.

Both put words in lower case.
"""

from __future__ import annotations

import unicodedata

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

SIMPLE, STANDARD = "simple", "standard"
WORD = r"[\p{L}\p{M}\p{N}_]"

# The classes of UAX #29 that matter for words, as far as general categories and scripts tell them.
_RUNS = r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_LETTER = rf"[\p{{L}}\p{{Nl}}&&[^\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}{_RUNS}]]"
_MORE = r"\p{M}\u200C\u200D\u00AD"
_MID_LETTER, _MID_NUMBER = "[:\u00B7\u0387\u05F4\u2027\uFE13\uFE55\uFF1A.\u2018\u2019\u2024\uFE52\uFF07\uFF0E']", (
    "[,;\u037E\u0589\u060C\u060D\u066C\u07F8\u2044\uFE10\uFE14\uFE50\uFE54\uFF0C\uFF1B.\u2018\u2019\u2024\uFE52\uFF07\uFF0E']")


def _standard(letter: str) -> str:
    """Possessive throughout, so that long texts need no stack and nothing is tried twice."""
    letters = rf"{letter}(?:{letter}|[{_MORE}])*+"
    numbers = rf"\p{{Nd}}[\p{{Nd}}{_MORE}]*+"
    joined = (rf"(?:{letters}(?:{_MID_LETTER}{letters})*+|{numbers}(?:{_MID_NUMBER}{numbers})*+"
              rf"|[\p{{IsKatakana}}\u30FC][\p{{IsKatakana}}\u30FC{_MORE}]*+|\p{{Pc}}[{_MORE}]*+)++")
    return rf"{joined}|[\p{{IsHan}}\p{{IsHiragana}}][{_MORE}]*+|[{_RUNS}][{_RUNS}{_MORE}]*+"


_PATTERNS = {SIMPLE: WORD + "+", STANDARD: _standard(_LETTER)}
_READER = regex.compile(_standard(_LETTER), regex.V1)


def _check(rule: str) -> None:
    if rule not in _PATTERNS:
        raise ValueError(f"rule must be '{SIMPLE}' or '{STANDARD}', not {rule!r}")


def tokens(value: Column, rule: str = SIMPLE) -> Column:
    """The words of a value, in order."""
    _check(rule)
    found = F.regexp_extract_all(F.lower(value), F.lit(_PATTERNS[rule]), F.lit(0))
    # A connector by itself joins nothing and is no word.
    return F.filter(found, lambda word: word.rlike(r"[^\p{Pc}\p{M}]")) if rule == STANDARD else found


def query_words(query: str, rule: str = SIMPLE) -> list[str]:
    """The words of a query text in order, by the same rule as ``tokens``."""
    _check(rule)
    if rule == STANDARD:
        words = [w for w in _READER.findall(query.lower()) if regex.search(r"[^\p{Pc}\p{M}]", w)]
    else:
        words = "".join(c if c == "_" or unicodedata.category(c)[0] in "LMN" else " " for c in query.lower()).split()
    if not words:
        raise ValueError(f"no word in text query {query!r}")
    return words


def query_terms(query: str, rule: str = SIMPLE) -> list[str]:
    """The distinct words of a query text."""
    return list(dict.fromkeys(query_words(query, rule)))


def has_words(value: Column, query: str, mode: str = "any", rule: str = SIMPLE) -> Column:
    """True where the value holds any (or all) of the query's words.

    Equal to a test on the ``tokens`` array, but by the simple rule it builds no array: a word is
    present exactly where its text occurs with no word character on either side. A plain substring
    test, which every hit passes, runs before the regex, or by the standard rule before the array.
    """
    terms = query_terms(query, rule)
    if mode not in ("any", "all"):
        raise ValueError(f"mode must be 'any' or 'all', not {mode!r}")
    folded = F.lower(value)
    if rule == STANDARD:
        words, wanted = tokens(value, rule), F.array(*map(F.lit, terms))
        near = folded.contains(terms[0])
        for term in terms[1:]:
            near = near | folded.contains(term) if mode == "any" else near & folded.contains(term)
        return near & (F.arrays_overlap(words, wanted) if mode == "any" else F.size(F.array_except(wanted, words)) == 0)
    if mode == "all":
        found = _has_one_of(folded, terms[:1])
        for term in terms[1:]:
            found = found & _has_one_of(folded, [term])
        return found
    return _has_one_of(folded, terms)


def _has_one_of(folded: Column, terms: list[str]) -> Column:
    near = folded.contains(terms[0])
    for term in terms[1:]:
        near = near | folded.contains(term)
    return near & folded.rlike(f"(?<!{WORD})(?:{'|'.join(terms)})(?!{WORD})")


def term_frequency(words: Column, term: str) -> Column:
    """How often a term occurs in a token array."""
    return F.size(F.filter(words, lambda word: word == F.lit(term)))
