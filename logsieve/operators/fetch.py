"""Reading the documents that an index has found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys up to which documents are read by ranges of keys, and the ranges that a scan is given.
MOST_KEYS, MOST_RANGES = 2000, 100


def fetch(docs: DataFrame, keys: DataFrame, key: str = "doc_id", most: int = MOST_KEYS) -> DataFrame:
    """The documents whose key is among the keys, which are distinct.

    Few keys become ranges that reach the scan: of a table that is sorted by key, only the pages
    that hold one are read. Beyond ``most`` keys, or where they are no numbers or texts, it is a semi
    join, and the optimiser decides by size whether the keys are sent to the documents.
    """
    kind = docs.schema[key].dataType.simpleString()
    if kind not in ("bigint", "int", "string"):
        return docs.join(keys.select(key), key, "left_semi")
    found = [r[0] for r in keys.select(key).limit(most + 1).collect()]  # no more than most + 1, however many there are
    if len(found) > most:
        return docs.join(keys.select(key), key, "left_semi")
    found = sorted(k for k in found if k is not None)
    if not found:
        return docs.filter(F.lit(False))
    return docs.filter(_in_ranges(F.col(key), found)).filter(F.col(key).isin(found))


def _in_ranges(value: Column, found: list) -> Column:
    """A condition that holds for all of them, as a few ranges that are cut where the gaps are widest."""
    if isinstance(found[0], int):
        gaps = sorted(range(1, len(found)), key=lambda i: found[i] - found[i - 1], reverse=True)
        cuts = sorted(gaps[:MOST_RANGES - 1])
    else:
        step = max(1, -(-len(found) // MOST_RANGES))
        cuts = list(range(step, len(found), step))
    parts = [(found[a], found[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(found)])]
    tests = [value == low if low == high else (value >= low) & (value <= high) for low, high in parts]
    while len(tests) > 1:  # a balanced tree, so that the plan stays shallow
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i] for i in range(0, len(tests), 2)]
    return tests[0]
