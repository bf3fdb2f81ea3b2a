"""Pattern search and log analytics on PySpark."""

from logsieve.functions.patterns import FIND, WHOLE, Pattern, compile_pattern
from logsieve.operators.clauses import (Clause, compound, contains, exists, find, find_not, regex,
                                        text, wildcard)
from logsieve.operators.facets import facet
from logsieve.operators.nearest import nearest, nearest_batch
from logsieve.operators.search import count_hits, first, hits, search, top

__all__ = [
    "FIND", "WHOLE", "Clause", "Pattern", "compile_pattern", "compound", "contains", "count_hits",
    "exists", "facet", "find", "find_not", "first", "hits", "nearest", "nearest_batch", "regex",
    "search", "text", "top", "wildcard",
]
