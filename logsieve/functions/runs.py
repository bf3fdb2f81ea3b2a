"""Words of a batch of documents put in order: runs of equal words of one document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Rows that are handed on at once.
ROWS_AT_ONCE = 65_536


@dataclass(frozen=True)
class Runs:
    """For each word of each document: the word, the document's place in the batch, and where its places begin and end."""

    token: pa.Array
    doc: np.ndarray
    bounds: np.ndarray
    places: np.ndarray  # of words in their document, from 0; ascending in a run


def runs(words: pa.ListArray) -> Runs:
    """Equal words of a document side by side; the order of words is any."""
    sizes = words.value_lengths().to_numpy()
    coded = words.flatten().dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(code)) - np.repeat(starts, sizes)
    both = doc * max(1, len(coded.dictionary)) + code
    order = np.argsort(both, kind="stable")
    both = both[order]
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    begins = order[first]
    return Runs(coded.dictionary.take(pa.array(code[begins])), doc[begins], np.append(first, len(both)), places[order])


def in_parts(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, rows.num_rows, ROWS_AT_ONCE):
        yield rows.slice(at, ROWS_AT_ONCE)
