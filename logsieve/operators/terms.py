"""Words by pattern: a dictionary of rotated words, so that ``*`` and ``?`` inside a word become a range of it.

A word is stored once for each of its rotations, with a mark at its end: ``word|``, ``ord|w``, ... ``|word``. A pattern is
rotated until its longest text without a wildcard stands in front, which is then a range of the sorted dictionary; the
few words in that range are tested with the whole pattern.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.operators.textindex import TokenIndex
from logsieve.sources.versions import Versions

# The end of a word; no word holds it. Rows of a file, and words up to which their postings are read by ranges of words.
END, ROWS_PER_FILE, MOST_WORDS = "|", 1_000_000, 2000


def rotations(words: DataFrame) -> DataFrame:
    """Rows ``(rotation, token)`` for a table with distinct tokens."""
    ended = F.concat("token", F.lit(END))
    turned = F.concat(F.substring(ended, F.col("at") + 1, F.length(ended)), F.substring(ended, F.lit(1), F.col("at")))
    rows = words.select("token", F.explode(F.sequence(F.lit(0), F.length("token"))).alias("at"))
    return rows.select(turned.alias("rotation"), "token")


def front(pattern: str) -> str:
    """The longest text that the rotations of all matching words begin with, for one of their rotations."""
    parts, joined = [""], f"{pattern}{END}{pattern}"
    for char in joined:
        if char in "*?":
            parts.append("")
        else:
            parts[-1] += char
    if len(parts) == 1:
        return pattern + END
    # The first and the last part are cut off where the pattern was doubled.
    return max(parts[1:-1], key=len)


def like(pattern: str) -> str:
    return "".join({"*": "%", "?": "_"}.get(c, "\\" + c if c in "%_\\" else c) for c in pattern)


@dataclass(frozen=True)
class TermDictionary:
    """``rotations`` (rotation, token), sorted; ``index`` has the words' documents."""

    rotations: DataFrame
    index: TokenIndex

    @staticmethod
    def ensure(index: TokenIndex, path: str, state: str) -> "TermDictionary":
        """The newest version of the stored dictionary if it was made in that state of the documents, else a new one."""
        spark = index.postings.sparkSession

        def write(folder: str) -> None:
            index.postings.select("token").distinct().write.parquet(f"{folder}/words")
            rows = rotations(spark.read.parquet(f"{folder}/words"))
            files = max(1, rows.count() // ROWS_PER_FILE)
            rows.repartitionByRange(files, "rotation").sortWithinPartitions("rotation").write.parquet(f"{folder}/rotations")

        return TermDictionary.load(spark, Versions(spark, path).ensure(state, write), index)

    @staticmethod
    def load(spark: SparkSession, folder: str, index: TokenIndex) -> "TermDictionary":
        return TermDictionary(spark.read.parquet(f"{folder}/rotations"), index)

    def words(self, pattern: str) -> DataFrame:
        """``token``: the words that match the pattern as a whole, in lower case; ``*`` is any text, ``?`` one character."""
        if not pattern or END in pattern:
            raise ValueError(f"a pattern needs characters, and none may be {END!r}")
        folded, begins = pattern.lower(), front(pattern.lower())
        rows = self.rotations
        if begins:
            rows = rows.filter((F.col("rotation") >= begins) & F.col("rotation").startswith(begins))
        return rows.filter(F.col("token").like(like(folded))).select("token").distinct()

    def keys(self, pattern: str) -> DataFrame:
        """Keys of the documents with a word that matches, each once.

        Few words are named to the scan of the postings, which then reads only theirs; beyond
        ``MOST_WORDS`` it is a semi join of the postings with the words.
        """
        words = self.words(pattern)
        named = [r.token for r in words.limit(MOST_WORDS + 1).collect()]  # no more than MOST_WORDS + 1
        if len(named) > MOST_WORDS:
            rows = self.index.postings.join(words, "token", "left_semi")
        else:
            rows = self.index.postings.filter(F.col("token").isin(sorted(named)) if named else F.lit(False))
        return rows.select(self.index.key).distinct()
