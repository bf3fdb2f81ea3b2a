"""What a match looks like: occurrences, records, lines, counts and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.functions.patterns import Pattern, compile_pattern

# Width of the blocks in which running lengths are added up (see _starts).
_BLOCK = 256


def find_all(value: Column, pattern: str | Pattern, options: str = "") -> Column:
    """Every match, in order, duplicates kept."""
    compiled = compile_pattern(pattern, options=options)
    return F.regexp_extract_all(value, F.lit(compiled.java), F.lit(0))


def count_matches(value: Column, pattern: str | Pattern, options: str = "") -> Column:
    """Number of non-overlapping matches."""
    compiled = compile_pattern(pattern, options=options)
    text = compiled.one_literal
    if text is None:
        return F.size(find_all(value, compiled)).cast("long")
    removed = F.octet_length(value) - F.octet_length(F.replace(value, F.lit(text), F.lit("")))
    return (removed / F.lit(len(text.encode("utf-8")))).cast("long")


def find_records(value: Column, pattern: str | Pattern, options: str = "") -> Column:
    """Matches as ``array<struct<match, idx, captures>>``; ``idx`` counts code points from 0."""
    compiled = compile_pattern(pattern, options=options)
    if compiled.least_width == 0:
        raise ValueError(f"offsets need a pattern that cannot match the empty text: {compiled.source!r}")
    java = F.lit(compiled.java)
    groups = [_capture(value, java, number, least).alias(f"g{number}")
              for number, least in enumerate(compiled.groups, start=1)]
    parts = F.struct(F.regexp_extract_all(value, java, F.lit(0)).alias("match"),
                     F.split(value, compiled.java, -1).alias("pieces"), *groups)

    def record(row: Column) -> Column:
        taken = [row[f"g{number}"] for number in range(1, len(groups) + 1)]
        return F.struct(row["match"].alias("match"), row["idx"].alias("idx"),
                        (F.array(*taken) if taken else F.array().cast("array<string>")).alias("captures"))

    return _named(parts, lambda found: F.transform(
        F.arrays_zip(found["match"].alias("match"), _starts(found["pieces"], found["match"]).alias("idx"),
                     *[found[f"g{n}"].alias(f"g{n}") for n in range(1, len(groups) + 1)]), record))


def _named(value: Column, body) -> Column:
    """``body`` with a name for ``value``, so that it is computed once however often it is used."""
    return F.transform(F.array(value), body)[0]


def _capture(value: Column, java: Column, number: int, least_width: int) -> Column:
    texts = F.regexp_extract_all(value, java, F.lit(number))
    if least_width == 0:
        return texts
    # A group that took no part comes back as ''; a taken one cannot be that short.
    return F.transform(texts, lambda text: F.nullif(text, F.lit("")))


def _starts(pieces: Column, matches: Column) -> Column:
    """Start of each match: running length of the pieces between matches and of the matches.

    With many matches, lengths are added up inside blocks of fixed width first, then across
    blocks, so that one growing array is not copied once per match.
    """
    steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda piece, match: F.struct(
        F.length(piece).alias("gap"), (F.length(piece) + F.length(match)).alias("step")))
    last = F.floor((F.size(matches) - 1) / F.lit(_BLOCK)).cast("int")

    def across_blocks(known: Column) -> Column:
        return F.flatten(F.zip_with(known, _running(F.transform(known, _block_total)), _block_starts))

    def placed(known: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(known, b * _BLOCK + 1, F.lit(_BLOCK)))
        return (F.when(F.size(known) <= _BLOCK, _block_starts(known, F.lit(0)))
                .otherwise(_named(blocks, across_blocks)))

    return _named(steps, placed)


def _block_starts(block: Column, base: Column) -> Column:
    return F.zip_with(_running(F.transform(block, lambda s: s["step"])), block,
                      lambda before, s: base + before + s["gap"])


def _block_total(block: Column) -> Column:
    return F.aggregate(block, F.lit(0), lambda done, s: done + s["step"])


def _running(numbers: Column) -> Column:
    """Sum of all earlier elements, for each element."""
    empty = F.struct(F.lit(0).alias("done"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(
        numbers, empty,
        lambda acc, n: F.struct((acc["done"] + n).alias("done"),
                                F.array_append(acc["out"], acc["done"]).alias("out")),
        lambda acc: acc["out"])


def split_lines(value: Column) -> Column:
    return F.split(value, "\n", -1)


def matching_lines(value: Column, pattern: str | Pattern, options: str = "") -> Column:
    """The lines on which the pattern is found."""
    compiled = compile_pattern(pattern, options=options)
    return F.filter(split_lines(value), compiled.test)


def line_view(docs: DataFrame, pattern: str | Pattern, content: str = "content",
              key: str = "doc_id", options: str = "") -> DataFrame:
    """One row per matching line, with its number from 1.

    The document filter comes first, so only texts with a hit are split.
    """
    compiled = compile_pattern(pattern, options=options)
    lines = (docs.filter(compiled.test(F.col(content)))
             .select(key, F.posexplode(split_lines(F.col(content))).alias("pos", "line")))
    return (lines.filter(compiled.test(F.col("line")))
            .select(key, (F.col("pos") + 1).cast("long").alias("line_no"), "line"))


def preview(value: Column, width: int = 100) -> Column:
    """The first ``width`` characters, with ``...`` when the value is longer."""
    return (F.when(F.length(value) > width, F.concat(F.substring(value, 1, width), F.lit("...")))
            .otherwise(value))


def or_missing(value: Column, text: str = "N/A") -> Column:
    return F.coalesce(value, F.lit(text))
