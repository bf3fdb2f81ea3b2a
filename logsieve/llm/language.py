"""Language identification by Bayesian evidence fusion.

Evidence of a row: its text (likelihood of its character trigrams in each language), the language that its markup or
label declares, the suffix of its address, and the host. How far a declaration can be trusted, and which languages a
host, its domain and its suffix hold, is counted over all rows, with the text's own decision as the provisional
language. The prior of a host is smoothed towards its domain, that towards the suffix, that towards the kind of row.
Sums of logarithms, one per language, give the posterior. One more language, "und", has the likelihood of trigrams that
no training text holds; it wins for text in none of the languages.

The trigram model is fitted on a bounded sample: of each language the SAMPLE labelled rows of at most SAMPLE_BYTES that
come first in a hashed order. Everything else is counted over all rows.

Scale: the text is read once, in batches, and only numbers leave the task. Counts are grouped aggregates, summed before
they move; the tables of hosts, domains and suffixes are joined, not broadcast.

Edge cases: a null or empty text, or one without letters, has no evidence; it is "und" and isn't kept. Null hosts,
suffixes and declarations are values of their own. Equal posteriors go to the first language by name. Equal rows are
answered alike. An empty table gives no rows; without labelled rows every row is "und".
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logsieve.llm.common import stored

SAMPLE, SAMPLE_BYTES = 400, 20_000
BINS, BITS = 1 << 16, 16
#: Trigrams overlap three times, so a text counts for a third of its trigrams. Counts that priors and trust begin with.
TEMPER, PRIOR, TRUST = 1 / 3, 20.0, 5.0
#: Least posterior of a kept row.
CONFIDENCE = 0.8
UNKNOWN = "und"


def _grams(data: np.ndarray) -> np.ndarray:
    """Bins of the byte trigrams of a text in lower case, runs of other characters than letters as one space."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    mixed = (data[:-2].astype(np.uint32) * np.uint32(0x9E3779B1)) ^ (data[1:-1].astype(np.uint32) * np.uint32(0x85EBCA77))
    mixed = (mixed ^ (data[2:].astype(np.uint32) * np.uint32(0xC2B2AE3D))) * np.uint32(0x27D4EB2F)
    return (mixed >> np.uint32(32 - BITS)).astype(np.int64)


def letters(text: str | None) -> np.ndarray:
    """The text's bytes in lower case, with each run of ASCII that isn't a letter as one space, between spaces."""
    data = np.frombuffer(b" " + (text or "").lower().encode() + b" ", np.uint8)
    other = (data < 128) & ~((data >= 97) & (data <= 122))
    data = np.where(other, np.uint8(32), data)
    return data[~(other & np.append(False, other[:-1]))]


class Model:
    """Logarithms of trigram likelihoods by bin and language; the last language is UNKNOWN."""

    def __init__(self, rows: list[tuple[str, str]]):
        known = sorted({lang for lang, _ in rows})
        counts = np.zeros((BINS, len(known)), np.float64)
        for lang, text in rows:
            counts[:, known.index(lang)] += np.bincount(_grams(letters(text)), minlength=BINS)
        total = counts.sum(0)
        self.languages = [*known, UNKNOWN]
        # A trigram never seen is as likely as one seen half a time; UNKNOWN holds every bin alike.
        found = np.log((counts + 0.5) / (total + BINS / 2))
        self.table = np.column_stack([found, np.full(BINS, -np.log(BINS))]).astype(np.float32)

    def score(self, text: str | None) -> tuple[int, np.ndarray]:
        """Number of trigrams, and the tempered log likelihood of each language."""
        data = letters(text)
        if not (data != 32).any():
            return 0, np.zeros(len(self.languages))
        bins = _grams(data)
        return len(bins), self.table[bins].sum(0, dtype=np.float64) * TEMPER


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """The model of the first `sample` rows of each language, in the order of a hash of the key."""
    rows = labelled.select(labelled[lang].alias("lang"), labelled[text].alias("text"), F.xxhash64(labelled[key]).alias("h"))
    rows = rows.where((F.octet_length("text") <= SAMPLE_BYTES) & F.col("lang").isNotNull() & (F.trim("text") != ""))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model([])
    # Hashes are spread evenly: this part of them holds the sample, and no more than twice of it is ever put in order.
    part = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, (2 * sample + 100) / n))])
    rows = rows.where(F.col("h") / 2.0**64 + 0.5 <= part[F.col("lang")])
    place = F.row_number().over(W.partitionBy("lang").orderBy("h", "text"))
    return Model([(r.lang, r.text) for r in rows.withColumn("n", place).where(F.col("n") <= sample).select("lang", "text").collect()])


def evidence(rows: DataFrame, model: Model) -> DataFrame:
    """The columns of `rows` without `text`, with `grams` and `scores` (one for each language of the model)."""
    names = [c for c in rows.columns if c != "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(t.as_py()) for t in batch.column("text")]
            scores = pa.array([s.tolist() for _, s in found], pa.list_(pa.float64()))
            columns = [*(batch.column(c) for c in names), pa.array([n for n, _ in found], pa.int64()), scores]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "grams", "scores"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.mapInArrow(run, f"{fields}, grams long, scores array<double>")


def _best(score: list[Column]) -> Column:
    """Place of the largest of the columns, the first of equal ones."""
    top = F.greatest(*score) if len(score) > 1 else score[0]
    return reduce(lambda rest, i: F.when(score[i] >= top, F.lit(i)).otherwise(rest), reversed(range(len(score) - 1)), F.lit(len(score) - 1))


def _counts(rows: DataFrame, by: list[str], n: int, name: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.array(*[F.sum((F.col("first") == i).cast("double")) for i in range(n)]).alias(name))


def _smoothed(counts: Column, towards: Column, weight: float) -> Column:
    """Shares of the counts, `weight` more of them dealt out as `towards` says."""
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x) + weight
    return F.zip_with(counts, towards, lambda c, p: (c + weight * p) / total)


def identify(rows: DataFrame, model: Model) -> DataFrame:
    """The other columns of `rows`, with lang, confidence and kept (in place of columns with these names).

    rows: text, kind, declared, suffix, domain, host and whatever is to be carried over.
    """
    n = len(model.languages)
    levels = ["kind", "suffix", "domain", "host"]
    answer = ["lang", "confidence", "kept"]
    carried = F.struct(*[F.col(c) for c in rows.columns if c not in ("text", "declared", *levels, *answer)])
    rows = rows.select("text", "declared", *levels, carried.alias("carried"))
    clean = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in [*levels, "declared"]}
    found = evidence(rows.withColumns({f"_{c}": v for c, v in clean.items()}), model)
    found = found.withColumn("first", F.when(F.col("grams") > 0, _best([F.col("scores")[i] for i in range(n)])).otherwise(n))
    found = stored(found, "evidence")

    counted = found.select(*[F.col(f"_{c}").alias(c) for c in [*levels, "declared"]], "first")
    hosts = stored(_counts(counted, levels, n, "c4"), "hosts")
    sums = F.array(*[F.sum(F.col("c4")[i]) for i in range(n)])
    prior = F.array(*[F.lit(1.0 / n)] * n)
    table = hosts
    for depth in (1, 2, 3):
        table = table.join(hosts.groupBy(*levels[:depth]).agg(sums.alias(f"c{depth}")), levels[:depth])
    for depth in (1, 2, 3, 4):
        prior = _smoothed(F.col(f"c{depth}"), prior, PRIOR)
    priors = table.select(*[F.col(c).alias(f"_{c}") for c in levels], prior.alias("prior"))

    pairs = _counts(counted, ["kind", "declared"], n, "pair")
    whole = pairs.groupBy("kind").agg(F.array(*[F.sum(F.col("pair")[i]) for i in range(n)]).alias("whole"), F.count(F.lit(1)).alias("kinds"))
    trust = F.zip_with("pair", "whole", lambda p, w: (p + TRUST / F.col("kinds")) / (w + TRUST))
    trust = pairs.join(whole, "kind").select(F.col("kind").alias("_kind"), F.col("declared").alias("_declared"), trust.alias("trust"))

    joined = found.join(priors, [f"_{c}" for c in levels]).join(trust, ["_kind", "_declared"])
    total = [F.col("scores")[i] + F.log(F.col("prior")[i]) + F.log(F.col("trust")[i]) for i in range(n)]
    joined = joined.withColumn("_total", F.array(*total))
    score = [F.col("_total")[i] for i in range(n)]
    best = _best(score)
    top = F.array_max("_total")
    share = 1 / F.aggregate("_total", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    names = F.array(*map(F.lit, model.languages))
    lang = F.when(F.col("grams") > 0, names[best]).otherwise(F.lit(UNKNOWN))
    confidence = F.when(F.col("grams") > 0, share).otherwise(F.lit(0.0))
    kept = (lang != UNKNOWN) & (confidence >= CONFIDENCE)
    return joined.select("carried.*", lang.alias("lang"), confidence.alias("confidence"), kept.alias("kept"))


def of_documents(docs: DataFrame) -> DataFrame:
    """Documents as rows for `identify`: the label is the declaration, the source stands for the host."""
    none = F.lit(None).cast("string")
    return docs.select("doc_id", none.cast("long").alias("page_id"), "text", F.lit("document").alias("kind"), F.col("lang").alias("declared"),
                       none.alias("suffix"), none.alias("domain"), F.col("source").alias("host"))


def of_pages(pages: DataFrame) -> DataFrame:
    """Pages as rows for `identify`: text without markup; declaration, suffix, domain and host from page and address."""
    page, host = F.col("html"), F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    declared = F.lower(F.regexp_extract(page, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    text = F.regexp_replace(page, r"(?is)<(script|style)\b[^>]*>.*?(?:</\1\b[^>]*>|\z)|<!--.*?(?:-->|\z)|<[^>]*>", " ")
    text = F.regexp_replace(text, r"&[#A-Za-z0-9]{1,10};", " ")
    return pages.select(F.lit(None).cast("long").alias("doc_id"), "page_id", text.alias("text"), F.lit("page").alias("kind"), declared.alias("declared"),
                        F.regexp_extract(host, r"([^.]*)$", 1).alias("suffix"), F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1).alias("domain"), host.alias("host"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents whose language is known; others go. Rows with equal key, text, label and source go together."""
    mark = F.xxhash64("text", "lang", "source")
    rows = of_documents(docs).withColumn("_print", F.xxhash64("text", "declared", "host"))
    good = identify(rows, fit(docs)).where("kept").select(F.col("doc_id").alias("__id"), F.col("_print").alias("__print")).distinct()
    found = docs.withColumn("__mark", mark)
    return found.join(good, found["doc_id"].eqNullSafe(F.col("__id")) & (found["__mark"] == F.col("__print")), "left_semi").select(*docs.columns)
