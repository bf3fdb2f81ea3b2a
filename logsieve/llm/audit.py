"""Filter interaction audit: what each of five filters removes, in every order in which they can be applied.

1. Each document becomes a mask, one bit for each filter that it fails, and the digest of its text. A text's copies are
   told apart by grouped minima of ids, so no join meets a text and no window holds its copies.
2. Documents are counted by part and mask: 32 cells for each part at most, with their labels.
3. Each cell folds across the array of all 120 orders: `transform` over the orders, `aggregate` along each of them. This
   gives 600 structs weighted by the cell's counts. A part's cells are merged by elementwise sums.

Scale: texts are read once and never shuffled. Small rows (id, part, mask, digest) are grouped three times, each time
combined before the shuffle; a part is 32 cells whatever its size. The orders are a constant of the plan.

Edge cases: a null text is empty; a null source is the part "", together with sources that are empty. A document with a
null id has no labels; it is a copy of none, and makes none a copy. Rows with equal id and text aren't copies of each
other. A document is good (toxic) if any of its rows in labels says 1. Without documents there are no rows; other
columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logsieve.llm.common import stored

#: Under 200 words; under half of the words distinct; over 2% upper case; holds a symbol; equal to an earlier text.
FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SYMBOLS = 200, 50, 2, r"[#$%&*|]"
SPACE = " \t\n\x0b\x0c\r"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_COPY = 1 << FILTERS.index("E")


def bit(filter_: str) -> int:
    return 1 << FILTERS.index(filter_)


def verdicts(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(id, part, mask, digest) of every document; the mask holds what its own text fails."""
    rows = docs.select(docs[key].alias("id"), F.coalesce(docs[source].cast("string"), F.lit("")).alias("part"),
                       F.coalesce(docs[text], F.lit("")).alias("t")).withColumn("bare", F.btrim("t", F.lit(SPACE)))
    rows = rows.withColumn("words", F.when(F.col("bare") == "", F.array().cast("array<string>")).otherwise(F.split("bare", r"[\x20\x09-\x0D]+")))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    fails = {
        "A": n < LEAST_WORDS,
        "B": 100 * distinct < DISTINCT_PERCENT * n,
        "C": 100 * F.regexp_count("t", F.lit("[A-Z]")) > UPPER_PERCENT * F.length("t"),
        "D": F.col("t").rlike(SYMBOLS),
    }
    mask = sum((F.when(test, bit(f)).otherwise(0) for f, test in fails.items()), F.lit(0))
    return rows.select("id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest"))


def _labelled(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Adds good and toxic (0 or 1). Rows without an id meet no label and are spread by their digest."""
    flags = labels.where(labels[key].isNotNull()).groupBy(labels[key].alias("of")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    rows = rows.withColumn("salt", F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(1 << 20))).otherwise(F.lit(-1).cast("long")))
    flags = flags.withColumn("side", F.lit(-1).cast("long"))
    joined = rows.join(flags, (rows["id"] == flags["of"]) & (rows["salt"] == flags["side"]), "left")
    return joined.select("id", "salt", "part", "mask", "digest", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def cells(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(part, mask, docs, good, toxic): how many documents fail exactly the filters of each mask."""
    rows = _labelled(stored(verdicts(docs, key, text, source), "verdicts"), labels, key)
    flags = ("good", "toxic")
    rows = rows.groupBy("id", "salt", "digest", "part", "mask", *flags).agg(F.count(F.lit(1)).alias("rows"))
    alike = rows.groupBy("digest", "part", "mask", *flags).agg(
        F.sum("rows").alias("rows"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "rows"))).alias("first"),
        F.sum(F.when(F.col("id").isNull(), F.col("rows")).otherwise(0)).alias("nameless"),
    )
    alike = alike.withColumn("least", F.min("first.id").over(W.partitionBy("digest")))
    originals = F.col("nameless") + F.when(F.col("first.id") == F.col("least"), F.col("first.rows")).otherwise(0)
    sides = F.array(F.struct(F.col("mask"), originals.alias("docs")), F.struct((F.col("mask") + _COPY).alias("mask"), (F.col("rows") - originals).alias("docs")))
    counted = alike.select("part", *flags, F.inline(sides)).where("docs > 0")
    return counted.groupBy("part", "mask").agg(
        F.sum("docs").alias("docs"), *[F.sum(F.when(F.col(f) == 1, F.col("docs")).otherwise(0)).alias(f) for f in flags])


def _along(order: Column, cell: Column) -> Column:
    """The five steps of one order for one cell: an array of structs of FIGURES."""
    kinds = ",".join(f"{f}:bigint" for f in FIGURES)
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(f"array<struct<{kinds}>>").alias("steps"))

    def step(done: Column, own: Column) -> Column:
        gone, fails = done["gone"], cell["mask"].bitwiseAND(own) != 0
        here = fails & ~gone
        when = {"kept": (~gone & ~fails, "docs"), "removed": (here, "docs"), "redundant": (fails & gone, "docs"),
                "unique_fails": (cell["mask"] == own, "docs"), "good_lost": (here, "good"), "toxic_lost": (here, "toxic")}
        figures = F.struct(*[F.when(test, cell[weight]).otherwise(F.lit(0).cast("long")).alias(f) for f, (test, weight) in when.items()])
        return F.struct((gone | fails).alias("gone"), F.array_append(done["steps"], figures).alias("steps"))

    return F.aggregate(order, start, step, lambda done: done["steps"])


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): 600 rows for each part.

    shapley is what the step's filter removes, summed over all orders.
    """
    bits = F.array(*[F.array(*[F.lit(bit(f)) for f in order]) for order in ORDERS])
    letters = F.split(F.lit(",".join("".join(ORDERS))), ",")
    zeros = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(f) for f in FIGURES]), len(ORDERS) * len(FILTERS))

    def add(left: Column, right: Column) -> Column:
        return F.struct(*[(left[f] + right[f]).alias(f) for f in FIGURES])

    def merge(done: Column, cell: Column) -> Column:
        return F.zip_with(done, F.flatten(F.transform(bits, lambda order: _along(order, cell))), add)

    found = cells(docs, labels, key, text, source).groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("cells"))
    sums = found.select("part", F.aggregate("cells", zeros, merge).alias("sums"))
    removed = F.transform(F.split(F.lit(",".join(FILTERS)), ","), lambda f: F.aggregate(
        F.zip_with("sums", letters, lambda s, letter: F.when(letter == f, s["removed"]).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a + x))
    steps = sums.select("part", F.map_from_arrays(F.split(F.lit(",".join(FILTERS)), ","), removed).alias("all"), F.posexplode("sums"))
    order, step = F.split(F.lit(",".join(ORDERS)), ",")[F.floor(F.col("pos") / len(FILTERS)).cast("int")], (F.col("pos") % len(FILTERS) + 1).cast("int")
    steps = steps.select("part", "all", "col", order.alias("filter_order"), step.alias("step"))
    return steps.select("part", "filter_order", "step", *[F.col(f"col.{f}").alias(f) for f in FIGURES],
                        F.col("all")[F.substring(F.col("filter_order"), F.col("step"), F.lit(1))].alias("shapley"))
