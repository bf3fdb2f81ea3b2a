"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

The words of a source, its documents in a seeded order, form a deck that may be dealt up to `most` times. The deck is
cut into blocks of equal words. The seats of the mix, one block each, go to the highest quotients target / (2 k + 1),
for each output shard by the growth of the apportionment from the shards before it. A source's quota is then dealt from
the front of its deck. No block is ever a row: what a document gives follows from its place in the deck.

Scale: the text is read once, for its number of words and a digest. Only (key, source, size) rows move, hashed by source
and one of 4,096 seeded buckets, so that a source with a third of all documents is spread over many tasks; the place in
the deck follows from key and text, so that rows without a key or with one key are spread as well, and rows equal in both
are one row with a number until the deck is cut. The sums of buckets have at most 4,096 rows a source. The table of
sources (a weight for each) is small by its nature.

Edge cases: a null or empty text has size 0 and gives nothing; a null source is a source of its own, ordered last;
sources without words get a target of 0; an empty table gives no rows; repeated rows are separate documents; further
columns of the input are ignored by `mix`, and returned unchanged by `mixed_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logsieve.llm.common import WORD, same, stored

SEED = "mix-1"
BLOCK_WORDS = 64
SHARDS = 8
MOST = 3


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", also: tuple[str, ...] = ()) -> DataFrame:
    words = F.coalesce(F.regexp_count(docs[text], F.lit(WORD)), F.lit(0)).cast("long")
    print_ = F.md5(F.coalesce(docs[text], F.lit("")).cast("binary"))
    return docs.select(docs[key].alias("doc_id"), docs[source].alias("source"), words.alias("size"), print_.alias("print"), *also)


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, weight): the weights in turn, by code point of the source, null last."""
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.array(*map(F.lit, weights))
    return sources.select("source", F.element_at(turn, (place % len(weights) + 1).cast("int")).alias("weight"))


def targets(totals: DataFrame, weights: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target): the words to take, at most `most` times those that there are.

    A source is capped if its cap is below its share of what the sources with a lower cap for their weight leave.
    """
    t, w = totals.alias("t"), weights.alias("w")
    rows = t.join(w, same(F.col("t.source"), F.col("w.source"))).select("t.source", "source_size", "weight")
    cap = most * F.col("source_size")
    order = [cap / F.col("weight"), F.col("source").asc_nulls_last()]
    every, before = W.partitionBy(), W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("level", F.try_divide(left.cast("double"), weight_left))
    free = F.col("level") * F.col("weight") < cap
    level = F.coalesce(F.max(F.when(free, F.col("level"))).over(every), F.lit(0.0))
    target = F.when(free, level * F.col("weight")).otherwise(cap.cast("double"))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def quotas(shares: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, most: int = MOST) -> DataFrame:
    """(source, source_size, target, block, dealt): dealt[h] is the number of blocks that shards 0..h get together.

    Blocks have at most 1/64 of the smallest target, so that rounding stays small for small sources as well. Only the
    quotients near a source's share are ranked: seats that are sure are counted, and each source adds a few.
    """
    every = W.partitionBy()
    free = F.col("target") < most * F.col("source_size")
    rows = (
        shares.withColumn("block", F.floor(F.min(F.when(F.col("target") > 0, F.col("target"))).over(every) / 64))
        .withColumn("block", F.greatest(F.lit(1), F.least(F.lit(block_words), F.coalesce("block", F.lit(1)))).cast("long"))
        .withColumn("all", F.sum("target").over(every))
        .withColumn("free", F.sum(F.when(free, F.col("target")).otherwise(0.0)).over(every))
        .withColumn("n", F.count(F.lit(1)).over(every))
        .withColumn("cap", F.floor(most * F.col("source_size") / F.col("block")))
        .withColumn("near", 2 + F.try_divide(2 * F.col("n") * F.col("target"), F.when(free, F.col("free")).otherwise(F.col("all"))))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .withColumn("seats", F.floor(F.floor(F.col("all") / F.col("block")) * (F.col("shard") + 1) / shards))
        .withColumn("share", F.coalesce(F.try_divide(F.col("seats") * F.col("target"), F.col("all")), F.lit(0.0)))
        .withColumn("near", F.coalesce("near", F.lit(2.0)))
        .withColumn("sure", F.least("cap", F.greatest(F.lit(0), F.floor(F.col("share") - F.col("near")))))
    )
    last = F.least(F.col("cap"), F.ceil(F.col("share") + F.col("near"))) - 1
    seats = F.when(last >= F.col("sure"), F.sequence("sure", last)).otherwise(F.array().cast("array<bigint>"))
    open_seats = rows.select("source", "shard", "seats", F.explode(seats).alias("k"), "target")
    sure = rows.groupBy("shard").agg(F.sum("sure").alias("given"))
    by_quotient = W.partitionBy("shard").orderBy(
        (F.col("target") / (2 * F.col("k") + 1)).desc(), F.col("source").asc_nulls_last(), "k"
    )
    won = (
        open_seats.withColumn("place", F.row_number().over(by_quotient))
        .join(sure, "shard")
        .where(F.col("place") <= F.col("seats") - F.col("given"))
        .groupBy("source", "shard")
        .agg(F.count(F.lit(1)).alias("won"))
    )
    r, v = rows.alias("r"), won.alias("v")
    total = F.col("sure") + F.coalesce("won", F.lit(0))
    dealt = r.join(v, same(F.col("r.source"), F.col("v.source")) & (F.col("r.shard") == F.col("v.shard")), "left").select(
        "r.source", "source_size", "target", "block", F.struct("r.shard", total.alias("blocks")).alias("s")
    )
    return (
        dealt.groupBy("source", "source_size", "target", "block")
        .agg(F.array_sort(F.collect_list("s")).alias("s"))
        .select("source", "source_size", "target", "block", F.col("s.blocks").alias("dealt"))
    )


#: Equal rows that are written out in one piece.
ALIKE = 100_000


def deck(docs: DataFrame, seed: str = SEED, also: tuple[str, ...] = ()) -> DataFrame:
    """Each document of (doc_id, source, size, print, *also) with `first`, the words before it in its source's seeded order."""
    place = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "print").cast("binary"))
    rows = docs.groupBy("doc_id", "source", "size", "print", *also).agg(F.count(F.lit(1)).alias("alike"))
    rows = rows.withColumn("place", place).withColumn("bucket", F.substring("place", 1, 3))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    words = F.col("size") * F.col("alike")
    buckets = (
        rows.groupBy("source", "bucket")
        .agg(F.sum(words).alias("words"))
        .select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    )
    inside = W.partitionBy("source", "bucket").orderBy("place", "doc_id", "size", *also).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum(words).over(inside))
    joined = rows.join(buckets, (F.col("bucket") == F.col("b")) & same(F.col("source"), F.col("s")))
    joined = joined.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("alike") - 1) / ALIKE))))
    last = F.least((F.col("part") + 1) * ALIKE, F.col("alike")) - 1
    joined = joined.withColumn("copy", F.explode(F.sequence(F.col("part") * ALIKE, last)))
    first = F.col("base") + F.col("upto") - words + F.col("copy") * F.col("size")
    return joined.select("doc_id", "source", "size", first.alias("first"), *also)


def _taken(dealt_words: Column) -> tuple[Column, Column]:
    """Whole rounds through the deck, and the words of the document in the last, partial round."""
    rounds = F.when(F.col("source_size") > 0, F.floor(dealt_words / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = dealt_words - rounds * F.col("source_size")
    return rounds, F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("first"))).cast("long")


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    seed: str = SEED,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    most: int = MOST,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    also: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, source, size, source_size, target, rounds, part, taken, shard, *also) of every document.

    `taken` = `rounds` * size + `part`: whole copies, and the first words of one more. `shard` is the first output
    shard that holds the document, null if none does. also: columns to carry, last in the deck's order. weights: (source, weight), by default 1, 2, 3 in turn.
    """
    rows = stored(sizes(docs, key, text, source, also), "sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = cyclic_weights(totals.select("source")) if weights is None else weights
    plan = quotas(targets(totals, weights, most), block_words, shards, most)
    d, p = deck(rows, seed, also).alias("d"), plan.alias("p")
    joined = d.join(p, same(F.col("d.source"), F.col("p.source"))).drop(F.col("p.source"))
    rounds, part = _taken(F.element_at("dealt", -1) * F.col("block"))
    joined = joined.withColumn("rounds", rounds).withColumn("part", part)
    joined = joined.withColumn("taken", F.col("rounds") * F.col("size") + F.col("part"))
    begins = F.size(F.filter("dealt", lambda n: n * F.col("block") <= F.col("first")))
    return joined.withColumn("shard", F.when(F.col("taken") > 0, begins)).select(
        "doc_id", "source", "size", "source_size", "target", "rounds", "part", "taken", "shard", *also
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of `docs`, a row for each copy; a partial copy holds the first words of the text."""
    marked = docs.withColumn("__row", F.xxhash64(*docs.columns))
    equal = W.partitionBy("__mark", "__id", "__source", "__size").orderBy(F.desc("__rounds"), F.desc("__part"))
    plan = (
        mix(marked, also=("__row",), **options)
        .where("taken > 0")
        .select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"),
                F.col("rounds").alias("__rounds"), F.col("part").alias("__part"), F.col("__row").alias("__mark"))
        .withColumn("__place", F.row_number().over(equal))
    )
    number = F.row_number().over(W.partitionBy("__row", "doc_id", "source").orderBy("__row"))
    d, p = marked.withColumn("__number", number).alias("d"), plan.alias("p")
    words = F.size(F.regexp_extract_all(F.col("d.text"), F.lit(WORD), F.lit(0)))
    copies = F.col("__rounds") + (F.col("__part") > 0).cast("long")
    first = F.array_join(F.slice(F.regexp_extract_all(F.col("d.text"), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), 1, F.greatest(F.lit(1), F.col("__part")).cast("int")), "")
    whole = (F.col("__copy") <= F.col("__rounds")) | (F.col("__part") == F.col("__size"))
    found = same(F.col("d.doc_id"), F.col("__id")) & same(F.col("d.source"), F.col("__source"))
    found &= (F.col("__row") == F.col("__mark")) & (F.col("__number") == F.col("__place"))
    rows = d.join(p, found & (F.coalesce(words, F.lit(0)) == F.col("__size")))
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies)))
    new = F.when(whole, F.col("d.text")).otherwise(first)
    fields = [F.col(f"d.{c}") for c in docs.columns]
    fields = [new.alias("text") if c == "text" else F.length(new).cast("long").alias(c) if c == "n_chars" else f for c, f in zip(docs.columns, fields, strict=True)]
    return rows.select(*fields)
