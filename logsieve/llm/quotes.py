"""Quotation linking: replies find the messages that they quote, and conversations get their order back.

The lines of a message have a level: the number of ">" before them. Neighbouring lines of one level, up to a blank line,
are a passage. A passage's words in lower case, joined by single spaces, are hashed. Level 0 is what the message says
itself; quoted passages are joined to the first message of the same scope (a list, a channel) that says the passage.
A message's parent is the one that has most of the quoted words of its lowest linked level. Parents of parents are
found by doubling, so that a chain of a thousand replies takes ten rounds; root, depth and the messages' own order
give the conversation.

Scale: passages, not texts, are shuffled. The first message that says a passage is a grouped minimum, so a passage in a
third of all messages is summed up before it moves, and a quote meets one row, never all messages that say it.

Edge cases: null and empty bodies have no passages and are roots; lines that introduce a quote ("... wrote:") belong
to no passage; a message links only to a message before it; a quote that nobody says stays unlinked; of rows that
repeat a key the first in order counts and `copies` is their number; a message without an order links to none and none
to it; an empty table gives no rows; further columns are ignored. `as_mail` gives equal turns one `row_id`, all others
their own, so that `each_copy` can give every turn its row again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.llm.common import same, stored

_MARKS = re.compile(r"(?:[ \t]*>)+[ \t]?")
_INTRODUCTION = re.compile(r"[^\n]{0,500}\b(?:wrote|schrieb|a écrit|escribió) ?:[ \t]*")


def levels(body: str | None) -> list[tuple[int, str]]:
    """(level, line without its marks) of every line."""
    out = []
    for line in (body or "").split("\n"):
        marks = _MARKS.match(line)
        out.append((marks.group().count(">"), line[marks.end() :]) if marks else (0, line))
    return out


def passages(body: str | None) -> list[tuple[int, str]]:
    """(level, normalised text) of every passage that has words."""
    out, level, words = [], None, []
    lines = levels(body)
    for i, (at, line) in enumerate([*lines, (-1, "")]):
        introduces = _INTRODUCTION.fullmatch(line) and i + 1 < len(lines) and lines[i + 1][0] > at
        if at != level or not line.strip() or introduces:
            if words:
                out.append((level, " ".join(words)))
            level, words = at, []
        if not introduces:
            words += line.lower().split()
    return out


def unquoted(body: str | None) -> str:
    """What the message says itself: its lines of level 0, without introductions, trimmed."""
    lines = levels(body)
    kept = [
        line
        for i, (at, line) in enumerate(lines)
        if at == 0 and not (_INTRODUCTION.fullmatch(line) and i + 1 < len(lines) and lines[i + 1][0] > 0)
    ]
    return "\n".join(kept).strip()


def _parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.string()), ("words", pa.int32())]))
    for batch in batches:
        found, own = [], []
        for body in batch.column("_body").to_pylist():
            own.append(unquoted(body))
            found.append([{"level": at, "hash": hashlib.sha256(p.encode()).hexdigest()[:32], "words": p.count(" ") + 1} for at, p in passages(body)])
        kept = ["scope", "key", "ord", "copies"]
        columns = [*map(batch.column, kept), pa.array(own, pa.string()), pa.array(found, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=[*kept, "own", "passages"])


def link(messages: DataFrame, key: str, order: str, body: str, scope: str) -> DataFrame:
    """(scope, key, ord, copies, own, n_quoted, parent, root, depth) of each key.

    copies: the rows with the key; own: the text without quotes; parent, root: keys; depth: 0 for a root. By (root,
    depth, ord) conversations are in the order of replies.
    """
    rows = messages.select(messages[scope].alias("scope"), messages[key].alias("key"), messages[order].alias("ord"), messages[body].alias("_body"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    out = f"scope {kinds['scope']}, key {kinds['key']}, ord {kinds['ord']}, copies long, own string, passages array<struct<level:int,hash:string,words:int>>"
    once = rows.groupBy("key").agg(F.min(F.struct("ord", "scope", "_body")).alias("m"), F.count(F.lit(1)).alias("copies")).select("key", "copies", "m.*")
    parsed = stored(once.select("scope", "key", "ord", "copies", "_body").mapInArrow(_parse, out), "messages")
    said = parsed.select("scope", "key", "ord", F.explode("passages").alias("p")).select("scope", "key", "ord", "p.*")
    first = said.where("level = 0 AND ord IS NOT NULL").groupBy("scope", "hash").agg(F.min(F.struct("ord", "key")).alias("first"))
    q, f = said.where("level > 0").alias("q"), first.alias("f")
    found = q.join(f, (F.col("q.hash") == F.col("f.hash")) & same(F.col("q.scope"), F.col("f.scope")))
    found = found.where(F.coalesce(F.col("first.ord") < F.col("q.ord"), F.lit(False)))
    votes = found.groupBy("q.key", "level", "first").agg(F.sum("words").alias("words"))
    parents = votes.groupBy("key").agg(F.max(F.struct((-F.col("level")).alias("near"), "words", "first")).alias("v"))
    nodes = stored(parsed.join(parents.select("key", F.col("v.first.key").alias("parent")), "key", "left"), "nodes")
    return nodes.join(_roots(nodes), ["key"], "left").select(
        "scope", "key", "ord", "copies", "own", F.size(F.filter("passages", lambda x: x["level"] > 0)).alias("n_quoted"), "parent",
        F.coalesce("root", "key").alias("root"), F.coalesce("depth", F.lit(0)).alias("depth"),
    )


def _roots(nodes: DataFrame) -> DataFrame:
    """(key, root, depth) of the messages that have a parent; each round doubles the steps of those not yet there."""
    active = stored(nodes.where("parent IS NOT NULL").select("key", F.col("parent").alias("at"), F.lit(1).alias("steps")), "jumps")
    settled = None
    while True:
        ahead = active.select(F.col("key").alias("at"), F.col("at").alias("next"), F.col("steps").alias("more"), F.lit(False).alias("there"))
        if settled is not None:
            ahead = ahead.unionByName(settled.select(F.col("key").alias("at"), F.col("root").alias("next"), F.col("depth").alias("more"), F.lit(True).alias("there")))
        moved = active.join(ahead, "at", "left").select(
            "key", F.coalesce("next", "at").alias("at"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.coalesce("there", F.lit(True)).alias("there"),
        )
        moved = stored(moved, "jumps")
        new = moved.where("there").select("key", F.col("at").alias("root"), F.col("steps").alias("depth"))
        settled = new if settled is None else stored(settled.unionByName(new), "roots")
        active = moved.where("NOT there").drop("there")
        if active.isEmpty():
            return settled


def each_copy(linked: DataFrame) -> DataFrame:
    """`linked` without `copies`, a row as often as it says; numbered in blocks, so that no list is long."""
    block = 10_000
    begins = linked.withColumn("__from", F.explode(F.sequence(F.lit(1).cast("long"), "copies", F.lit(block).cast("long"))))
    last = F.least(F.col("copies"), F.col("__from") + (block - 1))
    return begins.withColumn("__copy", F.explode(F.sequence("__from", last))).drop("__from", "__copy", "copies")


def turn_of(row_id: Column) -> Column:
    """The turn in a `row_id`; null where the row has none."""
    return F.element_at(F.split(row_id, ":"), -2).try_cast("long")


def as_mail(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, message_id, row_id, body): each turn as a reply that quotes the turn before and the one before that.

    message_id: conversation and turn; row_id: these and a hash of role and text, equal only for rows that are equal.
    """
    fields = [F.col(c) for c in ("conv_id", "turn", "role", "text")]
    own = turns.select(*fields)
    firsts = own.groupBy("conv_id", "turn").agg(F.min(F.struct("text", "role")).alias("m")).select("conv_id", "turn", "m.*")
    for back in (1, 2):
        earlier = firsts.select(F.col("conv_id").alias("_c"), (F.col("turn") + back).alias("_t"), F.col("text").alias(f"text{back}"), F.col("role").alias(f"role{back}"))
        own = own.join(earlier, same(F.col("conv_id"), F.col("_c")) & (F.col("turn") == F.col("_t")), "left").drop("_c", "_t")

    def quoted(text: str, mark: str):
        return F.concat(F.lit(mark), F.replace(F.col(text), F.lit("\n"), F.lit("\n" + mark)))

    body = F.concat_ws(
        "\n",
        F.when(F.col("text1") != "", F.concat(F.coalesce("role1", F.lit("someone")), F.lit(" wrote:"))),
        F.when((F.col("text1") != "") & (F.col("text2") != ""), F.concat(F.lit("> "), F.coalesce("role2", F.lit("someone")), F.lit(" wrote:"))),
        F.when((F.col("text1") != "") & (F.col("text2") != ""), quoted("text2", ">> ")),
        F.when(F.col("text1") != "", quoted("text1", "> ")),
        F.lit(""),
        F.col("text"),
    )
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.coalesce(F.col("turn").cast("string"), F.lit("-")))
    content = F.md5(F.concat_ws("|", *[F.coalesce(F.sha2(F.col(c).cast("binary"), 256), F.lit("-")) for c in ("role", "text")]).cast("binary"))
    kind = F.concat(F.when(F.col("conv_id").isNull(), "n").otherwise("c"), content)
    return own.select("conv_id", "turn", "role", key.alias("message_id"), F.concat_ws(":", key, kind).alias("row_id"), body.alias("body"))
