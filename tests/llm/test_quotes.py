import hashlib
from collections import Counter

from logsieve.llm import queries, quotes


def test_levels_and_passages():
    body = "Ann wrote:\n> Bob wrote:\n>> Old  TEXT\n> > still old\n> new text\n>\n> more\n\nmy answer\nhere\n"
    assert quotes.passages(body) == [(2, "old text still old"), (1, "new text"), (1, "more"), (0, "my answer here")]
    assert quotes.unquoted(body) == "my answer\nhere"
    assert quotes.passages(None) == quotes.passages("") == quotes.passages(">\n> \n") == []
    assert quotes.unquoted("nobody wrote:\nthis") == "nobody wrote:\nthis"
    assert quotes.passages("> " * 5000 + "deep") == [(5000, "deep")]


def linked(spark, rows):
    frame = spark.createDataFrame([(s, k, o, b, "clash") for s, k, o, b in rows], "scope string, key string, ord long, body string, parent string")
    got = quotes.link(frame, key="key", order="ord", body="body", scope="scope").collect()
    return {r.key: (r.parent, r.root, r.depth, r.own) for r in got}


def test_link(spark):
    rows = [
        ("s", "a", 1, "first message"), ("s", "b", 2, "> first message\nanswer b"), ("s", "c", 3, ">> first message\n> answer b\nanswer c"),
        ("s", "d", 4, "> First   MESSAGE\n> and something nobody said\nanswer d"), ("s", "e", 5, ">> answer b\nonly the grandparent is known"),
        ("s", "f", 6, "first message"), ("s", "g", 7, "> first message\ng"), ("t", "h", 8, "> first message\nanother list"),
        ("s", "i", 0, "> first message\nbefore it was said"), ("s", "j", 9, None), ("s", "k", 10, ""), (None, "l", 1, "x"), (None, "m", 2, "> x\ny"),
        ("s", "b", 99, "a second row with the key"), ("s", "n", None, "> first message\nno order"),
    ]
    got = linked(spark, rows)
    assert len(got) == 14
    assert {k: v[0] for k, v in got.items() if v[0]} == {"b": "a", "c": "b", "e": "b", "g": "a", "m": "l"}
    assert got["c"] == ("b", "a", 2, "answer c") and got["e"][1:3] == ("a", 2) and got["j"] == (None, "j", 0, "")
    assert got["d"][0] is None, "a passage is linked as a whole"


def test_a_long_chain(spark):
    rows = [("s", "0", 0, "text 0")] + [("s", str(i), i, f"> text {i - 1}\ntext {i}") for i in range(1, 300)]
    got = linked(spark, rows)
    assert all(got[str(i)][1:3] == ("0", i) for i in range(300))


def test_mail(spark):
    turns = [(1, 0, "user", "hello\nthere"), (1, 1, "assistant", "hi"), (1, 2, None, "bye"), (2, 0, "user", None), (2, 1, "user", ""), (2, 2, "user", "x"), (None, 0, "u", "a"), (None, 1, "u", "b")]
    mail = quotes.as_mail(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    bodies = {(r.conv_id, r.turn): r.body for r in mail.collect()}
    assert bodies[1, 2] == "assistant wrote:\n> user wrote:\n>> hello\n>> there\n> hi\n\nbye"
    got = {r.key: (r.parent, r.root, r.depth) for r in quotes.link(mail, "message_id", "turn", "body", "conv_id").collect()}
    assert got == {"1:0": (None, "1:0", 0), "1:1": ("1:0", "1:0", 1), "1:2": ("1:1", "1:0", 2), "2:0": (None, "2:0", 0), "2:1": (None, "2:1", 0), "2:2": (None, "2:2", 0), "-:0": (None, "-:0", 0), "-:1": ("-:0", "-:0", 1)}


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quotes.link(quotes.as_mail(empty), "message_id", "turn", "body", "conv_id").collect() == []


def test_every_row_of_op10(spark, tmp_path):
    turns = [(1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (1, 1, "assistant", "hi"), (1, 1, "assistant", "other"), (1, 2, "user", "bye"), (5, None, "user", "no turn"), (5, None, None, None), (5, 0, "user", "no turn"), (5, 1, "user", "five")]
    turns += [(None, 0, "user", f"first {i}") for i in range(30)] + [(None, 1, "user", f"second {i}") for i in range(20)] + [(None, None, "u", "x")] * 3
    turns += [(6, 0, "user", "again")] * 25_000
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op10(spark, str(tmp_path)).collect()

    def rows(found):
        return Counter((c, n, hashlib.sha256((t or "").encode()).hexdigest()) for c, n, t in found)

    assert Counter((r.conv_id, r.turn, r.text_sha256) for r in got) == rows((c, n, t) for c, n, _, t in turns)
    links = {(r.conv_id, r.turn): (r.parent_turn, r.root_turn, r.depth) for r in got}
    assert links == {
        (1, 0): (None, 0, 0), (1, 1): (0, 0, 1), (1, 2): (1, 0, 2), (5, None): (None, None, 0), (5, 0): (None, 0, 0), (5, 1): (0, 0, 1),
        (None, 0): (None, 0, 0), (None, 1): (0, 0, 1), (None, None): (None, None, 0), (6, 0): (None, 0, 0),
    }
