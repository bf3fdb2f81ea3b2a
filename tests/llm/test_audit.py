import itertools
import random

import pytest

from logsieve.llm import audit

WORDS = " \t\n\x0b\x0c\r"


def brute(docs, labels):
    """{(part, order, step): figures} by walking every document through every order."""
    masks = []
    for key, source, text in docs:
        t = text or ""
        words = [w for w in "".join(" " if c in WORDS else c for c in t).split(" ") if w]
        fails = {f for f, test in (("A", len(words) < 200), ("B", 2 * len(set(words)) < len(words)),
                                   ("C", 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t)), ("D", any(c in "#$%&*|" for c in t)),
                                   ("E", key is not None and any(k is not None and k < key and (x or "") == t for k, _, x in docs))) if test}
        own = [(q, x) for k, q, x in labels if k is not None and k == key]
        masks.append((source or "", fails, any(q == 1 for q, _ in own), any(x == 1 for _, x in own)))
    out = {}
    for part in {m[0] for m in masks}:
        rows = [m for m in masks if m[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order):
                gone, kept = [m for m in left if f in m[1]], [m for m in left if f not in m[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step + 1] = [
                    len(kept), len(gone), sum(f in m[1] for m in rows) - len(gone), sum(m[1] == {f} for m in rows),
                    sum(m[2] for m in gone), sum(m[3] for m in gone)]
                left = kept
        for (p, order, step), figures in out.items():
            if p == part:
                figures.append(shapley[order[step - 1]])
    return out


def run(spark, docs, labels):
    frame = spark.createDataFrame([(s, k, t, "x", 1) for k, s, t in docs], "source string, doc_id long, text string, part string, mask int").repartition(3)
    marks = spark.createDataFrame([(k, q, x, "y") for k, q, x in labels], "doc_id long, quality int, toxic int, good string")
    rows = audit.audit(frame, marks).collect()
    out = {(r[0], r[1], r[2]): list(r[3:]) for r in rows}
    assert len(out) == len(rows)
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "a b", "#", "A B C", "one\x0btwo three", "Ärger " * 300, " ".join(f"w{i}" for i in range(199)),
             " ".join(f"w{i}" for i in range(200)), " ".join(f"w{i % 100}" for i in range(200)), " ".join(f"w{i % 99}" for i in range(200)),
             "x" * 98 + "AB", "x" * 97 + "ABC", " ".join(f"W{i}" for i in range(400)) + "|", "long " * 20_000]
    docs = [(rng.choice([None, *range(60)]), rng.choice([None, "", "web", "mail"]), rng.choice(texts)) for _ in range(300)]
    docs += [(1000 + i, "web", texts[9]) for i in range(200)] + [(None, "mail", texts[9])] * 50
    labels = [(rng.choice([None, *range(80), 1003, 1100]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(120)]
    return docs, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs, labels = corpus(seed)
    assert run(spark, docs, labels) == brute(docs, labels)


def test_no_rows(spark):
    assert run(spark, [], []) == {} and run(spark, [], [(1, 1, 1)]) == {}
    one = run(spark, [(5, None, None)], [])
    assert len(one) == 600 and one["", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120] and one["", "BACDE", 1] == [1, 0, 0, 0, 0, 0, 0]
