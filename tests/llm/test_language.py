import math

import numpy as np
from pyspark.sql import functions as F

from logsieve.llm import language
from logsieve.llm.common import table

DATA = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = table(spark, DATA, "documents")
    model = language.fit(docs, sample=40)
    assert model.languages == ["de", "en", "es", "fr", "und"]
    seen = docs.withColumn("n", F.expr("row_number() over (partition by lang order by xxhash64(doc_id), text)")).where("n > 40")
    found = language.identify(language.of_documents(seen).withColumn("declared", F.lit(None).cast("string")), model)
    both = found.alias("f").join(seen.alias("s"), "doc_id").where("n_chars >= 20").select("f.lang", F.col("s.lang").alias("want"), "kept").collect()
    assert len(both) > 700 and sum(r.lang == r.want for r in both) / len(both) > 0.98
    assert sum(not r.kept for r in both) / len(both) < 0.005


def test_pages(spark):
    pages = table(spark, DATA, "pages")
    found = language.identify(language.of_pages(pages), language.fit(table(spark, DATA, "documents")))
    want = pages.select("page_id", F.regexp_extract("url", "/(en|de|fr|es)/", 1).alias("want"))
    rows = found.join(want, "page_id").collect()
    assert len(rows) == pages.count() and sum(r.lang == r.want for r in rows) / len(rows) > 0.98


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "id long, text string, kind string, declared string, suffix string, domain string, host string, scores string")


ROWS = [(1, "the cat and the dog", "p", "en", "uk", "a.uk", "x.a.uk", ""), (2, "der hund und die katze", "p", "en", "de", "b.de", "b.de", ""),
        (3, None, "p", None, None, None, None, ""), (4, "", "p", "en", "uk", "a.uk", "x.a.uk", ""), (5, "1234 !!", "p", "en", None, None, None, ""),
        (6, "zqxj vkwq xzzq qjxv " * 30, "p", "en", "uk", "a.uk", "x.a.uk", ""), (7, "in", "p", "de", "de", "b.de", "b.de", ""),
        (8, "the dog " * 20_000, "p", None, "uk", "a.uk", "y.a.uk", ""), (1, "the cat and the dog", "p", "en", "uk", "a.uk", "x.a.uk", "")]


def model():
    return language.Model([("en", "the dog and the cat in the house with the other things of that day " * 20), ("de", "der hund und die katze in dem haus mit den anderen dingen an diesem tag " * 20)])


def brute(rows, m):
    """The posterior by plain loops."""
    n = len(m.languages)
    scored = [(r, *m.score(r[1])) for r in rows]
    first = [int(np.argmax(s)) if g else None for _, g, s in scored]
    clean = [tuple(x or "" for x in (r[2], r[4], r[5], r[6], r[3])) for r in rows]
    out = []
    for (r, grams, scores), levels in zip(scored, clean, strict=True):
        if not grams:
            out.append((r[0], "und", 0.0))
            continue
        prior = [1 / n] * n
        for depth in range(1, 5):
            same = [f for f, c in zip(first, clean, strict=True) if c[:depth] == levels[:depth] and f is not None]
            prior = [(same.count(i) + language.PRIOR * prior[i]) / (len(same) + language.PRIOR) for i in range(n)]
        kind = [(f, c[4]) for f, c in zip(first, clean, strict=True) if c[0] == levels[0]]
        declared = {c[4] for c in clean if c[0] == levels[0]}
        total = []
        for i in range(n):
            held = sum(f == i and d == levels[4] for f, d in kind)
            every = sum(f == i for f, _ in kind)
            total.append(scores[i] + math.log(prior[i]) + math.log((held + language.TRUST / len(declared)) / (every + language.TRUST)))
        best = int(np.argmax(total))
        out.append((r[0], m.languages[best], 1 / sum(math.exp(t - total[best]) for t in total)))
    return sorted(out)


def test_fusion_agrees_with_plain_loops(spark):
    m = model()
    got = language.identify(rows_of(spark, ROWS).repartition(3), m).collect()
    want = brute(ROWS, m)
    assert sorted((r.id, r.lang) for r in got) == [w[:2] for w in want]
    assert all(math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-9) for a, b in zip([c for _, _, c in sorted((r.id, r.lang, r.confidence) for r in got)], [c for *_, c in want], strict=True))
    of = {r.id: r for r in got}
    assert of[1].lang == of[8].lang == "en" and of[2].lang == "de" and of[6].lang == "und"
    assert not any(of[i].kept for i in (3, 4, 5, 6)) and of[1].kept and of[2].kept


def test_kept_documents(spark):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate([r[1] for r in ROWS])]
    train = [(100 + i, "the dog and the cat in the house with the other things", "en", "s", 50) for i in range(9)]
    docs = spark.createDataFrame(rows + train, "doc_id long, text string, lang string, source string, n_chars int")
    kept = language.kept_documents(docs)
    assert kept.columns == docs.columns
    found = {r.doc_id for r in kept.collect()}
    assert {0, 8} | set(range(100, 109)) <= found and not found & {2, 3, 4}


def test_no_rows(spark):
    none = rows_of(spark, [])
    assert language.identify(none, model()).collect() == []
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert language.kept_documents(docs).collect() == []
    unlabelled = spark.createDataFrame([(1, "some text", None, None)], "doc_id long, text string, lang string, source string")
    assert language.identify(language.of_documents(unlabelled), language.fit(unlabelled)).first().lang == "und"


def test_markup_leaves_no_code(spark):
    attributes = " ".join(f'data-a{i}="{i}"' for i in range(100))
    html = f'<html {attributes} lang="de"><style>a > b {{}} </style ><SCRIPT type="x">var t="</p>";track(0); if (a<b) x();</Script>'
    html += "<p>one</p><!-- a > b <p>hidden</p> --><scripture>two</scripture><script>never(closed);</p>"
    pages = spark.createDataFrame([(1, "http://a.de/", html)], "page_id long, url string, html string")
    row = language.of_pages(pages).first()
    assert row.declared == "de" and row.text.split() == ["one", "two"]
