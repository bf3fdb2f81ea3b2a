import html.parser
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logsieve.llm import warc


class Plain(html.parser.HTMLParser):
    """The visible text by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in warc._SKIPPED
        self.out += ["\n"] if tag in warc._BLOCKS else []

    def handle_endtag(self, tag):
        self.skip -= tag in warc._SKIPPED
        self.out += ["\n"] if tag in warc._BLOCKS else []

    def handle_data(self, data):
        self.out += [] if self.skip else [data.replace("\n", " ")]


def plain(page):
    parser = Plain()
    parser.feed(page)
    parser.close()
    return warc._clean("".join(parser.out))


def test_text_agrees_with_the_parser_on_every_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for page in pages:
        assert warc.extract(page.html)["text"] == plain(page.html), page.page_id


@given(st.text(alphabet=st.sampled_from(list("<>!-/a\"'= &;p\n")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_any_markup_ends(page):
    warc.extract(page)
    warc.extract("<script>" + page + "<a href='" + page)


def test_long_broken_markup():
    for page in ("<a " * 100_000, "<script>" * 50_000, '<a b="' * 100_000, "<!--" * 100_000, "İ<style>x" * 1000):
        warc.extract(page)


ROWS = [(1, "http://a.example/x", '<html lang="de"><title>T &amp; t</title><p>Hi <a href="/y?a=1&amp;b">you</a></p><style>p{}</style>', 1),
        (2, None, None, 2), (None, "http://b.example/a b\r\nX: y", "", 3), (4, "", "plain \U0001f600 text\r\n\r\nWARC/1.1", 4), (4, "", "plain \U0001f600 text\r\n\r\nWARC/1.1", 4)]


def test_records_are_linked_and_read_back(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string, record int")
    sources = warc.responses(pages)
    path = str(tmp_path / "warc")
    warc.write(sources, path)
    back = warc.read(spark, path).collect()
    assert sorted(bytes(r.record) for r in back) == sorted(bytes(r.record) for r in sources.collect())
    made = warc.derive(sources)
    rows = made.collect()
    assert len(rows) == 2 * len(ROWS)
    of = {}
    for source in sources.collect():
        headers, block, _ = warc.unpack(bytes(source.record))
        assert headers["warc-block-digest"] == warc.digest(block)
        of[headers["warc-record-id"]] = headers
    meta = {r.record_id: r for r in rows if r.warc_type == "metadata"}
    for r in rows:
        headers, block, _ = warc.unpack(bytes(r.record))
        source = of[r.refers_to]
        assert headers["warc-refers-to"] == r.refers_to and r.source_digest == source["warc-payload-digest"]
        assert headers["warc-block-digest"] == r.block_digest == warc.digest(block)
        assert headers.get("warc-target-uri") == source.get("warc-target-uri")
        if r.warc_type == "conversion":
            assert meta[r.concurrent_to].refers_to == r.refers_to
        else:
            body = json.loads(block)
            assert body["source"] == source and body["intact"] and body["http"]["headers"]["content-type"].startswith("text/html")
    first = json.loads(warc.unpack(bytes(next(r.record for r in rows if r.key == 1 and r.warc_type == "metadata")))[1])
    assert first["html"] == {"title": "T & t", "lang": "de", "links": ["/y?a=1&b"]}
    text = next(warc.unpack(bytes(r.record))[1] for r in rows if r.key == 1 and r.warc_type == "conversion")
    assert text.decode() == "T & t\nHi you"
    again = str(tmp_path / "derived")
    warc.write(made, again)
    assert warc.read(spark, again).count() == len(rows)


def test_no_pages_and_damage(spark):
    assert warc.derive(warc.responses(spark.createDataFrame([], "page_id long, url string, html string"))).collect() == []
    record = warc.response(1, "u", "x" * 50)
    with pytest.raises(ValueError):
        warc.unpack(record[:-3])
    with pytest.raises(ValueError):
        warc.unpack(b"x" + record)
