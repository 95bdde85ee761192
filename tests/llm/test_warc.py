import hashlib
from html.parser import HTMLParser

from skein.llm import warc

PAGES = [
    (1, "http://a.example/x y\r\nZ", "<!DOCTYPE html><html lang=\"EN\"><head><meta charset=\"UTF-8\"><title>A &amp;amp; B</title>"
        "<script>var t='</p>';</script></head><body><!-- no --><p>one <b>two</b>&nbsp; three</p><p>&#233;&#x1F600;&nope;&lt;b&gt;"
        "<a href=\"/q\">link</a></body></html>"),
    (2, None, None), (None, "u", ""), (3, "u", "<style>x"), (3, "u", "<style>x"), (4, "u", "plain &#0; &#xD800; text"),
    (5, "u", "<p>" + "long é " * 40_000),
]


def records(spark):
    df = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, block string, key int")
    return warc.derivatives(warc.responses_of(df))


def test_linked_records(spark):
    rows = records(spark).collect()
    assert len(rows) == 2 * len(PAGES)
    meta = {r.key: r for r in rows if r.record_type == "metadata"}
    conv = {r.key: r for r in rows if r.record_type == "conversion"}
    one = conv[1].block
    assert one == "A &amp; B\none two three\né😀&nope;<b>link"
    assert conv[2].block == conv[None].block == conv[3].block == ""
    assert conv[4].block == "plain � � text"
    assert conv[5].block == ("long é " * 40_000).strip()
    assert meta[1].refers_to == conv[1].refers_to and conv[1].record_id in meta[1].block
    assert "source-header: Content-Type: text/html; charset=utf-8" in meta[1].block and "title: A &amp; B\r\n" in meta[1].block
    assert "language: en" in meta[1].block and "links: 1\r\n" in meta[1].block
    for r in rows:
        raw = r.block.encode()
        assert r.content_length == len(raw) and r.block_digest == "sha256:" + hashlib.sha256(raw).hexdigest()
        assert f"WARC-Refers-To: {r.refers_to}" in r.header and r.header.count("\r\n") == (7 if r.target_uri is None else 8)
    assert "WARC-Target-URI: http://a.example/x%20y%0D%0AZ\r\n" in conv[1].header
    assert len({r.record_id for r in rows}) == 2 * (len(PAGES) - 1)   # the repeated row repeats its records


def test_text_against_an_html_parser(spark):
    class Words(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.off = [], 0

        def handle_starttag(self, tag, attrs):
            self.off += tag in ("script", "style")

        def handle_endtag(self, tag):
            self.off -= tag in ("script", "style")

        def handle_data(self, data):
            if not self.off:
                self.out.append(data)

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = warc.with_plain_text(pages, "html", "text", "title").select("html", "text").collect()
    for r in rows:
        p = Words()
        p.feed(r.html)
        assert "".join(r.text.split()) == "".join("".join(p.out).split())


def test_files_and_parsing(spark, scratch):
    out = records(spark).filter("key <= 4")
    warc.write_records(out, scratch + "/w")
    import glob
    data = b"".join(open(f, "rb").read() for f in sorted(glob.glob(scratch + "/w/part-*")))
    n = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        size = int(head.rsplit(b"Content-Length: ", 1)[1])
        assert head.startswith(b"WARC/1.1\r\n") and rest[size:size + 4] == b"\r\n\r\n"
        data, n = rest[size + 4:], n + 1
    assert n == out.count()
    raw = spark.createDataFrame([(
        "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://x/\r\nWARC-Date: 2020-01-01T00:00:00Z"
        "\r\n\r\nHTTP/1.1 200 OK\r\nServer: s\r\n\r\n<p>hi</p>\r\n\r\nrest",), ("WARC/1.1\r\nWARC-Type: request\r\n\r\nGET /",), (None,)],
        "record string")
    rows = warc.derivatives(warc.parse_responses(raw)).collect()
    assert len(rows) == 2 and {r.refers_to for r in rows} == {"<urn:uuid:1>"}
    assert any("source-header: Server: s" in r.block for r in rows) and any(r.block == "hi\nrest" for r in rows)


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.derivatives(warc.responses_of(df)).collect() == []
