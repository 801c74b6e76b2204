"""Archives by round trip and against hand-made files; page text by held-out accuracy and fixed pages."""

import gzip
from hashlib import sha256
from time import process_time

import pytest
from pyspark.sql import functions as F

from carelens.llm import block_labeller, html_blocks, warc
from carelens.session import scratch_path


def test_chunks():
    for payload in (b"", b"x", bytes(range(256)) * 100, b"\r\n\r\n" * 9):
        assert warc.from_chunks(warc.to_chunks(payload, 7)) == payload
    assert warc.from_chunks(b"3;name=x\r\nabc\r\n0\r\nTrailer: y\r\n\r\n") == b"abc"
    for broken in (b"", b"5\r\nabc", b"3\r\nabcd\r\n0\r\n\r\n", b"zz\r\n", b"-1\r\n\r\n"):
        assert warc.from_chunks(broken) is None


def expected_rows(rows):
    pages = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, payload in pages:
        same = [j for j, p in pages if p == payload and j is not None]
        first = min(same, default=None)
        again = len(payload) >= 100 and len([1 for _, p in pages if p == payload]) > 1 and first is not None and i != first
        out.append((i, len(payload), sha256(payload).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment", [80, 1 << 14])
def test_round_trip(spark, segment):
    page = "<p>é WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n日本" * 20
    rows = [
        (5, "http://a/x y\r\nX: 1", page), (3, "http://b", page), (9, None, page), (None, "http://c", page), (1, "u", None), (2, "u", ""), (4, "u", "x" * 99),
        (6, "u", "x" * 99), (7, "u", "y" * 100), (8, "u", "y" * 100), (8, "u", "y" * 100), (10, "u", "z" * 5000), (10, "u", "z" * 5000), (None, "n", "q" * 300), (None, "n", "q" * 300),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("payload", F.lit("p"))
    got = warc.round_trip(df, segment_bytes=segment, file_records=3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected_rows(rows)
    assert warc.round_trip(df.limit(0)).collect() == []


def record(kind, name, block, **fields):
    lines = [f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{name}>\r\nContent-Length: {len(block)}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in fields.items()]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nContent-Length: 6\r\n\r\nabcdef"
    cut = [http[:10], http[10:25], http[25:]]
    segments = [
        record("response", "s1", cut[0], WARC_Segment_Number=1),
        record("continuation", "s2", cut[1], WARC_Segment_Origin_ID="<s1>", WARC_Segment_Number=2),
        record("continuation", "s3", cut[2], WARC_Segment_Origin_ID="<s1>", WARC_Segment_Number=3, WARC_Segment_Total_Length=len(http)),
    ]
    gap = [
        record("response", "g1", cut[0], WARC_Segment_Number=1),
        record("continuation", "g3", cut[2], WARC_Segment_Origin_ID="<g1>", WARC_Segment_Number=3, WARC_Segment_Total_Length=len(http)),
    ]
    short = [
        record("response", "h1", cut[0], WARC_Segment_Number=1),
        record("continuation", "h2", cut[1], WARC_Segment_Origin_ID="<h1>", WARC_Segment_Number=2, WARC_Segment_Total_Length=len(http)),
    ]
    lost = [record("continuation", "l2", cut[1], WARC_Segment_Origin_ID="<l1>", WARC_Segment_Number=2)]
    plain = record("response", "p", b"HTTP/1.1 200 OK\r\n\r\nWARC/1.0 \r\n\r\n body")
    info = record("warcinfo", "i", b"software: x")
    (tmp_path / "one.warc").write_bytes(info + segments[2] + gap[0] + plain + lost[0])
    (tmp_path / "two.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in [segments[0], segments[1], gap[1], *short]))
    (tmp_path / "three.warc").write_bytes(plain[: len(plain) - 20])
    got = {(r.record_id, r.whole): None if r.payload is None else bytes(r.payload) for r in warc.read(spark, str(tmp_path)).collect()}
    assert got == {
        ("<s1>", True): b"abcdef", ("<g1>", False): None, ("<h1>", False): None, ("<p>", True): b"WARC/1.0 \r\n\r\n body", ("<p>", False): None,
    }


def test_segments_carry_the_format_s_fields(spark):
    path = scratch_path(spark, "warc")
    pages = spark.createDataFrame([(1, "u", "w" * 1000)], "page_id long, url string, html string")
    warc.write(pages.select("page_id", "url", F.col("html").cast("binary").alias("payload")), path, segment_bytes=300)
    rows = sorted(warc.read_records(spark, path).collect(), key=lambda r: r.segment)
    assert [r.segment for r in rows] == list(range(1, len(rows) + 1)) and len(rows) > 3
    assert [r.kind for r in rows] == ["response"] + ["continuation"] * (len(rows) - 1)
    assert {r.origin for r in rows[1:]} == {rows[0].record_id} and rows[-1].total == sum(len(r.block) for r in rows)


# page text


def texts(html):
    return [b.text for b in html_blocks.blocks(html)]


def test_blocks():
    assert texts("") == [] and texts("plain &amp; text < 3 <") == ["plain & text < 3 <"]
    assert texts("<p>a <b>b</b>\n c<br>d<p>e<script>if (a</b) '</p>'</script>f<!-- <p>x --></div>g") == ["a b c d", "efg"]
    assert texts('<ul><li>x<li>y<a title="a>b" href=z>link</a></ul><table><tr><td>1<td>2</table>') == ["x", "ylink", "1", "2"]
    assert texts("<title>t</title><style>s</style><textarea>x</textarea>&#233;&nbsp;&lt;p&gt;") == ["é <p>"]
    assert texts("a</div>b</p>c</span>d") == ["abcd"]
    assert texts("<p>" * 3000 + "deep") == ["deep"] and texts("<div>" * 2000 + "deep") == ["deep"]
    block = html_blocks.blocks('<div class="mainContent side-bar" id=x><a href=q>in</a> out</div>')[0]
    assert block.path == (("div", "main", "content", "side", "bar", "x"),) and block.linked == 2


def test_held_out_blocks():
    blocks_right, _ = block_labeller.held_out(block_labeller.trained(), pages=150, seed=99)
    assert blocks_right > 0.99


def test_gradients():
    import numpy as np
    from random import Random

    rng = Random(1)
    w = block_labeller.train(pages=4, rounds=1)
    w = {k: v.astype(np.float64) for k, v in w.items()}
    html, label = block_labeller.made_page(rng)
    page = html_blocks.blocks(html)
    group = [(page, np.array(label, np.float32)), (page[:3], np.array(label[:3], np.float32))]
    slopes = block_labeller._slopes(w, group)

    def loss():
        labeller = block_labeller.Labeller(w)
        p = np.concatenate(labeller.scores([p for p, _ in group]))
        t = np.concatenate([y for _, y in group])
        return -(t * np.log(p) + (1 - t) * np.log(1 - p)).mean()

    for name in ("wx0", "wh1", "b0", "out1", "bias"):
        flat = w[name].reshape(-1)
        at = int(np.argmax(np.abs(slopes[name].reshape(-1))))
        before, step = flat[at], 1e-2
        flat[at] = before + step
        up = loss()
        flat[at] = before - step
        down = loss()
        flat[at] = before
        assert abs((up - down) / (2 * step) - slopes[name].reshape(-1)[at]) < 0.05 * abs(slopes[name].reshape(-1)[at]) + 1e-4


PAGE = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/a>A</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site.</p></div><article><h1>The head &amp; line</h1><p>First  paragraph,
with a break.<p><b>Second.</b></p><div class="ad">Buy this now.</div><ul><li>One point.</li></ul></article>
<aside class="sidebar"><p>Related things to read.</p></aside><form><label>Name</label><button>Send</button></form>
<section class="comments"><h2>Comments</h2><p>I liked this a lot.</p></section><footer>&copy; Site</footer></body></html>"""


def test_main_text(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>" + "long words here. " * 20_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(1))
    got = block_labeller.main_text(df).collect()
    main = "The head & line\nFirst paragraph, with a break.\nSecond.\nOne point."
    assert sorted(((r.page_id or 0, r.text[:70], r.n_chars) for r in got if r.page_id != 3)) == [(0, "", 0), (1, main, len(main)), (1, main, len(main)), (2, "", 0)]
    assert block_labeller.main_text(df.limit(0)).collect() == []


def test_embedded_elements_are_on_the_path():
    for tag in ("object", "video", "audio", "canvas", "svg", "template", "math"):
        for end in (f"</{tag}>", ""):  # closed and left open
            html = f"<div><article><p>before</p><{tag} id=x><p>inside</p>{end}<p>behind</p></article></div><p>last</p>"
            got = {b.text: [e[0] for e in b.path] for b in html_blocks.blocks(html)}
            assert list(got) == ["before", "inside", "behind", "last"]
            assert got["before"] == ["div", "article", "p"] and got["last"] == ["p"]
            assert tag == "math" or got["inside"] == ["div", "article", tag, "p"]
            assert not end or got["behind"] == ["div", "article", "p"]
    got = html_blocks.blocks('<p>If <math><mi>x</mi><mo/>=<mn>1</mn></math> holds <svg><path d="m"/><title>Icon</title></svg> then<video/> <a>so <canvas>old</canvas> on</a></p>')
    assert [(b.text, [e[0] for e in b.path][:2], b.linked) for b in got] == [
        ("If x=1 holds", ["p"], 0), ("Icon", ["p", "svg"], 0), ("then so", ["p", "a"], 3), ("old", ["p", "a"], 3), ("on", ["p"], 3)
    ]
    assert [b.text for b in html_blocks.blocks("<p>a <svg><path d='m'/></svg> b</p><script>x<p>y</script><xmp><p>z</xmp><p>c")] == ["a b", "c"]


SHAPES = ["<a", "<a '\"", "<p x= ", '<b ">" ', "<", '<a ">', "<div>x", "<!-", "<script></script", "<svg>x<i>", "<!--", "</p", "<li><b>", "&amp;<", "<textarea></textarea "]


@pytest.mark.parametrize("unit", SHAPES)
def test_hostile_pages_take_linear_time(unit):
    html = unit * (1_000_000 // len(unit))
    for page in (html, html + ">", ">" + html, "<b><div>" + html + "</b>" * 9):
        begin = process_time()
        html_blocks.blocks(page)
        assert process_time() - begin < 20  # a quadratic scan takes an hour


def test_end_tags_of_elements_outside_the_block_are_passed_over_at_once():
    begin = process_time()
    found = html_blocks.blocks("<b><div>" + "<i>" * 100_000 + "</b>" * 100_000 + "text")
    assert process_time() - begin < 20 and [b.text for b in found] == ["text"]


def test_quotes_and_tags():
    page = """<p title="a > b">one</p><p title='x>two</p><a href="q>three</a> < four <!x> five </ > six"""
    assert [b.text for b in html_blocks.blocks(page)] == ["one", "two", "three < four five six"]
    assert html_blocks.blocks("<xmp>a <b>&amp;</b>\n c</XMP ><p>d")[0] == ((("xmp",),), "a <b>&amp;</b> c", 0)
    assert [b.text for b in html_blocks.blocks("x<xmp>open <p>y")] == ["x", "open <p>y"]
