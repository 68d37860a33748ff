"""Operators 5 and 10."""

import base64
import gzip
import hashlib
import io

import pytest

from bourse.llm import html_extract, warc

PAGES = "page_id long, url string, html string"


def pages(spark):
    long = "<p>" + "long " * 60000 + "</p>"
    rows = [(1, "http://a/1", "<p>same</p>"), (2, "http://b/2", "<p>same</p>"), (3, None, "<p>é 漢</p>"), (4, "http://x\r\ny", None), (5, "u", ""),
            (6, "u", "<p>same</p>"), (7, "u", long), (8, "u", "\r\n\r\nWARC/1.1\r\n"), (9, "u", "once")]
    return rows, spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS path", "1 AS records")


def test_round_trip_of_all_pages(spark, tmp_path):
    rows, table = pages(spark)
    manifest = warc.write_warc(table, f"file://{tmp_path}/w", archive_bytes=1000)
    records = {r.record_id: r for r in warc.read_warc(spark, manifest).collect()}
    last = {}
    for p, _, h in rows:
        last[h or ""] = max(last.get(h or "", 0), p)
    for p, _, h in rows:
        data, r = (h or "").encode(), records[f"<urn:x-page:{p}>"]
        first = last[h or ""] == p
        assert r.record_type == ("response" if first else "revisit")
        assert r.refers_to == (None if first else f"<urn:x-page:{last[h or '']}>")
        assert r.payload_bytes == len(data) and r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert bytes(r.payload) == (data if first else b"")
    # every archive is a plain gzip file of members
    for f in (tmp_path / "w").glob("*.gz"):
        assert gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\n")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.round_trip(table, f"file://{tmp_path}/v").collect()}
    assert got[1] == ("revisit", 6) and got[6] == ("response", None) and len(got) == len(rows)
    small = {r.page_id: r.record_type for r in warc.round_trip(table, f"file://{tmp_path}/s", min_bytes=1000).collect()}
    assert set(small.values()) == {"response"}


def test_reader_finds_damage():
    whole = gzip.compress(warc.record(1, "u", b"payload"))
    assert [o for o, _ in warc.members(io.BytesIO(whole + whole))] == [0, len(whole)]
    with pytest.raises(warc.WarcError, match="cut off"):
        list(warc.members(io.BytesIO(whole[:-3])))
    with pytest.raises(warc.WarcError):
        list(warc.members(io.BytesIO(whole + b"trailing")))
    good = warc.record(1, "u", b"payload")
    assert warc.parse_record(good)["payload"] == b"payload"
    for bad in (good.replace(b"payload", b"paymoad"), good[:-1], good + b"x", b"no record", good.replace(b"Content-Length: 9", b"Content-Length: x")):
        if bad != good:
            with pytest.raises(warc.WarcError):
                warc.parse_record(bad)


def test_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], PAGES)
    assert warc.round_trip(none, f"file://{tmp_path}/e").collect() == []
    assert html_extract.main_text(none).collect() == []


CASES = [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain", "plain"), ("<p>a<script>x</script>b</p>", "ab"),
    ("<article><h1>T &amp; U</h1><p>one\n  two<br>three<p>four&nbsp;five</article><footer>f</footer>", "T & U\n\none two three\n\nfour five"),
    ("<nav><ul><li><a href=a>menu</a></ul></nav><div class=ad>buy, buy, buy, now, it, is, good</div><article><p>short.</p></article>", "short."),
    ("<body><header><h1>Site</h1></header><div id=content><h2>T</h2><p>First, a long enough paragraph, with commas, of the article.</p>"
     "<div class='share'>Share</div><ul><li>one</li><li>two</ul><p>x</p></div><aside>side</aside>"
     "<div id=comments><p>A reader, who writes a lot, with commas, many, many, of them, and more words than the article has.</p></div>"
     "<form><p>Your name</p></form></body>",
     "T\n\nFirst, a long enough paragraph, with commas, of the article.\n\none\n\ntwo\n\nx"),
    ("<div class=cookie-notice><p>We use cookies, and like them, because they are good, and tasty, and sweet.</p></div>"
     "<main><div class='post-content has-sidebar'><p>The text, of the page.</p></div></main>", "The text, of the page."),
    ("<article><p>text <!-- <p>no --> more</p><style>p{}</style><textarea>no</textarea></article>", "text more"),
    ("<article><p>a &lt;b&gt; &#233; &#x4e00;</p></article>", "a <b> é 一"), ("<p>unclosed <b>bold <i>it</p><p>next</b>", "unclosed bold it\n\nnext"),
    ("<a title='x > y' href=\"q\">t</a><p>z</p>", "t\n\nz"), ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\n\nb\n\nc"),
    ("<div id=main><h1>T</h1><p class=byline>By A</p><p>Body, long enough to be prose, here it is.</p></div><ol class=commentlist><li>hm, so, so</ol>"
     "<div class='topnav'>x</div>", "T\n\nBy A\n\nBody, long enough to be prose, here it is."),
    ("</p></div><<p>odd<", "<\n\nodd<"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_main_text(page, text):
    assert html_extract.extract(page) == text


PROSE = "A sentence of the article, long enough to count, and with commas, as prose has them."
BESIDE = [
    (f"<main><h1>Title</h1><p>lead paragraph</p><article><p>{PROSE}</p></article></main>", f"Title\n\nlead paragraph\n\n{PROSE}"),
    (f"<main><p>1 {PROSE}</p><article><p>2 {PROSE}</p><p>3 {PROSE}</p></article></main>", f"1 {PROSE}\n\n2 {PROSE}\n\n3 {PROSE}"),
    (f"<body><article><p>1 {PROSE}</p><p>2 {PROSE}</p></article><article><p>3 {PROSE}</p></article><footer>f</footer></body>",
     f"1 {PROSE}\n\n2 {PROSE}\n\n3 {PROSE}"),
    (f"<main><div><a href=a>{PROSE}</a></div><article><p>{PROSE}</p></article><h2>More</h2><ul><li><a href=b>{PROSE}</a></ul></main>", PROSE),
]


@pytest.mark.parametrize("page,text", BESIDE)
def test_beside_the_article(page, text):
    assert html_extract.extract(page) == text


def test_main_text_query(spark):
    rows = [(i, None if i % 2 else "u", p) for i, (p, _) in enumerate(CASES)]
    got = {r.page_id: r for r in html_extract.main_text(spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS text")).collect()}
    assert all(got[i].text == t and got[i].n_chars == len(t) for i, (_, t) in enumerate(CASES))


def test_depth_and_length_are_not_limited():
    deep = "<div>" * 5000 + "<p>in</p>" + "</div>" * 5000
    assert html_extract.extract(deep) == "in"
    many = "<article>" + "".join(f"<p>par {i}</p>" for i in range(5000)) + "</article>"
    assert html_extract.extract(many).count("\n\n") == 4999


def plain_main_text(page):
    """The scoring block by block: every block walks to the root and adds its
    points, characters and links to each ancestor; every block looks upwards
    for a kept node."""
    h = html_extract
    for by_words in (True, False):
        root = h.parse(page, by_words)
        found = h.blocks(root)
        if found:
            break
    else:
        return ""
    seen, score, chars, links, prose = {}, {}, {}, {}, {}
    for owner, text, link in found:
        points = 0.0
        if owner.tag not in h.HEADINGS and len(text) >= 25:
            points = (1 + text.count(",") + min(len(text) / 100, 30)) * (1 - min(1, link / len(text)))
        prose[id(owner)] = prose.get(id(owner), 0) + points
        up = owner.tag in ("p", "pre", "blockquote", "li", "dd", "dt", "td", "th", *h.HEADINGS) and owner.parent
        at, depth = owner.parent if up else owner, 0
        while at is not None:
            seen[id(at)] = at
            k = id(at)
            chars[k], links[k] = chars.get(k, 0) + len(text), links.get(k, 0) + link
            if depth < h.REACH:
                score[k] = score.get(k, 0) + points / (1, 2, 6, 12)[min(depth, 3)] / max(1, depth - 2)
            at, depth = at.parent, depth + 1
    for k, n in seen.items():
        bonus = 2 if n.tag == "article" or "article" in n.words or "articlebody" in n.words else 0
        score[k] = (score.get(k, 0) + bonus) * (1 - links[k] / max(chars[k], 1))
        n.score, n.chars, n.link_chars = score[k], chars[k], links[k]
    best = max(seen.values(), key=lambda n: score[id(n)])
    if score[id(best)] <= 0:
        best = next((n for n in seen.values() if n.tag in ("article", "main")), root)
    at = best
    while at is not None:
        if at.tag in ("article", "main"):
            best = at
            break
        at = at.parent
    keep = {id(best)}
    if best.parent is not None:
        beside = [s for s in best.parent.kids if not isinstance(s, str) and (s is best or not s.skip)]
        title = h._title(beside, best) if best.tag in ("article", "main") else {id(s) for s in beside if s.tag in h.HEADINGS}
        for s in beside:
            if s.score * (1 - s.link_chars / max(s.chars, 1)) >= max(3.0, best.score * 0.2) or prose.get(id(s), 0) >= 1.5 or id(s) in title:
                keep.add(id(s))

    def kept(n):
        while n is not None:
            if id(n) in keep:
                return True
            n = n.parent
        return False
    return "\n\n".join(t for o, t, _ in found if kept(o))


def test_random_trees_equal_the_plain_scoring():
    import random

    rnd = random.Random(8)
    texts = ["short", "a sentence, with a comma, that is long enough", "another one of them, a bit longer than the last, still plain", "x" * 300, "menu"]

    def tree(depth):
        tag = rnd.choice(["div", "div", "section", "p", "ul", "li", "article", "main", "h2", "a", "span", "header", "footer", "table", "td"])
        attrs = rnd.choice(["", "", "", ' class="post"', ' class="sidebar"', ' id="article-body"', " hidden"])
        kids = "".join(tree(depth + 1) if depth < 9 and rnd.random() < 0.62 else rnd.choice(texts) for _ in range(rnd.randint(1, 4)))
        return f"<{tag}{attrs}>{kids}" + (f"</{tag}>" if rnd.random() < 0.95 else "")

    some = 0
    for _ in range(400):
        page = tree(0)
        got = html_extract.extract(page)
        assert got == plain_main_text(page), page
        some += bool(got)
    assert some > 200


def test_broken_tags_leave_no_markup():
    for page, want in (('<p>Hello <a href="x>link</a> world, and more of it</p>', "Hello link world, and more of it"),
                       ("<p>it's <b title='a>b'>bold</b>, really, it is</p>", "it's bold, really, it is"),
                       ("<p>a < b and c > d, as they say here</p>", "a < b and c > d, as they say here")):
        assert html_extract.extract(page) == want


@pytest.mark.parametrize("page", [lambda n: "<div>Some text that is long enough, to count." * n, lambda n: "text <a " * n,
                                  lambda n: 'x <a href="' * n + ">", lambda n: "<header>" * n + "some text, that is long enough here"])
def test_time_grows_with_the_page(page):
    import time

    def seconds(n):
        best = 9e9
        for _ in range(2):
            t = time.perf_counter()
            html_extract.extract(page(n))
            best = min(best, time.perf_counter() - t)
        return best
    assert seconds(16_000) < 12 * max(seconds(4_000), 0.02)
