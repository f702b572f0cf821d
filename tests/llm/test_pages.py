"""WARC archives and main text of pages."""
import gzip
import hashlib
import html
import io
import random
import re

import duckdb
import pytest

from harness import compare, duck
from shoplens.llm import html_text, warc
from shoplens.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id bigint, url string, html string"
LONG = "<p>" + "lang öäü " * 20_000 + "</p>"


def test_warc_query(spark):
    result = compare(QUERIES["op2_warc"](spark, SF), ORACLE["op2_warc"], duck(SF))
    assert result["exact"] and result["types_match"]


def odd_pages(spark):
    a, b = "x" * 100, "y" * 150
    return spark.createDataFrame([
        (5, "u", a), (3, "http://e.org/é x\n", a), (3, None, a), (None, "u", a), (7, "u", None), (8, "u", ""),
        (9, " u ", "short"), (10, "u", "short"), (None, "q", b), (None, "q", b), (11, "u", "z" * 99),
        (12, "u", "z" * 99), (13, "u", LONG), (14, "u", LONG), (15, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 9)], SCHEMA)


def test_warc_odd_rows(spark):
    pages = odd_pages(spark)
    found = warc.read_archives(warc.write_archives(pages, warc.archive_path(spark), archive_bytes=300)).collect()
    rows = pages.collect()
    assert len(found) == len(rows)
    least = {}
    for r in rows:
        data = (r.html or "").encode()
        if len(data) >= 100 and r.page_id is not None:
            least[data] = min(r.page_id, least.get(data, r.page_id))
    want = []
    for r in rows:
        data = (r.html or "").encode()
        to = least.get(data)
        to = None if to == r.page_id else to
        want.append((r.page_id, r.url, "response" if to is None else "revisit", data.decode() if to is None else None,
                     len(data), hashlib.sha256(data).hexdigest(), to))
    key = str
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_urls_of_any_length(spark):
    urls = ["data:text/html;base64," + "QUJD" * 250_000, "http://e.org/ä" + "ö x" * 200_000, "u"]
    pages = spark.createDataFrame([(k, u, "x" * 200) for k, u in enumerate(urls)], SCHEMA)
    found = warc.read_archives(warc.write_archives(pages, warc.archive_path(spark))).collect()
    assert sorted((r.page_id, r.url, r.refers_to) for r in found) == [(0, urls[0], None), (1, urls[1], 0), (2, "u", 0)]
    with pytest.raises(warc.WarcError):  # not a record: given up before its end
        warc.parse(iter([b"garbage"] * 2 + [None]))


def test_warc_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert warc.read_archives(warc.write_archives(none, warc.archive_path(spark))).collect() == []


def archive(*records):
    return b"".join(map(warc.member, records))


def read(data, step=7):
    stream = io.BytesIO(data)
    return list(warc.records(lambda n: stream.read(min(n, step))))


def test_members_are_gzip_and_read_in_any_steps():
    some = [warc.record("response", k, "http://a.b/c", bytes([65 + k]) * (k * 70_000)) for k in range(5)]
    data = archive(*some)
    assert gzip.decompress(data) == b"".join(some)
    for step in (1, 10, 1 << 16):
        found = read(data, step)
        assert [len(b) for _, b in found] == [k * 70_000 for k in range(5)]
        assert [h["x-page-id"] for h, _ in found] == list("01234")


@pytest.mark.parametrize("harm", ["cut", "length", "digest", "no length", "garbage", "no version", "tail"])
def test_damage_is_found(harm):
    good = warc.record("response", 1, "u", b"payload " * 50)
    bad = {"length": good.replace(b"Content-Length: 400", b"Content-Length: 399"),
           "digest": good.replace(b"payload payload", b"Payload payload"),
           "no length": good.replace(b"Content-Length: 400\r\n", b""),
           "no version": good.replace(b"WARC/1.1", b"HTTP/1.1"), "tail": good + b"x"}.get(harm, good)
    data = archive(good, bad)
    data = data[:-9] if harm == "cut" else data + b"garbage" if harm == "garbage" else data
    with pytest.raises(warc.WarcError):
        read(data)


def test_archives_are_of_bounded_size(spark):
    rng = random.Random(1)
    pages = spark.createDataFrame([(k, "u", rng.randbytes(500).hex()) for k in range(200)], SCHEMA).coalesce(1)
    manifest = warc.write_archives(pages, warc.archive_path(spark), archive_bytes=20_000).collect()
    assert len(manifest) > 4 and all(m.n_bytes < 21_500 for m in manifest)
    assert sum(m.n_records for m in manifest) == 200


# Main text

def article_of(page):
    """What the given pages' articles hold, by their known markup."""
    inside = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
    lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(x for x in lines if x)


def test_html_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = QUERIES["op4_html_text"](spark, SF).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r.text == article_of(pages[r.page_id].html) and r.n_chars == len(r.text)
        assert r.url == pages[r.page_id].url


CASES = [
    (None, ""), ("", ""), ("   ", ""), ("plain text", "plain text"), ("<p>only  one\n paragraph", "only one paragraph"),
    ("<script>x</script><style>y</style><!-- z -->", ""), ("<div>a<br>b</div>", "a b"),
    ("<p>a &lt; b &amp; c&nbsp;d &#233; &bogus; e</p>", "a < b & c d é &bogus; e"),
    ("<p>one<p>two<p>three", "one\ntwo\nthree"),
    ("<article><h1>Head</h1><p><b>First line.<br><p>Second, line. And more.</article><footer>f</footer>",
     "Head\nFirst line.\nSecond, line. And more."),
    ("<article><header><h1>T</h1></header><p>x y z.</p><section class='comments'><p>c, c c.</p></section>"
     "<form><label>Name</label><input></form></article>", "T\nx y z."),
    ("<main><p>Text, of the page. It is long enough.</p><div class='share-buttons'>Share this</div>"
     "<div class='adBox'>Buy. Now.</div></main>", "Text, of the page. It is long enough."),
    ("<div class='cookie-notice'>We use cookies, to do things.</div><h1>Head</h1><p>Body text one.<p>Body text two.",
     "Head\nBody text one.\nBody text two."),
    ("<header>Site</header><nav>a b</nav><div id=page><h2>T</h2><p>Long text, with words. And more words.</p>"
     "<p>Short.</p><ul><li>one<li>two</ul></div><aside>Links, here.</aside><div id='comments'><p>I agree, yes. "
     "Really.</p></div>", "T\nLong text, with words. And more words.\nShort.\none\ntwo"),
    ("<p>unfinished <b>bold <a href='x", "unfinished bold"),
    ("<table><tr><td>cell a<td>cell b</table>", "cell a\ncell b"),
    ("<p hidden>gone</p><p style='display: none'>gone</p><p>here, it is.</p>", "here, it is."),
]


@pytest.mark.parametrize("page,text", CASES)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_html_odd_rows(spark):
    rows = [(k, None if k % 2 else "u", page) for k, (page, _) in enumerate(CASES)]
    rows += [rows[3], (None, "u", "<p>x"), (99, "u", "<div>" * 3000 + "deep" + "</div>" * 3000), (100, "u", LONG)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = html_text.extract(df).collect()
    want = [(i, u, html_text.main_text(h), len(html_text.main_text(h))) for i, u, h in rows]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert dict((r.page_id, r.text) for r in found)[99] == "deep"
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ratios_choose_the_long_punctuated_paths():
    pieces = [("Menu", "body/ul/li", 1, 1)] * 6 + [("A sentence, with marks. And another one.", "body/div/p", 2, 2)] * 6
    assert html_text.content_paths(pieces, html_text.THRESHOLD) == {"body/div/p"}


BODY_TEXT = "A long paragraph, with many words and marks. It goes on, and on, for a while. And ends here. " * 8
LINKS = "<ul><li><a href=a>First link</a><li><a href=b>Second link</a><li><a href=c>Third link</a></ul>"


@pytest.mark.parametrize("page,text", [
    (f"<div id=content><h1>Headline</h1><p>The lead.</p><div class=text><p>{BODY_TEXT}</p><p>{BODY_TEXT}</p></div></div>",
     f"Headline\nThe lead.\n{BODY_TEXT.strip()}\n{BODY_TEXT.strip()}"),
    (f"<div><div><p>Short one.</p></div><div><p>{BODY_TEXT}</p></div><div><p>Short two.</p></div></div>",
     f"Short one.\n{BODY_TEXT.strip()}\nShort two."),
    (f"<div>{LINKS}</div><div><h2><a href=x>Linked headline</a></h2><div><p>{BODY_TEXT}</p></div></div>"
     f"<div><h3>More</h3>{LINKS}</div>", f"Linked headline\n{BODY_TEXT.strip()}"),
    (f"<div><p>Lead in the links' element.</p>{LINKS}</div><div><div><p>{BODY_TEXT}</p>{LINKS}</div></div>",
     f"Lead in the links' element.\n{BODY_TEXT.strip()}\nFirst link\nSecond link\nThird link"),
    (f"<div><p>See <a href=x>the whole paper</a>.</p><div><p>{BODY_TEXT}</p></div><p>Plain text of the same path.</p></div>",
     f"See the whole paper.\n{BODY_TEXT.strip()}\nPlain text of the same path."),
    (f"<p>Outside.</p><main><h1>Headline</h1><article><p>{BODY_TEXT}</p></article><article><p>Short.</p></article></main>",
     f"Headline\n{BODY_TEXT.strip()}\nShort."),
])
def test_what_stands_beside_the_content_node_stays(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page,text", [
    (f"<div class='page has-sidebar'><h1>Headline</h1><p>{BODY_TEXT}</p></div>", f"Headline\n{BODY_TEXT.strip()}"),
    (f"<div>Site</div><div class='no-sidebar'><article><h1>Headline</h1><p>{BODY_TEXT}</p></article></div>",
     f"Headline\n{BODY_TEXT.strip()}"),
    (f"<div class='sidebar'><h1>Headline</h1><p>{BODY_TEXT}</p></div>", f"Headline\n{BODY_TEXT.strip()}"),
    (f"<article><p>{BODY_TEXT}</p><h2 id='related-work'>Related work</h2><p>A few words.</p><h2 id=comments>Comments</h2>"
     "<section id='social-history'><h2>Social history</h2><p>Some.</p></section>"
     "<div id='comments-on-the-method'><p>None, yet.</p></div></article>",
     f"{BODY_TEXT.strip()}\nRelated work\nA few words.\nComments\nSocial history\nSome.\nNone, yet."),
    ("".join(f"<div class='text widget'><p>{k}. {BODY_TEXT}</p></div>" for k in range(3))
     + "<div class='cookie-notice'><p>We use cookies, to do things.</p></div>",
     "\n".join(f"{k}. {BODY_TEXT.strip()}" for k in range(3))),
])
def test_a_name_alone_drops_nothing(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("name", ["class=comments", "id=comments", "class='post-comments x'", "class=adBox", "id=sidebar-2",
                                  "class='td related'", "class=footerLinks"])
def test_named_elements_of_a_minor_share_are_left_out(name):
    named = f"<div {name}><p>I agree, and so on. Really.</p></div>"
    for page in (f"<article><p>{BODY_TEXT}</p>{named}</article>", f"<div><p>{BODY_TEXT}</p></div>{named}",
                 f"<article><p>{BODY_TEXT}</p></article>{named * 99}"):
        assert html_text.main_text(page) == BODY_TEXT.strip()


@pytest.mark.parametrize("section", ['class="comments-section"', 'id="comments"', 'class="comment-list"', 'id="respond"'])
def test_comments_longer_than_the_article_go(section):
    remarks = "".join(f"<p>Reader number {k} thinks this was worth writing down, at some length.</p>" for k in range(30))
    page = (f"<html><body><article><h1>Title</h1><p>The article itself has a paragraph of plain words.</p>"
            f"<p>And another one of about the same length.</p><section {section}>{remarks}</section></article></body></html>")
    text = html_text.main_text(page)
    assert "Reader number" not in text
    assert "The article itself has a paragraph of plain words." in text and "And another one" in text


def test_an_article_about_comments_stays():
    body = "".join(f"<p>Paragraph {k} is on how comments are written, at some length.</p>" for k in range(5))
    text = html_text.main_text(f"<html><body><article class='comments'><h1>On comments</h1>{body}</article></body></html>")
    assert "Paragraph 4" in text
