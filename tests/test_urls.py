import re
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from grantlens.functions import urls
from grantlens.plans import pages as pg


def plain_form(url):
    """The normal form by the standard library."""
    parts = urlsplit(url)
    raised = lambda text: re.sub("%[0-9A-Fa-f]{2}", lambda m: m[0].upper(), text)
    user, at, site = parts.netloc.rpartition("@")
    site = site.lower()
    port = {"http": ":80", "https": ":443"}.get(parts.scheme, ":")
    site = site.removesuffix(port).removesuffix(":")
    given = sorted((p.partition("=")[0], p) for p in raised(parts.query).split("&") if p)
    query = "&".join(p for _, p in given)
    return f"{parts.scheme}://{user}{at}{site}{raised(parts.path) or '/'}" + (f"?{query}" if query else "")


ADDRESSES = st.tuples(
    st.sampled_from(["http", "HTTPS", "https", "ftp"]),
    st.sampled_from(["a.example", "A.Example:80", "a.example:443", "u:P@a.example", "a.example:8080", "a.example:"]),
    st.sampled_from(["", "/", "/x", "/%c3%a9t%C3%A9/", "/x%2", "/é//y", "/a%zz"]),
    st.lists(st.sampled_from(["b=2", "a=1", "a=0", "a", "", "B=%2f", "é=1", "a=1=2"]), max_size=5).map("&".join),
    st.sampled_from(["", "#top", "#"]),
).map(lambda p: f"{p[0]}://{p[1]}{p[2]}{'?' + p[3] if p[3] else ''}{p[4]}")


@settings(max_examples=10, deadline=None)
@given(st.lists(ADDRESSES, min_size=20, max_size=60))
def test_normal_form(spark, addresses):
    rows = spark.createDataFrame([(a,) for a in addresses], "url string")
    formed = rows.withColumn("normal", urls.normal_form(F.col("url")))
    for row in formed.withColumn("again", urls.normal_form(F.col("normal"))).collect():
        assert row.normal == plain_form(row.url) == row.again, row.url


def test_normal_form_of_odd_addresses(one):
    assert one(urls.normal_form, None) is None
    assert one(urls.normal_form, "") == ""
    assert one(urls.normal_form, "MAILTO:Me@Example.org#x") == "mailto:Me@Example.org"
    assert one(lambda t: urls.normal_form(t, keep_fragment=True), "http://A.b?c#D?e") == "http://a.b/?c#D?e"


def test_endings(one):
    for url, refused in {
        "http://a.b/x.PDF": True, "http://a.b/x.pdf?y=z": True, "http://a.b/x.tar.gz#p": True, "http://a.zip": False,
        "http://a.b/x.html": False, "http://a.b/?f=x.pdf": False, "http://a.b/pdf": False, "http://a.b/x.pdf/": False,
    }.items():
        assert one(urls.has_ending, url) is refused, url


class Links(HTMLParser):
    """Links of a page by the standard library's parser."""

    def __init__(self, address):
        super().__init__()
        self.address, self.base, self.found = address, None, []

    def handle_starttag(self, tag, attrs):
        href = dict(attrs).get("href")
        if href is not None and tag == "base" and self.base is None:
            self.base = urljoin(self.address, href.strip())
        if href is not None and tag in ("a", "area"):
            self.found.append(href.strip())

    def addresses(self):
        joined = [urljoin(self.base or self.address, href) for href in self.found]
        return [url for url in joined if re.match("(https?|ftp|file)://", url)]


PAGE = """<html><head>{base}</head><body><a href="one">1</a><map><area shape=rect HREF='/two'></map>
<!-- <a href="hidden">x</a> --><a class="x > y" href=three?b=1&amp;a=2>3</a><a name="n">no</a><abbr href="/no"></abbr>
<a href="mailto:x@y">m</a><a href=" ../four ">4</a><a data-href="/no" href="/five">5</a></body></html>"""


def test_links_by_base_and_area(spark):
    bases = ["", '<base href="https://other.example/r/s/">', "<BASE target=_top href='/up/'>", "<base target=x>"]
    rows = [(i, "https://a.example/d/p?q", PAGE.format(base=base)) for i, base in enumerate(bases)]
    rows += [(9, None, PAGE.format(base="")), (10, "https://a.example/", None), (11, "https://a.example/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((row.page_id, row.url) for row in pg.page_links(pages, "page_id").collect())
    expected = []
    for i, address, html in rows[:4]:
        parser = Links(address)
        parser.feed(html)
        expected += [(i, url) for url in parser.addresses()]
    assert got == sorted(expected) and len(got) == 20


def test_addresses_of_pages_against_plain_loops(spark, small_tables):
    pages = spark.read.parquet(f"{small_tables}/pages.parquet")
    counts = {}
    for row in pages.collect():
        parser = Links(row.url)
        parser.feed(row.html)
        formed = [plain_form(url) for url in parser.addresses()]
        for url in formed:
            if not re.search(r"\.(%s)$" % "|".join(urls.FILE_ENDINGS), urlsplit(url).path.lower()):
                counts.setdefault(url, [0, set(), 0])[0] += 1
                counts[url][1].add(row.page_id)
        counts.setdefault(plain_form(row.url), [0, set(), 0])[2] += 1
    got = {row.url: (row.n_links, row.n_pages, row.captured) for row in pg.linked_addresses(pages).collect()}
    assert got == {url: (n, len(on), own) for url, (n, on, own) in counts.items()}


def test_links_in_normal_form_are_one(spark):
    html = "<a href='HTTP://B.example:80?y=1&x=2#t'>a</a><a href='http://b.example/?x=2&y=1'>b</a><a href='/f.pdf'>c</a>"
    pages = spark.createDataFrame([(1, "http://a.example/", html)], "page_id long, url string, html string")
    found = pg.links(pages, normal=True, refused=urls.FILE_ENDINGS).collect()
    assert [row.url for row in found] == ["http://b.example/?x=2&y=1"]
