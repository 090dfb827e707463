from __future__ import annotations

import itertools
import random
import re
import time

import pytest

from graftline.llm import html_text as ht

SF = "/root/testdata/sf0.001"


def text(html):
    lines = ht.page_lines(html)
    return " ".join(lines[i].text for i in ht.candidates(lines)[0])


CASES = [
    ("<body><nav>m</nav><article><h1>T</h1><p>a <b>b</b>c&amp;d<br>e<p>f</article><footer>x</footer>", "T a bc&d e f"),
    ("<article><p>one<script>if (a<b) '</p>'</script> two<style>p{}</style></p><!-- no <p>x --></article>", "one two"),
    ("<div class='cookie-notice'>ok?</div><main><p>x</p><aside>y</aside><form>z</form><div id=comments><p>c</p></div></main>", "x"),
    ("<article><header><h1>Head</h1></header><p>in</p><section class='comment-list'><article class=comment>no</article></section></article><header>out</header>", "Head in"),
    ("<p>plain &lt;b&gt; &#233;&eacute;&nbsp;&amp x<p>2", "plain <b> éé & x 2"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a b c d"),
    ("<div>a<span class=ad>buy</span>b</div><div style='display:none'>h</div>", "a b"),
    ("a < b and c > d <p class=\"x>y\">q</p>", "a < b and c > d q"),
    ("<article>open <p>never closed <script>var x", "open never closed"),
    ("<div class='has-sidebar'><article><div class='entry-header'><h1>T</h1></div><p>x</p><div class='share-buttons'>s</div></article><div id='right_sidebar'>y</div></div>", "T x"),
    ("<div id=header>h</div><div id=menu>m</div><div id=content><p>body</p></div><div class='notice warning'>n</div><section id=comments><article id=comment-1>c</article></section>", "body"),
    ("<div id='ad-hoc-query'>a</div><article><p class='share-price'>b</p><p class='form-factor'>c</p><p class='notice-period'>d</p><p class='cookie-policy-notice'>e</p><p class='ad-slot-3'>f</p></article>", "b c d"),
    ("<main><article>one</article><p>outside</p><nav>no</nav></main><p>far</p>", "one outside"),
    ("<article><section class='reviews'><p>film reviews</p></section></article>", "film reviews"),
    ("<article><p>x</p><div class='userComments'><p>c</p></div><div id='cookieNotice'>k</div></article><article class='teaser'><p>t</p></article>", "x"),
    ("<article><p>x</p><div class='related'>first guess</div></article>", "x"),
    ("", ""),
    (None, ""),
    ("no markup", "no markup"),
]


@pytest.mark.parametrize(("html", "want"), CASES)
def test_main_text(html, want):
    assert text(html) == want


def longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 14))] for _ in range(2))
        at = ht.shared_lines(a, b)
        it = iter(b)
        assert at == sorted(set(at)) and all(any(a[i] == x for x in it) for i in at) and len(at) == longest(a, b)
    a, b = [rng.randint(0, 50) for _ in range(9000)], [rng.randint(0, 50) for _ in range(9000)]
    at = ht.shared_lines(a, b)
    it = iter(b)
    assert all(any(a[i] == x for x in it) for i in at)
    whole = ht._lengths(list(ht._rows(a, b))[-1], len(b))[-1]
    assert len(at) == whole


def test_differencing_on_pages_without_an_article(spark):
    page = lambda body: f"<div>Site name</div><div>Home News About</div>{body}<div>All rights reserved</div>"
    rows = [(1, "http://a.org/n/1.html", page("<p>First story.</p>")), (2, "http://a.org/n/2.html", page("<p>Second story.</p><p>More.</p>")), (3, "http://a.org/zzz", page("<p>Far away.</p>")), (4, "http://b.org/n/1", page("<p>Alone.</p>")), (5, None, "<p>x</p>"), (6, "http://c.org/1", "<p>copy</p>"), (7, "http://c.org/2", "<p>copy</p>"), (7, "http://c.org/2", "<p>copy</p>"), (None, "http://c.org/3", None), (9, "http://d.org/", "<article>kept</article><p>shared</p>"), (10, "http://d.org/x", "<article>kept</article><p>shared</p>")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in ht.extract(pages).collect()), key=str)
    want = {1: "First story.", 2: "Second story. More.", 3: "Far away.", 4: "Site name Home News About Alone. All rights reserved", 5: "x", 6: "copy", 7: "copy", None: "", 9: "kept", 10: "kept"}
    assert got == sorted(((i, want[i], len(want[i])) for i, *_ in rows), key=str)
    assert ht.extract(pages.limit(0)).count() == 0


def test_lines_beside_an_article_go_only_if_the_next_page_has_them(spark):
    page = lambda i, more: f"<main><p>Site news</p><article>story {i}</article>{more}<p>Contact us</p></main>"
    rows = [(1, "http://a.org/n/1", page(1, "<p>an own note</p>")), (2, "http://a.org/n/2", page(2, "")), (3, "http://b.org/x", page(3, ""))]
    got = {r.page_id: r.text for r in ht.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "story 1 an own note", 2: "story 2", 3: "Site news story 3 Contact us"}


def test_near_copies_keep_what_they_share(spark):
    """The page between two near copies and a page of the site's own lines; alone, copies keep everything."""
    story = [f"sentence {i}" for i in range(20)]
    page = lambda body: "".join(f"<p>{x}</p>" for x in ["site", *body, "foot"])
    rows = [(1, "http://a.org/a/1", page([*story, "one"])), (2, "http://a.org/a/2", page([*story, "two"])), (3, "http://a.org/b/3", page(["other", "news"])), (4, "http://b.org/1", page([*story, "x"])), (5, "http://b.org/2", page([*story, "y"]))]
    got = {r.page_id: r.text for r in ht.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    whole = " ".join(story)
    assert got == {1: f"site {whole} one foot", 2: f"{whole} two", 3: "other news", 4: f"site {whole} x foot", 5: f"site {whole} y foot"}


def test_differencing_decides_on_soft_words_inside_articles(spark):
    page = lambda i: f"<article><h1>Film {i}</h1><div class='reviews'><p>it was film {i}</p><p>read more reviews</p></div></article>"
    rows = [(1, "http://a.org/1", page(1)), (2, "http://a.org/2", page(2))]
    got = {r.page_id: r.text for r in ht.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "Film 1 it was film 1", 2: "Film 2 it was film 2"}


@pytest.mark.parametrize("unit", ["<x></y>", "<x><li>", "<li><div><x>", "</y>", "<a ' \">", "<td><x>", "<p><b class=ad>"])
def test_time_is_linear_in_broken_markup(unit):
    took = {}
    for n in (25_000, 100_000):
        began = time.process_time()
        ht.page_lines(unit * n + "end")
        took[n] = time.process_time() - began
    assert took[100_000] < 8 * took[25_000] + 1 and took[100_000] < 20


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_extraction_equals_brute_force(spark):
    rng = random.Random(9)
    words = "alpha beta gamma delta epsilon zeta".split()
    rows = []
    for i in range(60):
        site = i % 3
        lines = [f"site {site}", "menu", *(f"{rng.choice(words)} {rng.choice(words)}" for _ in range(rng.randint(0, 6))), f"foot {site}"]
        body = "".join(f"<p>{x}</p>" for x in lines)
        if i % 4 == 0:
            body = f"<main>{body}<article>own {i}</article></main>"
        rows.append((i, f"http://s{site}.org/{rng.choice(words)}/{i:02d}", body))
    order = sorted(rows, key=lambda r: (r[1].split("/")[2], "/" + r[1].split("/", 3)[3], str(r[0])))
    want = {}
    for k, (i, url, body) in enumerate(order):
        host, path = url.split("/")[2], "/" + url.split("/", 3)[3]
        near = sorted((distance(path, "/" + o[1].split("/", 3)[3]), turn, o) for turn, o in ((0, order[k + 1] if k + 1 < len(order) else None), (1, order[k - 1] if k else None)) if o and o[1].split("/")[2] == host)
        own = re.findall("<(?:p|article)>(.*?)</", body)
        gone = set()
        if near:
            others = [re.findall("<(?:p|article)>(.*?)</", o[2][2]) for o in near]
            gone = set(ht.shared_lines(own, others[0]))
            if len(gone) >= 0.8 * max(len(own), len(others[0])):
                gone &= set(ht.shared_lines(own, others[1])) if len(others) > 1 else set()
            gone -= {j for j, x in enumerate(own) if x.startswith("own")}
            gone = set() if len(gone) == len(own) else gone
        want[i] = " ".join(x for j, x in enumerate(own) if j not in gone)
    got = {r.page_id: r.text for r in ht.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want and any("site" not in t for t in want.values())


def test_articles_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    got = ht.extract(pages).collect()
    assert len(got) == len(source)
    for r in got:
        inner = source[r.page_id].split("<article>")[1].split("</article>")[0]
        plain = inner
        for tag in ("<h1>", "</h1>", "<p>", "</p>", "<br>"):
            plain = plain.replace(tag, " ")
        plain = ht.entities.unescape(plain.replace("<b>", "").replace("</b>", ""))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text)
