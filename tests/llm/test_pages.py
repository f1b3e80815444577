"""Main text of pages."""

import random

import pytest

from voltmart.llm import html

ARTICLE = ("<html><head><title>t</title><script>if (a < b) '</p>'</script></head><body><nav><a>Menu</a></nav>"
           "<div class='cookie-notice'>We use cookies</div><article><h1>Head  line</h1><p><b>First &amp; best<br>line<p>Second"
           "\n\tline <i>here</i><aside>Side</aside><form>Mail</form><div class=\"ad\">Buy</div><p>Third"
           "<section id=comments><p>Nice!</p></section></article><footer>&copy; us</footer></body></html>")


def text_of(page, near=None):
    return html.main_text(html.lines_of(page), [html.lines_of(near)] if near else [])


def test_article_wins():
    assert text_of(ARTICLE) == "Head line\nFirst & best line\nSecond line here\nThird"
    assert text_of(ARTICLE, ARTICLE) == text_of(ARTICLE)


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>a<p>b", "a\nb"), ("a < b and c > d", "a < b and c > d"),
    ("<!-- x --><p>a<!-- y -->b</p>", "ab"), ("<p>a&nbsp;&#233;&#x41;</p>", "a éA"), ("<main><p>in</p></main><p>out</p>", "in"),
    ("<article><p>one</p></article><p>x</p><article class=comment>no</article>", "one"), ("<p title='a>b'>q</p>", "q"),
    ("<div style='display: none'>no</div><p>yes</p>", "yes"), ("<article>open", "open"), ("</p></div>x", "x"),
    ("<script>never closed", ""), ("<a href=\"x<p>broken", "<a href=\"x\nbroken"),
])
def test_small_pages(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize("page, text", [
    ("<div class='layout no-sidebar'><p>a</p></div>", "a"), ("<body><form id=aspnetForm><article><p>a</p></article></form>", "a"),
    ("<div class='post share'><article>a<div class=share>b</div></article></div>", "a"),
    ("<form><nav>n</nav><main><p>a</p></main><aside><article>t</article></aside></form>", "a"),
    ("<article>a</article><aside><article>t</article></aside>", "a"), ("<form><p>a</p></form>", "a"),
    ("<div class='comments-open'><main><p>a</p></main></div>", "a"),
    ("<article class=card>teaser</article><main><p>a long main part, longer than that</p></main>", "a long main part, longer than that"),
    ("<main><h1>h</h1><form><article>a b c</article></form></main>", "a b c"), ("<div class='cookie-notice'>c</div><p>a</p>", "a"),
])
def test_wrappers_do_not_hide_the_article(page, text):
    assert text_of(page) == text


def test_differencing_without_markup():
    page = lambda body: f"<div>Top</div><div>Links</div><p>{body}</p><div>Bottom</div>"
    assert text_of(page("mine"), page("other")) == "mine"
    assert text_of(page("mine"), page("mine")) == "Top\nLinks\nmine\nBottom"


def subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("limit", [1 << 28, 20])
def test_common_places_are_longest(monkeypatch, limit):
    monkeypatch.setattr(html, "PRODUCT", limit)
    rng = random.Random(9)
    for _ in range(200):
        a = [rng.randint(0, 5) for _ in range(rng.randint(0, 25))]
        b = [rng.randint(0, 5) for _ in range(rng.randint(0, 25))]
        found = sorted(html.common_places(a, b))
        assert len(found) == subsequence(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)


def test_hostile_markup_ends():
    assert html.lines_of("<a " * 50_000) and html.lines_of("<p " + "x=\"y\" " * 20_000) is not None
    assert len(html.lines_of("<p>x" * 20_000)) == 20_000


def test_pages_across_ranges(spark):
    rows = [(i, f"http://{'hot' if i % 3 else 'h' + str(i)}.example.org/{i % 50}?q={i}",
             f"<div>Menu</div><p>text {i}</p><div>End</div>", "h", "p") for i in range(300)]
    rows += [(1000, None, None, "h", "p"), (1001, "", "", "h", "p"), (1002, "not a url ::[", "<p>x</p>", "h", "p"),
             (None, "http://cold.example.org/7", "<article>no id</article>", "h", "p"), rows[1], (1003, "http://[bad", "<article>y</article>", "h", "p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, text string")
    got = html.extract_pages(pages.repartition(7)).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r.text for r in got}
    for i in range(300):
        if i % 3 and i != 1:
            assert by_id[i] == f"text {i}", i
        elif i != 1:
            assert by_id[i] == f"Menu\ntext {i}\nEnd"
    assert by_id[1000] == "" and by_id[1001] == "" and by_id[None] == "no id" and by_id[1003] == "y"
    assert all(r.n_chars == len(r.text) for r in got)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.extract_pages(empty).count() == 0


def sentence(n):
    return " ".join(f"word{n * 7919 % 10007 + k}" for k in range(12))


def test_a_notice_inside_the_article_goes_if_its_neighbours_have_it(spark):
    page = lambda i: (f"<nav>m{i}</nav><article><p>Site wide notice: we moved</p><h1>{sentence(i)}</h1>"  # noqa: E731
                      f"<p>{sentence(i + 100)}</p><p>Read on</p></article>")
    rows = [(i, f"http://a.example/{i:03d}", page(i)) for i in range(40)]
    rows.append((99, "http://a.example/020b", f"<article><p>Site wide notice: we moved</p><p>{sentence(7000)}</p><p>Read on</p></article>"))
    got = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"{sentence(i)}\n{sentence(i + 100)}" for i in range(40))
    assert got[99] == sentence(7000)


@pytest.mark.parametrize("declared", [True, False])
def test_near_copies_beside_each_other_keep_their_text(spark, declared):
    """Ten paragraphs of which one differs: no neighbour of that kind says what is template."""
    def page(article, edit):
        body = [sentence(100 * article + k) for k in range(10)]
        body[3] = sentence(50_000 + edit)
        text = "".join(f"<p>{line}</p>" for line in body)
        return f"<div>Top</div><div>Links</div>{'<article>' + text + '</article>' if declared else text}<div>Bottom</div>", body
    rows, expected = [], {}
    for article in range(6):
        for edit in range(30 if article == 2 else 3):
            made, body = page(article, 100 * article + edit)
            expected[len(rows)] = "\n".join(body)
            rows.append((len(rows), f"http://b.example/{article}/{edit:02d}?print={edit}", made))
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        assert got == expected, parts


def brute(rows):
    """Every page against all pages of its host: nearest ones before it first, then those after it."""
    hosts, out = {}, {}
    for row in sorted(rows, key=lambda r: (*html._address(r[1]), str(r[0]))):
        hosts.setdefault(html._address(row[1])[0], []).append((row[0], html.lines_of(row[2])))
    for pages in hosts.values():
        for i, (key, page) in enumerate(pages):
            near = []
            for _, other in pages[:i][::-1] + pages[i + 1 :]:
                if len(near) < html.PARTNERS and not html.near_copies(page, other) and not any(html.near_copies(other, n) for n in near):
                    near.append(other)
            chosen = html.candidates(page)
            lines = [page[c][0] for c in chosen]
            template = None
            declared = bool(chosen) and page[chosen[0]][2] > 0
            for other in (near if len(near) == html.PARTNERS else []) if declared else near[: html.UNDECLARED]:
                texts, there = lines, [t for t, _, _ in other]
                common = {chosen[p] for p in longest(texts, there)}
                template = common if template is None else template & common
            size = lambda some: sum(len(page[c][0]) for c in some)
            template = template or set()
            if len(template) == len(chosen) or declared and 2 * size(template) > size(chosen):
                template = set()
            out[key] = "\n".join(page[c][0] for c in chosen if c not in template)
    return out


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    i, j, found = len(a), len(b), set()
    while i and j:
        if a[i - 1] == b[j - 1]:
            found.add(i - 1)
            i, j = i - 1, j - 1
        elif table[i - 1][j] >= table[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return found


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_generated_hosts_against_every_pair(spark, parts):
    rng, rows = random.Random(11), []
    for host in range(12):
        menu = [f"Link {host} {k}" for k in range(rng.randint(0, 6))]
        for n in range(rng.choice([1, 2, 3, 25])):
            own = [sentence(10_000 * host + 50 * n + k) for k in range(rng.randint(1, 6))]
            text = "".join(f"<p>{t}</p>" for t in own)
            if rng.random() < 0.4:
                text = f"<article><p>Host notice {host}</p>{text}</article>"
            rows.append((len(rows), f"https://www.h{host}.example/{n:03d}", "".join(f"<div>{m}</div>" for m in menu) + text + f"<div>Foot {host}</div>"))
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    got = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert got == brute(rows)


@pytest.mark.parametrize("parts", [1, 6])
def test_more_near_copies_than_may_wait_hide_no_partner(spark, monkeypatch, parts):
    """A host begins with 200 near copies of one page, a multiple of what waits; their partners come after them."""
    monkeypatch.setattr(html, "CHUNK", 8, raising=False)
    top = "".join(f"<div>Top {k}</div>" for k in range(3))
    copy = [sentence(k) for k in range(8)]
    rows = [("http://a.example/x", "<p>other host</p>")]
    for n in range(200):
        body = [*copy, sentence(30_000 + (n if n % 2 else 0))]
        rows.append((f"http://b.example/a{n:03d}", top + "".join(f"<p>{t}</p>" for t in body)))
    for n in range(6):
        rows.append((f"http://b.example/b{n}", top + "".join(f"<p>{sentence(50_000 + 20 * n + k)}</p>" for k in range(4))))
    rows = [(n, *row) for n, row in enumerate(rows)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    got = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert got == brute(rows)
    assert not any("Top" in text for text in got.values())
