import random
import time

import pytest

from rowferry.llm.page_difference import main_text, article, shared_lines, template, DifferenceSettings
from rowferry.llm.page_text import FURNITURE_TEXT, blocks

KIND = "page_id long, url string, html string"


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = (rng.sample("abcdefghijkl", rng.randint(0, 12)) for _ in range(2))
        shared = sorted(shared_lines(a, b))
        assert len(shared) == lcs(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in shared)


def test_copies_say_nothing_of_templates():
    settings = DifferenceSettings()
    lines = [f"line {i} of the text with quite a few more words" for i in range(10)]
    assert template(lines, lines[:9] + ["other"], settings) is None
    assert template(["menu", "own words of this page"], ["menu", "quite another text here"], settings) == {0}
    menu = [f"menu entry {i}" for i in range(15)]
    assert template([*menu, "short"], [*menu, "brief"], settings) == set(range(15))


def test_article():
    lines, parts = ["menu", "teaser", "body of many words", "footer"], [0, 1, 0, 2]
    assert article(lines, parts, {0, 3}) == ["teaser", "body of many words"]
    assert article(lines, parts, {0, 2, 3}) == ["teaser"]
    assert article(lines, [0, 1, 1, 2], {0, 2}) == ["teaser", "body of many words"]
    assert article(lines, [0, 0, 0, 2], set()) == lines[:3]


def text(page):
    return "\n\n".join(line for line, part in zip(*blocks(page)) if part != FURNITURE_TEXT)


def test_blocks():
    assert text("<p>a&amp;b &eacute; &#65;\n  c<br>d<p>e") == "a&b é A c d\n\ne"
    assert text("x<script>var t='</p>';</script>y<style>p{}</style><!-- c -->z") == "xyz"
    assert text("<nav><ul><li>m</ul></nav><header>h</header><div class='site-footer'>f</div><p>t</p><footer>g") == "t"
    assert text("<p class=ad>buy<p>kept<div id='cookie-notice'><p>n</p></div><form><p>q</p></form>end") == "kept\n\nend"
    assert text("<div class=comments><div><p>c</p></div></div><b>bold <i>text</b> more") == "bold text more"
    assert blocks("<p>out</p><article><header><h1>T</h1></header><p>in</p></article>tail") == (
        ["out", "T", "in", "tail"], [0, 1, 1, 0])
    assert blocks("<nav>m<p>n</nav>t<p>a<span class=ad>b</span>c") == (["m", "n", "t", "a", "b", "c"], [2, 2, 0, 0, 2, 0])
    assert text("<ul><li>1<li>2</ul><table><tr><td>3<td>4</table>") == "1\n\n2\n\n3\n\n4"
    assert text("5 < 6 and <p") == "5 < 6 and"


def test_template_lines_go(spark):
    page = "<div>Top menu</div><div>{}</div><div>Bottom line</div>"
    rows = [(i, f"http://host/a/{i}?x=1", page.format(f"Body number {i} is here")) for i in range(6)]
    rows += [(10, "http://host/a/3", rows[3][2]), (11, "http://other/a", page.format("alone")),
             (12, "http://host/b", "<p>Top menu</p><article><p>Marked text</p><p>Bottom line</p></article>")]
    found = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, KIND).coalesce(1)).collect()}
    assert [found[i] for i in range(6)] == [f"Body number {i} is here" for i in range(6)]
    assert found[10] == "Body number 3 is here"
    assert found[11] == "Top menu\n\nalone\n\nBottom line"
    assert found[12] == "Marked text\n\nBottom line"


def plain(pages, settings):
    """One host's (order, lines, parts), each with the nearest page that is no copy: before, else after, within reach."""
    runs = []
    for page in pages:
        if not runs or runs[-1] != page:
            runs.append(page)
    texts = []
    for k, (lines, parts) in enumerate(runs):
        near = [*runs[max(0, k - settings.reach): k][::-1], *runs[k + 1: k + 1 + settings.reach]]
        shared = next((s for other, _ in near if (s := template(lines, other, settings)) is not None), set())
        texts.append(((lines, parts), "\n\n".join(article(lines, parts, shared))))
    out, k = [], 0
    for page in pages:
        k += page != texts[k][0]
        out.append(texts[k][1])
    return out


@pytest.mark.parametrize("seed", range(6))
def test_pairing_against_a_plain_version(spark, seed):
    rng = random.Random(seed)
    prose = [f"this is line number {i} of a text with many words" for i in range(6)]
    bodies = [rng.sample(prose, 4) for _ in range(4)]

    def page(k):
        body = rng.choice(bodies) if rng.random() < 0.7 else [f"own line {k} of a page with more words than a menu", f"and {k}"]
        tag = rng.choice(["article", "div", "div"])
        return ("<div>menu one</div><div>menu two</div><nav>n</nav>" + f"<{tag}>" + "".join(f"<p>{b}</p>" for b in body)
                + f"</{tag}>" + "<div>foot</div>")

    rows = [(k, f"http://host/{k:03}", page(k)) for k in range(60)]
    rows += [(60 + k, f"http://host/{k:03}", rows[k][2]) for k in range(60) if rng.random() < 0.3]
    rows.sort(key=lambda r: (r[1], r[0]))
    spread = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        found = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, KIND)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", spread)
    expected = plain([blocks(r[2]) for r in rows], DifferenceSettings())
    assert [found[r[0]] for r in rows] == expected


def test_marks_are_evidence(spark):
    """A teaser in the mark with the text outside; short texts below a long menu; near copies in a row."""
    body = "A body of {} that goes on for quite a number of words, and then on"
    teaser = "<div>Top menu</div><article>Teaser</article><p>" + body + "</p><div>Bottom line</div>"
    menu = "".join(f"<div>menu entry number {i}</div>" for i in range(15)) + "<p>Short {}</p>"
    rows = [(i, f"http://one/{i}", teaser.format(f"page {i}")) for i in range(4)]
    rows += [(10 + i, f"http://two/{i}", menu.format(i)) for i in range(4)]
    copy = "<div>Top menu</div>" + "".join("<p>" + body.format(f"copies, line {j}") + "</p>" for j in range(9)) + "<p>end {}</p>"
    rows += [(20 + i, f"http://three/{i}", copy.format(i)) for i in range(3)]
    rows += [(23, "http://three/9", "<div>Top menu</div><p>" + body.format("another") + "</p>")]
    found = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, KIND).coalesce(1)).collect()}
    assert [found[i] for i in range(4)] == ["Teaser\n\n" + body.format(f"page {i}") for i in range(4)]
    assert [found[10 + i] for i in range(4)] == [f"Short {i}" for i in range(4)]
    for i in range(3):
        assert found[20 + i].split("\n\n") == [body.format(f"copies, line {j}") for j in range(9)] + [f"end {i}"]
    assert found[23] == body.format("another")


@pytest.mark.parametrize("unit", [
    "<a ", "<b", '<a "', "<a '", '<a ">"', "<!--", "</", "</script", "<script>", "<textarea", "<![CDATA[", "<?", "<", "<div>", "<b>",
    "</x>", "<b><div></div>", "<i></b>", "<a =", "&", "<K"])
def test_time_in_proportion_to_the_page(unit):
    """No page takes more than a few times the time of another of its length."""
    before = "<p>first</p>"
    page = before + unit * ((1 << 19) // len(unit))
    started = time.monotonic()
    lines, _ = blocks(page)
    assert lines[0] == "first" and time.monotonic() - started < 5
    assert blocks(before + "<" + "b" * (1 << 19))[0] == ["first"]


def test_odd_mark_up():
    assert blocks("<p>a < b</p><p title='x > y'>c</p><3")[0] == ["a < b", "c", "<3"]
    assert blocks("<p>a<b title=\"never closed>b</b></p><p>c</p>")[0] == ["ab", "c"]
    assert blocks("<p>a</p><!-- b")[0] == ["a"] and blocks("<p>a</p><div class='x")[0] == ["a"]
    assert blocks("<ul><li>a<li>b</ul><p>c<p>d")[0] == ["a", "b", "c", "d"]
    assert blocks("<p>a <b>b</p><div>c</b> d</div></x>e")[0] == ["a b", "c d", "e"]
    assert blocks("x<script>if (a<b) '</p>'</script>y")[0] == ["xy"]
