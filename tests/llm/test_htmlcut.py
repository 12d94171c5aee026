import html
import random
import re
from itertools import product

import pytest

from pktloom.llm import htmlcut as hc


def test_classifier_on_pages_it_has_not_seen():
    rnd, wrong, n = random.Random(99), 0, 0
    for _ in range(300):
        found = hc.blocks(hc.generated_page(rnd))
        kept = {id(b) for b in hc.content_blocks(found, hc.trained())}
        n += len(found)
        wrong += sum((id(b) in kept) != b.text.startswith(hc._MARK) for b in found)
    assert wrong / n < 0.02


def test_cut_is_least():
    rnd = random.Random(4)
    for _ in range(150):
        n = rnd.randint(1, 8)
        s, t = ([rnd.randint(0, 9) for _ in range(n)] for _ in range(2))
        edges = [(a, b, rnd.randint(0, 5)) for a, b in (rnd.sample(range(n), 2) for _ in range(rnd.randint(0, 10))) if n > 1] if n > 1 else []

        def cost(side):
            return sum(t[v] if side[v] else s[v] for v in range(n)) + sum(c for a, b, c in edges if side[a] != side[b])

        sides = list(product([False, True], repeat=n))
        least = min(map(cost, sides))
        for cut in (hc.source_side, hc.max_flow_side):
            got = cut(n, s, t, edges)
            assert cost(got) == least and sum(got) == min(sum(x) for x in sides if cost(x) == least)


def test_long_page():
    page = "<article>" + "".join(f"<p>Paragraph number {i}.</p><p class='ad'>Buy {i} now!</p>" for i in range(4000)) + "</article>"
    text = hc.main_text(page)
    assert text == "\n".join(f"Paragraph number {i}." for i in range(4000))


CASES = [
    (None, ""),
    ("", ""),
    ("just a sentence without any markup at all, which is all there is.", None),
    ("<nav><a href=/>Home</a></nav><article><h1>T &amp; U</h1><p>A  b<br>c<b>d</b></p></article><footer>&copy; x</footer>", "T & U\nA b cd"),
    ("<article><p>Body text is here.</p><section class=comments><div class=comment><p>I do not agree with this at all.</p></div></section></article>", "Body text is here."),
    ("<main><p>Body text is here.</p><aside><p>Another story that is not this one.</p></aside><p>More of it.</p></main>", "Body text is here.\nMore of it."),
    ("<body><div class='cookie-banner'><p>We use cookies to improve your visit.</p></div><article><p>One.</p></article></body>", "One."),
    ("<article><p>One.<form><label>Name</label><input><button>Go</button></form><p>Two.</article>", "One.\nTwo."),
    ("<article><!-- <p>no</p> --><script>var a='<p>no</p>'</script><style>p{}</style><p>1 &lt; 2 &#233; &nbsp;x</p></article>", "1 < 2 é x"),
    ("<article><p>Broken <b>here<p>Next < one <a href='x>y'>link</a> end", "Broken here\nNext < one link end"),
    ("<p title='>'>Quoted text is fine here.</p", None),
]


@pytest.mark.parametrize("page, text", CASES)
def test_cases(page, text):
    got = hc.main_text(page)
    assert isinstance(got, str) if text is None else got == text


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", CASES[3][0]), (1, "u", CASES[3][0]), (None, None, None), (2, "v", "<p>x " * 20000)], "page_id bigint, url string, html string").selectExpr("*", "'c' AS text", "1 AS n_chars")
    got = hc.extract(df).collect()
    assert len(got) == 4 and [r.n_chars for r in got if r.page_id == 1] == [12, 12] and [r.text for r in got if r.page_id is None] == [""]
    assert hc.extract(df.where("false")).count() == 0


def test_query_against_plain_reading(spark):
    from pktloom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in QUERIES["op10_html_mincut"](spark, sf).collect():
        inner = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_block_between_paragraphs_can_go():
    page = "<article><p>The first paragraph is a plain one, with a few words in it.</p><p><a href=/s>Share this</a></p><p>The second one is plain, too, and it has some more words.</p></article>"
    assert hc.main_text(page).split("\n") == ["The first paragraph is a plain one, with a few words in it.", "The second one is plain, too, and it has some more words."]
