"""Main text by the joint importance of hints and entropies."""

import pytest

from ledgertide.llm import site_style


def texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {r.page_id: r.text for r in site_style.extract_main_text(pages).collect()}


def test_the_tree_decides_beside_and_inside_a_marked_article(spark):
    page = ('<html><body><nav>Menu {i}</nav><div class="story"><p>Story {i}</p></div><div class="motto">Our motto</div>'
            '<article><h2>Teaser {i}</h2><div class="club">Join the club</div></article><div class="ad">Buy {i}</div></body></html>')
    got = texts(spark, [(i, f"http://a.example.org/{i}", page.format(i=i)) for i in range(30)])
    assert all(got[i] == f"Story {i}\nTeaser {i}" for i in range(30))


def test_copies_count_once_and_small_hosts_are_judged(spark):
    page = "<html><body class=p{i}><ul><li>Start<li>Shop</ul><div><p>Story {i}</p></div></body></html>"
    rows = [(i, "http://copies.example.org/", page.format(i=0)) for i in range(20)]
    rows += [(100 + i, "http://most.example.org/", page.format(i=max(0, i - 80))) for i in range(100)]
    rows += [(300 + i, "http://two.example.org/", page.format(i=i)) for i in range(2)]
    rows += [(400 + i, "http://bare.example.org/", "<body>All the same<p>Part " + str(i)) for i in range(9)]
    got = texts(spark, rows)
    assert all(got[i] == "Start\nShop\nStory 0" for i in range(20))  # one page only: nothing to tell the menu by
    assert all(got[100 + i] == f"Story {max(0, i - 80)}" for i in range(100))
    assert [got[300], got[301]] == ["Story 0", "Story 1"]
    assert all(got[400 + i] == f"All the same\nPart {i}" for i in range(9))


@pytest.mark.parametrize("source,want", [
    ('<div class="content no-sidebar"><p>Text</div>', "Text"),
    ('<div id="page-with-nav"><p>Text</div>', "Text"),
    ('<article class="post share"><p>Text</article><div class="ad">Buy</div>', "Text"),
    ('<article><h2 id="search-for-food">Food</h2><p>Text</article>', "Food\nText"),
    ('<div class="share"><h1>Title</h1><p>Text<div class="ad">Buy</div></div>', "Title\nText"),
    ('<form><div class="sidebar">Side</div><p>A long text of the page</form>', "A long text of the page"),
    ('<div class="site-footer">Foot</div><div id="comment-12">C</div><p>A long text of the page', "A long text of the page"),
    ('<article>Text</article><div class="comments">Far longer than the text</div>', "Text"),
    ('<ol class="comments"><li><article class="comment">C</article></ol><p>A long text of the page', "A long text of the page"),
    ("<p>A <svg class=x/>text</p><p>B", "A text\nB"),
    ("<p>A <svg><path d=x/><g>in it</svg>text", "A text"),
    ("<svg-icon></svg-icon><title-bar>Bar</title-bar><template-x>X</template-x><p>Text", "BarX\nText"),
    ("<div><svg><path d=x></div><p>Text", "Text"),
    ("<article><svg><path d=x><p>Text</article>", "Text"),
    ("<div><noscript>No</div><p>Text<div><template>T</div><p>End", "Text\nEnd"),
    ("<head><meta charset=x><title>T</title><body><p>Text", "Text"),
])
def test_words_of_names_and_unclosed_elements_lose_no_article(source, want):
    assert site_style.main_text(site_style.read_page(source), {}) == want
