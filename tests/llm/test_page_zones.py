from __future__ import annotations

import numpy as np
import pytest

from marketlake.llm import html_extract as H
from tests.llm.test_pages_packing import page


def text(body):
    return H.without_runs([(t, r) for t, r, _ in H.roles(page(body))], np.empty(0, np.int64))


@pytest.mark.parametrize("mark", ['class="layout with-sidebar"', 'class="no-sidebar"', 'class="has-header"', 'class="content-widget"', 'id="search-results"', 'class="sidebar"', 'class="page widget"'])
def test_class_words_of_a_wrapper_do_not_hide_an_article(mark):
    assert text(f"<div {mark}><article><p>story</p></article></div>") == "story"
    assert text(f"<div {mark}><main><p>story</p></main></div>") == "story"


def test_parts_of_an_article_stay():
    assert text('<article><h2 class="section-header">Head</h2><section class="related-work">Work</section><p>b</p></article>') == "Head\nWork\nb"


@pytest.mark.parametrize("mark", ["sidebar", "site-header", "sidebar-left", "ad-slot-3", "cookie-notice", "share-buttons", "related-posts", "post-comments", "main-nav", "widget-12", "ad unit"])
def test_noise_by_name_still_goes(mark):
    assert text(f'<article><p>a</p><div class="{mark}">no</div><p>b</p></article>') == "a\nb"
    assert text(f'<article><p>a</p><div class="{mark}"><article>no</article></div><p>b</p></article>') == "a\nb"


def test_elements_and_comments_still_hide_articles():
    assert text("<p>x</p><article>a</article><aside><article>no</article></aside><div class='comments'><article>no</article></div>") == "a"


def test_main_is_kept_with_its_articles_in_page_order(spark):
    body = "<main><h1>Title</h1><p>long story</p><article class='card'>teaser</article><p>end</p></main>"
    assert text(body) == "Title\nlong story\nteaser\nend"
    assert text("<main><article>only</article></main>") == "only"


def test_runs_of_the_host_decide_on_articles_beside_main(spark):
    teaser = "<article>" + " ".join(f"teaser{i}" for i in range(12)) + "</article>"
    rows = [(i, f"http://a.example/{i}", page(f"{teaser}<main><p>story {i}</p></main><article>letter{i} from{i} home{i}</article><p>out</p>")) for i in range(3)]
    out = H.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {r.page_id: r.text for r in out.collect()} == {i: f"story {i}\nletter{i} from{i} home{i}" for i in range(3)}


def test_tags_part_character_references():
    assert text("<article>am&am<b>p;</b> x &amp;</article>") == "am&amp; x &"


def test_a_name_alone_does_not_hide_a_whole_page():
    assert text('<div class="promotion"><h1>Promotion to the league</h1><p>They won.</p></div>') == "Promotion to the league\nThey won."
    assert text('<nav>menu</nav><div class="promotion"><p>They won.</p></div><footer>f</footer>') == "They won."
    assert text('<div class="promotion"><p>Buy</p></div><p>They won.</p>') == "They won."


def test_runs_decide_on_a_page_that_is_only_named(spark):
    menu = " ".join(f"entry{i}" for i in range(12))
    rows = [(i, f"http://a.example/{i}", page(f'<div class="widget"><p>{menu}</p><p>story {i} of its own</p></div>')) for i in range(4)]
    out = H.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {r.page_id: r.text for r in out.collect()} == {i: f"story {i} of its own" for i in range(4)}


def test_title_in_the_header_of_an_article():
    assert text("<header><h1>Site</h1></header><article><header><h1>The title</h1><p>By one</p><nav><h2>no</h2></nav></header><p>a</p></article>") == "The title\na"
    assert text("<article><header class='x'><div><h2>T <em>x</em></h2></div>date</header><p>a</p><footer><h3>no</h3></footer></article>") == "T x\na"
