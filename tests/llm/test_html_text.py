"""Extraction against the marked articles of the supplied pages, and on pages of other shapes."""

import html
import math
import random
import re
import time

import pytest

from eventpulse.llm.html_text import extract_text, main_text
from eventpulse.llm.queries import op3

LONG = "A sentence that goes on for a while, as articles do, and then some more words to fill the line. " * 3
SF_DIR = "/root/testdata/sf0.01"


def test_supplied_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    got = {r.page_id: r for r in op3(spark, SF_DIR).collect()}
    assert set(got) == set(pages)
    for page_id, page in pages.items():
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = [re.sub(r"<[^>]*>", " " if "<br>" in b else "", b) for b in re.split(r"</?(?:h1|p)>", article)]
        blocks = [" ".join(html.unescape(b).split()) for b in blocks]
        assert got[page_id].text == "\n\n".join(b for b in blocks if b)
        assert got[page_id].n_chars == len(got[page_id].text)


def clean(text):
    return " ".join(text.split())


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("<nav>a</nav>", ""),
        ("just   words\n here", "just words here"),
        (f"<body><header>Site</header><div class='menu'><a>x</a></div><main><h1>T</h1><p>{LONG}<p>Er.</main><aside>no</aside>", f"T\n\n{clean(LONG)}\n\nEr."),
        (f"<article><h1>T</h1><p>{LONG}</p><div class='comments'><article><p>{LONG}</p></article></div></article>", f"T\n\n{clean(LONG)}"),
        (f"<div class=cookie-notice><p>{LONG}</div><article><p>a&amp;b &lt;c&gt; &eacute;&nbsp;x</p></article>", "a&b <c> é x"),
        (f"<div class=ad>buy<article><p>{LONG}</p></article>", clean(LONG)),
        (f"<div id=nav><ul><li><a>one</a></ul></div><div><h2>T</h2><p>{LONG}</p><p>{LONG}</p></div><form>{LONG}</form><footer>f</footer>", f"T\n\n{clean(LONG)}\n\n{clean(LONG)}"),
        (f"<article><p>{LONG}</p><ul><li>Er.</li><li>Is.</li><li>It.</li><li>A.</li></ul></article>", f"{clean(LONG)}\n\nEr.\n\nIs.\n\nIt.\n\nA."),
        (f"<body class='has-sidebar'><div class='no-sidebar'><p>{LONG}</div>", clean(LONG)),
        (f"<p>{LONG}</p><script>var a = '<p>{LONG}</p>'</script><style>p{{}}</style><!-- {LONG} -->", clean(LONG)),
        (f"<article><p>one <b>two</b>three<br>four <span class=ad>no</span></p><p>{LONG}", f"one twothree four\n\n{clean(LONG)}"),
    ],
)
def test_shapes(page, want):
    assert main_text(page) == want


def test_nulls_repeats_and_clashing_names(spark, frame):
    rows = [(1, "u", "<p>x y</p>"), (1, "u", "<p>x y</p>"), (None, None, None), (2, "v", ""), (3, None, f"<p>{'x ' * 300_000}")]
    got = extract_text(frame(rows, "page_id bigint, url string, html string").selectExpr("*", "'c' AS text", "1 AS n_chars"))
    found = sorted(((r.page_id, r.url, r.n_chars) for r in got.collect()), key=str)
    assert found == sorted([(1, "u", 3), (1, "u", 3), (None, None, 0), (2, "v", 0), (3, None, 599_999)], key=str)


def test_empty_table(frame):
    assert extract_text(frame([], "page_id bigint, url string, html string")).collect() == []


@pytest.mark.parametrize(
    "page, want",
    [
        (f"<article><h1><a href=permalink>Title</a></h1><p>{LONG}</p><p><a href=x>All of it</a></p></article>", f"Title\n\n{clean(LONG)}\n\nAll of it"),
        (f"<article><p>{LONG}</p><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></article>", f"{clean(LONG)}\n\nOne\n\nTwo"),
        ("<article><p><a href=x>Nothing but a link</a></p></article>", "Nothing but a link"),
        (f"<body><a name=top><p>{LONG}</p><p>{LONG}</p>", f"{clean(LONG)}\n\n{clean(LONG)}"),
        (f"<body><a href=x><p>{LONG}</p><p>{LONG}</p>", f"{clean(LONG)}\n\n{clean(LONG)}"),
        (f"<body><a href=x>here<p>{LONG}</p><p>{LONG} <a href=y>z</a></p>", f"{clean(LONG)}\n\n{clean(LONG)} z"),
        (f"<body><p>{LONG}</p><p>{LONG}</p><a href=x><div>{LONG}</div><div>{LONG}</div></a></body>", f"{clean(LONG)}\n\n{clean(LONG)}"),
        (f"<body><a href=x>a<a>{LONG}</a>", f"a{clean(LONG)}"),
        (f"<article><p>{LONG}</p><section id=discussion><h2>Discussion</h2><p>{LONG}</p></section></article>", f"{clean(LONG)}\n\nDiscussion\n\n{clean(LONG)}"),
        (f"<article><p>{LONG}</p><p class=reply>{LONG}</p></article>", f"{clean(LONG)}\n\n{clean(LONG)}"),
        (f"<article><p>{LONG}</p><ol class=replies><li>{LONG}</ol><div id=discussion-thread>{LONG}</div></article>", clean(LONG)),
        (f"<article><p>{LONG}</p><div id=respond class=comment-respond>{LONG}</div></article>", clean(LONG)),
    ],
)
def test_links_and_discussions(page, want):
    assert main_text(page) == want


NAMES = (
    "sharing-economy related-work notice-period skip-list hidden-figures ad-hoc login-guide banner-history social-history"
    " promotion-theory widget-design"
).split()


@pytest.mark.parametrize("name", NAMES)
def test_a_section_named_after_its_heading_is_text(name):
    """Inside an article a name is a box's only if all of it says so."""
    page = '<article><h1>Title</h1><section id="{0}" class="part {0}"><h2>Head</h2><p>Some words.</p></section></article>'
    assert main_text(page.format(name)) == "Title\n\nHead\n\nSome words."
    for box in ("related-posts", "share-buttons", "newsletter", "cookie-banner", "adSlot"):
        assert main_text(page.format(box)) == "Title"


def test_every_block_of_an_article_stays():
    tags = "<span></span>" * 200
    page = f"<aside>x</aside><article>{tags}Ok<aside>y</aside><p>{'long text ' * 500}</p><p>end</p></article>"
    assert main_text(page).split("\n\n")[0] == "Ok" and main_text(page).endswith("\n\nend")


def test_deep_nesting_takes_little_time():
    for page in ("<body>" + "<i>" * 200_000 + "text", "<body>" + "<i>x</p></li></b>" * 60_000, "<div>" * 100_000 + "text" + "</div>" * 100_000):
        start = time.perf_counter()
        main_text(page)
        assert time.perf_counter() - start < 20


def test_smoothing_against_plain_sums():
    """Pages without an article: values, Gaussian and threshold, written out."""
    dice = random.Random(9)
    for _ in range(60):
        blocks = [(dice.choice([1, 3, 10, 60, 300, 900]), dice.choice([0, 0, 1, 5, 40])) for _ in range(dice.randint(1, 14))]
        page = "".join(f"<div>{'<b></b>' * k}{chr(97 + i) * n}</div>" for i, (n, k) in enumerate(blocks))
        tags = [(1 if i == 0 else 2) + 2 * k for i, (_, k) in enumerate(blocks)]  # its own and the end of the one before
        value = [math.log(1 + n / (1 + t)) for (n, _), t in zip(blocks, tags)]
        weight = [math.exp(-0.5 * d * d) for d in range(-3, 4)]
        smooth = [
            sum(w / sum(weight) * value[i + d] for d, w in zip(range(-3, 4), weight) if 0 <= i + d < len(value)) for i in range(len(value))
        ]
        least = 0.4 * sum(smooth) / len(smooth)
        want = [chr(97 + i) * n for i, (n, _) in enumerate(blocks) if smooth[i] >= least]
        assert main_text(page) == "\n\n".join(want)
