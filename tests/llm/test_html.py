import itertools
import random

import pytest

from weektide.llm.html import best_region, extract, learn, main_text, observe, parts, weigh

WEIGHTS = weigh({})
BODY = "<p>" + "</p><p>".join(f"Sentence {k} of the article has a number of words." for k in range(6)) + "</p>"
TEXT = "\n".join(f"Sentence {k} of the article has a number of words." for k in range(6))


@pytest.mark.parametrize("before, after", [
    ("<nav><ul><li><a href='/a'>Home page of this site</a></li></ul></nav>", "<footer>&copy; 2020 All rights</footer>"),
    ("<header><h1>The Site</h1><p>Some words on the site</p></header>", "<aside><p>Other things to read now</p></aside>"),
    ("<div class='cookie-notice'><p>We use cookies on this site, as all do.</p></div>", ""),
    ("<form><p>Write your name here please</p><input name=q></form>", "<script>if (a < b) { document.write('<p>no no</p>') }</script>"),
    ("<style>p > a { color: red }</style><!-- <p>hidden words</p> -->",
     "<section id='comments'><h2>Comments</h2>" + "<p>I think that this is a very long comment of a reader.</p>" * 30 + "</section>"),
    ("<ul class=menu><li><a href=x>One</a><li><a href=y>Two</a></ul>", "<div role='contentinfo'>Imprint and so on</div>"),
    ("<div id='sidebarLeft'><p>" + "Latest news in brief. " * 30 + "</p></div>", "<div style='display: none'>unseen words</div>"),
])
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div id=content>{}</div>", "{}"])
def test_article_without_its_surroundings(before, after, wrap):
    page = f"<html><head><title>A title</title></head><body>{before}{wrap.format(BODY)}{after}</body></html>"
    assert extract(page, WEIGHTS) == TEXT


def test_boilerplate_within_the_article():
    page = f"<article>{BODY}<div class='ad'>Buy this thing now</div>{BODY}</article>"
    assert extract(page, WEIGHTS) == TEXT + "\n" + TEXT


def test_references_spaces_and_blocks():
    page = "<article><h1> A&amp;B </h1><p>one&nbsp;\n two<br>three <b>fo</b>ur &lt;x&gt; &#233;</p><p> </p></article>"
    assert extract(page, WEIGHTS) == "A&B\none two three four <x> é"


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!-- a", "<script>x", "<nav>a b c</nav>", "</p></div>"])
def test_nothing_there(page):
    assert extract(page, WEIGHTS) == ""


def test_broken_markup():
    assert extract("<article><p>one two three<p><b>four five <p>six", WEIGHTS) == "one two three\nfour five\nsix"
    assert extract("<article><p>a 'quoted word<p class='x>y'>b c</article><foo", WEIGHTS).startswith("a 'quoted word")


def test_best_region_against_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-2, -1, -0.5, 0, 0.5, 1, 3]) for _ in range(rng.randint(0, 12))]
        sums = [sum(scores[a:b]) for a, b in itertools.combinations(range(len(scores) + 1), 2)]
        begin, end = best_region(scores)
        assert sum(scores[begin:end]) == max([0, *sums])


def pages(spark, rows):
    schema = "page_id bigint, url string, html string, text string, n_chars string, kind string"
    return spark.createDataFrame([(*r, "?", "?", "?") for r in rows], schema)


def test_all_pages(spark):
    page = f"<body><nav><a href=x>one two</a></nav><article>{BODY}</article></body>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", ""), (3, "w", "<p>" + "word " * 200_000)]
    got = main_text(pages(spark, rows), "page_id", "url", "html").collect()
    want = [(1, "u", TEXT), (1, "u", TEXT), (2, None, ""), (None, "v", ""), (3, "w", ("word " * 200_000).strip())]
    assert sorted(((r.page_id, r.url, r.text) for r in got), key=str) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text) for r in got)
    assert main_text(pages(spark, []), "page_id", "url", "html").collect() == []


def test_weights_come_from_labelled_pages(spark):
    rows = [(k, "u", f"<body><div>junk junk junk</div><article>{BODY}</article><div>more</div></body>") for k in range(20)]
    learned = learn(pages(spark, rows), "html")
    assert learned["text", "div"] < WEIGHTS["text", "div"] and learned["text", "p"] >= WEIGHTS["text", "p"]
    assert learned["tag", "div"] < learned["tag", "p"] < 0
    assert observe("<p>no label</p>") == {}


WRAPPERS = [
    "<div class='container has-sidebar'>{}</div>", "<div class='post no-comments'>{}</div>",
    "<form id='aspnetForm' method=post>{}</form>", "<div class='social-wrapper'>{}</div>",
    "<div id='page-header-fixed'>{}</div>", "<div class='widget'><main>{}</main></div>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main>{}</main>", "<h1>Title</h1><div>{}</div>"])
def test_wrappers_keep_their_article(wrapper, inner):
    before = "<nav><a href=x>Home page</a></nav><div class='share'>Share this with all</div>"
    after = "<div class='comments'><article><p>" + "A reader writes this. " * 60 + "</p></article></div>"
    page = f"<body>{before}{wrapper.format(before + inner.format(BODY) + after)}{after}</body>"
    assert extract(page, WEIGHTS) == ("Title\n" if "<h1>" in inner else "") + TEXT


@pytest.mark.parametrize("part", [
    "<form class='search-box'><p>Write here what you seek, or choose from the list</p></form>",
    "<div class='site-header-fixed'><p>Words at the head of each page of this site</p></div>",
    "<section class='comments-section'><article><p>" + "A reader's words. " * 90 + "</p></article></section>",
    "<div class='related-posts'><article><p>Another article's teaser</p></article></div>",
    "<div class='share-wrapper'><div class='comments'><article><p>I think so</p></article></div></div>",
])
def test_parts_that_hold_no_article_stay_out(part):
    for page in (f"{part}<article>{BODY}</article>", f"<article>{BODY}</article>{part}", f"<div>{BODY}</div>{part}"):
        assert extract(page, WEIGHTS) == TEXT


def test_a_page_that_is_a_form_has_no_article():
    assert extract("<body><form><p>Your name and your password, please</p></form></body>", WEIGHTS) == ""


def test_formulas_and_fallback_content_are_text():
    page = (
        "<article><p>The value <math>x = 4<annotation>x=4</annotation></math> holds, as "
        "<math><mi>y</mi> <mo>&lt;</mo> <mn>2</mn></math> does.</p><p>Seen <object data=a>in words</object> "
        "<svg class=a/>by <svg><text>no</text></svg>all <button-like>of us</button-like></p></article>"
    )
    assert extract(page, WEIGHTS) == "The value x = 4 holds, as y < 2 does.\nSeen in words by all of us"


def test_whole_pages_against_brute_force():
    """The text is that of the best of all runs of parts, tried one by one."""
    rng = random.Random(2)
    pieces = ["<p>", "</p>", "<div class=ad>", "<div>", "</div>", "<article>", "</article>", "<li>", "<br>",
              "one two", " three ", "four five six seven", "<nav>", "</nav>", "<form>", "</form>", "<td>", "&amp;"]
    for _ in range(400):
        page = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        seen = parts(page)
        scores = []
        for kind, value, barred, _ in seen:
            if kind == "tag":
                scores.append(WEIGHTS.get(("tag", value), -0.5))
            else:
                name, _, text = value.partition("|")
                scores.append(len(text.split()) * (-2.0 if barred else WEIGHTS.get(("text", name), 0.5)))
        runs = [(a, b) for a in range(len(seen)) for b in range(a + 1, len(seen) + 1)]
        best = max((sum(scores[a:b]) for a, b in runs), default=0)
        tied = [r for r in runs if abs(sum(scores[r[0]:r[1]]) - best) < 1e-9] if best > 1e-9 else [(0, 0)]
        texts = set()
        for a, b in tied:
            out = ""
            for kind, value, barred, _ in seen[a:b]:
                if kind == "text":
                    out += " " if barred else value.partition("|")[2].replace("&amp;", "&")
                elif value in ("p", "div", "article", "li", "nav", "form"):
                    out += "\n"
                elif value in ("br", "td"):
                    out += " "
            lines = [" ".join(x.split()) for x in out.split("\n")]
            texts.add("\n".join(x for x in lines if x))
        assert extract(page, WEIGHTS) in texts, page
