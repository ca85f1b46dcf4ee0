"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score by the element they stand in,
which is positive where articles have their words; tags score negative, the less the
more they belong to articles.  A linear scan finds the contiguous region of the highest
sum.  Elements that are no part of an article wherever they stand (menus, forms,
scripts, adverts, reader comments and the like) cost their words and are left out of the
region's text.  A name alone bars no article: names are read class by class, a form or an
element whose name only mentions such a part counts as a wrapper if it holds an article
or most of the page's words, and what a wrapper holds is left to the scan.

Weights are log odds, learned from pages that label themselves: their article or main
element says what is content.  Counts start from a prior, so pages of kinds never seen
still get sensible weights.

Defined results: NULL or empty pages, and pages without a region that scores above
zero, give an empty text.  Unclosed and stray tags are tolerated; a tag cut off at the
end of a page is dropped.  White space, a no-break space included, becomes one space;
``<br>`` and table cells part words, not blocks.  Formulas and what stands in for an object
are text of their line; drawings, frames and controls are none.  Equal pages give equal
texts; no rows give none.  Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import html as entities
import itertools
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML's elements by the part they play, and names that sites give to
# what surrounds an article.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = (
    "script style noscript template textarea svg iframe title select button annotation-xml annotation"
)
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
_APART = frozenset("br td th option".split())
_INLINE = frozenset(
    "abbr b bdi bdo big br cite code del dfn em font i img ins kbd mark q s samp small span "
    "strike strong sub sup time tt u var wbr math maction menclose merror mfrac mi "
    "mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle "
    "msub msubsup msup mtable mtd mtext mtr munder munderover none semantics object canvas".split()
)
_NEVER = frozenset("aside dialog footer head menu nav".split())
_PAGE_PARTS = frozenset("article footer h1 header main nav".split())
_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
    "search status toolbar".split()
)
_AROUND = frozenset(
    "ad ads adsense advert adverts advertisement advertising alert banner breadcrumb "
    "breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus footer "
    "gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "overlay pager pagination popup promo promotion recommended related search share sharing "
    "sidebar sidenav signup skip social sponsor sponsored subscribe toolbar widget".split()
)
# Words that say where such a part stands or what shape it has, and words before a name
# that speaks of an element's state instead of its part.
_PLACE = frozenset(
    "area bar block bottom box button buttons col column group inner item items left link "
    "links list outer panel posts primary right secondary section site slot top unit".split()
)
_STATE = frozenset("has hide is js no not show supports with without".split())
# Words seen inside and outside of articles by their element, before any page is.
_PRIOR = {
    "p": (30, 3), "blockquote": (10, 2), "pre": (10, 2), "h1": (10, 2), "h2": (10, 3),
    "h3": (10, 4), "h4": (8, 4), "article": (20, 1), "main": (20, 2), "section": (8, 4),
    "li": (6, 8), "a": (3, 12), "td": (6, 6), "div": (8, 6), "figcaption": (6, 3),
    "dd": (8, 4), "dt": (8, 4), "body": (6, 6),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<svg(?=[\s/])[^>]*/>"
    rf"|<({_RAW.replace(' ', '|')})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([a-z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Score of a word that is no part of an article.
_OUTSIDE = -2.0


#: How an element is barred: not at all, as a wrapper may be, by its name, in any case.
_OPEN, _MENTIONED, _NAMED, _BARRED = range(4)


def _named(value: str) -> int:
    """What the names in a class or id say."""
    worst = _OPEN
    for name in value.split():
        words = [w.lower() for w in _NAME.findall(name)]
        if words and words[0] not in _STATE and not _AROUND.isdisjoint(words):
            whole = all(w in _AROUND or w in _PLACE for w in words)
            worst = max(worst, _NAMED if whole else _MENTIONED)
    return worst


def _bar(name: str, attributes: str, within: bool) -> int:
    """How far an element belongs to no article; ``within``: it stands inside one."""
    if name in _NEVER or (name == "header" and not within):
        return _BARRED
    worst = _MENTIONED if name == "form" else _OPEN
    if not attributes.strip() or name in ("html", "body", "article", "main"):
        return worst
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next(filter(None, values), "")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return _BARRED
        if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return _BARRED
        # A form may say that it is one.
        if key == "role" and value.lower() in _ROLES and value.lower() != name:
            return _BARRED
        if key in ("class", "id"):
            title = within and name.startswith("h") and value.lower() == "header"
            worst = max(worst, _OPEN if title else _named(value))
    return worst


class _Wrapper:
    """An element that is barred unless what it holds says otherwise."""

    def __init__(self, bar: int, form: bool, height: int, begin: int) -> None:
        self.bar, self.form, self.height, self.begin, self.end = bar, form, height, begin, None
        self.holds = self.page_part = False


def _lifted(wrapper: _Wrapper, words: list[int]) -> bool:
    """``words``: words of the page before each of its parts."""
    if wrapper.holds or wrapper.bar == _NAMED:
        return wrapper.holds
    most = 2 * (words[wrapper.end] - words[wrapper.begin]) > words[-1]
    return most and (wrapper.page_part or not wrapper.form)


def parts(page: str) -> list[tuple[str, str, bool, bool]]:
    """``kind, value, excluded, inside`` of texts (with their element first: ``p|text``)
    and tags in page order; ``inside`` an article or main element."""
    found: list[tuple[str, str, bool, bool]] = []
    stack: list[str] = []
    barred = article = 0  # height of the stack at the outermost such element, plus one
    wrappers: list[_Wrapper] = []
    around: list[_Wrapper] = []  # those that are open
    at = 0

    def element() -> str:
        return next((n for n in reversed(stack) if n not in _INLINE), "body")

    def cut(height: int) -> None:
        nonlocal barred, article
        del stack[height:]
        barred = 0 if barred > height else barred
        article = 0 if article > height else article
        while around and around[-1].height > height:
            around.pop().end = len(found)

    for token in _TOKEN.finditer(page):
        if token.start() > at:
            found.append(("text", f"{element()}|{page[at:token.start()]}", bool(barred), bool(article)))
        at = token.end()
        closing, name, attributes = token[2], token[3], token[4]
        if name is None:
            closing, name, attributes = token[5], token[6], token[7]
        if name is None or page[at - 1] != ">":  # a comment, raw text, or cut off
            continue
        name = name.lower()
        if closing:
            found.append(("tag", name, bool(barred), bool(article)))
            if name in stack:
                cut(len(stack) - 1 - stack[::-1].index(name))
            continue
        if name in _BLOCK:  # a block ends an open paragraph
            for height in range(len(stack) - 1, -1, -1):
                if stack[height] == "p":
                    cut(height)
                    break
                if stack[height] in _BLOCK:
                    break
        if name not in _VOID and not attributes.endswith("/"):
            stack.append(name)
            is_main = name == "main" or re.search(
                r"role\s*=\s*[\"']?main|itemprop\s*=\s*[\"']?articleBody", attributes, re.I
            )
            if not barred and (name in _PAGE_PARTS or is_main):
                for outer in reversed(around):
                    outer.page_part = True
                    if outer.bar == _NAMED and not is_main:
                        break  # an article among comments, or a teaser
                    outer.holds |= bool(name == "article" or is_main)
            if not article and (name == "article" or is_main):
                article = len(stack)
            bar = _OPEN if barred else _bar(name, attributes, bool(article))
            if bar == _BARRED:
                barred = len(stack)
            elif bar:
                around.append(_Wrapper(bar, name == "form", len(stack), len(found)))
                wrappers.append(around[-1])
        found.append(("tag", name, bool(barred), bool(article)))
    if at < len(page):
        found.append(("text", f"{element()}|{page[at:]}", bool(barred), bool(article)))
    cut(0)
    return _settle(found, wrappers) if wrappers else found


def _settle(
    found: list[tuple[str, str, bool, bool]], wrappers: list[_Wrapper]
) -> list[tuple[str, str, bool, bool]]:
    """The parts of a page, those in wrappers that stay barred marked."""

    def covered(chosen: list[_Wrapper]) -> list[bool]:
        steps = [0] * (len(found) + 1)
        for w in chosen:
            steps[w.begin] += 1
            steps[w.end] -= 1
        return [total > 0 for total in itertools.accumulate(steps)]

    named = covered([w for w in wrappers if w.bar == _NAMED and not w.holds])
    words = [0]
    for (kind, value, barred, _), apart in zip(found, named, strict=False):
        counts = kind == "text" and not barred and not apart
        words.append(words[-1] + (len(value.partition("|")[2].split()) if counts else 0))
    out = covered([w for w in wrappers if not _lifted(w, words)])
    return [
        (kind, value, barred or apart, inside)
        for (kind, value, barred, inside), apart in zip(found, out, strict=False)
    ]


def observe(page: str) -> dict[tuple[str, str], list[int]]:
    """Words by element and tags by name, inside and outside of a labelled page's article."""
    seen: dict[tuple[str, str], list[int]] = {}
    labelled = False
    for kind, value, barred, inside in parts(page):
        labelled |= inside
        if kind == "text":
            value, _, text = value.partition("|")
            n = 0 if barred else len(text.split())
        else:
            n = 1
        if n:
            seen.setdefault((kind, value), [0, 0])[0 if inside and not barred else 1] += n
    return seen if labelled else {}


def learn(pages: DataFrame, html_col: str) -> dict[tuple[str, str], float]:
    """Weights from the counts over all pages that label themselves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, str], list[int]] = {}
        for batch in batches:
            for value in batch.column(0):
                for key, (a, b) in observe(value.as_py() or "").items():
                    sums = total.setdefault(key, [0, 0])
                    sums[0] += a
                    sums[1] += b
        rows = [(*k, *v) for k, v in total.items()]
        if rows:
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["kind", "name", "inside", "outside"],
            )

    known = sorted(_BLOCK | _INLINE | _VOID | _APART | {"a"})
    found = (
        pages.select(F.col(html_col).cast("string"))
        .mapInArrow(count, "kind string, name string, inside bigint, outside bigint")
        .where(F.col("name").isin(known))  # so the table has a bounded number of rows
        .groupBy("kind", "name").agg(F.sum("inside").alias("a"), F.sum("outside").alias("b"))
    )
    return weigh({(r.kind, r["name"]): (r.a, r.b) for r in found.collect()})


def weigh(counts: dict[tuple[str, str], tuple[int, int]]) -> dict[tuple[str, str], float]:
    """Log odds by element for words, within -2 and 2; by name for tags, below zero."""
    out = {}
    for name in {n for k, n in counts if k == "text"} | set(_PRIOR):
        a, b = counts.get(("text", name), (0, 0))
        prior = _PRIOR.get(name, (4, 4))
        out["text", name] = max(-2.0, min(2.0, math.log((a + prior[0]) / (b + prior[1]))))
    for (kind, name), (a, b) in counts.items():
        if kind == "tag":
            out["tag", name] = max(-3.0, min(-0.05, math.log((a + 1) / (b + 1)) - 0.5))
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous run with the highest sum above 0, the first and
    shortest of equals; (0, 0) if there is none."""
    best, region, total, begin = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, k
        total += score
        if total > best:
            best, region = total, (begin, k + 1)
    return region


def extract(page: str | None, weights: dict[tuple[str, str], float]) -> str:
    """The text of the best region, one line for each block."""
    found, scores = [], []
    for kind, value, barred, _ in parts(page or ""):
        if kind == "text":
            name, _, text = value.partition("|")
            words = len(text.split())
            score = _OUTSIDE if barred else weights.get(("text", name), 0.5)
            found.append(("" if barred else None, text, barred))
            scores.append(score * words)
        else:
            found.append((value, "", barred))
            scores.append(weights.get((kind, value), -0.5))
    begin, end = best_region(scores)
    blocks, line = [], []

    def close() -> None:
        words = entities.unescape("".join(line)).split()
        if words:
            blocks.append(" ".join(words))
        line.clear()

    for name, text, barred in found[begin:end]:
        if name is None:
            line.append(text)
        elif name in _BLOCK:
            close()
        elif name in _APART or (name == "" and barred):
            line.append(" ")
    close()
    return "\n".join(blocks)


def main_text(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, by weights learned from all."""
    weights = learn(pages, html_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [extract(x.as_py(), weights) for x in part.column(2)]
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    columns = [F.col(id_col).cast("bigint"), F.col(url_col).cast("string"), F.col(html_col).cast("string")]
    return pages.select(*columns).mapInArrow(
        rows, "page_id bigint, url string, text string, n_chars bigint"
    )
