"""Main-text extraction by the maximum-scoring subsequence of a page's tokens.

A page is a sequence of words and tags.  Words score 0 or more by the block they
stand in, tags score below 0 by their name; the scores are log odds counted
on labelled pages (pages that mark their article with ``<article>`` or
``<main>``; a bounded sample drawn by hash).  One linear scan finds the contiguous
stretch with the greatest sum, the content region.  Its text is returned
without what never belongs to an article (menus, forms, notices, comments,
scripts and so on, told by element name or by a word of class, id or role; a
so named element that holds most of the article or page is a wrapper and stays).

Blocks are joined by a line feed; white space inside a block is one blank;
character references are decoded.

Scale: a page is worked on alone next to the scan; nothing is shuffled but the
few hundred counts of the weights.

Defined cases: a NULL or empty page, or one without words, gives an empty
text; without labelled pages words score 1 and tags a little below 0; of two equally
good regions the first is taken; other columns are carried along.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import hash32

#: labelled pages that the weights are counted on (about; drawn by hash)
LABELLED_PAGES = 4_000

#: fixed values: elements by their part in a page
BLOCKS = frozenset("address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section "
                   "summary table tbody td tfoot th thead title tr ul".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("aside button datalist dialog fieldset figcaption footer form head header iframe label menu nav "
                  "noscript object option script select style svg template textarea title".split()) - {"figcaption"}
NOTICES = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                    "consent cookie cookies disqus footer header menu modal nav navbar navigation newsletter notice "
                    "popup promo promoted related share sharing sidebar social sponsor sponsored subscribe toolbar "
                    "widget".split())
#: words that leave a compound a notice (``comment-list``, ``footer-inner``); others do not (``has-sidebar``)
NEUTRAL = frozenset("area bar block body bottom box button buttons container content form inner items left link links "
                    "list main page posts primary right secondary section site slot top unit wrapper".split())
DISCUSSION = frozenset("comment comments discussion discussions disqus replies review reviews".split())
#: first words of a compound that names a state, not a thing (``has-comments``)
STATES = frozenset("can has hide is no show with without".split())
MARKS = frozenset(("article", "main"))
CLOSED_BY = {"p": BLOCKS, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
             "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "tr": frozenset(("tr",)),
             "option": frozenset(("option",))}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(?P<raw>script|style|textarea|template|noscript|iframe|svg)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
    |<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |</?[a-zA-Z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)""", re.S | re.I | re.X)
_CLASS = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z0-9]+")
_MAY_BE = re.compile(r"(?:class|id|role)\s*=", re.I)


def _notice(name: str, attrs: str) -> str:
    """``notice`` or ``discussion`` by the words of class, id and role, or nothing."""
    if not attrs or name in ("html", "body", "main"):
        return ""
    kind = ""
    for found in _CLASS.findall(attrs):
        for word in "".join(found).lower().split():
            order = _PART.findall(word)
            parts = set(order)
            # a compound is what its last word says (``user-comments``)
            if order and order[-1] in DISCUSSION and order[0] not in STATES:
                return "discussion"
            if parts & NOTICES and parts <= NOTICES | NEUTRAL:
                if parts & DISCUSSION:
                    return "discussion"
                kind = "notice"
    return kind


#: what an open element tells about its content: its name, never content, in a marked article, innermost notice
#: (a number, -1 for none), in a notice, nearest block, in a link
_Open = tuple[str, bool, bool, int, bool, str, bool]
_PAGE: _Open = ("", False, False, -1, False, "none", False)
#: only these end an open element of another name
_CLOSERS = frozenset().union(*CLOSED_BY.values())


def _scan(page: str, wrappers: frozenset[int], notices: list[tuple[int, str]]) -> Iterator[tuple[str, str, int, bool, int]]:
    """The tokens of ``tokens_of``, each with the number of the innermost notice it lies in.  ``notices`` is filled with
    the ``(outer notice, kind)`` of each; ``wrappers`` are numbers of notices that are none.

    One step a token, whatever the depth: an open element knows what holds for its content.
    """
    stack: list[_Open] = []
    count: dict[str, int] = {}
    block = 0
    for found in _TOKEN.finditer(page):
        name = found["name"]
        if found["text"] is not None:
            _, never, inside, notice, out, around, link = stack[-1] if stack else _PAGE
            yield ("never" if never else "out" if out else around + (" link" if link else ""), found["text"], block,
                   inside, notice)
        elif name:
            name = name.lower()
            _, never, inside, notice, out, around, link = stack[-1] if stack else _PAGE
            if name in BLOCKS:
                block += 1
            if found["close"]:
                if count.get(name):
                    gone = ""
                    while gone != name:
                        gone = stack.pop()[0]
                        count[gone] -= 1
            elif name not in EMPTY and not found["attrs"].endswith("/"):
                for k in range(len(stack) - 1, -1, -1) if name in _CLOSERS else ():
                    if name in CLOSED_BY.get(stack[k][0], ()):  # an open paragraph ends where a block begins
                        for gone in stack[k:]:
                            count[gone[0]] -= 1
                        del stack[k:]
                        break
                    if stack[k][0] in BLOCKS:
                        break
                _, never, inside, notice, out, around, link = stack[-1] if stack else _PAGE
                never = never or name in NEVER
                kind = _notice(name, found["attrs"])
                if kind:
                    out = out or len(notices) not in wrappers
                    notices.append((notice, kind))
                    notice = len(notices) - 1
                # a comment marked as an article marks no article of the page
                marks = name in MARKS and kind != "discussion"
                stack.append((name, never, inside or marks, notice, out, name if name in BLOCKS else around,
                              link or name == "a"))
                count[name] = count.get(name, 0) + 1
                inside = inside or marks
            yield "out tag" if never or out else "tag", name, block, inside and name not in MARKS, notice


def _wrappers(page: str) -> frozenset[int]:
    """Notices around the page's text: those that hold most words of its marked articles or, if it marks
    none, most of its words (a discussion may well be longer than the text)."""
    notices: list[tuple[int, str]] = []
    held: dict[int, list[int]] = {}
    words, marked_words = 0, 0
    for kind, value, _, marked, notice in _scan(page, frozenset(), notices):
        if kind not in ("never", "tag", "out tag"):
            n = len(value.split())
            words += n
            marked_words += n * marked
            if n and notice >= 0:
                sums = held.setdefault(notice, [0, 0])
                sums[0] += n
                sums[1] += n * marked
    for number in range(len(notices) - 1, -1, -1):  # inner notices come after those around them
        outer, sums = notices[number][0], held.get(number)
        if sums and outer >= 0:
            around = held.setdefault(outer, [0, 0])
            around[0] += sums[0]
            around[1] += sums[1]
    return frozenset(k for k, (n, marked) in held.items() if (
        2 * marked > marked_words if marked_words else 2 * n > words and notices[k][1] != "discussion"))


def tokens_of(page: str) -> Iterator[tuple[str, str, int, bool]]:
    """``(kind, value, block, marked)``: kind is ``tag`` or the scoring class of a text (``out tag`` and
    ``out`` for what is never content), block counts the block-level borders passed, marked tells if it lies in a marked article."""
    for kind, value, block, marked, _ in _scan(page, _wrappers(page) if _MAY_BE.search(page) else frozenset(), []):
        yield "out" if kind == "never" else kind, value, block, marked


def _features(page: str) -> Iterator[tuple[str, bool, int]]:
    """``(feature, marked, weight)`` of a page's tokens."""
    for kind, value, _, marked in tokens_of(page):
        if kind == "tag":
            yield f"tag {value if value in BLOCKS or value in EMPTY or value in NEVER else 'other'}", marked, 1
        elif kind not in ("out", "out tag"):
            n = len(value.split())
            if n:
                yield f"word {kind}", marked, n


def fit_weights(pages: DataFrame, html_col: str = "html", labelled_pages: int = LABELLED_PAGES) -> dict[str, float]:
    """Scores by token class: log odds of lying inside a marked article, 0 or more for words and below 0 for tags."""
    rows = pages.select(F.col(f"`{html_col}`").cast("string").alias("html")).filter(
        F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    total = rows.count()
    share = min(1.0, labelled_pages / max(1, total))
    sample = rows.filter(hash32("html") < share * float(1 << 32))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, list[int]] = {}
        for frame in frames:
            for page in frame["html"]:
                for feature, marked, n in _features(page):
                    sums.setdefault(feature, [0, 0])[marked] += n
        yield pd.DataFrame([(k, *v) for k, v in sums.items()], columns=["feature", "outside", "inside"])

    counts = (sample.mapInPandas(count, "feature string, outside long, inside long").groupBy("feature")
              .agg(F.sum("outside").alias("outside"), F.sum("inside").alias("inside")).collect())
    weights = {}
    for r in counts:  # a few hundred at most: the classes are fixed by the element names
        odds = math.log((r["inside"] + 1) / (r["outside"] + 1))
        weights[r["feature"]] = min(-0.05, odds) if r["feature"].startswith("tag ") else max(0.0, odds)
    return weights


def best_region(scores: list[float]) -> tuple[int, int]:
    """``(start, end)`` of the contiguous stretch with the greatest positive sum; empty if there is none."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(page: str | None, weights: dict[str, float]) -> str:
    tags = ("tag", "out tag")
    all_tokens = list(tokens_of(page or ""))
    tokens = [t for t in all_tokens if t[0] in tags or t[1].strip()]
    scores = []
    for kind, value, _, _ in tokens:
        if kind in tags:  # what is taken out of the region is no border of it
            scores.append(-0.05 if kind == "out tag" else weights.get(f"tag {value}", weights.get("tag other", -0.05)))
        else:
            scores.append(0.0 if kind == "out" else weights.get(f"word {kind}", 1.0) * len(value.split()))
    start, end = best_region(scores)
    # blanks between inline elements matter, so the region is read again with them
    first, last, seen, blocks = start, end, -1, {}
    for token in all_tokens:
        kind, value, block, _ = token
        if kind in tags or value.strip():
            seen += 1
        if seen >= last:
            break
        if kind not in (*tags, "out") and first <= seen:
            blocks.setdefault(block, []).append(entities.unescape(value))
        elif kind == "tag" and value == "br" and first <= seen:
            blocks.setdefault(block, []).append(" ")
    lines = (" ".join("".join(parts).split()) for _, parts in sorted(blocks.items()))
    return "\n".join(line for line in lines if line)


def extract_text(pages: DataFrame, html_col: str = "html", weights: dict[str, float] | None = None) -> DataFrame:
    """``pages`` plus ``text`` and ``n_chars`` (its code points); columns of those names are replaced."""
    fitted = fit_weights(pages, html_col) if weights is None else weights
    source = F.col(f"`{html_col}`").cast("string")

    @F.pandas_udf("string")
    def text_of(values: pd.Series) -> pd.Series:
        return pd.Series([main_text(v, fitted) for v in values], dtype=object)

    return (pages.withColumn("__text", text_of(source)).drop("text", "n_chars")
            .withColumns({"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}).drop("__text"))
