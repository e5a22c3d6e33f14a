"""The main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one for each block element. The length of text in a
window of a few lines, slid over the page, rises steeply where the article begins (a
surge) and falls to almost nothing where it ends (a dive); lines between are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import only, small_slices
from .html_blocks import Block, blocks

# Elements and words of class and id names that mark what is not the article.
ASIDE = frozenset("nav header footer aside form button dialog menu select figure fieldset head script style noscript".split())
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|"
    r"nav|navbar|navigation|menu|breadcrumb|breadcrumbs|sidebar|side|aside|widget|header|masthead|footer|foot|"
    r"comment|comments|commentlist|respond|reply|replies|disqus|discussion|cookie|cookies|consent|gdpr|notice|notices|alert|"
    r"popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|related|recommended|"
    r"pagination|pager|copyright|legal|disclaimer|complementary|contentinfo|hidden)(?=$|[\s_-])"
)
ARTICLE = re.compile(r"(?:^|\s)(?:articlebody|main)(?=$|\s)")


def aside(block: Block, inside: int) -> bool:
    """Whether an element around the block, from ``inside`` on, marks it as not the article."""
    for depth, (name, marks) in enumerate(block.around):
        if name in ASIDE and not (name in ("header", "figure") and depth > inside >= 0):
            return True
        if marks and name not in ("html", "body", "article", "main") and MARKS.search(marks):
            return True
    return False


def article_depth(block: Block) -> int:
    """How deep the element is that marks the article around the block; -1 without one."""
    for depth, (name, marks) in enumerate(block.around):
        if name in ("article", "main") or marks and ARTICLE.search(marks):
            return depth
    return -1


def surges(lengths: np.ndarray, window: int, surge: float, dive: float, steady: int) -> np.ndarray:
    """Which lines lie between a surge and the next dive.

    The sum over the ``window`` lines from a line on is its block length. A region
    begins where that passes ``surge`` and stays above ``dive`` for the following ``steady``
    lines, up to its own last line with text, and ends before the first line from which it is at most ``dive``.
    """
    n = len(lengths)
    sums = np.convolve(np.concatenate([lengths, np.zeros(window - 1)]), np.ones(window), "valid")[:n] if n else lengths
    keep, inside = np.zeros(n, bool), False
    for i in range(n):
        # A region of one or two lines has no more to be steady on.
        own = i + np.flatnonzero(lengths[i: i + window] > 0).max(initial=0)
        if not inside and sums[i] > surge and lengths[i] > 0 and (sums[i + 1: min(i + steady, own) + 1] > dive).all():
            inside = True
        elif inside and sums[i] <= dive:
            inside = False
        keep[i] = inside
    return keep


def page_text(page: str, window: int = 3, surge: float = 86, dive: float = 0) -> str:
    """The main text of one page; empty if there is none.

    Lines of elements marked as navigation, notices, adverts, forms, comments and the
    like have length 0, so have lines that are mostly links. Where the page itself marks
    its article (``article``, ``main``, ``articleBody``), lines outside have length 0 too and
    any text inside is a surge; else a surge needs ``surge`` characters in a window, or
    half of the largest window on pages that never have so many.
    """
    lines = blocks(page)
    depths = [article_depth(b) for b in lines]
    marked = any(d >= 0 and not aside(b, d) for b, d in zip(lines, depths))
    lengths = np.zeros(len(lines))
    for i, (block, depth) in enumerate(zip(lines, depths)):
        if marked and depth < 0 or aside(block, depth):
            continue
        size = len(block.text)
        if not marked and 2 * block.linked > size:
            continue
        lengths[i] = size
    if marked:
        surge = 0
    elif len(lines):
        surge = min(surge, np.convolve(lengths, np.ones(window)).max() / 2)
    keep = surges(lengths, window, surge, dive, 0 if marked else 2) & (lengths > 0)
    return " ".join(b.text for b, k in zip(lines, keep) if k)


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", window: int = 3,
              surge: float = 86) -> DataFrame:
    """``(page_id, url, text)``: the main text of every page.

    Null and empty pages have the empty text, as have pages without an article. Repeated
    rows, null ids and urls stay as they are; other columns are not read. A page is one
    row and one piece of work, however long it is; nothing is dropped or capped.
    """
    pages = only(pages, page_id=page_id, url=url, html=html)
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "html"):
            texts = [page_text(page or "", window, surge) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return pages.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
