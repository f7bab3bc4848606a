"""Main text of web pages as the maximum-scoring subsequence of words and tags.

A page becomes a sequence of words and tags. Words score positive, by the kind of block that they stand
in; tags score negative, by their name and by the names that they carry. One linear scan finds the
contiguous stretch with the best sum: the content region. The weights are learnt from labelled pages
(``labelled_pages``) by an averaged perceptron on that very scan: where the scan finds another region
than the page's, the weights of its tokens go down and those of the right region's go up; words never
fall below a small positive score and tags never rise above zero.

Where the region has nearly all words of the largest element around it, it is that element, so that a
short paragraph at either end is not lost. An element inside the region, with all in it, is left out where its name and the names it carries speak
against it, by log odds counted in the same pages (an advert amid the article).

Character references are decoded, white space within a block becomes one space, blocks are joined by
a line feed; scripts, styles and comments are never text. Null, empty or textless pages give the empty
string. Tags that are never closed, and tags cut off at the end of a page, are taken as they come; a
page is read in one pass whatever its length. Extra columns of the table don't matter.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled_pages import PAGES
from .labelled_pages import pages as labelled
from .tables import ship

#: Fixed values of HTML: elements that hold no text, that have no end tag, and that don't break a line.
TEXTLESS = frozenset("script style noscript template iframe object select option canvas audio video head title".split())
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("script style noscript template a abbr acronym b bdi bdo big cite code data dfn em font i img kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr br ins del input math mi mn mo mrow msup msub mfrac msqrt mtext svg g path text tspan".split())
#: Blocks whose start ends a p that is still open.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

#: Share of an element's words from which the region is all of it.
WHOLE = 0.6
#: How many labelled pages are made, how often they are gone through, the margin a word that the
#: region is to win by, the least score of a word, and the odds from which an element is left out.
LABELLED, ROUNDS, MARGIN, LEAST, AGAINST = 600, 20, 1.0, 0.05, 2.0

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<!--|<[!?/][^>]*+>")
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")


def tokens(page: str) -> Iterator[tuple[str, str, tuple[str, ...]]]:
    """("text", text, ()), ("open", name, marks) or ("close", name, ()); marks are class, id and role names,
    of each its runs of letters joined by hyphens."""
    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if not m:
            rest = page[at:]
            cut = re.search(r"<(?:/?[a-zA-Z]|!)[^>]*+$", rest)  # a tag cut off at the end
            yield "text", rest[: cut.start()] if cut else rest, ()
            return
        if m.start() > at:
            yield "text", page[at : m.start()], ()
        at = m.end()
        if m[0] == "<!--":
            end = page.find("-->", at)
            at = n if end < 0 else end + 3
            continue
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            yield "close", name, ()
            continue
        rest = m[3] if m[2] else m[6]
        marks = tuple("-".join(p) for a in _ATTRIBUTE.finditer(rest) for m in (a[2] or a[3] or a[4] or "").lower().split() if (p := _PART.findall(m))) if "=" in rest else ()
        yield "open", name, marks
        if name in RAW and not rest.endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            at = n if not end else end.end()
            yield "close", name, ()


Token = tuple[tuple[str, ...], int, int, int]


class Page:
    """A page as a sequence: for each token its features, how many words it is (0: a tag), its block and
    its element; and its blocks: text parts and the elements around."""

    def __init__(self, page: str):
        self.tokens: list[Token] = []
        self.blocks: list[tuple[list[str], int]] = []
        #: Elements: name, marks, element around (-1: none).
        self.elements: list[tuple[str, tuple[str, ...], int]] = []
        stack: list[int] = []
        open_of: Counter[str] = Counter()
        textless, fresh, inside = 0, True, "body"

        def end(name: str) -> None:
            nonlocal textless
            while True:
                e = stack.pop()
                self._tag("</", *self.elements[e][:2], e)
                open_of[self.elements[e][0]] -= 1
                textless -= self.elements[e][0] in TEXTLESS
                if self.elements[e][0] == name:
                    return

        for kind, value, marks in tokens(page):
            if kind == "text":
                n = 0 if textless else len(value.split())
                if textless or (fresh and not n):
                    continue
                if fresh:
                    inside = next((self.elements[e][0] for e in reversed(stack) if self.elements[e][0] not in INLINE), "body")
                    self.blocks.append(([], stack[-1] if stack else -1))
                    fresh = False
                self.blocks[-1][0].append(value)
                if n:
                    self.tokens.append((("word", f"word in {inside}", "word in a link" if open_of["a"] else "word in no link"), n, len(self.blocks) - 1, stack[-1] if stack else -1))
                continue
            if value not in INLINE:
                fresh = True
            elif value == "br" and not fresh:
                self.blocks[-1][0].append(" ")
            if kind == "open":
                if value in ENDS_P and open_of["p"]:
                    end("p")
                self._tag("<", value, marks, (stack[-1] if stack else -1) if value in VOID else len(self.elements))
                if value not in VOID:
                    self.elements.append((value, marks, stack[-1] if stack else -1))
                    stack.append(len(self.elements) - 1)
                    open_of[value] += 1
                    textless += value in TEXTLESS
            elif open_of[value]:
                end(value)

    def _tag(self, side: str, name: str, marks: tuple[str, ...], e: int) -> None:
        """A tag's features: its name, also together with the tag before it, and the names it carries."""
        before = self.tokens[-1][0][0] if self.tokens else ""
        self.tokens.append(((side + name, f"{before} {side}{name}", *(f"{side}.{x}" for x in names(marks))), 0, -1, e))


def names(marks: tuple[str, ...]) -> list[str]:
    """The different parts of an element's marks, and the first four letters of the longer ones."""
    parts = dict.fromkeys(p for m in marks for p in m.split("-"))
    return [*parts, *dict.fromkeys(f"{p[:4]}*" for p in parts if len(p) > 4)]


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous stretch with the largest sum; (0, 0) if none is positive."""
    best, best_sum, start, total = (0, 0), 0.0, 0, 0.0
    for at, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, at
        total += s
        if total > best_sum:
            best, best_sum = (start, at + 1), total
    return best


class Weights:
    """Scores of words and tags, and log odds of names on elements to be left out."""

    def __init__(self, marked: list[str], rounds: int = ROUNDS):
        known = [self._marked(p) for p in marked]
        left, kept = Counter(), Counter()
        for page, (first, last) in known:
            among, outside = ({b for _, _, b, _ in t if b >= 0} for t in (page.tokens[first:last], page.tokens[:first] + page.tokens[last:]))
            main = {b for b in among if "\x01" in "".join(page.blocks[b][0])}
            good = {e for b in main for e in self._around(page, page.blocks[b][1])}
            for e in good:
                kept.update(self._evidence(page, e))
            #: Of what is left out, the element that has no main text and stands in one that has: what is inside it proves nothing.
            for e in {[e for e in self._around(page, page.blocks[b][1]) if e not in good][-1] for b in (among | outside) - main if page.blocks[b][1] not in good}:
                left.update(self._evidence(page, e))
        self.against = {k: log((left[k] + 0.5) / (kept[k] + 0.5)) for k in {*left, *kept}}
        self.of: dict[str, float] = {}
        total: Counter[str] = Counter()
        out = [self.left_out(page) for page, _ in known]
        for r in range(rounds):
            for (page, (first, last)), bad in zip(known, out, strict=True):
                s = [x + MARGIN * t[1] * (1 if i < first or i >= last else -1) for i, (x, t) in enumerate(zip(self.scores(page, bad), page.tokens, strict=True))]
                a, b = best_stretch(s)
                if (a, b) != (first, last):
                    self._move(page, bad, a, b, -1.0)
                    self._move(page, bad, first, last, 1.0)
            if r >= rounds // 2:
                total.update(self.of)
        self.of = {k: x / (rounds - rounds // 2) if "<" in k else max(x / (rounds - rounds // 2), LEAST) for k, x in total.items()}

    @staticmethod
    def _marked(page: str) -> tuple[Page, tuple[int, int]]:
        """A labelled page, and its region: words of the main text carry a mark until they are found."""
        parts = re.split(r"(\[\[|\]\])", page)
        inside, out = False, []
        for x in parts:
            if x in ("[[", "]]"):
                inside = x == "[["
            else:
                out.append(re.sub(r"\bW\b", "W\x01", x) if inside else x)
        found = Page("".join(out))
        main = {i for i, (parts, _) in enumerate(found.blocks) if "\x01" in "".join(parts)}
        at = [i for i, (_, n, b, _) in enumerate(found.tokens) if n and b in main]
        return found, (at[0], at[-1] + 1)

    @staticmethod
    def _around(page: Page, e: int) -> Iterator[int]:
        while e >= 0:
            yield e
            e = page.elements[e][2]

    @staticmethod
    def _evidence(page: Page, e: int) -> list[str]:
        name, marks, _ = page.elements[e]
        return [name, *(f".{x}" for x in names(marks)), *(f"={m}" for m in marks)]

    def odds(self, name: str, marks: tuple[str, ...]) -> float:
        """Log odds of an element to be left out: by its name and the names it carries, each as a whole
        where the labelled pages have it, else by its parts."""
        out = self.against.get(name, 0.0)
        for m in {*marks}:
            out += self.against[f"={m}"] if f"={m}" in self.against else sum(self.against.get(f".{x}", 0.0) for x in names((m,)))
        return out

    def _move(self, page: Page, bad: list[bool], a: int, b: int, by: float) -> None:
        for features, n, _, e in page.tokens[a:b]:
            for i, f in enumerate(features if e < 0 or not bad[e] else ()):
                x = self.of.get(f, 0.0) + by * (0.01 * n if n else 0.2 if i else 0.02)
                self.of[f] = max(x, LEAST) if n else min(x, 0.0)

    def scores(self, page: Page, bad: list[bool]) -> list[float]:
        """Of each token; what is left out anyway costs a little by its words and nothing by its tags, so
        that the region reaches over it."""
        of = self.of.get
        return [-LEAST * n if e >= 0 and bad[e] else n * sum(of(f, LEAST) for f in features) if n else sum(of(f, 0.0) for f in features) for features, n, _, e in page.tokens]

    def left_out(self, page: Page) -> list[bool]:
        """Which elements are left out, themselves or with one around them. What holds over half of a page's
        words is not."""
        size = [0] * (len(page.elements) + 1)
        for _, n, _, e in page.tokens:
            size[e] += n
        for e in range(len(page.elements) - 1, -1, -1):
            size[page.elements[e][2]] += size[e]
        out: list[bool] = []
        for e, (name, marks, around) in enumerate(page.elements):
            out.append((around >= 0 and out[around]) or (2 * size[e] <= size[-1] and self.odds(name, marks) > AGAINST))
        return out


@lru_cache(1)
def weights() -> Weights:
    return Weights([*PAGES, *labelled(LABELLED)])


def extract(page: str | None, w: Weights | None = None) -> str:
    if not page:
        return ""
    w = w or weights()
    p = Page(page)
    bad = w.left_out(p)
    a, b = best_stretch(w.scores(p, bad))
    region = {x for _, _, x, _ in p.tokens[a:b] if x >= 0}
    if not region:
        return ""
    size, own = Counter(), Counter()  # words that each element holds, and those in the region
    for _, n, x, e in p.tokens:
        if n and not (e >= 0 and bad[e] and x not in region):
            for e in (*w._around(p, e), -1):
                size[e] += n
                own[e] += n * (x in region)
    words_in = sum(n for _, n, _, _ in p.tokens[a:b])
    of_page = {"html", "body"}
    fragment = not any(name in of_page for name, _, _ in p.elements)
    whole = [e for e in sorted(own) if own[e] == words_in >= WHOLE * size[e] and (fragment if e < 0 else p.elements[e][0] not in of_page)]
    #: What holds the whole region is no part of it.
    hold = {e for e in own if own[e] == words_in}
    p.elements = [("", (), up) if e in hold else (name, marks, up) for e, (name, marks, up) in enumerate(p.elements)]
    bad = w.left_out(p)
    out = []
    for x, (parts, e) in enumerate(p.blocks):
        if (x in region or (whole and whole[0] in (*w._around(p, e), -1))) and not (e >= 0 and bad[e]) and (text := " ".join(html.unescape("".join(parts)).split())):
            out.append(text)
    return "\n".join(out)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) for every row; repeated rows give repeated rows."""
    ship(pages.sparkSession)
    w = weights()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [extract(h.as_py(), w) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.string()), pa.array([len(x) for x in got], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
