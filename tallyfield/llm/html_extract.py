"""Main text of web pages by two-pass block rules: stop-word, length and link density, then context."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their they this to was we were
which will with would you
aber als am an auch auf aus bei das dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch
oder sich sie sind so über um und von vor war wie wird zu zum zur
au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa se ses son
sont sur un une vous
al como con de del el ella en entre era es esta este ha la las lo los más me no o para pero por que se si sin su sus también un una y
""".split())  # fmt: skip

# Elements by what they do to the text around them.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("""head title nav footer aside form dialog menu noscript template iframe object canvas svg math audio video select
option button textarea fieldset label""".split())
CONTENT = frozenset({"article", "main"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("li dt dd option".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
# Words that name what is not the article, and words that only say where or in what shape.
NOT_ARTICLE = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar
navigation menu breadcrumb breadcrumbs footer masthead comment comments reply replies disqus cookie cookies consent gdpr notice notification
popup modal overlay newsletter subscribe subscription share sharing social related recommended recommendations widget toolbar pagination
pager login signup search form""".split())
SHAPES = frozenset("""site page main top bottom left right header primary secondary global section block box bar area slot unit wrap wrapper
container inner outer list item items group panel content buttons links form posts articles policy user""".split())
# Stems that name comments, adverts and sidebars in any compound, and parts that make a name tell a state of something else.
OTHER_STEM = re.compile(r"comment(?!ar)|repl(?:y|ies)$|disqus|advert|ads?$|ad(?:sense|slot|box|unit)|sponsor|promo(?:s|tions?|tional|ted|box|card)?$|sidebar")
STATES = frozenset("has have with without no not is on off open closed enabled disabled free hide show".split())
# Elements that hold one entry of a thread.
ENTRIES = frozenset("div li section article blockquote".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|xmp|noembed|noframes)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)",
    re.S | re.I,
)
# A whole name and its value, so that no name is found inside a value; a value without quotes may hold them.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_LETTERS = re.compile(r"[^\W\d_]+")
# A clock time, a day in digits, or so and so long ago.
_WHEN = re.compile(r"\d{1,2}:\d\d|\d{4}-\d\d?-\d\d?|\d\d?[./]\d\d?[./]\d{2,4}|\d+\s+\w+\s+ago\b|\b(?:vor|hace|il y a)\s+\d+")


def _names_other(value: str) -> bool:
    """Whether a word of a class or id names something that is not the article.

    All its parts do or only say where, or one has the stem of a comment, an advert or a sidebar and none tells a state.
    """
    for word in value.split():
        parts = {p.lower() for p in _NAME_PARTS.findall(word)}
        if parts & NOT_ARTICLE and parts <= NOT_ARTICLE | SHAPES:
            return True
        if not parts & STATES and any(OTHER_STEM.match(p) for p in parts):
            return True
    return False


def _verdict(tag: str, attributes: str, in_content: bool) -> tuple[bool, bool, str]:
    """Whether an element is dropped, whether its class or id names something that is not the article, and its first class without digits."""
    if tag in DROPPED or (tag == "header" and not in_content):
        return True, False, ""
    if not attributes or tag in ("html", "body"):
        return False, False, ""
    named, kind = False, ""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, False, ""
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, False, ""
        if name == "role" and value.lower() in ROLES:
            return True, False, ""
        if name == "class" and value.strip():
            kind = re.sub(r"\d+", "", value.split()[0])
        named |= name in ("class", "id") and tag in BLOCK and _names_other(value)
    return False, named, kind


class Block(NamedTuple):
    """A run of text between block elements."""

    text: str
    linked: int  # characters inside links
    inside: bool  # an article element holds it
    named: int  # the innermost element around it whose name says that it is not the article (0: none)
    heading: bool
    item: bool  # of a list
    title: bool  # in a heading of the first level
    thread: bool = False  # part of an entry of a thread


class _Elements:
    """Elements of a page in the order of their starts: the one around, a kind (tag and first class; none for what is no entry), a time inside."""

    def __init__(self) -> None:
        self.around: list[int] = [0]
        self.kind: list[str | None] = [None]
        self.timed: list[bool] = [False]

    def add(self, around: int, tag: str, kind: str) -> int:
        self.around.append(around)
        self.kind.append(f"{tag} {kind}" if tag in ENTRIES else None)
        self.timed.append(False)
        return len(self.around) - 1


def _threads(blocks: list[Block], at: list[int], elements: _Elements, short: int) -> set[int]:
    """Numbers of the blocks that belong to a thread, by repeated siblings and not by names.

    Siblings of one kind, two or more, each of several blocks of which the first is short and no heading, are
    entries of a thread if they all repeat one short text after their first block (an offer to reply), or if each has a short
    block or a time element with an author beside the time and together they hold less than half of the long text of the page.
    """
    m = len(elements.around)
    count, chars, first = [0] * m, [0] * m, [-1] * m
    for i, e in enumerate(at):
        count[e] += 1
        chars[e] += len(blocks[i].text) if len(blocks[i].text) >= short else 0
        first[e] = i if first[e] < 0 else first[e]
    for e in range(m - 1, 0, -1):  # what is around starts before
        up = elements.around[e]
        count[up] += count[e]
        chars[up] += chars[e]
        if first[e] >= 0 and (first[up] < 0 or first[e] < first[up]):
            first[up] = first[e]
    groups: dict[tuple[int, str], list[int]] = {}
    for e in range(1, m):
        kind = elements.kind[e]
        if kind and count[e] > 1 and len(blocks[first[e]].text) < short and not blocks[first[e]].heading:
            groups.setdefault((elements.around[e], kind), []).append(e)
    groups = {k: v for k, v in groups.items() if len(v) > 1}
    if not groups:
        return set()
    member = {e for v in groups.values() for e in v}
    near = [0] * m  # the innermost entry around an element, itself included
    for e in range(1, m):
        near[e] = e if e in member else near[elements.around[e]]
    said: dict[int, set[str]] = {e: set() for e in member}
    timed = {near[e] for e in range(1, m) if elements.timed[e]}
    for i, e in enumerate(at):
        e, text = near[e], blocks[i].text
        if e and len(text) < short and not blocks[i].heading:
            if i != first[e]:
                said[e].add(text)
            when = _WHEN.search(text)
            if when and _LETTERS.search(text[: when.start()] or text[when.end() :]):
                timed.add(e)
    entries = set()
    for v in groups.values():
        if set.intersection(*(said[e] for e in v)) or (timed.issuperset(v) and 2 * sum(chars[e] for e in v) < chars[0]):
            entries.update(v)
    held = [False] * m
    for e in range(1, m):
        held[e] = e in entries or held[elements.around[e]]
    return {i for i, e in enumerate(at) if held[e]}


def _misnamed(blocks: list[Block], above_of: list[int], long: int) -> set[int]:
    """Named elements that hold the title and over half of the long text outside of links: a layout is named there, not what it holds."""
    chars = [0] * len(above_of)
    titled = set()
    title = next((b.named for b in blocks if b.title), 0)
    while title:
        titled.add(title)
        title = above_of[title]
    for b in blocks:
        chars[b.named] += len(b.text) - b.linked if len(b.text) >= long else 0
    for e in range(len(above_of) - 1, 0, -1):
        chars[above_of[e]] += chars[e]
    return {e for e in titled if 2 * chars[e] > chars[0]}


def blocks_of(html: str, short: int = 70, long: int = 200) -> list[Block]:
    """Blocks in page order.

    An element whose name says that it is not the article counts as named unless it holds the article element, or the title and most of
    the text (``_misnamed``).  Blocks of threads are marked (``_threads``).
    """
    out: list[Block] = []
    at_element: list[int] = []
    elements = _Elements()
    stack: list[tuple[str, bool, bool, int, int]] = []  # tag, dropped here or above, inside an article element, named, element
    opened: Counter[str] = Counter()
    above_of, holds = [0], set()  # of named elements: the next one around, and those that hold an article element
    parts: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split()) if parts else ""
        if text:
            inside, named, element = stack[-1][2:] if stack else (False, 0, 0)
            out.append(Block(text, linked, inside, named, any(opened[h] for h in HEADINGS), any(opened[i] for i in ITEMS), opened["h1"] > 0))
            at_element.append(element)
        parts.clear()
        linked = 0

    def pop() -> None:
        opened[stack.pop()[0]] -= 1

    at = 0
    for m in _MARKUP.finditer(html):
        if m.start() > at and not (stack and stack[-1][1]):
            text = unescape(html[at : m.start()])
            parts.append(text)
            linked += len(text) if opened["a"] else 0
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
        if tag in BLOCK:
            close()
        if m[2]:
            if opened[tag]:  # an end without a start is ignored
                while stack[-1][0] != tag:
                    pop()
                pop()
        elif tag not in VOID:
            if tag in BLOCK and opened["p"]:  # a block ends an open paragraph, whatever inline elements it left open
                inline = next((i for i in range(1, min(len(stack), 64) + 1) if stack[-i][0] in BLOCK), 0)
                if inline and stack[-inline][0] == "p":
                    for _ in range(inline):
                        pop()
            if stack and stack[-1][0] == tag and tag in ("a", "li", "td", "th", "tr", "dt", "dd", "option"):
                pop()
            _, was_dropped, in_content, around, element = stack[-1] if stack else ("", False, False, 0, 0)
            dropped, named, kind = _verdict(tag, m[4], in_content)
            if tag == "time":
                elements.timed[element] = True
            dropped = dropped or was_dropped
            if named:
                above_of.append(around)
                around = len(above_of) - 1
            elif tag in CONTENT and not dropped:
                while around and around not in holds:
                    holds.add(around)
                    around = above_of[around]
                around = 0
            if not m[4].endswith("/") or tag in BLOCK:
                if tag in BLOCK:
                    element = elements.add(element, tag, kind)
                stack.append((tag, dropped, in_content or (tag in CONTENT and not dropped and not named), around, element))
                opened[tag] += 1
    if at < len(html) and not (stack and stack[-1][1]):
        parts.append(unescape(html[at:]))
    close()
    out = [b._replace(named=0) if b.named in holds else b for b in out]
    misnamed, threads = _misnamed(out, above_of, long), _threads(out, at_element, elements, short)
    return [b._replace(named=0 if b.named in misnamed else b.named, thread=i in threads) for i, b in enumerate(out)]


def _alone(blocks: list[Block], short: int, long: int, low: float, high: float, links: float) -> list[bool | None]:
    """First pass: good (True), bad (False) or open (None), each block by itself."""
    words = [_LETTERS.findall(b.text.lower()) for b in blocks]
    stops = [sum(w in STOP_WORDS for w in found) for found in words]
    dense = [b.linked > links * len(b.text) for b in blocks]
    # What stands before the title is none of the article, unless most long text is there.
    title = next((i for i, b in enumerate(blocks) if b.title and not b.named and not b.thread), 0)
    lengths = [0 if b.named or b.thread or d or len(b.text) < long else len(b.text) for b, d in zip(blocks, dense, strict=True)]
    title = title if 2 * sum(lengths[:title]) <= sum(lengths) else 0
    bad = [b.named or b.thread or (i < title and not b.inside) for i, b in enumerate(blocks)]
    plain = [i for i, d in enumerate(dense) if not d and not bad[i]]

    def judged(known: bool) -> list[bool | None]:
        labels: list[bool | None] = []
        for i, (b, found, stop) in enumerate(zip(blocks, words, stops, strict=True)):
            share = stop / max(len(found), 1)
            if bad[i]:
                labels.append(False)
            elif dense[i]:  # a menu is a list of links or a run of them; a single one may stand in an article
                labels.append(False if b.item or any(dense[max(i - 1, 0) : i]) or any(dense[i + 1 : i + 2]) else None)
            elif len(b.text) < short or b.heading:
                labels.append(None)
            elif not known:
                labels.append(True if len(b.text) >= long else None)
            elif share >= high and (len(b.text) >= long or not b.linked):
                labels.append(True)
            elif share < low and len(b.text) >= long and not b.inside:
                labels.append(False)
            else:
                labels.append(None)
        return labels

    # A page in a language whose function words are not listed shows hardly any, or no block with enough of them: then length alone decides.
    labels = judged(sum(stops[i] for i in plain) >= 0.02 * sum(len(words[i]) for i in plain))
    return labels if any(labels) else judged(False)


def _inherited(blocks: list[Block], labels: list[bool | None]) -> list[bool]:
    """Second pass: open blocks take the label of the nearest decided block before or after them.

    A heading goes with what follows.  Equally near and different, or none decided: good.  Neighbours are
    those of the same side of an article element's border.
    """
    n, first = len(blocks), list(labels)
    before, after = [None] * n, [None] * n  # nearest decided blocks
    for order, near in ((range(n - 1, -1, -1), after), (range(n), before)):
        last: list[int | None] = [None, None]
        for i in order:
            side = blocks[i].inside
            near[i] = last[side]
            if first[i] is None and blocks[i].heading and near is after and near[i] is not None:
                first[i] = first[near[i]]
            if first[i] is not None:
                last[side] = i
    good = []
    for i, label in enumerate(first):
        if label is None:
            reach = [(abs(j - i), not first[j]) for j in (before[i], after[i]) if j is not None]
            label = not min(reach)[1] if reach else True
        good.append(label)
    return good


def main_text(html: str | None, short: int = 70, long: int = 200, low: float = 0.1, high: float = 0.25, links: float = 0.5) -> str:
    """Two passes over the blocks of a page.

    First each block is judged alone (``_alone``): in an element named as something else, in a thread (repeated siblings with a time
    or an offer to reply, see ``_threads``), links in a list or run, or before the page's title: bad; long enough with many stop words: good; long with hardly any: bad, but open inside an article element;
    short ones, headings and the rest stay open.  Where a page shows no listed stop words, or no block with many of them, length decides.
    Then open blocks take the label of their nearest decided neighbours (``_inherited``).

    Where no block is good, the open ones are all the text there is and stay.  Where an article element has good
    text, what lies outside of all article elements is bad.  Both passes and the parser are linear in the page.
    """
    blocks = blocks_of(html or "", short, long)
    if all(b.thread or b.named for b in blocks):  # a page that is a thread as a whole
        blocks = [b._replace(thread=False) for b in blocks]
    labels = _alone(blocks, short, long, low, high, links)
    good = _inherited(blocks, labels) if any(labels) else [label is not False for label in labels]
    has_article = any(b.inside and label for b, label in zip(blocks, good, strict=True))
    return " ".join(b.text for b, label in zip(blocks, good, strict=True) if label and (b.inside or not has_article))


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text of each page (see ``main_text``), and ``n_chars``, its code points.

    Null or empty html gives an empty text.  Input columns named text or n_chars are replaced; the rest
    stay, rows stay as they are.  Pages are independent, so nothing is shuffled.
    """

    @F.pandas_udf("string")
    def extract(column):
        return column.map(main_text)

    return pages.withColumn("text", extract(F.col(html))).withColumn("n_chars", F.length("text").cast("long"))
