"""Main text of web pages: the best-scoring contiguous region of words and tags.

A page becomes a list of items: words, with a positive weight each, and tags, with a
negative one. The region with the largest sum is found by one linear scan. Weights
come from the labelled pages below and seeded ones of many shapes. Elements that never hold article
text (scripts, forms, menus, adverts, reader comments and so on) stay in the list as
tags, but their words are no items and are never returned.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Names of the markup language and usual class names of page furniture.
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option "
    "p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = frozenset(
    "head nav header footer aside form menu dialog select button label fieldset svg math canvas object "
    "audio video map datalist".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())
FURNITURE = re.compile(
    r"(ads?|advert\w*|adsense|banner\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice\w*"
    r"|alert\w*|popup|modal|overlay|newsletter|subscri\w*|signup|sidebar\w*|widget\w*|menu\w*|nav"
    r"|navbar|navigation|breadcrumbs?|masthead|header|footer|comments?|commentlist|replies|disqus|respond"
    r"|thread|threads|discussion|responses|reactions|guestbook"
    r"|related|recommend\w*|share|sharing|social|login|search|toolbar|pagination|pager|copyright|legal"
    r"|disclaimer|skip)"
)
#: Names that an article gives to parts of its own; they count outside of articles only.
ARTICLE_PARTS = frozenset("legal disclaimer copyright social search login skip".split())
#: Parts of class names that say where or what kind of box, not what it holds.
GENERIC = re.compile(
    r"site|page|main|top|bottom|left|right|global|primary|secondary|user|reader|google|post|posts|articles"
    r"|stories|links?|lists?|area|box|bar|block|section|wrap|wrapper|container|inner|outer|buttons?|icons?"
    r"|slot|unit|form|policy|text|media|to|content|[0-9]+(x[0-9]+)?"
)
#: Elements that no class or id name turns into furniture.
NEVER = frozenset("body html article main h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())

#: Labelled pages: the text between the two marks is the article, all else is not.
START, END = "\x02", "\x03"
LABELLED = (
    "<body><nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></nav>"
    "<div class=ad>Buy shoes now</div><article>\x02<h1>A long walk by the river</h1>"
    "<p><b>It was raining</b> when we left the house, and the road was empty.<br><p>We met nobody.</p>"
    "<p>By noon the sun was out.</p>\x03</article><footer>All rights reserved 2020</footer></body>",
    "<body><div><a href=a>Home</a> <a href=b>Sport</a> <a href=c>Jobs</a></div><div>\x02<h2>New bridge "
    "opens</h2><p>The bridge over the bay opened on Monday after four years of work.</p><ul><li>It has "
    "four lanes.</li><li>It cost less than planned.</li></ul><p>Tolls start in May.</p>\x03</div>"
    "<div><ul><li><a href=d>More news</a></li><li><a href=e>Contact us</a></li></ul></div></body>",
    "<body><table><tr><td><a href=a>Index</a></td><td><a href=b>Shop</a></td></tr></table><main>\x02"
    "<p>Bread needs flour, water, salt and time.</p><p>Knead it for ten minutes and let it <i>rest</i> "
    "in a <a href=x>warm</a> place.</p><blockquote>Good bread is slow bread.</blockquote>\x03</main>"
    "<section><div><a href=c>Older</a></div><div><a href=d>Newer</a></div></section></body>",
    "<body><div><div>We value your privacy</div><div>Accept</div></div><div><section>\x02<h1>Notes on "
    "tuning</h1><p>Start with one string and a fork.</p><pre>A 440</pre><p>Then tune the others to it, "
    "one after another, and check the chords.</p>\x03</section></div><div><span>Share</span></div></body>",
)

#: Stands for a dropped element: it ends a block, but does not part the text around it.
GAP = "#gap"
#: Stands for the tag of a link beside which its block has no words.
LINK = "#link"

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>|[^>]*(?:>|\Z))",
    re.DOTALL,
)
_NAMES = re.compile(r"(?<![\w-])(?:class|id)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_ROLE = re.compile(r"(?<![\w-])role\s*=\s*[\"']?([\w-]+)", re.IGNORECASE)


def _is_furniture(name: str, rest: str, inside_article: bool) -> bool:
    if name == "header" and inside_article:
        return False  # the head of the article itself
    return name in DROPPED


def _named_furniture(name: str, rest: str, inside_article: bool) -> bool:
    """Whether role, or a whole class or id token, names furniture: has-sidebar does not."""
    if len(rest) < 3 or name in NEVER or (name == "header" and inside_article):
        return False
    role = _ROLE.search(rest)
    if role and role[1].lower() in ROLES:
        return True
    for m in _NAMES.finditer(rest):
        for token in m[1].strip("\"'").lower().split():
            parts = [p for p in re.split(r"[-_:]+", token) if p and not GENERIC.fullmatch(p)]
            if inside_article and (parts == ["header"] or ARTICLE_PARTS.issuperset(parts)):
                continue
            if parts and all(FURNITURE.fullmatch(p) for p in parts):
                return True
    return False


class _Boxes:
    """What one pass over a page tells about its elements: the words in each, and where the
    last closing tag of each name is."""

    def __init__(self, page: str):
        self.page = page
        self.words: dict[int, int] | None = None
        self.total = 0
        self.closings: dict[str, int] = {}

    def _count(self) -> None:
        """Words from each opening tag, by where it ends, to its closing tag or the page's end.

        Tags and raw texts are left out; a closing tag belongs to the last open element of
        its name.
        """
        self.words, at, seen = {}, 0, 0
        open_at: dict[str, list[tuple[int, int]]] = {}
        while True:
            m = _TAG.search(self.page, at)
            seen += len(self.page[at : m.start() if m else len(self.page)].split())
            if not m:
                break
            at = m.end()
            if m[2] is None:
                continue
            name, close = m[2].lower(), bool(m[1])
            if close:
                if open_at.get(name):
                    start, before = open_at[name].pop()
                    self.words[start] = seen - before
                continue
            if name not in VOID:
                open_at.setdefault(name, []).append((at, seen))
            if name in RAW:
                at = _raw_end(self.page, name, at)
        for left in open_at.values():
            self.words.update((start, seen - before) for start, before in left)
        self.total = seen

    def holds_most(self, at: int) -> bool:
        """Whether the element whose opening tag ends at ``at`` has over half of all words."""
        if self.words is None:
            self._count()
        return 2 * self.words.get(at, 0) > self.total

    def closes_after(self, name: str, at: int) -> bool:
        if name not in self.closings:
            found = re.compile(rf"</{re.escape(name)}\b", re.IGNORECASE).finditer(self.page)
            self.closings[name] = max((m.start() for m in found), default=-1)
        return self.closings[name] >= at


def _raw_end(page: str, name: str, at: int) -> int:
    end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
    return end.start() if end else len(page)


def _in_order(page: str) -> Iterator[tuple[str, str]]:
    """The page as ("tag", name) and ("text", words) items, without furniture's words."""
    at, skip, depth, article, boxes = 0, "", 0, 0, _Boxes(page)
    while True:
        m = _TAG.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text and not skip:
            yield "text", entities.unescape(text)
        if not m:
            return
        at = m.end()
        if m[2] is None:
            continue
        close, name, rest = bool(m[1]), m[2].lower(), m[3]
        if name in ("article", "main"):
            article = max(0, article + (-1 if close else 1))
        if not close and name in RAW:
            at = _raw_end(page, name, at)
            continue
        if skip:
            if name == skip:
                opens = not close and name not in SELF_CLOSING
                depth += 1 if opens else -1
                if depth == 0:
                    skip = ""
                    if close or name not in SELF_CLOSING:
                        continue
                else:
                    continue
            else:
                continue
        drop = not close and name not in VOID and _is_furniture(name, rest, article > 0)
        if not (drop or close) and name not in VOID and _named_furniture(name, rest, article > 0):
            # What holds most of the page's words is its layout, whatever it is called.
            drop = name in ("p", "li", "dt", "dd", "option") or not boxes.holds_most(at)
        if drop:
            # An element that is never closed must not swallow the rest of the page.
            if name in SELF_CLOSING or boxes.closes_after(name, at):
                skip, depth = name, 1
                yield "tag", GAP
                continue
        yield "tag", ("/" if close else "") + name


def items(page: str) -> Iterator[tuple[str, str]]:
    """As ``_in_order``, with the tags of links that are all the words of their block named LINK."""
    block: list[tuple[str, str]] = []
    linked = said = False
    for kind, value in _in_order(page):
        name = value.lstrip("/")
        if kind == "text":
            said = said or (not linked and any(c.isalnum() for c in value))
        elif name == "a":
            linked = value == "a"
        elif name in BLOCKS or name == GAP:
            yield from _links(block, said)
            block, linked, said = [], False, False
        block.append((kind, value))
    yield from _links(block, said)


def _links(block: list[tuple[str, str]], said: bool) -> Iterator[tuple[str, str]]:
    for kind, value in block:
        if kind == "tag" and not said and value in ("a", "/a"):
            value = value[:-1] + LINK
        yield kind, value


_NOUNS = "the river town old bridge was built over two years of work and people came to see it by boat".split()


def _varied(pages: int = 240, seed: int = 7) -> Iterator[str]:
    """Labelled pages of seeded shapes: each kind of block inside, link lists and boxes outside."""
    rng = random.Random(seed)

    def say(least: int, most: int) -> str:
        return " ".join(rng.choices(_NOUNS, k=rng.randint(least, most)))

    def linked(words: str) -> str:
        at = words.split()
        for i in sorted(rng.sample(range(len(at)), min(len(at), rng.randint(1, 2)))):
            at[i] = f"<a href=x>{at[i]}</a>"
        return " ".join(at)

    def maybe(words: str) -> str:
        return f"<a href=x>{words}</a>" if rng.random() < 0.15 else words

    def table() -> str:
        cells = [
            "<tr>" + "".join(f"<td>{maybe(say(1, 3))}</td>" for _ in range(rng.randint(2, 4))) + "</tr>"
            for _ in range(rng.randint(3, 10))
        ]
        return f"<table><tbody>{''.join(cells)}</tbody></table>"

    def block() -> str:
        kind = rng.random()
        if kind < 0.35:
            return f"<p>{say(10, 50)}</p>"
        if kind < 0.55:
            return f"<p>{linked(say(8, 30))}</p>"
        if kind < 0.7:
            return f"<div>{say(8, 40)}</div>"
        if kind < 0.78:
            return f"<section><h2>{say(2, 5)}</h2><div><p>{say(10, 40)}</p></div></section>"
        if kind < 0.86:
            return table()
        if kind < 0.93:
            return "<ul>" + "".join(f"<li>{maybe(say(3, 12))}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        return f"<blockquote><p>{say(8, 20)}</p></blockquote><pre>{say(3, 9)}</pre>"

    def outside() -> str:
        kind = rng.random()
        few = [f"<a href=y>{say(1, 2)}</a>" for _ in range(rng.randint(3, 9))]
        if kind < 0.4:
            return "<div><ul>" + "".join(f"<li>{x}</li>" for x in few) + "</ul></div>"
        if kind < 0.6:
            return "<div>" + " ".join(few) + "</div>"
        if kind < 0.75:
            return "<table><tr>" + "".join(f"<td>{x}</td>" for x in few) + "</tr></table>"
        if kind < 0.85:
            return "<div>" + "".join(f"<p>{say(1, 2)} {x} {x}</p>" for x in few[:4]) + "</div>"
        if kind < 0.95:
            return "<section>" + "".join(f"<div>{x}</div>" for x in few) + "</section>"
        return f"<div><div><span>{say(1, 4)}</span></div><div>{say(1, 2)}</div></div>"

    for _ in range(pages):
        tag = rng.choice(["article", "main", "div", "div", "section"])
        body = "".join(block() for _ in range(rng.randint(2, 9)))
        before, after = ("".join(outside() for _ in range(rng.randint(1, 4))) for _ in range(2))
        yield f"<body>{before}<{tag}>{START}<h1>{say(2, 8)}</h1>{body}{END}</{tag}>{after}</body>"


def _learn(pages: Iterable[str]) -> tuple[dict[str, float], float, float]:
    """Tag weights (all negative), the weight of a word, and that of an unseen tag.

    A weight is the log odds of an item's share inside articles to its share outside.
    """
    inside, outside = Counter(), Counter()
    for page in pages:
        within = False
        for kind, value in items(page):
            if kind == "tag":
                (inside if within else outside)[value.lstrip("/")] += 1
                continue
            for word in re.split(f"([{START}{END}])", value):
                if word in (START, END):
                    within = word == START
                else:
                    (inside if within else outside)["word"] += len(word.split())
    sums = inside.total(), outside.total()
    odds = {
        t: math.log((inside[t] + 0.5) / sums[0]) - math.log((outside[t] + 0.5) / sums[1])
        for t in inside | outside
    }
    word = max(odds.pop("word"), 0.1)
    # A tag of articles costs next to nothing, so that a last short paragraph stays.
    odds.pop(GAP, None)
    weights = {t: min(-0.02, w) for t, w in odds.items()}
    return weights, word, -0.5


WEIGHTS, WORD_WEIGHT, OTHER_TAG = _learn((*LABELLED, *_varied()))
#: Tags that only mark up words inside a block; seen in both kinds of region.
INLINE = frozenset("b i em strong u s small sub sup code span mark abbr cite q time font".split())


def _weight(tag: str) -> float:
    name = tag.lstrip("/")
    if name in INLINE or name in (
        GAP, "br", "img", "h1", "h2", "h3", "h4", "h5", "h6"
    ):
        return -0.02
    return WEIGHTS.get(name, OTHER_TAG)


def main_text(page: str | None) -> str:
    """The text of the best region: blocks in page order, joined by one space.

    Kadane's scan: the running sum restarts after it has fallen to zero or below; of
    equal regions the first one counts. Null, empty and wordless pages give "".
    """
    parts = list(items(page or ""))
    best, best_from, best_to = 0.0, 0, 0
    run, start = 0.0, 0
    for i, (kind, value) in enumerate(parts):
        run += WORD_WEIGHT * len(value.split()) if kind == "text" else _weight(value)
        if run <= 0:
            run, start = 0.0, i + 1
        elif run > best:
            best, best_from, best_to = run, start, i + 1
    blocks, block = [], []
    for kind, value in parts[best_from:best_to]:
        if kind == "text":
            block.append(value)
        elif value == GAP or value.lstrip("/") in BLOCKS:
            blocks.append("".join(block))
            block = []
    blocks.append("".join(block))
    return " ".join(" ".join(blocks).split())


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``; html may be null or empty.

    Each row is worked on alone, in Arrow batches, without a shuffle. Pages are read
    whole. Other columns are ignored.
    """
    rows = pages.select("page_id", "url", "html")

    def run(batches):
        for b in batches:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
