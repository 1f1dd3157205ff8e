"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element, and every run of text in it, is a node that is content or not. A
node's kind, hints in its class and id, and for text its length and share of links,
speak for either; a child tends to be what its parent is. Sum-product messages,
leaves to root and back, give each text's exact chance of being content, and the
blocks with a chance of one half or more are joined.

The potentials are counts: from pages whose own markup labels them (an article or
main element is content but for the boxes inside it), on top of fixed prior counts
for kinds and hints, so that rare kinds have a say. At most about ``FIT_PAGES``
pages, drawn by hash, are counted (a documented bound); every page is read whole.

A page is read in one forward scan, in time proportional to its length. A ``head``
ends, closed or not, at the first thing that belongs in the body. Quotes delimit only
attribute values, after an equals sign. Elements such as ``video`` or ``svg`` that are
never closed hide nothing. Reader comments, also where they are article elements of
their own beside or inside the main one, are boxes.

Defined results: NULL and empty pages have an empty text. Scripts, styles, forms and
the like are no text at all. Unclosed and unmatched tags never fail; a tag that never
ends, and a script or style that is never closed, go on to the end. Equal pages get
equal texts, one row each. Without pages to learn from the prior counts decide.
Other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.texts import whole
from turnstile.session import scratch_path

FIT_PAGES = 2_000
PRIOR = 20.0  # weight of the fixed counts

# Elements of HTML by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript textarea title iframe".split()  # what is inside is no markup
MEDIA = "template svg math object canvas video audio".split()
HEAD = "head base link meta title noscript script style template".split()  # what may stand in a head
NO_TEXT = {*RAW, *MEDIA, *"head form button select option datalist input label fieldset dialog".split()}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
TEXTUAL = set("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption ul ol li dl dt dd table tbody tr td th".split())
BOX = set("nav footer aside menu".split())
CLOSED_BY_BLOCK = set("p".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
LIST_ENDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}

# Words of class, id, role and label attributes.
BOX_WORDS = set(
    "ad ads adv advert advertisement adverts banner bar bottom breadcrumb breadcrumbs captcha comment comments consent "
    "cookie cookies copyright dialog disqus feedback footer form gdpr header login masthead menu meta modal nav navbar "
    "navigation newsletter notice outbrain overlay pager pagination popup promo promotion recommend recommended related "
    "replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe taboola tags toolbar "
    "topbar warning widget alert".split()
)
READER_WORDS = set("comment comments disqus replies reply respond".split())
MAIN_WORDS = set("article articlebody body content entry main page post story text".split())

NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
# Possessive, so that a tag is read once: quoted values after an equals sign, anything else up to the end.
ATTRIBUTES = re.compile(r"(?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+>")
ATTRIBUTE = re.compile(r"(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HINT = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    """An element, or a run of text where ``text`` is set."""

    tag: str
    parent: int
    hint: str = "none"
    text: list[str] | None = None
    linked: int = 0  # characters inside links
    block: int = 0
    reader: bool = False  # named as a place of reader comments


def _words(attributes: str) -> set[str]:
    """The words of class, id and the like."""
    return {w for m in ATTRIBUTE.finditer(attributes) for w in HINT.findall((m[2] or m[3] or m[4] or "").lower())}


def _hint(words: set[str]) -> str:
    if words & BOX_WORDS:
        return "box"
    return "main" if words & MAIN_WORDS else "none"


def tokens(page: str) -> Iterator[tuple[str, str, str, str]]:
    """The page as (kind, value, name, attributes): kinds are text, start, end, and raw for the inside of a CDATA section.

    Comments and declarations are left out, as is what scripts and the like enclose.
    One forward scan: what is known to be missing in the rest of the page is not searched again.
    """
    at = written = 0  # where the scan is, and up to where the page has been told
    plain = False  # a quoted value ran over the end: tags end at the next '>' from there on
    missing: set[str] = set()  # raw elements whose end tag does not follow
    while (start := page.find("<", at)) >= 0:
        name = NAME.match(page, start + 1)
        if name is None and not page.startswith(("!", "?"), start + 1):
            at = start + 1
            continue
        if start > written:
            yield "text", page[written:start], "", ""
        if name is None:
            section = page.startswith("<![CDATA[", start)
            mark = "-->" if page.startswith("<!--", start) else "]]>" if section else ">"
            end = page.find(mark, start + 2 if mark != "]]>" else start + 9)
            if section:
                yield "raw", page[start + 9 : end if end >= 0 else len(page)], "", ""
            at = written = len(page) if end < 0 else end + len(mark)
            continue
        rest = None if plain else ATTRIBUTES.match(page, name.end())
        if rest is None:
            plain = True
            close = page.find(">", name.end())
            if close < 0:  # a tag that never ends
                return
            at = written = close + 1
        else:
            at = written = rest.end()
        tag, attributes = name[2].lower(), page[name.end() : at - 1]
        yield "end" if name[1] else "start", "", tag, attributes
        if name[1] or tag not in RAW or attributes.endswith("/") and tag not in ("script", "style"):
            continue
        end = None if tag in missing else re.compile(rf"</{tag}[\s>/]", re.I).search(page, at)
        if end is not None:
            at = written = page.find(">", end.start()) + 1 or len(page)
        elif tag in ("script", "style"):
            return
        else:
            missing.add(tag)
    if written < len(page):
        yield "text", page[written:], "", ""


def parse(page: str) -> list[Node]:
    """The nodes of a page in order, parents before children; node 0 is the root.

    Inline elements are no nodes; they only tell which text is inside links.
    """
    nodes = [Node("root", -1)]
    stack = [0]
    at = 0
    link = 0  # depth of the stack at which a link is open
    block = 0  # runs of text with the same number are one block
    line = -1  # the text node of this block

    def add_text(raw: str) -> None:
        nonlocal line
        text = html.unescape(raw)
        if line < 0 or nodes[line].block != block:
            if not text.strip():
                return
            line = len(nodes)
            nodes.append(Node("#text", stack[-1], text=[], block=block))
        nodes[line].text.append(text)
        if link:
            nodes[line].linked += len(text.strip())

    def pop(depth: int, closed: str = "") -> None:
        nonlocal link
        for k in stack[depth:]:
            if nodes[k].tag in MEDIA and nodes[k].tag != closed:  # never closed: it hides nothing
                nodes[k].tag = "unclosed"
        del stack[depth:]
        if link > depth:
            link = 0

    def end_head() -> None:
        nonlocal block
        if nodes[stack[-1]].tag == "head":
            block += 1
            pop(len(stack) - 1)

    for kind, value, tag, attributes in tokens(page):
        if kind in ("text", "raw"):
            if value.strip():
                end_head()
            add_text(value if kind == "text" else value.replace("&", "&amp;"))
            continue
        closing = kind == "end"
        if not closing and tag not in HEAD:
            end_head()
        if tag == "br":
            add_text(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                link = 0 if closing else len(stack)
            continue
        block += 1
        if closing:
            place = next((k for k in range(len(stack) - 1, 0, -1) if nodes[stack[k]].tag == tag), 0)
            if place:
                pop(place, tag)
            continue
        for k in range(len(stack) - 1, 0, -1):
            name = nodes[stack[k]].tag
            if name in LIST_ENDS.get(tag, ()):
                break
            if name in SIBLINGS.get(tag, ()) or name in CLOSED_BY_BLOCK:
                pop(k)
                break
            if tag not in SIBLINGS:
                break
        if tag in VOID or tag in RAW or tag in MEDIA and attributes.endswith("/"):
            continue
        words = _words(attributes)
        stack.append(len(nodes))
        nodes.append(Node(tag, stack[-2], _hint(words), reader=bool(words & READER_WORDS)))
    pop(1)
    return nodes


def features(node: Node, textual: int) -> list[str]:
    """What a node shows of itself; ``textual`` is the length of all text below it."""
    if node.text is not None:
        size = len("".join(node.text).strip())
        share = node.linked / max(1, size)
        return [f"size:{min(4, int(math.log(size + 1, 4)))}", f"links:{'all' if share > 0.8 else 'some' if share > 0.3 else 'few'}"]
    kind = node.tag
    if kind not in BOX | {"article", "main", "header", "body", "html", "root", "section", "div"}:
        kind = "textual" if kind in TEXTUAL else "other"
    return [f"tag:{kind}", f"hint:{node.hint}", f"below:{min(5, int(math.log(textual + 1, 6)))}"]


# Fixed prior counts: the chance of a feature in content against that outside, before pages are counted.
LEANING = {
    "tag:article": 30.0, "tag:main": 30.0, "tag:textual": 1.5, "tag:nav": 0.002, "tag:footer": 0.005, "tag:aside": 0.005,
    "tag:menu": 0.01, "tag:header": 0.1, "tag:root": 0.1, "tag:html": 0.2, "tag:body": 0.3,
    "hint:box": 0.004, "hint:main": 8.0, "links:all": 0.2, "links:some": 0.6, "links:few": 1.5,
    "size:0": 0.7, "size:1": 0.8, "size:2": 1.0, "size:3": 1.6, "size:4": 4.0,
}
# How much the log chances of a group of features may say, either way: what a box is outweighs how its text looks.
LIMITS = {"tag:textual": 0.7, "tag:other": 0.7, "tag:div": 0.7, "tag:section": 0.7, "size": 1.5, "below": 0.5, "links": 1.5}
# Chance that a child is what its parent is, by the place of the child and whether the parent is content:
# the prior, and the bounds within which counts may move it.
STAYS = {
    ("plain", True): (0.97, 0.6, 0.98), ("plain", False): (0.9, 0.6, 0.94),
    ("box", True): (0.05, 0.02, 0.3), ("box", False): (0.98, 0.9, 0.99),
    ("in box", True): (0.97, 0.9, 0.98), ("in box", False): (0.998, 0.99, 0.999),
}


@dataclass(frozen=True)
class Potentials:
    """Log chances of a feature in content against outside; chances that a child is what its parent is."""

    leaning: dict[str, float]
    stays: dict[tuple[str, bool], float]

    @classmethod
    def of(cls, counts: dict[tuple[str, bool], int]) -> Potentials:
        """From counts of (feature, content) and of ('stays' or 'leaves' with the place, parent is content)."""
        groups: dict[str, dict[bool, int]] = {}
        for (name, content), n in counts.items():
            group = groups.setdefault(name.split(":")[0], {True: 0, False: 0})
            group[content] += n
        leaning = {}
        for name in {*LEANING, *(name for name, _ in counts if ":" in name)}:
            prior = LEANING.get(name, 1.0)
            total = groups.get(name.split(":")[0], {True: 0, False: 0})
            # as if PRIOR nodes of each state had been seen, showing the feature in the ratio of the prior
            inside = (counts.get((name, True), 0) + PRIOR * prior / (1 + prior)) / (total[True] + PRIOR)
            outside = (counts.get((name, False), 0) + PRIOR / (1 + prior)) / (total[False] + PRIOR)
            most = LIMITS.get(name, LIMITS.get(name.split(":")[0], 7.0))
            leaning[name] = max(-most, min(most, math.log(inside / outside)))
        stays = {}
        for (place, content), (prior, least, most) in STAYS.items():
            same, other = counts.get((f"stays {place}", content), 0), counts.get((f"leaves {place}", content), 0)
            chance = (same + PRIOR * prior) / (same + other + PRIOR)
            stays[place, content] = min(most, max(least, chance))
        return cls(leaning, stays)


def _below(nodes: list[Node]) -> list[int]:
    total = [len("".join(n.text).strip()) if n.text is not None else 0 for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        total[nodes[i].parent] += total[i]
    return total


def _mark_comments(nodes: list[Node]) -> None:
    """Articles that hold reader comments get the hint of a box.

    They stand in a place named for comments that does not hold the main article, or
    in another article that has more text of its own.
    """
    below = _below(nodes)
    articles = [i for i, n in enumerate(nodes) if n.tag in ("article", "main")]
    if not articles:
        return
    first = next((i for i in articles if nodes[i].hint != "box"), articles[0])
    above, i = {first}, first
    while i > 0:
        i = nodes[i].parent
        above.add(i)
    outer = [0] * len(nodes)  # the innermost article above a node
    read = [False] * len(nodes)
    own = below[:]  # text of an article outside the articles in it
    for i, node in enumerate(nodes[1:], 1):
        outer[i] = node.parent if nodes[node.parent].tag == "article" else outer[node.parent]
        read[i] = read[node.parent] or node.reader and i not in above
        if node.tag == "article" and outer[i]:
            own[outer[i]] -= below[i]
    for i in articles:
        if i != first and (read[i] or nodes[i].tag == "article" and outer[i] and own[outer[i]] >= below[i]):
            nodes[i].hint = "box"


def _places(nodes: list[Node]) -> list[str]:
    """Of each node: 'box' if it is set apart by kind or hint, 'in box' below such a node, else 'plain'."""
    _mark_comments(nodes)
    mains = [n.tag in ("article", "main") for n in nodes]
    # a wrapper of the article is no box, whatever its hints; nor is the article where all are named as boxes
    plain = [i for i, n in enumerate(nodes) if mains[i] and n.hint != "box"] or [i for i in range(len(nodes)) if mains[i]][:1]
    holds = [False] * len(nodes)
    for i in plain:
        holds[i] = True
    for i in range(len(nodes) - 1, 0, -1):
        holds[nodes[i].parent] |= holds[i]
    places = ["plain"] * len(nodes)
    inside = [False] * len(nodes)  # an article; a header there is its own
    for i, node in enumerate(nodes[1:], 1):
        inside[i] = inside[node.parent] or mains[i]
        if holds[i]:
            node.hint = "none" if node.hint == "box" else node.hint
        elif node.tag in BOX or node.hint == "box" or node.tag == "header" and not inside[i]:
            places[i] = "box"
        elif places[node.parent] != "plain":
            places[i] = "in box"
    return places


def labelled(nodes: list[Node]) -> list[bool] | None:
    """Content or not by the page's own markup; None where it has no article or main element."""
    if not any(n.tag in ("article", "main") for n in nodes):
        return None
    content = [False] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        box = node.tag in BOX or node.tag in NO_TEXT or node.hint == "box"
        content[i] = not box and (node.tag in ("article", "main") or content[node.parent])
    return content


def page_counts(page: str) -> Counter:
    """What a page adds to the counts of ``Potentials.of``."""
    nodes = parse(page)
    places = _places(nodes)
    content = labelled(nodes)
    found: Counter = Counter()
    if content is None:
        return found
    below = _below(nodes)
    for i, node in enumerate(nodes):
        found.update((name, content[i]) for name in features(node, below[i]))
        if i and node.tag not in NO_TEXT and node.tag not in ("article", "main"):  # these are told by their kind
            above = content[node.parent]
            found[f"{'stays' if content[i] == above else 'leaves'} {places[i]}", above] += 1
    return found


def marginals(nodes: list[Node], potentials: Potentials) -> list[float]:
    """Chance of each node to be content: messages to the root, then back.

    Elements without text, such as forms, are never content and send no message.
    """
    below, places = _below(nodes), _places(nodes)
    leaning, stays = potentials.leaning, potentials.stays
    # odds of content against not; a message is the odds that a child lends its parent, or a parent its child
    upward = [math.exp(sum(leaning.get(name, 0.0) for name in features(n, below[i]))) for i, n in enumerate(nodes)]
    lent = [1.0] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        node = nodes[i]
        if node.tag in NO_TEXT:
            upward[i] = 0.0
            continue
        keep, stay = stays[places[i], True], stays[places[i], False]
        odds = upward[i]
        lent[i] = (keep * odds + 1 - keep) / ((1 - stay) * odds + stay)
        upward[node.parent] = min(max(upward[node.parent] * lent[i], 1e-12), 1e12)
    full = upward[:]
    for i in range(1, len(nodes)):
        keep, stay = stays[places[i], True], stays[places[i], False]
        rest = full[nodes[i].parent] / lent[i]  # what the parent knows without this child
        down = (keep * rest + 1 - stay) / ((1 - keep) * rest + stay)
        full[i] = min(upward[i] * down, 1e12)
    return [odds / (1 + odds) for odds in full]


def main_text(page: str, potentials: Potentials) -> str:
    """The content blocks of a page, one line each."""
    nodes = parse(page)
    chances = marginals(nodes, potentials)
    hidden = [False] * len(nodes)
    lines = []
    for i, node in enumerate(nodes[1:], 1):
        hidden[i] = hidden[node.parent] or node.tag in NO_TEXT
        if node.text is not None and not hidden[i] and chances[i] >= 0.5:
            line = SPACE.sub(" ", "".join(node.text)).strip()
            if line:
                lines.append(line)
    return "\n".join(lines)


def train(pages: DataFrame, fit_pages: int = FIT_PAGES) -> Potentials:
    """Potentials from a sample of ``pages`` (url, html)."""
    spark = pages.sparkSession
    total = pages.count()
    upto = math.ceil(min(1.0, fit_pages / max(1, total)) * (1 << 20))
    drawn = pages.where(F.pmod(F.xxhash64(F.lit("fit"), "url", F.length("html")), F.lit(1 << 20)) < upto)

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for frame in frames:
            for page in frame["html"]:
                found.update(page_counts(page or ""))
        yield pd.DataFrame(
            {"name": [k[0] for k in found], "content": [k[1] for k in found], "n": list(found.values())}
        ).astype({"name": object, "content": bool, "n": "int64"})

    path = scratch_path(spark, "potentials")
    drawn.select("html").mapInPandas(counted, "name string, content boolean, n long").groupBy("name", "content").agg(
        F.sum("n").alias("n")
    ).write.parquet(path)
    rows = spark.read.parquet(path).collect()  # a few dozen features
    return Potentials.of({(r["name"], r["content"]): r["n"] for r in rows})


def extracted(pages: DataFrame, potentials: Potentials, keep: list[Column]) -> DataFrame:
    """``keep``, text and its length in code points, for every page."""
    schema = pages.select(*keep, F.lit("").alias("text")).schema

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(text=[main_text(page, potentials) for page in frame.pop("_html")])

    texts = pages.select(*keep, whole(F.col("html")).alias("_html")).mapInPandas(read, schema)
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page, by potentials learnt from the pages themselves."""
    return extracted(pages, train(pages), [F.col("page_id"), F.col("url")])
