"""Main-text extraction by the maximum-scoring subsequence of a page's tokens.

A page becomes a sequence of tokens: words, and tags.  Every word has a positive score
and every tag a negative one, and all weights are learned from labelled pages:

* a word's weight is the chance that a word in such surroundings (linked or not, in a
  heading, in a long or a short block) is article text;
* a tag's own weight is the share of such tags that stand away from the article;
* the begin tag of an element also takes back the words that it holds, in proportion to
  the learned odds that an element of its kind is furniture.  The odds are a logistic
  regression over the element's name, the words in its class, id, role and itemprop, the
  names it holds and stands in, its size, its share of links and of the page's words.
  No name or attribute word has a meaning that wasn't learned.

One linear scan over the tokens finds the contiguous region of the largest sum.  An
element that is likelier furniture and sums below zero is passed over by the scan: it
costs the region ``PASS`` and gives it no words.  What is no text by the rules of HTML
(script, style, title, hidden elements, ...) is no token at all.

Labelled pages are drawn by a generator of page layouts in this module
(``labelled_pages``); the tables have no page labels.
"""

from __future__ import annotations

import html as _html
import random
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from spherelake.llm.common import map_texts, schema_with
from spherelake.llm.hashed import fit_logistic

#: Elements whose content is no text of the page (fixed values).
RAW = frozenset("script style noscript template svg math iframe object canvas head title textarea select option datalist audio video map".split())
#: Elements that may stand in a page's head; any other begin tag, and text, ends it (fixed values).
HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head".split())
#: Elements that never have an end tag (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand in a line of text; all others end a block (fixed values).
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var br wbr img".split())
#: An end tag that is left out: a begin of one of these ends an open one (fixed values).
CLOSES = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]), "body": frozenset(["head"]),
}
#: Begin tags that end an open paragraph (fixed values).
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul body".split())
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])

#: What passing over an element costs a region.
PASS = 0.25
#: A word's least score, and a tag's (negative) one: words score positive and tags negative.
LEAST = 0.02
#: Log-odds of furniture beyond which an element is no article even if the page has no other text.
MAYBE = 4.0
#: A feature of elements is learned if so many of the labelled pages' elements have it; the weight of its square in the loss.
SUPPORT, L2, ROUNDS = 8, 1e-5, 300
#: Begin tags take back at most so many times the words they hold.
MOST = 3.0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
_ATTR = re.compile(r"""\b(class|id|role|itemprop|hidden|style|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "textarea", "title", "iframe", "noscript")}


def attributes(attrs: str) -> tuple[bool, tuple[str, ...]]:
    """Whether the attributes hide the element, and the distinct words of its class, id, role and itemprop."""
    words: dict[str, None] = {}
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDES.search(value):
            return True, ()
        if key not in ("style", "aria-hidden"):
            words |= dict.fromkeys(w.lower() for w in _SPLIT.split(value) if w)
    return False, tuple(words)


@dataclass
class Element:
    name: str
    words: tuple[str, ...]
    parent: int
    begin: int
    end: int = -1
    #: Names and attribute words of the elements it stands in, and names of those it holds.
    inside: tuple[str, ...] = ()
    holds: set[str] = field(default_factory=set)
    n: int = 0
    linked: int = 0


def parse(page: str) -> tuple[list[tuple], list[Element]]:
    """Tokens in page order and elements.

    A token is ("tag", name, element or -1, whether it begins that element) or ("word",
    block, piece, element or -1, linked, in a heading, words).  ``piece`` is a stretch of
    text as it stands.  A new ``block`` number begins at every tag that isn't inline.
    Unclosed and stray tags are tolerated; an unclosed comment, script or quoted
    attribute ends with the page.  Head and body may be implied.
    """
    out: list[tuple] = []
    elements: list[Element] = []
    stack: list[tuple[str, int]] = []  # name, and element (-1: no text; -2: of no interest)
    open_: list[int] = []
    around: Counter = Counter()
    block, i, n = 0, 0, len(page)
    drop = link = 0

    def begin(name: str, attrs: str) -> None:
        nonlocal drop, link
        hides, words = attributes(attrs) if "=" in attrs or "hidden" in attrs.lower() else (False, ())
        if name in RAW or hides or drop:
            stack.append((name, -1))
            drop += 1
            return
        link += name == "a"
        if name in ("html", "body") or name in INLINE and not words:
            stack.append((name, -2))
            out.append(("tag", name, -1, False))
            return
        e = Element(name, words, open_[-1] if open_ else -1, len(out), inside=tuple(k for k, c in around.items() if c))
        elements.append(e)
        stack.append((name, len(elements) - 1))
        open_.append(len(elements) - 1)
        around[name] += 1
        for w in words:
            around["." + w] += 1
        out.append(("tag", name, len(elements) - 1, True))

    def close(to: int, tag: str) -> None:
        """Close what is open from place ``to`` on; ``tag`` is the end tag that does, or empty."""
        nonlocal drop, link
        while len(stack) > to:
            name, k = stack.pop()
            if k == -1:
                drop -= 1
                continue
            link -= name == "a"
            if k == -2:
                if len(stack) == to and tag:
                    out.append(("tag", "/" + name, -1, False))
                continue
            e = elements[k]
            out.append(("tag", "/" + name, k, False))
            e.end = len(out)
            open_.pop()
            around[name] -= 1
            for w in e.words:
                around["." + w] -= 1
            if e.parent >= 0:
                p = elements[e.parent]
                p.holds |= e.holds
                p.holds.add(name)
                p.n += e.n
                p.linked += e.linked

    while i < n:
        m = _TOKEN.match(page, i)
        if m is None:  # a tag that the page's end cuts off
            if page.startswith("<", i):
                j = page.find(">", i)
                i = n if j < 0 else j + 1
                continue
            break
        i = m.end()
        text = m["text"] if m["text"] is not None else m["cdata"]
        if text is not None:
            if stack and stack[-1][0] == "head" and not text.isspace():
                close(len(stack) - 1, "")
            if not drop:
                size = len(text.split())
                heading = bool(stack) and stack[-1][0] in HEADINGS
                out.append(("word", block, text, open_[-1] if open_ else -1, link > 0, heading, size))
                if open_:
                    elements[open_[-1]].n += size
                    elements[open_[-1]].linked += size * (link > 0)
            continue
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if stack and stack[-1][0] == "head" and not m["end"] and name not in HEAD:
            close(len(stack) - 1, "")
        if name not in INLINE:
            block += 1
        elif name in ("br", "wbr", "img") and not m["end"] and not drop:
            out.append(("word", block, " " if name != "wbr" else "", open_[-1] if open_ else -1, False, False, 0))
        if m["end"]:
            # An end tag closes up to its begin; a stray one, or one beyond a sectioning border, closes nothing.
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k, name)
                    break
                if name in INLINE and stack[k][0] not in INLINE or name == "p" and stack[k][0] in ENDS_P - {"p"}:
                    break
            continue
        if name in ENDS_P or name in CLOSES:
            ends = CLOSES.get(name, frozenset(["p"]))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    close(k, "")
                    break
                if stack[k][0] not in INLINE and stack[k][0] != "p":
                    break
        attrs = m["attrs"] or ""
        if name in VOID or attrs.rstrip().endswith("/") and name not in RAW:
            if not drop:
                out.append(("tag", name, -1, False))
                if open_:
                    elements[open_[-1]].holds.add(name)
            continue
        if name in _ENDS:
            end = _ENDS[name].search(page, i)
            i = end.end() if end else n
            block += 1
            if open_ and not drop:
                elements[open_[-1]].holds.add(name)
            continue
        begin(name, attrs)
    close(0, "")
    return out, elements


def element_features(e: Element, all_words: int, known: dict[str, float] | None = None) -> list[str]:
    """What the odds of an element are learned from, if ``known``; ``all_words`` are the unlinked words of the page."""
    share = (e.n - e.linked) / max(1, all_words)
    size = "0" if e.n == 0 else str(min(8, e.n.bit_length()))
    links = "none" if e.n == 0 else str(int(4 * e.linked / e.n))
    shares = sum(share >= x for x in (0.02, 0.1, 0.3, 0.5, 0.8))
    out = [f"name:{e.name}", f"size:{size}", f"links:{links}", f"share:{shares}"]
    out += [f"word:{w}" for w in e.words if known is None or f"word:{w}" in known]
    # A name without a word that says something is a feature of its own, as is its size beside such a word.
    named = len(out) > 4
    out.append(f"named:{shares}" if named else f"bare:{e.name}")
    out += [f"in:{k}" for k in e.inside]
    out += [f"{'named' if named else 'bare'} holds:{k}" for k in e.holds]
    return out


def token_features(tokens: list[tuple]) -> list[str]:
    """For every token the feature that its own weight belongs to."""
    words_in: Counter = Counter()
    linked: Counter = Counter()
    for t in tokens:
        if t[0] == "word" and t[6]:
            words_in[t[1]] += t[6]
            linked[t[1]] += t[6] * t[4]
    out = []
    for t in tokens:
        if t[0] == "tag":
            out.append(f"tag:{t[1]}")
        else:
            kind = "heading" if t[5] else "long" if words_in[t[1]] >= 12 else "short"
            out.append(f"word:{'linked' if 2 * linked[t[1]] > words_in[t[1]] else 'plain'}:{kind}")
    return out


class Weights:
    """Learned weights: of words and tags by feature, of an element's features, and the bias of its odds.

    A tag that no labelled page has gets the mean tag's weight; unknown features of an
    element say nothing about it.
    """

    def __init__(self, scores: dict[str, float], odds: dict[str, float], bias: float):
        self.scores, self.odds, self.bias = scores, odds, bias
        tags = [v for k, v in scores.items() if k.startswith("tag:")]
        words = [v for k, v in scores.items() if k.startswith("word:")]
        self.tag = sum(tags) / len(tags) if tags else -LEAST
        self.word = sum(words) / len(words) if words else 0.5

    def of(self, feature: str) -> float:
        got = self.scores.get(feature)
        return got if got is not None else self.tag if feature.startswith("tag:") else self.word

    def furniture(self, e: Element, all_words: int) -> float:
        """The log-odds that an element is furniture."""
        return self.bias + sum(self.odds.get(f, 0.0) for f in element_features(e, all_words, self.odds))


def unlinked_words(tokens: list[tuple]) -> int:
    return sum(t[6] for t in tokens if t[0] == "word" and not t[4])


def block_texts(tokens) -> dict[int, str]:
    """The text of each block: character references decoded, white space made one space, trimmed."""
    blocks: dict[int, list[str]] = {}
    for t in tokens:
        blocks.setdefault(t[1], []).append(t[2])
    return {k: _SPACE.sub(" ", _html.unescape("".join(x))).strip() for k, x in blocks.items()}


def fit(pages: list[tuple[str, str]]) -> Weights:
    """Weights from labelled pages (html, main text: the article's blocks in page order, one a line).

    An element is furniture if less than half of its words belong to the main text.
    Elements inside one that is furniture altogether say nothing more and aren't learned
    from, nor are those without words.
    """
    inside: Counter = Counter()
    total: Counter = Counter()
    met: list[tuple[Element, int]] = []
    y: list[float] = []
    for page, main in pages:
        tokens, elements = parse(page)
        lines = main.split("\n")
        texts = block_texts(t for t in tokens if t[0] == "word")
        at, is_main = 0, set()
        for k, text in texts.items():
            if at < len(lines) and text and text == lines[at]:
                is_main.add(k)
                at += 1
        found = token_features(tokens)
        touched: list[bool | None] = [t[1] in is_main if t[0] == "word" and t[6] else None for t in tokens]
        for t, f, x in zip(tokens, found, touched):
            if x is not None:
                inside[f] += t[6] * x
                total[f] += t[6]
        # A tag counts as inside if the nearest word before it or after it is.
        before, near = False, [False] * len(tokens)
        for i, x in enumerate(touched):
            before = before if x is None else x
            near[i] = before
        after = False
        for i in range(len(tokens) - 1, -1, -1):
            after = after if touched[i] is None else touched[i]
            if tokens[i][0] == "tag":
                inside[found[i]] += near[i] or after
                total[found[i]] += 1
        mine = [0] * len(elements)
        for t in tokens:
            if t[0] == "word" and t[3] >= 0:
                mine[t[3]] += t[6] * (t[1] in is_main)
        for k in range(len(elements) - 1, -1, -1):
            if elements[k].parent >= 0:
                mine[elements[k].parent] += mine[k]
        words = unlinked_words(tokens)
        for k, e in enumerate(elements):
            if e.n and (e.parent < 0 or mine[e.parent]):
                met.append((e, words))
                y.append(float(2 * mine[k] < e.n))
    scores = {}
    for feature, n in total.items():
        p = (inside[feature] + 0.5) / (n + 1)
        # Of a word: how likely it is article text.  Of a tag: how likely it isn't beside it.
        scores[feature] = max(LEAST, p) if feature.startswith("word:") else -max(LEAST, 0.25 * (1 - p))
    support = Counter(f for e, words in met for f in element_features(e, words))
    often = {f: 0.0 for f, n in support.items() if n >= SUPPORT}
    rows = [element_features(e, words, often) for e, words in met]
    names = {f: i for i, f in enumerate(sorted({f for r in rows for f in r if f in often or f.startswith(("bare", "named"))}))}
    x = np.zeros((len(rows), len(names)), np.float32)
    for i, r in enumerate(rows):
        x[i, [names[f] for f in r if f in names]] = 1
    w = fit_logistic(x, np.array(y, np.float32), rounds=ROUNDS, rate=0.2, l2=L2) if rows else np.zeros(1)
    return Weights(scores, {f: float(w[i]) for f, i in names.items()}, float(w[-1]))


def scored(tokens: list[tuple], elements: list[Element], weights: Weights, odds: list[float]) -> tuple[list[float], list[bool]]:
    """The score of every token, and whether it lies in an element that is passed over; ``odds`` are the elements'."""
    found = token_features(tokens)
    scores = [weights.of(f) * (t[6] if t[0] == "word" else 1) for t, f in zip(tokens, found)]
    held = [0.0] * (len(elements) + 1)  # word scores inside, without what is passed over; the last for the page
    sums = [0.0] * (len(elements) + 1)
    for t, s in zip(tokens, scores):
        k = t[3] if t[0] == "word" else t[2]
        sums[k] += s
        held[k] += s * (t[0] == "word")
    passed = [False] * len(elements)
    for k in range(len(elements) - 1, -1, -1):  # inner ones come after outer ones
        e = elements[k]
        back = held[k] * min(MOST, max(0.0, 1 + odds[k]))
        scores[e.begin] -= back
        sums[k] -= back
        if odds[k] > 0 and sums[k] < 0:
            passed[k] = True
            held[k], sums[k] = 0.0, -PASS
        held[e.parent] += held[k]
        sums[e.parent] += sums[k]
    over = [False] * len(tokens)
    until = 0
    for k, e in enumerate(elements):
        if passed[k] and e.begin >= until:
            until = e.end
            for i in range(e.begin, until):
                scores[i], over[i] = 0.0, True
            scores[e.begin] = -PASS
    return scores, over


def likeliest(elements: list[Element], odds: list[float]) -> int:
    """Where the scan passes over all words: the element with the most words that may yet be article text, or -1.

    Its unlinked words count by the chance that it is no furniture; a chance below that
    of odds of MAYBE is none.
    """
    best, at = 0.0, -1
    for k, (e, x) in enumerate(zip(elements, odds)):
        chance = (e.n - e.linked) / (1 + np.exp(x)) if 0 < x <= MAYBE else 0.0
        if chance > best:
            best, at = chance, k
    return at


def best_region(scores: list[float]) -> tuple[int, int]:
    """The contiguous range with the largest positive sum, the first and longest of equals; (0, 0) if none."""
    best, at, to, total, begin = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best + 1e-12 or (total > best - 1e-12 and begin == at and best > 0):
            best, at, to = max(best, total), begin, i + 1
    return at, to


def extract(page: str, weights: Weights) -> str:
    """The main text: blocks joined by newlines, white space inside a block made one space."""
    tokens, elements = parse(page)
    words = unlinked_words(tokens)
    odds = [weights.furniture(e, words) for e in elements]
    scores, over = scored(tokens, elements, weights, odds)
    a, b = best_region(scores)
    if a == b and (k := likeliest(elements, odds)) >= 0:
        while k >= 0:
            odds[k] = -1.0
            k = elements[k].parent
        scores, over = scored(tokens, elements, weights, odds)
        a, b = best_region(scores)
    return "\n".join(x for x in block_texts(t for t, o in zip(tokens[a:b], over[a:b]) if t[0] == "word" and not o).values() if x)


#: Words of class, id and role that labelled pages give to furniture of each kind, and to the article (fixed values).
NAMES = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager skip",
    "header": "header masthead banner",
    "footer": "footer copyright legal disclaimer contentinfo",
    "aside": "sidebar widget complementary related recommended recommendations trending popular",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay",
    "ad": "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion",
    "form": "newsletter subscribe subscription signup login search",
    "comments": "comment comments commentlist respond reply replies disqus discussion",
    "share": "share sharing social",
    "article": "article main content post entry story body text articlebody maincontent",
}


class _Layouts:
    """Draws pages of varied layout."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.syllables = "ka lo mi re sun ter va do qui pa en str ing ou".split()

    def some(self, p: float) -> bool:
        return self.rng.random() < p

    def word(self) -> str:
        return "".join(self.rng.choices(self.syllables, k=self.rng.randint(1, 4)))

    def plain(self) -> str:
        """A word of attributes that says nothing."""
        return "".join(self.rng.choices(self.syllables, k=4))

    def prose(self, a: int, b: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(a, b)))

    def paragraphs(self, a: int, b: int, most: int) -> str:
        return "".join(f"<p>{self.prose(3, most)}</p>" for _ in range(self.rng.randint(a, b)))

    def links(self, a: int, b: int) -> str:
        one = [f'<a href="/{self.word()}">{self.prose(1, 4)}</a>' for _ in range(self.rng.randint(a, b))]
        return self.rng.choice(["<ul>%s</ul>" % "".join(f"<li>{x}</li>" for x in one), " ".join(one), " | ".join(one), "".join(f"<p>{x}</p>" for x in one)])

    def named(self, kind: str) -> str:
        """An attribute that names a kind, alone or among words that mean nothing."""
        w = self.rng.choice(NAMES[kind].split())
        if kind in ("comments", "aside", "ad", "share", "nav") and self.some(0.25):
            w = f"{self.rng.choice(['post', 'main', 'content', 'article', 'story'])}-{w}"
        w = self.rng.choice([w, w, w, f"{self.plain()}-{w}", f"{w}-{self.plain()}", f"{w} {self.plain()}", w.capitalize() + self.plain().capitalize()])
        return f"{self.rng.choice(['class', 'class', 'id', 'role' if '-' not in w else 'id'])}=\"{w}\""

    def wrap(self, kind: str, inner: str, names: str) -> str:
        """Furniture of a kind: an element whose name says so, or one whose attributes do."""
        name = self.rng.choice(names.split()) if names else ""
        if name and self.some(0.5):
            return f"<{name}{' ' + self.named(kind) if self.some(0.3) else ''}>{inner}</{name}>"
        name = self.rng.choice(["div", "div", "section", "p" if "<" not in inner else "div", "ul" if inner.startswith("<li") else "div", "span" if "<" not in inner else "div"])
        return f"<{name} {self.named(kind)}>{inner}</{name}>"

    def furniture(self, kind: str) -> str:
        rng = self.rng
        if kind == "nav":
            return self.wrap(kind, self.links(1, 12), "nav nav menu")
        if kind == "header":
            return self.wrap(kind, rng.choice(["", f"<h2>{self.prose(1, 4)}</h2>", f"<p>{self.prose(1, 8)}</p>"]) + rng.choice(["", self.furniture("nav"), self.links(2, 6), f"<p>{self.prose(3, 12)}</p>"]), "header")
        if kind == "footer":
            return self.wrap(kind, rng.choice([f"&copy; {self.prose(2, 20)}", f"<p>{self.prose(4, 40)}</p>", self.links(2, 9), f"{self.prose(3, 12)} {self.links(1, 4)}", self.paragraphs(1, 3, 30)]), "footer")
        if kind == "aside":
            return self.wrap(kind, rng.choice(["", f"<h3>{self.prose(1, 4)}</h3>"]) + rng.choice([self.links(2, 10), self.paragraphs(1, 3, 40), self.links(1, 4) + self.paragraphs(1, 2, 30)]), "aside")
        if kind == "notice":
            return self.wrap(kind, rng.choice([self.prose(4, 40), self.paragraphs(1, 2, 30), f"<p>{self.prose(4, 30)}</p><button>{self.prose(1, 2)}</button>"]), "dialog")
        if kind == "ad":
            return self.wrap(kind, rng.choice([self.prose(2, 30), self.paragraphs(1, 2, 30), f"<a href='/x'>{self.prose(2, 12)}</a>"]), "aside")
        if kind == "form":
            inner = rng.choice(["", f"<p>{self.prose(2, 20)}</p>", self.prose(2, 8)]) + f"<label>{self.prose(1, 3)}</label><input name='x'>" + rng.choice(["", f"<button>{self.prose(1, 2)}</button>", f"<fieldset>{self.prose(1, 4)}</fieldset>"])
            return rng.choice([f"<form>{inner}</form>", f"<form {self.named(kind)}>{inner}</form>", self.wrap(kind, f"<form>{inner}</form>", ""), self.wrap(kind, self.paragraphs(1, 2, 25), "")])
        if kind == "share":
            return self.wrap(kind, rng.choice([self.links(2, 6), self.prose(1, 6), f"<button>{self.prose(1, 2)}</button><button>{self.prose(1, 2)}</button>"]), "")
        # Reader comments, which may be longer than the article.
        one = rng.choice(["<li>%s</li>", "<div>%s</div>", '<div class="comment">%s</div>', '<article class="comment">%s</article>', "%s"])
        inner = "".join(one % (rng.choice(["", f"<h4>{self.prose(1, 3)}</h4>", f"<b>{self.prose(1, 2)}</b> "]) + self.paragraphs(1, 3, rng.choice([20, 60, 150]))) for _ in range(rng.choice([1, 2, 4, 9])))
        inner = rng.choice(["", f"<h3>{self.prose(1, 4)}</h3>"]) + (f"<ul>{inner}</ul>" if inner.startswith("<li") else inner) + rng.choice(["", "", self.furniture("form")])
        return self.wrap(kind, inner, "")

    def body(self) -> tuple[str, list[str]]:
        """The article's markup and its blocks."""
        rng, out, main = self.rng, [], []
        title = self.prose(2, 9)
        if self.some(0.8):
            main.append(title)
            out.append(rng.choice(["<h1>%s</h1>", "<h1>%s</h1>", "<header><h1>%s</h1></header>", '<h2 class="title">%s</h2>']) % title)
        for _ in range(rng.choice([1, 2, 3, 4, 6, 9, 14])):
            if self.some(0.12):
                out.append(self.furniture(rng.choice(["ad", "ad", "share", "aside", "form", "notice", "nav"])))
            if self.some(0.15):
                main.append(self.prose(1, 7))
                out.append(f"<h{(k := rng.choice([2, 3, 4]))}>{main[-1]}</h{k}>")
            if self.some(0.15):
                listed = [self.prose(1, 14) for _ in range(rng.randint(1, 7))]
                main += listed
                kind, close = rng.choice(["ul", "ol"]), rng.choice(["", "</li>"])
                out.append(f"<{kind}>{''.join(f'<li>{x}{close}' for x in listed)}</{kind}>")
            if self.some(0.1):
                main.append(self.prose(3, 40))
                out.append(rng.choice(["<blockquote><p>%s</p></blockquote>", "<blockquote>%s</blockquote>", "<pre>%s</pre>", "<figure><img src='a.png'><figcaption>%s</figcaption></figure>", "<div><p>%s</p></div>", "<section><p>%s</p></section>", "<dl><dd>%s</dl>"]) % main[-1])
            if self.some(0.1):
                cells = [[self.prose(1, 3) for _ in range(3)] for _ in range(rng.randint(1, 5))]
                main += [c for r in cells for c in r]
                out.append(f"<table>{''.join('<tr>' + ''.join(f'<td>{c}</td>' for c in r) + '</tr>' for r in cells)}</table>")
            words = self.prose(2, rng.choice([8, 40, 130])).split()
            main.append(" ".join(words))
            if len(words) > 6 and self.some(0.4):
                words[2], words[4] = f"<a href='#'>{words[2]}</a>", f"<b>{words[4]}</b>"
            out.append(f"<p>{' '.join(words)}" + "</p>" * self.some(0.8))
        return "".join(out), main

    def page(self) -> tuple[str, str]:
        rng = self.rng
        inner, main = self.body()
        content = inner
        if self.some(0.85):
            name = rng.choice(["article", "main", "div", "div", "section", "td"])
            attr = ""
            if self.some(0.75 if name in ("div", "section", "td") else 0.3):
                attr = self.named("article")
                if self.some(0.5):  # names that speak of furniture about the article itself
                    other = rng.choice(" ".join(v for k, v in NAMES.items() if k not in ("article", "comments")).split())
                    attr = rng.choice([attr[:-1] + f" with-{other}\"", attr[:-1] + f" no-{other}\"", attr[:-1] + f" {other}-{self.plain()}\"", f'class="{other}-{self.plain()}"', f"{attr} data-x='{other}'"])
            content = f"<{name} {attr}>{inner}</{name}>" if name != "td" else f"<table><tr><td {attr}>{inner}</td></tr></table>"
        elif self.some(0.5):
            content = f'<div class="{rng.choice(" ".join(NAMES.values()).split())}"><article>{inner}</article></div>'
        for _ in range(rng.choice([0, 0, 1, 2])):
            content = f"<div{rng.choice(['', ' class=%s' % self.plain(), ' id=%s' % self.plain()])}>{content}</div>"
        pick = lambda kinds, most: "".join(self.furniture(rng.choice(kinds)) for _ in range(rng.randint(0, most)))
        top = pick(["nav", "nav", "header", "header", "notice", "ad", "form", "share"], 4)
        low = pick(["aside", "aside", "comments", "comments", "form", "share", "nav", "ad", "notice"], 4) + (self.furniture("footer") if self.some(0.85) else "")
        if self.some(0.15):
            low += f"<ul>{''.join(f'<li><a href=/{k}>{self.prose(1, 4)}</a></li>' for k in range(rng.randint(3, 9)))}</ul>"
        if self.some(0.3):
            content = f"<div>{content}{self.furniture('aside')}</div>"
        head = f"<head><title>{self.prose(2, 6)}</title><style>p{{}}</style><script>var a='<p>';</script></head>" * self.some(0.9)
        shell = rng.choice(["<!DOCTYPE html><html>%s<body>%s</body></html>", "<html>%s<body class='with-sidebar'>%s", "%s<body>%s</body>"])
        return shell % (head, top + content + low), "\n".join(main)


def labelled_pages(n: int = 800, seed: int = 11) -> list[tuple[str, str]]:
    """Pages of varied layout with their main text, one block a line, drawn from a fixed seed."""
    made = _Layouts(seed)
    return [made.page() for _ in range(n)]


@lru_cache(1)
def default_weights() -> Weights:
    return fit(labelled_pages())


def extract_pages(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), weights: Weights | None = None) -> DataFrame:
    """``keep``, ``text`` string and ``n_chars`` long for every row.

    Null or empty html gives an empty text; a page without a word of content too.  The
    whole html is read, however long.  Of equal sums the first region counts.  Repeated
    rows each give a row, and an empty table none.  Columns of ``keep`` named text or
    n_chars are left out.
    """
    learned = weights or default_weights()
    kept, schema = schema_with(pages, keep, "text string, n_chars bigint")

    def make():
        def work(texts: list[str]) -> dict[str, object]:
            got = [extract(t, learned) for t in texts]
            return {"text": got, "n_chars": [len(t) for t in got]}

        return work

    return map_texts(pages, kept, html, schema, make)
