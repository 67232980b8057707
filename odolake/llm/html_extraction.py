"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element and every block of text is a variable with three labels: other, content, or
frame (an element that is neither but has content below). A node's observations (element
kind, words of class, id and role, length, links, marks) are potentials of its variable; a
parent and its child share a potential that ties their labels, given what the child's own
markup says it is. Messages are passed from the
leaves up and from the root down (sum-product), which gives the exact marginal of every node. Blocks of text with a marginal of one half or more are the main text.

The potentials are smoothed counts over labelled pages: the small set below, written for
this module, and a bounded sample of the given pages as far as their own markup names its
parts (``article``, ``nav`` and so on). What an element says about itself is an observation
among others, so pages without such markup are read by their other traits.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolake.llm.common import staged
from odolake.llm.dom import Node, read

MAX_PAGES = 400  # pages whose own markup is learnt from
SMOOTHING = 0.5
TEMPER = 0.5
SET_WEIGHT = 2.0  # what an occurrence in the labelled set counts
OTHER, CONTENT, FRAME = LABELS = (0, 1, 2)
PAGE_WEIGHT = 200.0  # occurrences of an observation in the given pages that count at most

# fixed values: what pages call their parts
_CONTENT = "article main content entry post story body text maincontent articlebody"
_OTHER = (
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc header masthead banner topbar footer bottom "
    "copyright legal sidebar side aside rail widget related recommended recommendations more teaser promo promotion ad ads "
    "adsense advert adverts advertisement sponsor sponsored outbrain taboola cookie cookies consent gdpr notice notification "
    "alert popup modal overlay newsletter subscribe subscription signup login form search share sharing social follow "
    "comment comments discussion disqus reply replies respondform tags meta byline hidden skip")
CONTENT_WORDS, OTHER_WORDS = frozenset(_CONTENT.split()), frozenset(_OTHER.split())
CONTENT_TAGS = frozenset(("article", "main"))
OTHER_TAGS = frozenset(("nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "search"))
CONTENT_ROLES = frozenset(("main", "article"))
OTHER_ROLES = frozenset((
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar", "alertdialog"))

PLAIN = frozenset("html body div section p ul ol li dl dt dd table tbody thead tr td th center".split())  # say nothing

_NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")

# Labelled pages: ``data-label`` holds from its element downwards.
LABELLED = (
    """<body><header data-label=0><h1>The Daily Kettle</h1><p>News for people who boil water</p><nav><ul><li><a href=a>Home</a>
    <li><a href=b>World</a><li><a href=c>Sport</a></ul></nav></header><main data-label=1><article><h1>A kettle sings in the rain
    </h1><p>Early on Monday, a kettle was heard in the old harbour, and nobody knew whose it was.</p><p>Neighbours came out,
    one after the other, and listened until the steam had gone.</p><h2>What came next</h2><p>By noon it was quiet again.</p>
    <ul><li>One kettle was found.</li><li>Two lids are missing, said the mayor.</li></ul></article></main>
    <aside data-label=0><h3>More stories</h3><ul><li><a href=d>Cups on strike</a><li><a href=e>Spoons return</a></ul></aside>
    <section id=comments class=comments data-label=0><h3>3 comments</h3><div class=comment><p>I heard it too, it was lovely.</p>
    </div><div class=comment><p>My cat did not like the sound at all, but I did.</p></div></section>
    <footer data-label=0><p>&copy; 2020 The Daily Kettle. All rights reserved.</p><a href=f>Imprint</a></footer></body>""",
    """<body><div id=topbar class=nav data-label=0><a href=a>Start</a> <a href=b>Shop</a> <a href=c>Help</a></div>
    <div class="cookie-notice" data-label=0><p>We use cookies to make this page better. <button>Accept</button></p></div>
    <div class=wrap><div class="post content" data-label=1><h2>Walking along the dike</h2><p>The path begins behind the mill and
    follows the water for about six miles, mostly in the open.</p><p>Take a coat, for the wind comes from the sea, and bring
    something to eat.</p><blockquote><p>It is the finest walk in the county, my aunt used to say.</p></blockquote>
    <p>Buses run back every hour.</p></div><div class=sidebar data-label=0><h4>Categories</h4><ul><li><a href=d>Walks</a>
    <li><a href=e>Boats</a></ul><div class=ad>Boots at half price, today only!</div><form><label>Newsletter</label>
    <input name=m><p>Sign up now and never miss a walk.</p></form></div></div>
    <div class=footer data-label=0>Copyright 2019 by the walkers | <a href=g>Contact</a> | <a href=h>Privacy</a></div></body>""",
    """<body><table><tr><td data-label=0><a href=1>Index</a><br><a href=2>Prices</a><br><a href=3>Links</a></td><td data-label=1>
    <p>Our bakery has been in this street since my grandfather bought the house, and the oven is the same.</p>
    <p>We bake rye on Tuesdays and white bread on all other days, except for Sunday.</p></td></tr></table>
    <p class=copyright data-label=0>&copy; the bakery</p></body>""",
    """<body><div role=banner data-label=0><p>Gazette</p></div><div role=navigation data-label=0><a href=a>One</a> <a href=b>Two</a>
    </div><div role=main data-label=1><h1>Council votes on the bridge</h1><p>After a long evening, the council voted for the new
    bridge by nine to four.</p><p>Work is to begin in spring, when the river is low, and will take two years.</p>
    <p>Critics spoke of the costs.</p></div><div class="share-buttons" data-label=0><a href=s>Share this</a>
    <a href=t>Send by mail</a></div><div class="related-posts" data-label=0><h3>You may also like</h3><p><a href=u>The old ferry
    goes on</a></p></div><div id=respond class="comment-form" data-label=0><h3>Leave a reply</h3><p>Your address will not be shown.
    </p></div><div role=contentinfo data-label=0><p>Terms of use. All rights reserved.</p></div></body>""",
    """<body><div class="ad banner" data-label=0>Cheap tyres, call now</div><div class=alert data-label=0><p>This site will be
    down on Sunday from ten to twelve.</p></div><section class=story data-label=1><h1>Snow in the hills</h1><div><p>It began in the
    night, said the warden, and had covered the road by six.</p></div><div><p>Schools stay closed until Thursday.</p></div>
    <figure><figcaption>The road above the village, seen on Tuesday.</figcaption></figure></section>
    <ul class=tags data-label=0><li><a href=x>snow</a><li><a href=y>weather</a></ul><div class=pagination data-label=0>
    <a href=p>Previous</a> <a href=n>Next</a></div></body>""",
    """<h1 data-label=1>A letter</h1><p data-label=1>Dear aunt, the goats are well, and so am I.</p><p data-label=1>They ate the roses.
    </p><ol data-label=1><li>Red ones first.</li><li>Then white.</li></ol>""",
    """<body><div class=header data-label=0><a href=a>The Orchard</a></div><div class="page-content" data-label=1><h1>How to prune a
    pear</h1><div class=byline data-label=0>By A. Gardener, 3 March</div><p>Wait for a dry day in late winter, and sharpen your
    shears.</p><div class=ad data-label=0>Shears from nine pounds</div><p>Cut above a bud that points outwards; the shoot will
    follow it.</p><form class=signup data-label=0><p>Get our letter every Friday.</p><input name=m></form><p>Paint large cuts, and
    feed the tree in May.</p><div class=share data-label=0><a href=s>Share</a> <a href=t>Print</a></div></div>
    <div class=footer data-label=0>All rights reserved. <a href=i>Imprint</a></div></body>""",
    """<body><header data-label=0><nav><a href=a>Home</a></nav></header><article data-label=1><header data-label=0><a href=x>Science</a>
    <p>4 minutes to read</p></header><p>The comet will be seen again in forty years, the observatory says.</p>
    <aside data-label=0><h4>Read also</h4><p>Ten comets you have missed.</p></aside><p>It was first drawn by a monk, who took it for
    a lantern.</p><div class=notice data-label=0><p>This text was changed on Friday.</p></div><p>Its tail is dust and ice.</p>
    <footer data-label=0><p>Filed under: sky</p></footer></article><div class=comments data-label=0><h3>Comments</h3>
    <article class=comment><p>I saw it as a child, it was green.</p></article><article class="comment reply"><p>You did not, it
    was white.</p></article></div></body>""",
)


def _kind(node: Node) -> int | None:
    """What an element's own markup says: 1 content, 0 not, None nothing."""
    role = node.attrs.get("role", "").lower()
    if node.tag == "#text":
        return None
    if node.tag in OTHER_TAGS or role in OTHER_ROLES or "hidden" in node.attrs:
        return 0
    names = {w.lower() for w in _NAME.findall(f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}")}
    if names & OTHER_WORDS:
        return 0
    if node.tag in CONTENT_TAGS or role in CONTENT_ROLES or names & CONTENT_WORDS:
        return 1
    return None


def observations(node: Node, parent: Node) -> list[str]:
    """What is seen of a node; each is a potential of its own."""
    if node.tag != "#text":
        return ["element"] if node.tag in PLAIN else [f"tag {node.tag}"]
    text, n = node.text, len(node.text)
    links = node.linked * 4 // n
    marks = sum(text.count(c) for c in ".,;:!?")
    out = [f"length {min(6, n.bit_length() - 3)}", f"links {links}", f"in {parent.tag if parent.tag not in PLAIN else 'element'}", f"marks {min(3, marks)}"]
    if "©" in text or "ll rights reserved" in text:
        out.append("copyright")
    return out


def labelled(html: str, by_markup: bool) -> tuple[list[Node], list[int | None]]:
    """Nodes of a page and their labels, by ``data-label`` or by what the markup says, handed down.

    What is unlabelled is a frame if it holds content, else other.

    With ``by_markup`` a page without a named main part has no labels at all.
    """
    nodes = read(html)
    labels: list[int | None] = [None] * len(nodes)
    for k, node in enumerate(nodes[1:], 1):
        above = labels[node.parent]
        if by_markup:
            own = _kind(node)
            labels[k] = 0 if above == 0 or own == 0 else 1 if above == 1 or own == 1 else None
        else:
            own = node.attrs.get("data-label")
            labels[k] = above if own is None else int(own)
    if by_markup and 1 not in labels:
        return nodes, [None] * len(nodes)
    inside = [False] * len(nodes)
    for k in range(len(nodes) - 1, 0, -1):
        inside[k] = inside[k] or labels[k] == 1
        inside[nodes[k].parent] |= inside[k]
    return nodes, [(FRAME if inside[k] else OTHER) if label is None else label for k, label in enumerate(labels)]


def counts(html: str, by_markup: bool) -> Counter:
    """How often an observation or a pair of labels occurs with a label."""
    nodes, labels = labelled(html, by_markup)
    out: Counter = Counter()
    for k, node in enumerate(nodes[1:], 1):
        if labels[k] is None:
            continue
        out.update((o, labels[k]) for o in observations(node, nodes[node.parent]))
        above = labels[node.parent]
        if above is not None:
            out[f"below {above} {_kind(node)}", labels[k]] += 1
        out["label", labels[k]] += 1
    return out


class Model:
    """Potentials as factors, from counts of observations and label pairs."""

    def __init__(self, seen: dict[tuple[str, int], float]):
        total = [seen.get(("label", y), 0.0) + 1 for y in LABELS]
        self.prior = [total[y] / sum(total) for y in LABELS]
        names = {o for o, _ in seen if o != "label" and not o.startswith("below")}
        self.factors = {o: [(seen.get((o, y), 0.0) + SMOOTHING) / (total[y] + 2 * SMOOTHING) for y in LABELS] for o in names}
        # traits of a text go together, and so do those of its neighbours: they count less than once
        self.text = {o: [x**TEMPER for x in f] for o, f in self.factors.items()}
        self.ties = {}
        for said in (None, 0, 1):
            rows = [[seen.get((f"below {a} {said}", y), 0.0) + SMOOTHING for y in LABELS] for a in LABELS]
            self.ties[said] = [[x / sum(row) for x in row] for row in rows]

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content for every node, by one pass up and one down; factors are rescaled on the way."""
        n = len(nodes)
        ties = [self.ties[_kind(node)] for node in nodes]
        own = [[1.0, 1.0, 1.0] for _ in range(n)]
        own[0] = list(self.prior)
        told = set()
        for k in range(1, n):
            node, mine = nodes[k], own[k]
            if node.text:
                mine[FRAME] = 1e-6  # text is no frame
                if node.text in told:  # says nothing new
                    continue
                told.add(node.text)
            for o in observations(node, nodes[node.parent]):
                f = (self.text if node.tag == "#text" else self.factors).get(o)
                if f:
                    mine[0] *= f[0]
                    mine[1] *= f[1]
                    mine[2] *= f[2]
        up: list[list[float]] = [[]] * n  # message of a node to its parent
        for k in range(n - 1, 0, -1):  # by now ``own`` holds all messages from below
            a, b, c = own[k] = _scaled(own[k])
            message = up[k] = [t[0] * a + t[1] * b + t[2] * c for t in ties[k]]
            above = own[nodes[k].parent]
            above[0] *= message[0]
            above[1] *= message[1]
            above[2] *= message[2]
            if above[0] + above[1] + above[2] < 1e-100:
                above[:] = _scaled(above)
        belief = [_scaled(own[0])] * n
        for k in range(1, n):
            above, message = belief[nodes[k].parent], up[k]
            a, b, c = above[0] / message[0], above[1] / message[1], above[2] / message[2]
            tie = ties[k]
            belief[k] = _scaled([own[k][y] * (a * tie[0][y] + b * tie[1][y] + c * tie[2][y]) for y in LABELS])
        return [b[1] / (b[0] + b[1] + b[2]) for b in belief]

    def extract(self, html: str) -> str:
        nodes = read(html)
        content = self.marginals(nodes)
        return "\n".join(n.text for n, p in zip(nodes, content) if n.tag == "#text" and p >= 0.5)


def _scaled(x: list[float]) -> list[float]:
    """The largest factor becomes 1, and none 0."""
    top = max(x) or 1.0
    return [max(v / top, 1e-250) for v in x]


def learn(pages: DataFrame | None = None, html: str = "html", max_pages: int = MAX_PAGES) -> Model:
    """The model from the labelled set and about ``max_pages`` of ``pages``, chosen by a hash of the page."""
    seen: Counter = Counter()
    for page in LABELLED:
        seen.update({k: SET_WEIGHT * c for k, c in counts(page, by_markup=False).items()})
    if pages is not None:
        parts = 1 << 20
        share = int(parts * min(1.0, max_pages / max(1, pages.count())))
        sample = staged(pages.select(F.col(html).alias("h")).where(
            F.col("h").isNotNull() & (F.pmod(F.xxhash64(F.lit(9), "h"), F.lit(parts)) < share)), "page-sample")

        def count(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total: Counter = Counter()
            for frame in frames:
                for page in frame["h"]:
                    total.update(counts(page, by_markup=True))
            yield pd.DataFrame([(o, y, c) for (o, y), c in total.items()], columns=["o", "y", "c"]).astype(
                {"o": object, "y": "int64", "c": "int64"})

        found = sample.mapInPandas(count, "o string, y long, c long").groupBy("o", "y").agg(F.sum("c").alias("c"))
        rows = [r for r in found.collect() if r.o != "label"]  # one row per kind of observation
        most = max((r.c for r in rows), default=1)
        for r in rows:  # the labelled set keeps its say
            seen[r.o, r.y] += PAGE_WEIGHT * r.c / most
            if r.o.startswith(("tag ", "element", "length ")):  # one of these for every node
                seen["label", r.y] += PAGE_WEIGHT * r.c / most
    return Model(dict(seen))


def extract(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``.

    Character references are decoded, white space inside a block becomes one space, and
    blocks are joined in page order by a line end. A missing or empty page has an empty
    text; so has one without main text. Repeated pages give repeated rows.
    """
    model = learn(pages, html) if model is None else model

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [model.extract(h) if h else "" for h in frame["h"]]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [
                len(t) for t in texts]})

    source = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("h"))
    kinds = [source.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return source.mapInPandas(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
