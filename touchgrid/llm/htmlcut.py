"""Main text of web pages by a minimum cut.

Each text block of a page is a node. A logistic classifier turns its features into terminal
capacities (source: content, sink: boilerplate); blocks next to each other, and blocks close
in the element tree, are tied by smoothness edges. The minimum cut is the labelling of least
total cost; its source side, in page order, is the main text.

The classifier is fitted on the blocks of at most `FIT_PAGES` pages, chosen by a hash of the
page's id. Elements and names whose meaning is fixed (article, nav, class "comments", ...)
give the labels; every block is shown once with and once without those marks, so that pages
that lack them are judged by their text. Extraction covers every page and its whole html.

Defined results: null or empty html, or html without content, gives an empty text; character
references are decoded as browsers do; white space inside a block is one space; unclosed and
crossing elements are tolerated, however deep they lie (elements know the one around them, so
a page costs no more than its tags and blocks): only script, style, title, textarea and iframe, which browsers
read as raw text, reach to the end of the page without an end tag, and an unclosed element of
`HIDDEN` ends where its surroundings end or the next block begins; repeated rows are all kept; an empty table gives no rows;
columns beside page_id, url and html are ignored.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchgrid.llm.common import table

FIT_PAGES = 400
SEED = 5
ADJACENT, NEARBY = 1.2, 0.6
#: Largest cost of a single block's label, so that its neighbours can overrule it.
MOST_COST = 6.0
TEXT_DIMS, MARK_DIMS = 12, 4
ROUNDS = 200

# Element and attribute names with a set meaning.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style title textarea iframe".split())
HIDDEN = frozenset("noscript template svg select option button".split())
FOREIGN = frozenset(("svg", "math"))
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
ITEM = frozenset("li td th dt dd".split())
CLOSES_P = BLOCK - {"body", "html", "head"}
CONTENT_TAGS = frozenset(("article", "main"))
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset search".split())
CONTENT_NAMES = frozenset("article articlebody content entry main post postbody story maincontent".split())
BOILER_NAMES = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disclaimer disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promoted related replies reply respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar topbar widget".split()
)

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)(?:((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|[^>]*(?:>|\Z))|<[!?][^>]*(?:>|\Z)", re.S
)
NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
NAME = re.compile(r"[A-Za-z]+")
SPACE = re.compile(r"\s+")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I | re.A) for tag in RAW}
FOREIGN_END = re.compile(r"</(?:svg|math)(?=[\s/>])", re.I | re.A)


class Block:
    """A text block: its text, the element that holds it, and what was seen on the way there."""

    __slots__ = ("boiler", "content", "heading", "item", "link_chars", "place", "text")

    def __init__(self, text, link_chars, place):
        self.text, self.link_chars, self.place = text, link_chars, place
        self.content = place is not None and place.content
        self.boiler = place is not None and (place.boiler or place.header and not place.article)
        self.heading = place is not None and place.tag[:1] == "h" and place.tag[1:].isdigit()
        self.item = any(e.tag in ITEM for e in (place, place and place.parent) if e)


class Element:
    """An element with the one around it, and the marks met on the way down to it."""

    __slots__ = ("article", "boiler", "content", "depth", "header", "parent", "tag")

    def __init__(self, tag, meaning, parent):
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 1
        self.content = meaning > 0 or bool(parent and parent.content)
        self.boiler = meaning < 0 or bool(parent and parent.boiler)
        self.header = tag == "header" or bool(parent and parent.header)
        self.article = tag == "article" or bool(parent and parent.article)


def _meaning(tag: str, attributes: str) -> int:
    """1 for marks of content, -1 for marks of boilerplate, else 0."""
    names = set()
    if "=" in attributes:
        for value in NAMES.findall(attributes):
            for word in NAME.findall(value):
                names |= {word.lower(), *(p.lower() for p in re.findall(r"[A-Z]?[a-z]+", word))}
    if tag in ("html", "body"):
        return 0
    if tag in CONTENT_TAGS:
        return -1 if names & BOILER_NAMES and not names & CONTENT_NAMES else 1
    if tag in BOILER_TAGS or names & BOILER_NAMES:
        return -1
    return int(bool(names & CONTENT_NAMES))


def tags_of(html: str) -> tuple[list[tuple[int, int, str, bool, str]], dict[int, int]]:
    """The tags (begin, end, name, closing, attributes) of a page, and where the text that each hides ends.

    A raw element is one tag that hides up to after its end tag. The stack holds the open
    blocks and hidden elements. A hidden element with an end tag of its own hides up to after
    it; one that ends with its surroundings, and every option, hides no block.
    """
    tags, until = [], {}
    stack: list[list] = []  # name, tag number, begin of the first block inside
    count: dict[str, int] = {}
    fresh: list[list] = []  # hidden elements without a block so far
    # What was sought last: where it was found, or up to where it is not.
    met, missed = {}, {}
    at, size = 0, len(html)

    def close(name, begin, end=None):
        """Close the innermost `name` and what is open inside it; `end`: after its own end tag."""
        while True:
            entry = stack.pop()
            count[entry[0]] -= 1
            if entry[0] in HIDDEN:
                own = end if entry[0] == name and end is not None else None
                if own is None or entry[0] == "option":
                    own = min(own or begin, begin if entry[2] is None else entry[2])
                until[entry[1]] = own
                entry[2] = own
            if entry[0] == name:
                return

    def search(pattern, begin, end=size):
        if missed.get(pattern, -1) >= end:
            return None
        m = met.get(pattern)
        if m is None or not begin <= m.start() < m.end() <= end:
            m = met[pattern] = pattern.search(html, begin, end)
            if m is None:
                missed[pattern] = end
        return m

    while m := TAG.search(html, at):
        at, tag, closing = m.end(), (m[2] or "").lower(), bool(m[1])
        if not tag:
            tags.append((m.start(), at, "", False, ""))
            continue
        number = len(tags)
        tags.append((m.start(), at, tag, closing, m[3] or ""))
        foreign = bool(count.get("svg") or count.get("math"))
        if tag in RAW:
            if closing or foreign and m[0].endswith("/>"):
                continue
            if tag == "textarea" and count.get("select"):
                close("select", m.start())
            # Inside svg and math these are no raw text, so their end tag has to come before that of the whole.
            outer = search(FOREIGN_END, at) if foreign else None
            end = search(RAW_END[tag], at, outer.start() if outer else size)
            if end or not foreign:
                at = until[number] = end.end() if end else size
        elif closing:
            if count.get(tag):
                close(tag, m.start(), at)
        else:
            if tag == "option" and stack and stack[-1][0] == "option" or tag in ("button", "select") and count.get(tag):
                close(tag, m.start())
            elif tag == "input" and count.get("select"):
                close("select", m.start())
            elif tag == "optgroup" and stack and stack[-1][0] in ("option", "optgroup"):
                close("optgroup" if count.get("optgroup") else "option", m.start())
            if tag in BLOCK:
                for entry in fresh:
                    entry[2] = entry[2] or m.start()
                fresh = []
            if (tag in BLOCK and tag not in VOID) or tag in ("datalist", "optgroup") or (
                tag in HIDDEN | FOREIGN and not (tag in FOREIGN and m[0].endswith("/>"))
            ):
                stack.append([tag, number, None])
                count[tag] = count.get(tag, 0) + 1
                if tag in HIDDEN:
                    fresh.append(stack[-1])
    while stack:
        close(stack[-1][0], size)
    return tags, until


def blocks_of(html: str | None) -> list[Block]:
    """The text blocks of a page in order."""
    html = html or ""
    found, parts, stack = [], [], []
    link, link_chars, at = 0, 0, 0
    opened: dict[str, int] = {}

    def end_block():
        nonlocal parts, link_chars
        if parts:
            text = SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                found.append(Block(text, min(link_chars, len(text)), stack[-1] if stack else None))
        parts, link_chars = [], 0

    def add(text):
        nonlocal link_chars
        if text:
            parts.append(text)
            if link:
                link_chars += len(text.strip())

    tags, until = tags_of(html)
    for number, (begin, end, tag, closing, attributes) in enumerate(tags):
        if begin < at:
            continue
        add(html[at:begin])
        at = end
        if not tag:
            continue
        if tag == "a":
            link = 0 if closing else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in RAW or tag in HIDDEN:
            at = max(at, until.get(number, at))
            if not closing and tag in ("title", "textarea", "option", "button"):
                parts.append(" ")
        elif tag in BLOCK:
            end_block()
            if tag in VOID:
                continue
            if closing:
                while opened.get(tag):
                    last = stack.pop()
                    opened[last.tag] -= 1
                    if last.tag == tag:
                        break
                link = 0
            else:
                around = stack[-1] if stack else None
                if around and (tag in CLOSES_P and around.tag == "p" or tag == around.tag == "li"):
                    opened[stack.pop().tag] -= 1
                    around = around.parent
                opened[tag] = opened.get(tag, 0) + 1
                stack.append(Element(tag, _meaning(tag, attributes), around))
    add(html[at:])
    end_block()
    return found


def features_of(blocks: list[Block]):
    """A row of text features and of mark features for each block."""
    import numpy as np

    rows = np.zeros((len(blocks), TEXT_DIMS + MARK_DIMS))
    for i, b in enumerate(blocks):
        n = len(b.text)
        words = b.text.count(" ") + 1
        rows[i] = (
            1.0, min(np.log1p(n) / 6, 1.5), b.link_chars / n, n < 25, words > 15,
            b.text[-1] in ".!?…。\"»”", min(10.0 * sum(map(b.text.count, ".,;:")) / words, 3.0) / 3,
            b.heading, b.item, "©" in b.text or "|" in b.text or "·" in b.text, i == 0, i == len(blocks) - 1,
            b.content, b.boiler, b.content and b.boiler, not b.content and not b.boiler,
        )
    return rows


def fit(pages: DataFrame, fit_pages: int = FIT_PAGES, rounds: int = ROUNDS):
    """Logistic weights from the blocks of the sampled pages (page_id, html)."""
    import numpy as np

    order = F.xxhash64(F.lit(SEED), "page_id")
    chosen = pages.select("page_id").distinct().orderBy(order, "page_id").limit(fit_pages)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows, labels = [], []
            for html in batch.column("html").to_pylist():
                blocks = blocks_of(html)
                for b, x in zip(blocks, features_of(blocks).tolist(), strict=True):
                    if b.content or b.boiler:
                        rows.append(x)
                        labels.append(int(not b.boiler))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.int32())], ["x", "y"])

    # Rows that repeat a page_id are one page here, so the bound holds for rows too.
    sample = pages.join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min("html").alias("html"))
    sample = sample.select("html").mapInArrow(run, "x array<double>, y int").toPandas()
    w = np.zeros(TEXT_DIMS + MARK_DIMS)
    # Without a sample the marks alone decide.
    w[TEXT_DIMS:TEXT_DIMS + 2] = 4.0, -4.0
    if sample.empty:
        return w
    x, y = np.array(sample["x"].to_list()), sample["y"].to_numpy()
    unmarked = x.copy()
    unmarked[:, TEXT_DIMS:] = 0
    x, y = np.concatenate([x, unmarked]), np.concatenate([y, y])
    weight = (len(y) / (2 * np.maximum(np.bincount(y, minlength=2), 1)))[y]
    moment, speed = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ ((p - y) * weight) / len(y) + 1e-3 * w
        moment, speed = 0.9 * moment + 0.1 * g, 0.99 * speed + 0.01 * g * g
        w -= 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(speed / (1 - 0.99**step)) + 1e-8)
    return w


def tree_distance(a: Element | None, b: Element | None) -> int:
    """Steps between two places in the element tree."""
    steps = 0
    while a is not b:
        if b is None or a is not None and a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def ties(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: page neighbours, and the nearest earlier block of the same container."""
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, ADJACENT * 2.0 ** (-max(0, tree_distance(blocks[i - 1].place, b.place) - 2) / 2)))
        up, around = 0, b.place
        while around is not None and up < 3:
            j = last.get(around)
            if j is not None and j < i - 1:
                edges.append((j, i, NEARBY * 2.0**-up))
            last[around] = i
            up, around = up + 1, around.parent
    return edges


def source_side(gain: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The minimum cut's source side: gain > 0 is a capacity from the source, < 0 one to the sink.

    Augmenting paths in level order until no path is left; ties of equal cost fall to the sink
    side.
    """
    n = len(gain)
    source, sink = n, n + 1
    head, capacity, out = [], [], [[] for _ in range(n + 2)]

    def arc(u, v, there, back):
        out[u].append(len(head))
        head.append(v)
        capacity.append(there)
        out[v].append(len(head))
        head.append(u)
        capacity.append(back)

    for i, g in enumerate(gain):
        if g > 0:
            arc(source, i, g, 0)
        elif g < 0:
            arc(i, sink, -g, 0)
    for u, v, c in edges:
        arc(u, v, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = [source]
        for u in queue:
            for e in out[u]:
                if capacity[e] > 0 and level[head[e]] < 0:
                    level[head[e]] = level[u] + 1
                    queue.append(head[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        trail: list[int] = []
        u = source
        while True:
            if u == sink:
                least = min(capacity[e] for e in trail)
                for e in trail:
                    capacity[e] -= least
                    capacity[e ^ 1] += least
                trail, u = [], source
                continue
            while tried[u] < len(out[u]):
                e = out[u][tried[u]]
                if capacity[e] > 0 and level[head[e]] == level[u] + 1:
                    break
                tried[u] += 1
            if tried[u] < len(out[u]):
                trail.append(out[u][tried[u]])
                u = head[trail[-1]]
            elif u == source:
                break
            else:
                e = trail.pop()
                u = head[e ^ 1]
                tried[u] += 1


def main_text(html: str | None, weights) -> str:
    """The content blocks of a page, one to a line."""
    import numpy as np

    blocks = blocks_of(html)
    if not blocks:
        return ""
    gain = np.clip(features_of(blocks) @ weights, -MOST_COST, MOST_COST)
    content = source_side(
        np.rint(gain * 1000).astype(int).tolist(), [(u, v, round(c * 1000)) for u, v, c in ties(blocks)]
    )
    return "\n".join(b.text for b, kept in zip(blocks, content, strict=True) if kept)


def extract_text(pages: DataFrame, weights) -> DataFrame:
    """(page_id, url, text) for pages (page_id, url, html)."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(h, weights) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string")


def op4_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages, fit(pages)).withColumn("n_chars", F.char_length("text").cast("long"))


QUERIES = {"op4_html_mincut": op4_html_mincut}
ORACLES: dict[str, str] = {}
