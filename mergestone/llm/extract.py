"""HTML main text by minimum cut.

A linear classifier, trained here on the small labelled pages in
``extract_samples``, gives each block its cost of being called content or
boilerplate. The costs become the capacities of edges to two terminals;
blocks that follow each other, and blocks that share a parent, get smoothness
edges. The minimum cut, found by max-flow, is the labelling of least total
cost. Capacities are whole numbers, so the cut is exact and repeatable.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergestone.llm.html_blocks import Block, Element, blocks_of
from mergestone.llm.scratch import modest_batches
from mergestone.llm.worker import tidy

#: Capacity of one nat of classifier cost, and of smoothness edges.
UNIT, NEXT, SIBLING = 1000, 250, 150
_AWAY = re.compile(
    r"\b(?:ad|ads|advert\w*|banner|promo\w*|sponsor\w*|cookie\w*|consent|notice|gdpr|popup|modal|subscribe|newsletter|nav\w*|menu\w*|breadcrumb\w*|"
    r"header|masthead|footer|sidebar|side|aside|widget|related|recommend\w*|share|sharing|social|comment\w*|respons\w*|disqus|reply|replies|"
    r"login|signup|search|pagination|pager|tags|toolbar|copyright|skip|-hidden-|complementary|contentinfo|navigation|alert|dialog)\b|^-hidden-"
)
_MAIN = re.compile(r"\b(?:article\w*|post|post-body|entry|entry-content|story|main|main-content|content|body|text|articlebody|mw-parser-output)\b")
#: Marks of an article's own title block, which are no page header.
_TITLE = re.compile(r"\b(?:article|entry|post|story)-(?:header|head|title)\b")
FEATURES = (
    "bias", "in_article", "in_main", "mark_main", "in_nav", "in_header", "in_footer", "in_aside", "in_form", "mark_away", "heading",
    "paragraph", "list_item", "log_length", "link_share", "sentence",
)


def _facts(element: Element) -> dict:
    """What the element and those around it say; kept on the element, as its blocks share it."""
    chain = []
    while element is not None and not element.facts:
        chain.append(element)
        element = element.parent
    up = element.facts if element is not None else dict.fromkeys(("article", "main", "good", "nav", "header", "footer", "aside", "form", "away"), 0)
    for element in reversed(chain):
        own = dict(up)
        name, marks = element.name, element.marks.replace("_", "-")
        if name == "article":
            # what an article's surroundings say of it counts no more, unless it is itself set apart
            own = dict.fromkeys(own, 0) if not (up["aside"] or up["away"] or up["footer"] or up["article"]) else own
            own["article"] = 1
        elif name == "main" or "role=main" in marks:
            own["main"] = 1
        elif name in ("nav", "menu", "footer", "aside"):
            own["nav" if name == "menu" else name] = 1
        elif name in ("header", "hgroup"):
            own["header"] = 0 if own["article"] else 1  # an article's own header holds its title
        elif name in ("form", "button", "fieldset", "dialog", "label", "legend"):
            own["form"] = 1
        if marks and name not in ("body", "html"):
            marks = _TITLE.sub("", marks)
            spoken = re.sub(r"-", " ", marks) if "-hidden-" not in marks else marks
            if _AWAY.search(marks) or _AWAY.search(spoken):
                own["away"] = 1
            elif _MAIN.search(marks):
                own["good"] = 1
        element.facts = up = own
    return up


def features(block: Block) -> list[float]:
    f, text = _facts(block.element), block.text
    return [
        1.0, f["article"], f["main"], f["good"], f["nav"], f["header"], f["footer"], f["aside"], f["form"], f["away"],
        float(block.tag in ("h1", "h2", "h3", "h4", "h5", "h6")), float(block.tag in ("p", "pre", "blockquote", "td", "figcaption", "dd")),
        float(block.tag in ("li", "dt", "option")), math.log1p(len(text)) / 5, block.linked / len(text), float(text[-1] in ".!?:…。”\""),
    ]


@cache
def weights() -> tuple[float, ...]:
    """Logistic regression by gradient descent over the labelled sample pages; the same on every machine to rounding."""
    from mergestone.llm.extract_samples import labelled_blocks

    lines, answers = [], []
    for page, wanted in labelled_blocks():
        for block in blocks_of(page):
            lines.append(features(block))
            answers.append(1.0 if block.text in wanted else 0.0)
    w = [0.0] * len(FEATURES)
    for _ in range(400):
        slope = [0.002 * x for x in w]
        for line, y in zip(lines, answers):
            z = sum(a * b for a, b in zip(w, line))
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            for i, x in enumerate(line):
                if x:
                    slope[i] += (p - y) * x / len(lines)
        w = [a - 2.0 * s for a, s in zip(w, slope)]
    return tuple(round(x, 3) for x in w)


def min_cut(source: list[int], sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut; the largest such set is not forced: ties fall to the sink.

    source[i], sink[i]: capacities of the terminal edges; edges: (i, j, capacity)
    of both directions. Dinic's algorithm, after the flow through each node's
    own two terminal edges.
    """
    n = len(source)
    spare = [s - t for s, t in zip(source, sink)]  # what flows straight through a node needs no search
    if not edges or all(x >= 0 for x in spare) or all(x <= 0 for x in spare):
        return _reach(spare, [[] for _ in range(n)] if not edges else _adjacent(n, edges)[0], _adjacent(n, edges)[1])
    links, room = _adjacent(n, edges)
    ahead, behind = [max(0, x) for x in spare], [max(0, -x) for x in spare]
    while True:
        level, queue = [-1] * n, deque()
        for i in range(n):
            if ahead[i]:
                level[i] = 0
                queue.append(i)
        found = False
        while queue:
            i = queue.popleft()
            found = found or behind[i] > 0
            for j, e in links[i]:
                if level[j] < 0 and room[e]:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not found:
            return [x >= 0 for x in level]
        turn = [0] * n
        for start in range(n):
            while ahead[start]:
                path, i = [], start
                while not behind[i]:
                    while turn[i] < len(links[i]):
                        j, e = links[i][turn[i]]
                        if room[e] and level[j] == level[i] + 1:
                            break
                        turn[i] += 1
                    else:
                        if not path:
                            break
                        i, _ = path.pop()
                        turn[i] += 1
                        continue
                    path.append((i, e))
                    i = j
                if not behind[i]:
                    break
                flow = min([ahead[start], behind[i], *(room[e] for _, e in path)])
                ahead[start] -= flow
                behind[i] -= flow
                for _, e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def _adjacent(n: int, edges: list[tuple[int, int, int]]) -> tuple[list[list[tuple[int, int]]], list[int]]:
    links: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    room: list[int] = []
    for i, j, c in edges:
        links[i].append((j, len(room)))
        links[j].append((i, len(room) + 1))
        room += [c, c]
    return links, room


def _reach(spare: list[int], links: list[list[tuple[int, int]]], room: list[int]) -> list[bool]:
    """The source's side when no flow has to cross between nodes."""
    side = [x > 0 for x in spare]
    queue = deque(i for i, x in enumerate(side) if x)
    while queue:
        for j, e in links[queue.popleft()]:
            if room[e] and not side[j]:
                side[j] = True
                queue.append(j)
    return side


def content_blocks(page: str) -> list[Block]:
    """The page's content blocks in page order."""
    blocks = blocks_of(page)
    if not blocks:
        return []
    w, source, sink = weights(), [], []
    for block in blocks:
        z = sum(a * b for a, b in zip(w, features(block)))
        least = math.log1p(math.exp(-abs(z)))
        # cost of calling it boilerplate: -log P(boilerplate); of calling it content: -log P(content)
        source.append(round(UNIT * (max(z, 0.0) + least)))
        sink.append(round(UNIT * (max(-z, 0.0) + least)))
    edges, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            same = block.element.parent is blocks[i - 1].element.parent
            edges.append((i - 1, i, NEXT if same else NEXT // 5))
        key = id(block.element.parent)
        if last.get(key, i - 1) != i - 1:
            edges.append((last[key], i, SIBLING))
        last[key] = i
    keep = min_cut(source, sink, edges)
    return [b for b, k in zip(blocks, keep) if k]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = ["\n".join(b.text for b in content_blocks(page or "")) for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars): each page's main text, its blocks joined by a newline.

    Null and empty pages, and pages without main text, give an empty text. Very
    long pages are read whole, tags without a partner cost no more than others.
    Null ids and urls stay null; repeated rows are each answered; other columns
    are ignored; an empty table gives none.
    """
    modest_batches(pages.sparkSession)
    raw = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kind = f"id {raw.schema['id'].dataType.simpleString()}, url {raw.schema['url'].dataType.simpleString()}, text string"
    return raw.mapInArrow(tidy(_extract), kind).select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
