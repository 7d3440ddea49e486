"""Main text of web pages: a linear-chain CRF over the leaf blocks of the DOM.

A page becomes a sequence of leaf blocks, the stretches of text between block-level tags, each with its
ancestors. A conditional random field with two labels, main text or not, is trained on pages
that label themselves: those with an ``article`` or ``main`` element, whose blocks are main text unless a nested menu, footer and
the like holds them. Half of what is learned from is shown without those elements, so that the field also decides pages that have
none. Where no page labels itself, fixed weights stand in for learned ones. Viterbi then labels every block of every page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from bazar.llm.tables import hash_sample

# What is learned from: so many pages in the order of a hash of their key, none longer than the second bound.
TRAINING_PAGES = 400
TRAINING_PAGE_BYTES = 200_000
EPOCHS = 6

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)", re.S)
NAMES = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea template noscript iframe noembed noframes xmp".split())
# never text of an article, whatever surrounds them
SKIPPED = RAW | set("head svg select option button canvas audio video".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li"
    " main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# an element that ends when one of these begins
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
MAIN = {"article", "main"}
AROUND = set("nav footer aside header form menu dialog search address fieldset".split())
# parts of class names and ids, and roles
AROUND_PART = re.compile(
    r"(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|disqus|footer|header|login|masthead|menu|modal|nav\w*|newsletter|notices?|pagination"
    r"|pager|popup|promo\w*|related|repl(?:y|ies)|search|share|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widgets?)$",
    re.I,
)
# names that begin so tell what a page or wrapper has, not what it is
STATES = set("has with without no is not show hide hidden".split())


def says_around(names: str) -> bool:
    """Whether a name of an element says that it surrounds the article: its first or last part does, and it names no state."""
    for name in names.split():
        parts = re.split(r"[-_]+", name.strip("-_"))
        if parts[0].lower() not in STATES and (AROUND_PART.match(parts[0]) or AROUND_PART.match(parts[-1])):
            return True
    return False


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    names: tuple[str, ...]
    linked: int


def leaf_blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order; references are decoded and white space is single spaces.

    A block ends at block-level tags only, so ``br`` and inline tags stay inside. An unclosed comment or tag
    reaches to the end of the page; a quote in a tag that is not closed counts as any character.
    """
    out: list[Block] = []
    if not page:
        return out
    stack: list[str] = []
    names: list[str] = []
    text: list[str] = []
    linked = skip = links = at = 0

    def flush() -> None:
        nonlocal linked
        if text:
            whole = " ".join(html.unescape("".join(text)).split())
            if whole:
                out.append(Block(whole, tuple(stack), tuple(n for n in names if n), min(linked, len(whole))))
            text.clear()
        linked = 0

    def pop() -> None:
        nonlocal skip, links
        tag = stack.pop()
        names.pop()
        skip -= tag in SKIPPED
        links -= tag == "a"

    while True:
        found = TOKEN.search(page, at)
        piece = page[at : found.start() if found else len(page)]
        if piece and not skip:
            text.append(piece)
            if links:
                linked += len(piece)
        if not found:
            break
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            if found[0].startswith("<![CDATA[") and not skip:
                text.append(html.escape(found[0][9:].removesuffix("]]>")))
            continue
        if found[1]:
            if tag in BLOCKS:
                flush()
            if tag in stack:
                while stack[-1] != tag:
                    pop()
                pop()
            continue
        if tag == "br":
            text.append(" ")
        if tag in BLOCKS:
            flush()
            for open_tag in ("p", "li", "dt", "dd", "td", "th", "tr"):
                if tag in CLOSED_BY[open_tag] and open_tag in stack:
                    inner = len(stack) - 1 - stack[::-1].index(open_tag)
                    if not SCOPES.get(open_tag, {"button", "table"}) & set(stack[inner + 1 :]):
                        while len(stack) > inner:
                            pop()
        if tag in VOID or found[3].endswith("/") and tag not in BLOCKS:
            continue
        stack.append(tag)
        # the names of a whole page say nothing about its blocks
        names.append("" if tag in ("html", "body") else " ".join(a or b or c for a, b, c in NAMES.findall(found[3])))
        skip += tag in SKIPPED
        links += tag == "a"
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
    flush()
    return out


def _bucket(n: int) -> int:
    return n.bit_length()


def features(block: Block) -> list[str]:
    """Names of what holds for a block."""
    path, text = block.path, block.text
    blocks = [t for t in path if t in BLOCKS]
    found = [f"a={t}" for t in set(path) if t in BLOCKS and t not in ("html", "body", "div", "section", "p")]
    found += [f"tag={blocks[-1] if blocks else ''}", f"len={_bucket(len(text))}", f"words={_bucket(text.count(' ') + 1)}", f"link={min(4, 4 * block.linked // len(text))}", "bias"]
    if AROUND & set(path):
        found.append("around")
    if MAIN & set(path):
        found.append("inmain")
    if any(says_around(n) for n in block.names):
        found.append("aroundname")
    if text[-1] in ".!?…。\"”'":
        found.append("stop")
    if "©" in text or "(c)" in text:
        found.append("copyright")
    if text.count(",") + text.count(". ") > 1:
        found.append("sentences")
    return found


HIDDEN = {"inmain", "a=article", "a=main"}

# Where training starts from. Learned pages may know few kinds of surroundings; the weights of these two stand for all of them.
PRIOR = {"bias": 0.0, "around": -6.0, "aroundname": -6.0}


# What decides where no page labels itself: text in the usual elements is main text unless it is around it or made of links.
UNTAUGHT = {"bias": -1.0, "around": -6.0, "aroundname": -6.0, "copyright": -3.0, "link=4": -4.0, "link=3": -3.0}
UNTAUGHT |= {f"tag={t}": 3.0 for t in "article blockquote body center dd div dl dt figcaption h1 h2 h3 h4 h5 h6 li main p pre section summary td th".split()}


def own_labels(blocks: Sequence[Block]) -> list[int] | None:
    """1 for main text, as the page itself says; None if it does not say."""
    if not any(MAIN & set(b.path) for b in blocks):
        return None
    labels = []
    for b in blocks:
        last = max((i for i, t in enumerate(b.path) if t in MAIN), default=-1)
        inner = set(b.path[last + 1 :]) if last >= 0 else set()
        labels.append(int(last >= 0 and not inner & AROUND and not any(says_around(n) for n in b.names)))
    return labels


def _add(a: float, b: float) -> float:
    hi, lo = (a, b) if a > b else (b, a)
    return hi + log(1.0 + exp(lo - hi)) if lo > hi - 50 else hi


@dataclass
class Field:
    """Two-label linear chain: label 1 scores the sum of its features' weights, label 0 scores 0, plus transitions."""

    weights: dict[str, float]
    moves: list[list[float]]
    first: list[float]

    def scores(self, seen: Sequence[Sequence[str]]) -> list[float]:
        get = self.weights.get
        return [sum(get(f, 0.0) for f in fs) for fs in seen]

    def decode(self, seen: Sequence[Sequence[str]]) -> list[int]:
        """The best label sequence; of equals the one with label 0."""
        if not seen:
            return []
        (m00, m01), (m10, m11) = self.moves
        scores = self.scores(seen)
        v0, v1, back = self.first[0], self.first[1] + scores[0], []
        for s in scores[1:]:
            a0, b0, a1, b1 = v0 + m00, v1 + m10, v0 + m01, v1 + m11
            back.append((b0 > a0, b1 > a1))
            v0, v1 = max(a0, b0), max(a1, b1) + s
        label = int(v1 > v0)
        labels = [label]
        for step in reversed(back):
            label = int(step[label])
            labels.append(label)
        return labels[::-1]


def train(pages: Sequence[tuple[Sequence[Sequence[str]], Sequence[int]]], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Maximum likelihood by AdaGrad, page by page in the given order; without pages the weights are those of ``UNTAUGHT``."""
    if not pages:
        return Field(dict(UNTAUGHT), [[0.0, 0.0], [0.0, 0.0]], [0.0, 0.0])
    field = Field(dict(PRIOR), [[0.0, 0.0], [0.0, 0.0]], [0.0, 0.0])
    seen_w: dict[str, float] = {}
    seen_m = np.full((3, 2), 1e-8)
    for _ in range(epochs):
        for seen, labels in pages:
            n = len(seen)
            if not n:
                continue
            emit = [(0.0, s) for s in field.scores(seen)]
            m = field.moves
            ahead = [[field.first[y] + emit[0][y] for y in (0, 1)]]
            for i in range(1, n):
                ahead.append([_add(ahead[-1][0] + m[0][y], ahead[-1][1] + m[1][y]) + emit[i][y] for y in (0, 1)])
            behind = [[0.0, 0.0] for _ in range(n)]
            for i in range(n - 2, -1, -1):
                behind[i] = [_add(m[y][0] + emit[i + 1][0] + behind[i + 1][0], m[y][1] + emit[i + 1][1] + behind[i + 1][1]) for y in (0, 1)]
            whole = _add(*ahead[-1])
            slope: dict[str, float] = {}
            moved = np.zeros((3, 2))
            for i in range(n):
                p1 = exp(min(0.0, ahead[i][1] + behind[i][1] - whole))
                for f in seen[i]:
                    slope[f] = slope.get(f, 0.0) + labels[i] - p1
                if i == 0:
                    moved[2] -= (1 - p1, p1)
                    moved[2][labels[0]] += 1
                else:
                    for x in (0, 1):
                        for y in (0, 1):
                            moved[x][y] -= exp(min(0.0, ahead[i - 1][x] + m[x][y] + emit[i][y] + behind[i][y] - whole))
                    moved[labels[i - 1]][labels[i]] += 1
            for f, g in slope.items():
                g -= decay * (field.weights.get(f, 0.0) - PRIOR.get(f, 0.0))
                seen_w[f] = seen_w.get(f, 1e-8) + g * g
                field.weights[f] = field.weights.get(f, 0.0) + rate * g / seen_w[f] ** 0.5
            seen_m += moved * moved
            step = rate * moved / np.sqrt(seen_m)
            field.moves = [[field.moves[x][y] + float(step[x][y]) for y in (0, 1)] for x in (0, 1)]
            field.first = [field.first[y] + float(step[2][y]) for y in (0, 1)]
    return field


def learn(pages: Sequence[str]) -> Field:
    """Train on the pages that label themselves, each shown with and without the elements that do."""
    shown = []
    for page in pages:
        blocks = leaf_blocks(page)
        labels = own_labels(blocks)
        if labels is not None:
            full = [features(b) for b in blocks]
            shown.append((full, labels))
            shown.append(([[f for f in fs if f not in HIDDEN] for fs in full], labels))
    return train(shown)


def main_text(page: str | None, field: Field) -> str:
    blocks = leaf_blocks(page)
    labels = field.decode([features(b) for b in blocks])
    return "\n".join(b.text for b, y in zip(blocks, labels) if y)


def fit(pages: DataFrame, key: str = "page_id", page: str = "html", limit: int = TRAINING_PAGES, longest: int = TRAINING_PAGE_BYTES) -> Field:
    """Train on at most ``limit`` pages of at most ``longest`` bytes, the first by a hash of their key."""
    sample = hash_sample(pages.filter(F.octet_length(page) <= longest).select(key, page), key, limit)
    return learn([r[1] for r in sample.collect()])


def extract(pages: DataFrame, field: Field, page: str = "html", keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``text``, the blocks labelled main text joined by line feeds, and ``n_chars``, its code points.

    NULL and empty pages, and pages without a main block, have an empty text. Rows are independent, so repeated rows get equal texts
    and an empty table stays empty. Columns called like the new ones are replaced. Only the field is broadcast; it has a weight for each of a fixed
    set of features.
    """
    added = [StructField("text", StringType()), StructField("n_chars", LongType())]
    kept = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars")]
    shared = pages.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), shared.value) for x in batch.column(len(kept))]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), *made], names=[*kept, "text", "n_chars"])

    schema = StructType([*(pages.schema[c] for c in kept), *added])
    return pages.select(*kept, F.col(page).alias("__page")).mapInArrow(run, schema)
