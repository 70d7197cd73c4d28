"""Main text of web pages: the contiguous stretch of a page with the highest score.

A page is a sequence of words and tags. Words score positive and tags negative, by how much more
often labelled pages have them inside their article than outside. Menus, adverts, forms and the
like are out: they have no score, wherever they stand. One linear scan finds the best stretch, and
its blocks are the text. Pages that mark exactly one article are the labelled ones.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages that weights are learnt from, about; and how many must agree on a class of elements.
SAMPLE = 2_000
MIN_PAGES = 5
#: Pages whose texts a worker holds at once.
BATCH = 128

# Elements by their meaning in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option"
    " p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end an open element of the same group, up to the first of the second group.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "option": ({"option"}, {"select"}),
}
MARKS = {"article", "main"}
# What is no part of an article, by element, by role, and by words of classes and ids.
OUT_TAGS = RAW | set(
    "aside button canvas dialog footer form head menu nav noscript object search select svg template".split()
)
OUT_ROLES = set("alert banner complementary contentinfo dialog menu navigation search".split())
OUT_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies disqus footer gdpr login menu modal nav navbar navigation newsletter notice"
    " notices overlay pager pagination popup promo promotion recommended related replies reply share"
    " sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget".split()
)
OUT_NAMES = {"header", "site-header", "page-header", "main-header"}

ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
QUOTE_OR_END = re.compile("""[>"']""")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


@dataclass
class Token:
    """A run of text (``name`` empty) or a tag. ``block`` numbers the page's blocks."""

    block: int
    name: str = ""
    text: str = ""
    out: bool = False
    in_article: bool = False
    in_main: bool = False
    labels: tuple[str, ...] = ()


@dataclass(frozen=True)
class Weights:
    """Scores of a word and of tags; ``out`` are labels of elements that are out."""

    word: float = 1.0
    other_tag: float = -0.25
    tags: dict[str, float] = field(default_factory=dict)
    out: frozenset[str] = frozenset()


def _tag_end(page: str, at: int) -> int:
    """Where the tag that goes on at ``at`` ends (its ``>``), or -1. Quoted values may hold one;
    a quote that nothing closes is no quote."""
    place = at
    while found := QUOTE_OR_END.search(page, place):
        if found.group() == ">":
            return found.start()
        close = page.find(found.group(), found.end())
        if close < 0:
            break
        place = close + 1
    return page.find(">", at)


class _Parser:
    """The tokens of a page. Only elements that matter later are kept open: blocks, and inline
    elements that are out with those of the same name inside."""

    def __init__(self, out_labels: frozenset[str], with_labels: bool):
        self.out_labels, self.with_labels = out_labels, with_labels
        self.open: list[tuple[str, bool, tuple[str, ...]]] = []  # name, out, labels
        self.counts: Counter[str] = Counter()
        self.n_out = self.block = self.articles = 0
        self.tokens: list[Token] = []

    def _add(self, name: str, text: str, labels: tuple[str, ...] = (), out: bool = False) -> None:
        marks = self.counts["article"] > 0, self.counts["main"] > 0
        self.tokens.append(Token(self.block, name, text, out or self.n_out > 0, *marks, labels))

    def _pop_to(self, size: int) -> None:
        while len(self.open) > size:
            name, out, _ = self.open.pop()
            self.counts[name] -= 1
            self.n_out -= out

    def _close(self, names: set[str], until: set[str] | None) -> None:
        """End the innermost open element of ``names`` and what is inside it."""
        if not any(self.counts[n] for n in names):
            return
        for place in range(len(self.open) - 1, -1, -1):
            name = self.open[place][0]
            if name in names:
                return self._pop_to(place)
            if until is not None and (name in until or (not until and name in BLOCKS)):
                return

    def text(self, raw: str) -> None:
        if raw:
            labels = tuple(x for _, _, some in self.open for x in some) if self.with_labels else ()
            self._add("", references.unescape(raw), labels)

    def _tag(self, name: str, out: bool) -> None:
        if name in BLOCKS:
            self.block += 1
        elif name == "br":
            self._add("", " ")
        self._add(name, "", out=out)

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self._close({"p"}, set())
        if name in CLOSES:
            self._close(*CLOSES[name])
        marked = any(self.counts[m] for m in MARKS)
        labels, out = (), name in OUT_TAGS or (name == "header" and not marked)
        if attributes and name not in ("html", "body"):
            labels, hinted = _labels(name, attributes)
            out = out or (hinted and name not in MARKS or _is_comment(labels)) or any(
                label in self.out_labels for label in labels
            )
        self._tag(name, out)
        if name in VOID:
            return
        if name in MARKS and not out and self.counts["form"]:
            self._keep_forms()
        self.articles += name == "article" and not out and not self.n_out
        if out or name in BLOCKS or self.counts[name]:
            self.open.append((name, out, labels))
            self.counts[name] += 1
            self.n_out += out

    def _keep_forms(self) -> None:
        """A form around an article or main part holds the page, it is no form in it."""
        self.n_out -= sum(out for name, out, _ in self.open if name == "form")
        self.open = [(name, out and name != "form", labels) for name, out, labels in self.open]

    def end(self, name: str) -> None:
        out = self.n_out > 0
        if self.counts[name]:
            # An inline element does not end a block around it.
            self._close({name}, None if name in BLOCKS else set())
        self._tag(name, out)


def _labels(name: str, attributes: str) -> tuple[tuple[str, ...], bool]:
    """An element's labels by class and id, and whether a role or a word says that it is out."""
    labels, hinted = [], False
    for attribute, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "").lower()
        if attribute.lower() == "role":
            hinted |= value in OUT_ROLES
            continue
        mark = "." if attribute.lower() == "class" else "#"
        for one in value.split():
            labels.append(f"{name}{mark}{one}")
            hinted |= one in OUT_NAMES or not OUT_WORDS.isdisjoint(re.split("[-_]+", one))
    return tuple(labels), hinted


def _is_comment(labels: tuple[str, ...]) -> bool:
    """Comments may be articles of their own."""
    return any(not {"comment", "comments"}.isdisjoint(re.split("[-_.#]+", x)) for x in labels)


def tokens_of(
    page: str, out_labels: frozenset[str] = frozenset(), with_labels: bool = False
) -> tuple[list[Token], int]:
    """Words and tags of a page in order, whatever is wrong with it, and its number of articles."""
    parser = _Parser(out_labels, with_labels)
    at = done = 0
    while (at := page.find("<", at)) >= 0:
        ahead = page[at + 1 : at + 2]
        if ahead == "!" and page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
            parser.text(page[done:at])
            at = done = end
        elif ahead and ahead in "!?":
            parser.text(page[done:at])
            end = page.find(">", at)
            at = done = len(page) if end < 0 else end + 1
        elif found := NAME.match(page, at + 2 if ahead == "/" else at + 1):
            parser.text(page[done:at])
            name = found.group().lower()
            end = _tag_end(page, found.end())
            if end < 0:  # the page ends inside a tag
                return parser.tokens, parser.articles
            if ahead == "/":
                parser.end(name)
                at = done = end + 1
                continue
            parser.start(name, page[found.end() : end])
            at = done = end + 1
            if name in RAW:
                close = RAW_END[name].search(page, at)
                stop = close.start() if close else len(page)
                if name in ("title", "textarea"):
                    parser.text(page[at:stop])
                at = done = stop
        else:
            at += 1
    parser.text(page[done:])
    return parser.tokens, parser.articles


def _judge(tokens: list[Token], articles: int) -> None:
    """In a page that marks its main part, words elsewhere are out: its one article, or else its
    main element, or else its articles."""
    main = any(t.in_main for t in tokens)
    if articles == 1 or (articles and not main):
        for t in tokens:
            t.out = t.out or not t.in_article
    elif main:
        for t in tokens:
            t.out = t.out or not t.in_main


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run of the highest sum, the first and shortest of equals;
    (0, 0) if no sum is positive."""
    best = running = 0.0
    start = 0
    found = (0, 0)
    for place, score in enumerate(scores):
        if running <= 0:
            running, start = 0.0, place
        running += score
        if running > best:
            best, found = running, (start, place + 1)
    return found


def main_text(page: str | None, weights: Weights) -> str:
    """Text of the page's best stretch, blocks joined by an empty line; '' if there is none."""
    if not page:
        return ""
    tokens, articles = tokens_of(page, weights.out)
    _judge(tokens, articles)
    scores = [
        0.0 if t.out
        else weights.tags.get(t.name, weights.other_tag) if t.name
        else len(t.text.split()) * weights.word
        for t in tokens
    ]
    start, stop = best_stretch(scores)
    if start == stop:
        return ""
    # A block is in as a whole.
    first, last = tokens[start].block, tokens[stop - 1].block
    blocks: dict[int, list[str]] = {}
    for t in tokens:
        if first <= t.block <= last and not t.name and not t.out:
            blocks.setdefault(t.block, []).append(t.text)
    texts = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(text for text in texts if text)


def _observed(page: str) -> list[tuple[str, int, int]]:
    """Words and tags of a labelled page by kind, inside and outside its article, those that are out
    apart; and all words by label of the elements around them."""
    tokens, articles = tokens_of(page, with_labels=True)
    if articles != 1:
        return []
    seen: dict[str, list[int]] = {}
    for t in tokens:
        n = 1 if t.name else len(t.text.split())
        kind = f"<{t.name}>" if t.name else "word"
        for one in ([] if t.out else [kind]) + [*set(t.labels)]:
            counts = seen.setdefault(one, [0, 0])
            counts[not t.in_article] += n
    return [(kind, inside, outside) for kind, (inside, outside) in seen.items()]


def learn_weights(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> Weights:
    """Weights from labelled pages: those with one article element.

    They are taken from about ``sample`` different pages, chosen by a hash of the page over the
    whole table. A kind of word or tag weighs the logarithm of its share inside to its share
    outside, at least 0.05 with the sign that words and tags have, at most 3. Labels of elements
    that hold words of ``MIN_PAGES`` pages or more, hardly one in twenty inside, are out. No
    labelled pages give fixed weights.
    """
    rows = pages.count()
    key = F.xxhash64(F.col(html_col))
    limit = 2**63 - 1 if rows <= sample else int((sample / rows - 0.5) * 2**64)
    chosen = (
        pages.where(F.col(html_col).rlike("(?i)<article[\\s>]"))
        .select(key.alias("key"), F.col(html_col).alias("page"))
        .where(F.col("key") <= F.lit(limit))
        .groupBy("key")
        .agg(F.first("page").alias("page"))
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for page in batch.column(0).to_pylist() for x in _observed(page)]
            kinds, inside, outside = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(inside, pa.int64()), pa.array(outside, pa.int64())],
                names=["kind", "inside", "outside"],
            )

    found = (
        chosen.select("page").mapInArrow(run, "kind string, inside long, outside long")
        .groupBy("kind")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"), F.count(F.lit(1)).alias("pages"))
        .where((F.col("pages") >= MIN_PAGES) | (F.col("kind") == "word"))
        .collect()
    )
    return weights_from([(r.kind, r.inside, r.outside, r.pages) for r in found])


def weights_from(counts: list[tuple[str, int, int, int]]) -> Weights:
    """Weights of counted kinds: (kind, inside, outside, pages)."""
    plain = [c for c in counts if c[0] == "word" or c[0].startswith("<")]
    if not plain:
        return Weights()
    inside, outside = (sum(c[k] for c in plain) + len(plain) for k in (1, 2))

    def weight(x: int, y: int, low: float, high: float) -> float:
        return min(max(math.log((x + 1) / inside) - math.log((y + 1) / outside), low), high)

    by_kind = {kind: (x, y) for kind, x, y, _ in plain}
    return Weights(
        word=weight(*by_kind.get("word", (0, 0)), 0.05, 3.0),
        tags={k[1:-1]: weight(x, y, -3.0, -0.05) for k, (x, y) in by_kind.items() if k.startswith("<")},
        out=frozenset(
            kind
            for kind, x, y, pages in counts
            if kind not in by_kind and pages >= MIN_PAGES and x * 20 < x + y
        ),
    )


def extract_text(
    pages: DataFrame,
    weights: Weights | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``<id>, <url>, text, n_chars`` for every page, by ``weights`` or by those learnt from ``pages``.

    Blocks are trimmed, runs of white space inside them (line breaks too) are one space, character
    references are decoded. Menus, headers of the page, footers, sidebars, notices, adverts, forms,
    scripts, styles and reader comments are left out wherever they stand. NULL and empty pages, and
    pages without a word that counts, have an empty text. Identifiers and addresses are taken as
    they are, NULL or repeated; a page is its own row and depends on no other but by the weights.
    Other columns are not read; an empty table gives no rows.
    """
    learnt = learn_weights(pages, html_col) if weights is None else weights

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                texts = [main_text(page, learnt) for page in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=[id_col, url_col, "text", "n_chars"],
                )

    kinds = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (id_col, url_col)]
    return pages.select(id_col, url_col, F.col(html_col).cast("string")).mapInArrow(
        run, f"{', '.join(kinds)}, text string, n_chars long"
    )
