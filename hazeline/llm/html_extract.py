"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing, clustering."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Width of the smoothing, in lines.
SIGMA = 1.0
#: What an element whose name leaves it open has to hold to be prose: characters outside of links, and their
#: share; characters per block.
PROSE, OWN, PER_BLOCK = 140, 0.7, 60

# Elements by what they mean for the text in them.
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset("article body div main section td".split())
ROOTS = frozenset("article main".split())
NEVER = frozenset(
    "aside audio button canvas datalist dialog footer form head iframe input math menu nav noscript object "
    "option script select style svg template textarea title video".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status "
    "toolbar".split()
)
CLOSED_BY_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",)}
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|sidebar\w*|menu\w*|nav|navbar|navigation|"
    r"breadcrumbs?|footer\w*|masthead|(?:site|page|top)[_-]?header|header|comments?|commentlist|respond|"
    r"responses?|repl(?:y|ies)|discussion|disqus\w*|cookies?|consent|gdpr|notices?|notification|alert|"
    r"banner\w*|shar(?:e|ing)|social\w*|related|recommend\w*|newsletter|subscri\w*|signup|login|popup|modal|"
    r"overlay|widget|toolbar|pagination|pager|search\w*|skip\w*|tags|copyright|legal|disclaimer)(?=$|[\s_-])",
    re.IGNORECASE,
)
# Words that say nothing about what a name of several words is for.
NEUTRAL = frozenset(
    "and area articles bar block body bottom box btn button buttons card cards col column container content for form "
    "group icon icons inner item items label large left link links list logo main more of our outer page panel post "
    "posts read right row section site slot small stories text the title to top unit us user users wide wrap "
    "wrapper you your".split()
)
LAYOUT = re.compile(r"\b(?:has|with|without|no|show|hide)[_-][\w-]+", re.IGNORECASE)
NO_ARTICLE = re.compile(
    r"comment|reply|ads?|advert\w*|sponsor\w*|promo\w*|related|recommended|teaser|notice", re.IGNORECASE
)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Line:
    """One block of text, with the tags around and in it and where on the page it is."""

    text: str
    tags: int
    linked: int
    container: int
    root: int
    doubt: int = 0


class Lines(HTMLParser):
    """Takes parser events as they come and keeps the blocks of text that may be content.

    Text of elements that are never content is dropped at once, tags count towards the block
    that follows. The stack holds open elements: tag, whether it is left out, its container, its
    article, and the element in doubt that it is in, if any.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[tuple[str, bool, int, int, int]] = [("html", False, 0, 0, 0)]
        self.containers = self.doubts = 0
        self.parts: list[str] = []
        self.tags = self.linked = self.links = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in VOID:
            if tag in BLOCKS:
                self.flush()
            elif tag in ("br", "wbr"):
                self.parts.append(" " if tag == "br" else "")
            return
        if tag in BLOCKS:
            self.flush()
            self._close_implied(tag)
        _, out, container, root, doubt = self.stack[-1]
        if not out:
            out = self._left_out(tag, dict(attrs), root)
            if out is None:
                self.doubts += 1
                out, doubt = False, doubt or self.doubts
        if tag in CONTAINERS:
            self.containers += 1
            container = self.containers
        if tag in ROOTS and not out and not root:
            root = self.containers
        self.links += tag == "a"
        self.stack.append((tag, out, container, root, doubt))

    def _left_out(self, tag: str, attrs: dict[str, str | None], root: int) -> bool | None:
        """Whether an element is never content; None if its name speaks for that, but not for sure."""
        if tag in NEVER or (tag == "header" and not root):
            return True
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or HIDDEN.search(attrs.get("style") or ""):
            return True
        if (attrs.get("role") or "").lower() in ROLES:
            return True
        if tag in ("html", "body", "main") or (tag == "header" and root):
            return False
        names = [attrs.get(name) or "" for name in ("class", "id")]
        if tag == "article":  # such names often list topics, too
            return any(NO_ARTICLE.fullmatch(name) for name in " ".join(names).split())
        sure, unsure = False, False
        for at, name in enumerate(names):
            for word in LAYOUT.sub("", name).split():
                found = [match[0].lower() for match in NAMES.finditer(word)]
                if root:  # an article's own head is part of it
                    found = [match for match in found if not match.endswith("header")]
                if not found:
                    continue
                # A word that is no such name and not neutral either may be the topic, an id within an article a mark.
                known = all(
                    NAMES.fullmatch(part) or part.lower() in NEUTRAL or part.isdigit() for part in re.split("[_-]+", word) if part
                )
                mark = root and at == 1 and not names[0]
                sure, unsure = sure or (known and not mark), True
        return True if sure else None if unsure else False

    def _close_implied(self, tag: str) -> None:
        if tag in ROOTS:  # a menu that nobody closed doesn't hold the article
            for at in range(len(self.stack) - 1, 0, -1):
                if self.stack[at][0] in ("nav", "menu", "head"):
                    del self.stack[at:]
                    break
        if tag == "body" and any(entry[0] == "head" for entry in self.stack):
            del self.stack[next(at for at, entry in enumerate(self.stack) if entry[0] == "head") :]
        limits = CLOSED_BY_SAME.get(tag)
        for at in range(len(self.stack) - 1, 0, -1):
            name = self.stack[at][0]
            if name == "p" or (limits and name == tag):
                del self.stack[at:]
                break
            if name in (limits or ()) or name in CONTAINERS or (not limits and name in BLOCKS):
                break

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        for at in range(len(self.stack) - 1, 0, -1):
            name = self.stack[at][0]
            if name == tag:
                del self.stack[at:]
                break
            if name in BLOCKS and tag not in BLOCKS:
                break
        if tag == "a":
            self.links = max(0, self.links - 1)

    def handle_data(self, data: str) -> None:
        if not self.stack[-1][1]:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, _, container, root, doubt = self.stack[-1]
            self.lines.append(Line(text, self.tags, self.linked, container, root, doubt))
            self.tags = 0
        self.parts.clear()
        self.linked = self.links = 0


def lines_of(html: str) -> list[Line]:
    """The blocks of text of a page that may be content, in order; broken markup is no error."""
    last = html.rfind("<")
    if last >= 0 and ">" not in html[last:] and re.match(r"<[a-zA-Z/!?]", html[last:]):
        html = html[:last]  # a page cut off within a tag
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    prose = _prose(parser.lines)
    return [line for line in parser.lines if line.doubt in prose]


def _prose(lines: list[Line]) -> set[int]:
    """The elements in doubt that hold prose, and 0 for what is in none."""
    found = {0}
    for doubt in {line.doubt for line in lines} - {0}:
        own = [line for line in lines if line.doubt == doubt]
        chars, linked = sum(len(line.text) for line in own), sum(line.linked for line in own)
        if chars - linked >= max(PROSE, OWN * chars) and chars >= PER_BLOCK * len(own):
            found.add(doubt)
    return found


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """The values under a Gaussian window; at the ends only what is there counts."""
    width = max(1, round(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-width, width + 1) / sigma) ** 2)
    full = np.convolve(ratios, weights)[width : width + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), weights)[width : width + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """The border between two clusters that differ most; below all values if they hardly differ."""
    ordered = np.sort(values)
    if len(ordered) < 2 or ordered[-1] - ordered[0] < 1.0:
        return -1.0
    n = np.arange(1, len(ordered))
    sums = np.cumsum(ordered)[:-1]
    low, high = sums / n, (ordered.sum() - sums) / (len(ordered) - n)
    at = int(np.argmax(n * (len(ordered) - n) * (high - low) ** 2))
    return float(low[at] + high[at]) / 2


def main_text(html: str) -> str:
    """The main text of a page: its content blocks, one per line; empty if there are none.

    Each block's characters outside of links, per tag, are smoothed over the neighbouring blocks
    and divided in two clusters, on a logarithmic scale. Content are the regions of the blocks in
    the upper cluster, wherever on the page they are, with all their blocks, so that a short
    paragraph stays with its article. The region of a block is the article that it is in, or else
    its container. A block that is mostly links speaks for none. Only if no block speaks for any
    region, all articles have the content.
    """
    lines = lines_of(html)
    if not lines:
        return ""
    ratios = np.array([max(0, len(line.text) - line.linked) / max(1, line.tags) for line in lines])
    heights = np.log1p(smoothed(ratios))
    own_words = np.array([2 * line.linked < len(line.text) for line in lines])
    upper = (heights > threshold(heights)) & own_words
    content = {line.root or line.container for line, high in zip(lines, upper, strict=True) if high}
    if not content:
        content = {line.root for line in lines if line.root}
    return "\n".join(line.text for line in lines if (line.root or line.container) in content)


def extract(
    df: DataFrame, *, html_col: str = "html", text_col: str = "text", keep: Iterable[str] | None = None
) -> DataFrame:
    """Add the main text of each page and ``n_chars``, its code points, to the columns of ``df``
    or to those in ``keep``.

    Null pages count as empty; a page without content has an empty text. Character references
    are decoded, white space within a block becomes one space. Pages are read whole, one by one,
    so that repeated rows, ties and an empty table need no rule. Columns named like those added
    are replaced.
    """
    added = [StructField(text_col, StringType()), StructField("n_chars", LongType())]
    taken = {f.name for f in added}
    names = [c for c in (df.columns if keep is None else keep) if c not in taken]
    schema = StructType([*[df.schema[c] for c in names], *added])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [main_text(html or "") for html in part.column(html_col).to_pylist()]
                columns = [pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*map(part.column, names), *columns], schema.names)

    return df.select(*{html_col: None, **dict.fromkeys(names)}).mapInArrow(run, schema)
