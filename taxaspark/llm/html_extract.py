"""Main text of web pages by tag-path ratios.

Each text block of a page hangs on a root-to-leaf path of tags (with class and id). Per path the
text length (without links), the punctuation and the number of blocks are summed; the two ratios
are smoothed over the paths in page order, fused with the path's own ratio, weighed by what its tags
say and compared with a threshold. The paths above it are the content nodes. The article is the
outermost ``article`` or ``main`` of the best of them, or else their smallest container.

Tags and words of class and id are evidence: ``article`` doubles a score, so a story in a plain
element outvotes teaser cards; words that mark boilerplate divide it. An element whose name is nothing but such
words, one of the reader's comments, and forms, asides and dialogs are content only where a page has no other text,
however long they are. Where the word is part of a longer name, such as a slug, the element is kept if its
own ratio is like that of the text around it. Menus, footers, scripts, styles and hidden elements are never content.

A page is read into a tree of distinct paths; marks, sums and verdicts pass along its edges once, so the work
grows with the page's size, however deep its tags nest.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import slices

# Element names of the HTML standard by the role they play here.
RAW = "script|style|textarea|title|iframe|noembed|noframes|noscript|template|xmp|svg|math|object|select|button"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
NEVER = set("nav footer head menu label".split())
SELDOM = set("aside form dialog fieldset".split())
ARTICLE = {"article", "main"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Words of class, id and role attributes that mark boilerplate.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising adsense alert alerts announcement aside banner breadcrumb breadcrumbs byline comment comments commentlist complementary consent contentinfo cookie cookies copyright "
    "dialog disclaimer disqus footer gdpr header login masthead menu menubar modal nav navbar navi navigation newsletter notice notices notification overlay pager pagination paywall "
    "popup promo promoted recommended related replies reply respond search share sharing sidebar sidenav signup skip social sponsor sponsored submenu subscribe subscription tags toolbar topbar widget".split()
)
# Words that say nothing beside one of MARKS ("related-posts", "share-buttons").
FURNITURE = set(
    "area article articles bar bars block body bottom box button buttons card cards col column container content count entry feed fixed form group icon icons inner item items "
    "left link links list main media meta module news page panel post posts right row section site stories story strip text title top unit wrap wrapper zone".split()
)
# Words that mark what readers wrote, also beside one other word ("reader-comments"), and headings of it.
READERS = set("comment comments commentlist review reviews replies responses disqus".split())
READER_HEADING = re.compile(r"(?:(?:reader|readers|user|customer|all|our)s?'?\s+)?(?:comments|reviews|responses|replies|feedback)(?:\s*\(?\d*\)?)|\d+\s+(?:comments?|replies|responses|reviews?)|(?:leave|post|add)\s+a\s+(?:comment|reply|review)|join the (?:discussion|conversation)", re.I)
#: How firmly a step is marked: its name holds a word of MARKS, or is nothing but such words.
WEAK, STRONG = 1, 2
WEIGHT = {0: 1.0, WEAK: 0.5, STRONG: 0.1}
IN_ARTICLE = 2.0
#: An element with a weak mark is kept from this share of the article's ratio on.
ALIKE = 0.25
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
WORD = re.compile(r"[a-z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？]")


def _step(tag: str, attrs: str) -> tuple[str, int, bool]:
    """Name of a path step, how firmly its tag or attributes mark boilerplate, and whether it is never content."""
    never, name = tag in NEVER, tag
    level = STRONG if tag in SELDOM else 0
    if attrs and not attrs.isspace():
        for _, a, b, c in ATTRIBUTE.findall(attrs):
            value = (a or b or c).lower()
            name += "." + value
            if tag not in ("html", "body", "article", "main"):
                for token in value.split():
                    words = WORD.findall(token)
                    if any(w in MARKS for w in words):
                        level = max(level, STRONG if all(w in MARKS or w in FURNITURE or len(w) < 3 for w in words) else WEAK)
                    if any(w in READERS for w in words) and sum(w not in FURNITURE and len(w) > 2 for w in words) <= 2:
                        level = STRONG
        never = never or bool(HIDDEN.search(attrs))
    return name, level, never


class Tree:
    """The distinct paths of a page: per node its parent (-1 at the top), depth, tag, own mark and outermost article (-1 without one)."""

    def __init__(self) -> None:
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.tag: list[str] = []
        self.mark: list[int] = []
        self.article: list[int] = []
        self._known: dict[tuple[int, str, int], int] = {}

    def child(self, parent: int, name: str, tag: str, mark: int) -> int:
        key = (parent, name, mark)
        if key not in self._known:
            node = self._known[key] = len(self.parent)
            above = self.article[parent] if parent >= 0 else -1
            self.parent.append(parent)
            self.depth.append(self.depth[parent] + 1 if parent >= 0 else 1)
            self.tag.append(tag)
            self.mark.append(mark)
            self.article.append(node if above < 0 and tag in ARTICLE else above)
        return self._known[key]

    def down(self, start: list, step) -> list:
        """A value per node from that of its parent (``start`` gives the one above the top)."""
        out: list = []
        for node, parent in enumerate(self.parent):
            out.append(step(node, out[parent] if parent >= 0 else start))
        return out


#: A text block: node of its path, text, and how much of the text is links.
Block = tuple[int, str, int]


def blocks(page: str) -> tuple[Tree, list[Block]]:
    """The page's paths and text blocks, but those never content; inline tags are no part of a path."""
    tree, out = Tree(), []
    stack: list[tuple[str, int, bool, bool]] = []  # tag, node, never content, free of marks so far
    open_tags: Counter[str] = Counter()
    opened = False  # an article has begun
    text: list[str] = []
    linked, link = 0, False

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if joined and not (stack and stack[-1][2]):
                if len(stack) > 1 and stack[-1][0] in HEADING and stack[-2][0] in ("section", "div", "ol", "ul") and READER_HEADING.fullmatch(joined):
                    # The heading names its section; what the section held before stays as it is.
                    (kind, node, never, _), own = stack[-2], stack[-1]
                    marked = tree.child(tree.parent[node], f"{kind}.readers", kind, STRONG)
                    stack[-2:] = [(kind, marked, never, False), (own[0], tree.child(marked, own[0], own[0], 0), own[2], False)]
                out.append((stack[-1][1] if stack else tree.child(-1, "", "", 0), joined, min(linked, len(joined))))
        linked = 0

    def pop() -> str:
        tag = stack.pop()[0]
        open_tags[tag] -= 1
        return tag

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
            linked += (m.start() - at) * link
        at = m.end()
        tag = (m.group("tag") or "").lower()
        if tag == "a":
            link = not m.group("end")
        if tag not in BLOCK:
            if tag and not m.group("end") and tag not in VOID and tag == "label":
                flush()
            continue
        flush()
        if tag in VOID:
            continue
        if m.group("end"):
            if open_tags[tag] > 0:
                while pop() != tag:
                    pass
            continue
        while stack and stack[-1][0] in ("p", *HEADING) and tag not in ("html", "body"):
            pop()  # a block opened inside a paragraph ends it
        if tag in ("li", "dd", "dt", "option", "tr", "td", "th") and stack and stack[-1][0] == tag:
            pop()
        name, level, never = _step(tag, m.group("attrs") or "")
        within = any(open_tags[t] > 0 for t in ARTICLE)
        if tag == "header":  # of the page; an article's own header keeps its headings
            level = 0 if within else STRONG
        clean = not stack or stack[-1][3]
        never = never or bool(stack) and stack[-1][2]
        if tag in HEADING and clean and within:
            level = 0  # a heading's own class, such as "header", doesn't condemn it
        if tag in ARTICLE and not opened:
            clean = True  # nor does a wrapper's class, such as "has-sidebar", the page's article
        opened = opened or tag in ARTICLE
        node = tree.child(stack[-1][1] if stack else -1, name, tag, level)
        stack.append((tag, node, never, clean and not level))
        open_tags[tag] += 1
    if at < len(page):
        text.append(page[at:])
    flush()
    return tree, out


def path_scores(found: list[tuple], sigma: float = 1.0) -> dict[tuple[str, ...], float]:
    """Smoothed ratio of each path of ``found`` (path, marks, text, length of links if there are any).

    The ratio is text outside links per block, times (1 + punctuation per block).
    """
    length: dict[tuple[str, ...], float] = {}
    marks: dict[tuple[str, ...], float] = {}
    count: dict[tuple[str, ...], int] = {}
    for path, _, t, *linked in found:
        length[path] = length.get(path, 0) + len(t) - sum(linked)
        marks[path] = marks.get(path, 0) + len(PUNCTUATION.findall(t))
        count[path] = count.get(path, 0) + 1
    paths = list(length)
    reach = max(1, math.ceil(3 * sigma))
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(reach + 1)]

    def smooth(x: list[float]) -> list[float]:
        out = []
        for i in range(len(x)):
            near = range(max(0, i - reach), min(len(x), i + reach + 1))
            out.append(sum(kernel[abs(i - j)] * x[j] for j in near) / sum(kernel[abs(i - j)] for j in near))
        return out

    text_ratio = smooth([length[p] / count[p] for p in paths])
    mark_ratio = smooth([marks[p] / count[p] for p in paths])
    return {p: t * (1 + m) for p, t, m in zip(paths, text_ratio, mark_ratio, strict=True)}


class _Sums:
    """Ratio of several blocks together."""

    def __init__(self) -> None:
        self.length = self.marks = self.count = 0

    def add(self, length: int, marks: int, count: int) -> None:
        self.length += length
        self.marks += marks
        self.count += count

    def ratio(self) -> float:
        return self.length / self.count * (1 + self.marks / self.count) if self.count else 0.0


def main_text(page: str | None) -> str:
    """The article of one page; empty for null, empty or text-free pages."""
    tree, found = blocks(page) if page else (None, [])
    if not found:
        return ""
    # The page's first article is free of the marks above it.
    first_article = next((n for n, t in enumerate(tree.tag) if t in ARTICLE), -1)
    level = tree.down(0, lambda n, above: tree.mark[n] if n == first_article else max(above, tree.mark[n]))
    rows = [(n, None, t, linked) for n, t, linked in found]
    own, smooth = path_scores(rows, 0.1), path_scores(rows)
    scores = {n: math.sqrt(own[n] * smooth[n]) * WEIGHT[level[n]] * (IN_ARTICLE if tree.article[n] >= 0 else 1.0) for n in own}
    mean = sum(scores.values()) / len(scores)
    spread = math.sqrt(sum((s - mean) ** 2 for s in scores.values()) / len(scores))
    least_marked = min(level[n] for n in scores)
    least_marked = WEAK if least_marked == 0 and any(level[n] == WEAK for n in scores) else least_marked
    first = max((n for n in scores if level[n] <= least_marked), key=lambda n: scores[n])
    least = min(scores[first], mean + 0.5 * spread)
    chosen = {n for n, s in scores.items() if s >= least and level[n] <= max(WEAK, level[first])}
    inside = _Ancestors(tree)
    if tree.article[first] >= 0:
        top = tree.article[first]
    else:
        top = tree.parent[first]
        for n in chosen:  # smallest container of the content nodes outside teasers
            if tree.article[n] < 0:
                while top >= 0 and not inside(top, n):
                    top = tree.parent[top]
    below = tree.down(top < 0, lambda n, above: above or tree.parent[n] == top)
    # Marks below the top, and headers there, on the way to each node.
    marked = tree.down(False, lambda n, above: below[n] and (above or tree.mark[n] > 0))
    header = tree.down(False, lambda n, above: below[n] and (above or tree.tag[n] == "header"))
    sums = [_Sums() for _ in tree.parent]
    plain = _Sums()
    for n, t, linked in found:
        part = (len(t) - linked, len(PUNCTUATION.findall(t)), 1)
        sums[n].add(*part)
        if (below[n] or n == top) and not marked[n]:
            plain.add(*part)
    for n in range(len(sums) - 1, -1, -1):
        if tree.parent[n] >= 0:
            sums[tree.parent[n]].add(sums[n].length, sums[n].marks, sums[n].count)
    stays = lambda n: not below[n] or not tree.mark[n] or tree.mark[n] == WEAK and sums[n].ratio() >= ALIKE * plain.ratio()
    good = tree.down(True, lambda n, above: above and stays(n))
    kept = []
    for n, t, _ in found:
        if not (below[n] or n == top):
            if n not in chosen or level[n] or tree.article[n] >= 0 and tree.article[first] < 0:
                continue
        elif tree.article[n] >= 0 and tree.article[first] < 0 and n not in chosen:
            continue  # a teaser beside the story
        elif header[n] and tree.tag[n] not in HEADING:
            continue
        if good[n]:
            kept.append(t)
    return "\n".join(kept or [t for n, t, _ in found if n == first])


class _Ancestors:
    """Tells whether a node lies on another's path, by the order in which a walk enters and leaves them."""

    def __init__(self, tree: Tree):
        children: list[list[int]] = [[] for _ in tree.parent]
        for n, parent in enumerate(tree.parent):
            if parent >= 0:
                children[parent].append(n)
        self.enter, self.leave = [0] * len(children), [0] * len(children)
        clock = 0
        todo = [(n, False) for n, parent in enumerate(tree.parent) if parent < 0]
        while todo:
            n, done = todo.pop()
            if done:
                self.leave[n] = clock
                continue
            self.enter[n] = clock = clock + 1
            todo.append((n, True))
            todo += [(c, False) for c in children[n]]

    def __call__(self, above: int, node: int) -> bool:
        return self.enter[above] <= self.enter[node] <= self.leave[above]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``.

    Null or empty html gives an empty text and 0; other columns of ``pages`` are ignored; repeated
    rows give repeated results; an empty table gives an empty result. Pages are read one by one,
    whole, so memory is bounded by a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [main_text(x) for x in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
