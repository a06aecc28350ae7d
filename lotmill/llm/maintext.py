"""Main text of web pages by a linear-chain conditional random field over their leaf blocks.

A page is cut into the text blocks of its document tree. Each block has features of its ancestors (tags, class words,
roles) and of its text; the field has one weight for each feature and label and one for each pair of neighbouring labels, trained
on labelled pages by gradient ascent on their conditional likelihood, and Viterbi finds the best labels of a page's blocks.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.llm.common import by_bytes
from lotmill.llm.layouts import labelled_pages

# Labelled pages, rounds and step of training, strength of the pull to zero, and blocks of a training sequence.
FIT_PAGES, ROUNDS, STEP, PULL, FIT_BLOCKS = 700, 100, 0.3, 0.05, 48
# Element paths whose features a task keeps.
KEPT_PATHS = 50_000

# Elements of HTML that break a line of text before and after them.
BREAKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead tr ul ins label".split()
)
# Elements whose content is not markup, and is not shown or not text of the page.
RAW = frozenset("script style title textarea template iframe noembed noframes xmp svg math object audio video canvas".split())
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that the start of one of the given elements ends.
ENDS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option"]),
    "optgroup": frozenset(["option", "optgroup"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
}
# Elements that tell parts of a page apart.
SECTIONS = frozenset("article main nav header footer aside form section dialog noscript ins".split())
# Elements that keep an end inside them from reaching outside.
SCOPES = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"])}
SCOPE = frozenset(["table", "td", "th", "caption", "button", "object"])
_IN_P = BREAKS - {"button", "label", "ins", "option", "optgroup", "body", "html", "head", "noscript"}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"'>]|$)""", re.I)
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_ENDED = re.compile(r"[.!?:…。！？؟।\"”»)]$")


def _tag_end(page: str, at: int, closes: dict[str, int]) -> int:
    """Where the tag that ``at`` lies in ends, its ``>`` left out; quoted values may hold one."""
    while True:
        stop = page.find(">", at)
        if stop < 0:
            return len(page)
        quote = min((q for q in (_find(page, '"', at, closes), _find(page, "'", at, closes)) if q >= 0), default=-1)
        if quote < 0 or quote > stop or page[quote - 1] not in "= \t\n\r\f":
            return stop
        end = _find(page, page[quote], quote + 1, closes)
        if end < 0:
            return stop
        at = end + 1


def _find(page: str, what: str, at: int, seen: dict[str, int]) -> int:
    """``page.find(what, at)``, for growing ``at`` without going over the same characters twice."""
    known = seen.get(what, -2)
    if known == -1 or known >= at:
        return known
    seen[what] = page.find(what, at)
    return seen[what]


@dataclass
class Block:
    """A text block: its text, the path it stands at, its own element, and its characters inside links."""

    text: str
    path: int
    tag: str
    linked: int


class Paths:
    """Numbers the element paths seen, each with the features of its elements.

    A path is its parent and one element; features are those a model knows, or all while one is trained.
    """

    def __init__(self, known: dict[str, int] | None = None):
        self.known = known
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.features: list[frozenset] = [frozenset()]

    def child(self, parent: int, tag: str, words: tuple[str, ...]) -> int:
        key = (parent, tag, words)
        if key not in self.numbers:
            above, own = self.features[parent], [f"in:{tag}", *(f"word:{w}" for w in words)]
            if words or tag in SECTIONS:
                above = frozenset(f for f in above if not f.startswith("near:"))
                own += [f"near:{tag}", *(f"near:word:{w}" for w in words)]
            if self.known is not None:
                own = [f for f in own if f in self.known]
            self.features.append(above | frozenset(own))
            self.numbers[key] = len(self.features) - 1
        return self.numbers[key]


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])", re.I)


def _words(attributes: str) -> tuple[str, ...]:
    """Words of class, id and role, and ``hidden``."""
    found = []
    for m in _NAMED.finditer(attributes[:2000]):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            found.append("hidden")
        elif name in ("class", "id", "role"):
            found += [w.lower() for w in _WORD.findall(value)][:20]
    return tuple(dict.fromkeys(found))


def blocks(page: str | None, paths: Paths) -> list[Block]:
    """The text blocks of a page in order.

    Comments, scripts, styles and other content that is no text are left out, ends that HTML
    leaves out are put in, character references are decoded, and white space is one blank. Unclosed quotes, comments and
    elements do no harm. The work grows with the length of the page, however it is nested.
    """
    if not page:
        return []
    out: list[Block] = []
    stack: list[tuple[str, int]] = []  # open elements with their paths
    open_: Counter = Counter()
    pieces: list[str] = []
    linked = 0
    closes: dict[str, int] = {}
    unclosed: set[str] = set()

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(references.unescape("".join(pieces)).split())
            if text:
                path = stack[-1][1] if stack else 0
                tag = next((t for t, _ in reversed(stack) if t in BREAKS), "") if len(stack) < 64 else ""
                out.append(Block(text, path, tag, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def pop_to(place: int) -> None:
        while len(stack) > place:
            tag, _ = stack.pop()
            open_[tag] -= 1

    def close(tags: frozenset, scope: frozenset) -> None:
        """Ends the outermost of the given elements that is open inside the scope."""
        if not any(open_[t] for t in tags):
            return
        found = None
        for i in range(len(stack) - 1, max(-1, len(stack) - 200), -1):
            if stack[i][0] in tags:
                found = i
            elif stack[i][0] in scope:
                break
        if found is not None:
            pop_to(found)

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            pieces.append(page[at:start])
            if open_["a"] > 0:
                linked += start - at
        if start >= size:
            break
        nxt = page[start + 1 : start + 2]
        if nxt == "!" or nxt == "?":
            if page.startswith("<!--", start):
                end = _find(page, "-->", start + 2, closes)
                at = end + 3 if end >= 0 else size
            else:
                end = page.find(">", start)
                at = end + 1 if end >= 0 else size
            continue
        ending = nxt == "/"
        name = _NAME.match(page, start + 1 + ending)
        if not name:
            if ending:
                end = page.find(">", start)
                at = end + 1 if end >= 0 else size
            else:
                pieces.append("<")
                at = start + 1
            continue
        tag = name[0].lower()
        end = _tag_end(page, name.end(), closes)
        attributes, at = page[name.end() : end], end + 1
        if tag == "br":
            pieces.append(" ")
            continue
        breaks = tag in BREAKS
        if breaks:
            flush()
        if ending:
            if open_[tag] > 0:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        if not breaks and any(t in BREAKS for t, _ in stack[i + 1 : i + 50]):
                            flush()
                        pop_to(i)
                        break
            continue
        if tag in RAW:
            found = _raw_end(tag).search(page, at) if tag not in unclosed and not attributes.endswith("/") else None
            if found:
                end = page.find(">", found.end())
                at = end + 1 if end >= 0 else size
            elif tag in ("script", "style", "textarea", "template", "title"):
                at = size
            else:
                unclosed.add(tag)
            continue
        if tag in VOID:
            continue
        if tag in _IN_P and open_["p"]:
            close(frozenset(["p"]), SCOPE)
        if tag in ENDS:
            close(ENDS[tag], SCOPES.get(tag, frozenset(["table"])))
        parent = stack[-1][1] if stack else 0
        path = paths.child(parent, tag, _words(attributes)) if breaks else parent
        stack.append((tag, path))
        open_[tag] += 1
    flush()
    return out


def _bucket(n: float, edges: tuple) -> int:
    return sum(n >= e for e in edges)


def text_features(found: list[Block]) -> list[list[str]]:
    """Features of the blocks' texts, own elements and places."""
    out = []
    for i, b in enumerate(found):
        length = _bucket(len(b.text), (8, 20, 45, 90, 200, 500))
        share = _bucket(b.linked / len(b.text), (0.01, 0.3, 0.7))
        out.append([
            "any",
            f"size:{length}",
            f"links:{share}",
            f"own:{b.tag}",
            f"own:{b.tag}:links:{share}",
            f"size:{length}:links:{share}",
            "ended" if _ENDED.search(b.text) else "open",
            f"commas:{_bucket(b.text.count(',') + b.text.count('、') + b.text.count('，'), (1, 3))}",
            "sign" if "©" in b.text or "®" in b.text else "no sign",
            "bar" if "|" in b.text or "·" in b.text else "no bar",
            "first" if i == 0 else "last" if i == len(found) - 1 else "inside",
        ])
    return out


@dataclass
class Model:
    """Weights of a trained field: of a feature for each label, of a label after another, of the first label."""

    numbers: dict[str, int]
    weights: np.ndarray
    after: np.ndarray
    first: np.ndarray


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(emit: np.ndarray, after: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log partition, label marginals, summed pair marginals) of padded sequences (sequence, place, label), by forward and backward sums."""
    n, places, labels = emit.shape
    live = np.arange(places)[None, :] < lengths[:, None]
    forward, backward = np.zeros_like(emit), np.zeros_like(emit)
    forward[:, 0] = first + emit[:, 0]
    for t in range(1, places):
        forward[:, t] = _log_sum(forward[:, t - 1][:, :, None] + after[None], 1) + emit[:, t]
    for t in range(places - 2, -1, -1):
        ahead = _log_sum(after[None] + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(live[:, t + 1][:, None], ahead, 0.0)
    total = _log_sum(forward[np.arange(n), lengths - 1], 1)
    each = np.where(live[:, :, None], np.exp(forward + backward - total[:, None, None]), 0.0)
    pairs = np.zeros((labels, labels))
    for t in range(1, places):
        joint = forward[:, t - 1][:, :, None] + after[None] + (emit[:, t] + backward[:, t])[:, None, :] - total[:, None, None]
        pairs += np.exp(joint[live[:, t]]).sum(axis=0)
    return total, each, pairs


def train(pages: Iterable[list[tuple[str, int]]], rounds: int = ROUNDS) -> Model:
    """A field trained on pages given as pieces (html, label): 1 main text, 0 other text, -1 no text.

    Pages without text teach nothing. The sample is what the caller bounds it to; it is held in memory here.
    """
    paths, rows, labels = Paths(), [], []
    for page in pages:
        feats, kept = [], labelled_blocks(page, paths)
        for b, own in zip((b for b, _ in kept), text_features([b for b, _ in kept])):
            feats.append([*paths.features[b.path], *own])
        # A block without a mark of its own goes on with the label of the one before it.
        last, given = 0, []
        for _, m in kept:
            last = m if m >= 0 else last
            given.append(last)
        for start in range(0, len(feats), FIT_BLOCKS):
            rows.append(feats[start : start + FIT_BLOCKS])
            labels.append(given[start : start + FIT_BLOCKS])
    counts = Counter(f for page in rows for feats in page for f in feats)
    numbers = {f: i for i, f in enumerate(sorted(f for f, c in counts.items() if c >= 3))}
    model = Model(numbers, np.zeros((len(numbers), 2)), np.zeros((2, 2)), np.zeros(2))
    if not rows:
        return model
    places, lengths = max(len(p) for p in rows), np.array([len(p) for p in rows], np.int64)
    known = [(s * places + t, numbers[x]) for s, page in enumerate(rows) for t, feats in enumerate(page) for x in feats if x in numbers]
    at, f = np.array(known, np.int64).reshape(-1, 2).T
    gold = np.zeros((len(rows), places, 2))
    gold_pairs, gold_first = np.zeros((2, 2)), np.zeros(2)
    for i, given in enumerate(labels):
        gold[i, np.arange(len(given)), given] = 1
        gold_first[given[0]] += 1
        for a, b in zip(given, given[1:]):
            gold_pairs[a, b] += 1
    by_label = lambda where, values, n: np.stack([np.bincount(where, values[:, k], n) for k in (0, 1)], axis=1)
    values = (model.weights, model.after, model.first)
    means, squares = [np.zeros_like(x) for x in values], [np.zeros_like(x) for x in values]
    for step in range(1, rounds + 1):
        emit = by_label(at, model.weights[f], len(rows) * places).reshape(gold.shape)
        _, each, pairs = marginals(emit, model.after, model.first, lengths)
        slope = by_label(f, (gold - each).reshape(-1, 2)[at], len(numbers))
        slopes = [slope - PULL * model.weights, gold_pairs - pairs - PULL * model.after, gold_first - each[:, 0].sum(axis=0) - PULL * model.first]
        # Steps by the running mean of the slope over that of its size (Adam), shorter towards the end.
        for value, own, mean, square in zip(values, slopes, means, squares):
            mean += 0.1 * (own - mean)
            square += 0.01 * (own * own - square)
            value += STEP * (1 - step / (rounds + 1)) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return model


def labelled_blocks(page: list[tuple[str, int]], paths: Paths) -> list[tuple[Block, int]]:
    """Blocks of a page given as pieces (html, label), with their labels; -1 for a block whose pieces have none.

    Labels travel through the cutting as private characters in front of each text.
    """
    marked = []
    for piece, label in page:
        mark = f"\ue000{label}"
        marked.append(piece if label < 0 else re.sub(r"(?<=>)(?=[^<])", mark, piece if piece.startswith("<") else f"{mark}{piece}"))
    out = []
    for b in blocks("".join(marked), paths):
        found = re.findall("\ue000([01])", b.text)
        b.text = " ".join(re.sub("\ue000[01]", "", b.text).split())
        if b.text:
            out.append((b, int(found[0]) if found else -1))
    return out


@cache
def default_model() -> Model:
    return train(labelled_pages(FIT_PAGES))


def viterbi(emit: np.ndarray, after: np.ndarray, first: np.ndarray) -> list[int]:
    """The most likely labels of one sequence (place, label) of two labels; of equal ones the smaller."""
    (stay0, go1), (go0, stay1) = after.tolist()
    a, b = (first + emit[0]).tolist()
    back = []
    for x, y in emit[1:].tolist():
        from1, to1 = b + go0 > a + stay0, b + stay1 > a + go1
        back.append((from1, to1))
        a, b = (b + go0 if from1 else a + stay0) + x, (b + stay1 if to1 else a + go1) + y
        if abs(a) > 1e6:  # only the difference counts
            a, b = 0.0, b - a
    label = int(b > a)
    out = [label]
    for from1, to1 in reversed(back):
        label = int(to1 if label else from1)
        out.append(label)
    return out[::-1]


class Extractor:
    """Main texts by a model; keeps the weights of the element paths it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.paths = Paths(model.numbers)
        self.by_path: dict[int, np.ndarray] = {}
        self.by_feature = {f: model.weights[i] for f, i in model.numbers.items()}
        self.none = np.zeros(2)

    def text(self, page: str | None) -> str:
        """Main text of a page, blocks joined by an empty line; empty if there is none."""
        if len(self.paths.features) > KEPT_PATHS:
            self.paths.clear()
            self.by_path.clear()
        cut = blocks(page, self.paths)
        if not cut:
            return ""
        emit = np.empty((len(cut), 2))
        for i, (b, own) in enumerate(zip(cut, text_features(cut))):
            if b.path not in self.by_path:
                self.by_path[b.path] = sum((self.by_feature[f] for f in self.paths.features[b.path]), self.none)
            emit[i] = self.by_path[b.path] + sum([self.by_feature.get(f, self.none) for f in own])
        labels = viterbi(emit, self.model.after, self.model.first)
        return "\n\n".join(b.text for b, label in zip(cut, labels) if label)


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages`` (page_id, url, html).

    ``text`` is the main text of the whole page, its blocks in page order joined by an empty line, ``n_chars`` its code
    points. Null and empty pages, and pages without main text, have empty text. Repeated rows are rows of their own; an empty
    table gives no rows. Extra columns are left out. ``model`` is by default trained on ``FIT_PAGES`` made-up pages.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model or default_model())
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    types = dict(rows.dtypes)

    def run(batches) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(sent.value)
        for batch in by_bytes(batches, "html"):
            texts = [extractor.text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
