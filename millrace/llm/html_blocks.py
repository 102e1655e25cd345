"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks, the runs of text between block-level tags. Every block is read as
hashed tag path, hashed words and a few measures; a bidirectional LSTM over the page's blocks, in
numpy, decides for each whether it belongs to the article. The model is trained here on a bounded
sample of the pages: semantic tags and telling class names give the labels, and every sampled page is
also shown with other containers, without containers' names and with foreign blocks around it, so that
pages that name nothing are read by their words and their order.
"""

from __future__ import annotations

import html as references
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces_of

# Bound of the training sample.
TRAIN_PAGES = 400
VARIANTS = 8
EPOCHS = 16
PATH_DIMS, WORD_DIMS, MEASURES, HIDDEN = 160, 48, 6, 16

# HTML elements that do not begin a block, that hold no text, and that have no end tag.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img object param math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover "
    "munderover mmultiscripts mtable mtr mtd mstyle mpadded mphantom menclose merror semantics".split()
)
HIDDEN_TEXT = ("script", "style", "template", "iframe", "svg", "textarea")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# An open element of the value is closed by the start of one of the key.
CLOSES = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
# Names of tags, classes and ids that tell what a container holds; they label the training sample only.
ARTICLE_NAMES = set("article main content post entry story text body".split())
OTHER_NAMES = set(
    "nav menu header footer aside sidebar side form ad ads advert advertisement banner sponsor promo comment comments reply "
    "discussion cookie consent notice popup share social related newsletter subscribe login breadcrumb head title button select "
    "copyright widget toolbar masthead".split()
)

# Levels of a block's path that are kept, the innermost ones.
DEPTH = 48
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_HIDDEN_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in HIDDEN_TEXT}
_TAG_SIGN = re.compile("[>\"']")
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A leaf: its text, and the names on its path, the innermost last, each a tag with its class and id words."""

    text: str
    path: list[tuple[str, ...]]
    linked: int = 0


class _Tags:
    """The tags of a page, in order and in linear time, whatever the page holds.

    A tag ends at the first ``>`` outside quotes, and where quotes leave none at the first ``>``; a tag without any is markup
    up to the next ``<``. The text of hidden elements is skipped if they end; if not, only their tag is.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.failed: set[int] = set()  # places outside quotes from which no tag ends
        self.endless: set[str] = set()  # what is known not to come any more

    def _find(self, what: str, at: int) -> int:
        if what in self.endless:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.endless.add(what)
        return found

    def _end(self, at: int) -> int:
        """Where the tag that goes on at ``at`` ends, after its ``>``; -1 if the page ends before."""
        if at > self.last:
            return -1
        start, seen = at, []
        while at not in self.failed:
            seen.append(at)
            sign = _TAG_SIGN.search(self.page, at)
            if sign is None:
                break
            at = sign.end()
            if sign.group() == ">":
                return at
            # a quote begins a value only after an equals sign
            if self.page[start : at - 1].rstrip()[-1:] == "=" if at - start < 256 else self.page[at - 256 : at - 1].rstrip()[-1:] == "=":
                closing = self._find(sign.group(), at)
                at = closing + 1 if closing >= 0 else at
        self.failed.update(seen)
        return self.page.find(">", start) + 1  # there is one, as the last is not before

    def __iter__(self) -> Iterator[tuple[int, int, str, bool, str]]:
        """``(begin, end, name, closes, attributes)``; the name is empty for what is no element."""
        page, at = self.page, 0
        while (at := page.find("<", at)) >= 0:
            begin, tag = at, _TAG.match(page, at)
            if tag:
                name, after = tag[2].lower(), tag.end()
                at = self._end(after)
                if at < 0:
                    following = page.find("<", after)
                    at = following if following >= 0 else len(page)
                    yield begin, at, "", False, ""
                    continue
                attributes = page[after : at - 1]
                if not tag[1] and name in _HIDDEN_END:
                    closing = None
                    if not (attributes.endswith("/") and name == "svg") and name not in self.endless:
                        closing = _HIDDEN_END[name].search(page, at)
                        if closing is None:
                            self.endless.add(name)
                    if closing:
                        ended = self._end(closing.end())
                        at = ended if ended >= 0 else len(page)
                    yield begin, at, "", False, ""
                else:
                    yield begin, at, name, bool(tag[1]), attributes
            elif page.startswith("<!--", at):
                closing = self._find("-->", at + 4)
                at = closing + 3 if closing >= 0 else at + 4
                yield begin, at, "", False, ""
            elif page.startswith(("<!", "<?", "</"), at) and at < self.last:
                at = page.find(">", at) + 1
                yield begin, at, "", False, ""
            else:
                at += 1


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    path: list[tuple[str, ...]] = field(default_factory=list)
    open: Counter = field(default_factory=Counter)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    in_link: bool = False

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            if self.in_link:
                self.linked += len(raw)

    def cut(self) -> None:
        text = " ".join(references.unescape("".join(self.parts)).split()) if self.parts else ""
        if text:
            self.blocks.append(Block(text, self.path[-DEPTH:], self.linked))
        self.parts, self.linked = [], 0

    def leave(self) -> None:
        self.open[self.path.pop()[0]] -= 1


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order, with references decoded and white space made single spaces.

    No text is lost to markup that is not finished: see :class:`_Tags`.
    """
    held, at = _Page(), 0
    page = page or ""
    for begin, end, tag, closes, attributes in _Tags(page):
        held.text(page[at:begin])
        at = end
        if not tag:
            continue
        if tag in INLINE:
            if tag == "br":
                held.text(" ")
            elif tag == "a":
                held.in_link = not closes
            continue
        held.cut()
        if closes:
            while held.open[tag] and held.path:
                found = held.path[-1][0] == tag
                held.leave()
                if found:
                    break
        else:
            if held.path and held.path[-1][0] in CLOSES.get(tag, ()):
                held.leave()
            if tag not in VOID:
                words = [w for n in _NAMED.findall(attributes) for w in _NAME.findall("".join(n).lower())]
                held.path.append((tag, *words))
                held.open[tag] += 1
    held.text(page[at:])
    held.cut()
    return held.blocks


def weak_label(block: Block) -> int:
    """What the names on the path say: 1 article, 0 other, -1 nothing. The innermost telling name wins, but a page's own parts beat an article around them."""
    names = [set(level) for level in block.path]
    if any(level & OTHER_NAMES for level in names):
        return 0
    return 1 if any(level & ARTICLE_NAMES - {"body"} for level in names) else -1


def _hash(text: str, dims: int) -> int:
    return zlib.crc32(text.encode()) % dims


def features(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray]:
    """A row per block of all pages, and where each page's rows begin and end."""
    offsets = np.cumsum([0, *map(len, pages)])
    blocks = [b for page in pages for b in page]
    count = len(blocks)
    different: dict[tuple, int] = {}
    which = np.array([different.setdefault(tuple(block.path), len(different)) for block in blocks], dtype=np.int64)
    rows = np.zeros((len(different), PATH_DIMS), dtype=np.float32)
    known: dict[tuple, list[int]] = {}
    for i, path in enumerate(different):
        for depth, level in enumerate(reversed(path)):
            # the two innermost levels are also told apart from the rest
            where = min(depth, 2)
            if (where, level) not in known:
                known[where, level] = [_hash(f"{where}{w}", PATH_DIMS) for w in level] + [_hash(w, PATH_DIMS) for w in level]
            rows[i, known[where, level]] = 1
    paths = rows[which]
    split = pc.ascii_split_whitespace(pc.utf8_lower(pa.array([b.text for b in blocks], pa.string())))
    coded = split.flatten().dictionary_encode()
    bucket = np.array([_hash(w, WORD_DIMS) for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()], dtype=np.int64)
    lengths = np.diff(np.asarray(split.offsets)).astype(np.int64)
    owner = np.repeat(np.arange(count), lengths)
    flat = bucket[np.asarray(coded.indices)] if len(bucket) else np.empty(0, dtype=np.int64)
    words = np.bincount(owner * WORD_DIMS + flat, minlength=count * WORD_DIMS).reshape(count, WORD_DIMS)
    words = np.sqrt(words / np.maximum(lengths, 1)[:, None])
    chars = np.array([len(b.text) for b in blocks], dtype=np.float64)
    linked = np.array([b.linked for b in blocks]) / np.maximum(chars, 1)
    stops = np.array([b.text.count(".") + b.text.count(",") for b in blocks]) / np.maximum(lengths, 1)
    ended = np.array([b.text.endswith((".", "!", "?")) for b in blocks], dtype=np.float64)
    place = np.concatenate([np.arange(n) / max(1, n - 1) for n in np.diff(offsets)] or [np.empty(0)])
    measures = np.stack([np.log1p(chars) / 5, np.log1p(lengths) / 4, linked, np.minimum(stops, 1), ended, place], axis=1)
    return np.concatenate([paths, words, measures], axis=1).astype(np.float32), offsets


class Labeller:
    """A bidirectional LSTM with a logistic output per block."""

    def __init__(self, inputs: int, hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.weights: dict[str, np.ndarray] = {"out": rng.normal(0, 0.1, 2 * hidden), "bias": np.zeros(1)}
        for side in ("f", "b"):
            self.weights[f"x{side}"] = rng.normal(0, inputs**-0.5, (inputs, 4 * hidden))
            self.weights[f"h{side}"] = rng.normal(0, hidden**-0.5, (hidden, 4 * hidden))
            offset = np.zeros(4 * hidden)
            offset[hidden : 2 * hidden] = 1  # remember at first
            self.weights[f"c{side}"] = offset

    def _run(self, x: np.ndarray, offsets: np.ndarray, side: str, tape: list | None) -> np.ndarray:
        """States of one direction; pages of all lengths side by side, the longest first."""
        size, w = self.hidden, self.weights
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        lengths, first, last = lengths[order], offsets[:-1][order], offsets[1:][order] - 1
        given = x @ w[f"x{side}"] + w[f"c{side}"]
        out = np.zeros((len(x), size))
        h = c = np.zeros((len(order), size))
        for t in range(int(lengths[0]) if len(lengths) else 0):
            n = int(np.searchsorted(-lengths, -t, side="left"))
            rows = first[:n] + t if side == "f" else last[:n] - t
            before, c_before = h[:n], c[:n]
            z = given[rows] + before @ w[f"h{side}"]
            gates = 1 / (1 + np.exp(-z[:, : 3 * size]))
            i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
            g = np.tanh(z[:, 3 * size :])
            c = f * c_before + i * g
            squashed = np.tanh(c)
            h = o * squashed
            out[rows] = h
            if tape is not None:
                tape.append((rows, before, c_before, i, f, o, g, squashed))
        return out

    def probabilities(self, x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, offsets, "f", None), self._run(x, offsets, "b", None)], axis=1)
        return 1 / (1 + np.exp(-(both @ self.weights["out"] + self.weights["bias"])))

    def gradients(self, x: np.ndarray, offsets: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted cross-entropy, by backpropagation through both directions."""
        size, w = self.hidden, self.weights
        tapes: dict[str, list] = {"f": [], "b": []}
        states = {side: self._run(x, offsets, side, tapes[side]) for side in tapes}
        both = np.concatenate([states["f"], states["b"]], axis=1)
        wrong = (1 / (1 + np.exp(-(both @ w["out"] + w["bias"]))) - target) * weight / max(weight.sum(), 1e-9)
        found = {"out": both.T @ wrong, "bias": np.array([wrong.sum()])}
        for k, side in enumerate("fb"):
            back = np.outer(wrong, w["out"][k * size : (k + 1) * size])
            dz_all = np.zeros((len(x), 4 * size))
            d_hidden = np.zeros_like(w[f"h{side}"])
            dh = dc = np.zeros((0, size))
            for rows, before, c_before, i, f, o, g, squashed in reversed(tapes[side]):
                grow = np.zeros((len(rows) - len(dh), size))
                dh = np.concatenate([dh, grow]) + back[rows]
                dc = np.concatenate([dc, grow]) + dh * o * (1 - squashed**2)
                dz = np.concatenate(
                    [dc * g * i * (1 - i), dc * c_before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1
                )
                dz_all[rows] = dz
                d_hidden += before.T @ dz
                dh, dc = dz @ w[f"h{side}"].T, dc * f
            found |= {f"x{side}": x.T @ dz_all, f"h{side}": d_hidden, f"c{side}": dz_all.sum(axis=0)}
        return found

    def fit(self, x: np.ndarray, offsets: np.ndarray, target: np.ndarray, epochs: int = EPOCHS, batch: int = 128, seed: int = 5) -> None:
        """Adam over shuffled pages; blocks with target -1 do not count, both classes count the same."""
        rng = np.random.default_rng(seed)
        share = max(1e-3, float((target == 1).sum()) / max(1, int((target >= 0).sum())))
        weight = np.where(target < 0, 0.0, np.where(target == 1, 0.5 / share, 0.5 / max(1e-3, 1 - share)))
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            pages = rng.permutation(len(offsets) - 1)
            for at in range(0, len(pages), batch):
                chosen = pages[at : at + batch]
                rows = np.concatenate([np.arange(offsets[p], offsets[p + 1]) for p in chosen])
                cuts = np.cumsum([0, *(offsets[p + 1] - offsets[p] for p in chosen)])
                step += 1
                for k, g in self.gradients(x[rows], cuts, np.maximum(target[rows], 0), weight[rows]).items():
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g * g
                    self.weights[k] -= 0.01 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)


def _variant(page: list[Block], others: list[list[Block]], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """A training page made of a sampled page: other container names, or none, and foreign blocks around the article."""
    labels = [weak_label(b) for b in page]
    rename = rng.random()
    words = sorted(ARTICLE_NAMES - {"body"})
    tag = str(rng.choice(["div", "section", "main", "article"]))
    article = (tag, *(str(w) for w in rng.choice(words, int(rng.integers(1 if tag in ("div", "section") else 0, 3)), replace=False)))
    shorter = rng.random() < 0.6
    made: list[tuple[Block, int]] = []

    def foreign(name: str, tag: str, count: int, from_article: bool) -> None:
        """Blocks of other pages in a container of their own; reader comments read like articles."""
        source = others[int(rng.integers(len(others)))]
        wanted = [b for b in source if (weak_label(b) == 1) == from_article] or source
        container = (tag, name) if rename < 0.7 else (tag, "x")
        for _ in range(count if wanted else 0):
            b = wanted[int(rng.integers(len(wanted)))]
            text = b.text if not from_article else b.text[: int(rng.integers(20, 160))]
            made.append((Block(text, [("html",), ("body",), container, ("p",)], 0 if from_article else b.linked), 0))

    if rng.random() < 0.4:
        foreign(str(rng.choice(["cookie", "notice", "banner", "header", "masthead"])), str(rng.choice(["div", "header"])), 1, False)
    for block, label in zip(page, labels):
        path = block.path
        if rename < 0.5:
            path = [article if level[0] in ("article", "main") else ("div", *level[1:]) if level[0] in ("nav", "footer") else level for level in path]
        elif rename >= 0.7:  # names say nothing
            path = [(level[0],) if level[0] in ("html", "body", "p", "li", "ul", "h1", "h2", "head", "title") else ("div",) for level in path]
        text = block.text
        if shorter and label == 1 and len(text) > 80:
            sentences = text.split(". ")
            text = ". ".join(sentences[: int(rng.integers(1, 4))])
        made.append((Block(text, path, block.linked), label))
    tail = [i for i, (_, label) in enumerate(made) if label == 1]
    after = made[tail[-1] + 1 :] if tail else []
    made = made[: tail[-1] + 1] if tail else made
    if rng.random() < 0.5:
        foreign(str(rng.choice(["sidebar", "related", "widget", "promo", "social"])), str(rng.choice(["aside", "div", "section"])), int(rng.integers(1, 4)), False)
    if rename < 0.7 and rng.random() < 0.5:
        foreign(str(rng.choice(["comments", "comment", "reply", "discussion"])), str(rng.choice(["section", "div", "ul"])), int(rng.integers(1, 5)), True)
    if rng.random() < 0.3:
        foreign(str(rng.choice(["newsletter", "login", "subscribe"])), "form", 1, False)
    made += after
    return [b for b, _ in made], [label for _, label in made]


_fitted: dict[tuple, Labeller] = {}


def sampled(pages: DataFrame, sample: int) -> list[str]:
    """The ``sample`` different pages with the smallest hashes; the hashes are found on their own, so only these pages are moved."""
    hashed = pages.filter("html is not null").select(F.xxhash64("html").alias("hash"), "html")
    chosen = [r["hash"] for r in hashed.select("hash").distinct().orderBy("hash").limit(sample).collect()]
    rows = hashed.filter(F.col("hash").isin(chosen)).groupBy("hash").agg(F.min("html").alias("html")).orderBy("hash").collect()
    return [r["html"] for r in rows]


def trained(pages: DataFrame, sample: int = TRAIN_PAGES, variants: int = VARIANTS, epochs: int = EPOCHS) -> Labeller:
    """A labeller fitted on :func:`sampled` pages of ``pages (html, …)``; only those reach the driver.

    Null pages do not count, repeated pages count once, ties of the hash are broken by the page, and long pages are taken
    whole. A table without pages gives a labeller that has learnt nothing. Equal samples are fitted once per process.
    """
    rows = sampled(pages, sample)
    key = (variants, epochs, *(zlib.crc32(h.encode()) for h in rows))
    if key not in _fitted:
        _fitted.clear()
        _fitted[key] = _fit([b for b in map(blocks_of, rows) if b], variants, epochs)
    return _fitted[key]


def _fit(parsed: list[list[Block]], variants: int, epochs: int) -> Labeller:
    model = Labeller(PATH_DIMS + WORD_DIMS + MEASURES)
    if not parsed:
        return model
    rng = np.random.default_rng(3)
    shown, labels = [*parsed], [label for page in parsed for label in map(weak_label, page)]
    for page in parsed:
        for _ in range(variants):
            made, own = _variant(page, parsed, rng)
            shown.append(made)
            labels += own
    x, offsets = features(shown)
    model.fit(x.astype(np.float64), offsets, np.array(labels), epochs)
    return model


def extracted(pages: DataFrame, model: Labeller) -> DataFrame:
    r"""``(page_id, url, text, n_chars)`` per row of ``pages (page_id, url, html, …)``.

    The blocks labelled as article, in page order, joined by ``\n``; empty if there are none, and for null
    or empty pages. Rows with equal or null ids are pages of their own.
    """

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "html", 2 << 20):
            parsed = [blocks_of(h) for h in batch["html"].to_pylist()]
            x, offsets = features(parsed)
            chosen = model.probabilities(x, offsets) >= 0.5 if len(x) else np.zeros(0, dtype=bool)
            texts = [
                "\n".join(b.text for b, keep in zip(page, chosen[a:]) if keep) for page, a in zip(parsed, offsets)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        labelled, "page_id bigint, url string, text string, n_chars bigint"
    )
