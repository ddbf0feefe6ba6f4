"""HTML extraction: a bidirectional LSTM labels every block of a page as article text or not.

A page is cut into leaf blocks: runs of text between block-level tags. Every block has hashed vectors of its
tag path (names, classes and ids of the elements around it) and of its words, and a few figures. The network
reads them forwards and backwards over the whole page, so that a block's label depends on its neighbours. It
is trained here, by numpy, on generated pages whose labels are known from how they were made.
"""

from __future__ import annotations

import html
import math
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH_BINS, WORD_BINS, FIGURES = 384, 96, 8
WIDTH = PATH_BINS + WORD_BINS + FIGURES
STRETCH = 1 << 13  # blocks whose vectors are in memory at a time

TAG = re.compile(r"""<(?:!--(?:.*?)(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|[!?/][^>]*+>)""", re.S)
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PARTS = re.compile(r"[a-z]+")
# Element kinds of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr button label output progress meter picture math".split())
MATH = frozenset("mi mo mn ms mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd mtext mspace semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe noembed noframes svg title textarea select option canvas object annotation annotation-xml".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",)}


def leaf_blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """(tag path, text, characters inside links) of a page's blocks in order.

    A path has the names, classes and ids of all open elements, outermost first, however deep they lie. Each stands at
    its innermost place, and of names that share a bin only the innermost stands, so a path has no more parts than
    there are bins. Character references are decoded, white space becomes one space, and blocks without text are
    left out. Scripts, styles, comments and other raw elements have no text and do not end a block."""
    low = None
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[tuple[str, list[int]]] = []
    places: dict[str, list[int]] = {}
    named: dict[int, list[tuple[int, int, str]]] = {}
    parts: list[tuple[str, bool]] = []

    def close_block() -> None:
        text = " ".join(html.unescape("".join(p for p, _ in parts)).split()) if parts else ""
        if text:
            linked = sum(len(p) for p, in_link in parts if in_link)
            out.append((tuple(token for *_, token in sorted(met[-1] for met in named.values())), text, linked))
        parts.clear()

    def push(name: str, tokens: list[str]) -> None:
        bins = [] if name in INLINE or name in MATH else [_bin(token, PATH_BINS) for token in tokens]
        for k, (place, token) in enumerate(zip(bins, tokens)):
            named.setdefault(place, []).append((len(stack), k, token))
        places.setdefault(name, []).append(len(stack))
        stack.append((name, bins))

    def pop_to(name: str) -> None:
        while stack:
            top, bins = stack.pop()
            places[top].pop()
            for place in bins:
                named[place].pop()
                if not named[place]:
                    del named[place]
            if top == name:
                return

    at = 0
    while (tag := TAG.search(page, at)) is not None:
        if tag.start() > at:
            parts.append((page[at : tag.start()], bool(places.get("a"))))
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        ends, attributes = tag[1] or tag[4], tag[3] or tag[6] or ""
        if not ends and name in RAW:
            low = page.lower() if low is None else low
            if len(low) != len(page):  # a letter whose lower case is longer; the tags themselves are ASCII
                low = "".join(c.lower() if c.isascii() else c for c in page)
            stop = low.find(f"</{name}", at)
            stop = low.find(">", stop) if stop >= 0 else stop
            at = stop + 1 if stop >= 0 else len(page)
            continue
        if name not in INLINE and name not in MATH:
            close_block()
        elif name == "br":
            parts.append((" ", False))
        if ends:
            if places.get(name):
                pop_to(name)
            continue
        if name in ENDS_P and places.get("p"):
            pop_to("p")
        if name in SIBLINGS and places.get(name):
            if places[name][-1] > max((places[outer][-1] for outer in SIBLINGS[name] if places.get(outer)), default=-1):
                pop_to(name)
        if name in VOID or attributes.endswith("/"):
            continue
        tokens = [name]
        for found in NAMED.finditer(attributes):
            value = next((v for v in found.groups() if v), "").lower()
            tokens += [f".{t}" for t in PARTS.findall(value)]
        push(name, tokens)
    parts.append((page[at:], bool(places.get("a"))))
    close_block()
    return out


def _bin(token: str, bins: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % bins


def vectors(
    blocks: list[tuple[tuple[str, ...], str, int]], paths: dict[tuple[str, ...], np.ndarray], first: int = 0, total: int | None = None
) -> np.ndarray:
    """A row for each block: path bins (the inner ones weigh more), word bins (shares), figures.

    Blocks may be a stretch, from the one numbered `first`, of a page of `total` blocks."""
    last = (len(blocks) if total is None else total) - 1 - first
    out = np.zeros((len(blocks), WIDTH), np.float32)
    for i, (path, text, linked) in enumerate(blocks):
        if path not in paths:
            if len(paths) > 20_000:
                paths.clear()
            row = np.zeros(PATH_BINS, np.float32)
            for depth, token in enumerate(reversed(path)):
                row[_bin(token, PATH_BINS)] = max(0.3, 1.0 / (1 + 0.15 * depth))
            paths[path] = row
        out[i, :PATH_BINS] = paths[path]
        words = text.lower().split()
        for word in words:
            out[i, PATH_BINS + _bin(word.strip(".,:;!?()"), WORD_BINS)] += 1
        out[i, PATH_BINS:-FIGURES] /= math.sqrt(len(words))
        n = len(text)
        out[i, -FIGURES:] = (
            math.log1p(n) / 6,
            math.log1p(len(words)) / 4,
            min(1.0, linked / n),
            min(1.0, 10 * sum(text.count(c) for c in ".,;") / n),
            text[-1] in ".!?…\"”",
            first + i == 0,
            i == last,
            1.0,
        )
    return out


@dataclass(frozen=True)
class Training:
    """pages: generated pages to learn from. sample_pages: rows of the table whose words fill them; the bound of
    what the driver takes from the table, with at most sample_words words of each."""

    pages: int = 800
    hidden: int = 12
    epochs: int = 6
    batch: int = 40
    rate: float = 0.01
    seed: int = 11
    sample_pages: int = 200
    sample_words: int = 300


@dataclass
class Network:
    """Weights of both directions (inputs, state, bias of the four gates) and of the output."""

    inputs: list[np.ndarray] = field(default_factory=list)
    state: list[np.ndarray] = field(default_factory=list)
    bias: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray | None = None
    shift: float = 0.0


def new_network(hidden: int, seed: int) -> Network:
    rng = np.random.default_rng(seed)
    net = Network()
    for _ in range(2):
        net.inputs.append((rng.standard_normal((WIDTH, 4 * hidden)) * 0.15).astype(np.float32))
        net.state.append((rng.standard_normal((hidden, 4 * hidden)) / math.sqrt(hidden) * 0.5).astype(np.float32))
        bias = np.zeros(4 * hidden, np.float32)
        bias[hidden : 2 * hidden] = 1.0
        net.bias.append(bias)
    net.out = (rng.standard_normal(2 * hidden) * 0.3).astype(np.float32)
    return net


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _pass(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool, state=None):
    """States of one direction over (time, page, gates) inputs, what training needs of them, and the last state.

    It starts from `state` or from zero; padded steps leave the state as it is."""
    hidden = u.shape[0]
    h, c = state or (np.zeros((x.shape[1], hidden), np.float32), np.zeros((x.shape[1], hidden), np.float32))
    states, trace = np.empty((*x.shape[:2], hidden), np.float32), []
    drive = x @ w + b
    for t in range(len(x)):
        gates = drive[t] + h @ u
        i, f, o = (_sigmoid(gates[:, k * hidden : (k + 1) * hidden]) for k in (0, 1, 2))
        g = np.tanh(gates[:, 3 * hidden :])
        m = mask[t][:, None]
        new_c = f * c + i * g
        tanh_c = np.tanh(new_c)
        if keep:
            trace.append((h, c, i, f, o, g, tanh_c, m))
        c, h = m * new_c + (1 - m) * c, m * o * tanh_c + (1 - m) * h
        states[t] = h
    return states, trace, (h, c)


def _back(x: np.ndarray, trace: list, grad: np.ndarray, w: np.ndarray, u: np.ndarray):
    hidden = u.shape[0]
    dh, dc = np.zeros_like(trace[0][0]), np.zeros_like(trace[0][0])
    drive = np.empty((*x.shape[:2], 4 * hidden), np.float32)
    du = np.zeros_like(u)
    for t in range(len(x) - 1, -1, -1):
        h, c, i, f, o, g, tanh_c, m = trace[t]
        dh = dh + grad[t]
        d_new, keep_h = m * dh, (1 - m) * dh
        d_c = m * dc + d_new * o * (1 - tanh_c**2)
        drive[t] = np.concatenate([d_c * g * i * (1 - i), d_c * c * f * (1 - f), d_new * tanh_c * o * (1 - o), d_c * i * (1 - g**2)], axis=1)
        du += h.T @ drive[t]
        dh = drive[t] @ u.T + keep_h
        dc = d_c * f + (1 - m) * dc
    flat = drive.reshape(-1, 4 * hidden)
    return x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(axis=0)


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x = np.zeros((longest, len(pages), WIDTH), np.float32)
    mask = np.zeros((longest, len(pages)), np.float32)
    for k, page in enumerate(pages):
        x[: len(page), k], mask[: len(page), k] = page, 1
    return x, mask


def _logits(net: Network, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    # Backwards, padded steps come first and leave the state at zero.
    ahead, trace_a, _ = _pass(x, mask, net.inputs[0], net.state[0], net.bias[0], keep)
    behind, trace_b, _ = _pass(x[::-1], mask[::-1], net.inputs[1], net.state[1], net.bias[1], keep)
    both = np.concatenate([ahead, behind[::-1]], axis=2)
    return both @ net.out + net.shift, both, trace_a, trace_b


def label(net: Network, pages: list[np.ndarray], cells: int = STRETCH) -> list[np.ndarray]:
    """Whether each block of each page is article text; pages of like length go through together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and len(pages[order[to]]) * (to + 1 - at) <= cells:
            to += 1
        x, mask = _padded([pages[k] for k in order[at:to]])
        found = _logits(net, x, mask)[0] > 0
        for column, k in enumerate(order[at:to]):
            out[k] = found[: len(pages[k]), column]
        at = to
    return out


def label_long(net: Network, blocks: list[tuple[tuple[str, ...], str, int]], paths: dict[tuple[str, ...], np.ndarray], step: int = STRETCH) -> np.ndarray:
    """What label gives for one page, a stretch of blocks at a time: each direction hands its state to the next one."""
    hidden, starts = net.state[0].shape[0], range(0, len(blocks), step)
    score = np.full(len(blocks), net.shift, np.float32)
    for side, order in ((0, starts), (1, reversed(starts))):
        state, turn = None, -1 if side else 1
        for at in order:
            x = vectors(blocks[at : at + step], paths, at, len(blocks))[::turn, None]
            states, _, state = _pass(x, np.ones(x.shape[:2], np.float32), net.inputs[side], net.state[side], net.bias[side], False, state)
            score[at : at + step] += (states[:, 0] @ net.out[side * hidden : (side + 1) * hidden])[::turn]
    return score > 0


def train(pages: list[tuple[np.ndarray, np.ndarray]], training: Training) -> Network:
    """Fit the network to (vectors, labels) of pages by Adam on the mean log loss of blocks."""
    net, rng = new_network(training.hidden, training.seed), np.random.default_rng(training.seed)
    moments: dict[str, list[np.ndarray]] = {}
    step = 0

    def move(key: str, value: np.ndarray, grad: np.ndarray) -> np.ndarray:
        m, v = moments.setdefault(key, [np.zeros_like(grad), np.zeros_like(grad)])
        m[...] = 0.9 * m + 0.1 * grad
        v[...] = 0.999 * v + 0.001 * grad**2
        return (value - training.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    for _ in range(training.epochs):
        order = rng.permutation(len(pages))
        for at in range(0, len(order), training.batch):
            chosen = [pages[k] for k in order[at : at + training.batch]]
            x, mask = _padded([c[0] for c in chosen])
            y = np.zeros_like(mask)
            for k, (_, labels) in enumerate(chosen):
                y[: len(labels), k] = labels
            logits, both, trace_a, trace_b = _logits(net, x, mask, keep=True)
            error = ((_sigmoid(logits) - y) * mask / mask.sum()).astype(np.float32)
            spread = error[:, :, None] * net.out
            hidden = training.hidden
            step += 1
            grads = [_back(x, trace_a, spread[:, :, :hidden], net.inputs[0], net.state[0]), _back(x[::-1], trace_b, spread[::-1, :, hidden:], net.inputs[1], net.state[1])]
            net.out = move("out", net.out, np.tensordot(error, both, axes=([0, 1], [0, 1])))
            net.shift = float(move("shift", np.float32(net.shift), np.asarray(error.sum(), np.float32)))
            for k, (dw, du, db) in enumerate(grads):
                for key, part, grad in (("inputs", net.inputs, dw), ("state", net.state, du), ("bias", net.bias, db)):
                    part[k] = move(f"{key}{k}", part[k], grad)
    return net


# Names that pages give to their parts, and words that such parts have.
GOOD_NAMES = "content article post entry story body text main prose markdown page-body article-body post-content entry-content".split()
BAD_NAMES = {
    "nav": "nav menu navbar breadcrumb breadcrumbs topnav site-nav pagination tabs".split(),
    "header": "header masthead top-bar site-header banner branding".split(),
    "footer": "footer site-footer colophon bottom legal credits".split(),
    "aside": "sidebar aside related widget rail recommended trending tags toc".split(),
    "ad": "ad ads advert advertisement sponsored promo banner-ad adbox dfp".split(),
    "notice": "notice cookie cookies consent gdpr alert newsletter popup modal paywall disclaimer".split(),
    "form": "form search login signup subscribe contact poll".split(),
    "comments": "comments comment replies discussion disqus responses feedback reader-comments".split(),
    "share": "share social sharing buttons tools byline meta".split(),
}
LAYOUT_NAMES = "flex row col grid wide dark light large small left right inner outer block mt px md lg hidden clearfix".split()
BAD_TAGS = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}
BAD_WORDS = {
    "nav": "home about contact next previous menu login archive topics",
    "header": "welcome sign in search site edition",
    "footer": "© copyright all rights reserved privacy terms imprint contact",
    "aside": "related read more popular most read trending tags follow",
    "ad": "advertisement sponsored buy now offer sale free shipping",
    "notice": "we use cookies accept decline subscribe newsletter notice",
    "form": "name email message submit search send password",
    "comments": "reply says posted comment ago like report user wrote",
    "share": "share tweet facebook email print save by updated",
}


class _Maker:
    """Pages of random make with known labels."""

    def __init__(self, words: list[str], seed: int):
        self.random, self.words = random.Random(seed), words or ["word"]

    def say(self, low: int, high: int) -> str:
        picked = self.random.choices(self.words, k=self.random.randint(low, high))
        return html.escape(" ".join(picked).capitalize() + self.random.choice([".", ".", ".", "", "!", "?"]), quote=False)

    def attributes(self, names: list[str], chance: float) -> str:
        if self.random.random() >= chance:
            return ""
        kind = self.random.choice(["class", "class", "id"])
        other = self.random.choices(LAYOUT_NAMES, k=self.random.randint(1, 12)) if self.random.random() < 0.15 else []
        return f' {kind}="{" ".join([*other, ""])}{self.random.choice(names)}{self.random.choice(["", "", " col", "-1", " wide"])}"'

    def depth(self) -> int:
        """How many plain elements lie between a part and its texts."""
        return self.random.choice([0, 0, 0, 0, self.random.randint(1, 4), self.random.randint(5, 40)])

    def part(self, kind: str) -> list[tuple[str, bool | None]]:
        """A part that is no article text, as (markup, label of a text in it)."""
        own = BAD_WORDS[kind].split()
        tag = BAD_TAGS.get(kind, "div") if self.random.random() < 0.6 else self.random.choice(["div", "section", "div"])
        bare = tag in ("nav", "footer", "aside", "form") or (tag == "header" and kind == "header")
        out: list[tuple[str, bool | None]] = [(f"<{tag}{self.attributes(BAD_NAMES[kind], 0.5 if bare else 1.0)}>", None)]
        deep, plain = self.depth(), self.random.choice(["div", "div", "section"])
        out.append((f"<{plain}>" * deep, None))

        def text() -> str:
            extra = " ".join(self.random.choices(own, k=self.random.randint(1, 4)))
            return {0: extra, 1: self.say(1, 6), 2: f"{extra} {self.say(2, 14)}", 3: self.say(4, 40)}[self.random.randint(0, 3)]

        if kind in ("nav", "aside", "share") or self.random.random() < 0.2:
            out.append((f"<ul>", None))
            for _ in range(self.random.randint(2, 7)):
                out += [("<li><a href=/x>", None), (self.say(1, 3) if self.random.random() < 0.7 else text(), False), ("</a></li>", None)]
            out.append(("</ul>", None))
        else:
            inner = self.random.choice(["p", "p", "div", "span", ""])
            for _ in range(self.random.randint(1, 6) if kind == "comments" else self.random.randint(1, 2)):
                opened = f"<{inner}>" if inner else "<br>" if False else ""
                out += [(opened, None), (text(), False), (f"</{inner}>" if inner else "", None)]
                if not inner or inner == "span":
                    break
        return [*out, (f"</{plain}>" * deep + f"</{tag}>", None)]

    def article(self) -> list[tuple[str, bool | None]]:
        tag = self.random.choice(["article", "article", "main", "div", "section"])
        out: list[tuple[str, bool | None]] = [(f"<{tag}{self.attributes(GOOD_NAMES, 0.3 if tag in ('article', 'main') else 1.0)}>", None)]
        deep = self.depth()
        out.append(("<div>" * deep, None))
        if self.random.random() < 0.85:
            head = self.random.choice(["h1", "h1", "h2"])
            out += [(f"<{head}>", None), (self.say(2, 12), True), (f"</{head}>", None)]
        if self.random.random() < 0.15:
            out += self.part("share")
        for _ in range(self.random.choice([0, 1, 1, 2, 3, 4, 6, 9, 14])):
            close = self.random.random() < 0.9
            kind = self.random.choice(["p"] * 10 + ["blockquote", "li", "h2", "pre", "td"])
            before, after = {"li": ("<ul><li>", "</li></ul>"), "td": ("<table><tr><td>", "</td></tr></table>")}.get(kind, (f"<{kind}>", f"</{kind}>"))
            if kind == "p" and self.random.random() < 0.15:
                before, after = "<p><b>", "<br>"
            text = self.say(1, 6) if self.random.random() < 0.25 else self.say(8, 90)
            out += [(before, None), (text, True), (after if close or kind != "p" else "", None)]
            if self.random.random() < 0.07:
                out += self.part(self.random.choice(["ad", "aside", "share", "notice", "form"]))
        if self.random.random() < 0.15:
            out += self.part(self.random.choice(["comments", "share", "aside"]))
        return [*out, ("</div>" * deep + f"</{tag}>", None)]

    def page(self) -> tuple[str, list[tuple[str, bool]]]:
        """Markup, and (text, label) of its texts in order."""
        pick = self.random
        parts: list[tuple[str, bool | None]] = [(f"<!DOCTYPE html><html><head><title>{self.say(2, 8)}</title></head><body>", None)]
        for kind in pick.sample(["header", "nav", "ad", "notice", "form", "aside"], k=pick.randint(0, 4)):
            parts += self.part(kind)
        wrapped = pick.random() < 0.4
        if wrapped:
            parts.append((f"<div{self.attributes(['wrapper', 'container', 'page', 'layout', 'site'], 0.8)}>", None))
        parts += self.article()
        for kind in pick.sample(["comments", "aside", "ad", "share", "form", "notice"], k=pick.randint(0, 3)):
            parts += self.part(kind)
        if wrapped:
            parts.append(("</div>", None))
        if pick.random() < 0.8:
            parts += self.part("footer")
        if pick.random() < 0.85:
            parts.append(("</body></html>", None))
        return "".join(p for p, _ in parts), [(p, y) for p, y in parts if y is not None]


def made_pages(words: list[str], n: int, seed: int) -> Iterator[tuple[list[tuple[tuple[str, ...], str, int]], np.ndarray]]:
    """(blocks, labels) of generated pages; a page whose blocks are not its texts one by one is left out."""
    maker = _Maker(words, seed)
    for _ in range(n):
        page, texts = maker.page()
        blocks = leaf_blocks(page)
        want = [(t, y) for x, y in texts if (t := " ".join(html.unescape(x).split()))]
        if [b[1] for b in blocks] == [t for t, _ in want]:
            yield blocks, np.array([y for _, y in want], np.float32)


def fit(pages: DataFrame, training: Training = Training()) -> Network:
    """Train on generated pages that are filled with words of a bounded sample of the table's pages."""
    text = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>", " ")
    words = F.slice(F.split(F.trim(text), r"\s+"), 1, training.sample_words)
    order = F.xxhash64(F.col("page_id").cast("string"))
    last = pages.select(order.alias("order")).orderBy("order").limit(training.sample_pages).agg(F.max("order")).first()[0]
    near = pages.where(order <= F.lit(last)) if last is not None else pages.limit(0)
    sample = near.select("page_id", "html").orderBy(order, "html").limit(training.sample_pages)
    found = [html.unescape(w) for row in sample.select(words.alias("w")).collect() for w in row["w"] if w]
    made = [(vectors(b, {}), y) for b, y in made_pages(found, training.pages, training.seed) if len(b)]
    return train(made, training)


def extract(pages: DataFrame, net: Network) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) for every row of pages (page_id, url, html): the blocks that the
    network labels as article text, in page order, one line each.

    Null and empty pages, and pages without such blocks, have an empty text. Rows are independent: repeated ones
    give the same text, an empty table gives no rows, and other columns are not read. A page of any length is read
    whole: its blocks' vectors are made a stretch at a time.
    """
    # Arrays alone: a broadcast is pickled by name of class, and executors need not have this package.
    share = pages.sparkSession.sparkContext.broadcast((net.inputs, net.state, net.bias, net.out, net.shift))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, paths = Network(*share.value), {}

        def marked(found: list) -> list[np.ndarray]:
            if len(found) == 1 and len(found[0]) > STRETCH:
                return [label_long(own, found[0], paths)]
            return label(own, [vectors(b, paths) for b in found])

        def article(found: list) -> list[str]:
            return ["\n".join(block[1] for block, good in zip(b, m) if good) for b, m in zip(found, marked(found))]

        for batch in batches:
            texts, counts, found, held = [], [], [], 0
            for page in batch.column(2):
                blocks = leaf_blocks(page.as_py() or "")
                counts.append(len(blocks))
                if found and held + len(blocks) > STRETCH:
                    texts += article(found)
                    found, held = [], 0
                found.append(blocks)
                held += len(blocks)
            texts += article(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(counts, pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_blocks"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(task, "page_id long, url string, text string, n_chars long, n_blocks long")
