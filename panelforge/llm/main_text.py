"""Main text of web pages: a recurrent network labels every block, in the context of the whole page.

1. A page becomes the sequence of its leaf blocks: runs of text between block
   level tags, with character references decoded, white space (of any kind)
   made one space, and the path of open elements. Unclosed and misnested tags
   are closed as browsers do; scripts, styles, templates and form controls have
   no blocks.
2. A block is read as a vector: hashed tokens of the tag path (names, words of
   class, id, role), the inner elements apart; hashed words; and a few measures
   of length, links and place.
3. A bidirectional LSTM in numpy runs over a page's blocks, so that each label
   depends on all blocks before and after, and labels every one of them. Blocks
   over 0.5 are the main text, joined by blank lines.

The pages carry no labels, so the network is trained here on a bounded sample
of them (``SAMPLE_PAGES``): blocks are labelled by the meaning of their
containers, where the markup states it, and each page is also dealt out in
other dress - other containers of the same meaning, and boilerplate of all
kinds made of texts of the sample - so that no single template is learned.

Defined results: null or empty html, and pages without main text, give ''.
Repeated rows and null ids are pages like others; a table without usable pages
to learn from is labelled by the rules that label the sample.
"""

from __future__ import annotations

import html as references
import re
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import Words, text_of

#: Pages learned from, and the longest of them in characters; bounds of the training sample alone.
SAMPLE_PAGES = 300
SAMPLE_CHARS = 200_000
#: Ways in which each page of the sample is dressed besides its own.
DRESSES = 4
EPOCHS = 6
SEED = 11
PATH_BUCKETS, WORD_BUCKETS = 1 << 12, 1 << 13
PATH_SIZE, WORD_SIZE, MEASURES, HIDDEN = 24, 8, 7, 24
#: Elements of a path that are read from either end.
PATH_ENDS = 12
#: Pages labelled at once, and blocks in them.
BATCH_PAGES, BATCH_BLOCKS = 256, 20_000

# Element names of the HTML standard.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset("noscript template select datalist svg math object audio video canvas button".split())
#: A start tag of the key ends an open element of the values, up to the nearest of the last.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})}
ENDS |= {"tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
ENDS |= {k: ({"thead", "tbody", "tfoot"}, {"table"}) for k in ("thead", "tbody", "tfoot")}

# Containers by meaning, as (element, words of class or id).
CONTENT = [
    ("article", ""), ("main", ""), ("article", "post"), ("div", "article"), ("div", "article body"), ("div", "post content"), ("div", "entry content"),
    ("div", "content"), ("div", "main content"), ("section", "story"), ("div", "story body"), ("div", "post body"), ("div", "text"), ("td", "content"),
    ("section", "article text"), ("div", "page content"), ("section", "content"), ("div", "main"), ("div", "body"), ("div", "post"), ("div", ""),
]
BOILERPLATE = {
    "menu": [("nav", ""), ("div", "nav"), ("div", "menu"), ("ul", "menu"), ("div", "navbar"), ("div", "navigation"), ("div", "breadcrumb"), ("nav", "breadcrumbs"), ("div", "pagination"), ("menu", ""), ("div", "toc")],
    "header": [("header", ""), ("div", "header"), ("div", "masthead"), ("div", "top bar"), ("header", "site header"), ("div", "banner"), ("div", "logo")],
    "footer": [("footer", ""), ("div", "footer"), ("div", "copyright"), ("footer", "site footer"), ("div", "bottom"), ("div", "legal")],
    "sidebar": [("aside", ""), ("div", "sidebar"), ("aside", "sidebar"), ("div", "related"), ("div", "widget"), ("div", "recommended"), ("section", "related"), ("div", "trending"), ("div", "side"), ("td", "sidebar")],
    "notice": [("div", "cookie notice"), ("div", "consent"), ("div", "cookie banner"), ("div", "notice"), ("dialog", ""), ("div", "modal"), ("div", "popup"), ("div", "gdpr"), ("div", "alert"), ("div", "privacy"), ("section", "cookies")],
    "advert": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "sponsored"), ("aside", "ad"), ("div", "promo"), ("ins", "adsbygoogle"), ("section", "promotion"), ("p", "ad"), ("div", "sponsor")],
    "form": [("form", ""), ("div", "newsletter"), ("form", "search"), ("form", "login"), ("div", "subscribe"), ("fieldset", ""), ("form", "signup"), ("div", "contact form")],
    "comments": [("div", "comments"), ("section", "comments"), ("ol", "comment list"), ("div", "comment"), ("div", "disqus thread"), ("div", "respond"), ("section", "reader comments"), ("ul", "comments"), ("div", "replies"), ("div", "discussion")],
    "share": [("div", "share"), ("div", "social"), ("ul", "social links"), ("div", "sharing"), ("div", "author bio"), ("div", "tags"), ("div", "meta")],
}
#: Elements and words that state a meaning by themselves.
SAYS_CONTENT = frozenset("article main .article .post .entry .story .articlebody .content".split())
SAYS_NOT = frozenset(
    "nav header footer aside form dialog menu .nav .menu .navbar .navigation .breadcrumb .breadcrumbs .pagination .header .masthead .footer .copyright .sidebar .related "
    ".widget .cookie .cookies .consent .notice .modal .popup .gdpr .ad .ads .advert .advertisement .sponsored .promo .newsletter .search .login .subscribe .comments "
    ".comment .disqus .respond .replies .share .social .sharing".split()
)

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)""", re.S)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAME_WORD = re.compile(r"[a-z]+", re.A)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

Element = tuple[str, ...]
Block = tuple[tuple[Element, ...], str, float]


# ---------------------------------------------------------------- pages to blocks


def element(name: str, attributes: str) -> Element:
    """The name of an element and the words of its class, id, role and item property."""
    words = []
    if "=" in attributes:
        for key, *values in _ATTRIBUTE.findall(attributes):
            if key.lower() in ("class", "id", "role", "itemprop"):
                words += _NAME_WORD.findall(_CAMEL.sub(" ", "".join(values)).lower())
    return (name, *[f".{w}" for w in words])


def blocks(page: str) -> list[Block]:
    """(path, text, share of characters in links) of each leaf block in page order."""
    out: list[Block] = []
    stack: list[Element] = []
    pieces: list[str] = []
    state = {"linked": 0, "in_link": 0, "unseen": 0}

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                path = [e for e in stack if e[0] in BLOCK or len(e) > 1]
                ends = path if len(path) <= 2 * PATH_ENDS else path[:PATH_ENDS] + path[-PATH_ENDS:]
                out.append((tuple(ends), text, min(1.0, state["linked"] / len(text))))
        state["linked"] = 0

    def pop_to(at: int) -> None:
        for e in stack[at:]:
            state["in_link"] -= e[0] == "a"
            state["unseen"] -= e[0] in UNSEEN
        del stack[at:]

    def say(text: str) -> None:
        if text and not state["unseen"]:
            text = references.unescape(text) if "&" in text else text
            pieces.append(text)
            if state["in_link"]:
                state["linked"] += len(text)

    at, size = 0, len(page)
    while at < size:
        tag = _TAG.search(page, at)
        if tag is None:
            say(page[at:])
            break
        say(page[at : tag.start()])
        at = tag.end()
        closing, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if not name:
            continue
        name = name.lower()
        if closing:
            if name in BLOCK:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop_to(k)
                    break
                if name not in BLOCK and stack[k][0] in BLOCK:
                    break  # an inline end tag does not end a block
            continue
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else size
            continue
        if name == "br":
            say(" ")
            continue
        if name in BLOCK:
            flush()
            if name in ENDS or name not in ("html", "body", "head"):
                ended, until = ENDS.get(name, ({"p"}, {"body", "td", "th", "li", "div", "article", "section", "main", "aside", "blockquote"}))
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in ended:
                        pop_to(k)
                        break
                    if stack[k][0] in until:
                        break
            if name == "body":
                pop_to(0)
        if name in VOID or attributes.endswith("/") and name not in BLOCK and name != "a":
            continue
        stack.append(element(name, attributes))
        state["in_link"] += name == "a"
        state["unseen"] += name in UNSEEN
    flush()
    return out


# ---------------------------------------------------------------- labels of the sample


def stated(path: Sequence[Element]) -> int | None:
    """1 or 0 where the markup states that a block is main text or not, else None."""
    found = None
    for e in path:
        if any(t in SAYS_NOT for t in e) and not (found == 1 and e[0] == "header"):
            return 0
        if any(t in SAYS_CONTENT for t in e):
            found = 1
    return found


def rule_labels(page: Sequence[Block]) -> list[int | None]:
    """Stated labels; on a page that states no main text, long blocks without links are taken for it."""
    labels = [stated(path) for path, _, _ in page]
    if 1 in labels:
        return labels
    return [0 if y == 0 or linked > 0.3 or len(text.split()) < 8 else 1 for y, (_, text, linked) in zip(labels, page)]


def _worded(rng: np.random.Generator, container: tuple[str, str]) -> Element:
    name, words = container
    return (name, *[f".{w}" for w in words.split()])


def dressed(rng: np.random.Generator, page: Sequence[Block], labels: Sequence[int | None], prose: Sequence[str], short: Sequence[str]) -> tuple[list[Block], list[int]]:
    """The main text of a page in another container, amid boilerplate of the kinds that pages have."""
    one = lambda of: of[rng.integers(len(of))]
    outer: list[Element] = [("html",), ("body",)]
    outer += [_worded(rng, one([("div", "wrapper"), ("div", "page"), ("div", "container"), ("div", ""), ("div", "site"), ("table", ""), ("div", "root")])) for _ in range(rng.integers(0, 3))]
    body = [*outer, _worded(rng, one(CONTENT))]
    body += [("div",)] * int(rng.random() < 0.3)
    content: list[tuple[Block, int]] = []
    for (path, text, linked), y in zip(page, labels):
        if y == 1:
            leaf = path[-1][:1] if path and path[-1][0] in BLOCK - {"article", "main", "section", "div", "body"} else ("p",)
            inside = [one([("ul",), ("blockquote",), ("table",), ("figure",), ("div",), ("section",)])] if rng.random() < 0.08 else []
            content.append((((*body, *inside, leaf), text, linked), 1))
    for _ in range(rng.integers(0, 4)):  # what articles hold besides paragraphs, in short pieces
        inside = one([[("ul",), ("li",)], [("ol",), ("li",)], [("table",), ("tr",), ("td",)], [("table",), ("tbody",), ("tr",), ("td",)], [("h2",)], [("h3",)], [("header",), ("h1",)],
                      [("header",), ("h2",)], [("blockquote",), ("p",)], [("pre",)], [("figure",), ("figcaption",)], [("dl",), ("dd",)], [("p",)], [("div",), ("p",)]])
        many = int(rng.integers(2, 7)) if len(inside) > 1 and inside[0][0] in ("ul", "ol", "table", "dl") else 1
        pieces = [" ".join(one(prose).split()[: rng.integers(1, 15)]) if rng.random() < 0.8 else one(prose) for _ in range(many)]
        made = [(((*body, *inside), text, float(rng.random() < 0.1)), 1) for text in pieces]
        cut = 0 if inside[0][0] == "header" else int(rng.integers(0, len(content) + 1))
        content = content[:cut] + made + content[cut:]

    def part(kind: str, within: list[Element]) -> list[tuple[Block, int]]:
        top = [*within, _worded(rng, one(BOILERPLATE[kind]))]
        links = kind in ("menu", "sidebar", "share") and rng.random() < 0.8
        many = rng.integers(1, {"menu": 9, "sidebar": 6, "comments": 7, "share": 5}.get(kind, 3) + 1)
        made = []
        for _ in range(many):
            long = rng.random() < {"comments": 0.8, "notice": 0.6, "advert": 0.5, "sidebar": 0.3, "footer": 0.3, "form": 0.2}.get(kind, 0.05)
            text = one(prose) if long else one(short)
            leaf = [("ul",), ("li",)] if links else [one([("p",), ("div",), ("h3",), ("span", ".label"), ("li",), ("h4",), ("h1",), ("h2",)])] if rng.random() < 0.8 else []
            made.append(((tuple([*top, *leaf]), text, float(links)), 0))
        return made

    maybe = lambda kind, chance, within: part(kind, within) if rng.random() < chance else []
    before = maybe("notice", 0.3, outer) + maybe("header", 0.5, outer) + maybe("menu", 0.6, outer) + maybe("advert", 0.4, outer) + maybe("form", 0.2, outer) + maybe("sidebar", 0.25, outer)
    after = maybe("share", 0.3, body if rng.random() < 0.5 else outer) + maybe("advert", 0.3, outer) + maybe("comments", 0.5, body if rng.random() < 0.3 else outer)
    after += maybe("sidebar", 0.4, outer) + maybe("form", 0.3, body if rng.random() < 0.2 else outer) + maybe("footer", 0.6, outer) + maybe("notice", 0.2, outer)
    if len(content) > 2 and rng.random() < 0.35:
        cut = int(rng.integers(1, len(content)))
        content = content[:cut] + part(one(["advert", "sidebar", "share", "form", "notice"]), body) + content[cut:]
    rows = before + content + after
    return [b for b, _ in rows], [y for _, y in rows]


# ---------------------------------------------------------------- blocks to vectors


def _bucket(token: str, size: int) -> int:
    return zlib.crc32(token.encode()) % size


def path_buckets(path: Sequence[Element], known: dict[tuple[Element, ...], list[int]]) -> list[int]:
    found = known.get(path)
    if found is None:
        found = [_bucket(t, PATH_BUCKETS) for e in path for t in e] + [_bucket(f"inner {t}", PATH_BUCKETS) for e in path[-2:] for t in e] + [0]
        if len(known) < 50_000:
            known[path] = found
    return found


class Inputs:
    """Vectors of the blocks of several pages, as bags of buckets and measures."""

    def __init__(self, pages: Sequence[Sequence[Block]], known: dict | None = None):
        known = {} if known is None else known
        flat = [b for page in pages for b in page]
        self.lengths = np.array([len(page) for page in pages], np.int64)
        bags = [path_buckets(path, known) for path, _, _ in flat]
        self.path_ids = np.fromiter((i for bag in bags for i in bag), np.int64)
        self.path_from = np.concatenate(([0], np.cumsum([len(bag) for bag in bags]))).astype(np.int64)
        texts = [text.encode() for _, text, _ in flat]
        offs = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        words = Words(np.frombuffer(b"".join(texts), np.uint8), offs, lower=True)
        self.word_ids = (words.hashes() % np.uint64(WORD_BUCKETS)).astype(np.int64)
        self.word_from = np.asarray(words.first, np.int64)
        n_words = np.diff(self.word_from)
        place = np.concatenate([np.arange(n) / max(1, n - 1) for n in self.lengths]) if len(flat) else np.zeros(0)
        size = np.diff(offs)
        ends = np.array([text[-1] in ".!?…。:;" for _, text, _ in flat], float) if flat else np.zeros(0)
        linked = np.array([x for _, _, x in flat], float)
        self.measures = np.stack([np.log1p(size) / 5, np.log1p(n_words) / 4, linked, ends, place, 1 - place, size / np.maximum(1, n_words) / 10], 1).astype(np.float32)


def _bag_sums(table: np.ndarray, ids: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sum of the rows of ``table`` in each bag; an empty bag is zero."""
    out = np.zeros((len(start) - 1, table.shape[1]), table.dtype)
    full = np.flatnonzero(np.diff(start))
    if len(full):
        out[full] = np.add.reduceat(table[ids], start[full], axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over blocks, with its training by Adam."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        d, h = PATH_SIZE + WORD_SIZE + MEASURES, HIDDEN
        draw = lambda *shape, by=0.1: (rng.standard_normal(shape) * by).astype(np.float32)
        self.p = {"path": draw(PATH_BUCKETS, PATH_SIZE), "word": draw(WORD_BUCKETS, WORD_SIZE), "out": draw(2 * h + d), "bias": np.zeros(1, np.float32)}
        for way in "fb":
            gates = np.zeros(4 * h, np.float32)
            gates[h : 2 * h] = 1  # remember at first
            self.p |= {f"x{way}": draw(d, 4 * h, by=0.2), f"h{way}": draw(h, 4 * h, by=0.2), f"g{way}": gates}
        self.moments = None

    def _vectors(self, x: Inputs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        path = np.tanh(_bag_sums(self.p["path"], x.path_ids, x.path_from))
        counts = np.maximum(1, np.diff(x.word_from))[:, None].astype(np.float32)
        return np.concatenate([path, _bag_sums(self.p["word"], x.word_ids, x.word_from) / counts, x.measures], 1), path, counts

    def _run(self, way: str, v: np.ndarray, mask: np.ndarray, keep: bool):
        """Hidden states (time, page, hidden); the states of steps for the way back if ``keep``."""
        steps, n, _ = v.shape
        size = HIDDEN
        h, c = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
        out, kept = np.zeros((steps, n, size), np.float32), []
        entered = v @ self.p[f"x{way}"] + self.p[f"g{way}"]
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = entered[t] + h @ self.p[f"h{way}"]
            i, f, o = _sigmoid(z[:, :size]), _sigmoid(z[:, size : 2 * size]), _sigmoid(z[:, 2 * size : 3 * size])
            g = np.tanh(z[:, 3 * size :])
            m = mask[t][:, None]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            new_h = o * tanh_c
            if keep:
                kept.append((t, i, f, o, g, tanh_c, h, c, m))
            c, h = m * new_c + (1 - m) * c, m * new_h + (1 - m) * h
            out[t] = h
        return out, kept

    def _back(self, way: str, v: np.ndarray, kept: list, d_out: np.ndarray, grads: dict[str, np.ndarray]) -> np.ndarray:
        n, size = v.shape[1], HIDDEN
        d_h, d_c = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
        d_z = np.zeros((len(kept), n, 4 * size), np.float32)
        for t, i, f, o, g, tanh_c, h0, c0, m in reversed(kept):
            d_h = d_h + d_out[t]
            new_h, new_c = m * d_h, m * d_c
            new_c = new_c + new_h * o * (1 - tanh_c**2)
            d_z[t] = np.concatenate([new_c * g * i * (1 - i), new_c * c0 * f * (1 - f), new_h * tanh_c * o * (1 - o), new_c * i * (1 - g**2)], 1)
            grads[f"h{way}"] += h0.T @ d_z[t]
            d_h, d_c = (1 - m) * d_h + d_z[t] @ self.p[f"h{way}"].T, (1 - m) * d_c + new_c * f
        grads[f"x{way}"] += np.tensordot(v, d_z, ((0, 1), (0, 1)))
        grads[f"g{way}"] += d_z.sum((0, 1))
        return d_z @ self.p[f"x{way}"].T

    def _laid(self, x: Inputs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        flat, path, counts = self._vectors(x)
        page = np.repeat(np.arange(len(x.lengths)), x.lengths)
        step = np.arange(len(page)) - np.repeat(np.cumsum(x.lengths) - x.lengths, x.lengths)
        v = np.zeros((int(x.lengths.max(initial=0)), len(x.lengths), flat.shape[1]), np.float32)
        mask = np.zeros(v.shape[:2], np.float32)
        v[step, page], mask[step, page] = flat, 1
        return v, mask, step, page, path, counts

    def scores(self, x: Inputs) -> np.ndarray:
        """Probability of main text for each block."""
        v, mask, step, page, _, _ = self._laid(x)
        states = np.concatenate([self._run("f", v, mask, False)[0], self._run("b", v, mask, False)[0], v], 2)
        return _sigmoid(states[step, page] @ self.p["out"] + self.p["bias"])

    def learn(self, x: Inputs, labels: np.ndarray, weight: np.ndarray, rate: float) -> float:
        """One step on a batch; returns its loss."""
        v, mask, step, page, path, counts = self._laid(x)
        (hf, kf), (hb, kb) = self._run("f", v, mask, True), self._run("b", v, mask, True)
        states = np.concatenate([hf, hb, v], 2)[step, page]
        y = _sigmoid(states @ self.p["out"] + self.p["bias"])
        total = max(1.0, float(weight.sum()))
        d = ((y - labels) * weight / total).astype(np.float32)
        grads = {k: np.zeros_like(p) for k, p in self.p.items()}
        grads["out"], grads["bias"] = states.T @ d, d.sum(keepdims=True)
        d_states = np.zeros((*mask.shape, states.shape[1]), np.float32)
        d_states[step, page] = d[:, None] * self.p["out"]
        d_v = d_states[:, :, 2 * HIDDEN :] + self._back("f", v, kf, d_states[:, :, :HIDDEN], grads) + self._back("b", v, kb, d_states[:, :, HIDDEN : 2 * HIDDEN], grads)
        d_flat = d_v[step, page]
        d_path = d_flat[:, :PATH_SIZE] * (1 - path**2)
        np.add.at(grads["path"], x.path_ids, np.repeat(d_path, np.diff(x.path_from), axis=0))
        np.add.at(grads["word"], x.word_ids, np.repeat(d_flat[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] / counts, np.diff(x.word_from), axis=0))
        self._adam(grads, rate)
        near = np.clip(np.where(labels == 1, y, 1 - y), 1e-7, 1)
        return float(-(np.log(near) * weight).sum() / total)

    def _adam(self, grads: dict[str, np.ndarray], rate: float) -> None:
        if self.moments is None:
            self.moments = [0, {k: np.zeros_like(p) for k, p in self.p.items()}, {k: np.zeros_like(p) for k, p in self.p.items()}]
        self.moments[0] += 1
        t, first, second = self.moments
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / max(norm, 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g**2
            self.p[k] -= (rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)


def fit(pages: Sequence[str], seed: int = SEED, dresses: int = DRESSES, epochs: int = EPOCHS) -> Labeller | None:
    """A labeller learned from the sample; None if nothing in it is main text."""
    rng = np.random.default_rng(seed)
    own = [b for b in map(blocks, pages) if b]
    labels = [rule_labels(page) for page in own]
    prose = [text for page, ys in zip(own, labels) for (_, text, _), y in zip(page, ys) if y == 1]
    short = [text for page, ys in zip(own, labels) for (_, text, _), y in zip(page, ys) if y == 0] or [" ".join(t.split()[:3]) for t in prose]
    if not prose:
        return None
    short = short + [" ".join(one.split()[: 1 + k % 9]) for k, one in enumerate(prose[: len(short)])]
    data = [(page, ys) for page, ys in zip(own, labels)]
    for page, ys in zip(own, labels):
        if 1 in ys:
            data += [dressed(rng, page, ys, prose, short) for _ in range(dresses)]
    data = [(page, ys) for page, ys in data if page]
    model, known = Labeller(seed), {}
    ready = sorted(range(len(data)), key=lambda k: len(data[k][0]))
    groups = [ready[k : k + 48] for k in range(0, len(ready), 48)]
    inputs = [Inputs([data[k][0] for k in g], known) for g in groups]
    for epoch in range(epochs):
        for k in rng.permutation(len(groups)):
            ys = [y for at in groups[k] for y in data[at][1]]
            known_y = np.array([y is not None for y in ys], np.float32)
            model.learn(inputs[k], np.array([y or 0 for y in ys], np.float32), known_y, 0.01 * 0.8**epoch)
    model.moments = None
    return model


def label(model: Labeller | None, pages: Sequence[Sequence[Block]], known: dict) -> list[np.ndarray]:
    """Main text or not, for the blocks of each page."""
    if model is None:
        return [np.array([y == 1 for y in rule_labels(page)], bool) for page in pages]
    order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
    found: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    lo = 0
    while lo < len(order):
        hi = lo + 1
        while hi < len(order) and hi - lo < BATCH_PAGES and len(pages[order[hi]]) * (hi + 1 - lo) <= BATCH_BLOCKS:
            hi += 1
        some = order[lo:hi]
        x = Inputs([pages[k] for k in some], known)
        for k, part in zip(some, np.split(model.scores(x) >= 0.5, np.cumsum(x.lengths)[:-1])):
            found[k] = part
        lo = hi
    return found


# ---------------------------------------------------------------- Spark


def sample(pages: DataFrame, n: int = SAMPLE_PAGES) -> list[str]:
    """At most ``n`` pages, drawn by the hash of their html."""
    usable = pages.select(F.col("html").cast("string").alias("html")).where(f"length(html) BETWEEN 1 AND {SAMPLE_CHARS}")
    total = usable.count()
    draw = F.pmod(F.xxhash64("html"), F.lit(1 << 20))
    share = min(1.0, 2 * n / max(1, total))
    some = usable.where(draw < F.lit(int(share * (1 << 20)) + 1)).select("html", F.xxhash64(F.lit(1), "html").alias("h"))
    return [r.html for r in some.orderBy("h", "html").limit(n).collect()]


def _extractor(model: Labeller | None, at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            texts: list[str] = []
            for lo in range(0, batch.num_rows, BATCH_PAGES):
                pages = [blocks(h or "") for h in batch.column(at)[lo : lo + BATCH_PAGES].to_pylist()]
                texts += ["\n\n".join(text for (_, text, _), yes in zip(page, ys) if yes) for page, ys in zip(pages, label(model, pages, known))]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(batch.num_columns) if k != at], pa.array(texts, pa.string())], [*[batch.schema.names[k] for k in range(batch.num_columns) if k != at], "main_text"])

    return run


def main_text(pages: DataFrame, n: int = SAMPLE_PAGES, model: Labeller | None = None) -> DataFrame:
    """``pages`` without html plus ``main_text``; a column of this name in ``pages`` gives way.

    ``model``: one fitted before; by default one is fitted to a sample of ``n`` pages.
    """
    pages = pages.drop("main_text").withColumn("html", text_of("html"))
    model = model or fit(sample(pages, n))
    others = [c for c in pages.columns if c != "html"]
    schema = pages.select(*[F.col(f"`{c}`") for c in others]).withColumn("main_text", F.lit("")).schema
    laid = pages.select(*[F.col(f"`{c}`") for c in others], "html")
    return laid.mapInArrow(_extractor(model, len(others)), schema)
