"""HTML main-text extraction with a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags. Each block
has a tag path (tags, and the words of class, id and role attributes, of its open
elements) and words. Path and words are hashed into two count vectors; with a few
shape numbers they are the input of a bidirectional LSTM that reads all blocks of
the page in order and labels each as main text or not, so a block is judged in the
context of the whole page. Everything is numpy; pages are processed in Arrow
batches, sorted by length, and no page is ever joined with another.

Training: the weights are fitted on the driver with a bounded sample
(``TRAIN_PAGES`` pages, smallest hash of the page id). Their blocks are labelled by
the containers that HTML itself defines (article or main against nav, header,
footer, aside, form and the like); copies of each page with renamed, moved and
added containers teach layouts that the sample does not hold. The model never sees
a label of a page it was not trained on, and labels all pages alike.

Defined cases: a null, empty or tag-free html gives '' or the text itself as one
block; null and repeated ids pass; very long pages are read whole (the state runs
over all blocks); an empty table gives no rows; other columns pass.
"""

from __future__ import annotations

import html as htmllib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tag sets of HTML.
BLOCK_TAGS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search
section summary table tbody td tfoot th thead title tr ul""".split())
RAW_TAGS = frozenset("script style textarea iframe noembed noframes xmp".split())     # their content is no markup
DROPPED = frozenset("button select template svg".split())                              # form controls, inert markup, drawings
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCK_TAGS - {"html", "head", "body", "title"}
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
               "th": ("td", "th"), "option": ("option",)}
# Containers and attribute words that mark page furniture, used to label training pages.
FURNITURE = frozenset("""nav header footer aside form menu dialog head title ad ads advert advertisement banner sponsor
sponsored promo sidebar side menu navbar navigation breadcrumb breadcrumbs cookie consent notice alert popup modal
newsletter subscribe signup login search share social related recommended comment comments reply replies disqus
copyright legal toolbar pagination widget contentinfo complementary hidden""".split())

PATH_DIM, WORD_DIM, SHAPE_DIM, HIDDEN = 256, 32, 6, 24
TRAIN_PAGES = 160
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


def _end_of_dropped(text: str, at: int, tag: str) -> int:
    """Where an element that is left out ends: after its end tag, but for a control that
    is never closed, or closed only behind the next block, at that block."""
    end = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
    if tag in ("template", "svg"):
        return end.end() if end else at
    stop = end.start() if end else len(text)
    for m in _TOKEN.finditer(text, at, stop):
        name = _NAME.match(m.group())
        if name is not None and name[1].lower() in BLOCK_TAGS:
            return m.start()
    return end.end() if end else stop


def leaf_blocks(html: str | None) -> list[tuple[tuple[str, ...], str]]:
    """``(path, text)`` of each leaf block in page order; blank blocks left out."""
    out: list[tuple[tuple[str, ...], str]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []

    def flush():
        text = _SPACE.sub(" ", htmllib.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            out.append((tuple(w for _, words in stack for w in words), text))

    def pop_to(names):
        """Close up to the innermost open element of ``names``, formatting inside it too."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                del stack[k:]
                return
            if stack[k][0] in BLOCK_TAGS and stack[k][0] not in ("p",) and names == ("p",):
                return

    at, text = 0, html or ""
    while at < len(text):
        m = _TOKEN.search(text, at)
        if m is None:
            parts.append(text[at:])
            break
        parts.append(text[at:m.start()])
        at, token = m.end(), m.group()
        name = _NAME.match(token)
        if name is None:                                       # comment or declaration
            if token.startswith("<![CDATA["):
                parts.append(htmllib.escape(token[9:-3]))
            continue
        tag, closing = name[1].lower(), token[1] == "/"
        if tag in RAW_TAGS:
            if not closing and not (token.endswith("/>") and tag == "iframe"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
                at = end.end() if end else len(text)
            continue
        if tag in DROPPED:
            if not closing and not token.endswith("/>"):
                at = _end_of_dropped(text, at, tag)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
        if closing:
            if any(t == tag for t, _ in stack):
                pop_to((tag,))
            continue
        if tag in CLOSES_P:
            pop_to(("p",))
        if tag in SAME_CLOSES and any(t in SAME_CLOSES[tag] for t, _ in stack[-3:]):
            pop_to(SAME_CLOSES[tag])
        if tag in VOID or token.endswith("/>"):
            continue
        attrs = " ".join(next(filter(None, m.groups()[1:]), "") for m in _ATTR.finditer(token)) if "=" in token else ""
        stack.append((tag, (tag, *_WORDS.findall(attrs.lower()))))
    flush()
    return out


def _cell(word: str, size: int, salt: bytes) -> int:
    return zlib.crc32(salt + word.encode("utf-8", "replace")) % size


@lru_cache(maxsize=200_000)
def _word_cell(word: str) -> int:
    return _cell(word.lower(), WORD_DIM, b"w")


def features(blocks: list[tuple[tuple[str, ...], str]]) -> np.ndarray:
    """One row per block: hashed path counts, hashed word frequencies, shape."""
    x = np.zeros((len(blocks), PATH_DIM + WORD_DIM + SHAPE_DIM), np.float32)
    cells: dict[str, int] = {}
    for k, (path, text) in enumerate(blocks):
        for depth, name in enumerate(path):
            c = cells.get(name)
            if c is None:
                c = cells[name] = _cell(name, PATH_DIM, b"p")
            x[k, c] = 1.0
        words = text.split(" ")
        counts = np.bincount([_word_cell(w) for w in words], minlength=WORD_DIM)
        x[k, PATH_DIM:PATH_DIM + WORD_DIM] = counts / len(words)
        n = len(text)
        x[k, PATH_DIM + WORD_DIM:] = (np.log1p(len(words)) / 5, np.log1p(n) / 8, text.count(".") / len(words),
                                      len(path) / 10, text[-1] in ".!?:\"'", 1.0)
    return x


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _lstm(x, w, keep=False):
    """States of an LSTM over ``x`` [steps, rows, dim] with weights [dim + hidden + 1, 4 * hidden]."""
    steps, rows, dim = x.shape
    hid = w.shape[1] // 4
    h, c = np.zeros((rows, hid), np.float32), np.zeros((rows, hid), np.float32)
    out = np.empty((steps, rows, hid), np.float32)
    pre = x.reshape(-1, dim) @ w[:dim] + w[-1]
    pre = pre.reshape(steps, rows, 4 * hid)
    trace = []
    for t in range(steps):
        z = pre[t] + h @ w[dim:-1]
        i, f, o = _sigmoid(z[:, :hid]), _sigmoid(z[:, hid:2 * hid] + 1), _sigmoid(z[:, 2 * hid:3 * hid])
        g = np.tanh(z[:, 3 * hid:])
        before, c = c, f * c + i * g
        tc = np.tanh(c)
        if keep:
            trace.append((i, f, o, g, before, tc, h))
        h = o * tc
        out[t] = h
    return out, trace


def _lstm_grad(x, w, trace, d_out):
    steps, rows, dim = x.shape
    hid = w.shape[1] // 4
    grad = np.zeros_like(w)
    dh, dc = np.zeros((rows, hid), np.float32), np.zeros((rows, hid), np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, tc, h = trace[t]
        dh = dh + d_out[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        grad[:dim] += x[t].T @ dz
        grad[dim:-1] += h.T @ dz
        grad[-1] += dz.sum(0)
        dh, dc = dz @ w[dim:-1].T, dc * f
    return grad


def _padded(pages: list[np.ndarray]):
    """Steps-first array, reversed copy and mask of several pages."""
    steps, dim = max(len(p) for p in pages), PATH_DIM + WORD_DIM + SHAPE_DIM
    x = np.zeros((steps, len(pages), dim), np.float32)
    r = np.zeros_like(x)
    mask = np.zeros((steps, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[:len(p), k], r[:len(p), k], mask[:len(p), k] = p, p[::-1], 1
    return x, r, mask


def _unreverse(y, mask):
    out = np.zeros_like(y)
    for k, n in enumerate(mask.sum(0).astype(int)):
        out[:n, k] = y[:n, k][::-1]
    return out


def label_pages(model: dict, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Probability of being main text for every block of every page (non-empty pages)."""
    x, r, mask = _padded(pages)
    a, _ = _lstm(x, model["fwd"])
    b, _ = _lstm(r, model["bwd"])
    y = _sigmoid(np.concatenate([a, _unreverse(b, mask)], 2) @ model["out"][:-1] + model["out"][-1])
    return [y[:len(p), k] for k, p in enumerate(pages)]


def container_labels(blocks: list[tuple[tuple[str, ...], str]]) -> list[int]:
    """1 inside article or main and outside furniture, else 0; without such a
    container, 1 for paragraphs and headings outside furniture."""
    holds = any(p in ("article", "main") for path, _ in blocks for p in path)
    return [int(not FURNITURE.intersection(path)
                and (("article" in path or "main" in path) if holds else bool({"p", "h1", "h2", "h3", "pre", "blockquote"} & set(path))))
            for path, _ in blocks]


def augmented(blocks, labels, rng: random.Random):
    """A variant of a labelled page: containers renamed, furniture added around and inside the main text."""
    pool = sorted(FURNITURE - {"head", "title"})

    def wrappers(most):
        """Elements that say nothing, with made-up class words."""
        return tuple(w for _ in range(rng.randrange(most + 1)) for w in (
            rng.choice(["div", "div", "section", "span"]), rng.choice(["page", "wrap", "container", "row", "col", "outer", "inner", "layout",
                                                                       "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9)))])))

    page = ("html", "body", *wrappers(2))
    main_path = (*page, *rng.choice([("article",), ("article",), ("main",), ("div", "content"), ("main", "article"), ("div", "post", "body"),
                                     ("div", "content", "article"), ("div", "main", "article", "entry", "content")]), *wrappers(1))
    texts = [t for _, t in blocks]
    words = " ".join(texts).split(" ")

    def some_text():
        n = rng.choice([1, 2, 4, 8, 16, 30])
        at = rng.randrange(max(1, len(words) - n))
        return " ".join(words[at:at + n])

    def furniture(inside=()):
        tag = rng.choice(["div", "aside", "section", "nav", "header", "footer", "form"])
        mark = (tag,) if tag in FURNITURE and rng.random() < 0.5 else (tag, rng.choice(pool))
        if not FURNITURE.intersection(mark):
            mark = (*mark, rng.choice(pool))
        leaf = rng.choice([(), ("p",), ("ul", "li"), ("ul", "li", "a"), ("h2",), ("h3",), ("label",)])
        base = inside or (page if rng.random() < 0.7 else ("html", "body"))
        return [((*base, *mark, *leaf), some_text()) for _ in range(rng.choice([1, 1, 2, 4]))]

    out, lab = [], []

    def add(items, value):
        out.extend(items)
        lab.extend([value] * len(items))

    for _ in range(rng.randrange(4)):
        add(furniture(), 0)
    for (path, text), y in zip(blocks, labels):
        if y:
            leaf = rng.choice(["h2", "h3", "li", "blockquote", "pre", "td", "figcaption"]) if rng.random() < 0.08 else path[-1]
            leaf = leaf if leaf in BLOCK_TAGS and leaf not in ("article", "main") else "p"
            extra = (("section",) if rng.random() < 0.1 else ()) + (("ul",) if leaf == "li" else ())
            add([((*main_path, *extra, leaf), text if rng.random() < 0.9 else some_text())], 1)
            if rng.random() < 0.2:
                add(furniture(main_path), 0)
        else:
            add([(path, text)], 0)
    for _ in range(rng.randrange(4)):
        add(furniture(), 0)
    return out, lab


def train(samples: list[str], epochs: int = 14, copies: int = 4, seed: int = 11, rate: float = 0.02) -> dict:
    """Fit the labeller on labelled pages and their variants (Adam, fixed seed)."""
    rng, gen = random.Random(seed), np.random.default_rng(seed)
    data = []
    for page in samples:
        blocks = leaf_blocks(page)
        if not blocks:
            continue
        labels = container_labels(blocks)
        data.append((features(blocks), np.array(labels, np.float32)))
        for _ in range(copies):
            b, y = augmented(blocks, labels, rng)
            data.append((features(b), np.array(y, np.float32)))
    dim = PATH_DIM + WORD_DIM + SHAPE_DIM
    model = {"fwd": gen.normal(0, 0.15, (dim + HIDDEN + 1, 4 * HIDDEN)).astype(np.float32),
             "bwd": gen.normal(0, 0.15, (dim + HIDDEN + 1, 4 * HIDDEN)).astype(np.float32),
             "out": gen.normal(0, 0.15, 2 * HIDDEN + 1).astype(np.float32)}
    if not data:
        return model
    data.sort(key=lambda d: len(d[1]))
    batches = [data[k:k + 24] for k in range(0, len(data), 24)]
    m = {k: np.zeros_like(v) for k, v in model.items()}
    v = {k: np.zeros_like(x) for k, x in model.items()}
    step = 0
    for epoch in range(epochs):
        order = gen.permutation(len(batches))
        for b in order:
            xs, ys = zip(*batches[b])
            x, r, mask = _padded(list(xs))
            target = np.zeros_like(mask)
            for k, y in enumerate(ys):
                target[:len(y), k] = y
            a, ta = _lstm(x, model["fwd"], True)
            c, tc = _lstm(r, model["bwd"], True)
            states = np.concatenate([a, _unreverse(c, mask)], 2)
            p = _sigmoid(states @ model["out"][:-1] + model["out"][-1])
            d = ((p - target) * mask / mask.sum()).astype(np.float32)
            ds = d[:, :, None] * model["out"][:-1]
            grads = {"fwd": _lstm_grad(x, model["fwd"], ta, ds[:, :, :HIDDEN]),
                     "bwd": _lstm_grad(r, model["bwd"], tc, _unreverse(ds[:, :, HIDDEN:], mask)),
                     "out": np.concatenate([np.einsum("tr,trh->h", d, states), [d.sum()]])}
            step += 1
            lr = rate * (1 - 0.8 * epoch / epochs)
            for k in model:
                g = np.clip(grads[k], -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.98 * v[k] + 0.02 * g * g
                model[k] = (model[k] - lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.98 ** step)) + 1e-8)).astype(np.float32)
    return model


def extract(model: dict, pages: list[str | None], rows: int = 64) -> list[str]:
    """Main text of each page: its blocks labelled main, joined by an empty line."""
    parsed = [leaf_blocks(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((k for k, b in enumerate(parsed) if b), key=lambda k: len(parsed[k]))
    at = 0
    while at < len(order):
        take, budget = 1, 40_000                     # blocks padded at once: bounds memory for long pages
        while take < rows and at + take < len(order) and (take + 1) * len(parsed[order[at + take]]) <= budget:
            take += 1
        group = order[at:at + take]
        for k, p in zip(group, label_pages(model, [features(parsed[k]) for k in group])):
            out[k] = "\n\n".join(text for (_, text), y in zip(parsed[k], p) if y >= 0.5)
        at += take
    return out


def training_pages(pages: DataFrame, html: str = "html", page_id: str = "page_id", limit: int = TRAIN_PAGES) -> list[str]:
    """The bounded training sample: ``limit`` pages with the smallest id hashes."""
    h = F.xxhash64(F.col(page_id))
    there = pages.where(F.col(html).isNotNull())
    last = there.select(h.alias("h")).orderBy("h").limit(limit).agg(F.max("h")).first()[0]     # hashes only
    if last is None:
        return []
    return [r[2] for r in there.where(h <= last).select(h.alias("h"), page_id, html).orderBy("h", page_id, html).limit(limit).collect()]


def main_text(html: Column, model: dict) -> Column:
    def run(batch: pd.Series) -> pd.Series:
        values = [x if isinstance(x, str) else None for x in batch]
        out: list[str] = []
        for k in range(0, len(values), 512):
            out.extend(extract(model, values[k:k + 512]))
        return pd.Series(out, dtype="object")

    return F.pandas_udf(run, "string")(html)


def extract_pages(pages: DataFrame, html: str = "html", page_id: str = "page_id", model: dict | None = None) -> DataFrame:
    """``pages`` without the html, plus ``text`` and ``n_chars``."""
    model = model or train(training_pages(pages, html, page_id))
    keep = [F.col(f"`{c}`") for c in pages.columns if c not in (html, "text", "n_chars")]
    return (pages.select(*keep, main_text(F.col(html), model).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
