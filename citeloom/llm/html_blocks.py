"""Main-text extraction from HTML with a recurrent block labeller.

A page is cut into leaf blocks: the text between two block-level tags. Each block is described by its
tag path (element names and the words of class and id attributes of all open elements, hashed), its
words (hashed) and a few measures. A bidirectional LSTM in numpy reads the whole sequence of blocks,
so each decision sees the document on both sides, and labels every block as main text or not.

The labeller is trained here, on generated pages (``training_pages``) whose labels are known; the
number of pages, the seed and the rounds are parameters. It is trained once, on the driver; the
executors get its weights.

Defined cases: null or empty html gives the empty text; pages without tags are one block; comments,
scripts, styles and the head are no blocks; unclosed and stray tags are tolerated; white space inside
a block becomes one space; ``<br>`` is white space; very long or hostile pages are read whole, in time
in proportion to their length and memory in proportion to their blocks; repeated rows and null ids are worked like other
rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import bound_batches
from citeloom.llm.shingles import word_hashes

PATH_SIZE, WORD_SIZE, MEASURES = 256, 32, 8
#: Words count less than paths: few words mark main text by themselves.
WORD_SCALE = 0.3
HIDDEN = 16
TRAIN_PAGES, ROUNDS, SEED = 1600, 14, 7

_OPENS = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: The rest of a tag, up to the first ">" outside quotes.
_REST = re.compile(r"""((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_ATTRIBUTE = re.compile(r"""(?:^|[\s/])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_NAME = re.compile(r"[a-z]+")
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img input br".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a head may hold; any other ends it.
_IN_HEAD = frozenset("head title meta link base style script noscript template html".split())
_RAW = ("script", "style", "noscript", "template", "iframe", "svg")
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_ITEMS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}


class Path(NamedTuple):
    """Tag path of a block: hashed words as bits, their number, and the innermost two."""

    bits: int = 0
    length: int = 0
    last: tuple[str, ...] = ()

    def inside(self, words: tuple[str, ...]) -> Path:
        bits = self.bits
        for w in words:
            bits |= 1 << zlib.crc32(w.encode()) % PATH_SIZE
        return Path(bits, self.length + len(words), (self.last + words)[-2:])


class _Open:
    """The open elements; every step costs the same, however deep they are nested."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, Path]] = []
        self.places: dict[str, list[int]] = {}

    def last(self, name: str) -> int:
        places = self.places.get(name)
        return places[-1] if places else -1

    @property
    def path(self) -> Path:
        return self.stack[-1][1] if self.stack else Path()

    def push(self, name: str, words: tuple[str, ...]) -> None:
        path = self.path if name in _INLINE else self.path.inside(("<" + name, *words))
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, path))

    def pop(self, name: str, within: tuple[str, ...] = ()) -> None:
        """Close the innermost element of a name and all inside it, unless a limiting element is between."""
        at = self.last(name)
        if at >= 0 and all(self.last(w) < at for w in within):
            while len(self.stack) > at:
                self.places[self.stack.pop()[0]].pop()


def _tags(page: str) -> Iterator[tuple[str, str, str, int, int]]:
    """(text before, name or "", attributes, start, end) of each tag, comment or declaration, read once
    from left to right; the generator is sent the place to go on from.

    A tag ends at the first ">" outside quotes, or, where a quote is left open, at the first one.
    Without a further ">" the rest is text, up to an unclosed comment.
    """
    at = text = 0
    while True:
        at = page.find("<", at)
        close = page.find(">", at) if at >= 0 else -1
        if close < 0:
            end = page.find("<!--", max(at, 0)) if at >= 0 else -1
            yield page[text : end if end >= 0 else len(page)], "", "", len(page), len(page)
            return
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            name, rest, end = "", "", end + 3 if end >= 0 else len(page)
        elif page[at + 1 : at + 2] in ("!", "?"):
            name, rest, end = "", "", close + 1
        else:
            found = _OPENS.match(page, at)
            if found is None:
                at += 1
                continue
            name = found.group(1) + found.group(2).lower()
            whole = _REST.match(page, found.end())
            rest, end = (whole.group(1), whole.end()) if whole else (page[found.end() : close], close + 1)
        on = yield page[text:at], name, rest, at, end
        at = text = on if on is not None else end


def leaf_blocks(page: str) -> list[tuple[Path, str, float]]:
    """(tag path, text, share of its characters inside links) of each block with text, in page order."""
    opened = _Open()
    blocks: list[tuple[Path, str, float]] = []
    parts: list[str] = []
    path = Path()
    linked = 0

    def flush() -> None:
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            blocks.append((path, text, min(1.0, linked / len(text))))
        parts, linked = [], 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and opened.last("head") < 0 and opened.last("title") < 0:
            parts.append(html.unescape(raw))
            if opened.last("a") >= 0:
                linked += len(parts[-1])

    tags, on = _tags(page), None
    while True:
        try:
            before, name, rest, _, end = tags.send(on)
        except StopIteration:
            break
        on = None
        add(before)
        if not name:
            continue
        closing, name = name[0] == "/", name.lstrip("/")
        if not closing and opened.last("head") >= 0 and name not in _IN_HEAD:
            opened.pop("title")
            opened.pop("head")
        if not closing and name in _RAW:
            if not (name == "svg" and rest.rstrip().endswith("/")):
                # A raw element ends with its own closing tag; without one, with the page.
                final = re.compile(f"</{name}", re.I).search(page, end)
                close = page.find(">", final.end()) if final else -1
                on = close + 1 if close >= 0 else len(page)
            continue
        if name == "br":
            add(" ")
            continue
        block = name not in _INLINE
        if block:
            flush()
        if closing:
            opened.pop(name)
        else:
            if name in _CLOSES_P:
                opened.pop("p", ("td", "th", "li", "button", "body"))
            if name in _ITEMS:
                opened.pop(name, _ITEMS[name])
            if name not in _VOID:
                attributes = _ATTRIBUTE.findall(rest)
                opened.push(name, tuple(dict.fromkeys(w for a in attributes for w in _NAME.findall(a.lower()))))
        if block:
            path = opened.path
    flush()
    return blocks


# --- features ------------------------------------------------------------------------------------


def path_vector(path: Path) -> np.ndarray:
    bits = np.frombuffer(path.bits.to_bytes(PATH_SIZE // 8, "little"), np.uint8)
    out = np.unpackbits(bits, bitorder="little").astype(np.float32)
    for word in path.last:  # the innermost names once more, apart from those around them
        out[zlib.crc32(b"last " + word.encode()) % PATH_SIZE] += 0.5
    return out


def features(pages: list[list[tuple[Path, str, float]]]) -> np.ndarray:
    """One row for each block of all pages."""
    blocks = [b for p in pages for b in p]
    paths = {path: None for path, _, _ in blocks}
    vectors = np.stack([path_vector(p) for p in paths]) if paths else np.zeros((0, PATH_SIZE), np.float32)
    number = {p: i for i, p in enumerate(paths)}
    out = np.zeros((len(blocks), PATH_SIZE + WORD_SIZE + MEASURES), np.float32)
    if not blocks:
        return out
    out[:, :PATH_SIZE] = vectors[[number[p] for p, _, _ in blocks]]
    data = [t.encode() for _, t, _ in blocks]
    hashes, first = word_hashes(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]))
    counts = np.diff(first)
    cells = np.repeat(np.arange(len(blocks)), counts) * WORD_SIZE + (hashes % np.uint64(WORD_SIZE)).astype(np.int64)
    words = np.bincount(cells, minlength=len(blocks) * WORD_SIZE).reshape(-1, WORD_SIZE)
    out[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] = WORD_SCALE * words / np.maximum(1, np.sqrt((words**2).sum(1)))[:, None]
    place = np.concatenate([(np.arange(len(p)) + 0.5) / len(p) for p in pages if p])
    marks = np.array([sum(t.count(c) for c in ".!?;,") for _, t, _ in blocks])
    sizes = np.array([len(t) for _, t, _ in blocks])
    rows = [
        np.log1p(counts) / 5, np.array([x for _, _, x in blocks]), np.minimum(1, 5 * marks / np.maximum(1, sizes)), place, 1 - place,
        np.minimum(1, np.array([p.length for p, _, _ in blocks]) / 10), (counts < 6).astype(float), (counts > 20).astype(float),
    ]
    out[:, PATH_SIZE + WORD_SIZE :] = np.stack(rows, 1)
    return out


# --- the network ---------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM with one logistic output for each block."""

    def __init__(self, seed: int = SEED, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        size, self.hidden = PATH_SIZE + WORD_SIZE + MEASURES, hidden
        self.w: dict[str, np.ndarray] = {}
        for d in "fb":
            self.w[f"x{d}"] = (rng.standard_normal((size, 4 * hidden)) / 6).astype(np.float32)
            self.w[f"h{d}"] = (rng.standard_normal((hidden, 4 * hidden)) / np.sqrt(hidden)).astype(np.float32)
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1  # gates: input, forget, output, cell
            self.w[f"c{d}"] = bias
        self.w["o"] = (rng.standard_normal(2 * hidden) / np.sqrt(2 * hidden)).astype(np.float32)
        self.w["p"] = np.zeros(1, np.float32)

    def _direction(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """Hidden states (time, pages, hidden); padded steps keep the state."""
        n = self.hidden
        z_in = x @ self.w[f"x{d}"] + self.w[f"c{d}"]
        h = np.zeros((x.shape[1], n), np.float32)
        c = np.zeros_like(h)
        out = np.zeros((*x.shape[:2], n), np.float32)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            z = z_in[t] + h @ self.w[f"h{d}"]
            gates, cell, m = _sigmoid(z[:, : 3 * n]), np.tanh(z[:, 3 * n :]), mask[t][:, None]
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            c_new = f * c + i * cell
            squashed = np.tanh(c_new)
            if keep is not None:
                keep.append((t, i, f, o, cell, c, h, squashed, m))
            h, c = m * (o * squashed) + (1 - m) * h, m * c_new + (1 - m) * c
            out[t] = h
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        states = np.concatenate([self._direction(d, x, mask, None) for d in "fb"], 2)
        return _sigmoid(states @ self.w["o"] + self.w["p"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        n, kept = self.hidden, {"f": [], "b": []}
        states = np.concatenate([self._direction(d, x, mask, kept[d]) for d in "fb"], 2)
        p = _sigmoid(states @ self.w["o"] + self.w["p"])
        total = mask.sum()
        loss = float(-(mask * (label * np.log(p + 1e-7) + (1 - label) * np.log(1 - p + 1e-7))).sum() / total)
        dp = (mask * (p - label) / total).astype(np.float32)
        g = {"o": np.einsum("tb,tbh->h", dp, states), "p": np.array([dp.sum()], np.float32)}
        for k, d in enumerate("fb"):
            from_out = dp[:, :, None] * self.w["o"][k * n : (k + 1) * n]
            dz_all = np.zeros((*x.shape[:2], 4 * n), np.float32)
            dh, dc = np.zeros((x.shape[1], n), np.float32), np.zeros((x.shape[1], n), np.float32)
            gh = np.zeros_like(self.w[f"h{d}"])
            for t, i, f, o, cell, c_before, h_before, squashed, m in reversed(kept[d]):
                dh = dh + from_out[t]
                live_h, live_c = dh * m, dc * m + dh * m * o * (1 - squashed**2)
                dz = np.concatenate([live_c * cell * i * (1 - i), live_c * c_before * f * (1 - f), live_h * squashed * o * (1 - o), live_c * i * (1 - cell**2)], 1)
                dz_all[t] = dz
                gh += h_before.T @ dz
                dh, dc = dh * (1 - m) + dz @ self.w[f"h{d}"].T, dc * (1 - m) + live_c * f
            flat = dz_all.reshape(-1, 4 * n)
            g[f"x{d}"], g[f"h{d}"], g[f"c{d}"] = x.reshape(-1, x.shape[2]).T @ flat, gh, flat.sum(0)
        return g, loss

    def predict(self, pages: list[list[tuple[Path, str, float]]], group: int = 128) -> list[np.ndarray]:
        """Scores of every page's blocks; pages of like length are worked together."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and end - at < group and len(pages[order[end]]) * (end - at) < 8192:
                end += 1
            part = order[at:end]
            x, mask = padded([pages[i] for i in part])
            found = self.scores(x, mask)
            for k, i in enumerate(part):
                out[i] = found[: len(pages[i]), k]
            at = end
        return out


def padded(pages: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """Features (time, pages, size) and mask (time, pages)."""
    longest, flat, at = max(len(p) for p in pages), features(pages), 0
    x = np.zeros((longest, len(pages), flat.shape[1]), np.float32)
    mask = np.zeros((longest, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = flat[at : at + len(p)], 1
        at += len(p)
    return x, mask


def train(pages: int = TRAIN_PAGES, rounds: int = ROUNDS, seed: int = SEED, batch: int = 50) -> Labeller:
    """Fit a labeller on generated pages with Adam."""
    made = training_pages(pages, seed)
    cut = [(leaf_blocks(p), want) for p, want in made]
    cut = sorted(([b for b in blocks], [float(MARKER in t) for _, t, _ in blocks]) for blocks, _ in cut)
    cut.sort(key=lambda x: len(x[0]))
    net = Labeller(seed)
    groups = []
    for at in range(0, len(cut), batch):
        part = cut[at : at + batch]
        clean = [[(p, t.replace(MARKER, "").strip() or "-", s) for p, t, s in blocks] for blocks, _ in part]
        x, mask = padded(clean)
        label = np.zeros_like(mask)
        for k, (_, labels) in enumerate(part):
            label[: len(labels), k] = labels
        groups.append((x, mask, label))
    rng, m, v, step = np.random.default_rng(seed), {}, {}, 0
    for _ in range(rounds):
        for at in rng.permutation(len(groups)):
            g, _ = net.gradients(*groups[at])
            step += 1
            for k, grad in g.items():
                grad = np.clip(grad, -1, 1)
                m[k] = 0.9 * m.get(k, 0) + 0.1 * grad
                v[k] = 0.999 * v.get(k, 0) + 0.001 * grad**2
                net.w[k] = (net.w[k] - 0.02 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


# --- generated pages -----------------------------------------------------------------------------

#: Marks the blocks of main text in generated pages; taken out before features are made.
MARKER = "\x00"

# Names by which pages mark the parts that are no main text, and what these parts say.
_PARTS = {
    "menu": (("nav", "div", "ul", "header"), "nav menu navbar navigation breadcrumb breadcrumbs topbar toolbar", "Home About Contact News Products Services Login Search Archive Blog Help Shop"),
    "header": (("header", "div"), "header masthead banner site branding logo top", "Welcome to our site;The daily news;Skip to content;Sign in"),
    "ad": (("div", "aside", "section", "ins"), "ad ads advert advertisement adsbox sponsored sponsor promo banner", "Advertisement;Buy now and save;Sponsored content;Get the best offer today"),
    "notice": (("div", "section", "aside", "p"), "notice cookie cookies consent alert message newsletter subscribe popup modal", "We use cookies to improve this site;Accept all;Subscribe to our newsletter;This page has moved"),
    "side": (("aside", "div", "section"), "sidebar aside widget related recent popular trending share social tags", "Related articles;Most read;Share this;Recent posts;Follow us;Tags"),
    "comments": (("div", "section", "ol", "ul"), "comment comments reply replies discussion responses thread disqus", "Great post, thanks;I do not agree with this at all;Reply;Leave a comment;Posted by a reader"),
    "form": (("form", "div"), "form search login signup contact", "Your name;Your email;Send;Submit;Password;Search"),
    "footer": (("footer", "div"), "footer bottom copyright legal colophon credits", "Copyright;All rights reserved;Privacy policy;Terms of use;Contact us;Imprint"),
}
_BODY = (("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article body"), ("div", "entry content"), ("section", "story"), ("div", "post text"), ("div", "main"), ("section", ""), ("article", "entry"))
_SYLLABLES = "the an er on re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve la que ción ung sch lich aux ment é è ü ñ".split() + [a + b for a in "bcdfglmnprstvw" for b in "aeiou"]


def training_pages(count: int, seed: int) -> list[tuple[str, list[str]]]:
    """Pages of random structure with the texts of their main blocks, which bear ``MARKER``."""
    rng = random.Random(seed)

    def words(least: int, most: int) -> str:
        out = ["".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(least, most))]
        if rng.random() < 0.08:
            out = rng.choices(out[: rng.randint(1, 3)], k=len(out))
        out[0] = out[0].capitalize()
        if rng.random() < 0.15:
            out = [w + rng.choice(("", "***", "%%%", "$$$", "###", "!!", " |")) for w in out]
        if rng.random() < 0.06:
            out = [w.upper() for w in out]
        return " ".join(out) + rng.choice((".", ".", "", ","))

    def attribute(names: str) -> str:
        chosen = [rng.choice(names.split())] if names else []
        if chosen and rng.random() < 0.15:
            chosen[0] = rng.choice(("left", "right", "top", "main", "site", "my")) + chosen[0]
        if rng.random() < 0.3:
            chosen.append("".join(rng.choices(_SYLLABLES[:20], k=2)))
        if not chosen or rng.random() < 0.1:
            return ""
        joined = rng.choice((" ", "-")).join(chosen)
        return f' {rng.choice(("class", "class", "id"))}="{joined}"'

    def part(kind: str) -> str:
        tags, names, said = _PARTS[kind]
        tag = rng.choice(tags)
        own = attribute(names) if tag in ("div", "section", "ol", "ul", "p", "ins") or rng.random() < 0.5 else ""
        if not own and tag in ("div", "section", "ol", "ul", "p"):
            own = f' class="{rng.choice(names.split())}"'
        phrases = said.split(";") if ";" in said else said.split()
        phrase = lambda: rng.choice(phrases) if rng.random() < 0.4 else words(1, 14 if kind != "menu" else 2)
        if tag in ("ul", "ol"):
            inner = "".join(f'<li><a href="/{i}">{phrase()}</a></li>' if kind == "menu" else f"<li>{phrase()}</li>" for i in range(rng.randint(2, 7)))
        elif kind == "menu":
            links = [f'<a href="/{i}">{phrase()}</a>' for i in range(rng.randint(3, 8))]
            inner = "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>" if rng.random() < 0.8 else " ".join(links)
        elif kind == "form":
            inner = "".join(rng.choice((f"<label>{phrase()}</label><input>", f"<button>{phrase()}</button>", f"<p>{phrase()}</p>", f"<select><option>{phrase()}</option></select>")) for _ in range(rng.randint(1, 4)))
        elif kind == "comments":
            inner = "".join(f"<div{attribute('comment reply')}><p>{words(3, 60)}</p></div>" if rng.random() < 0.7 else f"<p>{phrase()}</p>" for _ in range(rng.randint(1, 6)))
        elif tag == "p":
            inner = phrase()
        else:
            wrap = rng.choice(("", "p", "div", "h3", "ul", "span"))
            texts = [phrase() if rng.random() < 0.7 else f'<a href="/x">{phrase()}</a>' for _ in range(rng.randint(1, 4))]
            if kind == "footer":
                texts[0] = rng.choice(("&copy; ", "")) + texts[0] + rng.choice((" &middot; ", "")) + words(2, 10)
            inner = " ".join(texts) if not wrap else "<ul>" + "".join(f"<li>{t}</li>" for t in texts) + "</ul>" if wrap == "ul" else "".join(f"<{wrap}>{t}</{wrap}>" for t in texts)
        return f"<{tag}{own}>{inner}</{tag}>"

    def main_block() -> str:
        kind = rng.random()
        mark = MARKER + " "
        if kind < 0.62:
            text = words(1, 6) if rng.random() < 0.3 else words(1, 120)
            if rng.random() < 0.04:
                text = rng.choice(rng.choice(list(_PARTS.values()))[2].split(";"))
            if rng.random() < 0.2:
                text = f"<b>{text}<br>"
            elif rng.random() < 0.15:
                text += f' <a href="/y">{words(1, 3)}</a> {words(1, 20)}'
            return f"<p>{mark}{text}" + ("</p>" if rng.random() < 0.8 else "")
        if kind < 0.74:
            level = rng.choice("1223")
            return f"<h{level}>{mark}{words(1, 10)}</h{level}>"
        if kind < 0.82:
            return "<ul>" + "".join(f"<li>{mark}{words(2, 25)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if kind < 0.88:
            return f"<blockquote><p>{mark}{words(5, 50)}</p></blockquote>"
        if kind < 0.92:
            return f"<pre>{mark}{words(3, 30)}</pre>"
        if kind < 0.96:
            return "<table>" + "".join(f"<tr><td>{mark}{words(1, 4)}</td><td>{mark}{words(1, 4)}</td></tr>" for _ in range(rng.randint(1, 3))) + "</table>"
        return f"<figure><figcaption>{mark}{words(3, 15)}</figcaption></figure>"

    def cell(kind: str) -> str:
        """A part as a cell of a table that lays out the page."""
        said = _PARTS[kind][2]
        texts = [rng.choice(said.split(";") if ";" in said else said.split()) if rng.random() < 0.5 else words(1, 4) for _ in range(rng.randint(1, 7))]
        joined = rng.choice((" ", " | ", "<br>", "</p><p>")).join(f'<a href="/{i}">{t}</a>' if kind in ("menu", "side") or rng.random() < 0.3 else t for i, t in enumerate(texts))
        return f"<td{attribute(_PARTS[kind][1])}>{joined}</td>"

    def table_page(inner: str) -> str:
        """A page laid out by a table, with the main text in one cell."""
        names = rng.choice(_BODY)[1]
        cells = [cell(k) for k in ("menu", "side", "ad") if rng.random() < 0.5]
        ahead = cells[: rng.randint(0, len(cells))]
        row = "".join(ahead) + f"<td{attribute(names) if names else ''}>{inner}</td>" + "".join(cells[len(ahead) :])
        head = f"<tr>{cell(rng.choice(('header', 'menu')))}</tr>" if rng.random() < 0.5 else ""
        foot = f"<tr>{cell('footer')}</tr>" if rng.random() < 0.4 else part("footer") if rng.random() < 0.7 else f"<p{attribute(_PARTS['footer'][1])}>Copyright {words(1, 8)}</p>"
        outside = foot if foot.startswith("<tr>") else ""
        return f"<table>{head}<tr>{row}</tr>{outside}</table>" + ("" if outside else foot)

    def page() -> str:
        tag, names = rng.choice(_BODY)
        own = f' class="{names}"' if names else ""
        inner = [f"<h1>{MARKER} {words(2, 14)}</h1>"] * (rng.random() < 0.85) + [main_block() for _ in range(rng.randint(1, 16) if rng.random() < 0.8 else rng.randint(16, 60))]
        for kind in ("ad", "side", "notice", "menu", "form"):
            if rng.random() < 0.12:
                inner.insert(rng.randint(0, len(inner)), part(kind))
        if rng.random() < 0.12:
            return f"<html><head><title>x</title></head><body>{table_page(''.join(inner))}</body></html>"
        text = f"<{tag}{own}>{''.join(inner)}</{tag}>"
        before = [part(k) for k in ("header", "menu", "notice", "ad", "side") if rng.random() < (0.75 if k == "menu" else 0.4)]
        after = [part(k) for k in ("side", "comments", "ad", "form", "notice", "menu", "footer") if rng.random() < (0.8 if k == "footer" else 0.35)]
        rng.shuffle(before)
        if rng.random() < 0.2:
            text = f"<main>{text}</main>" if tag != "main" else text
        body = "".join(before) + text + "".join(after)
        if rng.random() < 0.3:
            body = f'<div{attribute("wrapper page container site")}>{body}</div>'
        return f"<!DOCTYPE html><html><head><title>x</title><script>var t='</p>';</script></head><body>{body}</body></html>"

    pages = [page() for _ in range(count)]
    return [(p, [t.replace(MARKER, "").strip() for _, t, _ in leaf_blocks(p) if MARKER in t]) for p in pages]


# --- extraction ----------------------------------------------------------------------------------

_TRAINED: dict[tuple, Labeller] = {}


def default_labeller() -> Labeller:
    """The labeller of the default parameters, trained once a process."""
    key = (TRAIN_PAGES, ROUNDS, SEED)
    if key not in _TRAINED:
        _TRAINED[key] = train(*key)
    return _TRAINED[key]


def main_texts(pages: list[str], net: Labeller) -> list[str]:
    cut = [leaf_blocks(p) for p in pages]
    return ["\n\n".join(t for (_, t, _), s in zip(blocks, scores, strict=True) if s >= 0.5) for blocks, scores in zip(cut, net.predict(cut), strict=True)]


def _extract(shared, html_col: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        net = shared.value
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                texts = main_texts([p or "" for p in part[html_col]], net)
                yield part.drop(columns=[html_col]).assign(text=texts)

    return run


def extract(df: DataFrame, net: Labeller | None = None, html_col: str = "html", id_cols: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per input row: the id columns, ``text`` and ``n_chars`` (its code points)."""
    bound_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(net or default_labeller())  # weights of fixed size
    ids = df.select(*id_cols).schema
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ids)
    rows = df.select(*id_cols, html_col)
    out = rows.mapInPandas(_extract(shared, html_col), f"{kinds}, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
