"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its blocks, the runs of text between block-level tags. A
bidirectional LSTM in numpy reads a hashed vector of each block's tag path and one of its words
and labels every block from the whole page. The model is trained here, on pages that a generator
lays out in many ways and so can label.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

PATH_BITS, WORD_BITS, NUMBERS, HIDDEN = 9, 6, 5, 24
INPUTS = (1 << PATH_BITS) + (1 << WORD_BITS) + NUMBERS
#: Generated pages and passes over them: the bound of training.
TRAIN_PAGES, EPOCHS, SEED = 1200, 5, 11

# Element names of the HTML standard.
BLOCK_TAGS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("script style noscript template title textarea svg math iframe object canvas audio video head".split())
HEAD_TAGS = frozenset("html head base basefont bgsound link meta title noscript noframes script style template".split())
RAW_TAGS = frozenset("script style title textarea noscript iframe template".split())
CLOSES_P = BLOCK_TAGS - {"button", "label", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body", "head"}
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTES = re.compile(r"""\b(class|id|role|hidden|aria-label|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_UNQUOTED_END = re.compile(r"""=\s*[^\s"'>]+$""")
_TOKENS = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")


def _names(attributes: str) -> tuple[str, ...]:
    found = []
    for m in _ATTRIBUTES.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() in ("hidden", "aria-hidden"):
            found += ["hidden"] * (value.lower() != "false")
        else:
            found += _TOKENS.findall(value.lower())
    return tuple(found)


def blocks_of(page: str) -> list[tuple[tuple, str, int]]:
    """Blocks in page order: the path of open elements (tag and names), the text, and its characters in links.

    References are decoded and white space is one space. Comments, scripts, styles and other
    elements that show no text leave nothing; an unclosed tag at the end is markup. A head ends at
    the first element or text that cannot be in one.
    """
    out: list[tuple[tuple, str, int]] = []
    path: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            whole = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if whole:
                out.append((tuple(path), whole, min(linked, len(whole))))
            text.clear()
        linked = 0

    def add(part: str) -> None:
        nonlocal linked
        if path and path[-1][0] == "head" and part.strip(" \t\n\f\r"):
            path.pop()
        if part and not any(p[0] in HIDDEN_TAGS for p in path):
            text.append(part)
            if any(p[0] == "a" for p in path):
                linked += len(part)

    at, end = 0, len(page)
    while m := _MARKUP.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag in BLOCK_TAGS:
                flush()
            for k in range(len(path) - 1, -1, -1):
                if path[k][0] == tag:
                    del path[k:]
                    break
            continue
        if path and path[-1][0] == "head" and tag not in HEAD_TAGS:
            path.pop()
        if tag in BLOCK_TAGS:
            flush()
            if tag in CLOSES_P:
                for k in range(len(path) - 1, -1, -1):
                    if path[k][0] == "p":
                        del path[k:]
                        break
            if tag in SAME_CLOSES and path and path[-1][0] in SAME_CLOSES[tag]:
                path.pop()
            if tag == "body":
                path[:] = [p for p in path if p[0] != "head"]
        if tag == "br":
            add(" ")
        if tag in VOID_TAGS or m[3].endswith("/") and (tag in ("path", "circle", "rect") or tag in ("svg", "math") and not _UNQUOTED_END.search(m[3])):
            continue
        if tag in RAW_TAGS:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        path.append((tag, _names(m[3]) if m[3] else ()))
    add(page[at:])
    flush()
    return out


@cache
def _bucket(token: str, bits: int) -> int:
    return zlib.crc32(token.encode("utf-8", "replace")) * 0x9E3779B1 % (1 << 32) >> (32 - bits)


_words: dict[str, int] = {}
_paths: dict[tuple, np.ndarray] = {}


def _path_at(path: tuple) -> np.ndarray:
    if (known := _paths.get(path)) is None:
        tokens = {f"<{tag}" for tag, _ in path} | {n for _, names in path for n in names}
        if path:
            inner = [tag for tag, _ in path if tag in BLOCK_TAGS]
            tokens.add(f"in {inner[-1] if inner else ''}")
        if len(_paths) > 50_000:
            _paths.clear()
        known = _paths[path] = np.array(sorted({_bucket(t, PATH_BITS) for t in tokens}), np.int64)
    return known


def vectors(blocks: list[tuple[tuple, str, int]]) -> np.ndarray:
    """A row for each block: tag path, words, and numbers of length, links, ends of sentences and place."""
    x = np.zeros((len(blocks), INPUTS), np.float32)
    first = 1 << PATH_BITS
    for k, (path, text, linked) in enumerate(blocks):
        x[k, _path_at(path)] = 1
        words = text.lower().split(" ")
        at = []
        for w in words:
            if (b := _words.get(w)) is None:
                if len(_words) > 200_000:
                    _words.clear()
                b = _words[w] = zlib.crc32(w.encode("utf-8", "replace")) & ((1 << WORD_BITS) - 1)
            at.append(b)
        counts = np.bincount(at, minlength=1 << WORD_BITS)
        x[k, first : first + (1 << WORD_BITS)] = counts / np.sqrt((counts * counts).sum())
        x[k, -NUMBERS:] = (np.log1p(len(words)) / 5, linked / len(text), min(1.0, sum(map(text.count, ".!?")) / 5), k / len(blocks), 1 / (1 + k))
    return x


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * z) + 1)


class Labeller:
    """A bidirectional LSTM over the blocks of a page, and a logistic unit for each block."""

    def __init__(self, rng: np.random.Generator):
        scale = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.w = {}
        for d in "fb":
            self.w[f"x{d}"], self.w[f"h{d}"] = scale(INPUTS, 4 * HIDDEN), scale(HIDDEN, 4 * HIDDEN)
            self.w[f"c{d}"] = np.zeros(4 * HIDDEN, np.float32)
            self.w[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1
        self.w["o"], self.w["p"] = scale(2 * HIDDEN, 1), np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states over time (T, pages, HIDDEN); where the mask is 0 the state does not move."""
        T, n, _ = x.shape
        given = x @ self.w[f"x{d}"] + self.w[f"c{d}"]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.empty((T, n, HIDDEN), np.float32)
        for t in range(T) if d == "f" else range(T - 1, -1, -1):
            z = given[t] + h @ self.w[f"h{d}"]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o, g = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c2 = f * c + i * g
            s = np.tanh(c2)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, s, m))
            h, c = np.where(m, o * s, h), np.where(m, c2, c)
            out[t] = h
        return out

    def scores(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Per page the logit of each block; pages of like length go together."""
        out: list[np.ndarray] = [np.empty(0, np.float32)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            longest = len(pages[order[-1]])
            some, order = order[-max(1, min(256, 40_000 // longest)) :], order[: -max(1, min(256, 40_000 // longest))]
            x, mask = _padded([pages[k] for k in some])
            both = np.concatenate([self._run(x, mask, d, None) for d in "fb"], axis=2)
            logits = (both @ self.w["o"])[:, :, 0] + self.w["p"]
            for j, k in enumerate(some):
                out[k] = logits[: len(pages[k]), j]
        return out

    def step(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the blocks of a batch, and its gradients through time."""
        x, mask = _padded(pages)
        y = np.zeros(mask.shape, np.float32)
        for j, own in enumerate(labels):
            y[: len(own), j] = own
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self._run(x, mask, d, kept[d]) for d in "fb"], axis=2)
        p = _sigmoid((both @ self.w["o"])[:, :, 0] + self.w["p"])
        total = mask.sum()
        loss = -float((mask * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / total)
        dz = (mask * (p - y) / total).astype(np.float32)
        grad = {"o": np.einsum("tnh,tn->h", both, dz)[:, None], "p": np.array([dz.sum()], np.float32)}
        d_both = dz[:, :, None] * self.w["o"][:, 0]
        for d, part in (("f", d_both[:, :, :HIDDEN]), ("b", d_both[:, :, HIDDEN:])):
            d_given = np.zeros((*mask.shape, 4 * HIDDEN), np.float32)
            wh, gh = self.w[f"h{d}"], np.zeros_like(self.w[f"h{d}"])
            dh, dc = np.zeros((mask.shape[1], HIDDEN), np.float32), np.zeros((mask.shape[1], HIDDEN), np.float32)
            for t, h0, c0, i, f, o, g, s, m in reversed(kept[d]):
                dh = dh + part[t]
                own = np.where(m, dh, 0)
                dc2 = np.where(m, dc, 0) + own * o * (1 - s * s)
                z = np.concatenate([dc2 * g * i * (1 - i), dc2 * c0 * f * (1 - f), own * s * o * (1 - o), dc2 * i * (1 - g * g)], axis=1)
                d_given[t] = z
                gh += h0.T @ z
                dh = np.where(m, 0, dh) + z @ wh.T
                dc = np.where(m, dc2 * f, dc)
            grad[f"h{d}"], grad[f"c{d}"] = gh, d_given.sum(axis=(0, 1))
            grad[f"x{d}"] = x.reshape(-1, INPUTS).T @ d_given.reshape(-1, 4 * HIDDEN)
        return loss, grad


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x, mask = np.zeros((longest, len(pages), INPUTS), np.float32), np.zeros((longest, len(pages)), bool)
    for j, own in enumerate(pages):
        x[: len(own), j], mask[: len(own), j] = own, True
    return x, mask


# Names that page authors commonly give to parts of a page, and words that such parts hold.
MAIN_NAMES = "article articlebody body content main post entry story text page copy hentry single prose".split()
OTHER_NAMES = {
    "nav": "nav navbar navigation menu topnav breadcrumb breadcrumbs pagination tabs skip".split(),
    "header": "header masthead banner top topbar site logo branding".split(),
    "footer": "footer foot bottom copyright colophon legal".split(),
    "aside": "sidebar side widget aside related recommended trending popular rail promo".split(),
    "notice": "cookie cookies consent gdpr notice alert modal popup overlay subscribe paywall newsletter".split(),
    "ad": "ad ads advert advertisement sponsored sponsor banner promo adsense".split(),
    "form": "form search login signup contact subscribe".split(),
    "comments": "comments comment reply replies discussion disqus respond thread".split(),
    "share": "share social tools toolbar print meta byline tags".split(),
}
OTHER_WORDS = {
    "nav": "home about contact products news menu next previous skip".split(),
    "header": "welcome home sign in search menu".split(),
    "footer": "© · copyright all rights reserved privacy terms imprint 2024".split(),
    "aside": "related popular trending more read also see latest".split(),
    "notice": "we use cookies accept consent privacy subscribe newsletter sign up".split(),
    "ad": "advertisement sponsored buy now offer sale ad".split(),
    "form": "name email password submit search subscribe send".split(),
    "comments": "reply says wrote comment report like ago".split(),
    "share": "share tweet email print save by tags".split(),
}
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve que ción für sch ä é".split()


def generated_page(rng: np.random.Generator) -> tuple[str, list[str]]:
    """A page laid out at random, and the text of its main blocks in order."""
    pick = lambda x: x[int(rng.integers(len(x)))]
    chance = lambda p: rng.random() < p
    word = lambda: "".join(pick(SYLLABLES) for _ in range(int(rng.integers(1, 5))))
    # Some pages shout or trail marks after every word; that tells nothing of a block's part.
    marks = pick([[""]] * 5 + [["!!"], ["***", "###", "%%%", "$$$", "&amp;&amp;"], ["", "!", "?"], ["", ",", ".", ":"], [" |"], [" 7", "", " 19.", " @x"]])
    loud = chance(0.12)

    def words(low: int, high: int, extra: list[str] = ()) -> str:
        own = [(word().upper() if loud else word()) + pick(marks) for _ in range(int(rng.integers(low, high)))]
        if extra and chance(0.6):
            own[: int(rng.integers(1, 4))] = [pick(extra) for _ in range(int(rng.integers(1, 4)))]
        return " ".join(own) + pick([".", ".", "", "!", "?"])

    def attrs(names: list[str], likely: float = 0.8) -> str:
        if not chance(likely):
            return f' class="{word()}"' if chance(0.3) else ""
        name = pick(names) + (pick(["-", "_", " "]) + pick(["wrap", "box", "inner", "area", "list", "1", "block"]) if chance(0.4) else "")
        return f' {pick(["class", "class", "id"])}="{name}"'

    def inline(text: str) -> str:
        if chance(0.2):
            parts = text.split(" ")
            k = int(rng.integers(len(parts)))
            tag = pick(["b", "i", "em", "strong", "a", "span"])
            parts[k] = f'<{tag}{" href=#" if tag == "a" else ""}>{parts[k]}</{tag}>'
            text = " ".join(parts)
        return text

    def other(kind: str) -> str:
        names, extra = OTHER_NAMES[kind], OTHER_WORDS[kind]
        tag = {"nav": pick(["nav", "nav", "div", "ul"]), "header": pick(["header", "header", "div"]), "footer": pick(["footer", "footer", "div"]), "aside": pick(["aside", "aside", "div", "section"]), "form": pick(["form", "form", "div"]), "comments": pick(["section", "div", "ul", "ol"])}.get(kind, pick(["div", "div", "section", "aside", "p"]))
        named = attrs(names, 1.0 if tag in ("div", "section", "ul", "ol", "p") else 0.4)
        long = kind in ("comments", "ad", "notice", "aside", "footer")
        items = [words(1, 28 if long and chance(0.6) else 5, extra) for _ in range(int(rng.integers(1, 8)))]
        if kind in ("nav", "aside") and chance(0.7) and tag != "ul":
            inner = "<ul>" + "".join(f'<li><a href="/{word()}">{x}</a></li>' for x in items) + "</ul>"
        elif tag in ("ul", "ol"):
            inner = "".join(f"<li>{inline(x)}</li>" for x in items)
        elif kind == "form":
            inner = "".join(f"<label>{x}</label><input name=q>" for x in items[:3]) + f"<button>{words(1, 3, extra)}</button>"
        elif chance(0.5):
            inner = inline(items[0])
        else:
            inner = "".join(f"<{t}>{inline(x)}</{t}>" for x in items for t in [pick(["p", "div", "span", "h3", "p"])])
        return f"<{tag}{named}>{inner}</{tag}>"

    main: list[str] = []

    def keep(text: str) -> str:
        main.append(text)
        return text

    def article() -> str:
        parts = [f"<h1>{inline(keep(words(2, 12)))}</h1>"] if chance(0.85) else []
        for _ in range(int(rng.integers(1, 16))):
            kind = rng.random()
            if kind < 0.72:
                text = words(1, pick([3, 12, 60, 120]))
                for _ in range(int(rng.integers(2, 6)) if chance(0.06) else 1):  # passages repeat
                    parts.append(f"<p>{inline(keep(text))}" + ("</p>" if chance(0.9) else ""))
            elif kind < 0.80:
                parts.append("".join(f"<h2>{keep(words(1, 8))}</h2>" for _ in "a"))
            elif kind < 0.88:
                parts.append("<ul>" + "".join(f"<li>{keep(words(1, 14))}</li>" for _ in range(int(rng.integers(1, 5)))) + "</ul>")
            elif kind < 0.93:
                parts.append(f"<blockquote><p>{keep(words(3, 40))}</p></blockquote>")
            else:
                parts.append("<table>" + "".join(f"<tr><td>{keep(words(1, 4))}</td><td>{keep(words(1, 4))}</td></tr>" for _ in range(2)) + "</table>")
            if chance(0.06):
                parts.append(other(pick(["ad", "share", "aside", "form", "notice", "comments"])))
        if chance(0.15):
            parts.append(other(pick(["comments", "share"])))
        tag = pick(["article", "article", "article", "article", "main", "div", "section"])
        named = attrs(MAIN_NAMES, 1.0) if tag in ("div", "section") else attrs(MAIN_NAMES, 0.2)
        return f"<{tag}{named}>" + "".join(parts) + f"</{tag}>"

    before = [other(pick(["nav", "header", "notice", "ad", "form", "nav", "ad"])) for _ in range(int(rng.integers(0, 4)))]
    after = [other(pick(["footer", "aside", "comments", "notice", "ad", "form", "footer", "nav"])) for _ in range(int(rng.integers(0, 5)))]
    middle = article()
    if chance(0.3):
        middle = f"<div{attrs(['wrapper', 'container', 'page', 'layout', 'row', 'site'], 1.0)}>" + (other("aside") if chance(0.3) else "") + middle + (other("aside") if chance(0.4) else "") + "</div>"
    page = "<!DOCTYPE html><html><head><title>t</title></head><body>" + "".join(before) + middle + "".join(after) + "</body></html>"
    return page[: int(len(page) * (0.5 + rng.random() / 2))] if chance(0.08) else page, main


@cache
def trained(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """The labeller, trained on generated pages; the same at every call."""
    rng = np.random.default_rng(seed)
    data = []
    for _ in range(pages):
        page, main = generated_page(rng)
        blocks = blocks_of(page)
        if blocks:
            data.append((vectors(blocks), _labels(blocks, main)))
    model, seen, moved, t = Labeller(rng), {}, {}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        for a in range(0, len(data), 16):
            batch = [data[k] for k in order[a : a + 16]]
            _, grad = model.step([_blurred(x, rng) for x, _ in batch], [y for _, y in batch])
            size, t = np.sqrt(sum(float((g * g).sum()) for g in grad.values())), t + 1
            rate = 0.01 * (1 - 0.8 * epoch / max(1, epochs - 1))
            for k, g in grad.items():
                g = g * min(1.0, 1 / (size + 1e-9))
                moved[k] = 0.9 * moved.get(k, 0) + 0.1 * g
                seen[k] = 0.99 * seen.get(k, 0) + 0.01 * g * g
                model.w[k] -= (rate * moved[k] / (1 - 0.9**t) / (np.sqrt(seen[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
    return model


def _blurred(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Without the words of half the blocks, and with shaken numbers, so that paths come to matter most."""
    x = x.copy()
    x[rng.random(len(x)) < 0.5, 1 << PATH_BITS : -NUMBERS] = 0
    x[:, -NUMBERS:] *= rng.uniform(0.7, 1.3, (len(x), NUMBERS)).astype(np.float32)
    return x


def _labels(blocks: list[tuple[tuple, str, int]], main: list[str]) -> np.ndarray:
    """1 for the blocks of ``main``, matched in order; text that the page's end cut counts, too."""
    out, at = np.zeros(len(blocks), np.float32), 0
    for k, (_, text, _) in enumerate(blocks):
        for j in range(at, min(at + 2, len(main))):
            want = _SPACE.sub(" ", html.unescape(main[j])).strip()
            if text == want or k == len(blocks) - 1 and text and want.startswith(text):
                out[k], at = 1, j + 1
                break
    return out


def extract(pages: list[str], model: Labeller) -> list[str]:
    """Per page its main blocks, joined by newlines; empty if there are none."""
    out: list[str] = []
    held: list[list] = []
    size = 0
    for k, page in enumerate(pages):
        held.append(blocks_of(page))
        size += len(held[-1])
        if size >= 8_000 or k == len(pages) - 1:
            for blocks, scores in zip(held, model.scores([vectors(b) for b in held]), strict=True):
                out.append("\n".join(text for (_, text, _), s in zip(blocks, scores, strict=True) if s > 0))
            held, size = [], 0
    return out


def main_text(pages: DataFrame, html: str = "html", model: Labeller | None = None) -> DataFrame:
    """``pages`` with text and n_chars added: the main blocks of the whole page, and their code points.

    A null or empty page, or one without main blocks, has an empty text. ``<br>`` is white space.
    Repeated rows are read one by one; columns called text or n_chars are replaced.
    """
    shared = pages.sparkSession.sparkContext.broadcast((model or trained()).w)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Labeller(np.random.default_rng(0))
        own.w = shared.value
        for batch in batches:
            yield pd.Series(extract([x if isinstance(x, str) else "" for x in batch], own), dtype=object)

    keep = [c for c in pages.columns if c not in ("text", "n_chars")]
    return pages.select(*keep, F.pandas_udf(run, "string")(F.col(html)).alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
