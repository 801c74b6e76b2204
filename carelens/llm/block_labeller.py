"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks. Each is a vector: hashed names on its tag path, hashed words of its text, and a few
measures. A bidirectional LSTM in numpy reads the whole sequence, so every block is classified in the light of all others; the main
text is the blocks labelled main. The model is trained here, on pages made up by :func:`made_page`; its weights are in
``block_labeller.npz``, written by ``python -m carelens.llm.block_labeller``.
"""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path
from random import Random
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import Remembered, map_texts, per_worker, quoted, text_of
from carelens.llm.hashing import BY_SPACE, joined, words
from carelens.llm.html_blocks import Block, blocks

PATH_BUCKETS, WORD_BUCKETS = 1 << 11, 1 << 9
PATH_SIZE, WORD_SIZE, MEASURES, HIDDEN = 24, 8, 5, 24
WEIGHTS = Path(__file__).with_name("block_labeller.npz")


def path_buckets(path: tuple[tuple[str, ...], ...]) -> list[int]:
    """Buckets of the names on a path; tags and class words apart, and the innermost element once more."""
    names = {("<" if i == 0 else ".") + name for element in path for i, name in enumerate(element)}
    if path:
        names |= {f"leaf {name}" for name in path[-1]}
    return sorted({crc32(n.encode("utf-8", "replace")) % PATH_BUCKETS for n in names})


def measures(page: list[Block]) -> np.ndarray:
    """Length, share of link text, whether it ends like a sentence, place on the page, path depth."""
    n = len(page)
    out = np.empty((n, MEASURES), np.float32)
    for i, b in enumerate(page):
        size = len(b.text)
        out[i] = (min(size, 2000) ** 0.5 / 20, min(1.0, b.linked / size), b.text[-1] in ".!?\"”…。", i / n, min(len(b.path), 12) / 12)
    return out


def word_means(texts: list[str], table: np.ndarray) -> np.ndarray:
    """Mean word vector of each text, over all its words."""
    data, begins = joined([t.encode("utf-8", "replace") for t in texts])
    at, hashes = words(data, BY_SPACE)
    text = np.searchsorted(begins, at, side="right") - 1
    bucket = (hashes >> np.uint64(55)).astype(np.int64)
    counts = np.maximum(np.bincount(text, minlength=len(texts)), 1)
    return np.stack([np.bincount(text, column[bucket], len(texts)) for column in table.T], axis=1).astype(np.float32) / counts[:, None].astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lstm(inputs: np.ndarray, mask: np.ndarray, wx: np.ndarray, wh: np.ndarray, b: np.ndarray, keep: bool = False):
    """Hidden states (steps, pages, HIDDEN) of one direction; where ``mask`` is 0 the state stays. Gates: in, forget, out, new."""
    steps, pages, _ = inputs.shape
    fed = inputs @ wx + b
    h = c = np.zeros((pages, HIDDEN), np.float32)
    out = np.empty((steps, pages, HIDDEN), np.float32)
    trace = []
    for t in range(steps):
        gates = fed[t] + h @ wh
        ifo = _sigmoid(gates[:, : 3 * HIDDEN])
        g = np.tanh(gates[:, 3 * HIDDEN :])
        i, f, o = ifo[:, :HIDDEN], ifo[:, HIDDEN : 2 * HIDDEN], ifo[:, 2 * HIDDEN :]
        new_c = f * c + i * g
        tanh_c = np.tanh(new_c)
        m = mask[t][:, None]
        if keep:
            trace.append((h, c, i, f, o, g, tanh_c, m))
        h = m * (o * tanh_c) + (1 - m) * h
        c = m * new_c + (1 - m) * c
        out[t] = h
    return (out, trace) if keep else out


def lstm_back(slope: np.ndarray, trace: list, inputs: np.ndarray, wx: np.ndarray, wh: np.ndarray):
    """Gradients of inputs, wx, wh and b for ``slope``, the gradient of the hidden states."""
    steps, pages, _ = inputs.shape
    d_h = d_c = np.zeros((pages, HIDDEN), np.float32)
    d_gates = np.empty((steps, pages, 4 * HIDDEN), np.float32)
    d_wh = np.zeros_like(wh)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, tanh_c, m = trace[t]
        d_h = d_h + slope[t]
        own_h, own_c = m * d_h, m * d_c
        through = own_c + own_h * o * (1 - tanh_c**2)
        gates = np.concatenate(
            (through * g * i * (1 - i), through * c * f * (1 - f), own_h * tanh_c * o * (1 - o), through * i * (1 - g**2)), axis=1
        )
        d_gates[t] = gates
        d_wh += h.T @ gates
        d_h = (1 - m) * d_h + gates @ wh.T
        d_c = (1 - m) * d_c + through * f
    flat = d_gates.reshape(-1, 4 * HIDDEN)
    return d_gates @ wx.T, inputs.reshape(-1, inputs.shape[2]).T @ flat, d_wh, flat.sum(0)


class Labeller:
    """The trained network."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        self.path = Remembered(self._path, 20_000)

    def _path(self, path: tuple) -> np.ndarray:
        return self.w["path"][path_buckets(path)].sum(0)

    def inputs(self, pages: list[list[Block]]) -> np.ndarray:
        """One vector per block, all pages' blocks in order."""
        flat = [b for p in pages for b in p]
        paths = np.stack([self.path[b.path] for b in flat])
        return np.concatenate((paths, word_means([b.text for b in flat], self.w["word"]), np.concatenate([measures(p) for p in pages if p])), axis=1)

    def scores(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Probability of main text, for each block of each page."""
        out: list[np.ndarray] = [np.empty(0, np.float32)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        while order:
            longest = len(pages[order[-1]])
            take = max(1, min(len(order), 256, 200_000 // longest))  # pages of like length go together
            some, order = order[-take:], order[:-take]
            vectors = self.inputs([pages[i] for i in some])
            lengths = [len(pages[i]) for i in some]
            padded = np.zeros((longest, len(some), vectors.shape[1]), np.float32)
            mask = np.zeros((longest, len(some)), np.float32)
            begin = 0
            for k, n in enumerate(lengths):
                padded[:n, k], mask[:n, k] = vectors[begin : begin + n], 1
                begin += n
            w = self.w
            ahead = lstm(padded, mask, w["wx0"], w["wh0"], w["b0"])
            back = lstm(padded[::-1], mask[::-1], w["wx1"], w["wh1"], w["b1"])[::-1]
            p = _sigmoid(ahead @ w["out0"] + back @ w["out1"] + w["bias"])
            for k, (i, n) in enumerate(zip(some, lengths)):
                out[i] = p[:n, k]
        return out


@lru_cache(maxsize=1)
def trained() -> dict[str, np.ndarray]:
    with np.load(WEIGHTS) as stored:
        return {k: stored[k].astype(np.float32) for k in stored.files}


def main_text(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: page_id, url, text (blocks of main text joined by a line feed; empty if none), n_chars (code points).

    Character references are decoded and white space within a block becomes one space; all of the page is read, and no block
    labelled main is left out. Null html is an empty page; ids and addresses may be null or repeat.
    """
    weights = trained()
    shared = df.sparkSession.sparkContext.broadcast(weights)  # fixed size
    name = f"labeller {sum(float(np.abs(v).sum()) for v in weights.values())!r}"

    def run(pages):
        labeller = per_worker(name, lambda: Labeller(shared.value))
        out = []
        for begin in range(0, len(pages), 512):
            cut = [blocks(p) for p in pages[begin : begin + 512]]
            out += ["\n".join(b.text for b, p in zip(page, score) if p >= 0.5) for page, score in zip(cut, labeller.scores(cut))]
        return {"text": out}

    rows = df.select(quoted(page_id).alias("page_id"), quoted(url).alias("url"), text_of(html).alias("html"))
    return map_texts(rows, run, "text string", ("page_id", "url"), "html", holds=True).withColumn("n_chars", F.length("text").cast("long"))


# Training


_SYLLABLES = "an ar be da de en er es ga he in ka la le li lo ma mi na ne no on or pa ra re ri ro sa se so ta te ti to un va ver vi".split()
#: Tags and class words of page parts; `None` stands for an element without class.
_MAIN_WRAPS = ("article", "article", "article", "main", "div content", "div post body", "section entry", "div article text", "div story", "article post", "div main content")
_NOISE = {
    "menu": ("nav", "nav menu", "div nav", "div navbar", "ul menu", "div breadcrumbs", "nav breadcrumb", "div menu main", "div pagination", "div tabs"),
    "top": ("header", "header site", "div header", "div masthead", "div topbar", "header top", "div branding"),
    "bottom": ("footer", "footer site", "div footer", "div copyright", "section footer", "div legal", "div site info"),
    "side": ("aside", "aside sidebar", "div sidebar", "div related", "section recommended", "div widget", "div rail", "aside more", "div trending", "div author bio", "div tags"),
    "notice": ("div cookie notice", "div notice", "div banner", "p alert", "div consent", "section gdpr", "div popup modal", "div warning", "div message", "div paywall", "div announcement", "noscript"),
    "advert": ("div ad", "div ads", "div advert", "div advertisement", "section sponsored", "aside promo", "div banner ad", "ins adsbygoogle", "div promotion", "p ad", "div ad slot"),
    "form": ("form", "form search", "form newsletter", "div subscribe", "form login", "div signup", "form contact"),
    "comments": ("section comments", "div comments", "ol commentlist", "div comment thread", "section discussion", "div disqus", "div replies", "ul comments list", "div reader comments", "div responses"),
    "share": ("div share", "ul social", "div social links", "div toolbar", "div share buttons"),
}


def _open(rng: Random, spec: str) -> tuple[str, str]:
    tag, *names = spec.split()
    if not names:
        return f"<{tag}>", f"</{tag}>"
    value = rng.choice(("-", "_", " ")).join(names)
    if rng.random() < 0.3:
        value += rng.choice(("-1", " block", " wrapper", "-box", " wide", "-container", " clearfix"))
    kind, quote = rng.choice(("class", "class", "class", "id")), rng.choice(('"', '"', "'"))
    return f"<{tag} {kind}={quote}{value}{quote}>", f"</{tag}>"


def _words(rng: Random, n: int) -> list[str]:
    return ["".join(rng.choice(_SYLLABLES) for _ in range(rng.choice((1, 1, 2, 2, 3, 4)))) for _ in range(n)]


def _sentences(rng: Random, n: int) -> str:
    out = []
    for _ in range(n):
        w = _words(rng, rng.choice((1, 3, 6, 9, 12, 18, 25)))
        out.append(" ".join([w[0].capitalize(), *w[1:]]) + rng.choice((".", ".", ".", "!", "?")))
    text = " ".join(out)
    if rng.random() < 0.12:
        text = " ".join(x + rng.choice(("&amp;&amp;&amp;", "***", "$$$", "###", "%%%")) for x in text.split())
    elif rng.random() < 0.08:
        text = " | ".join(text.split())
    elif rng.random() < 0.06:
        text = " ".join(x.upper() + "!!" for x in text.split())
    elif rng.random() < 0.1:
        text = text.replace(" ", " &copy; ", 1) if rng.random() < 0.3 else text.replace(" ", ' <a href="/x">' + _words(rng, 1)[0] + "</a> ", 1)
    return text


def _noise(rng: Random, kind: str) -> str:
    begin, end = _open(rng, rng.choice(_NOISE[kind]))
    link = lambda: f'<a href="/{_words(rng, 1)[0]}">{" ".join(_words(rng, rng.choice((1, 1, 2, 3, 8)))).capitalize()}</a>'
    prose = lambda: _sentences(rng, rng.choice((1, 1, 2, 3)))
    wrap = lambda inner: rng.choice(("<p>{}</p>", "<p>{}</p>", "<div>{}</div>", "{}", "<span>{}</span><br>")).format(inner)
    listed = lambda n: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(n)) + "</ul>" if rng.random() < 0.7 else " ".join(link() for _ in range(n))
    if kind in ("menu", "share"):
        body = listed(rng.randint(2, 9))
    elif kind == "top":
        body = rng.choice(("<h1>{}</h1>", "<h2>{}</h2>", "<p>{}</p>", "<div class=\"logo\">{}</div>")).format(" ".join(_words(rng, 3))) + (listed(4) if rng.random() < 0.5 else "") + (wrap(prose()) if rng.random() < 0.4 else "")
    elif kind == "bottom":
        body = (wrap("&copy; " + " ".join(_words(rng, 2)) + " &middot; " + prose()) if rng.random() < 0.7 else wrap(prose())) + (listed(4) if rng.random() < 0.5 else "")
    elif kind == "side":
        body = rng.choice(("<h3>{}</h3>", "<h2>{}</h2>", "<h4>{}</h4>", "")).format(" ".join(_words(rng, 2))) + (listed(rng.randint(2, 6)) if rng.random() < 0.6 else "".join(wrap(prose()) for _ in range(rng.randint(1, 3))))
    elif kind == "form":
        body = "".join(rng.choice(("<label>{}</label><input name=q>", "<p>{}</p>", "<button>{}</button>", "<select><option>{}</option><option>x</option></select>", "<h3>{}</h3>", "<textarea>{}</textarea>")).format(" ".join(_words(rng, rng.randint(1, 8)))) for _ in range(rng.randint(1, 4)))
    elif kind == "comments":
        inside = rng.choice(("<div class=\"comment\">{}</div>", "<li>{}</li>", "<article class=\"comment\">{}</article>", "<blockquote>{}</blockquote>", "{}", "<div>{}</div>"))
        body = rng.choice(("<h2>{}</h2>", "<h3>{}</h3>", "")).format(" ".join(_words(rng, 2))) + "".join(inside.format(f"<p>{_sentences(rng, rng.randint(1, 4))}</p>" + (f"<span>{_words(rng, 1)[0]}</span>" if rng.random() < 0.3 else "")) for _ in range(rng.randint(1, 6)))
    else:
        body = "".join(wrap(prose()) for _ in range(rng.choice((1, 1, 2)))) + (f"<button>{_words(rng, 1)[0]}</button>" if rng.random() < 0.2 else "")
    return begin + body + end


def made_page(rng: Random) -> tuple[str, list[bool]]:
    """A page, and for each of its blocks whether it is main text. Main blocks carry a mark that is taken off again."""
    mark = "⁣"

    def main_block() -> str:
        kind = rng.random()
        text = mark + _sentences(rng, rng.choice((1, 1, 2, 4, 8)))
        if kind < 0.72:
            return rng.choice((f"<p>{text}</p>", f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br><p>{mark}{_sentences(rng, 2)}</p>", f'<p class="{rng.choice(("lead", "text", "intro", "first"))}">{text}</p>', f"<div>{text}</div>"))
        if kind < 0.82:
            return f"<h{rng.choice('2234')}>{mark}{' '.join(_words(rng, rng.randint(1, 8)))}</h2>"
        if kind < 0.9:
            tag = rng.choice(("ul", "ol"))
            return f"<{tag}>" + "".join(f"<li>{mark}{_sentences(rng, 1) if rng.random() < 0.6 else ' '.join(_words(rng, 3))}</li>" for _ in range(rng.randint(1, 5))) + f"</{tag}>"
        if kind < 0.94:
            return f"<blockquote>{rng.choice(('<p>{}</p>', '{}')).format(text)}</blockquote>"
        if kind < 0.97:
            return "<table>" + "".join(f"<tr><td>{mark}{' '.join(_words(rng, 2))}</td><td>{mark}{rng.randint(1, 999)}</td></tr>" for _ in range(rng.randint(1, 4))) + "</table>"
        return rng.choice((f"<pre>{text}</pre>", f"<figure><img src=x><figcaption>{text}</figcaption></figure>", f"<section><h3>{mark}{_words(rng, 1)[0]}</h3><p>{text}</p></section>"))

    begin, end = _open(rng, rng.choice(_MAIN_WRAPS))
    body = [f"<h1>{mark}{' '.join(_words(rng, rng.randint(1, 10)))}</h1>"] if rng.random() < 0.8 else []
    body += [main_block() for _ in range(rng.choice((0, 1, 2, 4, 8, 16, 30)) if body else rng.choice((1, 3, 8, 20)))]
    for kind in ("advert", "notice", "side", "share", "form", "comments"):
        if rng.random() < 0.12:
            body.insert(len(body) if kind == "comments" else rng.randint(0, len(body)), _noise(rng, kind))
    before = [_noise(rng, k) for k in ("menu", "top", "notice", "advert", "side", "form", "menu") if rng.random() < 0.4]
    after = [_noise(rng, k) for k in ("side", "advert", "form", "comments", "share", "menu", "notice") if rng.random() < 0.33]
    rng.shuffle(before)
    rng.shuffle(after)
    if rng.random() < 0.8:
        after.append(_noise(rng, "bottom"))
    outer = _open(rng, rng.choice(("div page", "div wrapper", "div container", "div site", "main"))) if rng.random() < 0.4 else ("", "")
    page = outer[0] + "".join(before) + begin + "".join(body) + end + "".join(after) + outer[1]
    html = f"<!DOCTYPE html><html><head><title>{_words(rng, 1)[0]}</title><style>p{{}}</style></head><body>{page}</body></html>"
    return html, [mark in b.text for b in blocks(html)]


def train(pages: int = 6000, rounds: int = 5, batch: int = 32, seed: int = 42) -> dict[str, np.ndarray]:
    """Fit the network on made-up pages by Adam; a minute or two on one core."""
    rng, np_rng = Random(seed), np.random.default_rng(seed)
    inputs = PATH_SIZE + WORD_SIZE + MEASURES
    normal = lambda *shape, scale: (np_rng.standard_normal(shape) * scale).astype(np.float32)
    w = {"path": normal(PATH_BUCKETS, PATH_SIZE, scale=0.3), "word": normal(WORD_BUCKETS, WORD_SIZE, scale=0.1)}
    for d in "01":
        w |= {f"wx{d}": normal(inputs, 4 * HIDDEN, scale=inputs**-0.5), f"wh{d}": normal(HIDDEN, 4 * HIDDEN, scale=HIDDEN**-0.5)}
        w |= {f"b{d}": np.zeros(4 * HIDDEN, np.float32), f"out{d}": normal(HIDDEN, scale=HIDDEN**-0.5)}
        w[f"b{d}"][HIDDEN : 2 * HIDDEN] = 1
    w["bias"] = np.zeros(1, np.float32)
    data = []
    for _ in range(pages):
        html, label = made_page(rng)
        page = [b._replace(text=b.text.replace("⁣", "").strip() or "x") for b in blocks(html)]
        if page:
            data.append((page, np.array(label, np.float32)))
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for turn in range(rounds):
        rng.shuffle(data)
        data.sort(key=lambda d: len(d[0]) + rng.random() * 8)
        groups = [data[i : i + batch] for i in range(0, len(data), batch)]
        rng.shuffle(groups)
        for group in groups:
            slopes = _slopes(w, group)
            step += 1
            rate = 0.004 * (1 - step / (rounds * len(groups) + 1))
            for k, slope in slopes.items():
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return w


def _slopes(w: dict[str, np.ndarray], group: list[tuple[list[Block], np.ndarray]]) -> dict[str, np.ndarray]:
    """Gradients of the mean log loss of a batch of pages."""
    longest, n = max(len(p) for p, _ in group), len(group)
    paths = np.zeros((longest, n, PATH_BUCKETS), np.float32)
    bags = np.zeros((longest, n, WORD_BUCKETS), np.float32)
    more = np.zeros((longest, n, MEASURES), np.float32)
    mask, target = np.zeros((longest, n), np.float32), np.zeros((longest, n), np.float32)
    for k, (page, label) in enumerate(group):
        mask[: len(page), k], target[: len(page), k] = 1, label
        more[: len(page), k] = measures(page)
        for t, b in enumerate(page):
            paths[t, k, path_buckets(b.path)] = 1
            data, _ = joined([b.text.encode()])
            bucket = (words(data, BY_SPACE)[1] >> np.uint64(55)).astype(np.int64)
            bags[t, k] = np.bincount(bucket, minlength=WORD_BUCKETS) / max(1, len(bucket))
    x = np.concatenate((paths @ w["path"], bags @ w["word"], more), axis=2)
    ahead, trace0 = lstm(x, mask, w["wx0"], w["wh0"], w["b0"], keep=True)
    back, trace1 = lstm(x[::-1], mask[::-1], w["wx1"], w["wh1"], w["b1"], keep=True)
    error = (_sigmoid(ahead @ w["out0"] + back[::-1] @ w["out1"] + w["bias"]) - target) * mask / mask.sum()
    out = {"out0": np.einsum("tnh,tn->h", ahead, error), "out1": np.einsum("tnh,tn->h", back[::-1], error), "bias": error.sum(keepdims=True).reshape(1)}
    d_x, out["wx0"], out["wh0"], out["b0"] = lstm_back(error[:, :, None] * w["out0"], trace0, x, w["wx0"], w["wh0"])
    d_back, out["wx1"], out["wh1"], out["b1"] = lstm_back(error[::-1, :, None] * w["out1"], trace1, x[::-1], w["wx1"], w["wh1"])
    d_x = (d_x + d_back[::-1]).reshape(longest * n, -1)
    out["path"] = paths.reshape(longest * n, -1).T @ d_x[:, :PATH_SIZE]
    out["word"] = bags.reshape(longest * n, -1).T @ d_x[:, PATH_SIZE : PATH_SIZE + WORD_SIZE]
    return out


def held_out(weights: dict[str, np.ndarray], pages: int = 500, seed: int = 7) -> tuple[float, float]:
    """Share of blocks labelled right, and of pages with all blocks right, on made-up pages that were not trained on."""
    rng, labeller = Random(seed), Labeller(weights)
    made = [made_page(rng) for _ in range(pages)]
    cut = [[b._replace(text=b.text.replace("⁣", "").strip() or "x") for b in blocks(html)] for html, _ in made]
    right = [(s >= 0.5) == np.array(label, bool) for s, (_, label) in zip(labeller.scores(cut), made)]
    return float(np.concatenate(right).mean()), float(np.mean([r.all() for r in right]))


if __name__ == "__main__":
    made = train()
    np.savez_compressed(WEIGHTS, **{k: v.astype(np.float16) for k, v in made.items()})
    print("blocks, pages right on held-out pages:", held_out(trained()))
