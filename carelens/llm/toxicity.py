"""Toxicity by a classifier chain.

The categories are predicted one after the other. Each has a linear model (logistic regression) over hashed words and word
beginnings, which also reads the probabilities that the chain gave to the earlier categories. In training these are
out-of-fold predictions: a document's probability comes from models that did not see it, so later models learn from the same kind
of input as they get when the chain is applied.

The labels only say toxic or not. The finer categories are taken from the toxic documents by seed words; those of
toxic documents without a seed word are ``coded``. The last link predicts the label itself.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import documents, map_texts, quoted
from carelens.session import materialise

#: Seed words of the plain categories.
SEEDS = {
    "insult": ("clown", "idiot", "loser", "moron", "stupid"),
    "contempt": ("disgusting", "pathetic", "scum", "trash", "worthless"),
}
CATEGORIES = (*SEEDS, "coded", "toxic")
#: Labelled documents used at most: half toxic, half not, each the smallest hashes of their ids. Features kept at most per link.
MAX_LABELLED, MAX_FEATURES = 8_000, 4_096
BUCKETS = 1 << 20
FOLDS = 5
_WORD = re.compile(r"[^\W\d_]+")


def _buckets(word: str) -> list[int]:
    """Buckets of a word and of its first 4 and 5 letters."""
    names = [f"={word}"]
    if len(word) > 4:
        names.append(f"^{word[:4]}")
    if len(word) > 5:
        names.append(f"^{word[:5]}")
    return [_fnv(n.encode("utf-8", "replace")) for n in names]


def _fnv(data: bytes) -> int:
    """FNV-1a, folded to a bucket."""
    h = 0xCBF29CE484222325
    for byte in data:
        h = ((h ^ byte) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
    return (h ^ (h >> 32)) & (BUCKETS - 1)


@dataclass(frozen=True)
class Link:
    """One model: ``weight`` of features by bucket, ``bias``, and ``earlier``: weights of the earlier categories' probabilities."""

    weight: dict[int, float]
    bias: float
    earlier: tuple[float, ...]

    def probability(self, features: set[int], before: list[float]) -> float:
        score = self.bias + sum(map(self.weight.get, self.weight.keys() & features)) + sum(w * p for w, p in zip(self.earlier, before))
        return float(1 / (1 + np.exp(-np.clip(score, -30, 30))))


@dataclass(frozen=True)
class Chain:
    """Links in the order of :data:`CATEGORIES`, and the probability from which a document is toxic."""

    links: tuple[Link, ...]
    threshold: float = 0.5

    def probabilities(self, features: set[int]) -> list[float]:
        out: list[float] = []
        for link in self.links:
            out.append(link.probability(features, out))
        return out


def _select(rows: np.ndarray, columns: np.ndarray, target: np.ndarray, limit: int) -> np.ndarray:
    """Buckets whose presence tells most about the target: the highest chi-squared, at least 10."""
    total = np.bincount(columns, minlength=BUCKETS).astype(float)
    hit = np.bincount(columns, target[rows], minlength=BUCKETS)
    n, positive = len(target), target.sum()
    expected = total * positive / n
    spread = expected * (1 - positive / n) * (1 - total / n)
    chi = np.where((total >= 3) & (spread > 0), (hit - expected) ** 2 / np.maximum(spread, 1e-9), 0)
    best = np.argsort(-chi, kind="stable")[:limit]
    return np.sort(best[chi[best] >= 10])


def _train(rows: np.ndarray, columns: np.ndarray, earlier: np.ndarray, target: np.ndarray, limit: int, rounds: int = 150, l2: float = 1e-3):
    """Logistic regression by full-batch Adam on presence features and the earlier probabilities."""
    chosen = _select(rows, columns, target, limit)
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))
    inside = place[columns] >= 0
    r, c = rows[inside], place[columns[inside]]
    weight = np.zeros(len(chosen) + earlier.shape[1] + 1)
    first, second = np.zeros_like(weight), np.zeros_like(weight)
    split = len(chosen)
    for step in range(1, rounds + 1):
        score = np.bincount(r, weight[c], len(target)) + earlier @ weight[split:-1] + weight[-1]
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target) / len(target)
        slope = np.concatenate((np.bincount(c, error[r], split), earlier.T @ error, [error.sum()])) + l2 / len(target) * weight
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        weight -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return Link(dict(zip(chosen.tolist(), weight[:split].tolist())), float(weight[-1]), tuple(weight[split:-1].tolist()))


def _predict(link: Link, rows: np.ndarray, columns: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """A link's probabilities for many documents at once."""
    weight = np.zeros(BUCKETS)
    weight[list(link.weight)] = list(link.weight.values())
    score = np.bincount(rows, weight[columns], len(earlier)) + link.bias
    if link.earlier:
        score = score + earlier @ np.array(link.earlier)
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def train_chain(rows: np.ndarray, columns: np.ndarray, targets: np.ndarray, folds: np.ndarray, limit: int = MAX_FEATURES) -> Chain:
    """Fit the links one after the other.

    ``rows`` and ``columns``: document number and bucket of each feature; ``targets`` has a column of 0/1 per category, ``folds`` a
    number per document.
    """
    earlier, links = np.zeros((len(targets), 0)), []
    out = np.zeros(len(targets))
    for category in range(targets.shape[1]):
        target = targets[:, category].astype(float)
        out = np.zeros(len(targets))
        for fold in np.unique(folds):
            seen = folds != fold
            index = np.cumsum(seen) - 1
            mine = seen[rows]
            link = _train(index[rows[mine]], columns[mine], earlier[seen], target[seen], limit) if seen.any() else _EMPTY
            out[~seen] = _predict(link, rows, columns, earlier)[~seen]
        links.append(_train(rows, columns, earlier, target, limit))
        earlier = np.column_stack((earlier, out))
    # the last category's out-of-fold probabilities tell where to cut
    return Chain(tuple(links), _threshold(out, targets[:, -1] == 1))


_EMPTY = Link({}, -5.0, ())


def _threshold(p: np.ndarray, toxic: np.ndarray) -> float:
    if not toxic.any() or toxic.all():
        return 0.5
    cuts = np.linspace(0.05, 0.95, 91)
    # documents that are not toxic are many times more: their errors weigh four times as much
    cost = [np.mean(p[toxic] < c) + 4 * np.mean(p[~toxic] >= c) for c in cuts]
    best = cuts[np.flatnonzero(np.array(cost) <= min(cost) + 1e-12)]
    return float(best[len(best) // 2])


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """doc_id, toxic, text features and seeds found, of at most ``limit`` labelled documents.

    Labels without id or value are left out; several labels of a document: the highest counts. Rows of a repeated id each count.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = materialise(
        rows.filter("toxic = 1").orderBy(*order).limit(limit // 2).union(rows.filter("toxic = 0").orderBy(*order).limit(limit // 2)), "labelled"
    )
    texts = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "text")  # at most `limit` rows of two numbers

    def run(values):
        made = [set(_WORD.findall(t.lower())) for t in values]
        return {
            "features": [sorted({b for w in m for b in _buckets(w)}) for m in made],
            "seeds": [[not m.isdisjoint(s) for s in SEEDS.values()] for m in made],
        }

    return map_texts(texts, run, "features array<int>, seeds array<boolean>", ("doc_id", "toxic"))


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Chain:
    """Train on the labelled sample; the driver gets the distinct features of at most ``limit`` documents."""
    table = training_rows(docs, labels, limit).toArrow().sort_by("doc_id").combine_chunks()
    if not table.num_rows:
        return Chain(tuple(_EMPTY for _ in CATEGORIES))
    toxic = table["toxic"].to_numpy() == 1
    seeds = np.array(table["seeds"].to_pylist(), bool).reshape(len(toxic), -1) & toxic[:, None]
    targets = np.column_stack((seeds, toxic & ~seeds.any(axis=1), toxic))
    sizes = pc.list_value_length(table["features"]).to_numpy()
    columns = pc.list_flatten(table["features"]).to_numpy().astype(np.int64)
    return train_chain(np.repeat(np.arange(len(toxic)), sizes), columns, targets, table["doc_id"].to_numpy() % FOLDS)


def classify(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = MAX_LABELLED) -> DataFrame:
    """Per row: doc_id, one probability per category (p_insult, p_contempt, p_coded, p_toxic), toxic.

    Null texts are empty; ids may be null or repeat, rows are handled one by one. Without labelled documents nothing is toxic.
    """
    docs = documents(df, doc_id, text)
    chain = fit(docs, labels, limit)
    shared = df.sparkSession.sparkContext.broadcast(chain)  # bounded by MAX_FEATURES per link
    names = [f"p_{c}" for c in CATEGORIES]

    def run(texts):
        links = shared.value
        wanted = frozenset(b for link in links.links for b in link.weight)
        made = Words(wanted)
        values = [links.probabilities(made(t)) for t in texts]
        return {n: [v[i] for v in values] for i, n in enumerate(names)}

    scored = map_texts(docs, run, ", ".join(f"{n} double" for n in names), ("doc_id",))
    return scored.select("*", (quoted("p_toxic") >= chain.threshold).alias("toxic"))


class Words:
    """The features of texts as far as some link weighs them, with words remembered."""

    def __init__(self, wanted: frozenset[int], size: int = 200_000):
        from carelens.llm.common import Remembered

        self.of_word = Remembered(lambda w: frozenset(_buckets(w)) & wanted, size)

    def __call__(self, text: str) -> set[int]:
        return set().union(*map(self.of_word.__getitem__, set(_WORD.findall(text.lower()))))
