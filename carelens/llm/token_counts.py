"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is run through the merges once: those that come out as one token, and that the
pre-tokenizer's pattern leaves whole, are proven to count as 1. In a text a pre-token found among them is counted
without merging; only the rest is merged.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from hashlib import sha256
from heapq import heapify, heappop, heappush

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import Remembered, documents, map_texts, per_worker
from carelens.llm.pretokens import Pieces, compiled


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the code points from 256 on, in order.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """``rank`` of each merge as (left, right), strings ``special`` that count as one token wherever they occur,
    and ``proven`` strings (ordinary text) that encode alone as one token."""

    rank: dict[tuple[str, str], int]
    special: tuple[str, ...]
    proven: frozenset[str]
    pattern: str


def merge_count(letters: str, rank: dict[tuple[str, str], int]) -> int:
    """How many tokens the merges leave of a pre-token given in byte letters: always the best merge, leftmost first."""
    if len(letters) > 128:
        return _merge_count_long(letters, rank)
    none = len(rank)
    get, parts = rank.get, list(letters)
    found = [get(pair, none) for pair in zip(parts, parts[1:])]
    while found:
        best = min(found)
        if best == none:
            break
        i = found.index(best)
        parts[i] += parts.pop(i + 1)
        del found[i]
        if i:
            found[i - 1] = get((parts[i - 1], parts[i]), none)
        if i < len(found):
            found[i] = get((parts[i], parts[i + 1]), none)
    return len(parts)


def _merge_count_long(letters: str, rank: dict[tuple[str, str], int]) -> int:
    """The same by a queue of merges, so that a very long pre-token takes n log n steps."""
    parts: list[str | None] = list(letters)
    before, after = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
    queue = [(r, i, p) for i, p in enumerate(zip(parts, parts[1:])) if (r := rank.get(p)) is not None]
    heapify(queue)
    left = len(parts)
    while queue:
        _, i, pair = heappop(queue)
        j = after[i]
        if j < 0 or (parts[i], parts[j]) != pair:
            continue
        parts[i], parts[j] = pair[0] + pair[1], None
        left -= 1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b >= 0 and (r := rank.get(p := (parts[a], parts[b]))) is not None:
                heappush(queue, (r, a, p))
    return left


def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read a byte-level BPE file and prove the whole tokens; runs once, on the driver, bounded by the vocabulary."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model = data["model"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    rank = {pair: i for i, pair in enumerate(pairs)}
    special = tuple(t["content"] for t in data["added_tokens"])
    byte_of = {letter: b for b, letter in byte_letters().items()}
    find, proven = compiled(pattern).findall, set()
    for letters in model["vocab"]:
        if letters in special or merge_count(letters, rank) != 1:
            continue
        try:
            text = bytes(byte_of[c] for c in letters).decode("utf-8")
        except UnicodeDecodeError:  # part of a character: no pre-token
            continue
        if find(text) == [text]:
            proven.add(text)
    return Vocabulary(rank, special, frozenset(proven), pattern)


class Counter:
    """Counts the tokens of whole texts."""

    def __init__(self, vocabulary: Vocabulary, remember: int = 500_000):
        letters = byte_letters()
        table = [letters[b] for b in range(256)]

        def merge_rest(piece: str) -> int:
            return merge_count("".join(map(table.__getitem__, piece.encode("utf-8", "replace"))), vocabulary.rank)

        whole = dict.fromkeys(vocabulary.proven, 1)
        tokens = Remembered(merge_rest, 50_000, whole)
        self.pieces = Pieces(vocabulary.pattern, tokens.__getitem__, sum, remember)
        self.special = compiled("|".join(map(regex.escape, vocabulary.special))) if vocabulary.special else None

    def __call__(self, text: str) -> int:
        if self.special is None or self.special.search(text) is None:
            return sum(self.pieces(text)) if text else 0
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(self.pieces(p)) for p in parts if p)


def token_counts(
    df: DataFrame, vocabulary: Vocabulary, limit: int = 1024, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    Whole texts, no truncation, nothing added at either end. Null is the empty text: 0 bytes, 0 tokens. Ids may be
    null or repeat; rows are handled one by one.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by the vocabulary
    name = sha256(repr((sorted(vocabulary.rank.items()), vocabulary.special, vocabulary.pattern)).encode()).hexdigest()

    def run(texts):
        return {"n_tokens": list(map(per_worker(name, lambda: Counter(shared.value)), texts))}

    rows = documents(df, doc_id, text).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = map_texts(rows, run, "n_tokens long", ("doc_id", "n_bytes"), holds=True)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
