"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece exactly one token can be the last one of the prefix's encoding. It is the vocabulary string
that ends there, encodes alone as one token, and stands in a valid pair with the last token of what precedes it (two
neighbouring tokens are valid if their joined bytes encode as these two). So one token per prefix describes the
encodings of all prefixes: bytes are appended exactly, an edit keeps everything before it, and behind it the old
tokens are taken over as soon as ``longest`` of them in a row come out the same. Cost is linear in the piece's length.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame

from carelens.llm.common import Remembered, documents, map_texts, per_worker
from carelens.llm.pretokens import Pieces

#: Two tokens as one number: left * PAIR + right. Above every id.
PAIR = 1 << 24
_SHORT = (2, 1)
#: Chunks remembered in each of two generations, about 250 bytes each.
REMEMBERED = 500_000
#: Bytes of a beginning whose last tokens are remembered.
HEAD = 6


def load_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks (also their ids) from a rank file; read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(text): int(rank) for text, rank in map(bytes.split, lines)}


def merged(data: bytes, ranks: dict[bytes, int], stop: int = 1) -> list[bytes]:
    """The definition: join the neighbours of lowest rank, leftmost first, until no neighbours join or ``stop`` are left."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > stop:
        found = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        best = min((r for r in found if r is not None), default=None)
        if best is None:
            break
        i = found.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def halves(ranks: dict[bytes, int]) -> dict[int, tuple[int, int]]:
    """For each token that encodes alone as one token, the two tokens its last merge joined (single bytes: itself twice).

    Tokens that the merges never build are left out: they occur only as a whole piece.
    """
    out = {}
    for text, rank in ranks.items():
        if len(text) == 1:
            out[rank] = (rank, rank)
            continue
        parts = merged(text, ranks, stop=2)
        if len(parts) == 2 and parts[0] + parts[1] == text:
            out[rank] = (ranks[parts[0]], ranks[parts[1]])
    return out


class PrefixEncoder:
    """Encodes pieces with the ranks of a vocabulary that holds all 256 single bytes, each ranked before every join."""

    def __init__(self, ranks: dict[bytes, int], built: dict[int, tuple[int, int]] | None = None):
        self.ranks = ranks
        self.built = halves(ranks) if built is None else built
        self.string = {rank: text for text, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.alone = {text: rank for text, rank in ranks.items() if rank in self.built}
        tails: dict[bytes, set[int]] = {}
        for text in self.alone:
            if len(text) > 2:
                tails.setdefault(text[-3:], set(_SHORT)).add(len(text))
        self.sizes = {tail: tuple(sorted(found, reverse=True)) for tail, found in tails.items()}  # of strings that end so, longest first
        self.pair = Remembered(self._pair, 200_000)
        self.heads = Remembered(lambda head: tuple(Prefixes(self, head).last), 50_000)
        self.form = "H" if max(self.string) < 1 << 16 else "I"

    def _pair(self, key: int) -> bool:
        """Whether the joined bytes of two tokens encode as these two.

        Both are taken apart at the seam, the one that was built later first. The pair is invalid if at some step the
        two pieces at the seam join, and earlier than the merge that was just undone (of equal merges the left is first).
        """
        left, right = divmod(key, PAIR)
        string, ranks, built, before = self.string, self.ranks, self.built, PAIR
        while True:
            joined = ranks.get(string[left] + string[right])
            if joined is not None and joined < before:
                return False
            inner_left, inner_right = built[left][1], built[right][0]
            if inner_left == left and inner_right == right:
                return True
            if inner_right == right or (inner_left != left and left > right):
                before, left = left, inner_left
            else:
                before, right = right + 1, inner_right

    def of_piece(self, piece: str) -> bytes:
        """The ids of a piece, packed. A piece that is itself in the vocabulary is that token."""
        data = piece.encode("utf-8", "replace")
        whole = self.ranks.get(data)
        return array(self.form, (whole,) if whole is not None else Prefixes(self, data).ids()).tobytes()


class Prefixes:
    """A byte string with the last token of each of its prefixes."""

    def __init__(self, encoder: PrefixEncoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, data, []
        if len(data) > HEAD:  # what other strings with this beginning have already is the same here
            self.last = list(encoder.heads[data[:HEAD]])
        self._extend(len(self.last), len(data))

    def _extend(self, end: int, until: int) -> None:
        """Append the last tokens of the prefixes of lengths end + 1 to until, trying the longest strings of the vocabulary first."""
        data, last, find, pair, sizes = self.data, self.last, self.encoder.alone.get, self.encoder.pair, self.encoder.sizes.get
        for stop in range(end + 1, until + 1):
            for size in sizes(data[stop - 3 : stop], _SHORT) if stop > 2 else _SHORT:
                if size > stop:
                    continue
                start = stop - size
                token = find(data[start:stop])
                if token is not None and (not start or pair[last[start - 1] * PAIR + token]):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a single byte")

    def append(self, data: bytes) -> None:
        """Add bytes at the end; nothing before them is done again."""
        begin = len(self.data)
        self.data += data
        self._extend(begin, len(self.data))

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Put ``data`` in the place of bytes [start, stop); returns how many prefixes were worked out anew."""
        old, tail = self.last[stop:], self.data[stop:]
        self.data, self.last = self.data[:start] + data + tail, self.last[:start]
        edited, same = start + len(data), 0
        for end in range(start + 1, len(self.data) + 1):
            self._extend(end - 1, end)
            if end > edited:
                same = same + 1 if old[end - edited - 1] == self.last[-1] else 0
                if same >= self.encoder.longest:
                    self.last += old[end - edited :]
                    return end - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        """The encoding, read backwards from the last token."""
        out, end = [], len(self.data)
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.encoder.string[token])
        return out[::-1]


class TextCodec:
    """Whole texts to ids and back; ordinary text only, no special tokens. A chunk is remembered with its ids packed and in decimal."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, built: dict[int, tuple[int, int]] | None = None, remember: int = REMEMBERED):
        self.encoder = PrefixEncoder(ranks, built)
        self.decimal = {rank: str(rank) for rank in ranks.values()}
        self.pieces = Pieces(pattern, Remembered(self._piece, 50_000).__getitem__, self._joined, remember)
        strings = [self.encoder.string.get(i, b"") for i in range(max(self.encoder.string) + 1)]
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.size = np.fromiter(map(len, strings), np.int64, len(strings))
        self.begin = np.cumsum(self.size) - self.size

    def _piece(self, piece: str) -> tuple[bytes, str]:
        packed = self.encoder.of_piece(piece)
        return packed, ",".join(map(self.decimal.__getitem__, array(self.encoder.form, packed)))

    @staticmethod
    def _joined(found: list[tuple[bytes, str]]) -> tuple[bytes, str]:
        packed, decimal = zip(*found) if found else ((), ())
        return b"".join(packed), ",".join(decimal)

    def pack(self, text: str) -> tuple[np.ndarray, str]:
        """The ids of a text, and as decimal numbers with commas."""
        found = self.pieces(text)
        packed, decimal = self._joined(found if found[0][0] else found[1:])  # nothing before a space at the begin
        return np.frombuffer(packed, np.uint16 if self.encoder.form == "H" else np.uint32), decimal

    def encode(self, text: str) -> list[int]:
        return self.pack(text)[0].tolist()

    def unpack(self, ids: np.ndarray) -> Iterator[bytes]:
        """The bytes of ids made by :meth:`pack`, some at a time, each looked up in the vocabulary's strings."""
        for at in range(0, len(ids), 1 << 16):
            some = ids[at : at + (1 << 16)]
            size = self.size[some]
            place = np.arange(int(size.sum())) + np.repeat(self.begin[some] - (np.cumsum(size) - size), size)
            yield self.bytes[place].tobytes()

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids. Raises KeyError for an id that is not in the vocabulary."""
        return b"".join(map(self.encoder.string.__getitem__, ids))


def _with_codec(df: DataFrame, ranks: dict[bytes, int], pattern: str, function, schema: str, keep: tuple[str, ...], text: str, remember: int = REMEMBERED) -> DataFrame:
    made = (ranks, pattern, halves(ranks))
    shared = df.sparkSession.sparkContext.broadcast(made)  # bounded by the vocabulary
    name = sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()

    def run(values):
        return function(per_worker(name, lambda: TextCodec(*shared.value, remember=remember)), values)

    return map_texts(df, run, schema, keep, text, holds=True)


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row's whole text.

    A null text is empty; an empty text has no ids. Ids may be null or repeat: rows are handled one by one.
    """

    def run(codec, texts):
        return {"ids": [codec.encode(t) for t in texts]}

    return _with_codec(documents(df, doc_id, text), ranks, pattern, run, "ids array<int>", ("doc_id",), "text")


def decode(df: DataFrame, ranks: dict[bytes, int], doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id`` and ``bytes`` of every row's ids. Null ids are none; an unknown id fails the job."""

    def run(codec, rows):
        return {"bytes": [codec.decode(r or []) for r in rows]}

    return _with_codec(df.selectExpr(f"`{doc_id}` AS doc_id", f"`{ids}` AS ids"), ranks, "", run, "bytes binary", ("doc_id",), "ids")


def round_trip(
    df: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False, remember: int = REMEMBERED
) -> DataFrame:
    """Encode, then decode the ids, in one pass that moves no ids between tasks.

    Per row: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (bytes that the ids decode to), and
    on request ids. ``remember`` bounds the chunks each worker holds, which changes memory and time only. Null texts are empty, ids may be null or repeat; rows are handled one by one.
    """

    def run(codec, texts):
        out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
        for value in texts:
            ids, decimal = codec.pack(value)
            decoded = sha256()
            for part in codec.unpack(ids):
                decoded.update(part)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(sha256(decimal.encode()).hexdigest())
            out["decoded_sha256"].append(decoded.hexdigest())
            if with_ids:
                out["ids"].append(ids.astype(np.int32))
        return out

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return _with_codec(documents(df, doc_id, text), ranks, pattern, run, schema, ("doc_id",), "text", remember)
