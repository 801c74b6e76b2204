"""Alignment of two tokenizers over the same bytes, and how many documents link each pair of their ids.

The byte offsets at which tokens end go into one dictionary per tokenizer, from end to token index. The offsets that both have, in
order, cut both id lists into groups; within a group every pair of tokens whose bytes overlap is a link.

Both tokenizers always end a token before a space that follows a character other than white space: the byte-level pattern never matches across
such a place, and no piece of the other vocabulary holds a space after another character (proven when it is loaded). So a
text is the sequence of its chunks between these places, and a chunk's alignment is made once and remembered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import accumulate, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.llm.common import documents, per_worker, row_blocks
from carelens.llm.token_counts import byte_letters
from carelens.session import materialise

#: Pair counts broadcast up to this many rows; beyond it the join is shuffled.
BROADCAST_PAIRS = 1 << 20
#: Bytes of texts aligned at once; a longer text is aligned alone and whole.
BLOCK_BYTES = 1 << 20
#: Code points of the longest chunk that is remembered.
REMEMBERED = 128
_CUT = re.compile(r"(?<=\S) ")
_LOOSE = re.compile(r"(?:\A|\s) ")
_LOW = (1 << 40) - 1
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


@dataclass(frozen=True)
class Vocabularies:
    """The two vocabulary files' content: byte-level BPE (A) and pieces (B)."""

    byte_level: str
    pieces: bytes

    @staticmethod
    def load(byte_level: str, pieces: str) -> Vocabularies:
        with open(byte_level, encoding="utf-8") as a, open(pieces, "rb") as b:
            return Vocabularies(a.read(), b.read())


def align(a_ends: list[int], b_ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """How many A and B tokens end up to each offset at which both end: the groups' bounds in either id list."""
    a_at = dict(zip(a_ends, range(1, len(a_ends) + 1)))
    b_at = dict(zip(b_ends, range(1, len(b_ends) + 1)))
    common = sorted(a_at.keys() & b_at.keys())
    return tuple(np.fromiter(map(at.__getitem__, common), np.int64, len(common)) for at in (a_at, b_at))


def links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the tokens whose byte ranges overlap, in order: one for each stretch between neighbouring ends of any token."""
    ends = np.union1d(a_ends, b_ends)
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


class Aligner:
    """Encodes and aligns whole texts. Chunks are remembered for two generations of at most ``remember`` and those of one call."""

    def __init__(self, vocabularies: Vocabularies, remember: int = 200_000):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(vocabularies.byte_level), SentencePieceProcessor(model_proto=vocabularies.pieces)
        self.a.encode_special_tokens = True
        byte_of = {letter: bytes([b]) for b, letter in byte_letters().items()}
        names = (self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size()))
        self.a_bytes = [b"".join(byte_of.get(c, c.encode()) for c in name) for name in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.cuttable = not any(re.search("[^▁]▁", p) for p in pieces)
        ids = range(max(len(self.a_bytes), len(pieces)))
        self.decimal, self.a_last, self.b_last = (np.array([f"{i}{sign}" for i in ids], object) for sign in ",|;")
        self.space = self.b.piece_to_id("▁")
        self.remember, self.young, self.old = remember, {}, {}

    def encode(self, rest: str) -> tuple[list[int], list[int], list[int], list[int]] | None:
        """Ids and ends by A and B of a space and the text; None where the tokens' bytes are not the text's. The piece tokenizer adds
        the space itself, but not to nothing."""
        a_ids, b_ids = self.a.encode(" " + rest, add_special_tokens=False).ids, self.b.encode(rest) if rest else [self.space]
        a, b, whole = [self.a_bytes[i] for i in a_ids], [self.b_bytes[i] for i in b_ids], b" " + rest.encode()
        if b"".join(a) != whole or b"".join(b) != whole:
            return None
        return a_ids, b_ids, list(accumulate(map(len, a))), list(accumulate(map(len, b)))

    def aligned(self, rests: list[str]) -> Iterator[tuple[str, tuple | None]]:
        """Each chunk with its alignment. Chunks between which both tokenizers end a token are encoded as one text."""
        plain = [bool(r) and not r[-1].isspace() and "▁" not in r for r in rests] if self.cuttable else [False] * len(rests)
        together, apart = list(compress(rests, plain)), [r for r, p in zip(rests, plain) if not p]
        found = self.encode(" ".join(together)) if together else None
        if found is not None:
            yield from zip(together, self.sliced(*found, np.cumsum([len(r.encode()) + 1 for r in together])))
        for rest in rests if together and found is None else apart:
            found = self.encode(rest)
            yield rest, found and next(self.sliced(*found, np.array(found[2][-1:])))

    def sliced(self, a_ids: list[int], b_ids: list[int], a_ends: list[int], b_ends: list[int], stops: np.ndarray) -> Iterator[tuple[int, str, bytes]]:
        """For the text up to each of ``stops``, from the one before: number of A ids, B ids and groups (40 bits each), the groups as text
        and the linked pairs as packed 64-bit numbers."""
        a_to, b_to = align(a_ends, b_ends)
        a, b, a_ends, b_ends = np.array(a_ids), np.array(b_ids), np.array(a_ends), np.array(b_ends)
        # A's ids of a group come first, then B's; the last of each has another sign behind it
        place_a = np.arange(len(a)) + np.repeat(np.concatenate(([0], b_to[:-1])), np.diff(a_to, prepend=0))
        place_b = np.arange(len(b)) + np.repeat(a_to, np.diff(b_to, prepend=0))
        text = np.empty(len(a) + len(b), object)
        text[place_a], text[place_b] = self.decimal[a], self.decimal[b]
        text[place_a[a_to - 1]], text[place_b[b_to - 1]] = self.a_last[a[a_to - 1]], self.b_last[b[b_to - 1]]
        text = text.tolist()
        i, j = links(a_ends, b_ends)
        pairs = a[i] << 32 | b[j]
        group = np.searchsorted(a_ends[a_to - 1], stops) + 1
        link = np.searchsorted(np.minimum(a_ends[i], b_ends[j]), stops, "right")
        n_a, n_b = a_to[group - 1], b_to[group - 1]
        x = y = z = w = 0
        for x2, y2, z2, w2 in zip(n_a.tolist(), n_b.tolist(), group.tolist(), link.tolist()):
            yield (x2 - x) | (y2 - y) << 40 | (z2 - z) << 80, "".join(text[x + y : x2 + y2])[:-1], pairs[w:w2].tobytes()
            x, y, z, w = x2, y2, z2, w2

    def chunks(self, text: str) -> list[str]:
        """The text cut at the spaces where both tokenizers end a token; each chunk without the space before it."""
        if not self.cuttable:
            return [text]
        return text.split(" ") if _LOOSE.search(text) is None else _CUT.split(text)

    def __call__(self, texts: list[str]) -> list[tuple[int, int, int, str, np.ndarray]]:
        """The same for whole texts; zeros and nothing where a text has no tokens."""
        cut = [self.chunks(t) if t else [] for t in texts]
        if len(self.young) > self.remember:
            self.young, self.old = {}, self.young
        known, old = self.young, self.old
        wanted = set().union(*cut).difference(known)
        known.update((r, old[r]) for r in wanted if r in old)
        new = [r for r in wanted if r not in old]
        known.update(self.aligned(new))
        out = [self._whole([known[r] for r in rests] or [None]) for rests in cut]
        for r in wanted:
            if len(r) > REMEMBERED:
                del known[r]
        return out

    def _whole(self, found: list) -> tuple[int, int, int, str, np.ndarray]:
        if None in found:
            return 0, 0, 0, "", np.empty(0, np.int64)
        counts, groups, pairs = zip(*found)
        n = sum(counts)
        return n & _LOW, n >> 40 & _LOW, n >> 80, ";".join(groups), np.frombuffer(b"".join(pairs), np.int64)


_LINKS = T.ArrayType(T.StructType([T.StructField("pair", T.LongType()), T.StructField("n", T.IntegerType())]))


def encoded(df: DataFrame, vocabularies: Vocabularies, with_groups: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links (each distinct pair and how often), and the groups as text."""
    docs = documents(df, doc_id, text)
    shared = df.sparkSession.sparkContext.broadcast(vocabularies)  # bounded by the vocabularies
    name = sha256(vocabularies.byte_level.encode() + vocabularies.pieces).hexdigest()
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    fields = [docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in counts), T.StructField("groups_sha256", T.StringType()), T.StructField("links", _LINKS)]
    schema = T.StructType(fields + [T.StructField("groups", T.StringType())] * with_groups)
    link = pa.struct([("pair", pa.int64()), ("n", pa.int32())])

    def run(batches):
        aligner = per_worker(name, lambda: Aligner(shared.value))
        for batch in (b.slice(i, j - i) for b in batches for i, j in row_blocks(b.column(1), BLOCK_BYTES)):
            rows, digests, texts, keys, times, ends = [], [], [], [], [], [0]
            for n_a, n_b, n_groups, groups, pairs in aligner(batch.column(1).to_pylist()):
                key, n = np.unique(pairs, return_counts=True)
                rows.append((n_a, n_b, n_groups, len(pairs)))
                digests.append(sha256(groups.encode()).hexdigest() if n_a else "")
                keys.append(key)
                times.append(n)
                ends.append(ends[-1] + len(key))
                if with_groups:
                    texts.append(groups)
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(times).astype(np.int32))], fields=list(link))
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in zip(*rows)), pa.array(digests, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(texts, pa.string())] * with_groups, schema.names)

    return docs.mapInArrow(run, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, n_docs (rows that hold it linked) and most (the highest n_docs of any pair with the same A id)."""
    counted = materialise(rows.select(F.explode("links.pair").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs")), "pairs")
    keyed = counted.withColumn("a", F.shiftright("pair", 32))
    most = keyed.groupBy("a").agg(F.max("n_docs").alias("most"))
    return keyed.join(most, "a").select("pair", "n_docs", "most")


def align_documents(
    df: DataFrame, vocabularies: Vocabularies, with_groups: bool = False, broadcast_pairs: int = BROADCAST_PAIRS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and ``groups`` if asked for.

    A encodes a space and the text, B the text (it adds the space). ``groups`` lists A and B ids as ``a1,a2|b1;a3|b2,b3``. A pair's count
    is the number of rows that hold it linked; ``n_best`` counts the links whose count is the highest of their A id, ties
    included, ``count_sum`` sums the counts over the links. Null, empty texts and those whose tokens' bytes differ from the text
    have no tokens: zeros and an empty digest. Every row is a document, whatever its id; ids may be null or repeat. An empty table
    gives an empty table.
    """
    rows = materialise(encoded(df, vocabularies, with_groups, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = materialise(pair_counts(rows), "pair_counts")
    if counts.count() <= broadcast_pairs:
        counts = F.broadcast(counts)
    each = rows.select("row", F.inline("links")).join(counts, "pair")
    best = F.when(F.col("n_docs") == F.col("most"), F.col("n")).otherwise(0)
    sums = each.groupBy("row").agg(F.sum(best).alias("n_best"), F.sum(F.col("n") * F.col("n_docs")).alias("count_sum"))
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return rows.join(sums, "row", "left").select(*kept, *zero, "groups_sha256", *["groups"] * with_groups)
