"""Encoding against the definition of the merges and against the public libraries."""

import random
from hashlib import sha256

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from carelens.llm import byte_bpe, token_counts

ODD = [
    "", " ", "  ", "a  b\n\n c \n", "\t x\x1cy \x1f z", "x" * 3000, "don't we'll x　y   z", "日本語 テキスト 123 ½ ² Ⅷ", "\r\n \r\n a",
    "🙂🙂 é́", "=" * 500, " " * 300 + "x", "one<|endoftext|>two <|endoftext|>", "...!!! ??", "ab" * 1500,
]


def random_texts(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(" \n\t\x1c\xa0a1.'sé日²ǅ​́🙂 the") for _ in range(rng.randint(1, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.load_vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def encoder(ranks):
    return byte_bpe.PrefixEncoder(ranks)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_codec_equals_library(ranks, library):
    codec = byte_bpe.TextCodec(ranks, public_tokenizers.PATTERN)
    for text in ODD + random_texts(2000):
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_prefixes_equal_merges(encoder, ranks):
    rng = random.Random(3)
    for _ in range(200):
        data = bytes(rng.choice(b"theandingou \xc3\xa9") for _ in range(rng.randint(1, 30)))
        table = byte_bpe.Prefixes(encoder, data)
        for end in range(1, len(data) + 1):
            assert encoder.string[table.last[end - 1]] == byte_bpe.merged(data[:end], ranks)[-1]


def test_append_and_replace_equal_a_fresh_encoding(encoder):
    rng = random.Random(4)
    table = byte_bpe.Prefixes(encoder, b"the beginning of it")
    for _ in range(100):
        start = rng.randint(0, len(table.data))
        stop = rng.randint(start, min(len(table.data), start + 5))
        table.replace(start, stop, bytes(rng.choice(b"ea nthi") for _ in range(rng.randint(0, 6))))
        table.append(b"ing")
        assert table.last == byte_bpe.Prefixes(encoder, table.data).last


def test_replace_stops_behind_the_edit(encoder):
    table = byte_bpe.Prefixes(encoder, b"thing " * 200)
    assert table.replace(3, 4, b"k") < 200 < len(table.data)
    assert table.last == byte_bpe.Prefixes(encoder, table.data).last


def test_counts_equal_library(vocabulary):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counter = token_counts.Counter(vocabulary)
    texts = ODD + random_texts(2000)
    assert [counter(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_whole_tokens_are_proven(vocabulary):
    letters = token_counts.byte_letters()
    assert len(vocabulary.proven) > 40_000
    for text in random.Random(1).sample(sorted(vocabulary.proven), 500):
        assert token_counts.merge_count("".join(letters[b] for b in text.encode()), vocabulary.rank) == 1


def test_long_pre_tokens_by_queue(vocabulary):
    rng = random.Random(2)
    for _ in range(50):
        word = "".join(rng.choice("aeinorst") for _ in range(rng.randint(100, 160)))
        direct = token_counts._merge_count_long(word, vocabulary.rank)
        parts, found = list(word), True
        while found:  # the definition
            pairs = [vocabulary.rank.get(p, 1 << 30) for p in zip(parts, parts[1:])]
            found = bool(pairs) and min(pairs) < 1 << 30
            if found:
                i = pairs.index(min(pairs))
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert direct == len(parts)


def test_queries_over_rows(spark, documents, ranks, vocabulary, library):
    rows = [(1, None), (2, ""), (2, "the the"), (None, "the"), (5, "a b " * 2000), (5, "a b " * 2000)]
    counted = token_counts.token_counts(documents(rows), vocabulary).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in counted)[:3] == [(0, 3, 1, False), (1, 0, 0, False), (2, 0, 0, False)]
    assert sum(r.over_limit for r in counted) == 2
    got = {(r.doc_id, r.decoded_sha256): r for r in byte_bpe.round_trip(documents(rows), ranks, public_tokenizers.PATTERN).collect()}
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        row = got[doc_id, sha256((text or "").encode()).hexdigest()]
        assert (row.n_tokens, row.ids_sha256) == (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert byte_bpe.round_trip(documents([]), ranks, public_tokenizers.PATTERN).collect() == []
    back = byte_bpe.decode(byte_bpe.encode(documents(rows), ranks, public_tokenizers.PATTERN), ranks).collect()
    assert sorted(bytes(r["bytes"]).decode() for r in back) == sorted(t or "" for _, t in rows)
