"""Cross-tokenizer alignment against the two libraries on whole texts."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
import tokenizers

import __spark_entry__ as registry
from carelens.llm import alignment

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.Vocabularies.load(*FILES)


@pytest.fixture(scope="module")
def plain():
    a, b = tokenizers.Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    a.encode_special_tokens = True
    decoder = tokenizers.decoders.ByteLevel()

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(text):
        """(A spans, B spans) as (begin, end, id), or None without tokens."""
        if not text:
            return None
        whole = (" " + text).encode()
        encoded = a.encode(" " + text, add_special_tokens=False)
        assert decoder.decode(encoded.tokens) == " " + text
        letters = {c: i for i, c in alignment.byte_letters().items()}
        spans = []
        for ids, size in (
            (encoded.ids, [len(bytes(letters[c] for c in t)) for t in encoded.tokens]),
            (ids := b.encode(text), [len(b_bytes(i)) for i in ids]),
        ):
            at, out = 0, []
            for i, n in zip(ids, size):
                out.append((at, at + n, i))
                at += n
            spans.append(out)
        return spans if b"".join(b_bytes(i) for *_, i in spans[1]) == whole else None

    return encode


def brute(rows, encode):
    """Sorted result rows, by comparing every A token with every B token of a text."""
    made, docs = [], defaultdict(int)
    for doc_id, text in rows:
        spans = encode(text)
        if spans is None:
            made.append((doc_id, 0, 0, 0, Counter(), ""))
            continue
        a, b = spans
        linked, k = Counter(), 0
        for begin, end, i in a:
            while b[k][1] <= begin:
                k += 1
            j = k
            while j < len(b) and b[j][0] < end:
                linked[i, b[j][2]] += 1
                j += 1
        ends = sorted({s[1] for s in a} & {s[1] for s in b})
        groups, start = [], 0
        a_at, b_at = iter(a), iter(b)
        for end in ends:
            sides = []
            for side in (a_at, b_at):
                ids = []
                for s in side:
                    ids.append(str(s[2]))
                    if s[1] == end:
                        break
                sides.append(",".join(ids))
            groups.append("|".join(sides))
        for p in linked:
            docs[p] += 1
        made.append((doc_id, len(a), len(b), len(groups), linked, ";".join(groups)))
    most = defaultdict(int)
    for (i, _), n in docs.items():
        most[i] = max(most[i], n)
    out = []
    for doc_id, n_a, n_b, n_groups, linked, groups in made:
        best = sum(n for p, n in linked.items() if docs[p] == most[p[0]])
        digest = sha256(groups.encode()).hexdigest() if n_a else ""
        out.append((doc_id, n_a, n_b, n_groups, sum(linked.values()), best, sum(n * docs[p] for p, n in linked.items()), digest))
    return sorted(out, key=str)


def result(df):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


ODD = [
    "", None, " ", "a", " a", "a ", "  ", "a  b ", "\n ", "x\n\n  y", "tab\t tab", "　wide　 space", "nul\0 byte", "café naïve ﬁn",
    "<|endoftext|> and <s> </s> <0x41>", "▁ lower block", "日本語のテキスト without spaces", "I'll we've 1234567 !!!??? ", "\u0085next \x1cline", "emoji 👩‍👩‍👧 ok",
    "x" * 300 + " " + "ab " * 50, "a" * 5000, " ".join(["the cat"] * 900),
]


def odd_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab \t\n\xa0éß日本1's<|>.") for _ in range(rng.randint(0, 40))) for _ in range(n)] + ODD


def test_align_and_links():
    a, b = [2, 5, 6, 9], [5, 7, 9]
    assert [x.tolist() for x in alignment.align(a, b)] == [[2, 4], [1, 3]]
    assert list(zip(*(x.tolist() for x in alignment.links(a, b)))) == [(0, 0), (1, 0), (2, 1), (3, 1), (3, 2)]


def test_chunks_give_what_whole_texts_give(vocabularies, plain):
    aligner = alignment.Aligner(vocabularies, remember=50)  # forgets often
    texts = odd_texts(1, 400)
    got = [r for i in range(0, len(texts), 7) for r in aligner([t or "" for t in texts[i : i + 7]])]
    for text, (n_a, n_b, _, groups, pairs) in zip(texts, got):
        spans = plain(text)
        assert (n_a, n_b) == ((0, 0) if spans is None else (len(spans[0]), len(spans[1])))
        if spans:
            sides = [g.split("|") for g in groups.split(";")]
            assert [",".join(s) for s in zip(*sides)] == [",".join(str(i) for *_, i in s) for s in spans]
            assert len(pairs) == sum(1 for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1])


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 0])
def test_operator_equals_brute_force(documents, vocabularies, plain, broadcast_pairs):
    rows = [*enumerate(odd_texts(2, 60)), (3, "the same id"), (None, "no id"), (None, "no id")]
    out = alignment.align_documents(documents(rows), vocabularies, with_groups=True, broadcast_pairs=broadcast_pairs)
    assert result(out) == brute(rows, plain)
    assert all(sha256(r.groups.encode()).hexdigest() == r.groups_sha256 if r.groups else r.groups_sha256 == "" for r in out.collect())


def test_empty_table(documents, vocabularies):
    assert alignment.align_documents(documents([]), vocabularies).collect() == []
    assert result(alignment.align_documents(documents([(1, None)]), vocabularies)) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_registered_query_equals_brute_force(spark, sf, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(registry.queries()["op13_alignment"](spark, sf)) == brute(rows, plain)
