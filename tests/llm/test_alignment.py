"""Cross-tokenizer alignment against the libraries themselves and brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import alignment
from broadsheet.llm.vocabularies import SPACE, byte_level, content_of, pieces, vocabulary_path

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

A, B = vocabulary_path(), vocabulary_path("piece_bpe_32k.model")
LETTERS = [*"ab  e\n\téüß你好世🙂½\x00<>0x'.,AZ€ₛक\x1c\x85　", "́", "ﬁ", "<s>", "<0x41>", "<|endoftext|>", "the", " " * 20, "\n\n", "'ll"]


@pytest.fixture(scope="module")
def libraries():
    return tokenizers.Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)


def some_texts(n, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choice(LETTERS) for _ in range(draw.randint(1, 25))) for _ in range(n)]


def test_ids_equal_the_libraries(libraries):
    byte_bpe, piece_bpe = libraries
    texts = [*some_texts(3_000), "".join(some_texts(400)), "a" * 3_000, " " * 3_000, "\n " * 700 + "x", SPACE + "a" + SPACE]
    encode = byte_level(content_of(A))
    assert [encode(t).tolist() for t in texts] == [byte_bpe.encode(t, add_special_tokens=False).ids for t in texts]
    plain = byte_level(content_of(A), True)
    byte_bpe.encode_special_tokens = True
    assert [plain(t).tolist() for t in texts] == [byte_bpe.encode(t, add_special_tokens=False).ids for t in texts]
    assert [pieces(content_of(B))(t).tolist() for t in texts] == piece_bpe.encode(texts)


def brute_force(texts, libraries):
    byte_bpe, piece_bpe = libraries
    byte_bpe.encode_special_tokens = True
    letters = {v: bytes([k]) for k, v in _bytes_to_letters().items()}
    documents, holders = [], Counter()
    for text in texts:
        a = byte_bpe.encode(" " + text, add_special_tokens=False).ids if text else []
        b = piece_bpe.encode(text) if text else []
        bytes_a = [b"".join(letters[c] for c in byte_bpe.id_to_token(i)) for i in a]
        bytes_b = [
            bytes([int(piece_bpe.id_to_piece(i)[3:5], 16)]) if piece_bpe.is_byte(i) else piece_bpe.id_to_piece(i).replace(SPACE, " ").encode()
            for i in b
        ]
        whole = b" " + (text or "").encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            documents.append(None)
            continue
        spans_a, spans_b = _spans(bytes_a), _spans(bytes_b)
        links = [(x, y) for x, (s, e) in zip(a, spans_a) for y, (u, v) in zip(b, spans_b) if s < v and u < e]
        ends = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups, start = [], 0
        for end in ends:
            groups.append([[i for i, (s, e) in zip(ids, spans) if start <= s and e <= end] for ids, spans in ((a, spans_a), (b, spans_b))])
            start = end
        documents.append((a, b, groups, links))
        holders.update(set(links))
    highest = defaultdict(int)
    for (x, _), n in holders.items():
        highest[x] = max(highest[x], n)
    for found in documents:
        if found is None:
            yield 0, 0, 0, 0, 0, 0, ""
            continue
        a, b, groups, links = found
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(holders[p] == highest[p[0]] for p in links)
        yield len(a), len(b), len(groups), len(links), best, sum(holders[p] for p in links), hashlib.sha256(line.encode()).hexdigest()


def _bytes_to_letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _spans(tokens):
    ends = np.cumsum([len(t) for t in tokens]).tolist()
    return list(zip([0, *ends], ends))


@pytest.mark.parametrize("slab_bytes", [alignment.SLAB_BYTES, 1_000])
def test_equals_brute_force(spark, sf_dir, libraries, slab_bytes):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 600").orderBy("doc_id").limit(120).collect()]
    texts += some_texts(60) + [None, "", SPACE, "a" + SPACE + "b", "same words", "same words", "<|endoftext|> <s>", " ", "\n" * 50]
    if slab_bytes == 1_000:  # many passes
        texts = texts[100:]
    rows = [(i if i % 9 else None, t, "x", 3) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a string, at long").repartition(20 if slab_bytes > 1_000 else 3)
    got = alignment.align(df, slab_bytes=slab_bytes).collect()
    expected = list(brute_force(texts, libraries))
    assert sorted(tuple(r)[1:] for r in got) == sorted(expected)
    by_id = {r.doc_id: tuple(r)[1:] for r in got if r.doc_id is not None}
    assert all(by_id[i] == e for i, e in enumerate(expected) if i % 9)


def test_empty_table_and_only_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string")
    assert alignment.align(df.limit(0)).count() == 0
    assert sorted(tuple(r) for r in alignment.align(df).collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_one_long_text_beside_short_ones(spark):
    long_text = " ".join(f"w{i % 97} über{i}" for i in range(120_000))  # over a chunk
    df = spark.createDataFrame([(1, long_text), (2, "w1 über1"), (3, long_text)], "doc_id long, text string").coalesce(1)
    rows = {r.doc_id: r for r in alignment.align(df).collect()}
    assert rows[1].asDict() | {"doc_id": 3} == rows[3].asDict() and rows[1].n_a > 300_000 and rows[2].n_links < 20


def test_perfect_hash_is_minimal_and_keys_are_checked():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 100, 50_000):
        keys = np.unique(draw.integers(0, 1 << 62, n, dtype=np.uint64))
        number = alignment.PerfectHash.of(keys)
        again = alignment.PerfectHash(number.sizes, number.bits)
        assert sorted(again(keys).tolist()) == list(range(len(keys)))
        assert again(keys + np.uint64(1)).max(initial=-1) < len(keys)
