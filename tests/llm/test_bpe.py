"""Byte-pair encoding against the tiktoken library."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from attestra.llm import bpe

public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def vocabulary(request):
    path = public.path(request.param)
    ranks = bpe.read_ranks(path)
    return path, bpe.Encoder(ranks, public.PATTERN), tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(coder, text):
    return np.frombuffer(b"".join(coder.encode(text)), "<u4").tolist()


def texts():
    rng = random.Random(3)
    out = ["", " ", "\n\n  \t x", "it's we'll 's 'sx ''s", "<|endoftext|>", "漢字 ひらがな 한글 🙂🙂 é́​\xa0　x", "aaaaaaa" * 50, "0123456789" * 9]
    for _ in range(400):
        out.append("".join(rng.choice("ab  cé\n\t'sTHE the1230!?漢 \x1c\u0085") for _ in range(rng.choice([1, 3, 10, 60]))))
    return out


def test_every_text_as_the_library(vocabulary):
    _, coder, library = vocabulary
    for t in texts():
        assert ids(coder, t) == library.encode_ordinary(t)
        assert coder.decode(np.array(ids(coder, t), "<u4")) == t.encode()
    assert not any(coder.leaf)


@pytest.mark.parametrize("letters", ["a", "ab", "theofan", "-=", "é"])
def test_very_long_pre_tokens(vocabulary, letters):
    _, coder, library = vocabulary
    rng = random.Random(5)
    t = "".join(rng.choice(letters) for _ in range(20_000))
    assert ids(coder, t) == library.encode_ordinary(t)


def test_own_vocabulary_with_overlapping_pairs():
    ranks = {bytes([b]): b for b in range(256)} | {x: 256 + k for k, x in enumerate([b"ba", b"ab", b"aba", b"aa", b"abab", b"baab", b"aaa"])}
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder, rng = bpe.Encoder(ranks, public.PATTERN), random.Random(9)
    for _ in range(2000):
        t = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 40)))
        assert ids(coder, t) == library.encode_ordinary(t)


def test_cuts_and_forgetting_change_nothing(vocabulary, monkeypatch):
    _, coder, library = vocabulary
    monkeypatch.setattr(bpe, "PIECE_CHARS", 5)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    coder.known.clear()
    for t in texts():
        assert ids(coder, t) == library.encode_ordinary(t)


def test_documents(spark, vocabulary):
    path, coder, library = vocabulary
    rows = [(i, t) for i, t in enumerate(texts()[:60])] + [(1, "again"), (1, "again"), (None, "no id"), (5, None)]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, id int, n_tokens int, ids string").repartition(3)
    out = bpe.encode_documents(df, path, public.PATTERN, with_ids=True)
    expected = []
    for i, t in rows:
        x = library.encode_ordinary(t or "")
        expected.append((str(i), len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), x))
    key = lambda r: (r[0], r[2])
    assert sorted(((str(r.doc_id), *r[1:]) for r in out.collect()), key=key) == sorted(expected, key=key)
    back = bpe.decode_documents(out, path)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(i), t or "") for i, t in rows)
    assert bpe.encode_documents(df.filter(F.lit(False)), path, public.PATTERN).count() == 0


def test_bytes_that_are_no_utf8(spark, vocabulary):
    path, _, library = vocabulary
    df = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    assert bpe.encode_documents(df, path, public.PATTERN).first().n_tokens == len(library.encode_ordinary("a�b"))
