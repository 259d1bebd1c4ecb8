import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from tidemark.llm import op6_bpe
from tests.llm.conftest import ODD

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


def pair(name):
    tok = op6_bpe.load(public_tokenizers.path(name), public_tokenizers.PATTERN)
    return tok, tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=tok.bpe.ranks,
                                  special_tokens={})


@pytest.mark.parametrize("name", FILES)
def test_same_ids_as_the_library(name):
    tok, enc = pair(name)
    rnd = random.Random(1)
    texts = [t or "" for _, t in ODD] + ["".join(map(chr, range(700))), "<|endoftext|>"]
    texts += ["".join(rnd.choice("abcdefxyz  \n\té漢字🎉ß!?0123'") for _ in range(300)) for _ in range(100)]
    for t in texts:
        assert tok.encode(t) == enc.encode_ordinary(t)
        assert tok.decode(tok.encode(t)) == t.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_random_texts(text):
    tok, enc = pair(FILES[0])
    assert tok.encode(text) == enc.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=40), st.binary(max_size=20), st.integers(0, 40))
def test_appends_and_edits_reuse_the_table(data, more, at):
    bpe = pair(FILES[0])[0].bpe
    last = bpe.extend(data, [])
    grown = bpe.extend(data + more, list(last))
    assert grown == bpe.extend(data + more, [])
    at = min(at, len(data))
    edited = data[:at] + more + data[at + 1:]
    assert bpe.extend(edited, last[:at + 1]) == bpe.extend(edited, [])


def test_frames(spark, odd, none):
    path, pattern = public_tokenizers.path(FILES[0]), public_tokenizers.PATTERN
    tok, enc = pair(FILES[0])
    want = sorted((i or -1, len(enc.encode_ordinary(t or "")),
                   hashlib.sha256(" ".join(map(str, enc.encode_ordinary(t or ""))).encode()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ODD)
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                 for r in op6_bpe.round_trip(odd, path, pattern).collect())
    assert got == want
    back = op6_bpe.decode(op6_bpe.encode(odd, path, pattern), path, pattern).collect()
    assert sorted(bytes(r["data"]) for r in back) == sorted((t or "").encode() for _, t in ODD)
    assert op6_bpe.round_trip(none, path, pattern).collect() == []
