import hashlib
import random

import numpy as np
import pytest

from medallion.llm import bpe
from medallion.llm.queries import op8_bpe_round_trip

from .conftest import SF

ALPHABET = [*"ab  \n\t\r'stre.,!1²٣é漢🙂  　\u0085\x1c\x00ß-<|>", "<|endoftext|>", " the", "'ll", "don't", "ing", "\n\n", "    "]


@pytest.fixture(scope="module")
def library(tokenizer_file):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file)


@pytest.fixture(scope="module")
def own(tokenizer_file):
    return bpe.ForcedBoundaryBPE(bpe.read_spec(tokenizer_file))


def test_same_ids_and_texts_as_the_library(own, library):
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choices(ALPHABET, k=rng.randint(0, 30)))
        ids = library.encode(text, add_special_tokens=False).ids
        got = own.encode(text.encode())
        assert np.frombuffer(got, "<u4").tolist() == ids, text
        assert own.decode(got).decode() == library.decode(ids, skip_special_tokens=False)


def test_no_token_spans_a_boundary(own):
    rng = random.Random(2)
    for _ in range(500):
        data = "".join(rng.choices(ALPHABET[:-1], k=20)).encode()
        cuts = own.boundaries(data)
        for token in own.vocab:
            if len(token) > 3:
                break
            at = data.find(token)
            assert at < 0 or not any(at < c < at + len(token) for c in cuts)


def test_fragments_by_themselves(own):
    for fragment in (b"international", b"aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "été".encode()):
        cuts = [0, *own.boundaries(fragment), len(fragment)]
        assert b"".join(own._merge(fragment[a:b]) for a, b in zip(cuts, cuts[1:])) == own._merge(fragment)


def test_ids_that_end_inside_a_character(own, library):
    ids = library.encode("🙂", add_special_tokens=False).ids[:1]
    assert own.decode(np.array(ids, "<u4").tobytes()).decode() == library.decode(ids)
    assert own.decode(np.array([4_000_000], "<u4").tobytes()) == b""


def test_memo_keeps_recent_entries():
    made = []
    memo = bpe.Memo(lambda k: made.append(k) or k, limit=2)
    assert [memo[k] for k in (1, 2, 3, 1, 3)] == [1, 2, 3, 1, 3]
    assert made == [1, 2, 3] and len(memo) <= 2


def test_odd_rows(odd_docs, no_docs, tokenizer_file, library):
    got = bpe.round_trip(odd_docs, tokenizer_file).collect()
    want = sorted((r["doc_id"] or -1, len(library.encode(r["text"] or "", add_special_tokens=False).ids),
                   hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in odd_docs.collect())
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["decoded_sha256"]) for r in got) == want
    assert bpe.round_trip(no_docs, tokenizer_file).count() == 0
    assert bpe.encode_documents(no_docs, tokenizer_file).columns == ["doc_id", "ids"]


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        bpe.ForcedBoundaryBPE('{"model": {"type": "WordPiece"}, "added_tokens": []}')


def test_query(spark, document_rows, library):
    got = {r["doc_id"]: r for r in op8_bpe_round_trip(spark, SF).collect()}
    assert len(got) == len(document_rows)
    for r in document_rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        row = got[r["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_long_fragments_have_the_library_s_ids(own, library):
    """Runs of one letter, of a few, and of anything: the heap and the plain way agree with the library."""
    rng = random.Random(7)
    texts = ["a" * 5000, "-" * 3000, "=" * 777, "\n" * 4000, " " * 3000, "ab" * 2000, "the" * 900, "é" * 1500, "9" * 2000, "aB3" * 1000]
    texts += ["".join(rng.choices("abcdefgh", k=rng.randrange(60, 400))) for _ in range(60)] + ["".join(rng.choices("ab", k=300)) for _ in range(20)]
    for text in texts:
        assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text[:30]


def test_very_long_runs_take_n_log_n(own, library):
    import time

    took = {}
    for char in "a-=\n":
        for n in (16_000, 64_000):
            began = time.perf_counter()
            ids = own.encode((char * n).encode())
            took[char, n] = time.perf_counter() - began
            assert own.decode(ids) == (char * n).encode()
        assert took[char, 64_000] < 10 * took[char, 16_000] + 0.1
    began = time.perf_counter()
    ids = own.encode(b"a" * 1_000_000)
    assert time.perf_counter() - began < 30
    assert np.frombuffer(ids, "<u4").tolist() == library.encode("a" * 1_000_000, add_special_tokens=False).ids
    assert max(map(len, own._fragment), default=0) <= bpe.MEMO_BYTES and max(map(len, own._piece), default=0) <= bpe.MEMO_BYTES
