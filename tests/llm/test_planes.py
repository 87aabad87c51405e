import random
import zlib

import numpy as np
import pytest

from medallion.llm import planes
from medallion.llm.bpe import read_spec
from medallion.llm.queries import op1_token_planes

from .conftest import SF
from .test_bpe import ALPHABET


@pytest.fixture(scope="module")
def library(tokenizer_file):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file)


@pytest.mark.parametrize("plane_bits", [1, 8])
def test_round_trip_of_chunks(plane_bits):
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 1), (7, 2), (1000, 50257), (999, 2**32 - 1), (65536, 300)):
        ids = rng.integers(0, top, n, dtype=np.uint64, endpoint=True).astype("<u4")
        payload = planes.pack_planes(ids, plane_bits)
        assert np.array_equal(planes.unpack_planes(payload), ids)
    with pytest.raises(ValueError):
        planes.unpack_planes(payload[:-1])
    with pytest.raises(ValueError):
        planes.unpack_planes(b"XXXX" + payload[4:])


def test_crc_of_parts():
    rng = random.Random(3)
    for _ in range(50):
        parts = [rng.randbytes(rng.choice([0, 1, 4, 400, 70_000])) for _ in range(rng.randint(1, 4))]
        assert planes.crc32_joined([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def test_encoder_gives_the_library_ids(tokenizer_file, library):
    own = planes.LibraryEncoder(read_spec(tokenizer_file))
    rng = random.Random(4)
    for i in range(6000):
        text = "".join(rng.choices([ALPHABET, [*"abé '.,1\n", " the", " x", "'s"]][i % 2], k=rng.randint(0, 25)))
        assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def expected(rows, library):
    out, start = [], 0
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("chunk_ids, plane_bits", [(100, 8), (1 << 16, 1)])
def test_odd_rows(odd_docs, tokenizer_file, library, chunk_ids, plane_bits):
    _, digests = planes.encode_to_files(odd_docs, tokenizer_file, chunk_ids=chunk_ids, plane_bits=plane_bits, shards=3)
    got = sorted((r["doc"] or -1, r["start"], r["n_tokens"], r["ids_crc32"]) for r in digests.collect())
    rows = sorted(((r["doc_id"] or -1, r["text"]) for r in odd_docs.collect()), key=lambda r: (r[0], r[1] or ""))
    assert got == expected(rows, library)  # the null id comes first


def test_empty_table(no_docs, tokenizer_file):
    path, digests = planes.encode_to_files(no_docs, tokenizer_file)
    assert digests.count() == 0 and digests.columns == ["doc", "start", "n_tokens", "ids_crc32"]


def test_query(spark, document_rows, library):
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in op1_token_planes(spark, SF).collect())
    assert got == expected([(r["doc_id"], r["text"]) for r in document_rows], library)
