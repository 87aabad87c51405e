import hashlib
import os.path
import random

import pytest

from medallion.llm import fingerprint as P
from medallion.llm.queries import op10_prefix_hashes

from .conftest import SF


def prefixes(text):
    return P.Prefixes(P.code_points((text or "").encode()))


def test_spans_and_extensions():
    rng = random.Random(2)
    for _ in range(400):
        a, b = ("".join(rng.choices("ab🙂", k=rng.randint(0, 30))) for _ in range(2))
        x, y, i, j = prefixes(a), prefixes(b), rng.randint(0, len(a)), rng.randint(0, len(b))
        n = len(os.path.commonprefix([a[i:], b[j:]]))
        assert P.common_extension(x, i, y, j) == n
        assert P.common_extension(x, i, y, j, backwards=True) == len(os.path.commonprefix([a[:i][::-1], b[:j][::-1]]))
        k = rng.randint(0, min(len(a) - i, len(b) - j))
        assert P.spans_equal(x, i, y, j, k) == (a[i:i + k] == b[j:j + k])


def test_replaced_tail_is_the_same_as_anew():
    x = prefixes("abcdefghij🙂")
    y = x.replaced_tail(7, P.code_points("xyz".encode()))
    assert y.text() == b"abcdefgxyz" and y.fingerprint() == prefixes("abcdefgxyz").fingerprint()


def test_zeros_and_lengths_count():
    texts = ["", "\x00", "\x00\x00", "a", "aa", "ab", "ba"]
    assert len({prefixes(t).fingerprint() for t in texts}) == len(texts)


def plain_likeness(a, b):
    if a == b:
        return 1.0
    head, tail = len(os.path.commonprefix([a, b])), len(os.path.commonprefix([a[::-1], b[::-1]]))
    return min(head + tail, min(len(a), len(b))) / max(len(a), len(b))


def like(a, b):
    return P.likeness(prefixes(a), prefixes(b))


def test_likeness_goes_on_past_differences():
    rng = random.Random(5)
    text = "".join(rng.choices("abcdefghij klmnop\u00e9\U0001f600", k=10_000))
    assert like(text, "#" + text[1:-1] + "#") == 9_998 / 10_000
    edits = list(text)
    for at in (0, 1_500, 4_000, 4_200, 7_777, 9_999):
        edits[at] = "#"
    assert like(text, "".join(edits)) == like("".join(edits), text) == 9_994 / 10_000
    assert like(text, "#" + text[:3_000] + "##" + text[3_000:6_000] + text[6_001:] + "#") == 9_999 / 10_003
    assert like(text, "#" + text[5_000:] + text[:5_000] + "#") >= 9_990 / 10_002  # halves in the other order


def test_likeness_counts_no_code_point_twice():
    least = 200 - P.ANCHOR - P.STEP + 2  # periodic text may be aligned a few periods off
    assert least / 1_002 <= like("#" + "ab" * 100 + "#", "!" + "ab" * 500 + "!") <= 200 / 1_002
    assert least / 1_002 <= like("#" + "ab" * 500 + "#", "!" + "ab" * 100 + "!") <= 200 / 1_002
    block = "".join(random.Random(6).choices("abcdefgh", k=100))
    assert like("#" + block + "#", "!" + block + "?" + block + "?" + block + "!") == 100 / 304
    assert like("x" * 5_000, "y" * 5_000) == 0


def expected(rows):
    out = []
    for k, (key, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1] or ""
        text = text or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), prefixes(text).fingerprint(), prefixes(edited).fingerprint(),
                    plain_likeness(text, edited), plain_likeness(text, following)))
    return out


def test_query(spark, document_rows):
    rows = sorted(((r["doc_id"], r["text"]) for r in document_rows), reverse=True)
    assert sorted(map(tuple, op10_prefix_hashes(spark, SF).collect())) == sorted(expected(rows))


@pytest.mark.parametrize("partitions", [1, 2, 40])
def test_odd_rows(odd_docs, no_docs, partitions):
    rows = sorted(((r["doc_id"], r["text"]) for r in odd_docs.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    got = P.fingerprints(odd_docs, partitions=partitions).collect()
    key = lambda r: (r[0] or -1, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(expected(rows), key=key)
    assert P.fingerprints(no_docs, partitions=partitions).count() == 0


def test_one_document(spark):
    for text in ("abcdef", "", None):
        docs = spark.createDataFrame([(5, text)], "doc_id bigint, text string")
        assert [tuple(r) for r in P.fingerprints(docs).collect()] == expected([(5, text)])


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_ids_that_are_texts(spark, document_rows, partitions):
    rows = [(f"doc-{r['doc_id'] * 7919 % 1000:x}é", r["text"]) for r in document_rows] + [(None, "no id"), ("", "empty id")]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(5)
    got = P.fingerprints(docs, partitions=partitions).collect()
    want = expected(sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode()), reverse=True))
    got, want = (sorted(map(tuple, x), key=repr) for x in (got, want))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):  # both ends count at least; what is equal in the middle may add to them
        assert b[5] <= a[5] <= 1 and b[6] <= a[6] <= 1


def test_middle_part_against_the_longest_common_blocks():
    """Likeness of edited copies is close to what the standard library's matching blocks of 64 and more give."""
    from difflib import SequenceMatcher

    rng = random.Random(8)
    for _ in range(30):
        a = "".join(rng.choices("abcdefghijklmnop ", k=rng.randrange(400, 1500)))
        b = list(a)
        for _ in range(rng.randrange(1, 5)):
            at = rng.randrange(len(b))
            b[at:at + rng.randrange(0, 4)] = rng.choices("xyz", k=rng.randrange(0, 4))
        b = "".join(b)
        blocks = SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()
        sure = sum(m.size for m in blocks if m.size >= P.ANCHOR + P.STEP - 1) / max(len(a), len(b))
        most = sum(m.size for m in blocks) / max(len(a), len(b))
        assert sure - 0.01 <= like(a, b) <= most + 0.01
