"""Property tests: cleaners against plain-Python statements of the same rules.

Each example is a batch of generated values evaluated in one Spark job.
"""

import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion.functions import casts, text
from medallion.functions.keys import name_norm
from medallion.functions.unaccent import unaccent, unaccent_nfkd

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

ID_TEXT = st.one_of(st.none(), st.text(alphabet="0123456789 \t\xa0", max_size=12))
NUM_TEXT = st.one_of(
    st.none(),
    st.text(alphabet="0123456789.,- xe", max_size=14),
    st.decimals(min_value=-10**9, max_value=10**9, places=2, allow_nan=False).map(
        lambda d: f"{d:,.2f}".replace(",", "_").replace(".", ",").replace("_", ".")),
)
NAME_TEXT = st.one_of(st.none(), st.text(alphabet="abcXYZ Çãéíõüß\tÆøŁ-#\u0301\u0303\xa0\u2009–—’ỆừẼ", max_size=20))


def run(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["r"] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def py_pad(s):
    """An id is its characters other than blanks, zero-filled to eight; no characters, no id."""
    bare = "".join((s or "").split())
    return bare.zfill(8) if bare else None


def py_locale(s):
    if s is None:
        return None
    t = s.replace(".", "").replace(",", ".").replace(" ", "")
    if re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", t):
        return float(t)
    return None


# What a reader would type for these on an ASCII keyboard.
PLAIN = {"ß": "ss", "Æ": "AE", "ø": "o", "Ł": "L", "–": "-", "—": "-", "’": "'"}


def py_norm(s):
    """Names are equal when they are alike without accents, case and blanks."""
    if s is None:
        return None
    typed = "".join(PLAIN.get(ch, ch) for ch in s)
    bare = "".join(ch for ch in unicodedata.normalize("NFD", typed) if not unicodedata.combining(ch))
    return "".join(bare.lower().split())


@SETTINGS
@given(st.lists(ID_TEXT, min_size=1, max_size=200))
def test_pad_id_matches_rule(spark, values):
    assert run(spark, text.pad_id, values) == [py_pad(v) for v in values]


@SETTINGS
@given(st.lists(NUM_TEXT, min_size=1, max_size=200))
def test_locale_decimal_matches_rule(spark, values):
    assert run(spark, text.locale_decimal, values) == [py_locale(v) for v in values]


@SETTINGS
@given(st.lists(NAME_TEXT, min_size=1, max_size=200))
def test_name_norm_matches_rule(spark, values):
    assert run(spark, name_norm, values) == [py_norm(v) for v in values]


@SETTINGS
@given(st.lists(NAME_TEXT, min_size=1, max_size=200))
def test_nfkd_path_equals_native_path(spark, values):
    assert run(spark, unaccent_nfkd, values) == run(spark, unaccent, values)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789 x+-", max_size=10)), min_size=1, max_size=200))
def test_guarded_long_cast_equals_try_cast(spark, values):
    guarded = run(spark, casts.to_long, values)
    plain = run(spark, lambda c: F.trim(c).try_cast("bigint"), values)
    assert guarded == plain


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab.,# 0", max_size=12)), min_size=1, max_size=200))
def test_replace_first_matches_python(spark, values):
    got = run(spark, lambda c: text.regex_replace_first(c, r"\.", "_"), values)
    assert got == [None if v is None else re.sub(r"\.", "_", v, count=1) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\n\x0b\f\rc", max_size=12)), min_size=1, max_size=200))
def test_remove_whitespace_matches_java_class(spark, values):
    got = run(spark, text.remove_whitespace, values)
    assert got == [None if v is None else re.sub(r"[ \t\n\x0b\f\r]+", "", v) for v in values]
