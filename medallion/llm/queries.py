"""The registered queries of the training-data operators: thin digests of their outputs.

Every query applies its operator to the whole of its table.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import bpe, collocations, decontaminate, fingerprint, hilbert, html_text, langid, pitman_yor, planes, reversed_search, secret_scan, simhash, toxicity
from medallion.llm.common import crc_mod, table

#: Folder of the public tokenizer files; a parameter of the operators that use them.
TOKENIZER_DIR = os.environ.get("MEDALLION_TOKENIZERS", "")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    if TOKENIZER_DIR:
        return os.path.join(TOKENIZER_DIR, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids written as shuffled byte planes and read back."""
    _, digests = planes.encode_to_files(table(spark, sf_dir, "documents"), tokenizer_path())
    return digests.withColumnRenamed("doc", "doc_id")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items, and those items."""
    found = decontaminate.match_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a recurrent network that never saw the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, crc_mod(docs["doc_id"], 5) != 0)
    return langid.identify(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate group of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of equal row counts along a Hilbert curve."""
    found = hilbert.assign_shards(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a conditional random field that never saw the held-out third."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_mod(docs["doc_id"], 3) != 1)
    return toxicity.score_documents(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted", "spans")


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forced-boundary byte-level BPE of every text, and its decoded text."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a Pitman-Yor model that never saw the held-out seventh."""
    docs = table(spark, sf_dir, "documents")
    found = pitman_yor.score_documents(docs, crc_mod(docs["doc_id"], 7) == 2)
    return found.select("doc_id", (crc_mod(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_prefix_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polynomial fingerprint of every document and of its edited text, and their likeness."""
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of every language, from count streams in prefix and suffix order."""
    found = collocations.collocations(table(spark, sf_dir, "documents"))
    return found.withColumn("score", F.col("score").cast("bigint"))  # at most 1,000,000: a part occurs as often as the whole


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the fixed patterns and strings of high entropy."""
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op13_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item, searched from the items' side."""
    return reversed_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_planes": op1_token_planes,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_simhash": op4_simhash,
    "op5_html_text": op5_html_text,
    "op6_hilbert_shards": op6_hilbert_shards,
    "op7_toxicity": op7_toxicity,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_pitman_yor": op9_pitman_yor,
    "op10_prefix_hashes": op10_prefix_hashes,
    "op11_collocations": op11_collocations,
    "op12_secret_scan": op12_secret_scan,
    "op13_reversed_search": op13_reversed_search,
}
#: Every window of ten item words (or the whole shorter item) is looked up among the documents' windows of that length.
OP2_SQL = r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
grams AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM low, ks WHERE len(w) >= k)),
hit AS (SELECT doc_id, i, win.k, item_id FROM grams JOIN win ON grams.k = win.k AND grams.g = win.g),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS names FROM hit WHERE item_id IS NOT NULL GROUP BY doc_id)
SELECT low.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(names), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(names, ','), '')) AS items_sha256,
       coalesce(n, 0) > 0 AS contaminated
FROM low LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: Every phrase of one to four words counted whole; cuts and longer phrases by joins.
OP11_SQL = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
grams AS (SELECT lang, w[i:i + k - 1] AS g
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS n FROM grams GROUP BY lang, phrase),
total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE len(g) = 1 GROUP BY lang),
candidate AS (SELECT * FROM f WHERE len(g) > 1 AND n >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.n AS a, k, h.n AS l, t.n AS r, CAST((CAST(2000000 AS HUGEINT) * c.n) // (h.n + t.n) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM candidate) c
  JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(c.g[:k], ' ')
  JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(c.g[k + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT c.lang, c.phrase
  FROM (SELECT lang, n, array_to_string(g[i:i + k - 1], ' ') AS part
        FROM (SELECT lang, n, g, k, unnest(range(1, len(g) - k + 2)) AS i FROM candidate, (SELECT unnest([2, 3]) AS k) WHERE len(g) > k)) x
  JOIN candidate c ON c.lang = x.lang AND c.phrase = x.part WHERE 100 * x.n >= 80 * c.n),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, total.n, score
  FROM lowest JOIN total USING (lang) WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM inside))
SELECT * FROM ranked WHERE rank <= 2000
"""

#: Term counts of all documents, joined to the items' terms with their repeats.
OP13_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w,
         row_number() OVER () AS r
  FROM documents WHERE text IS NOT NULL),
items AS (
  SELECT item_id, r, t, count(*) AS times
  FROM (SELECT item_id, r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
        FROM (SELECT *, row_number() OVER () AS r FROM benchmark WHERE text IS NOT NULL))
  GROUP BY ALL),
total AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM docs WHERE len(w) > 0),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY ALL),
df AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM tf, total GROUP BY t, big_n),
gain AS (
  SELECT r, t, df.weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(w) * big_n) // big_l))) AS gain
  FROM tf JOIN docs USING (r) JOIN df USING (t), total),
scored AS (
  SELECT item_id, items.r AS item, gain.r AS doc, CAST(sum(times * gain) AS BIGINT) AS score
  FROM gain JOIN items USING (t) GROUP BY ALL HAVING sum(times * gain) > 0),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM scored JOIN docs ON docs.r = scored.doc)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

def _matches_sql(regex: str, group: int, least: int) -> str:
    """Row, place and value of every match: running sums of what lies between the matches and of the matches."""
    quoted = regex.replace("'", "''")
    return f"""SELECT r, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY r ORDER BY i) - length(m) AS BIGINT) AS start,
         CAST(sum(length(gap) + length(m)) OVER (PARTITION BY r ORDER BY i) AS BIGINT) AS stop, v, length(v) >= {least} AS kept
  FROM (SELECT r, unnest(gaps[:len(ms)]) AS gap, unnest(ms) AS m, unnest(vs) AS v, unnest(range(len(ms))) AS i
        FROM (SELECT r, string_split_regex(text, '{quoted}') AS gaps, regexp_extract_all(text, '{quoted}', 0) AS ms,
                     regexp_extract_all(text, '{quoted}', {group}) AS vs FROM t))"""


def _entropy_sql(chars: secret_scan.CharacterClass, allowed: tuple[str, ...]) -> str:
    """United windows of a class's runs outside allow-listed matches, every window's entropy from its own character counts."""
    grown = secret_scan.steps(chars.window)
    sums = [sum(grown[:c + 1]) for c in range(chars.window + 1)]
    cut = secret_scan.any_of(allowed)
    return f"""
  SELECT r, start + min(q) AS start, start + max(q) + {chars.window} AS stop
  FROM (SELECT *, sum(CASE WHEN q <= before + {chars.window} THEN 0 ELSE 1 END) OVER (PARTITION BY r, start ORDER BY q) AS island
        FROM (SELECT *, lag(q) OVER (PARTITION BY r, start ORDER BY q) AS before
              FROM (SELECT r, start, q
                    FROM (SELECT r, start, q, count(*) AS c
                          FROM (SELECT r, start, q, unnest(string_split(substring(run, q + 1, {chars.window}), '')) AS letter
                                FROM (SELECT r, start, run, unnest(range(length(run) - {chars.window - 1})) AS q
                                      FROM (SELECT r, run, CAST(place + sum(length(run) + coalesce(length(cut), 0)) OVER (PARTITION BY r, place ORDER BY i)
                                                   - length(run) - coalesce(length(cut), 0) AS BIGINT) AS start
                                            FROM (SELECT r, place, unnest(parts) AS run, unnest(list_resize(cuts, len(parts))) AS cut, unnest(range(len(parts))) AS i
                                                  FROM (SELECT r, start AS place, string_split_regex(v, '{cut}') AS parts, regexp_extract_all(v, '{cut}') AS cuts
                                                        FROM ({_matches_sql("(" + chars.regex + ")", 1, chars.window)}))))
                                      WHERE length(run) >= {chars.window}))
                          GROUP BY r, start, q, letter)
                    GROUP BY r, start, q HAVING sum({sums}[c + 1]) <= {chars.most})))
  GROUP BY r, start, island"""


def _op12_sql() -> str:
    base = [(p.kind, f"SELECT r, start, stop FROM ({_matches_sql(p.regex, p.group, p.least)}) WHERE kept") for p in secret_scan.PATTERNS]
    more = [(c.kind, _entropy_sql(c, secret_scan.ALLOWED)) for c in secret_scan.CLASSES]
    union = " UNION ALL ".join(f"SELECT r, start, stop, '{kind}' AS kind, {rank} AS rank FROM ({sql})" for rank, (kind, sql) in enumerate(base + more))
    counts = ", ".join(f"count(kind) FILTER (kind = '{p.kind}') AS n_{p.kind}" for p in secret_scan.PATTERNS)
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({union}),
said AS (SELECT *, kind || ':' || start || ':' || stop AS span FROM spans)
SELECT any_value(doc_id) AS doc_id, {counts},
       sha256(coalesce(string_agg(span, ',' ORDER BY start, rank, stop) FILTER (rank < {len(base)}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, rank, stop), '') AS spans
FROM t LEFT JOIN said USING (r) GROUP BY r
"""


ORACLES: dict[str, str] = {"op2_decontamination": OP2_SQL, "op11_collocations": OP11_SQL, "op12_secret_scan": _op12_sql(), "op13_reversed_search": OP13_SQL}
