import hashlib
import shutil
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from medallion.llm import decontaminate, langid

from .conftest import SF
from .test_decontaminate import brute
from .test_simhash import classes, plain_fingerprint

REPO = Path(corpus_pipeline.__file__).parent


@pytest.fixture(scope="module")
def stages(spark, documents, tmp_path_factory):
    """Every stage's input and output rows, written and read between the stages."""
    folder, docs, out = tmp_path_factory.mktemp("pipeline"), documents, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        after = spark.read.parquet(str(folder / name))
        out[name] = (docs.collect(), after.collect(), docs.columns, after.columns)
        docs = after
    return out


def test_order_and_columns(stages, documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "simhash_dedup", "decontamination", "bpe_encoding"]
    assert all(after == documents.columns for name, (*_, after) in stages.items() if name != "bpe_encoding")


def test_only_letterless_documents_go_by_language(stages):
    before, after, *_ = stages["language_id"]
    assert sorted(map(tuple, after)) == sorted(tuple(r) for r in before if langid.has_letter((r["text"] or "").encode()))


def test_toxic_labels_go_and_clean_ones_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.toxicity_filter(spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
    gone = [y for i, y in labels.items() if i not in kept]
    assert sum(gone) >= 0.6 * sum(labels.values()) and len(gone) - sum(gone) <= 0.01 * len(labels)


def test_one_document_of_each_group(stages):
    before, after, *_ = stages["simhash_dedup"]
    before = sorted(before, key=lambda r: r["doc_id"])
    label = classes(np.array([plain_fingerprint(r["text"]) for r in before], np.uint64), 3)
    assert sorted(map(tuple, after)) == sorted(tuple(r) for i, r in enumerate(before) if label[i] == i)


def test_no_window_is_left(spark, stages):
    items = [(str(r["item_id"]), decontaminate.words_of((r["text"] or "").encode())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after, *_ = stages["decontamination"]
    kept = {r["doc_id"]: r for r in after}
    touched = 0
    for r in before:
        words = decontaminate.words_of(r["text"].encode())
        hit, _ = brute(words, items, decontaminate.WINDOW)
        if not hit:
            assert kept[r["doc_id"]] == r
        elif r["doc_id"] in kept:
            new = kept[r["doc_id"]]
            touched += 1
            assert not brute(decontaminate.words_of(new["text"].encode()), items, decontaminate.WINDOW)[0]
            assert new["n_chars"] == len(new["text"]) < len(r["text"])
        else:
            assert len(hit) > 0.8 * len(words)
    assert touched


def test_last_stage_and_run(spark, stages, tokenizer_file):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file)
    before, after, *_ = stages["bpe_encoding"]
    want = []
    for r in before:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()))
    assert sorted(map(tuple, after)) == sorted(want)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(want)


def test_odd_rows_and_no_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        rows = docs
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SF)
            rows = spark.createDataFrame(rows.collect(), rows.schema)
        assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows.count() == 0


def test_entry_without_these_folders(tmp_path):
    """The rest imports and registers its queries when the pipeline and the llm folders are gone."""
    for name in ("medallion", "__spark_entry__.py"):
        source = REPO / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    count, any_llm = said.stdout.split()
    assert int(count) >= 60 and any_llm == "False"
