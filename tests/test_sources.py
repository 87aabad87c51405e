"""Contract tests: mini files in a fresh temp folder, cp1252/UTF-8, swapped headers, trailing ';'."""

import os
import tempfile

from medallion.contracts import CLAIMS
from medallion.sources import charset, delimited
from medallion.sinks.jdbc import contract_column_types, create_table_column_types, jdbc_write_options
from medallion.sources.jdbc import jdbc_read_options


def write(path, text, encoding):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))


def test_swapped_headers_keep_values_with_names(spark):
    root = tempfile.mkdtemp(prefix="md-swap-")
    write(f"{root}/a/one.csv", "A;B\n1;x\n2;y\n", "utf-8")
    write(f"{root}/a/two.csv", "B;A\nz;3\n", "utf-8")
    df = delimited.read_folder(spark, f"{root}/a", sep=";")
    got = sorted((r["A"], r["B"]) for r in df.collect())
    assert got == [("1", "x"), ("2", "y"), ("3", "z")]


def test_cp1252_claims_header_and_trailing_separator(spark):
    root = tempfile.mkdtemp(prefix="md-cp1252-")
    header = ";".join(CLAIMS.raw_names) + ";\n"
    row = "2023;4º;Cat;Tipo; ;BANCO (conglomerado);1.234,50;1;2;3;6; ; ;7;\n"
    write(f"{root}/claims/q4.csv", header + row, "cp1252")
    df = delimited.read_contract(spark, f"{root}/claims", CLAIMS)
    assert df.columns[: len(CLAIMS.raw_names)] == CLAIMS.raw_names
    r = df.first()
    assert r["Trimestre"] == "4º" and r["CNPJ IF"] == " "
    audit = {x["file_name"]: x["encoding"] for x in charset.encoding_audit(spark, f"{root}/claims").collect()}
    assert audit == {"q4.csv": "windows-1252"}


def test_union_by_name_fills_missing(spark):
    root = tempfile.mkdtemp(prefix="md-union-")
    write(f"{root}/p/v2.csv", "Nome|Segmento\nA|S1\n", "utf-8")
    write(f"{root}/p/less.csv", "Nome|CNPJ\nB|123\n", "utf-8")
    df = delimited.read_folder(spark, f"{root}/p", sep="|")
    rows = {r["Nome"]: (r["Segmento"], r["CNPJ"]) for r in df.collect()}
    assert rows == {"A": ("S1", None), "B": (None, "123")}


def test_jdbc_options_are_partitioned_and_batched():
    r = jdbc_read_options("jdbc:x", "t", partition_column="id", lower_bound=0, upper_bound=100, num_partitions=4)
    assert r["numPartitions"] == "4" and r["partitionColumn"] == "id"
    w = jdbc_write_options("jdbc:x", "t", batch_size=500, num_partitions=8,
                           column_types={"cnpj": "VARCHAR(8)"})
    assert w["batchsize"] == "500" and w["truncate"] == "true"
    assert w["createTableColumnTypes"] == create_table_column_types({"cnpj": "VARCHAR(8)"})


def test_pick_file_by_glob_and_infer_schema(spark):
    root = tempfile.mkdtemp(prefix="md-glob-")
    write(f"{root}/f/a.csv", "x|y\n1|2.5\n", "utf-8")
    write(f"{root}/f/b.txt", "x|y\n9|9\n", "utf-8")
    df = delimited.read_delimited(spark, f"{root}/f", sep="|", glob="*.csv", infer_schema=True)
    assert [tuple(r) for r in df.collect()] == [(1, 2.5)]
    assert dict(df.dtypes) == {"x": "int", "y": "double"}


def test_object_store_layout_is_plain_uri():
    from medallion.sources.parquet import layer_path
    assert layer_path("s3a://bucket/lake/", "trusted", "claims") == "s3a://bucket/lake/trusted/claims"


def test_incremental_ingest_takes_each_file_once(spark):
    from medallion.contracts import INSTITUTIONS
    from medallion.streaming.ingest import run_once

    root = tempfile.mkdtemp(prefix="md-stream-")
    landing, target, ckpt = f"{root}/landing", f"{root}/raw", f"{root}/_ckpt"
    write(f"{landing}/a.tsv", "Segmento\tCNPJ\tNome\nS1\t1\tA\n", "utf-8")
    run_once(spark, landing, INSTITUTIONS, target, ckpt)
    run_once(spark, landing, INSTITUTIONS, target, ckpt)          # nothing new: no rows added
    write(f"{landing}/b.tsv", "Segmento\tCNPJ\tNome\nS2\t2\tB\nS3\t3\tC\n", "utf-8")
    run_once(spark, landing, INSTITUTIONS, target, ckpt)
    rows = spark.read.parquet(target)
    assert rows.count() == 3
    assert sorted(r["source_file"] for r in rows.collect()) == ["a.tsv", "b.tsv", "b.tsv"]


def test_contract_column_types():
    from medallion.contracts import CLAIMS
    types = contract_column_types(CLAIMS)
    assert types["cnpj"] == "VARCHAR(8)" and types["bank_index"] == "DOUBLE"
    assert types["quarter_claim"] == "INT" and types["total_number_of_complaints"] == "BIGINT"
    assert "cnpj VARCHAR(8)" in create_table_column_types(types)


def test_encoding_audit_labels(spark):
    root = tempfile.mkdtemp(prefix="md-enc-")
    write(f"{root}/e/ascii.txt", "plain text\n", "ascii")
    write(f"{root}/e/utf8.txt", "ação\n", "utf-8")
    write(f"{root}/e/latin1.txt", "ação\n", "latin-1")
    write(f"{root}/e/cp1252.txt", "a – b\n", "cp1252")
    write(f"{root}/e/utf16.txt", "ação\nx\n", "utf-16")
    got = {r["file_name"]: (r["encoding"], r["spark_charset"]) for r in charset.encoding_audit(spark, f"{root}/e").collect()}
    assert got == {
        "ascii.txt": ("ascii", "UTF-8"), "utf8.txt": ("utf-8", "UTF-8"),
        "latin1.txt": ("iso-8859-1", "ISO-8859-1"), "cp1252.txt": ("windows-1252", "ISO-8859-1"),
        "utf16.txt": ("utf-16", "UTF-16"),
    }


def test_read_folder_auto_encoding(spark):
    root = tempfile.mkdtemp(prefix="md-auto-")
    write(f"{root}/c/a.csv", "Nome;Índice\nAção;1,5\n", "utf-8")
    write(f"{root}/c/b.csv", "Índice;Nome\n2,5;Pão – doce\n", "cp1252")
    df = delimited.read_folder(spark, f"{root}/c", sep=";", encoding="auto")
    got = sorted((r["Nome"], r["Índice"]) for r in df.collect())
    assert got == [("Ação", "1,5"), ("Pão – doce", "2,5")]


def test_confidence_of_encodings(spark, tmp_path):
    """Text is sure of its own charset unless others read it alike; another charset's text is not."""
    text = "Instituição financeira: São Paulo, operações à vista – não há dúvida.\nÍndice de reclamações\n"
    latin = text.replace("–", "-")
    cases = {
        "ascii": (b"plain\ntext\n", "ascii", 1.0, 1.0), "empty": (b"\n", "ascii", 1.0, 1.0),
        "utf8": (text.encode(), "utf-8", 0.999, 1.0), "one": ("não\n".encode(), "utf-8", 0.9, 1.0),
        "cp1252": (text.encode("cp1252"), "windows-1252", 0.95, 1.0),
        "latin1": (latin.encode("latin-1"), "iso-8859-1", 0.3, 0.34),
        "cp850": (latin.encode("cp850"), "windows-1252", 0.0, 0.01), "mac": (latin.encode("mac_roman"), "windows-1252", 0.0, 0.01),
        "utf16": (text.encode("utf-16"), "utf-16", 1.0, 1.0), "utf16le": (text.encode("utf-16-le"), "utf-16le", 0.8, 1.0),
        "broken": ("São".encode()[:-1] + b" x" + "é".encode()[:1] + b"\n", "iso-8859-1", 0.0, 1.0),
    }
    for name, (data, *_) in cases.items():
        (tmp_path / name).write_bytes(data)
    got = {r["file_name"]: (r["encoding"], r["confidence"]) for r in charset.encoding_audit(spark, str(tmp_path)).collect()}
    assert {n: e for n, (e, _) in got.items()} == {n: e for n, (_, e, _, _) in cases.items()}
    assert all(low <= got[n][1] <= high for n, (_, _, low, high) in cases.items()), got


def test_confidence_comes_from_the_same_aggregation(spark, tmp_path):
    (tmp_path / "a").write_bytes("São\n".encode())
    plan = charset.file_facts(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Join" not in plan and "Generate" not in plan
