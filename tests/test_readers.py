"""Readers and ingestion on the dirt that loses or garbles text: quotes, surplus fields, UTF-16, NULs, changed headers."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medallion.contracts import INSTITUTIONS
from medallion.sources import charset, delimited
from medallion.streaming.ingest import run_once


def put(root, name, data):
    path = os.path.join(str(root), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode("utf-8"))


def test_doubled_quotes_and_separators_inside_values(spark, tmp_path):
    put(tmp_path, "a.csv", 'A;B\n"a ""b;c"" d";1\nplain;2\n')
    got = {(r["A"], r["B"]) for r in delimited.read_folder(spark, str(tmp_path), sep=";").collect()}
    assert got == {('a "b;c" d', "1"), ("plain", "2")}
    assert ('a "b;c" d', "1") in {tuple(r) for r in delimited.read_delimited(spark, str(tmp_path), sep=";").collect()}


def test_quoted_headers(spark, tmp_path):
    put(tmp_path, "a.csv", '﻿"A;1";B;;B\n1;2;3;4\n')
    df = delimited.read_folder(spark, str(tmp_path), sep=";", source_column=None, malformed_column=None)
    assert df.columns == ["A;1", "B", "B3"] and tuple(df.first()) == ("1", "2", "4")


@pytest.mark.parametrize("schema", [None, "A string, B string"])
def test_one_scan_keeps_or_refuses_surplus_and_missing_fields(spark, tmp_path, schema):
    put(tmp_path, "a.csv", "A;B\na;1;extra\nb\nc;3\n")
    schema = schema and StructType.fromDDL(schema)
    options = {"sep": ";", "schema": schema, "infer_schema": schema is None}
    df = delimited.read_delimited(spark, str(tmp_path), malformed_column=delimited.MALFORMED, **options)
    got = {r["A"]: (r["B"] and str(r["B"]), r[delimited.MALFORMED]) for r in df.collect()}
    assert got == {"a": ("1", "a;1;extra"), "b": (None, "b"), "c": ("3", None)}
    assert dict(df.dtypes)["B"] == ("int" if schema is None else "string")
    assert {r["A"] for r in df.where(F.col(delimited.MALFORMED).isNotNull()).select("A").collect()} == {"a", "b"}
    with pytest.raises(Exception, match="(?i)malformed"):
        delimited.read_delimited(spark, str(tmp_path), **options).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        delimited.read_delimited(spark, str(tmp_path), **options).select("A").collect()


def test_surplus_and_missing_fields_keep_their_line(spark, tmp_path):
    put(tmp_path, "a.csv", "A;B\na;1;extra\nb\nc;3\n")
    df = delimited.read_folder(spark, str(tmp_path), sep=";")
    got = {r["A"]: (r["B"], r[delimited.MALFORMED]) for r in df.collect()}
    assert got == {"a": ("1", "a;1;extra"), "b": (None, "b"), "c": ("3", None)}
    audit = delimited.malformed_rows(df).first()
    assert (audit["source_file"], audit["total"], audit["malformed"]) == ("a.csv", 3, 2)


def test_headers_of_any_length(spark, tmp_path):
    names = [f"column {i} " + "x" * 40 for i in range(3000)]  # over 64 KiB
    put(tmp_path, "a.csv", ";".join(names) + "\n" + ";".join(map(str, range(3000))) + "\n")
    df = delimited.read_folder(spark, str(tmp_path), sep=";", source_column=None, malformed_column=None)
    assert df.columns == [n.strip() for n in names]
    assert df.select(F.col(f"`{names[-1].strip()}`")).first()[0] == "2999"


@pytest.mark.parametrize("encoding", ["utf-16", "utf-16-le", "utf-16-be"])
def test_utf16_is_read_back(spark, tmp_path, encoding):
    put(tmp_path, "a.csv", "Nome;Índice\nAção;1,5\nPão – doce;2\n".encode(encoding))
    put(tmp_path, "b.csv", "Índice;Nome\n3;x\n")
    got = {(r["Nome"], r["Índice"]) for r in delimited.read_folder(spark, str(tmp_path), sep=";", encoding="auto").collect()}
    assert got == {("Ação", "1,5"), ("Pão – doce", "2"), ("x", "3")}


def test_one_nul_does_not_make_utf16(spark, tmp_path):
    put(tmp_path, "a.csv", "Nome;N\nAção com um \x00 dentro;1\n")
    labels = [r["encoding"] for r in charset.encoding_audit(spark, str(tmp_path)).collect()]
    assert labels == ["utf-8"]
    df = delimited.read_folder(spark, str(tmp_path), sep=";", encoding="auto")
    assert df.first()["Nome"] == "Ação com um \x00 dentro"


def test_only_distinct_headers_reach_the_driver(spark, tmp_path, monkeypatch):
    """Several hundred files in two header groups, in one folder: two rows are collected."""
    for i in range(300):
        put(tmp_path, f"f{i:03}.csv", f"A;B\n{i};a\n" if i % 3 else f"B;A\na;{i}\n")
    frame, rows = type(spark.range(1)), []
    collect = frame.collect

    def counted(self):
        out = collect(self)
        rows.append(len(out))
        return out

    monkeypatch.setattr(frame, "collect", counted)
    df = delimited.read_folder(spark, str(tmp_path), sep=";")
    assert rows == [2]
    monkeypatch.undo()
    assert {(r["A"], r["B"]) for r in df.collect()} == {(str(i), "a") for i in range(300)}


def test_uniform_folders_are_scanned_as_folders(spark, tmp_path):
    put(tmp_path, "x/a.csv", "A;B\n1;a\n")
    put(tmp_path, "x/b.csv", "A;B\n2;b\n")
    put(tmp_path, "y/c.csv", "B;A\nc;3\n")
    put(tmp_path, "with space/d.csv", "A;B\n4;d\n")
    df = delimited.read_folder(spark, str(tmp_path), sep=";")
    assert {(r["A"], r["B"], r["source_file"]) for r in df.collect()} == {("1", "a", "a.csv"), ("2", "b", "b.csv"), ("3", "c", "c.csv"), ("4", "d", "d.csv")}
    assert "LeftSemi" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_empty_folder_is_an_error(spark, tmp_path):
    put(tmp_path, "empty.csv", "")
    with pytest.raises(FileNotFoundError):
        delimited.read_folder(spark, str(tmp_path), sep=";")


def test_ingest_matches_columns_by_name(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / x) for x in ("landing", "raw", "checkpoint"))
    put(landing, "a.tsv", "Segmento\tCNPJ\tNome\nS1\t1\tBANK A\n")
    run_once(spark, landing, INSTITUTIONS, target, checkpoint)
    put(landing, "b.tsv", "Nome\tCNPJ\tSegmento\nBANK B\t2\tS2\n")
    put(landing, "c.tsv", "Segmento\tCNPJ\tNome\nS3\t3\tBANK C\n")
    run_once(spark, landing, INSTITUTIONS, target, checkpoint)
    run_once(spark, landing, INSTITUTIONS, target, checkpoint)
    got = {(r["Segmento"], r["CNPJ"], r["Nome"], r["source_file"]) for r in spark.read.parquet(target).collect()}
    assert got == {("S1", "1", "BANK A", "a.tsv"), ("S2", "2", "BANK B", "b.tsv"), ("S3", "3", "BANK C", "c.tsv")}


def test_ingest_refuses_unknown_columns_before_writing(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / x) for x in ("landing", "raw", "checkpoint"))
    put(landing, "a.tsv", "Segmento\tCNPJ\tNome\tNovo\nS1\t1\tBANK A\tx\n")
    with pytest.raises(Exception, match="Novo"):
        run_once(spark, landing, INSTITUTIONS, target, checkpoint)
    assert not os.path.exists(target)
    # the file is not lost: the next run meets it again
    put(landing, "a.tsv", "Segmento\tCNPJ\tNome\nS1\t1\tBANK A\n")
    run_once(spark, landing, INSTITUTIONS, target, checkpoint)
    assert spark.read.parquet(target).count() == 1
