"""Line breaks in quoted values, whatever the split size."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from medallion.contracts import CLAIMS
from medallion.plans import fixtures
from medallion.plans.queries import QUERIES
from medallion.sinks.delimited import write_delimited
from medallion.sources import quoted
from medallion.sources.delimited import MALFORMED, read_contract, read_folder

from .conftest import SF_SMALL


def plain_records(data: bytes, sep: bytes) -> list[bytes]:
    """Records of a file, one byte after another."""
    out, held, inside, field = [], bytearray(), False, True
    i = 3 if data.startswith(b"\xef\xbb\xbf") else 0
    while i < len(data):
        c = data[i:i + 1]
        if inside:
            held += c
            if c == b'"':
                if data[i + 1:i + 2] == b'"':
                    held += b'"'
                    i += 1
                else:
                    inside = False
            field = False
        elif c == b"\n":
            out.append(bytes(held))
            held, field = bytearray(), True
        else:
            inside = field and c == b'"'
            held += c
            field = bytes(held).endswith(sep)
        i += 1
    out.append(bytes(held))
    return [r for r in (r.removesuffix(b"\r") for r in out) if r.strip(b" \t\r")]


def random_file(rnd: random.Random, sep: str, rows: int) -> bytes:
    parts = ["a", "é", '""', "\n", "\r\n", sep, " ", "x" * 30, "\n\n", f"{sep}\"\"\n"]
    lines = [f'id{sep}"the\nvalue"{sep}last' if rnd.random() < 0.5 else f"id{sep}value{sep}last"]
    for i in range(rows):
        kind = rnd.random()
        if kind < 0.4:
            value = '"' + "".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 12))) + '"'
        elif kind < 0.6:
            value = f'{i}" stray "quotes'
        else:
            value = f"plain {i}"
        last = '"' + "".join(rnd.choice(parts) for _ in range(3)) + '"' if rnd.random() < 0.2 else "z"
        lines.append(f"{i}{sep}{value}{sep}{last}")
        if rnd.random() < 0.1:
            lines.append(rnd.choice(["", "  ", "\r"]))
    end = rnd.choice(["\n", "\r\n"])
    return (("﻿" if rnd.random() < 0.5 else "") + end.join(lines) + rnd.choice(["", end])).encode()


@pytest.mark.parametrize("seed", range(4))
def test_records_do_not_depend_on_splits(spark, tmp_path, seed):
    rnd = random.Random(seed)
    sep = rnd.choice([";", "|", "\t"])
    files = {f"f{i}.csv": random_file(rnd, sep, rnd.choice([0, 3, 60])) for i in range(4)}
    files["empty.csv"], files["blank.csv"] = b"", b"\n\r\n \n"
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    want = sorted((name, r, i == 0, True) for name, data in files.items() for i, r in enumerate(plain_records(data, sep.encode())))
    for split_bytes in (1 << 20, 300, 70):
        got = quoted.records(spark, str(tmp_path), sep, split_bytes=split_bytes).collect()
        assert sorted((r["path"].rsplit("/", 1)[1], bytes(r["record"]), r["header"], r["closed"]) for r in got) == want, split_bytes


def test_values_are_what_a_csv_reader_gives(spark, tmp_path):
    rnd = random.Random(9)
    rows = [(str(i), "".join(rnd.choice(["a", '"', "\n", ";", "\r\n", "é"]) for _ in range(rnd.randrange(1, 9))), "t") for i in range(300)]
    out = io.StringIO(newline="")
    writer = csv.writer(out, delimiter=";", lineterminator="\n")
    writer.writerows([("id", "value", "last"), *rows])
    (tmp_path / "a.csv").write_text(out.getvalue(), newline="")
    df = read_folder(spark, str(tmp_path), sep=";", multiline=True, split_bytes=64)
    assert df.columns == ["id", "value", "last", MALFORMED, "source_file"]
    assert sorted(map(tuple, df.collect())) == sorted((*r, None, "a.csv") for r in rows)
    assert df.select("id").distinct().count() == len(rows)


def test_one_record_over_many_splits(spark, tmp_path):
    long = "line\n" * 400
    (tmp_path / "a.csv").write_text(f'id;v\n1;"{long}"\n2;x\n')
    df = read_folder(spark, str(tmp_path), sep=";", multiline=True, split_bytes=100)
    assert sorted((r["id"], r["v"]) for r in df.collect()) == [("1", long), ("2", "x")]


def test_fields_and_open_values(spark, tmp_path):
    """Rows with surplus or missing fields and a value that never ends keep their text."""
    (tmp_path / "a.csv").write_text('id;v\n1;"a\nb";c\n2\n3;ok\n4;"open\n5;x\n')
    df = read_folder(spark, str(tmp_path), sep=";", multiline=True, split_bytes=8)
    assert {r["id"]: r[MALFORMED] for r in df.collect()} == {"1": '1;"a\nb";c', "2": "2", "3": None, "4": '4;"open\n5;x\n'.rstrip("\n")}
    with pytest.raises(Exception, match="not closed within 10 bytes"):
        quoted.records(spark, str(tmp_path), ";", max_record_bytes=10)


def test_charsets_and_headers(spark, tmp_path):
    """cp1252 and UTF-8 files with their columns in another order, found out in the same read."""
    (tmp_path / "a.csv").write_bytes('id;nome – x\n1;"São\n– Paulo"\n'.encode("cp1252"))
    (tmp_path / "b.csv").write_bytes('nome – x;id;more\n"Ünï\n文";2;m\n'.encode())
    df = read_folder(spark, str(tmp_path), sep=";", encoding="auto", multiline=True, malformed_column=None)
    assert sorted((r["id"], r["nome – x"], r["more"], r["source_file"]) for r in df.collect()) == [
        ("1", "São\n– Paulo", None, "a.csv"), ("2", "Ünï\n文", "m", "b.csv")]


def test_contract_with_line_breaks(spark, tmp_path):
    claims = fixtures.claims_raw(spark, SF_SMALL).withColumn("Categoria", F.concat("Categoria", F.lit('\n"more"')))
    path = write_delimited(claims, str(tmp_path / "claims"), sep=";", encoding="ISO-8859-1", trailing_separator=True, cp1252_headers=True)
    got = read_contract(spark, path, CLAIMS, multiline=True).drop("source_file", MALFORMED)
    assert got.exceptAll(claims.select(*got.columns)).count() == 0 and got.count() == claims.count()


def test_query_reads_several_splits_a_file(spark, monkeypatch):
    seen = []
    states = quoted.split_states
    monkeypatch.setattr(quoted, "split_states", lambda looked: seen.append(looked) or states(looked))
    assert QUERIES["csv_multiline"](spark, "/root/testdata/sf0.01").where(F.col("line").isNotNull()).count() == 0
    splits = seen[0].groupBy("path").count().collect()
    assert min(r["count"] for r in splits) >= 4
    inside = states(seen[0]).where("state").count()
    assert inside > 0


def test_changed_files_are_refused(spark, tmp_path):
    """A split that the first reading has not seen is an error, not a wrong table."""
    (tmp_path / "a.csv").write_text("id;v\n1;x\n")
    cut = quoted._cut(b";", type("Known", (), {"value": {}}), 1 << 20)
    import pyarrow as pa

    batch = pa.record_batch([pa.array(["p"]), pa.array([0]), pa.array([b"x"])], names=["path", "start", "line"])
    with pytest.raises(ValueError, match="has changed"):
        list(cut(iter([batch])))


def test_linear_time():
    import time

    lines = [b'a;"' + b'""' * n + b'";b' for n in (50_000, 200_000)] + [(b'"x";' * n) + b'"' for n in (50_000, 200_000)]
    took = []
    for line in lines:
        began = time.perf_counter()
        quoted.ends_inside(line, False, b";")
        quoted.ends_inside(line, True, b";")
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0] + 0.05 and took[3] < 12 * took[2] + 0.05


def test_small_splits_share_tasks(spark, tmp_path, monkeypatch):
    """Tasks and files follow the input's size and the cores, not the number of splits; records over splits stay whole."""
    lines = [f'{i};"note {i}\nsaid ""yes;{i}"""' for i in range(4000)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id;note\n" + "\n".join(lines) + "\n")
    scratch = str(tmp_path / "scratch")
    monkeypatch.setattr(quoted, "scratch_path", lambda *_: scratch)
    got = quoted.records(spark, str(tmp_path / "in"), ";", split_bytes=512).where("NOT header").select(F.col("record").cast("string"), "closed")
    assert sorted(tuple(r) for r in got.collect()) == sorted((x, True) for x in lines)
    splits = spark.read.parquet(f"{scratch}/splits")
    assert splits.count() > 200 and len(splits.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism
    assert len(spark.read.parquet(f"{scratch}/pieces").inputFiles()) <= 4 * 2 * spark.sparkContext.defaultParallelism
