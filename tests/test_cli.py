"""End to end from files: mini raw folders in the reference's dialects -> layers."""

import os
import tempfile

from medallion.__main__ import build_parser, run_from_folders
from medallion.contracts import CLAIMS, PROFILES


def write(path, text, encoding):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))


def profile_row(name, segment, match, reviews="100"):
    cols = ["Emp " + name, reviews, "1", "2", "3", "http://x", "Paris, França", "1999.0", "Bank", "n/a", "u",
            "3.8", "3.7", "4.0", "3.8", "3.4", "3.4", "3.5", "77.0", "63.0", segment, name, match]
    return "|".join(cols)


def test_run_from_folders(spark):
    root = tempfile.mkdtemp(prefix="md-cli-")
    write(f"{root}/in/banks/registry.tsv",
          "Segmento\tCNPJ\tNome\nS1\t123\tBANCO ALFA - PRUDENCIAL\nS3\t4567\tBANCO BETA\n", "utf-8")
    header = "|".join(PROFILES.raw_names[:20] + ["Segmento", "Nome", "match_percent"])
    write(f"{root}/in/prof/v2.csv",
          "\n".join([header, profile_row("ALFA", "S1", "100"), profile_row("ALFA", "S1", "60", "5"),
                     profile_row("BETA", "S2", "100")]) + "\n", "utf-8")
    less_header = "|".join(PROFILES.raw_names[:20] + ["CNPJ", "Nome", "match_percent"])
    write(f"{root}/in/prof/less.csv", less_header + "\n" + profile_row("BETA", "4567", "70") + "\n", "utf-8")
    claims_header = ";".join(CLAIMS.raw_names) + ";"
    rows = [
        "2023;1º;Cat;Banco;123;Alfa (conglomerado);1.234,50;1;2;3;6;10;20;30;",
        "2023;2º;Cat;Banco;123;SEM NOME;2.000,00;1;2;3;6; ; ; ;",
        "2023;2º;Cat;Banco; ;Alfa;9,99;1;2;3;6;1;1;1;",
        "2023;3º;Cat;Banco;4567;BETA;1,00;1;1;1;3;1;1;1;",
    ]
    write(f"{root}/in/claims/2023.csv", claims_header + "\n" + "\n".join(rows) + "\n", "cp1252")
    audit = run_from_folders(spark, [f"{root}/in/banks"], [f"{root}/in/prof"], [f"{root}/in/claims"],
                             f"{root}/lake")
    assert audit["raw.claims"] == 4 and audit["raw.profiles"] == 4
    assert audit["trusted.profiles"] == 3          # stale ALFA/S1 copy removed
    # Claims of id 00000123 (named and unnamed) get the ALFA profile; BETA's segments differ.
    assert audit["delivery.bank_employment_satisfaction"] == 2
    out = spark.read.parquet(f"{root}/lake/delivery/bank_employment_satisfaction")
    got = sorted((r["cnpj"], r["quarter_claim"], r["bank_index"], r["match_percent"]) for r in out.collect())
    assert got == [("00000123", 1, 1234.5, 100), ("00000123", 2, 2000.0, 100)]


def test_parser():
    args = build_parser().parse_args(["run", "--institutions", "a", "--profiles", "b", "c",
                                      "--claims", "d", "--root", "r"])
    assert args.profiles == ["b", "c"] and args.claims_encoding == "windows-1252"
