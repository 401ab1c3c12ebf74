import os

import pytest

from propyield.sinks import export_csv, export_named_csv, materialize_for, materialize_once
from propyield.sources import (
    header_groups,
    infer_types,
    ingest_folder,
    ingest_pipe_folder,
    ingest_yearly_folder,
    read_delimited,
    read_tolerant,
    scan_with_rejects,
)
from propyield.sources import fs
from propyield.sources.inference import infer_schema


def local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def write(folder: str, name: str, text: str) -> None:
    os.makedirs(local(folder), exist_ok=True)
    with open(os.path.join(local(folder), name), "w", encoding="utf-8") as f:
        f.write(text)


def test_yearly_folder_by_header_groups(spark, scratch):
    write(scratch, "rent_2022.csv", "INSEE_C;LIBGEO;loypredm2\n09001;Foix;9,5\n")
    write(scratch, "rent_2023.CSV", "loypredm2;INSEE_C;LIBGEO\n10,5;09002;Créon\n")
    write(scratch, "app12-2024.csv", "INSEE_C;LIBGEO;loypredm2\n2A004;Ajaccio;12\n")
    write(scratch, "notes.txt", "not a csv\n")
    write(f"{scratch}/sub", "rent_2019.csv", "INSEE_C;LIBGEO;loypredm2\n1;x;1\n")
    df = ingest_yearly_folder(spark, scratch)
    rows = sorted((r.INSEE_C, r.LIBGEO, r.loypredm2, r.year) for r in df.collect())
    assert rows == [("09001", "Foix", "9,5", "2022"), ("09002", "Créon", "10,5", "2023"),
                    ("2A004", "Ajaccio", "12", "122024")]


def test_missing_column_is_an_error_unless_allowed(spark, scratch):
    write(scratch, "a_2022.csv", "INSEE_C;LIBGEO\n1;x\n")
    write(scratch, "b_2023.csv", "INSEE_C\n2\n")
    with pytest.raises(Exception):
        ingest_yearly_folder(spark, scratch).collect()
    df = ingest_yearly_folder(spark, scratch, allow_missing=True)
    assert sorted((r.INSEE_C, r.LIBGEO) for r in df.collect()) == [("1", "x"), ("2", None)]


def test_empty_folder_is_an_error(spark, scratch):
    write(scratch, "only.txt", "a|b\n1|2\n")
    with pytest.raises(ValueError):
        ingest_yearly_folder(spark, scratch)
    with pytest.raises(ValueError):
        ingest_pipe_folder(spark, f"{scratch}/nothing-here")


def test_pipe_folder_keeps_leading_zeros_and_duplicates(spark, scratch):
    write(scratch, "s1.txt", "Code postal|Commune\n09000|FOIX\n09000|FOIX\n")
    write(scratch, "s2.TXT", "Commune|Code postal\nTOULOUSE|31000\n")
    df = ingest_pipe_folder(spark, scratch, rename={"Code postal": "postal", "Commune": "commune"})
    assert sorted(map(tuple, df.select("postal", "commune").collect())) == [
        ("09000", "FOIX"), ("09000", "FOIX"), ("31000", "TOULOUSE")]


def test_inference_is_opt_in(spark, scratch):
    write(scratch, "n.csv", "k;name;n\n09;a;1\n10;b;-3\n")
    typed = read_delimited(spark, scratch, ";", infer=True)
    text = read_delimited(spark, scratch, ";")
    assert dict(typed.dtypes) == {"k": "string", "name": "string", "n": "int"}
    assert sorted(r.k for r in text.collect()) == ["09", "10"]
    assert sorted(map(tuple, typed.collect())) == [("09", "a", 1), ("10", "b", -3)]


def test_inference_over_files_that_disagree(spark, scratch):
    write(scratch, "a.csv", "code;zip;n;m;x;day;ok;none;a.b;id\n31000;31000;1;1;1;2023-05-17;true;;1;1\n")
    write(scratch, "b.csv", "zip;code;m;n;x;day;ok;none;a.b;id\n09000;2A004;1.5;3000000000;;2023-05-17 10:00:00;FALSE;;2;12345678901234567890\n")
    write(scratch, "c.csv", "zip;code;m;n;x;day;ok;none;a.b;id\n")
    df = ingest_folder(spark, scratch, ".csv", ";", infer=True)
    assert dict(df.dtypes) == {"code": "string", "zip": "string", "n": "bigint", "m": "double", "x": "int", "day": "timestamp_ntz",
                               "ok": "boolean", "none": "string", "a.b": "int", "id": "string"}
    rows = sorted(map(tuple, df.select("code", "zip", "n", "m", "x", "ok", "`a.b`").collect()))
    assert rows == [("2A004", "09000", 3000000000, 1.5, None, False, 2), ("31000", "31000", 1, 1.0, 1, True, 1)]
    assert infer_types(spark.range(3)).dtypes == [("id", "bigint")]


@pytest.mark.parametrize(("values", "want"), [
    (["0", "-5", "2147483647"], "int"), (["2147483648"], "bigint"), (["9223372036854775808"], "string"), (["-0"], "string"),
    (["+5"], "string"), (["00"], "string"), (["0", "0.5", ".5", "1e3"], "double"), (["1", "x"], "string"), (["1", "true"], "string"),
    (["2023-02-30"], "string"), (["2023-02-28"], "date"), (["2023-02-28", "5"], "string"), (["", None], "string"), (["5", "", None], "int"),
    (["1,5"], "string"), ([" 1"], "string"), (["007.5"], "string")])
def test_kinds_of_values(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert infer_schema(df) == {"v": want}
    assert infer_schema(df.limit(0)) == {"v": "string"}


def test_headers_are_found_by_a_job(spark, scratch):
    many = ["a;b\n1;2\n", "b;a\n2;1\n", "\ufeffa;b\n1;2\n", "\n  \n\"a\";b\n1;2\n"]
    for i in range(200):
        write(scratch, f"f{i:03d}.csv", many[i % 4])
    write(scratch, "empty.csv", "")
    write(scratch, "blank.csv", "\n\n")
    write(scratch, "big.CSV", "a;b\n" + "1;2\n" * 900_000)  # several splits
    write(f"{scratch}/k=1", "x.csv", "other\n1\n")
    write(f"{scratch}/sub/deep", "x.csv", "other\n1\n")
    groups = header_groups(spark, scratch, ".csv", ";")
    assert [g.columns for g in groups] == [("a", "b"), ("b", "a"), ("a", "b")]
    assert sum(len(g.names) for g in groups if not g.others) == 100
    df = ingest_folder(spark, scratch, ".csv", ";")
    assert df.columns == ["a", "b"]
    assert df.groupBy("a", "b").count().collect() == [("1", "2", 900_200)]


def test_a_folder_of_many_files_needs_no_call_for_each(spark, scratch, monkeypatch):
    for i in range(1500):
        write(scratch, f"r_{2000 + i % 20}_{'ab'[i % 2] * (i // 20 + 1)}.csv", "a;b\n1;2\n" if i % 3 else "b;a\n2;1\n")
    calls = []
    real = fs._fs
    monkeypatch.setattr(fs, "_fs", lambda *a: (calls.append(a[1]), real(*a))[1])
    df = ingest_yearly_folder(spark, scratch)
    assert len(calls) < 20
    assert df.groupBy("a", "b").count().collect() == [("1", "2", 1500)]
    assert df.select("year").distinct().count() == 20


def test_tolerant_read_counts_agree(spark, scratch):
    write(scratch, "t.tsv", "code\tname\tdep\n01001\ta\t01\n01002\tb\n01003\tc\t01\textra\n"
                            "01004\td\t01\n")
    df = read_tolerant(spark, scratch, "\t")
    assert [r.code for r in df.orderBy("code").collect()] == ["01001", "01004"]
    assert df.count() == 2 and df.select("code").count() == 2


def test_rejects_are_kept(spark, scratch):
    good = "code\tname\tdep\n01001\ta\t01\n01005\t\"x\ty\"\t01\n01006\t\t\n"
    write(f"{scratch}/in", "t.tsv", good + "01002\tb\n\n01003\tc\t01\textra\n\"a\tb\"\n")
    write(f"{scratch}/in", "u.tsv", "code\tname\tdep\n01004\td\t01\nalone\n")
    out = scan_with_rejects(spark, f"{scratch}/in", f"{scratch}/out")
    assert out.good.columns == ["code", "name", "dep"]
    assert sorted(r.code for r in out.good.collect()) == ["01001", "01004", "01005", "01006"]
    assert {r.name for r in out.good.where("code = '01005'").collect()} == {"x\ty"}
    got = sorted((r.file.rsplit("/", 1)[1], r.line, r.reason) for r in out.rejected.collect())
    assert got == [("t.tsv", '"a\tb"', "too few fields"), ("t.tsv", "01002\tb", "too few fields"),
                   ("t.tsv", "01003\tc\t01\textra", "too many fields"), ("u.tsv", "alone", "too few fields")]
    assert out.good.count() == 4 and out.good.select("dep").count() == 4


def test_export_named_csv(spark, scratch):
    df = spark.createDataFrame([("09", 5.5), ("31", None)], "dep string, y double")
    target = export_named_csv(df, scratch, "out.csv")
    assert target.endswith("/out.csv")
    assert sorted(os.listdir(local(scratch))) in (["out.csv"], [".out.csv.crc", "out.csv"])
    back = spark.read.schema("dep string, y double").options(header=True, sep=";").csv(target)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    export_named_csv(df.limit(1), scratch, "out.csv")  # replaces
    assert spark.read.options(header=True, sep=";").csv(target).count() == 1
    cached = df.cache()
    export_named_csv(cached, scratch, "out.csv")
    assert cached.storageLevel.useMemory  # the caller's cache is left alone
    cached.unpersist()


def test_export_csv_and_read_back(spark, scratch):
    df = spark.createDataFrame([("09000", "FOIX", "", None)], "a string, b string, c string, d string")
    export_csv(df, scratch, sep="\t")
    back = read_delimited(spark, scratch, "\t").first()
    assert (back.a, back.b, back.d) == ("09000", "FOIX", None)
    assert back.c in ("", None)  # CSV round trip may turn "" into null


def test_materialize_once_skips_existing(spark, scratch):
    path = f"{scratch}/m"
    first = materialize_once(spark.range(3), path)
    again = materialize_once(spark.range(10), path)  # present: not rewritten
    assert first.count() == again.count() == 3
    forced = materialize_once(spark.range(10), path, force=True)
    assert forced.count() == 10
    assert fs.exists(spark, f"{path}/_SUCCESS")


def test_file_names_with_spaces_brackets_and_plus(spark, scratch):
    write(scratch, "rent 2023.csv", "INSEE_C\n1\n")
    write(scratch, "rent_[v2] 2024.csv", "INSEE_C\n2\n")
    write(scratch, "rent+2025 \u00e9.csv", "INSEE_C\n3\n")
    write(scratch, "rent{a}*2026?.csv", "INSEE_C\n4\n")
    rows = sorted((r.INSEE_C, r.year) for r in ingest_yearly_folder(spark, scratch).collect())
    assert rows == [("1", "2023"), ("2", "22024"), ("3", "2025"), ("4", "2026")]


def test_materialize_for_rebuilds_for_another_key(spark, scratch):
    path = f"{scratch}/m"
    assert materialize_for(spark, lambda: spark.range(3), path, "a").count() == 3
    assert materialize_for(spark, lambda: spark.range(9), path, "a").count() == 3
    assert materialize_for(spark, lambda: spark.range(9), path, "b").count() == 9
    assert materialize_for(spark, lambda: spark.range(4), path, "a").count() == 4


def test_headers_are_found_without_python_workers(spark, scratch):
    from propyield.sources.headers import first_lines
    from tests.plan_text import explain_text

    for name, text in (("a.csv", "x;y\n1;2\n"), ("b.csv", "\n \t\r\ny;x\n" + "1;2\n" * 300_000), ("c.csv", "\n\n"), ("d.CSV", "x;y")):
        fs.write_text(spark, f"{scratch}/{name}", text)
    found = first_lines(spark, scratch, ".csv")
    assert {r["file_name"]: bytes(r["line"]) for r in found.collect()} == {"a.csv": b"x;y", "b.csv": b"y;x", "d.CSV": b"x;y"}
    assert "MapInArrow" not in explain_text(found, "simple")


def test_line_items_meet_orders_that_have_their_customer(spark, scratch):
    import datetime as dt

    from propyield.plans.analogs import build_sale
    from tests.plan_text import explain_text

    day = dt.datetime(2000, 1, 2)
    for name, rows, schema in (
            ("customer", [(1, "C1", 2, "S")], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
            ("orders", [(7, 1, "F", day, "1-URGENT"), (8, None, "F", day, "5-LOW")],
             "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"),
            ("lineitem", [(7, 9.0, 12.5, 0.0, 0.0, "N", "O"), (7, 9.0, 3.0, 0.1, 0.08, "R", "O"), (8, 1.0, 1.0, 0.0, 0.0, "N", "O")],
             "l_orderkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
             "l_returnflag string, l_linestatus string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/{name}.parquet")
    sales = build_sale(spark, scratch)
    assert sorted((r.postal, r.commune, r.surface_txt, r.value_txt, r.date_txt) for r in sales.collect()) == [
        ("00002", "C1", "", "NC", "2000-01-02"), ("00002", "C1", "9,00", "12,50", "02/01/2000")]
    # the many line items take part in the last join alone
    plan = explain_text(sales, "simple")
    assert plan.index("l_orderkey") < plan.index("Join") + 80 and "c_custkey" not in plan[plan.index("Join"):].split("\n")[0]
