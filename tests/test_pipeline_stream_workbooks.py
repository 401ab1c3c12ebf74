import datetime as dt
import io
import os
import zipfile

import pytest
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from propyield.plans import fixtures
from propyield.plans.analogs import REGION
from propyield.plans.fixtures import xlsx_bytes
from propyield.plans import pipeline
from propyield.plans.pipeline import Inputs, JdbcTarget, run_pipeline, workbook_to_jdbc
from propyield.operators import clean_sales, rent_by_dept, sales_totals
from propyield.schemas import GEO_COLUMNS, RENT_RENAMES, SALE_RENAMES, RegionSpec
from propyield.sinks import Run, drop_old_runs, published
from propyield.sources import fs, ingest_pipe_folder, ingest_yearly_folder
from propyield.sources import workbooks
from propyield.sources.workbooks import read_workbooks, register_workbooks, sheet_rows
from propyield.streaming import compact, ingest_any_layout, ingest_available, keep_rent_means, keep_sales_totals, stream_folder
from propyield.streaming.aggregates import rent_means_kept, totals
from tests.test_sources_sinks import local, write

SF001 = "/root/testdata/sf0.001"


def test_sheet_rows_shared_inline_blank():
    data = xlsx_bytes(["code", "dep", "pct"], [["09000", None, 1.5], ["31000", "31", None]])
    assert sheet_rows(data) == [["code", "dep", "pct"], ["09000", None, 1.5], ["31000", "31"]]
    buf = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(data)) as src, zipfile.ZipFile(buf, "w") as dst:
        for item in src.namelist():
            body = src.read(item)
            if item == "xl/worksheets/sheet1.xml":  # an inline string cell
                body = body.replace(b'<c r="A2" t="s"><v>3</v></c>',
                                    b'<c r="A2" t="inlineStr"><is><t>2A004</t></is></c>')
            dst.writestr(item, body)
    assert sheet_rows(buf.getvalue())[1][0] == "2A004"
    with pytest.raises(ValueError):
        sheet_rows(data, "Sheet9")


def test_read_workbooks_infers_types_by_header(spark, scratch):
    os.makedirs(local(scratch), exist_ok=True)
    with open(os.path.join(local(scratch), "a.xlsx"), "wb") as f:
        f.write(xlsx_bytes(["dep", "pct", "note"], [["09", 1.5, "x"], ["31", 2.0, None]]))
    with open(os.path.join(local(scratch), "b.xlsx"), "wb") as f:
        f.write(xlsx_bytes(["pct", "dep"], [[3.25, "34"]]))
    with open(os.path.join(local(scratch), "ignored.txt"), "w") as f:
        f.write("not a workbook")
    df = read_workbooks(spark, scratch, file_column="file")
    assert dict(df.dtypes) == {"dep": "string", "pct": "double", "note": "string", "file": "string"}
    rows = sorted((r.dep, r.pct, r.note) for r in df.collect())
    assert rows == [("09", 1.5, "x"), ("31", 2.0, None), ("34", 3.25, None)]


def test_kinds_are_remembered_for_unchanged_workbooks(spark, scratch, monkeypatch):
    save(scratch, "a.xlsx", xlsx_bytes(["dep", "n"], [["09", 1.5]]))
    assert dict(read_workbooks(spark, scratch).dtypes) == {"dep": "string", "n": "double"}
    inferred = []
    real = workbooks.infer_workbook_schema
    monkeypatch.setattr(workbooks, "infer_workbook_schema", lambda *a: (inferred.append(1), real(*a))[1])
    assert dict(read_workbooks(spark, scratch).dtypes) == {"dep": "string", "n": "double"} and not inferred
    save(scratch, "b.xlsx", xlsx_bytes(["dep", "n"], [["31", "x"]]))
    df = read_workbooks(spark, scratch)
    assert dict(df.dtypes) == {"dep": "string", "n": "string"} and len(inferred) == 1
    assert sorted(map(tuple, df.collect())) == [("09", "1.5"), ("31", "x")]


def test_workbook_format(spark, scratch):
    register_workbooks(spark)
    save(scratch, "a.xlsx", xlsx_bytes(["dep", "n", "ok"], [["09", 1.5, True], ["31", None, False]]))
    save(scratch, "B.XLSX", xlsx_bytes(["n", "dep"], [[3.0, "34"]]))
    save(scratch, "other.xlsx.txt", b"no workbook")
    df = spark.read.format("workbook").schema("dep string, n double").load(scratch)
    assert df.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, df.collect())) == [("09", 1.5), ("31", None), ("34", 3.0)]
    assert spark.read.format("workbook").load(scratch).columns == ["n", "dep"]  # those of the first workbook
    save(f"{scratch}/two", "t.xlsx", xlsx_bytes(["a"], [["x"]], sheet="Other"))
    assert spark.read.format("workbook").option("sheet", "Other").load(f"{scratch}/two").collect() == [("x",)]
    write(f"{scratch}/none", "readme.txt", "nothing")
    with pytest.raises(Exception, match="no workbook"):
        spark.read.format("workbook").load(f"{scratch}/none").collect()


def test_stream_ingests_only_new_files(spark, scratch):
    src, out = f"{scratch}/in", f"{scratch}/out"
    header = "Nature mutation|Code postal|Commune\n"
    write(src, "a.txt", header + "Vente|09000|FOIX\n")
    stream = stream_folder(spark, src, ".txt", "|", rename=SALE_RENAMES)
    ingest_available(stream, f"{out}/t", f"{out}/ck")
    write(src, "b.TXT", header + "Vente|31000|TOULOUSE\nEchange|34000|SETE\n")
    ingest_available(stream_folder(spark, src, ".txt", "|", rename=SALE_RENAMES),
                     f"{out}/t", f"{out}/ck")
    ingest_available(stream_folder(spark, src, ".txt", "|", rename=SALE_RENAMES),
                     f"{out}/t", f"{out}/ck")  # nothing new: no duplicates
    got = sorted(r.postal for r in spark.read.parquet(f"{out}/t").collect())
    assert got == ["09000", "31000", "34000"]


def test_pipeline_outputs_and_rerun(spark, scratch):
    inputs = Inputs(fixtures.rent_folder(spark, SF001), fixtures.sale_folder(spark, SF001),
                    fixtures.geo_delimited(spark, SF001, "\t"))
    out = run_pipeline(spark, inputs, scratch, REGION, code_remap={"3": "30"})
    first = published(spark, scratch)
    assert set(first) == {"rents", "sales", "address_sales", "rent_by_dept", "rent_by_city", "yield_dept_long",
                          "yield_city_long", "rents_region", "address_sales_csv", "geo_remapped", "rent_by_dept.csv",
                          "rent_by_city.csv", "yield_by_dept.csv", "yield_by_city.csv"}
    assert all(fs.exists(spark, p) for path in first.values() for p in (path if isinstance(path, list) else [path]))
    n = out["address_sales"].count()
    again = run_pipeline(spark, inputs, scratch, REGION)  # stages reused
    assert again["address_sales"].count() == n
    assert again["yield_by_dept"].columns == ["dep", *[str(y) for y in range(1995, 2002)]]
    second = published(spark, scratch)
    assert second["sales"] == first["sales"] and second["yield_by_dept.csv"] != first["yield_by_dept.csv"]
    assert "geo_remapped" not in second and published(spark, scratch, 1) == first


def test_pipeline_rerun_for_another_region_or_input(spark, scratch, monkeypatch):
    inputs = Inputs(f"{scratch}/rents", f"{scratch}/sales", f"{scratch}/geo")
    write(inputs.rent_folder, "r_2023.csv", "INSEE_C;LIBGEO;REG;DEP;loypredm2;lwr.IPm2;upr.IPm2\n"
          "09122;Foix;76;09;10;9;11\n75056;Paris;11;75;30;29;31\n")
    write(inputs.sale_folder, "s.txt", "Nature mutation|Code postal|Commune|Surface reelle bati|Valeur fonciere|No voie|Voie|Date mutation\n"
          "Vente|09000|FOIX|50|100000|1|RUE|04/01/2023\nVente|75001|PARIS|20|300000|2|RUE|04/01/2023\n")
    write(inputs.geo_path, "g.tsv", "Code Postal\tCommune\tCode INSEE\tCode D\u00e9partement\tR\u00e9gion\tCode R\u00e9gion\n"
          "09000\tFOIX\t09122\t09\t['OCC']\t76\n75001\tPARIS\t75056\t75\t['IDF']\t11\n")
    south, capital = RegionSpec("76", ("['OCC']",)), RegionSpec("11", ("['IDF']",))
    rows = lambda out: {k: sorted(map(tuple, v.collect())) for k, v in out.items()}
    first = rows(run_pipeline(spark, inputs, f"{scratch}/out", south))
    second = rows(run_pipeline(spark, inputs, f"{scratch}/out", capital))
    assert second == rows(run_pipeline(spark, inputs, f"{scratch}/fresh", capital))
    assert first["yield_by_dept"] == [("09", 6.0)] and second["yield_by_dept"] == [("75", 2.4)]
    write(inputs.rent_folder, "r_2023.csv", "INSEE_C;LIBGEO;REG;DEP;loypredm2;lwr.IPm2;upr.IPm2\n75056;Paris;11;75;60,0;59;61\n")
    sent = []
    monkeypatch.setattr(pipeline, "write_jdbc", lambda df, url, table, properties: sent.append((url, table, df.count())))
    third = rows(run_pipeline(spark, inputs, f"{scratch}/out", capital, database=JdbcTarget("jdbc:x", {})))
    assert third["yield_by_dept"] == [("75", 4.8)]
    assert sent == [("jdbc:x", "yield_by_dept", 1), ("jdbc:x", "yield_by_city", 1)]


def small_inputs(folder, rent="10"):
    inputs = Inputs(f"{folder}/rents", f"{folder}/sales", f"{folder}/geo")
    write(inputs.rent_folder, "r_2023.csv", "INSEE_C;LIBGEO;REG;DEP;loypredm2;lwr.IPm2;upr.IPm2\n"
          f"09122;Foix;76;09;{rent};9;11\n")
    if os.path.exists(local(inputs.sale_folder)):
        return inputs  # other rents beside the same sales
    write(inputs.sale_folder, "s.txt", "Nature mutation|Code postal|Commune|Surface reelle bati|Valeur fonciere|No voie|Voie|Date mutation\n"
          "Vente|09000|FOIX|50|100000|1|RUE|04/01/2023\n")
    write(inputs.geo_path, "g.tsv", "Code Postal\tCommune\tCode INSEE\tCode D\u00e9partement\tR\u00e9gion\tCode R\u00e9gion\n"
          "09000\tFOIX\t09122\t09\t['OCC']\t76\n")
    return inputs


def shown(spark, out):
    """What a reader of the published outputs sees."""
    at = published(spark, out)
    read = lambda n: sorted(map(tuple, spark.read.options(header=True, sep=";").csv(at[n]).collect()))
    return {n: read(n) for n in at if n.endswith(".csv") or n in ("rents_region", "address_sales_csv")}


def test_a_job_that_breaks_leaves_the_published_run_whole(spark, scratch, monkeypatch):
    south, out = RegionSpec("76", ("['OCC']",)), f"{scratch}/out"
    run_pipeline(spark, small_inputs(scratch), out, south)
    before, named = shown(spark, out), published(spark, out)
    assert before["yield_by_city.csv"] == [("Foix", "09122", "6.0")]
    inputs = small_inputs(scratch, rent="20,0")  # other rents, same sales
    for broken in ("rent_by_city", "yield_by_city_long", "export_named_csv"):  # later ones reuse finished stages
        with monkeypatch.context() as m:
            m.setattr(pipeline, broken, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                run_pipeline(spark, inputs, out, south)
        assert shown(spark, out) == before and published(spark, out) == named
    run_pipeline(spark, inputs, out, south)
    after = shown(spark, out)
    assert after["yield_by_city.csv"] == [("Foix", "09122", "12.0")]
    assert after["rent_by_dept.csv"][0][2] == "20.0" and published(spark, out)["sales"] == named["sales"]


def test_old_runs_are_dropped_but_not_what_later_ones_use(spark, scratch):
    south, out = RegionSpec("76", ("['OCC']",)), f"{scratch}/out"
    assert published(spark, out) == {} and drop_old_runs(spark, out) == []
    for rent in ("10", "20", "30"):
        run_pipeline(spark, small_inputs(scratch, rent), out, south)
    failed = Run(spark, out)  # a run that never publishes, after the last one
    spark.range(1).write.parquet(failed.path("rents"))
    before = shown(spark, out)
    first = published(spark, out, 1)
    gone = drop_old_runs(spark, out, keep=1)
    assert gone and shown(spark, out) == before
    assert published(spark, out, 1) == {} and not fs.exists(spark, first["rents"][0])
    assert published(spark, out)["sales"] == first["sales"] and fs.exists(spark, first["sales"][0])
    assert fs.exists(spark, f"{failed.folder}/rents")


def test_a_new_file_renews_its_year_alone(spark, scratch):
    south, out = RegionSpec("76", ("['OCC']",)), f"{scratch}/out"
    inputs = small_inputs(scratch)
    head = "INSEE_C;LIBGEO;REG;DEP;loypredm2;lwr.IPm2;upr.IPm2\n"
    write(inputs.rent_folder, "r_2024.csv", head + "09122;Foix;76;09;30;9;11\n")
    write(inputs.rent_folder, "none_1990.csv", head)  # a year without rows
    run_pipeline(spark, inputs, out, south)
    first = published(spark, out)
    year = lambda paths: {p.rsplit("=", 1)[1]: p for p in paths}
    assert set(year(first["rents"])) == {"p1990", "p2023", "p2024"} and len(first["sales"]) == 1
    write(inputs.rent_folder, "x_2024.csv", "LIBGEO;" + head.replace("LIBGEO;", "") + "Foix;09122;76;09;50;9;11\n")
    write(inputs.sale_folder, "t2.txt", "Code postal|Nature mutation|Commune|Surface reelle bati|Valeur fonciere|No voie|Voie|Date mutation\n"
          "09000|Vente|FOIX|10|20000|2|RUE|04/01/2024\n")
    got = run_pipeline(spark, inputs, out, south)
    second = published(spark, out)
    assert {y for y, p in year(second["rents"]).items() if p != year(first["rents"])[y]} == {"p2024"}
    assert set(first["sales"]) < set(second["sales"])
    whole = run_pipeline(spark, inputs, f"{scratch}/fresh", south)
    for name in whole:
        assert sorted(map(repr, got[name].collect())) == sorted(map(repr, whole[name].collect())), name
    assert shown(spark, out) == shown(spark, f"{scratch}/fresh")
    os.remove(os.path.join(local(inputs.rent_folder), "r_2023.csv"))  # a file that is gone
    third = run_pipeline(spark, inputs, out, south)
    assert set(year(published(spark, out)["rents"])) == {"p1990", "p2024"}
    assert {r.year for r in third["rents"].collect()} == {"2024"}
    drop_old_runs(spark, out, keep=1)
    assert shown(spark, out)["rent_by_dept.csv"] == [("09", "2024", "40.0", "9.0", "11.0")]
    assert fs.exists(spark, year(first["rents"])["p1990"]) and not fs.exists(spark, year(first["rents"])["p2024"])


def test_two_runs_publish_under_numbers_of_their_own(spark, scratch):
    runs = [Run(spark, scratch) for _ in range(2)]
    for run in runs:
        run.path("x")
    assert [run.publish() for run in runs] == [1, 2]
    assert published(spark, scratch) == {"x": f"{runs[1].folder}/x"}
    made = runs[0].stage("t", lambda: spark.range(3), "k")
    assert made.count() == 3 and Run(spark, scratch).stage("t", lambda: spark.range(9), "k").count() == 3
    assert Run(spark, scratch, force=True).stage("t", lambda: spark.range(9), "k").count() == 9


def test_building_a_plan_runs_no_job(spark):
    from propyield.operators import clean_sales, rent_by_dept, yield_by_dept_long
    from propyield.plans.analogs import geo_table, rent_table, sale_table

    tables = [t(spark, SF001) for t in (sale_table, geo_table, rent_table)]
    spark.sparkContext.setJobGroup("plans-only", "no job is expected")
    try:
        yield_by_dept_long(clean_sales(*tables[:2], REGION), rent_by_dept(tables[2])).explain()
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plans-only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def save(folder, name, data):
    os.makedirs(local(folder), exist_ok=True)
    with open(os.path.join(local(folder), name), "wb") as f:
        f.write(data)


def test_workbook_headers_dates_booleans_and_extension(spark, scratch, monkeypatch):
    day = dt.date(2023, 5, 17)
    save(scratch, "A.XLSX", xlsx_bytes(["dep", "taux", "taux", None, "jour", "ok"], [["09", 1.0, 2.0, "x", day, True]]))
    save(scratch, "b.xlsx", xlsx_bytes(["dep", "taux", "ok"], [["31", 3.0, False]]))
    df = read_workbooks(spark, scratch)
    assert df.columns == ["dep", "taux", "taux1", "_c3", "jour", "ok"]
    assert dict(df.dtypes)["jour"] == "timestamp_ntz" and dict(df.dtypes)["ok"] == "boolean"
    assert sorted(map(tuple, df.collect())) == [
        ("09", 1.0, 2.0, "x", dt.datetime(2023, 5, 17), True), ("31", 3.0, None, None, None, False)]
    sent = []
    monkeypatch.setattr(pipeline, "write_jdbc", lambda df, url, table, properties: sent.append((table, df.columns, df.count())))
    workbook_to_jdbc(spark, scratch, JdbcTarget("jdbc:x", {}), "levels")
    assert sent == [("levels", df.columns, 2)]
    declared = StructType([StructField("dep", StringType()), StructField("flag", BooleanType())])
    save(f"{scratch}/text", "t.xlsx", xlsx_bytes(["dep", "flag"], [["1", "false"], ["2", "VRAI"], ["3", "maybe"]]))
    assert [r.flag for r in read_workbooks(spark, f"{scratch}/text", schema=declared).collect()] == [False, True, None]
    write(f"{scratch}/none", "readme.txt", "nothing")
    with pytest.raises(ValueError):
        read_workbooks(spark, f"{scratch}/none")


def test_stream_of_several_layouts(spark, scratch):
    src, out = f"{scratch}/in", f"{scratch}/out"
    run = lambda: ingest_any_layout(spark, src, ".txt", "|", f"{out}/t", f"{out}/ck")
    write(src, "a.txt", "p|c\n1|x\n")
    write(src, "b [2].txt", "c|p\ny|2\n")
    run()
    write(src, "c.TXT", "p|c\n3|z\n")
    run()
    run()
    assert sorted((r.p, r.c) for r in spark.read.parquet(f"{out}/t").collect()) == [("1", "x"), ("2", "y"), ("3", "z")]


def rent_file(*rows, order=("INSEE_C", "LIBGEO", "REG", "DEP", "loypredm2", "lwr.IPm2", "upr.IPm2")):
    named = [dict(zip(("INSEE_C", "LIBGEO", "REG", "DEP", "loypredm2", "lwr.IPm2", "upr.IPm2"), r, strict=True)) for r in rows]
    return "\n".join([";".join(order), *[";".join(r[c] for c in order) for r in named]]) + "\n"


def test_means_from_the_stream_equal_the_batch_after_every_batch(spark, scratch):
    src, target = f"{scratch}/in", f"{scratch}/kept"
    files = [("r_2022.csv", rent_file(("1", "A", "76", "09", "10,5", "9", "11"), ("2", "B", "76", "31", "x", "", "1"))),
             ("s_2022.CSV", rent_file(("1", "A", "76", "09", "11,25", "8", "12"), order=("LIBGEO", "DEP", "REG", "INSEE_C", "upr.IPm2", "lwr.IPm2", "loypredm2"))),
             ("t_2023.csv", rent_file(("3", "C", "76", "09", "7", "6", "8")))]
    sums = f"{target}/sums"
    for n, (name, text) in enumerate(files):
        write(src, name, text)
        got = keep_rent_means(spark, src, target, ["dep", "year"])
        want = rent_by_dept(ingest_yearly_folder(spark, src, rename=RENT_RENAMES))
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        assert fs.exists(spark, f"{sums}/batch={n:010d}")
        # the batch comes again, as after a failure before its commit: nothing counts twice
        os.remove(local(f"{target}/checkpoint/commits/{n}"))
        crc = local(f"{target}/checkpoint/commits/.{n}.crc")
        if os.path.exists(crc):
            os.remove(crc)
        again = keep_rent_means(spark, src, target, ["dep", "year"])
        assert sorted(map(repr, again.collect())) == sorted(map(repr, want.collect()))
        kept = rent_means_kept(["dep", "year"])
        schema = spark.read.parquet(f"{sums}/batch={n:010d}").schema
        assert compact(spark, sums, kept.what, schema) == n == compact(spark, sums, kept.what, schema)
        merged = kept.derive(totals(spark, sums, kept.what, schema))
        assert sorted(map(repr, merged.collect())) == sorted(map(repr, want.collect()))
    assert not fs.exists(spark, f"{sums}/batch=0000000000") and fs.exists(spark, f"{sums}/base=0000000002")


def test_sales_of_one_address_from_several_batches(spark, scratch):
    header = "Nature mutation|Code postal|Commune|Surface reelle bati|Valeur fonciere|No voie|Voie|Date mutation\n"
    src, target = f"{scratch}/in", f"{scratch}/kept"
    geo = spark.createDataFrame([("09000", "FOIX", "09122", "09", "['OCC']", "76")], ", ".join(f"{c} string" for c in GEO_COLUMNS))
    south = RegionSpec("76", ("['OCC']",))
    lines = ["Vente|09000|FOIX|50|100000,5|1|RUE|04/01/2023\nVente|09000|FOIX||9|1|RUE|04/01/2023\n",
             "Vente|09000|FOIX|-50|1|1|RUE|04/01/2023\n", "Vente|09000|FOIX|10|5|1|RUE|04/01/2023\nEchange|09000|FOIX|10|5|1|RUE|04/01/2023\n"]
    seen = []
    for i, text in enumerate(lines):
        write(src, f"s{i}.txt", header + text)
        got = keep_sales_totals(spark, src, geo, south, target, ["dep"]).collect()
        want = sales_totals(clean_sales(ingest_pipe_folder(spark, src, rename=SALE_RENAMES), geo, south), ["dep"]).collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in want]
        seen.append(len(got))
    assert seen == [1, 0, 1]  # an address whose surface was taken back comes in again
