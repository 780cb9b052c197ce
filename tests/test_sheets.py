"""Sheets, checkpoints, traces and files against small files written here."""

import pytest
from pyspark.sql import functions as F

from celldex.operators import assemble
from celldex.sources import sheets, tables

SHEET = '﻿patient_id, path_to_file ,is_reference,channels\n P1 ,"a, ""b"".ome.tif",TRUE,DAPI|CD3\n\nP1,b.tif,false,dapi | CD8\n,,,\nP2,c.tif,true,"CELLTOX|DAPI"\n'


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path / name)


def test_sheet(spark, tmp_path):
    path = put(tmp_path, "in.csv", SHEET)
    df = sheets.step_sheet(spark, path, "preprocessing")
    rows = sorted(df.collect(), key=lambda r: r["row"])
    assert [(r["patient_id"], r["path_to_file"]) for r in rows] == [("P1", 'a, "b".ome.tif'), ("P1", "b.tif"), ("P2", "c.tif")]
    got = {r["path_to_file"]: (r["is_reference"], r["channels"]) for r in sheets.checked(df, ["DAPI"]).collect()}
    assert got["b.tif"] == (False, ["dapi", "CD8"])
    assert sheets.unknown_columns(df, ["patient_id"]) == ["path_to_file", "is_reference", "channels"]
    with pytest.raises(ValueError, match="registered_image"):
        sheets.step_sheet(spark, path, "segmentation")
    with pytest.raises(ValueError, match="unknown step"):
        sheets.step_sheet(spark, path, "x")


def test_checked_names_problems(spark):
    frame = lambda rows: spark.createDataFrame(rows, "row long, patient_id string, is_reference string, channels string")
    with pytest.raises(ValueError, match=r"several references \(patient A"):
        sheets.checked(frame([(0, "A", "true", "DAPI"), (1, "A", "true", "DAPI")]), ["DAPI"])
    with pytest.raises(ValueError, match="no nuclear channel"):
        sheets.checked(frame([(0, "A", "true", "CD3")]), ["DAPI"])
    with pytest.raises(ValueError, match="isn't true or false"):
        sheets.checked(frame([(0, "A", "yes", "DAPI")]), ["DAPI"], allow_none=True)
    with pytest.raises(ValueError, match="no rows"):
        sheets.checked(frame([]), ["DAPI"])
    assert sheets.checked(frame([(0, "A", "FALSE", "DAPI")]), ["DAPI"], allow_none=True).head()["is_reference"] is False


def test_identities_and_kept_channels(spark):
    rows = spark.createDataFrame([("P1", 0, "/x/P1_a.ome.tif", False, ["DAPI", "CD3"]), ("P1", 1, "/y/P1_a.tif", True, ["dapi", "CD8", "cd8"]), ("P2", 0, "b", True, ["DAPI"])], "patient_id string, row long, image string, is_reference boolean, channels array<string>")
    assert sorted(r["id"] for r in sheets.identities(rows, "image", "row").collect()) == ["P1_a_000", "P1_a_001", "P2_b"]
    kept = {(r["patient_id"], r["row"]): r["channels"] for r in sheets.kept_channels(rows, "row").collect()}
    assert kept == {("P1", 0): ["CD3"], ("P1", 1): ["dapi", "CD8"], ("P2", 0): ["DAPI"]}
    assert {r["patient_id"]: r["images"] for r in sheets.run_manifest(rows, sheets.kept_channels(rows, "row")).collect()} == {"P1": 2, "P2": 1, None: 3}


def test_checkpoints(spark, tmp_path):
    rows = spark.createDataFrame([("P2", "b", 'x,"y".tif', True, "DAPI", 0.5), ("P1", "a", None, False, "DAPI|CD3", 0.25)], "patient_id string, id string, registered_image string, is_reference boolean, channels string, pixel_size double")
    path = str(tmp_path / "registered")
    assert sheets.write_checkpoint(rows, "registered", path)
    back = sheets.sheet(spark, path).drop("row")
    assert back.columns == sheets.CHECKPOINTS["registered"]
    got = sheets.checkpoint_rows(back, "registered").orderBy("id").collect()
    assert [(r["id"], r["registered_image"], r["is_reference"], r["channels"], r["pixel_size"]) for r in got] == [("a", None, False, ["DAPI", "CD3"], 0.25), ("b", 'x,"y".tif', True, ["DAPI"], 0.5)]
    assert not sheets.write_checkpoint(rows.limit(0), "registered", str(tmp_path / "none")) and not (tmp_path / "none").exists()
    assert not sheets.write_checkpoint(rows, "registered", str(tmp_path / "none"), level="all")
    with pytest.raises(ValueError, match="unknown columns: more"):
        sheets.checkpoint(rows.withColumn("more", F.lit(1)), "registered")
    with pytest.raises(ValueError, match="missing columns: pixel_size"):
        sheets.checkpoint(rows.drop("pixel_size"), "registered")
    with pytest.raises(ValueError, match="without an id"):
        sheets.checkpoint_rows(back.withColumn("pixel_size", F.lit("-1")), "registered")


def test_trace_and_size_log(spark, tmp_path):
    names = ["process", "tag", "name", "status", "exit", "realtime", "duration", "%cpu", "memory", "cpus", "peak_rss", "peak_vmem", "rchar", "wchar"]
    path = put(tmp_path, "trace.txt", "\t".join(names) + "\nA:B\tt\tn\tCOMPLETED\t0\t12m 4s\t-\t142.3%\t3.2 GB\t8\t512 MB\t-\t0\t1.5 KB\n")
    r = sheets.trace(spark, path).head()
    assert (r["realtime_s"], r["duration_s"], r["cpu_pct"], r["cpus"], r["memory_b"], r["peak_vmem_b"], r["rchar_b"], r["wchar_b"]) == (724.0, None, 142.3, 8, 3435973836.8, None, 0.0, 1536.0)
    log = put(tmp_path, "log.csv", "process,sample_id,filename,bytes\nP,s,a,10\nP,s,b,5\nQ,s,a,1\n")
    assert {(r["process"], r["bytes"]) for r in sheets.size_totals(sheets.sheet(spark, log)).collect()} == {("P", 15), ("Q", 1)}
    with pytest.raises(ValueError, match="size log"):
        sheets.size_totals(sheets.sheet(spark, path, "\t"))
    made = sheets.size_log(spark, log, "P", "s").head()
    assert (made["filename"], made["bytes"]) == ("log.csv", len((tmp_path / "log.csv").read_text()))


def test_files_and_documents(spark, tmp_path):
    put(tmp_path, "b.json", '{"id": "b", "n": 2}')
    put(tmp_path, "a.json", '{"id": "a", "n": 1}')
    put(tmp_path, "c.json", "{broken")
    assert [r["path"].rpartition("/")[2] for r in sheets.files(spark, str(tmp_path), "*.json").collect()] == ["a.json", "b.json", "c.json"]
    assert sorted((r["id"], r["n"]) for r in sheets.documents(spark, str(tmp_path), "id string, n long").collect()) == [("a", 1), ("b", 2)]


def test_run_at():
    assert sheets.run_at("registration", "preprocessing", "segmentation") and not sheets.run_at("preprocessing", "registration", "segmentation")


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        conf = None

        def get(self, name, default=None):
            return {"spark.master": "spark://host:7077"}.get(name, default)

    session = Conf()
    session.conf = session
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_dir(session)


def test_columns_of_merged_tables(spark):
    df = spark.createDataFrame([(1, 2.0, 9.0, 0.1, 0.2, 0.3, "x", "+")], "label long, x double, area double, CD8 double, DAPI double, CD3 double, note string, a_sign string").withColumn("b_sign", F.lit(" "))
    assert assemble.marker_columns(df) == ["CD8", "DAPI", "CD3"]
    assert assemble.ordered_columns(df.select("label", "x", "area", "CD8", "DAPI", "CD3"), "P1", ["dapi"]).columns == ["fov", "cell_size", "label", "x", "area", "DAPI", "CD3", "CD8"]
    assert assemble.gated_columns(df) == ["a_sign"] and assemble.gated_columns(df.select("label")) == []


def test_assembled_errors(spark):
    with pytest.raises(ValueError, match="need compartments"):
        assemble.compartment_mode(False, True, False)
    with pytest.raises(ValueError, match="embedded masks"):
        assemble.compartment_mode(True, False, True)
    assert assemble.compartment_mode(True, True, True)["masks"]
    files = spark.createDataFrame([("/a/P1_DAPI_CD3.tif",), ("/a/P1_dapi.tif",), ("/a/P1_CD3_DAPI.txt",)], "path string")
    assert assemble.reference_file(files, ["dapi", "cd3"], [".tif"]) == "/a/P1_DAPI_CD3.tif"
    with pytest.raises(ValueError, match="expected one"):
        assemble.reference_file(files, ["DAPI"], [".tif", ".txt"])
    shapes = spark.createDataFrame([("A", 5, 5), ("B", 5, 6)], "channel string, height int, width int")
    with pytest.raises(ValueError, match="2 shapes"):
        assemble.channel_files(shapes)
    assert assemble.channel_files(shapes.limit(1)).count() == 1 and assemble.usable_slides(shapes, 6).count() == 0
    with pytest.raises(ValueError, match="unknown kind"):
        assemble.of_kind(shapes, "x", ["y"])
