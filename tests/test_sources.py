"""Workbooks, Stata files, registries, reports, sessions, streaming intake, the pipeline end to end."""

import os
import time

import pytest
from pyspark.sql import functions as F

from paygrain.plans.pipeline import Pipeline, Settings
from paygrain.plans.sessions import ModelRegistry, Sessions
from paygrain.sources import files, xlsx
from paygrain.streaming import intake


@pytest.fixture
def books(tmp_path):
    xlsx.write(str(tmp_path / "01_2024.xlsx"), {"Feuil1": (["ID", "Salaire"], [("a", 1.5), ("é & <b>", None)]), "Feuil2": (["ID", "Extra"], [("c", "x")])})
    xlsx.write(str(tmp_path / "02_2024.xlsx"), {"Feuil1": (["ID", "Salaire"], [("d", 2)])})
    (tmp_path / "~$02_2024.xlsx").write_bytes(b"lock")
    return tmp_path


def test_workbooks(spark, books):
    d = files.read_workbooks(spark, str(books), keep_place=True)
    assert sorted((r.fichier, r.feuille, r.ID, r.Salaire, r.Extra) for r in d.collect()) == sorted(
        [("01_2024.xlsx", "Feuil1", "a", "1.5", None), ("01_2024.xlsx", "Feuil1", "é & <b>", None, None), ("01_2024.xlsx", "Feuil2", "c", None, "x"), ("02_2024.xlsx", "Feuil1", "d", "2", None)], key=str
    )
    assert files.read(spark, str(books / "01_2024.xlsx"), sheet="2").columns == ["Extra", "ID"]
    assert files.read_workbooks(spark, str(books), sheet="1", skip=1).count() == 1
    assert xlsx.sheet_names(books / "01_2024.xlsx") == ["Feuil1", "Feuil2"]


def test_readers_by_extension(spark, tmp_path):
    d = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    for name in ("t.parquet", "t.csv", "t.json", "t.orc", "t.xlsx"):
        files.write(d, str(tmp_path / name))
        assert files.read(spark, str(tmp_path / name), columns=["x", "gone"]).columns == ["x"]
    files.write(d.where("x = 1"), str(tmp_path / "t.dta"))
    assert [tuple(r) for r in files.read(spark, str(tmp_path / "t.dta")).collect()] == [(1, "a")]
    with pytest.raises(ValueError):
        files.read(spark, "t.pdf")


def test_incremental_registry(spark, books, tmp_path):
    reg = files.IntakeRegistry(str(tmp_path / "registry.csv"))
    assert reg.rows() == {}
    found = files.manifest(spark, str(books))
    assert {r.file for r in found.collect()} == {"01_2024.xlsx", "02_2024.xlsx"}
    h = {r.file: r.hash for r in found.collect()}
    assert h["01_2024.xlsx"] == files.md5(str(books / "01_2024.xlsx"))
    reg.upsert("01_2024.xlsx", h["01_2024.xlsx"], "completed")
    reg.upsert("02_2024.xlsx", h["02_2024.xlsx"], "in_progress")
    assert [(r.file, r.reason) for r in files.to_process(found, reg.frame(spark)).collect()] == [("02_2024.xlsx", "incomplete")]
    reg.upsert("02_2024.xlsx", "other", "completed")
    assert [(r.file, r.reason) for r in files.to_process(found, reg.frame(spark)).collect()] == [("02_2024.xlsx", "modified")]
    assert files.to_process(found, reg.frame(spark), force=True).count() == 2


def test_reports_archive_newest_and_stages(spark, tmp_path):
    d = spark.createDataFrame([("a", 1.0), ("b", None)], "g string, v double")
    files.write_report(str(tmp_path / "r.xlsx"), {"sex/age": d}, {"rows": 2}, [("g", "group")])
    assert xlsx.sheet_names(tmp_path / "r.xlsx") == ["sex_age", "Metadata", "Legende"]
    files.write_text(str(tmp_path / "r.txt"), "Rapport", {"Total": {"n": 2}, "Table": d})
    assert "b | " in (tmp_path / "r.txt").read_text()
    copy = files.archive(str(tmp_path / "r.txt"), str(tmp_path / "old"))
    assert os.path.exists(copy) and files.archive(str(tmp_path / "none"), str(tmp_path / "old")) is None
    assert files.newest([str(tmp_path / "r.xlsx"), copy]) == copy or os.path.getmtime(copy) <= os.path.getmtime(tmp_path / "r.xlsx")
    assert files.newest([]) is None
    s = files.Stages(str(tmp_path / "stages.json"))
    s.set("merged", "/m")
    assert s.get("weighted", "merged") == "/m" and s.get("weighted") is None
    assert files.probe(d, 1)[1].count() == 1


def test_audit_workbook(spark, tmp_path):
    from paygrain.operators.audit import audit_tables

    a = spark.createDataFrame([("x", 1.0), ("x", 1.0), (None, 2.0)], "id string, v double")
    b = spark.createDataFrame([("y", "1")], "id string, v string").withColumn("z", F.lit(1))
    t = audit_tables([("01", a), ("02", b)], "id", ["v", "absent"])
    files.write_report(str(tmp_path / "audit.xlsx"), t, {"files": 2})
    assert xlsx.sheet_names(tmp_path / "audit.xlsx") == ["copies", "schema", "fill", "outliers", "identifiers", "Metadata"]
    assert sorted((r.file, r.duplicates) for r in t["copies"].collect()) == [("01", 1), ("02", 0)]
    assert sorted((r.change, r.column) for r in t["schema"].collect()) == [("extra", "z"), ("retyped", "('v', 'double', 'string')")]


def test_sessions(tmp_path):
    s = Sessions(str(tmp_path / "sessions"))
    a = s.create({"filters": False, "seed": 1})
    time.sleep(0.01)
    b = s.create({"filters": True, "seed": 1})
    s.close(a, "completed", {"n": 3})
    assert [d["id"] for d in s.list()] == [a, b] and s.current() == b
    assert s.compare(a, b) == {"filters": (False, True), "status": ("completed", "active")}
    assert s.rollback(a) == {"filters": False, "seed": 1} and s.current() == a
    s.delete(a)
    assert s.current() is None and len(s.list()) == 1
    with pytest.raises(FileNotFoundError):
        s.get(a)


def test_model_registry(spark, tmp_path):
    from paygrain.operators import models
    from paygrain.plans.catalog import ModelSpec

    d = spark.createDataFrame([(float(i), 2.0 * i + (i % 3)) for i in range(30)], "x double, y double")
    m = models.fit_linear(d, ModelSpec("m", "linear", "y", ("x",)))
    r = ModelRegistry(f"file://{tmp_path}/models")
    one = r.register("m", m.model, m.figures)
    two = r.register("m", m.model)
    assert r.latest("m") == two and r.latest("other") is None and len(r.list("m")) == 2
    assert r.load(one).transform(d).count() == 30
    with pytest.raises(KeyError):
        r.load("gone")


def test_streaming_intake(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()
    one = spark.createDataFrame([(1, 10.0)], "i int, v double")
    one.toPandas().to_parquet(src / "01_2024_A.parquet")
    stream = lambda: intake.monthly_files(spark, str(src), one.schema)
    intake.take_new(stream(), out, ck).awaitTermination()
    one.toPandas().to_parquet(src / "02_2024_A.parquet")
    intake.take_new(stream(), out, ck).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted((r.MOIS, r.ANNEE, r.i) for r in got.collect()) == [(1, 2024, 1), (2, 2024, 1)]
    seen = []
    intake.for_each_batch(stream(), str(tmp_path / "ck2"), lambda df, k: seen.append(df.count())).awaitTermination()
    assert sum(seen) == 2


def test_streaming_windows_equal_batch(spark, tmp_path):
    d = spark.sql("SELECT timestamp_seconds(1704067200 + id * 600) ts, concat('t', id % 2) event_type, cast(id AS double) value FROM range(40)")
    d.write.parquet(str(tmp_path / "ev"))
    s = intake.windowed_counts(spark.readStream.schema(d.schema).parquet(str(tmp_path / "ev")))
    q = s.writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("w").collect())) == sorted(map(tuple, intake.windowed_counts(d).collect()))


def test_pipeline(spark, tmp_path):
    import random

    random.seed(2)
    rows = []
    for f in range(12):
        for m in range(1, 7):
            if random.random() < 0.25:
                continue
            for w in range(6):
                rows.append((len(rows), f"W{f}_{w}", f"{1000000 + f}", "F" if w % 2 else "M", "M", 100000.0 + 1000 * f + 10 * w + m, 1.0, m, 2024))
    d = spark.createDataFrame(rows, "ligne_id bigint, id_indiv string, numero_employeur string, sexe string, type_salarie string, salaire_brut double, duree_travaillee double, mois int, annee int")
    ref = spark.createDataFrame([(f"{1000000 + f}", "C10" if f % 2 else "H49") for f in range(12)], "numero_employeur string, secteur_activite_cod string")
    p = Pipeline(spark, str(tmp_path / "s"), Settings(imputations=3))
    r = p.run({"declarations": d, "secteurs_employeurs": ref})
    assert r.log == list(p.STEPS) and r.figures["merges"][0]["status"] == "merged"
    assert p.sessions.list()[0]["status"] == "completed"
    e = r.tables["estimates"].where("dimension = 'global'")
    assert e.agg(F.sum("n_obs")).first()[0] == len(rows)
    assert r.tables["combined"].where("m = 3 AND variance > 0").count() > 0
    assert r.tables["firm_time"].count() == 72
    with pytest.raises(ValueError):
        p.run({}, ["nothing"])
    with pytest.raises(KeyError):
        p.run({}, "prepare")
    assert p.sessions.list()[-1]["status"] == "failed"
