"""Readers by extension, monthly file listing, the intake registry, sinks (SRC-01 to SRC-20)."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import os
import shutil
from collections.abc import Iterable, Sequence
from datetime import datetime, timezone
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import xlsx

#: Rows above which a result is not gathered for a workbook or text report.
SMALL = 200_000


def read(spark: SparkSession, path: str, sheet: str = "*", skip: int = 0, columns: Sequence[str] | None = None) -> DataFrame:
    """A table by its extension: parquet, csv, json, orc, xlsx, xls (if the library is there), dta. Other extensions are
    an error. columns: read no others."""
    kind = Path(path.rstrip("/")).suffix.lower().lstrip(".")
    if kind in ("parquet", "orc"):
        d = spark.read.format(kind).load(path)
    elif kind == "csv":
        d = spark.read.option("header", True).csv(path)
    elif kind in ("json", "jsonl"):
        d = spark.read.json(path)
    elif kind == "xlsx":
        d = read_workbooks(spark, path, sheet, skip)
    elif kind == "xls":
        # needs an engine that may be absent; its own error says so
        d = spark.createDataFrame(pd.read_excel(path, sheet_name=0 if sheet == "*" else sheet, skiprows=skip).astype(object))
    elif kind == "dta":
        d = read_stata(spark, path)
    else:
        raise ValueError(f"no reader for {path}")
    return d.select(*[c for c in columns if c in d.columns]) if columns else d


def read_workbooks(spark: SparkSession, path: str, sheet: str = "*", skip: int = 0, keep_place: bool = False) -> DataFrame:
    """All sheets of all workbooks, one under the other, columns by header; keep_place: with fichier, feuille, no_ligne.

    The headers are listed in a first pass over the cells' keys, distinct before they are gathered."""
    def cells(batches: Iterable[pd.DataFrame]):
        for b in batches:
            for where, content in zip(b["path"], b["content"]):
                for name, head, rows in xlsx.sheets(io.BytesIO(content), sheet, skip):
                    out = [(where, name, n, {h: v for h, v in zip(head, row) if v is not None}) for n, (_, row) in enumerate(rows, 1)]
                    yield pd.DataFrame(out, columns=["fichier", "feuille", "no_ligne", "cells"]).astype({"no_ligne": "int32"})

    # files are opened by Spark, wherever they lie; one row of bytes a workbook
    raw = _contents(spark, path, "*.xlsx").mapInPandas(cells, "fichier string, feuille string, no_ligne int, cells map<string,string>")
    heads = [r[0] for r in raw.select(F.explode(F.map_keys("cells")).alias("h")).distinct().orderBy("h").collect()]
    place = ["fichier", "feuille", "no_ligne"] if keep_place else []
    return raw.select(*place, *[F.col("cells")[h].alias(h) for h in heads if h not in place])


def _contents(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, content): name and bytes of the files of a folder or pattern, without the lock files of open ones."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    name = F.url_decode(F.element_at(F.split("path", "/"), -1))
    return f.select(name.alias("path"), "content").where(~F.col("path").startswith("~$"))


def read_stata(spark: SparkSession, path: str, chunk: int = 100_000) -> DataFrame:
    """A Stata file, or several by a pattern: one task per file, read in chunks. The columns are those of the first file's
    header, the type of each what its storage type can hold; other files' columns are brought to them by name, absent ones
    null. A file is one row of bytes: at most 2 GB."""
    first = _contents(spark, path, "*").orderBy("path").select("path", F.substring("content", 1, 1 << 24).alias("head")).first()
    with pd.io.stata.StataReader(io.BytesIO(bytes(first["head"]))) as r:
        r.variable_labels()  # reads the header
        whole = {"b", "h", "l"}
        kinds = ["timestamp_ntz" if f.startswith(("%t", "%d")) else "long" if t in whole else "double" if t in ("f", "d") else "string" for t, f in zip(r._typlist, r._fmtlist)]
        names = list(r._varlist)

    def run(batches: Iterable[pd.DataFrame]):
        for b in batches:
            for content in b["content"]:
                for part in pd.read_stata(io.BytesIO(content), chunksize=chunk, convert_categoricals=False):
                    yield pd.DataFrame({n: part[n].astype("Int64") if k == "long" and n in part else part[n] if n in part else None for n, k in zip(names, kinds)})

    return _contents(spark, path, "*").mapInPandas(run, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at))


def probe(df: DataFrame, rows: int = 1000) -> tuple[list[tuple[str, str]], DataFrame]:
    """Columns with types, and the first rows."""
    return df.dtypes, df.limit(rows)


def newest(paths: Iterable[str]) -> str | None:
    """The most recently changed file; the last name among equals."""
    return max(paths, key=lambda p: (os.path.getmtime(p), p), default=None)


# --- intake registry -------------------------------------------------------------------------------------------------


def manifest(spark: SparkSession, path: str, pattern: str = "*.xlsx") -> DataFrame:
    """file, size, hash of every file, hashed where it lies; lock files are left out."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return f.where(~F.url_decode(name).startswith("~$")).select(F.url_decode(name).alias("file"), F.col("length").alias("size"), F.md5("content").alias("hash"))


def to_process(found: DataFrame, registry: DataFrame, force: bool = False) -> DataFrame:
    """found with the reason it has to be read: new_file, modified, incomplete (not completed before), or forced; files
    that are up to date are left out."""
    r = registry.select("file", F.col("hash").alias("_h"), F.col("status").alias("_s"))
    why = F.when(F.col("_h").isNull(), "new_file").when(F.col("_h") != F.col("hash"), "modified").when(F.col("_s") != "completed", "incomplete")
    d = found.join(r, "file", "left").withColumn("reason", F.coalesce(why, F.lit("forced")) if force else why)
    return d.where("reason IS NOT NULL").drop("_h", "_s")


class IntakeRegistry:
    """A small CSV on the driver: file, hash, status, at. Entries become completed only after their data are written."""

    FIELDS = ("file", "hash", "status", "at")

    def __init__(self, path: str):
        self.path = path

    def rows(self) -> dict[str, dict[str, str]]:
        if not os.path.exists(self.path):
            return {}
        with open(self.path, newline="", encoding="utf-8") as f:
            return {r["file"]: r for r in csv.DictReader(f)}

    def upsert(self, file: str, hash_: str, status: str) -> None:
        rows = self.rows()
        rows[file] = {"file": file, "hash": hash_, "status": status, "at": datetime.now(timezone.utc).isoformat(timespec="seconds")}
        to = f"{self.path}.new"
        with open(to, "w", newline="", encoding="utf-8") as f:
            w = csv.DictWriter(f, self.FIELDS)
            w.writeheader()
            w.writerows(rows[k] for k in sorted(rows))
        os.replace(to, self.path)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(r["file"], r["hash"], r["status"]) for r in self.rows().values()], "file string, hash string, status string")


def md5(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "md5").hexdigest()


# --- sinks -----------------------------------------------------------------------------------------------------------


def gathered(df: DataFrame) -> list:
    """The rows of a small result; a larger one is an error."""
    rows = df.limit(SMALL + 1).collect()
    if len(rows) > SMALL:
        raise ValueError(f"over {SMALL} rows; write it as parquet or csv")
    return rows


def write(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """By extension: parquet, csv (also for unknown extensions), json, orc - distributed; xlsx and dta for small results."""
    kind = Path(path.rstrip("/")).suffix.lower().lstrip(".")
    data = io.BytesIO()
    if kind == "xlsx":
        xlsx.write(data, {"data": (df.columns, gathered(df))})
        _put(df.sparkSession, path, data.getvalue())
    elif kind == "dta":
        pd.DataFrame(gathered(df), columns=df.columns).to_stata(data, write_index=False, version=118)
        _put(df.sparkSession, path, data.getvalue())
    else:
        w = df.write.mode("overwrite").partitionBy(*partition_by) if partition_by else df.write.mode("overwrite")
        (w.format(kind) if kind in ("parquet", "json", "orc") else w.format("csv").option("header", True)).save(path)


def _put(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file, through the file system that its path names."""
    if "://" not in path or path.startswith("file:"):
        Path(path.removeprefix("file://").removeprefix("file:")).write_bytes(data)
        return
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(data))
    out.close()


def write_report(path: str, tables: dict[str, DataFrame], metadata: dict[str, object], legend: Sequence[tuple[str, str]] = ()) -> None:
    """A workbook with one sheet per table, then Metadata and Legende."""
    out = {n: (d.columns, gathered(d)) for n, d in tables.items()}
    out["Metadata"] = (["cle", "valeur"], [(k, str(v)) for k, v in metadata.items()])
    if legend:
        out["Legende"] = (["terme", "sens"], list(legend))
    data = io.BytesIO()
    xlsx.write(data, out)
    _put(SparkSession.getActiveSession(), path, data.getvalue())


def write_text(path: str, title: str, sections: dict[str, object]) -> None:
    """A plain text report: mappings as lines, tables as rows of text."""
    with open(path, "w", encoding="utf-8") as f:
        f.write(f"{title}\n{'=' * len(title)}\n")
        for name, s in sections.items():
            f.write(f"\n{name}\n{'-' * len(name)}\n")
            if isinstance(s, DataFrame):
                f.write(" | ".join(s.columns) + "\n")
                f.writelines(" | ".join("" if v is None else str(v) for v in r) + "\n" for r in gathered(s))
            elif isinstance(s, dict):
                f.writelines(f"{k}: {v}\n" for k, v in s.items())
            else:
                f.write(f"{s}\n")


def archive(path: str, folder: str) -> str | None:
    """Copy a file that is about to be replaced under a timestamped name; None if there is none."""
    if not os.path.exists(path):
        return None
    os.makedirs(folder, exist_ok=True)
    p = Path(path)
    to = os.path.join(folder, f"{p.stem}_{datetime.now(timezone.utc):%Y%m%d_%H%M%S_%f}{p.suffix}")
    shutil.copytree(path, to) if p.is_dir() else shutil.copy2(path, to)
    return to


class Stages:
    """Which table a stage has written last: an explicit record in place of the newest file of a folder."""

    def __init__(self, path: str):
        self.path = path

    def _all(self) -> dict[str, str]:
        return json.loads(Path(self.path).read_text()) if os.path.exists(self.path) else {}

    def set(self, stage: str, table: str) -> None:
        Path(self.path).write_text(json.dumps(self._all() | {stage: table}, indent=1, sort_keys=True))

    def get(self, *stages: str) -> str | None:
        """The table of the first of the stages that has one."""
        known = self._all()
        return next((known[s] for s in stages if s in known), None)
