"""Versioned bundles of fitted state (E9, S7, M11): tables, small documents and spark.ml models.

A bundle is a folder of versions ``v=1``, ``v=2`` ...  A version's parts are written first and its
``manifest.json`` last, under another name and then renamed, so a version is either whole or not there: readers
look only at versions with a manifest, and a writer that died leaves a folder that nobody reads and whose number
is not used again.  Versions are never changed once written, so a reader that holds one is not disturbed by the next.

The manifest has each part's kind, files, bytes, schema, rows and an order-free checksum of the rows.  ``open_bundle``
compares files and bytes (a listing, no read), ``verify`` reads the rows again and compares the checksum.  A part that
is missing, cut or altered raises ``DamagedBundle``.  Everything goes through the Hadoop file system of the path, so any shared store works.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "manifest.json"


class DamagedBundle(ValueError):
    """A part does not agree with its manifest."""


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _numbers(spark: SparkSession, base: str) -> dict[int, bool]:
    """Version numbers below ``base`` and whether each has its manifest."""
    fs, root = _fs(spark, base)
    if not fs.exists(root):
        return {}
    found = {}
    for entry in fs.listStatus(root):
        name = re.fullmatch(r"v=(\d+)", entry.getPath().getName())
        if name:
            found[int(name[1])] = _exists(spark, f"{base}/{name[0]}/{MANIFEST}")
    return found


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def _size(spark: SparkSession, path: str) -> dict[str, int]:
    """Files and bytes below a path, without hidden files."""
    fs, target = _fs(spark, path)
    files = size = 0
    if fs.exists(target):
        entries = fs.listFiles(target, True)
        while entries.hasNext():
            entry = entries.next()
            if not entry.getPath().getName().startswith((".", "_")):
                files, size = files + 1, size + entry.getLen()
    return {"files": files, "bytes": size}


def _content(df: DataFrame) -> dict[str, object]:
    """Rows and an order-free checksum of them."""
    row = df.select(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)").alias("x"))
    n, total = row.agg(F.count(F.lit(1)), F.sum("x")).first()
    return {"rows": n, "checksum": str(total or 0)}


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    fs, target = _fs(spark, path)
    _, part = _fs(spark, f"{path}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, target):
        raise OSError(f"cannot finish {path}")


def _read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]  # one small document


@dataclass
class Bundle:
    """One finished version."""

    spark: SparkSession
    path: str
    version: int
    parts: dict[str, dict]

    def _part(self, name: str, kind: str) -> dict:
        part = self.parts.get(name)
        if part is None or part["kind"] != kind:
            raise KeyError(f"{self.path} has no {kind} {name}")
        return part

    def frame(self, name: str) -> DataFrame:
        part = self._part(name, "frame")
        return self.spark.read.schema(StructType.fromJson(part["schema"])).parquet(f"{self.path}/{name}")

    def frames(self, prefix: str) -> dict[str, DataFrame]:
        """All tables below ``prefix/``, by the rest of their name."""
        names = [n for n, p in self.parts.items() if p["kind"] == "frame" and n.startswith(f"{prefix}/")]
        return {n[len(prefix) + 1:]: self.frame(n) for n in names}

    def doc(self, name: str):
        return self._part(name, "doc")["value"]

    def model(self, name: str) -> PipelineModel:
        self._part(name, "model")
        return PipelineModel.load(f"{self.path}/{name}")

    def check(self) -> None:
        """Files and bytes of every part against the manifest."""
        for name, part in self.parts.items():
            if part["kind"] != "doc":
                now = _size(self.spark, f"{self.path}/{name}")
                if now != {k: part[k] for k in now}:
                    raise DamagedBundle(f"{self.path}/{name} has {now}, its manifest says {part['files']} files, {part['bytes']} bytes")

    def verify(self) -> None:
        """``check``, and the rows of every table against their checksum."""
        self.check()
        for name, part in self.parts.items():
            if part["kind"] == "frame":
                now = _content(self.frame(name))
                if now != {k: part[k] for k in now}:
                    raise DamagedBundle(f"{self.path}/{name} has {now}, its manifest says {part['rows']} rows, checksum {part['checksum']}")


def save_bundle(spark: SparkSession, base: str, frames: dict[str, DataFrame] | None = None, docs: dict[str, object] | None = None,
                models: dict[str, PipelineModel] | None = None) -> int:
    """Write the next version and return its number.  Documents (small, JSON) live in the manifest itself."""
    version = max(_numbers(spark, base), default=0) + 1
    path = f"{base}/v={version}"
    parts: dict[str, dict] = {name: {"kind": "doc", "value": value} for name, value in (docs or {}).items()}
    for name, df in (frames or {}).items():
        df.write.parquet(f"{path}/{name}")
        back = spark.read.schema(df.schema).parquet(f"{path}/{name}")
        parts[name] = {"kind": "frame", "schema": json.loads(df.schema.json()), **_size(spark, f"{path}/{name}"), **_content(back)}
    for name, model in (models or {}).items():
        model.write().save(f"{path}/{name}")
        parts[name] = {"kind": "model", **_size(spark, f"{path}/{name}")}
    _write_text(spark, f"{path}/{MANIFEST}", json.dumps({"version": version, "parts": parts}))
    return version


def latest_version(spark: SparkSession, base: str) -> int | None:
    """The highest finished version."""
    return max((v for v, done in _numbers(spark, base).items() if done), default=None)


def open_bundle(spark: SparkSession, base: str, version: int | None = None) -> Bundle:
    """A finished version (the latest by default), its files checked against the manifest."""
    number = latest_version(spark, base) if version is None else version
    path = f"{base}/v={number}"
    if number is None or not _exists(spark, f"{path}/{MANIFEST}"):
        raise FileNotFoundError(f"no finished version {'' if version is None else version} in {base}")
    bundle = Bundle(spark, path, number, json.loads(_read_text(spark, f"{path}/{MANIFEST}"))["parts"])
    bundle.check()
    return bundle
