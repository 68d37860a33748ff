"""S14 + S15: a training run as one unit -- model, report, column layout.

A run is written into a folder of its own and becomes visible by its manifest,
which is written last, under a new name, by an atomic rename.  The manifest
lists every file with its length and SHA-256, so a loader sees either a whole
run or none: a run that broke between its writes leaves the one before it
loadable, and a changed or lost file is refused.

    <folder>/run-<id>/model/...   pyspark.ml model, or the training rows of KNN
    <folder>/run-<id>/report/...  one JSON document
    <folder>/manifests/<number>-<model>_trainingDate_<yyyymmdd>-<id>.json
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from typing import NamedTuple

from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import evaluate as ev
from ..plans import trees as tr
from ..plans.learn import Layout
from ..plans.selection import Fitted

# The names of the reference's report fields.
METRIC_FIELD = "precision_score of positive class (test-set)"
REPORT_CLASSES = ["0", "1", "accuracy", "macro avg", "weighted avg"]
LOADERS = {"DecisionTree": DecisionTreeClassificationModel, "RandomForest": RandomForestClassificationModel}


class CorruptRunError(ValueError):
    pass


class Run(NamedTuple):
    manifest: dict
    path: str

    @property
    def layout(self) -> Layout:
        return Layout(**self.manifest["layout"])

    def report(self, spark: SparkSession) -> dict:
        return read_report(spark, f"{self.path}/report")

    def model(self, spark: SparkSession):
        """The fitted model; of KNN its training rows."""
        family = self.manifest["model_name"]
        return LOADERS[family].load(f"{self.path}/model") if family in LOADERS else spark.read.parquet(f"{self.path}/model")

    def forest(self, spark: SparkSession) -> tr.Forest:
        """The model's node table (trees and forests)."""
        return tr.node_table(spark, f"{self.path}/model", self.manifest["depth"], self.manifest["trees"])


def _hadoop(spark: SparkSession, path: str):
    """(file system, Path class) of a folder."""
    kind = spark._jvm.org.apache.hadoop.fs.Path
    return kind(path).getFileSystem(spark._jsc.hadoopConfiguration()), kind


def report_of(predictions: DataFrame, model_name: str, params: dict) -> dict:
    """The report document: one aggregate over the predictions."""
    rows = {r["class"]: r for r in ev.classification_report(predictions).collect()}
    cells = {(r["label"], r["prediction"]): r["count"] for r in ev.confusion_matrix(predictions).collect()}
    head = ev.headline(predictions).first()
    named = {"precision": "precision", "recall": "recall", "f1-score": "f1_score", "support": "support"}
    full = {c: {k: rows[c][v] for k, v in named.items()} for c in REPORT_CLASSES if c != "accuracy"}
    full["accuracy"] = rows["accuracy"]["precision"]
    return {"accuracy": head["accuracy"], "best_params": params, "classification_report": full,
            "confusion_matrix": [[cells[y, p] for p in (0, 1)] for y in (0, 1)], "model_name": model_name, METRIC_FIELD: head["precision_1"]}


def write_report(spark: SparkSession, report: dict, path: str) -> str:
    """The document as one JSON line."""
    spark.createDataFrame([(json.dumps(report, sort_keys=True),)], "value string").coalesce(1).write.text(path)
    return path


def read_report(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r.value for r in spark.read.text(path).collect()))


def _digests(spark: SparkSession, path: str) -> dict[str, list]:
    """{file below ``path``: [length, SHA-256]}; one row per file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    rows = files.select("path", "length", F.sha2("content", 256).alias("digest")).collect()
    mark = "/" + path.rstrip("/").rpartition("/")[2] + "/"
    return {r["path"].partition(mark)[2]: [r["length"], r["digest"]] for r in rows}


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, kind = _hadoop(spark, folder)
    where = kind(f"{folder}/manifests")
    if not fs.exists(where):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(where)) if n.endswith(".json"))


def save_run(spark: SparkSession, folder: str, fitted: Fitted, layout: Layout, day: dt.date | None = None) -> str:
    """Write a run and make it the current one; returns its manifest's name."""
    folder, mark = folder.rstrip("/"), uuid.uuid4().hex
    path = f"{folder}/run-{mark}"
    if fitted.family in LOADERS:
        fitted.model.write().save(f"{path}/model")
        depth, trees = tr.depth_of(fitted.model), tr.trees_of(fitted.model)
    else:
        fitted.model.write.parquet(f"{path}/model")
        depth = trees = 0
    report = report_of(fitted.predictions, fitted.family, fitted.params)
    write_report(spark, report, f"{path}/report")
    return _commit(spark, folder, path, mark, {"model_name": fitted.family, "params": fitted.params, "depth": depth, "trees": trees,
                                               "layout": layout._asdict()}, day)


def _commit(spark: SparkSession, folder: str, path: str, mark: str, about: dict, day: dt.date | None) -> str:
    manifest = about | {"run": path.rpartition("/")[2], "files": _digests(spark, path)}
    number = max([int(n.partition("-")[0]) for n in _names(spark, folder)], default=0) + 1
    day = day or dt.date.today()
    name = f"{number:08d}-model_{about['model_name'].lower()}_trainingDate_{day:%Y%m%d}-{mark}.json"
    fs, kind = _hadoop(spark, folder)
    temp, final = kind(f"{folder}/manifests/.{mark}.tmp"), kind(f"{folder}/manifests/{name}")
    out = fs.create(temp, False)
    out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    out.close()
    if not fs.rename(temp, final):
        raise OSError(f"could not commit {name}")
    return name


def load_run(spark: SparkSession, folder: str, layout: Layout | None = None, name: str | None = None) -> Run:
    """The latest run (or that of a manifest), with all its files checked;
    ``layout`` is that of the table the model is meant for."""
    folder = folder.rstrip("/")
    names = _names(spark, folder)
    if not names:
        raise FileNotFoundError(f"no run in {folder}")
    manifest = json.loads("\n".join(r.value for r in spark.read.text(f"{folder}/manifests/{name or names[-1]}").collect()))
    path = f"{folder}/{manifest['run']}"
    try:
        found = _digests(spark, path)
    except Exception as e:
        raise CorruptRunError(f"{path} cannot be read") from e
    if found != manifest["files"]:
        bad = sorted(k for k in found.keys() | manifest["files"].keys() if found.get(k) != manifest["files"].get(k))
        raise CorruptRunError(f"{path}: not the files of the manifest: {bad[:5]}")
    run = Run(manifest, path)
    if layout is not None:
        run.layout.check(layout)
    return run
