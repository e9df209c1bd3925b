"""S4 / S5 as a sink with a commit: a set of files that is published whole or not at all.

Tasks stage their files below a folder of the run, in tree layout (``<project>/<path>``), and
report how many; the driver's commit publishes the run by replacing one small manifest, and an
abort removes what was staged. Until the commit readers see the run before, whatever tasks were
lost or repeated: a task attempt stages in a folder of its own, and the manifest names the
attempts that count. What reaches the driver is one message per task.

    updates.write.format("published_files").option("path", shared_dir).mode("append").save()
    read_published(spark, shared_dir)
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

MANIFEST = "manifest.json"
SCHEMA = "project string, path string, content string"


@dataclass
class Staged(WriterCommitMessage):
    """One task attempt: its folder within the run, and the files and bytes in it."""

    folder: str
    files: int
    size: int


class PublishedWriter(DataSourceWriter):
    """Made on the driver and sent to the tasks, so all share the run's name."""

    def __init__(self, root: str):
        self.root, self.run = root.rstrip("/"), uuid.uuid4().hex

    def _run_dir(self) -> str:
        return os.path.join(self.root, "runs", self.run)

    def write(self, iterator):
        folder, files, size = uuid.uuid4().hex, 0, 0
        base = os.path.join(self._run_dir(), folder)
        os.makedirs(base, exist_ok=True)
        for row in iterator:
            target = os.path.normpath(os.path.join(base, row["project"], row["path"]))
            if not target.startswith(os.path.join(base, row["project"]) + os.sep):
                raise ValueError(f"{row['path']!r} leaves its project")
            os.makedirs(os.path.dirname(target), exist_ok=True)
            data = (row["content"] or "").encode("utf-8", "surrogatepass")
            with open(target, "wb") as out:
                out.write(data)
            files, size = files + 1, size + len(data)
        return Staged(folder, files, size)

    def commit(self, messages):
        done = [m for m in messages if m is not None]
        text = json.dumps({"run": self.run, "files": sum(m.files for m in done), "bytes": sum(m.size for m in done),
                           "folders": [m.folder for m in done if m.files]})
        os.makedirs(self.root, exist_ok=True)
        fresh = os.path.join(self.root, f".{MANIFEST}.{self.run}")
        with open(fresh, "w", encoding="utf-8") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        os.replace(fresh, os.path.join(self.root, MANIFEST))

    def abort(self, messages):
        shutil.rmtree(self._run_dir(), ignore_errors=True)


class PublishedFiles(DataSource):
    @classmethod
    def name(cls):
        return "published_files"

    def schema(self):
        return SCHEMA

    def writer(self, schema, overwrite):
        return PublishedWriter(self.options["path"])


def mounted(root: str) -> str:
    """The folder as tasks and driver open it; stores that are not mounted are refused."""
    if root.startswith("file:"):
        return "/" + root[5:].lstrip("/")
    if "://" in root:
        raise ValueError(f"{root}: published files need a folder that driver and executors have mounted")
    return root


def publish(files: DataFrame, root: str) -> None:
    """Publish ``files(project, path, content)`` below a shared folder, replacing what was published there."""
    from sourcelens.session import ship_package

    spark = files.sparkSession
    ship_package(spark)
    spark.dataSource.register(PublishedFiles)
    files.select("project", "path", "content").write.format("published_files").option("path", mounted(root)).mode("append").save()


def published(root: str) -> dict | None:
    """The manifest of the published run, None where nothing is."""
    try:
        with open(os.path.join(mounted(root), MANIFEST), encoding="utf-8") as f:
            return json.load(f)
    except FileNotFoundError:
        return None


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The published files as ``files(project, path, content)``; listed and read in tasks."""
    from sourcelens.sources.filesource import scan_sources

    root = mounted(root)
    held = published(root)
    if held is None or not held["folders"]:
        return spark.createDataFrame([], SCHEMA)
    run = os.path.join(root, "runs", held["run"])
    found = scan_sources(spark, {folder: os.path.join(run, folder) for folder in held["folders"]}, suffix="",
                         universal_newlines=False)
    # Below an attempt's folder the first level is the project.
    return found.where("read_status = 'ok'").select(
        F.substring_index("path", "/", 1).alias("project"),
        F.expr("substring(path, instr(path, '/') + 1)").alias("path"), "content")


def clear_old_runs(root: str) -> int:
    """Remove the folders of all runs but the published one: replaced runs, and any whose driver died."""
    root = mounted(root)
    held, gone = published(root), 0
    for run in os.listdir(os.path.join(root, "runs")) if os.path.isdir(os.path.join(root, "runs")) else []:
        if held is None or run != held["run"]:
            shutil.rmtree(os.path.join(root, "runs", run), ignore_errors=True)
            gone += 1
    return gone
