"""Sinks: changed-only updates (S4) and diff artefacts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcelens.operators import diff as D


def changed_only(df: DataFrame, before: str = "content", after: str = "updated") -> DataFrame:
    """rows whose text actually changed."""
    return df.where(~F.col(after).eqNullSafe(F.col(before)))


def write_updates(df: DataFrame, out_dir: str, before: str = "content", after: str = "updated") -> None:
    """S4 as a table: only changed files are written, partitioned by project.

    The table is the latest run's: every write replaces it whole, so a rerun never leaves
    two rows for one file.
    """
    changed_only(df, before, after).select("project", "path", F.col(after).alias("content")).write.mode(
        "overwrite"
    ).partitionBy("project").parquet(out_dir)


def apply_updates(files: DataFrame, updates: DataFrame) -> DataFrame:
    """A new snapshot of ``files``: unchanged rows kept, changed rows replaced."""
    keep = files.join(updates.select("project", "path"), ["project", "path"], "left_anti")
    return keep.unionByName(updates.select(*files.columns), allowMissingColumns=True)


# Fixed value: status of a path that would leave its root.
OUTSIDE_ROOT = "error: outside the project root"


def _write_batches(it):
    import os
    import uuid

    for pdf in it:
        status = []
        for root, path, text, inside in zip(pdf["root"], pdf["path"], pdf["content"], pdf["inside"]):
            if root is None or not inside:
                status.append(OUTSIDE_ROOT if root is not None else "error: no root for the project")
                continue
            target = os.path.join(root, path)
            fresh = f"{target}.{uuid.uuid4().hex}.part"
            try:
                os.makedirs(os.path.dirname(target), exist_ok=True)
                with open(fresh, "w", encoding="utf-8", newline="") as fh:
                    fh.write(text)
                os.replace(fresh, target)  # a killed task leaves the old file whole
                status.append("written")
            except OSError as e:
                status.append(f"error: {e}")
        yield pd.DataFrame({"project": pdf["project"], "path": pdf["path"], "status": status})


def write_files(df: DataFrame, roots: dict[str, str], before: str = "content", after: str = "updated") -> DataFrame:
    """S4 to a shared file tree: executors replace changed files; returns (project, path, status).

    Unchanged files are never touched, paths that resolve outside their project's root (F1)
    are refused. ``roots`` maps project -> root directory.
    """
    from sourcelens.operators.lookup import resolve_path
    from sourcelens.session import ship_package

    ship_package(df.sparkSession)
    root_map = F.create_map(*[x for p, r in roots.items() for x in (F.lit(p), F.lit(r))])
    _, inside, rel = resolve_path(F.col("path"), "/root")
    c = changed_only(df, before, after).select(
        "project", root_map[F.col("project")].alias("root"), "path", F.col(after).alias("content"),
        (inside & (rel != "") & ~F.col("path").startswith("/")).alias("inside"),
    )
    return c.mapInPandas(_write_batches, "project string, path string, status string")


def named_diffs(pairs: DataFrame, prefix: str = "review") -> DataFrame:
    """Unified diffs of changed files with the names of their artefacts."""
    d = D.unified_diffs(pairs)
    return d.select("project", "path", D.diff_name("path", prefix, "project").alias("diff_path"), "diff")


def write_diffs(pairs: DataFrame, out_dir: str, prefix: str = "review") -> None:
    """S5 as a table."""
    named_diffs(pairs, prefix).write.mode("overwrite").parquet(out_dir)


def publish_diffs(pairs: DataFrame, root: str, prefix: str = "review") -> None:
    """S5 as files below a shared folder, published whole or not at all."""
    from sourcelens.sources.published import publish

    publish(named_diffs(pairs, prefix).select("project", F.col("diff_path").alias("path"), F.col("diff").alias("content")), root)
