"""Source trees as ``files`` rows, listed and read in tasks.

Spark's built-in file listing hides names starting with ``_`` or ``.`` and skips empty
files, which would drop ``__init__.py`` and dot-directories. Here the driver lists only the
first levels of each tree; every directory below is walked by a task, and tasks read the
contents in batches bounded in bytes. Read failures and bad UTF-8 become a ``read_status``
instead of failing the job. ``follow_tree`` reads only what has changed since a listing.
"""

from __future__ import annotations

import hashlib
import os

SCHEMA = "project string, path string, content string, content_sha string, read_status string, size bigint"
LISTING = "project string, root string, path string, size bigint, mtime bigint"

# A listing batch holds so many files, a batch of contents so many bytes (or one larger file).
LIST_ROWS, READ_BYTES = 10_000, 16 << 20


def walk_tree(root: str, suffix: str | None):
    """(path, size, mtime in ns) of every file under ``root`` (dot-dirs, ``__init__.py`` and empty files included)."""
    for dirpath, dirnames, filenames in os.walk(root):
        dirnames.sort()
        for name in sorted(filenames):
            if suffix and not name.endswith(suffix):  # glob "*<suffix>": "*" may be empty
                continue
            full = os.path.join(dirpath, name)
            yield os.path.relpath(full, root).replace(os.sep, "/"), *_stat(full)


def _stat(full: str) -> tuple[int, int]:
    try:
        found = os.stat(full)
        return found.st_size, found.st_mtime_ns
    except OSError:
        return 0, 0


def read_file(root: str, path: str) -> tuple[str | None, str | None, str]:
    """(text, sha256 of the bytes, status) of one file."""
    try:
        with open(os.path.join(root, path), "rb") as fh:
            raw = fh.read()
    except OSError:
        return None, None, "unreadable"
    sha = hashlib.sha256(raw).hexdigest()
    try:
        return raw.decode("utf-8"), sha, "ok"
    except UnicodeDecodeError:
        return None, sha, "bad_utf8"


def _walk_units(root: str, depth: int) -> list[tuple[str, bool]]:
    """What the driver lists: files in the first ``depth`` levels and the directories at
    that depth (each walked later by a task), as (relative path, is_directory).

    Mirrors ``os.walk``: symlinked directories are not descended into.
    """
    files, frontier = [], [""]
    for _ in range(depth):
        deeper = []
        for rel in frontier:
            try:
                entries = sorted(os.scandir(os.path.join(root, rel) if rel else root), key=lambda e: e.name)
            except OSError:
                continue
            for e in entries:
                path = f"{rel}/{e.name}" if rel else e.name
                if e.is_dir():
                    if not e.is_symlink():
                        deeper.append(path)
                else:
                    files.append(path)
        frontier = deeper
    return [(f, False) for f in files] + [(d, True) for d in frontier]


def list_sources(spark, roots: dict[str, str], suffix: str = ".py", depth: int = 1):
    """The files of source trees without their contents: ``LISTING`` rows, walked in tasks."""
    import pandas as pd

    from sourcelens.session import ship_package

    ship_package(spark)
    units = [(p, r, u, d) for p, r in roots.items() for u, d in _walk_units(r, depth)]
    todo = spark.createDataFrame(units, "project string, root string, unit string, is_dir boolean")
    columns = ["project", "root", "path", "size", "mtime"]

    def list_units(it):
        for pdf in it:
            rows = []
            for project, root, unit, is_dir in zip(pdf["project"], pdf["root"], pdf["unit"], pdf["is_dir"]):
                if is_dir:
                    for rel, size, mtime in walk_tree(os.path.join(root, unit), suffix):
                        rows.append((project, root, f"{unit}/{rel}", size, mtime))
                        if len(rows) >= LIST_ROWS:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
                elif not suffix or unit.rsplit("/", 1)[-1].endswith(suffix):
                    rows.append((project, root, unit, *_stat(os.path.join(root, unit))))
            yield pd.DataFrame(rows, columns=columns)

    return todo.repartition(max(1, len(units))).mapInPandas(list_units, LISTING)


def read_listed(listed, read_partitions: int | None = None, universal_newlines: bool = True):
    """``SCHEMA`` rows of listed files, spread round-robin over tasks that read in bounded batches."""
    import pandas as pd
    from pyspark.sql import functions as F

    from sourcelens.functions import text as T

    columns = ["project", "path", "content", "content_sha", "read_status", "size"]

    def read_files(it):
        for pdf in it:
            rows, held = [], 0
            for project, root, path, size in zip(pdf["project"], pdf["root"], pdf["path"], pdf["size"]):
                rows.append((project, path, *read_file(root, path), size))
                held += size
                if held >= READ_BYTES:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=columns)

    n = read_partitions or listed.sparkSession.sparkContext.defaultParallelism
    df = listed.repartition(n).mapInPandas(read_files, SCHEMA)
    if universal_newlines:
        df = df.withColumn("content", T.normalise_newlines(F.col("content")))
    return df


def scan_sources(spark, roots: dict[str, str], suffix: str = ".py", depth: int = 1,
                 read_partitions: int | None = None, universal_newlines: bool = True):
    """S1 (+ X2): ``files(project, path, content, content_sha, read_status, size)``.

    The driver lists only the first ``depth`` directory levels. ``universal_newlines`` applies
    text-mode reading (CRLF / CR to LF), as the CLI did.
    """
    return read_listed(list_sources(spark, roots, suffix, depth), read_partitions, universal_newlines)


def follow_tree(spark, roots: dict[str, str], index, before=None, suffix: str = ".py", depth: int = 1):
    """Bring a parse store up to date with its trees: (store, listing).

    ``before`` is the listing that the call before returned (None at first). Files of another
    size or time, or that are new, are read; files that are gone leave the map; contents that
    the store knows are not parsed, whatever their files are called now. Write both results
    and hand them to the next call.
    """
    from sourcelens.operators import index as I
    from sourcelens.session import write_and_read

    keys, state = ["project", "path"], ["project", "path", "size", "mtime"]
    now = write_and_read(list_sources(spark, roots, suffix, depth), "listing")
    changed = now if before is None else now.join(before.select(*state), state, "left_anti")
    read = write_and_read(read_listed(changed).where("read_status = 'ok'").select(*keys, "content"), "changed_files")
    hashed = I.with_sha(read)
    fresh = hashed.select(*keys, "content_sha")
    if index is None:
        return I.ParseStore(fresh, I.parse_contents(hashed)), now
    held = index.paths.join(now.select(*keys), keys, "left_semi").join(changed.select(*keys), keys, "left_anti")
    paths = held.unionByName(fresh)
    kept = index.records.join(paths.select("content_sha").distinct(), "content_sha", "left_semi")
    return I.ParseStore(paths, kept.unionByName(I.parse_contents(hashed, index.of("file")))), now
