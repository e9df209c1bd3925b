"""Source index: one parsing pass per distinct content (E1-E5) and the lookups answered from it.

What parsing finds depends on a file's content alone, so records are kept by content hash, in a
``ParseStore``: a narrow map (project, path) -> content_sha, and the records of every content,
parsed once however many projects hold a copy of it. Python's own ``ast`` parses inside
``mapInArrow``. Every later question (skeleton, symbol search, import resolution, definitions)
is answered on the contents first and goes out to the files that hold them last.
"""

from __future__ import annotations

import ast
import gc
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcelens.functions import text as T

RECORD_SCHEMA = (
    "content_sha binary, rec string, kind string, name string, lineno int, end_lineno int, bfs_order int, "
    "alias_pos int, seg_start int, seg_end int, status string, error string"
)
_TYPES = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
_ARROW_SCHEMA = pa.schema([(n, _TYPES[t]) for n, t in (c.split() for c in RECORD_SCHEMA.split(", "))])
KEYS = ["project", "path"]

# Section texts and lookup messages ({...} are filled per row).
SKELETON_HEADING = "## Project Skeleton\n"
SKELETON_ENTRY = "### {path}\n{names}"
SKELETON_NAME_SEP = ", "
IMPORTED_HEADING = "## Imported Files\n"
IMPORTED_SEP = "\n\n---\n\n"
HIT_DEFINED = "DEFINED  {path}:{lineno}"
HIT_CALLED = "CALLED   {path}:{lineno}"
MSG_NOT_FOUND_IN_PROJECT = "'{symbol}' not found in project"
MSG_NOT_FOUND_IN_FILE = "'{name}' not found in {path}"
MSG_NO_SOURCE = "Could not extract source for '{name}'"
MSG_PARSE_ERROR = "Error parsing '{path}': {error}"


# ---------------------------------------------------------------------------
# Parsing (inside tasks)
# ---------------------------------------------------------------------------
def _segment_offsets(content: str):
    """Character offsets of a node's source segment, as ``ast.get_source_segment`` cuts it.

    The segment runs from (lineno, col_offset) to (end_lineno, end_col_offset); lines are
    split on CRLF, CR and LF (the parser's line breaks) and column offsets are UTF-8 bytes.
    """
    starts = [0] + [m.end() for m in re.finditer(r"\r\n|\r|\n", content)]
    plain = content.isascii()

    def char_at(lineno: int, col: int) -> int:
        begin = starts[lineno - 1]
        if plain:
            return begin + col
        end = starts[lineno] if lineno < len(starts) else len(content)
        return begin + len(content[begin:end].encode("utf-8")[:col].decode("utf-8", errors="ignore"))

    def segment(node):
        if getattr(node, "end_lineno", None) is None or getattr(node, "end_col_offset", None) is None:
            return None, None
        return char_at(node.lineno, node.col_offset), char_at(node.end_lineno, node.end_col_offset)

    return segment


# One builder per syntax node that the index keeps: (rec, kind, name, position among its siblings).
def _defines(kind: str):
    return lambda node: (("def", kind, node.name, None),)


def _names_a_call(node: ast.Call):
    """A plain name or the last attribute; calls of other expressions have none."""
    name = getattr(node.func, "id", getattr(node.func, "attr", None))
    return () if name is None else (("call", None, name, None),)


def _imports_modules(node: ast.Import):
    return [("import", None, alias.name, at) for at, alias in enumerate(node.names)]


def _imports_from(node: ast.ImportFrom):
    """F8: an absolute module; relative imports never resolve."""
    return (("import", None, node.module, 0),) if node.module and not node.level else ()


_BUILDERS = {
    ast.FunctionDef: _defines("function"),
    ast.AsyncFunctionDef: _defines("async"),
    ast.ClassDef: _defines("class"),
    ast.Call: _names_a_call,
    ast.Import: _imports_modules,
    ast.ImportFrom: _imports_from,
}


class _ChildFields(dict):
    """Per node type: the fields that can hold nodes; those that only hold names, numbers and constants are left out."""

    _PLAIN = (str, int, object, str | None, int | None)

    def __missing__(self, kind):
        types = getattr(kind, "_field_types", {})  # without it (before Python 3.13) every field is looked at
        self[kind] = found = tuple(n for n in kind._fields if types.get(n, ast.AST) not in self._PLAIN)
        return found


_CHILD_FIELDS = _ChildFields()


def walk(tree: ast.AST):
    """All nodes in the order of ``ast.walk``, which takes most of its time in generators and plain fields."""
    nodes, node_type = [tree], ast.AST
    for node in nodes:  # grows while it is read
        for name in _CHILD_FIELDS[type(node)]:
            value = getattr(node, name, None)
            if isinstance(value, list):
                nodes += [v for v in value if isinstance(v, node_type)]
            elif isinstance(value, node_type):
                nodes.append(value)
    return nodes


def content_records(sha: bytes, content: str):
    """Records of one content in walk order, its own status first."""
    try:
        tree = ast.parse(content)
    except SyntaxError as e:
        return [(sha, "file", *[None] * 8, "syntax_error", str(e))]
    except Exception as e:  # deep nesting etc.: reported, never fatal
        return [(sha, "file", *[None] * 8, "error", f"{type(e).__name__}: {e}")]
    out, segment = [(sha, "file", *[None] * 8, "ok", None)], None
    for order, node in enumerate(walk(tree)):
        build = _BUILDERS.get(type(node))
        for rec, kind, name, at in build(node) if build else ():
            ends, cut = None, (None, None)
            if rec == "def":  # E5 as offsets into the file: the text is cut only for lookups that need it
                segment = segment or _segment_offsets(content)
                ends, cut = node.end_lineno, segment(node)
            out.append((sha, rec, kind, name, node.lineno, ends, order, at, *cut, None, None))
    return out


def _batch_records(batch):
    """Records of a batch of contents. A tree has no cycles and goes with its last reference, so the collector, which
    would go through the same nodes and rows again and again, waits until the batch is done."""
    paused = gc.isenabled()
    gc.disable()
    try:
        return [r for sha, content in zip(*(c.to_pylist() for c in batch.columns)) for r in content_records(sha, content)]
    finally:
        if paused:
            gc.enable()


def _parse_batches(batches):
    for batch in batches:
        rows = _batch_records(batch)
        for at in range(0, len(rows), 50_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows[at:at + 50_000]), _ARROW_SCHEMA)], schema=_ARROW_SCHEMA)


# ---------------------------------------------------------------------------
# The store
# ---------------------------------------------------------------------------
@dataclass
class ParseStore:
    """``paths(project, path, content_sha)`` and ``records`` (``RECORD_SCHEMA``) of every content.

    A file without content has a null hash and no records.
    """

    paths: DataFrame
    records: DataFrame
    _hot: list = field(default_factory=list, repr=False)

    @property
    def sparkSession(self) -> SparkSession:
        return self.paths.sparkSession

    def cache(self) -> ParseStore:
        return ParseStore(self.paths.cache(), self.records.cache())

    def of(self, rec: str) -> DataFrame:
        return self.records.where(F.col("rec") == rec)

    def where(self, condition) -> DataFrame:
        """Records at every file that holds their content, filtered before they go out to the files."""
        return self.at_files(self.records.where(condition))

    def at_files(self, records: DataFrame) -> DataFrame:
        """Records of contents as records of the files that hold them."""
        columns = [c for c in records.columns if c != "content_sha"]
        each = records.groupBy("content_sha").agg(F.collect_list(F.struct(*columns)).alias("_r"))  # one content's own
        return self.to_files(each).select(*KEYS, "content_sha", F.inline("_r"))

    def to_files(self, each: DataFrame, how: str = "inner") -> DataFrame:
        """Join one row per content to its files. A content that many files hold is a hot key and is salted."""
        from sourcelens.plans.joins import hot_keys, join_hot_keys

        if not self._hot:
            self._hot.append(hot_keys(self.paths.where("content_sha is not null"), ["content_sha"]))
        return join_hot_keys(self.paths, each, ["content_sha"], how, salt_by=KEYS, hot=self._hot[0])

    def at_targets(self, targets: DataFrame, small: bool | None = None) -> ParseStore:
        """The store of some files only: their paths, and the records of the contents they hold."""
        from sourcelens.plans.joins import join_small

        paths = join_small(self.paths, targets.select(*KEYS).distinct(), KEYS, "left_semi", known_small=small)
        if small is False:  # records meet their files in every question, which leaves out the others: no join before it
            return ParseStore(paths, self.records, self._hot)
        shas = paths.select("content_sha").distinct()
        return ParseStore(paths, join_small(self.records, shas, ["content_sha"], "left_semi", known_small=small))

    def keep(self, name: str) -> ParseStore:
        """Write both tables in the shared checkpoint dir and read them back."""
        from sourcelens.session import shared_table_path, write_and_read

        out = shared_table_path(self.sparkSession, name, release=True)
        _write_records(self.records, out)
        return ParseStore(write_and_read(self.paths, f"{name}_paths"), _read_records(self.sparkSession, out))


# Bytes of a content's SHA-256 that are its key. Two of 10**12 contents agree in 128 bits with a probability below 1e-14.
SHA_BYTES = 16


def with_sha(files: DataFrame) -> DataFrame:
    """``files`` with the hash of each content, as its first ``SHA_BYTES`` bytes: every path and record repeats it, and
    as no codec shortens it, it is most of what is written of them."""
    sha = F.substring(F.sha2(F.col("content"), 256), 1, 2 * SHA_BYTES)
    return files.select(*KEYS, "content", F.unhex(sha).alias("content_sha"))


def parse_contents(hashed: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Records of every distinct content of ``hashed(content_sha, content)`` that is not ``known`` yet.

    Known hashes go first (anti join), then equal contents become one row, on the map side
    already, so a text is parsed once however many files hold it.
    """
    from sourcelens.session import ship_package

    ship_package(hashed.sparkSession)
    contents = hashed.where(F.col("content").isNotNull()).select("content_sha", "content")
    if known is not None:
        contents = contents.join(known.select("content_sha").distinct(), "content_sha", "left_anti")
    one = contents.groupBy("content_sha").agg(F.first("content").alias("content"))
    return one.mapInArrow(_parse_batches, RECORD_SCHEMA)


def extract(files: DataFrame) -> ParseStore:
    """The parse store of ``files(project, path, content)``.

    Keep it (``keep`` or ``write_index``) when several questions are asked of it.
    """
    hashed = with_sha(files)
    return ParseStore(hashed.select(*KEYS, "content_sha"), parse_contents(hashed))


def refresh_index(files: DataFrame, index: ParseStore) -> ParseStore:
    """Incremental re-index: parse only contents that the store does not know.

    A moved, copied or renamed file costs a row of the map. Records of contents that no file
    holds any more are dropped. Write the result as a new index version.
    """
    hashed = with_sha(files)
    paths = hashed.select(*KEYS, "content_sha")
    held = paths.select("content_sha").distinct()
    kept = index.records.join(held, "content_sha", "left_semi")
    return ParseStore(paths, kept.unionByName(parse_contents(hashed, index.of("file"))))


# Rows of a page of the written records: what a lookup by name reads at least of a file that may hold the name.
PAGE_ROWS = 1_000


def _write_records(records: DataFrame, out_dir: str) -> None:
    """Records by type as the parser's tasks give them: nothing is shuffled, and every text is parsed once.

    Each file is sorted by name, so a lookup by name reads the few pages of a file whose bounds hold the name; what is
    asked for by content alone (imports, states) is sorted by content, so a content's rows lie side by side.
    """
    by_name = F.when(F.col("rec").isin("def", "call"), F.col("name"))
    ordered = records.sortWithinPartitions("rec", by_name, "content_sha")
    (ordered.write.mode("overwrite").partitionBy("rec").option("compression", "zstd")
     .option("parquet.page.row.count.limit", str(PAGE_ROWS)).parquet(out_dir))


def _read_records(spark: SparkSession, out_dir: str) -> DataFrame:
    """Written records; without any, the folder has no files to tell the columns from."""
    return spark.read.schema(RECORD_SCHEMA).parquet(out_dir)


def write_index(index: ParseStore, out_dir: str) -> None:
    """Write the records partitioned by record type, so each lookup reads one slice, and the paths beside them."""
    _write_records(index.records, out_dir)
    index.paths.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/_paths")


def read_index(spark: SparkSession, out_dir: str) -> ParseStore:
    return ParseStore(spark.read.parquet(f"{out_dir.rstrip('/')}/_paths"), _read_records(spark, out_dir))


# ---------------------------------------------------------------------------
# Questions
# ---------------------------------------------------------------------------
def definitions(index: ParseStore) -> DataFrame:
    return index.where(F.col("rec") == "def").select(*KEYS, "kind", "name", "lineno", "end_lineno", "bfs_order")


def definition_source(defs: DataFrame, files: DataFrame, small: bool | None = None) -> DataFrame:
    """E5: source text of the given definitions ``(project, path, seg_start, seg_end, ...)``.

    The index keeps only character offsets; the text is cut from the file content here, for
    the requested definitions only (their files are filtered where the file table is read).
    """
    from sourcelens.plans.joins import join_small

    paths = defs.select(*KEYS).distinct()
    content = join_small(files.select(*KEYS, "content"), paths, KEYS, "left_semi", known_small=small)
    return defs.join(content, KEYS, "left").withColumn("source", _segment()).drop("content")


def _segment():
    """A definition's text, cut from its content."""
    return F.when(F.col("seg_start").isNotNull(),
                  F.substring(F.col("content"), F.col("seg_start") + 1, F.col("seg_end") - F.col("seg_start")))


def calls(index: ParseStore) -> DataFrame:
    return index.where(F.col("rec") == "call").select(*KEYS, "name", "lineno", "bfs_order")


def imports(index: ParseStore) -> DataFrame:
    return index.where(F.col("rec") == "import").select(
        *KEYS, F.col("name").alias("module"), "lineno", "bfs_order", "alias_pos"
    )


def parse_status(index: ParseStore) -> DataFrame:
    """One row per file with ok / syntax_error / error / unreadable."""
    found = index.to_files(index.of("file").select("content_sha", "status", "error"), "left")
    status = F.when(F.col("content_sha").isNull(), F.lit("unreadable")).otherwise(F.col("status"))
    return found.select(*KEYS, status.alias("status"), "error")


def skeleton_entries(index: ParseStore) -> DataFrame:
    """A1: per file ``### <path>\\n<n1, n2, ...>`` with names in walk order, duplicates kept.

    Files without definitions have no entry (F9). The names are put in order once per content.
    """
    g = index.of("def").groupBy("content_sha").agg(
        F.array_sort(F.collect_list(F.struct("bfs_order", "name"))).alias("defs"))
    names = g.select("content_sha", F.size("defs").cast("bigint").alias("n_names"),
                     F.array_join(F.col("defs.name"), SKELETON_NAME_SEP).alias("names"))
    return index.to_files(names).select(
        *KEYS, "n_names", T.fill(SKELETON_ENTRY, path="path", names="names").alias("entry"))


def skeleton_sizes(entries: DataFrame) -> DataFrame:
    """Per project: character count of the skeleton section, from decomposable sums.

    The section text itself is the per-file entries in ``path`` order joined by newlines;
    its length needs no concatenation, so a project of any size stays one small row.
    """
    return entries.groupBy("project").agg(
        F.count("*").cast("bigint").alias("n_entries"),
        (
            F.lit(len(SKELETON_HEADING))
            + F.sum(F.length("entry"))
            + F.greatest(F.count("*") - 1, F.lit(0))
        ).cast("bigint").alias("skeleton_chars"),
    )


# Characters of skeleton text in one chunk row; the entry that reaches the end of a chunk is its last.
CHUNK_CHARS = 16_384


def skeleton_chunks(entries: DataFrame, chunk_chars: int | None = None) -> DataFrame:
    """Per project: the skeleton section as chunks ``(project, chunk_no, text)``, bounded in size.

    Entries are in ``path`` order. An entry's place in the text follows from the lengths of
    those before it (prefix sums over ranges of paths), and its place decides its chunk, so a
    project of any size is cut without being gathered. The chunks in order are the section;
    the first has its heading.
    """
    from sourcelens.plans.order import running_total

    size = CHUNK_CHARS if chunk_chars is None else chunk_chars
    placed = running_total(entries.select("project", "path", "entry"), ["project"], ["path"],
                           F.length("entry") + 1, "_start")
    cut = placed.withColumn("chunk_no", F.floor(F.col("_start") / size))
    chunks = cut.groupBy("project", "chunk_no").agg(  # at most a chunk and its last entry
        F.array_sort(F.collect_list(F.struct("_start", "entry"))).alias("e"))
    before = F.when(F.col("chunk_no") == 0, F.lit(SKELETON_HEADING)).otherwise(F.lit("\n"))
    return chunks.select("project", "chunk_no", F.concat(before, F.array_join(F.col("e.entry"), "\n")).alias("text"))


# Paths of files that can be imported.
MODULE_RE = r"[^/]\.py$"


def modules(files: DataFrame) -> DataFrame:
    """``modules(project, module_key, path)``: dotted key of every .py file.

    Two files mapping to one key (``a/b.py`` and ``a.b.py``) keep the smallest path.
    """
    py = files.where(F.col("path").rlike(MODULE_RE)).select("project", "path")
    return py.groupBy("project", T.module_key("path").alias("module_key")).agg(F.min("path").alias("path"))


def resolve_imports(index: ParseStore, files: DataFrame, content=None) -> DataFrame:
    """Imports joined to the module map on (project, key), with the module's content.

    Inner equi-join: unresolved imports drop out, duplicates stay. Every module is picked among
    the files of its key, with its content, where the imports meet it, so a text is shuffled
    once; a module imported by many targets is a hot key there and is salted (``join_hot_keys``).
    The imports are written once: they are counted for hot keys and then joined. ``content``
    (default: the text) is what is wanted of a module's file, so a length costs no text in any shuffle.
    """
    from pyspark.sql import Window

    from sourcelens.plans.joins import join_hot_keys
    from sourcelens.session import write_and_read

    imp = write_and_read(imports(index), "imports")
    wanted = F.col("content") if content is None else content
    keyed = files.where(F.col("path").rlike(MODULE_RE)).select(
        "project", T.module_key("path").alias("module"), F.col("path").alias("resolved_path"), wanted.alias("resolved_content"))
    first = F.min("resolved_path").over(Window.partitionBy("project", "module"))
    dim = keyed.withColumn("_first", first).where(F.col("resolved_path") == F.col("_first")).drop("_first")
    return join_hot_keys(imp, dim, ["project", "module"], "inner", salt_by=["path", "bfs_order", "alias_pos"])


def imported_sections(resolved: DataFrame) -> DataFrame:
    """A5: per target, resolved contents in walk order joined by the separator.

    The group is one target's own imports (bounded by that file's length).
    """
    g = resolved.groupBy("project", "path").agg(
        F.array_sort(F.collect_list(F.struct("bfs_order", "alias_pos", "resolved_content"))).alias("r")
    )
    return g.select(
        "project",
        "path",
        F.concat(F.lit(IMPORTED_HEADING), F.array_join(F.col("r.resolved_content"), IMPORTED_SEP)).alias(
            "imported_section"
        ),
    )


# So many names are looked up by a filter on the name-ordered records, more by a join.
NAMES_PUSHED = 200


def symbol_hits(index: ParseStore) -> DataFrame:
    """Definitions and calls of every content as one relation (UNION ALL)."""
    cols = ["content_sha", F.col("name").alias("symbol"), "bfs_order", "lineno"]
    return index.of("def").select(*cols, F.lit("DEFINED").alias("kind")).unionByName(
        index.of("call").select(*cols, F.lit("CALLED").alias("kind")))


def search_symbols(requested: DataFrame, index: ParseStore, small: bool | None = None) -> DataFrame:
    """Requested ``(project, symbol)`` against the hit relation; not-found rows added.

    The requested names go to the records (broadcast when proven small), so these are
    filtered where they are read and a hot name such as ``run`` is never a shuffle key. A
    content's hits then go out to its files in one row, and what the project did not ask for
    is dropped there. Misses are an anti join against the found names only.
    """
    from sourcelens.plans.joins import join_hot_keys, small_side
    from sourcelens.session import checkpoint, write_and_read

    req = requested.select("project", "symbol").distinct()
    if small is None:  # written once: it is counted, and read by three steps
        req, small = small_side(write_and_read(req, "symbols_asked"), materialize=False)
    names = req.select("symbol").distinct()
    hits = symbol_hits(index)
    pushed = names.limit(NAMES_PUSHED + 1).collect() if small else []
    if small and len(pushed) <= NAMES_PUSHED:  # few names are a filter that the scan skips pages by
        hits = hits.where(F.col("symbol").isin([r["symbol"] for r in pushed]))
    elif small:
        hits = hits.join(F.broadcast(names), "symbol", "left_semi")
    else:  # too many names to broadcast: hot names (``run``) are salted, the rest shuffle-joined
        hits = join_hot_keys(hits, names, ["symbol"], "inner", salt_by=["content_sha", "bfs_order"])
    each = hits.groupBy("content_sha").agg(
        F.collect_list(F.struct("symbol", "bfs_order", "lineno", "kind")).alias("_h"))  # one content's own hits
    placed = index.to_files(each).select(*KEYS, F.inline("_h"))
    if small:
        j = placed.join(F.broadcast(req), ["project", "symbol"], "left_semi")
    else:
        j = join_hot_keys(placed, req, ["project", "symbol"], "inner", salt_by=["path", "bfs_order"])
    hit = F.when(F.col("kind") == "DEFINED", T.fill(HIT_DEFINED, path="path", lineno="lineno")).otherwise(
        T.fill(HIT_CALLED, path="path", lineno="lineno"))
    # Materialised once: the output and the anti join both read it (one index scan).
    found = checkpoint(j.select("project", "symbol", "path", "bfs_order", "lineno", "kind", hit.alias("hit")))
    missing = req.join(found.select("project", "symbol").distinct(), ["project", "symbol"], "left_anti").select(
        "project",
        "symbol",
        F.lit(None).cast("string").alias("path"),
        F.lit(None).cast("int").alias("bfs_order"),
        F.lit(None).cast("int").alias("lineno"),
        F.lit("NONE").alias("kind"),
        T.fill(MSG_NOT_FOUND_IN_PROJECT, symbol="symbol").alias("hit"),
    )
    return found.unionByName(missing)


def get_definitions(requested: DataFrame, index: ParseStore, files: DataFrame, small: bool | None = None) -> DataFrame:
    """J7 + W2 + E5: first definition in walk order per requested ``(project, path, name)``.

    Requests become (content, name) pairs; the definitions are semi-joined with those first
    (broadcast when proven small), then ``min_by`` over ``bfs_order`` picks the first hit (no
    sort of the group). The source is cut once per content and name, whatever the number of
    files asked about. ``status`` says ok / not_found / parse_error / missing; misses and
    unparseable files have the reference's messages as ``output``.
    """
    from sourcelens.plans.joins import hot_keys, join_hot_keys, join_small, small_side
    from sourcelens.session import write_and_read

    req = requested.select(*KEYS, "name").distinct()
    if small is None:
        req, small = small_side(req)
    # every side below has at most as many rows as the requests
    paths = join_small(index.paths, req.select(*KEYS).distinct(), KEYS, "left_semi", known_small=small) if small else index.paths
    asked = req.join(paths.withColumn("listed", F.lit(True)), KEYS, "left")
    if not small:  # read by four steps
        asked = write_and_read(asked, "asked")
    pairs = asked.where(F.col("content_sha").isNotNull()).select("content_sha", "name").distinct()
    d = join_small(index.of("def").select("content_sha", "name", "lineno", "bfs_order", "seg_start", "seg_end"),
                   pairs, ["content_sha", "name"], "left_semi", known_small=small)
    first = d.groupBy("content_sha", "name").agg(
        F.min_by(F.struct("lineno", "seg_start", "seg_end"), "bfs_order").alias("w")).select("content_sha", "name", "w.*")
    if small:
        holders = paths.groupBy("content_sha").agg(F.min(F.struct(*KEYS)).alias("f")).select("content_sha", "f.*")
        source = definition_source(first.join(holders, "content_sha"), files, small).drop(*KEYS)
    else:  # copies become one text per content on the map side, which is shuffled once
        held = with_sha(files).where(F.col("content_sha").isNotNull()).groupBy("content_sha").agg(F.first("content").alias("content"))
        source = first.join(held, "content_sha", "left").withColumn("source", _segment()).drop("content")
    state = join_small(index.of("file").select("content_sha", F.col("status").alias("parsed"), "error"),
                       pairs.select("content_sha").distinct(), ["content_sha"], "left_semi", known_small=small)
    if small:
        j = asked.join(source, ["content_sha", "name"], "left").join(state, "content_sha", "left")
    else:  # many files may hold one content
        hot = hot_keys(asked.where(F.col("content_sha").isNotNull()), ["content_sha"])  # the next join keeps these rows
        j = join_hot_keys(asked, source, ["content_sha", "name"], "left", salt_by=KEYS)
        j = join_hot_keys(j, state, ["content_sha"], "left", salt_by=[*KEYS, "name"], hot=hot)
    ok = F.col("parsed") == "ok"
    status = (F.when(ok & F.col("lineno").isNotNull(), "ok").when(ok, "not_found")
              .when(F.col("parsed").isNotNull(), "parse_error").otherwise("missing"))
    output = (
        F.when(F.col("status") == "ok", F.coalesce(F.col("source"), T.fill(MSG_NO_SOURCE, name="name")))
        .when(F.col("status") == "not_found", T.fill(MSG_NOT_FOUND_IN_FILE, name="name", path="path"))
        .otherwise(T.fill(MSG_PARSE_ERROR, path="path", error=F.coalesce("error", F.lit("file not found"))))
    )
    return j.withColumn("status", status).select(
        *KEYS, "name", F.col("lineno").cast("bigint").alias("lineno"),
        (F.col("status") == "ok").cast("bigint").alias("found"), output.alias("output"), "status", "error",
    )


def ordered_hits(hits: DataFrame) -> DataFrame:
    """O1: search results with their ``position`` in presentation order: per symbol, files by path
    (what was not found last), and definitions and calls interleaved in walk order within a file.

    A total order over all results as a column, found without sorting them in one place.
    """
    from sourcelens.plans.order import positions

    missing = hits.withColumn("_missing", F.col("path").isNull())
    return positions(missing, ["project", "symbol", "_missing", "path", "bfs_order"]).drop("_missing")
