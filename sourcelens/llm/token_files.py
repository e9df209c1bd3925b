"""Token ids in binary files: each document compressed by itself with one shared zstandard dictionary.

A file holds frames and an offset index, so one short document is read without touching the others::

    b"TIDS" | dictionary hash (32 bytes) | id width (1 byte) | frames ...
    | index: doc_id int64, offset uint64, size uint32, tokens uint32, named uint8 per document | count uint32 | b"TIDX"

The dictionary lies beside the files under its hash; a reader refuses any other. Files are written by
tasks over ranges of doc_id, under names of their own, so a lost task leaves at most a file that no
manifest names. The manifest (one row per file) is a Spark table.

Null and empty texts are the end id alone. A null doc_id comes before all others and is an entry that is not
``named``. Repeated rows become repeated entries, next to each other. An empty table gives an empty manifest.
Extra columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sourcelens.session import shared_table_path

from .common import scratch, text_of
from .token_ids import encoder

MAGIC, FOOT = b"TIDS", b"TIDX"
HEAD = len(MAGIC) + 32 + 1
ENTRY = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("size", "<u4"), ("tokens", "<u4"), ("named", "u1")])
#: A file is closed once its frames reach this size.
FILE_BYTES = 32 << 20
LEVEL = 3
#: The dictionary is trained on at most this many documents, those of least hash, and on so many code points of each.
SAMPLE_DOCS, SAMPLE_CHARS, DICT_BYTES = 800, 4_000, 32 << 10
#: Bytes of files that one task reads back.
READ_BYTES = 8 << 20
MANIFEST = "path string, part int, file int, first_doc long, last_doc long, n_docs long, tokens long, bytes long"


def _files(base: str):
    from pyarrow import fs

    if "://" in base or base.startswith("file:"):
        return fs.FileSystem.from_uri(base if "://" in base else "file://" + base[5:])
    return fs.LocalFileSystem(), base


def train_dictionary(docs: DataFrame, tokenizer: str, cut: str | None, end_id: int, text: str = "text") -> bytes:
    """A dictionary from a bounded sample; empty where the sample is too small to train one."""
    import zstandard

    spread = F.xxhash64(F.col("doc_id"), text_of(text)).alias("h")
    least = docs.select(spread).orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    if least is None:
        return b""
    # Rows that repeat share their hash: as many as the sample holds are enough.
    rows = docs.select(spread, F.substring(text_of(text), 1, SAMPLE_CHARS).alias("t")).where(
        F.col("h") <= least).limit(SAMPLE_DOCS).collect()
    rows.sort()
    coder = encoder(tokenizer, cut)
    end = np.array([end_id], coder.dtype).tobytes()
    samples = [ids + end for ids in coder.encode([r["t"] for r in rows])]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes):
    import zstandard

    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=False)


def _decompressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


class _Writer:
    """One file at a time below ``base``; ``rows`` collects the manifest."""

    def __init__(self, base: str, part: int, mark: bytes, width: int):
        self.files, self.base = _files(base)
        self.part, self.mark, self.width, self.rows, self.count = part, mark, width, [], 0
        self._open()

    def _open(self):
        self.body, self.size, self.index = [MAGIC + self.mark + bytes([self.width])], HEAD, []

    def add(self, doc: int | None, frame: bytes, tokens: int):
        self.index.append((doc or 0, self.size, len(frame), tokens, doc is not None))
        self.body.append(frame)
        self.size += len(frame)
        if self.size >= FILE_BYTES:
            self.close()

    def close(self):
        if not self.index:
            return
        index = np.array(self.index, ENTRY)
        path = f"{self.base}/{self.part:06d}-{self.count:05d}-{uuid.uuid4().hex}.tids"
        tail = index.tobytes() + np.uint32(len(index)).astype("<u4").tobytes() + FOOT
        with self.files.open_output_stream(path) as out:
            for piece in self.body:
                out.write(piece)
            out.write(tail)
        self.rows.append((path.rsplit("/", 1)[1], self.part, self.count, int(index["doc_id"][0]),
                          int(index["doc_id"][-1]), len(index), int(index["tokens"].sum()), self.size + len(tail)))
        self.count += 1
        self._open()


def write(docs: DataFrame, tokenizer: str, cut: str | None, end_id: int, text: str = "text",
          base: str | None = None) -> tuple[str, DataFrame]:
    """Write all documents in ascending doc_id order; the folder and the manifest of its files.

    The manifest has ``start``, the number of ids in all files before.
    """
    spark = docs.sparkSession
    base = (base or shared_table_path(spark, "token-files")).rstrip("/")
    dictionary = train_dictionary(docs, tokenizer, cut, end_id, text)
    mark = hashlib.sha256(dictionary).digest()
    files, root = _files(base)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/{mark.hex()}.dict") as out:
        out.write(dictionary)

    def store(batches):
        from pyspark import TaskContext

        coder = encoder(tokenizer, cut)
        width = coder.dtype.itemsize
        end, press = np.array([end_id], coder.dtype).tobytes(), _compressor(dictionary)
        out = _Writer(base, TaskContext.get().partitionId(), mark, width)
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist())):
                ids += end
                out.add(doc, press.compress(ids), len(ids) // width)
        out.close()
        if out.rows:
            names = [x.split()[0] for x in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out.rows], pa.schema(
                [(n, pa.string() if n == "path" else pa.int32() if n in ("part", "file") else pa.int64())
                 for n in names]))

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(text).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id"))
    made = scratch(ordered.mapInArrow(store, MANIFEST), "token-manifest")
    # Parts are ranges of doc_id in order: one row a part, then the files of each part by themselves.
    upto = lambda w: F.coalesce(F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = made.groupBy("part").agg(F.sum("tokens").alias("tokens")).select(
        "part", upto(Window.orderBy("part")).alias("base"))
    inside = upto(Window.partitionBy("part").orderBy("file"))
    return base, made.withColumn("inside", inside).join(parts, "part").withColumn(
        "start", F.col("base") + F.col("inside")).drop("base", "inside")


def _dictionary(base: str, mark: bytes) -> bytes:
    files, root = _files(base)
    with files.open_input_stream(f"{root}/{mark.hex()}.dict") as f:
        data = f.read()
    if hashlib.sha256(data).digest() != mark:
        raise ValueError("the dictionary is not the one the file was written with")
    return data


def _index(data, size: int) -> np.ndarray:
    """The offset index from the end of an open file."""
    data.seek(size - 8)
    tail = data.read(8)
    if tail[4:] != FOOT:
        raise ValueError("not a whole file")
    count = int(np.frombuffer(tail[:4], "<u4")[0])
    data.seek(size - 8 - count * ENTRY.itemsize)
    return np.frombuffer(data.read(count * ENTRY.itemsize), ENTRY)


def _head(data) -> tuple[bytes, np.dtype]:
    data.seek(0)
    head = data.read(HEAD)
    if head[:4] != MAGIC:
        raise ValueError("not a token file")
    return head[4:36], np.dtype(f"<u{head[36]}")


def read(base: str, manifest: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32, and the ids themselves on request."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")

    def load(batches):
        known: dict = {}
        files, root = _files(base)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                with files.open_input_file(f"{root}/{path}") as data:
                    mark, dtype = _head(data)
                    if mark not in known:
                        known[mark] = _decompressor(_dictionary(base, mark))
                    index = _index(data, data.size())
                    for at in range(0, len(index), 2_000):
                        some = index[at:at + 2_000]
                        data.seek(int(some["offset"][0]))
                        body = data.read(int(some["offset"][-1] + some["size"][-1] - some["offset"][0]))
                        crcs, ids, base_at = [], [], int(some["offset"][0])
                        for x in some:
                            o = int(x["offset"]) - base_at
                            own = np.frombuffer(known[mark].decompress(body[o:o + int(x["size"])]), dtype)
                            if len(own) != x["tokens"]:
                                raise ValueError(f"{path}: the index and a frame disagree")
                            own = own.astype("<u4")
                            crcs.append(zlib.crc32(own.tobytes()))
                            if keep_ids:
                                ids.append(own.astype(np.int64))
                        tokens = some["tokens"].astype(np.int64)
                        starts = start + np.cumsum(tokens) - tokens
                        start += int(tokens.sum())
                        columns = [pa.array(some["doc_id"].astype(np.int64), mask=some["named"] == 0), pa.array(starts), pa.array(tokens),
                                   pa.array(crcs, pa.int64())]
                        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                        if keep_ids:
                            columns.append(pa.array(ids, pa.list_(pa.int64())))
                            names.append("ids")
                        yield pa.RecordBatch.from_arrays(columns, names)

    held = manifest.agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes")).first()
    tasks = max(1, min(held["files"], max(-(-(held["bytes"] or 0) // READ_BYTES), base_tasks(manifest))))
    return manifest.select("path", "start").repartition(tasks).mapInArrow(load, schema)


def base_tasks(df: DataFrame) -> int:
    """Tasks the session runs at once."""
    return df.sparkSession.sparkContext.defaultParallelism


def read_document(base: str, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (of each of its repeats), by the offset index alone."""
    files, root = _files(base)
    with files.open_input_file(f"{root}/{path}") as data:
        mark, dtype = _head(data)
        index, unzip, out = _index(data, data.size()), _decompressor(_dictionary(base, mark)), []
        for x in index[(index["doc_id"] == doc_id) & (index["named"] == 1)]:
            data.seek(int(x["offset"]))
            out.append(np.frombuffer(unzip.decompress(data.read(int(x["size"]))), dtype))
        return out
