"""Token-id files of a corpus in document order, and their reader.

Documents are dealt by ranges of doc_id, so part files follow each other in ascending order; a task encodes
its range and writes files of ``ids_per_file`` ids. A file appears under its name only when it is whole
(written aside, then renamed), so a task that runs again puts the same file there again.

Nulls and odd cases: a null or empty text is its end id alone; null ids come last; rows that share a
doc_id are written one after the other, by the hash of their text; an empty table gives no files and an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hostlens.llm.common import chunks, doc_key, shuffle_parts
from hostlens.llm.pfor import decode_file, encode_file
from hostlens.llm.tokens import TokenIds
from hostlens.session import materialize, scratch_path

NULL_ID = -(2**63)
WRITTEN = "file string, n_ids long, n_docs long"


def _write(folder: str, path: str, end_id: int, spaced: bool, ids_per_file: int, percentile: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task = TokenIds.of(path, spaced), TaskContext.get()
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        part, parts_of = [], []
        held = n_files = 0

        def put() -> pa.RecordBatch:
            nonlocal held, n_files
            name = f"part-{task.partitionId():06d}-{n_files:06d}.tok"
            doc_ids, lengths = (np.concatenate(x) for x in zip(*parts_of, strict=True))
            data = encode_file(np.concatenate(part), doc_ids, lengths, percentile)
            with store.open_output_stream(aside := f"{base}/_{name}-{task.taskAttemptId()}") as f:
                f.write(data)
            store.move(aside, f"{base}/{name}")
            row = pa.RecordBatch.from_pydict({"file": [name], "n_ids": [int(lengths.sum())], "n_docs": [len(doc_ids)]})
            part.clear()
            parts_of.clear()
            held, n_files = 0, n_files + 1
            return row

        for b in chunks(batches):
            ids = coder.encode(b["text"].to_pylist())
            end = np.array([end_id], coder.kind)
            for x in ids:
                part += [x, end]
            lengths = np.array([len(x) + 1 for x in ids], np.int64)
            parts_of.append((b["doc_id"].fill_null(NULL_ID).to_numpy(), lengths))
            held += int(lengths.sum())
            if held >= ids_per_file:
                yield put()
        if parts_of:
            yield put()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, spaced: bool = False,
                 ids_per_file: int = 1 << 22, percentile: float = 90.0) -> tuple[str, DataFrame]:
    """Writes the files; returns their folder (a fresh one in the shared folder if none is given) and a row per file."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    folder = folder if "://" in folder else folder.replace("file:/", "/", 1) if folder.startswith("file:/") else folder
    rows = docs.select("doc_id", "text", *doc_key())
    rows = rows.repartitionByRange(shuffle_parts(spark), "_id", F.col("doc_id").isNull(), "_row").sortWithinPartitions("_id", F.col("doc_id").isNull(), "_row")
    written = rows.select("doc_id", "text").mapInArrow(_write(folder, tokenizer, end_id, spaced, ids_per_file, percentile), WRITTEN)
    return folder, materialize(written, "token-manifest")


def _read(keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b["file"].to_pylist(), b["content"], strict=True):
                ids, doc_ids, lengths = decode_file(data.as_py())
                ends = np.cumsum(lengths)
                raw = memoryview(ids.astype("<u4").tobytes())
                cut = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                out = {"file": [name] * len(cut), "doc_id": pa.array(doc_ids, mask=doc_ids == NULL_ID), "at": ends - lengths,
                       "n_tokens": lengths, "ids_crc32": [zlib.crc32(x) for x in cut]}
                yield pa.RecordBatch.from_pydict(out | ({"ids": [bytes(x) for x in cut]} if keep_ids else {}))

    return run


def read_tokens(spark: SparkSession, folder: str, written: DataFrame, keep_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ``ids``, little-endian uint32) from the files."""
    if written.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids)
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = written.select("file", before.alias("first"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder)
    rows = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").mapInArrow(
        _read(keep_ids), "file string, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids)
    return rows.join(first, "file").select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * keep_ids)
