"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

Layout of a data set (a folder in the shared store):

* ``shard-<n>-<attempt>.bin`` — the ids of consecutive documents, little
  endian, two bytes an id where the vocabulary has at most 65 536 ids, else four;
* ``shard-<n>-<attempt>.idx`` — three little-endian 64-bit integers a
  document: 1 or 0 (whether it has a doc_id), doc_id, and the document's end
  in the shard's ids;
* ``manifest.json`` — id width, end id, and each shard's file names, counts
  and bases (documents and ids before it): prefix sums of the shards' counts.

Writing: one range shuffle puts documents in ascending doc_id order (repeated
ids by text hash, so that one id may fill several partitions), each task
encodes its rows batch by batch and streams ids to its own pair of files.
File names hold the task attempt and the manifest lists only files of
committed attempts, so a task that ran twice does no harm.  Only one row a
shard reaches the driver.  Reading: one task a shard maps its files into
memory; a document's global start is base plus local offset.

Null texts are empty documents (the end id alone); a null doc_id sorts first
and stays null; repeated rows are separate documents; an empty table gives a
manifest without shards; other columns are not read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .common import in_tasks, steps
from .encode import encoder, with_end

SHARD_ROW = "shard int, bin string, idx string, n_docs long, n_tokens long, width int"


def _open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    return (pafs.LocalFileSystem(use_mmap=True), path) if fs.type_name == "local" else (fs, path)


def write_token_files(docs: DataFrame, folder: str, vocab_path: str, drop_space: bool, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Encode every document, append ``end_id``, write the data set; returns the manifest."""
    spark = docs.sparkSession

    def write(batches) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab_path, drop_space)
        context = TaskContext.get()
        shard = context.partitionId()
        base = f"shard-{shard:06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        fs, path = _open_fs(folder)
        fs.create_dir(path, recursive=True)
        n_docs = n_tokens = 0
        out = idx = None
        for b in steps(batches, "text"):
            if out is None:
                out, idx = fs.open_output_stream(f"{path}/{base}.bin"), fs.open_output_stream(f"{path}/{base}.idx")
            ids, rows = with_end(*enc.encode(b.column(1)), end_id)
            out.write(ids.astype(ids.dtype.newbyteorder("<"), copy=False).tobytes())
            key = b.column(0)
            entry = np.empty((b.num_rows, 3), "<i8")
            entry[:, 0] = pc.is_valid(key).to_numpy(zero_copy_only=False)
            entry[:, 1] = pc.fill_null(key, 0).to_numpy(zero_copy_only=False)
            entry[:, 2] = rows[1:] + n_tokens
            idx.write(entry.tobytes())
            n_docs += b.num_rows
            n_tokens += len(ids)
        if out is not None:
            out.close()
            idx.close()
            yield pa.RecordBatch.from_pylist([dict(shard=shard, bin=f"{base}.bin", idx=f"{base}.idx", n_docs=n_docs,
                                                   n_tokens=n_tokens, width=enc.dtype().itemsize)],
                                             schema=pa.schema([("shard", pa.int32()), ("bin", pa.string()),
                                                               ("idx", pa.string()), ("n_docs", pa.int64()),
                                                               ("n_tokens", pa.int64()), ("width", pa.int32())]))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = (rows.repartitionByRange("id", F.xxhash64("text"))
               .sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"), "text"))
    written = materialize(ordered.transform(in_tasks(write, SHARD_ROW)), "token_shards")
    shards, docs_before, ids_before = [], 0, 0
    for r in written.orderBy("shard").collect():      # one row a file
        shards.append(r.asDict() | {"doc_base": docs_before, "id_base": ids_before})
        docs_before += r["n_docs"]
        ids_before += r["n_tokens"]
    manifest = {"end_id": end_id, "n_docs": docs_before, "n_tokens": ids_before, "shards": shards}
    fs, path = _open_fs(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(folder: str) -> dict:
    fs, path = _open_fs(folder)
    with fs.open_input_stream(f"{path}/manifest.json") as f:
        return json.loads(f.read())


def read_documents(spark: SparkSession, folder: str, block: int = 20_000) -> DataFrame:
    """Per document (doc_id, start, n_tokens, ids_crc32), from the files alone."""
    shards = read_manifest(folder)["shards"]
    out = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not shards:
        return spark.createDataFrame([], out)

    def read(batches) -> Iterator[pa.RecordBatch]:
        fs, path = _open_fs(folder)
        for b in batches:
            for s in b.to_pylist():
                with fs.open_input_file(f"{path}/{s['idx']}") as f, fs.open_input_file(f"{path}/{s['bin']}") as g:
                    entry = np.frombuffer(f.read_buffer(), "<i8").reshape(-1, 3)
                    ids = np.frombuffer(g.read_buffer(), f"<u{s['width']}")
                    for at in range(0, len(entry), block):
                        part = entry[at:at + block]
                        ends = part[:, 2]
                        starts = np.concatenate(([entry[at - 1, 2] if at else 0], ends[:-1]))
                        crc = np.fromiter((zlib.crc32(ids[x:y].astype("<u4")) for x, y in zip(starts.tolist(), ends.tolist())),
                                          np.int64, len(part))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(part[:, 1], pa.int64(), mask=part[:, 0] == 0), pa.array(starts + s["id_base"]),
                             pa.array(ends - starts), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    keys = ("shard", "bin", "idx", "width", "id_base")
    rows = spark.createDataFrame([tuple(s[k] for k in keys) for s in shards],
                                 "shard int, bin string, idx string, width int, id_base long")
    return rows.repartitionByRange(len(shards), "shard").transform(in_tasks(read, out))


def token_files(docs: DataFrame, vocab_path: str, drop_space: bool, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the data set and read it back."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token_files")
    write_token_files(docs, folder, vocab_path, drop_space, end_id)
    return read_documents(spark, folder)
