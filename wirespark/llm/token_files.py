"""Token ids in flat binary files with 64-bit document offsets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wirespark.llm.common import stored
from wirespark.llm.token_ids import blocks, encoder, with_end

#: Stands for a null doc_id in the files.
NO_DOC = np.iinfo(np.int64).min

_PARTS = "part int, name string, docs bigint, tokens bigint"
_DOCS = "doc_id bigint, start bigint, ids binary"
_READ_IDS = 4_000_000


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and its path there."""
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def id_type(largest: int) -> str:
    """The smallest little-endian unsigned type that holds all ids."""
    return "<u2" if largest < 1 << 16 else "<u4"


def _write(
    batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int
) -> Iterator[pa.RecordBatch]:
    """Write the ids and lengths of a partition; names differ by attempt, so a repeat is safe."""
    context, encode = TaskContext.get(), encoder(tokenizer)
    store, root = open_folder(folder)
    name = f"{context.partitionId():06d}-{context.taskAttemptId()}"
    kind, out = id_type(max(encode.largest_id, end_id)), None
    names, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in batches:
        numbers = batch.column("doc_id").fill_null(int(NO_DOC)).to_numpy()
        for begin, end, texts in blocks(batch.column("text")):
            ids, starts = with_end(*encode.encode(texts), end_id)
            out = out or store.open_output_stream(f"{root}/ids-{name}.bin")
            out.write(ids.astype(kind).tobytes())
            names.append(numbers[begin:end])
            lengths.append(np.diff(starts))
    if out is None:
        return
    out.close()
    lengths = np.concatenate(lengths)
    for what, values in (("docs", np.concatenate(names)), ("lengths", lengths)):
        with store.open_output_stream(f"{root}/{what}-{name}.bin") as file:
            file.write(values.astype("<i8").tobytes())
    row = [[context.partitionId()], [name], [len(lengths)], [int(lengths.sum())]]
    types = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(row, types)], names=["part", "name", "docs", "tokens"]
    )


def _offsets(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Write the offsets of each part: its base and the running sum of its lengths."""
    store, root = open_folder(folder)
    for batch in batches:
        for row in batch.to_pylist():
            lengths = mapped(store, f"{root}/lengths-{row['name']}.bin", "<i8")
            values = row["base"] + np.concatenate([[0], np.cumsum(lengths)])
            with store.open_output_stream(f"{root}/offsets-{row['name']}.bin") as file:
                file.write(values.astype("<u8").tobytes())
        yield batch


def mapped(store: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where the folder is a file system, else read."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r")
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype=kind)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> None:
    """Write the token ids of documents in ascending doc_id order (null first) to ``folder``.

    ``docs`` needs doc_id and text (null: empty); other columns are ignored, repeated rows are
    written as often as they come, an empty table gives a folder without parts. Documents are
    range-partitioned by doc_id (and text, which splits a doc_id that many rows share) and sorted; each
    task encodes its documents and appends the ids, an end id after each document, to one flat
    file of unsigned integers. Then prefix sums over the parts' totals give each part its base,
    and a second pass over the lengths writes global 64-bit offsets (documents + 1 a part).

    The folder must be reachable by all executors. Files: ids-*, docs-* (doc_id), offsets-*
    for each part, and the table ``parts`` (part, name, docs, tokens, base), written last.
    """
    spark = docs.sparkSession
    store, root = open_folder(folder)
    store.create_dir(root, recursive=True)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), F.xxhash64("text")
    )
    write = partial(_write, folder=folder, tokenizer=tokenizer, end_id=end_id)
    parts = stored(ordered.mapInArrow(write, _PARTS), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = parts.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    count = max(1, parts.count())
    based = based.withColumn("type", F.lit(id_type(max(encoder(tokenizer).largest_id, end_id))))
    spread = based.repartitionByRange(count, "part")
    done = spread.mapInArrow(partial(_offsets, folder=folder), based.schema)
    done.write.parquet(f"{folder}/parts")


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, root = open_folder(folder)
    for batch in batches:
        for row in batch.to_pylist():
            ids = mapped(store, f"{root}/ids-{row['name']}.bin", row["type"])
            docs = mapped(store, f"{root}/docs-{row['name']}.bin", "<i8")
            offsets = mapped(store, f"{root}/offsets-{row['name']}.bin", "<u8").astype(np.int64)
            begin = 0
            while begin < len(docs):
                end = np.searchsorted(offsets, offsets[begin] + _READ_IDS, side="right") - 1
                end = min(max(int(end), begin + 1), len(docs))
                lo, hi = offsets[begin] - row["base"], offsets[end] - row["base"]
                data = pa.py_buffer(ids[lo:hi].astype("<u4").tobytes())
                ends = pa.py_buffer(((offsets[begin : end + 1] - offsets[begin]) * 4).tobytes())
                numbers = docs[begin:end]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers, mask=numbers == NO_DOC),
                        pa.array(offsets[begin:end]),
                        pa.LargeBinaryArray.from_buffers(
                            pa.large_binary(), end - begin, [None, ends, data]
                        ).cast(pa.binary()),
                    ],
                    names=["doc_id", "start", "ids"],
                )
                begin = end


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Read token files back: doc_id, start (ids of all documents before it), ids
    (little-endian unsigned 32-bit). A task maps the files of one part."""
    parts = spark.read.parquet(f"{folder}/parts")
    count = max(1, parts.count())
    return parts.repartitionByRange(count, "part").mapInArrow(partial(_read, folder=folder), _DOCS)
