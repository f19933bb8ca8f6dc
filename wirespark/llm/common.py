"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirespark.session import new_folder

#: Words are runs of characters other than space and U+0009 to U+000D.
WORD = "[^\\x20\\x09-\\x0D]+"

#: 64-bit odd multipliers (splitmix64) used to mix hashes.
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_BLANKS = np.arange(256, dtype=np.uint8)
_BLANKS[9:14] = 32


def stored(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def carried(docs: DataFrame) -> Column:
    """All columns of a row as one, ``given``, so that no name clashes with an operator's own."""
    names = ["`" + name.replace("`", "``") + "`" for name in docs.columns]
    return F.struct(*map(F.col, names)).alias("given")


def restored(names: list[str], other: dict[str, Column] | None = None) -> list[Column]:
    """The columns of a ``carried`` row, some of them replaced or added."""
    other = other or {}
    return [other.get(n, F.col("given").getField(n)).alias(n) for n in names]


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def text_array(column: pa.Array) -> pa.LargeStringArray:
    """A text column as one array without nulls (null becomes empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def utf8_bytes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the offset at which each begins (one more than texts)."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_ascii(texts: pa.LargeStringArray) -> pa.LargeStringArray:
    """A-Z in lower case, everything else as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return _translated(texts, table)


def _translated(texts: pa.LargeStringArray, table: np.ndarray) -> pa.LargeStringArray:
    data, offsets = utf8_bytes(texts)
    return pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(table[data])
    )


def split_words(texts: pa.LargeStringArray) -> tuple[np.ndarray, pa.LargeStringArray]:
    """Words of each text: offsets into the words (one more than texts), and all the words."""
    parts = pc.split_pattern(_translated(texts, _BLANKS), " ")
    words, bounds = parts.values, parts.offsets.to_numpy()
    full = pc.greater(pc.binary_length(words), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return kept[bounds].astype(np.int64), words.filter(full)


def numbered(words: pa.LargeStringArray) -> tuple[np.ndarray, pa.LargeStringArray]:
    """A number for each word, equal for equal words, and the distinct words by number."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def listed(values: pa.Array) -> list:
    """Strings or bytes of an array without nulls; ``to_pylist`` would make a scalar of each first."""
    return values.to_numpy(zero_copy_only=False).tolist()


def word_hashes(words: pa.LargeStringArray) -> np.ndarray:
    """A 64-bit hash of each word."""
    values = words.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, values), np.uint64, len(values))


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit mix of unsigned 64-bit numbers (a bijection)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


def spans(lengths: np.ndarray) -> np.ndarray:
    """0, 1, 2, … within each run of the given lengths, runs one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
