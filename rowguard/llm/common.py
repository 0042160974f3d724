"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowguard.session import ensure_checkpoint_dir

#: bytes of text that one step of a Python worker handles at a time
STEP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    It cuts lineage the way ``checkpoint()`` does, but as compressed, columnar
    files: a lost executor costs a re-read, not a recomputation, and readers
    fetch only the columns that they need. The folder is new for each call.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rowguard-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id bigint, text string): other columns never reach an operator."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def crc_mod(doc_id, mod: int):
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def crc_mod_py(doc_id: int | None, mod: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


def hash_bound(share: float) -> int:
    """The value up to which about ``share`` of all signed 64-bit hashes lie."""
    return min(int(min(1.0, share) * 2**64) - 2**63, 2**63 - 1)


def ceil_div(a: int, b: int) -> int:
    return -(-a // b)


def release() -> None:
    """Give a worker's free memory back: workers are kept for later tasks, of other operators too."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


# ------------------------------------------------------------ Arrow batches

def steps(batches: Iterator[pa.RecordBatch], text: str = "text",
          step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``step_bytes`` of text (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // step_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


#: byte maps for word splitting: A-Z lower-cased; white space is what Arrow splits at
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: the same, and every ASCII byte that is no letter or digit becomes a space
ALNUM = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in LOWER)


def words(texts: pa.Array, table: bytes = LOWER) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words of texts, split at ASCII white space after mapping bytes by ``table``.

    Returns offsets (n + 1) into the codes, the codes of all words in order, and
    the distinct words that codes stand for. A null text has no words. Only ASCII
    bytes are mapped, so UTF-8 stays valid and offsets stay right.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = data.slice(at[0], at[-1] - at[0]).to_pybytes().translate(table) if data is not None else b""
    mapped = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer((at - at[0]).tobytes()), pa.py_buffer(data)])
    split = pc.ascii_split_whitespace(mapped)
    offsets = split.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    coded = pc.dictionary_encode(split.flatten())
    codes = coded.indices.to_numpy().astype(np.int64)
    known = coded.dictionary.to_pylist()
    if "" in known:  # what stands before the first or after the last separator
        empty = codes == known.index("")
        kept = np.concatenate([[0], np.cumsum(~empty)])
        offsets, codes = kept[offsets], codes[~empty]
    return offsets, codes, known


def hashes(known: list[str]) -> np.ndarray:
    """64-bit hashes of distinct words, the same on every machine."""
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in known), np.uint64, len(known))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: spreads all bits of ``h``."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pack(values: np.ndarray, delta: bool = False) -> bytes:
    """Unsigned integers as byte planes (high bytes together, so that they compress)."""
    if delta and len(values):
        values = np.diff(values, prepend=values.dtype.type(0))
    return values.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def unpack(blob: bytes, dtype, delta: bool = False) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(blob, np.uint8).reshape(size, -1)
    values = np.ascontiguousarray(planes.T).reshape(-1).view(dtype)
    return np.cumsum(values, dtype=dtype) if delta else values


def run_lengths(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array, and where each begins."""
    if not len(sorted_values):
        return sorted_values, np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return sorted_values[starts], starts
