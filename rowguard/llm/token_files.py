"""Operator 11: token ids as binary files, one zstandard frame a document, one shared dictionary.

Writing: documents are dealt to ranges of ascending id (equal ids by text, equal
rows by their place in the input, so a hot id is split), sorted there and encoded.
A bounded sample of serialised id arrays trains one zstandard dictionary. Every
document is compressed alone with it, so a short document is as cheap to fetch
as its own frame; blocks of documents carry the dictionary's hash and the index
of their frames. A range is one file; Spark's text writer writes the blocks as
they are, so commits and retries are Spark's, in any store that Spark reaches.

File: blocks, each followed by a line end. Block, little endian:

    4 bytes   magic "IDZ1"
    uint32    bytes of an id (2 or 4), fixed by the size of the vocabulary
    uint64    bytes of the block
    uint64    number of the file
    uint64    number of the block in its file
    uint64    documents n
    32 bytes  sha256 of the dictionary (of nothing, if there is none)
    int64[n]  document ids
    uint8[n]  1 where the document id is null
    uint64[n] ids of each document
    uint64[n] where each frame ends, from the end of this index
    frames    zstandard, each the ids of one document

The dictionary lies in the folder ``dictionary``, the files in ``shards``, one
row a block in the Parquet table ``blocks`` (file, number, first and last id,
documents, ids). ``read`` gives all documents back, ``fetch`` the ones with
stated ids: it opens only files whose range holds one and decompresses only
their frames.

Defined results: a null or empty text is the end id alone; null ids come first
in the order; rows that share an id are ordered by the hash of their text, equal
rows are interchangeable; an empty table has no blocks; other columns are
ignored. Equal rows are dealt by their place in the input, so an input whose
partitions change when they are computed again should be a written table.
A wrong magic, length or dictionary raises an error: such files are damaged.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowguard.llm.common import ceil_div, documents, steps
from rowguard.llm.spans import ByteLevel, byte_level_tokenizer, gather, split, sums
from rowguard.session import ensure_checkpoint_dir

#: public tokenizer file; a parameter, never copied
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
#: bytes of text that one file aims at
FILE_BYTES = 64 << 20
#: bytes of text that one block is made from (one document at least)
BLOCK_BYTES = 16 << 20
LEVEL = 3
#: the dictionary's bytes, and its bounded sample: so many documents, so many code points of each
DICTIONARY_BYTES = 65_536
SAMPLE_DOCS = 2048
SAMPLE_CHARS = 2048
#: blocks up to which their starts (24 bytes each) are broadcast
BROADCAST_BLOCKS = 50_000

MAGIC = b"IDZ1"
HEAD = struct.Struct("<4sIQQQQ32s")
READ = "doc_id long, file long, block long, slot long, n_tokens long, before long, ids binary"


def _ids(tokenizer: ByteLevel, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(where each text's ids end, all ids), the end id after each text."""
    offsets, codes, spans = split(texts, whole=not tokenizer.by_span, fine=tokenizer.fine(texts))
    ends, ids = tokenizer.encode(spans)
    size = sums(np.diff(np.concatenate([[0], ends]))[codes], offsets) + 1
    upto = np.cumsum(size)
    out = np.full(int(upto[-1]) if len(upto) else 0, end_id, np.int64)
    own = np.ones(len(out), bool)
    own[upto - 1] = False
    out[own] = ids[gather(codes, ends)]
    return upto, out


def _text_of(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def train_dictionary(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, size: int = DICTIONARY_BYTES,
                     sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS, n_docs: int | None = None) -> bytes:
    """A dictionary from serialised id arrays of at most ``sample_docs`` documents, chosen by hash.

    A document is in the sample if its hash falls into that share of all rows;
    equal rows, which share a hash, are one. A long document gives
    ``sample_chars`` code points from a place chosen by hash. Empty bytes if the
    sample is too small for a dictionary.
    """
    data, rows = _text_of(tokenizer), documents(docs).filter("text <> ''")
    h = F.xxhash64("doc_id", "text")
    share = min(1.0, sample_docs / max(rows.count() if n_docs is None else n_docs, 1))
    long = F.greatest(F.length("text") - sample_chars, F.lit(0))
    piece = F.substring("text", (F.pmod(h, long + 1) + 1).cast("int"), F.lit(sample_chars))
    # hashes are even over 64 bits: the rows expected below the bound are the sample's size
    rows = (rows.withColumn("h", h).filter(F.col("h") <= int(share * 2**64) - 2**63 - 1).groupBy("h").agg(F.min(piece).alias("text"))
            .orderBy("h").collect())
    if not rows:
        return b""
    model = byte_level_tokenizer(data)
    ends, ids = _ids(model, pa.array([r.text for r in rows], pa.large_string()), end_id)
    samples = [a.tobytes() for a in np.split(ids.astype(_dtype(model, end_id)), ends[:-1])]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # fewer samples than its trainer asks for
        return b""


def _dtype(tokenizer: ByteLevel, end_id: int):
    return np.dtype("<u2" if max(len(tokenizer.surface) - 1, end_id) < 1 << 16 else "<u4")


def _zdict(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def pack_block(file: int, number: int, doc_ids: list, ends: np.ndarray, ids: np.ndarray, dictionary: bytes,
               compressor: zstandard.ZstdCompressor) -> bytes:
    begins = np.concatenate([[0], ends[:-1]])
    raw = memoryview(ids).cast("B")
    width = ids.dtype.itemsize
    frames = [compressor.compress(raw[a * width:b * width]) for a, b in zip(begins.tolist(), ends.tolist())]
    n = len(doc_ids)
    index = b"".join([
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is None for d in doc_ids),
        (ends - begins).astype("<u8").tobytes(), np.cumsum([len(f) for f in frames]).astype("<u8").tobytes()])
    size = HEAD.size + len(index) + sum(map(len, frames))
    return b"".join([HEAD.pack(MAGIC, width, size, file, number, n, hashlib.sha256(dictionary).digest()), index, *frames])


class Block:
    """A block of a file's bytes: its index, and its documents' ids on demand."""

    def __init__(self, data: memoryview, at: int, dictionary_sha: bytes):
        magic, self.width, self.size, self.file, self.number, self.n, sha = HEAD.unpack_from(data, at)
        if magic != MAGIC or at + self.size > len(data):
            raise ValueError("no whole block of token ids at this place")
        if sha != dictionary_sha:
            raise ValueError("the block was written with another dictionary")
        n, here = self.n, at + HEAD.size
        self.doc_ids = np.frombuffer(data, "<i8", n, here)
        self.null = np.frombuffer(data, np.uint8, n, here + 8 * n).astype(bool)
        self.n_ids = np.frombuffer(data, "<u8", n, here + 9 * n).astype(np.int64)
        ends = np.frombuffer(data, "<u8", n, here + 17 * n).astype(np.int64)
        self.frames = here + 25 * n + np.concatenate([[0], ends])
        self.data = data

    def ids(self, k: int, decompressor: zstandard.ZstdDecompressor) -> np.ndarray:
        raw = decompressor.decompress(self.data[self.frames[k]:self.frames[k + 1]])
        ids = np.frombuffer(raw, f"<u{self.width}")
        if len(ids) != self.n_ids[k]:
            raise ValueError("a frame does not hold the ids that its index states")
        return ids

    @staticmethod
    def walk(content: bytes, dictionary: bytes) -> Iterator[Block]:
        data, at, sha = memoryview(content), 0, hashlib.sha256(dictionary).digest()
        while at < len(data):
            block = Block(data, at, sha)
            yield block
            at += block.size + 1  # the line end


def write(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, file_bytes: int = FILE_BYTES,
          block_bytes: int = BLOCK_BYTES, dictionary: bytes | None = None) -> str:
    """Write the ids of every document under ``path`` (a new folder); returns ``path``."""
    spark, rows, data = docs.sparkSession, documents(docs), _text_of(tokenizer)
    total, n_docs = (x or 0 for x in rows.agg(F.sum(F.octet_length("text")), F.count_if(F.col("text") != "")).first())
    if dictionary is None:
        dictionary = train_dictionary(docs, tokenizer, end_id, n_docs=n_docs)
    files = max(ceil_div(total, file_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.asc_nulls_first("doc_id"), F.asc("h"), F.asc("place")]
    dealt = (rows.withColumn("h", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
             .repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, file = byte_level_tokenizer(data), TaskContext.get().partitionId()
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zdict(dictionary), write_checksum=True)
        for number, batch in enumerate(steps(batches, step_bytes=block_bytes)):
            ends, ids = _ids(model, batch.column("text"), end_id)
            ids = ids.astype(_dtype(model, end_id))
            blob = pack_block(file, number, batch.column("doc_id").to_pylist(), ends, ids, dictionary, compressor)
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["block"])

    _raw(spark.createDataFrame([(bytearray(dictionary),)], "block binary").coalesce(1), f"{path}/dictionary")
    _raw(dealt.mapInArrow(run, "block binary"), f"{path}/shards")
    _index(spark, path, dictionary).write.parquet(f"{path}/blocks")
    return path


def _raw(blocks: DataFrame, path: str) -> None:
    """Bytes as they are, a line end after each row."""
    blocks.select(F.col("block").cast("string").alias("value")).write.text(path, lineSep="\n")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(_files(spark, f"{path}/dictionary").select("content").first()[0])[:-1]


def _index(spark: SparkSession, path: str, dictionary: bytes) -> DataFrame:
    """One row a block, from the blocks' heads and indexes alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows = []
                for b in Block.walk(content.as_buffer(), dictionary):
                    named = b.doc_ids[~b.null]
                    rows.append({"path": name, "file": b.file, "block": b.number, "n_docs": b.n, "n_null": int(b.null.sum()),
                                 "first_id": int(named.min()) if len(named) else None, "last_id": int(named.max()) if len(named) else None,
                                 "n_tokens": int(b.n_ids.sum())})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=BLOCKS)

    return _files(spark, f"{path}/shards").select("path", "content").mapInArrow(
        run, "path string, file long, block long, n_docs long, n_null long, first_id long, last_id long, n_tokens long")


BLOCKS = pa.schema([("path", pa.string()), ("file", pa.int64()), ("block", pa.int64()), ("n_docs", pa.int64()), ("n_null", pa.int64()),
                    ("first_id", pa.int64()), ("last_id", pa.int64()), ("n_tokens", pa.int64())])
RAW = pa.schema([("doc_id", pa.int64()), ("file", pa.int64()), ("block", pa.int64()), ("slot", pa.int64()), ("n_tokens", pa.int64()),
                 ("before", pa.int64()), ("ids", pa.binary())])


def _documents(files: DataFrame, dictionary: bytes, wanted: np.ndarray | None = None) -> DataFrame:
    """Documents of files: all, or those whose ids are in the sorted array ``wanted``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor(dict_data=_zdict(dictionary))
        for batch in batches:
            for content in batch.column("content"):
                for b in Block.walk(content.as_buffer(), dictionary):
                    keep = np.arange(b.n) if wanted is None else np.flatnonzero(np.isin(b.doc_ids, wanted) & ~b.null)
                    if not len(keep):
                        continue
                    before = np.cumsum(b.n_ids) - b.n_ids
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(b.doc_ids[keep], mask=b.null[keep]), pa.array(np.full(len(keep), b.file)), pa.array(np.full(len(keep), b.number)),
                         pa.array(keep), pa.array(b.n_ids[keep]), pa.array(before[keep]),
                         pa.array([b.ids(k, decompressor).astype("<u4").tobytes() for k in keep], pa.binary())], schema=RAW)

    return files.select("content").mapInArrow(run, READ)


def running_sum(df: DataFrame, key: str, value: str, name: str, group: int = 1024) -> DataFrame:
    """Sum of ``value`` over all smaller ``key`` (distinct, from 0 on), in two levels.

    Groups of neighbouring keys are summed first, so no task sees all rows: one
    holds a row a group, the others a group each.
    """
    of = F.floor(F.col(key) / group)
    rows = df.withColumn("_group", of)
    groups = rows.groupBy("_group").agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("_group", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_group").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(groups, "_group").withColumn(name, F.col(name) + F.col("_before")).drop("_group", "_before")


def _starts(spark: SparkSession, path: str) -> DataFrame:
    """First id's number of every block: files in order, blocks in order."""
    blocks = spark.read.parquet(f"{path}/blocks").select("file", "block", "n_tokens")
    files = running_sum(blocks.groupBy("file").agg(F.sum("n_tokens").alias("of_file")), "file", "of_file", "base").drop("of_file")
    inside = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = blocks.withColumn("own", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    starts = own.join(files, "file").select("file", "block", (F.col("base") + F.col("own")).alias("base"))
    # a few numbers a block: small files' worth go to every task, more are joined by Spark's own choice
    return F.broadcast(starts) if blocks.count() <= BROADCAST_BLOCKS else starts


def _placed(found: DataFrame, starts: DataFrame) -> DataFrame:
    start: Column = F.col("base") + F.col("before")
    return found.join(starts, ["file", "block"]).select("doc_id", start.alias("start"), "n_tokens", "ids")


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) of every document, from the files."""
    return _placed(_documents(_files(spark, f"{path}/shards"), read_dictionary(spark, path)), _starts(spark, path))


def fetch(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The same for documents with the stated ids alone."""
    wanted = np.unique(np.array(doc_ids, np.int64))
    blocks = spark.read.parquet(f"{path}/blocks")
    asked = F.lit(wanted.tolist()).cast("array<long>")
    held = blocks.filter(F.exists(asked, lambda i: i.between(F.col("first_id"), F.col("last_id"))))
    paths = [r.path for r in held.select("path").distinct().collect()]
    files = (spark.read.format("binaryFile").load(paths) if paths else _files(spark, f"{path}/shards").limit(0))
    return _placed(_documents(files, read_dictionary(spark, path), wanted), _starts(spark, path))


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write into a new folder of the shared checkpoint folder and read the files back."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rowguard-token-files-{uuid.uuid4().hex}"
    return read(spark, write(docs, path, **options))


def unpack(ids: bytes) -> list[int]:
    """The ids of one document as integers."""
    return np.frombuffer(ids, "<u4").tolist()
