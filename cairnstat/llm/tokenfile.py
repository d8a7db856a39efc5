"""Token files: each document's ids compressed by itself with one shared zstandard dictionary.

A token file is a Parquet folder. ``dictionary`` holds one row: id width, dictionary, its SHA-256. ``blocks`` holds runs of
documents in ascending key order: the dictionary's hash, the least and greatest key, the keys, an offset index of the frames, the token counts, the
first token's place within the file, and the frames end to end. A short document is read by its offsets alone, without
inflating its neighbours.

Documents are dealt to files by ranges of the key (bounds from quantiles of the key column alone), so texts never
move: what is shuffled are compressed frames. A file is written by one task in order, and a lost task is
repeated by Spark's commit protocol.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import codec
from .common import arrow_map, shared_dir, table, tokenizer_path
from .langid import draw_limit

#: The dictionary learns from about so many documents, and from the first bytes of each; the files hold all.
SAMPLE_DOCS = 2000
SAMPLE_BYTES = 16 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
BLOCK_BYTES = 1 << 20
#: Documents of a file at least; with more than FILES times that, files grow until they hold MOST_DOCS, and then their number does.
DOCS_PER_FILE = 2500
FILES = 4096
MOST_DOCS = 250_000
BLOCKS = "file int, block int, dict_sha256 string, least long, greatest long, doc_ids array<long>, offsets array<long>, n_tokens array<long>, first long, payload binary"


def serialize(ids: bytes, width: int, end: int | None) -> bytes:
    """Little-endian ids of ``width`` bytes, with the end id if any."""
    got = np.frombuffer(ids, "<u4")
    if end is not None:
        got = np.append(got, np.uint32(end))
    return got.astype(f"<u{width}").tobytes()


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """Dictionary of the samples; with too little to learn from, their bytes as they are."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


@dataclass
class TokenFiles:
    """Where token files are, and what is needed to read them."""

    path: str
    width: int
    dictionary: bytes

    @property
    def sha256(self) -> str:
        return hashlib.sha256(self.dictionary).hexdigest()

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> TokenFiles:
        row = spark.read.parquet(f"{path}/dictionary").first()
        found = cls(path, row["width"], bytes(row["dictionary"]))
        if found.sha256 != row["dict_sha256"]:
            raise ValueError("the dictionary's hash differs from the stored one")
        return found


def write(docs: DataFrame, tokenizer: str, path: str, *, end: int | None = 2, key: str = "doc_id", text: str = "text") -> TokenFiles:
    """Encode and store all rows of ``docs``. Null and empty texts have the end id only; equal keys lie side by side in order
    of their ids; a null key comes first. Further columns are left out."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    n = docs.count()
    drawn = docs.filter(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit("")), F.lit("dict")) <= draw_limit(SAMPLE_DOCS, n))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        width = 2 if len(own.bytes_of) <= 1 << 16 else 4
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([serialize(own.ids(t.as_py()), width, end)[:SAMPLE_BYTES] for t in batch[1]], pa.binary()), batch[0]], ["ids", "doc_id"])

    # SAMPLE_BYTES of about SAMPLE_DOCS documents, in an order of their own
    samples = [bytes(r[0]) for r in arrow_map(drawn, sample, "ids binary, doc_id long", keeps=tokenizer).orderBy("doc_id", "ids").select("ids").collect()]
    width = 2 if len(codec(tokenizer).bytes_of) <= 1 << 16 else 4
    files = TokenFiles(path, width, train(samples))
    n_files = max(1, -(-n // min(MOST_DOCS, max(DOCS_PER_FILE, n // FILES))))
    bounds = np.array(docs.approxQuantile("doc_id", [k / n_files for k in range(1, n_files)], 0.1 / n_files) if n_files > 1 else [], np.float64)
    shared, sha = spark.sparkContext.broadcast((files.dictionary, bounds)), files.sha256  # 64 KB, and a number for each file

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (raw, at) = codec(tokenizer), shared.value
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=True)
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                plain = [serialize(own.ids(t.as_py()), width, end) for t in part[1]]
                keys = part[0].fill_null(-(1 << 62)).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.searchsorted(at, keys.astype(np.float64), "right"), pa.int32()), part[0],
                    pa.array([len(x) // width for x in plain], pa.int64()), pa.array([zlib.crc32(x) for x in plain], pa.int64()),
                    pa.array([packer.compress(x) for x in plain], pa.binary())], ["file", "doc_id", "n", "tie", "frame"])

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = block = first = -1
        keys: list = []
        counts: list[int] = []
        frames: list[bytes] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, first
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in frames])]).tolist()
            row = {"file": at, "block": block, "dict_sha256": sha, "least": min((k for k in keys if k is not None), default=None), "greatest": max((k for k in keys if k is not None), default=None), "doc_ids": keys[:], "offsets": offsets, "n_tokens": counts[:], "first": first, "payload": b"".join(frames)}
            block, first = block + 1, first + sum(counts)
            for x in (keys, counts, frames):
                x.clear()
            return pa.RecordBatch.from_pylist([row], kind)

        kind = pa.schema([("file", pa.int32()), ("block", pa.int32()), ("dict_sha256", pa.string()), ("least", pa.int64()), ("greatest", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("first", pa.int64()), ("payload", pa.binary())])
        held = 0
        for batch in batches:
            for file, doc, n_, frame in zip(*(batch[i].to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if frames and (file != at or held >= BLOCK_BYTES):
                    yield flush()
                    held = 0
                if file != at:
                    at, block, first = file, 0, 0
                keys.append(doc)
                counts.append(n_)
                frames.append(frame)
                held += len(frame)
        if frames:
            yield flush()

    dealt = arrow_map(docs, encode, "file int, doc_id long, n long, tie long, frame binary", keeps=tokenizer).repartition(n_files, "file")
    arrow_map(dealt.sortWithinPartitions("file", "doc_id", "tie", "n"), lay, BLOCKS).write.parquet(f"{path}/blocks")
    spark.createDataFrame([(width, bytearray(files.dictionary), sha)], "width int, dictionary binary, dict_sha256 string").write.parquet(f"{path}/dictionary")
    return files


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document, from the files alone."""
    files = TokenFiles.open(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    totals = blocks.groupBy("file").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n"))
    ahead, starts = 0, []
    for file, n in sorted(map(tuple, totals.collect())):  # a row per file, each of MOST_DOCS documents or more once there are over FILES
        starts.append((file, ahead))
        ahead += n
    width, sha = files.width, files.sha256
    shared = spark.sparkContext.broadcast((files.dictionary, dict(starts)))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, before = shared.value
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_sha256"] != sha:
                    raise ValueError("a block was written with another dictionary")
                body, at, n, crc = memoryview(row["payload"]), row["offsets"], [], []
                for a, b in zip(at, at[1:], strict=False):  # one document's ids at a time, as small frames can hold many
                    ids = np.frombuffer(reader.decompress(body[a:b]), f"<u{width}")
                    n.append(len(ids))
                    crc.append(zlib.crc32(ids.astype("<u4")))
                if n != row["n_tokens"]:
                    raise ValueError("a frame holds another number of ids than the index says")
                start = before[row["file"]] + row["first"] + np.concatenate([[0], np.cumsum(n)[:-1]])
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return arrow_map(blocks.drop("least", "greatest"), unpack, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents of one key, inflating nothing else. The filter on a block's least and greatest key reaches the scan."""
    files = TokenFiles.open(spark, path)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(files.dictionary))
    hits = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").filter((F.col("least") <= doc_id) & (F.col("greatest") >= doc_id)).filter(F.array_contains("doc_ids", doc_id))
    frames = hits.select(F.explode(F.arrays_zip("doc_ids", F.slice("offsets", 1, F.size("doc_ids")).alias("a"), F.slice("offsets", 2, F.size("doc_ids")).alias("b"))).alias("x"), "payload").filter(F.col("x.doc_ids") == doc_id)
    cut = frames.select(F.expr("substring(payload, cast(x.a + 1 as int), cast(x.b - x.a as int))").alias("frame"))
    return [np.frombuffer(reader.decompress(bytes(r[0])), f"<u{files.width}").tolist() for r in cut.collect()]


def op5_tokens(spark, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), path, end=2)
    return read(spark, path)
