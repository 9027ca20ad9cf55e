"""Token-id files: concatenated ids with Elias-Fano document boundaries.

A token file is a folder of blocks in document order, one block a row of a Parquet file
(``part, seq, n_docs, n_ids, payload``): Spark's committer makes the write whole or absent on
any store, and each block is read alone. A payload is

    magic "EFTOK01\\0" | u32 id width | u32 0 | u64 null doc_ids | i64 smallest doc_id
    | boundaries | doc_ids | ids

``boundaries`` (the n_docs + 1 offsets) and ``doc_ids`` (sorted, nulls first, less the
smallest) are Elias-Fano lists: u64 n, u64 universe, u32 low bits, u32 words of high bits,
the packed low bits, the unary high bits and a select sample (the place of every 64th set
bit), each padded to 8 bytes. ``EliasFano.select(i)`` finds an offset from its sample in a
few words; there is no 64-bit offset table.

Defined cases: a null text is empty (its only id is the end id); null doc_ids come first;
repeated doc_ids and rows are kept, each a document of its own; an empty table writes an
empty file; extra columns are ignored; a document is never divided between blocks.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventweave.llm.frames import need
from eventweave.llm.textops import blocks
from eventweave.llm.tokens import encoder
from eventweave.session import work_dir

MAGIC = b"EFTOK01\0"
BLOCK_SCHEMA = "part int, seq long, n_docs long, n_ids long, payload binary"
SAMPLE = 64


def _pad(b: bytes) -> bytes:
    return b + b"\0" * (-len(b) % 8)


class EliasFano:
    """A non-decreasing list of integers below a bound in about 2 + log2(bound / n) bits each."""

    def __init__(self, n: int, universe: int, low_bits: int, low: bytes, high: np.ndarray, sample: np.ndarray):
        self.n, self.universe, self.low_bits, self.low, self.high, self.sample = n, universe, low_bits, low, high, sample

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n, universe = len(v), int(v[-1]) + 1 if len(v) else 1
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        width = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> width) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) + 1 if n else 0) + 63 & ~63, dtype=np.uint8)
        bits[ones] = 1
        return cls(n, universe, low_bits, low, np.packbits(bits, bitorder="little").view(np.uint64), ones[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        return (struct.pack("<QQII", self.n, self.universe, self.low_bits, len(self.high)) + _pad(self.low)
                + self.high.tobytes() + _pad(self.sample.tobytes()))

    @classmethod
    def read(cls, raw: memoryview, at: int) -> tuple[EliasFano, int]:
        n, universe, low_bits, words = struct.unpack_from("<QQII", raw, at)
        at += 24
        size = -(-n * low_bits // 8)
        low = bytes(raw[at:at + size])
        at += size + -size % 8
        high = np.frombuffer(raw, np.uint64, words, at)
        at += 8 * words
        samples = -(-n // SAMPLE)
        sample = np.frombuffer(raw, np.uint32, samples, at)
        at += 4 * samples + -4 * samples % 8
        return cls(n, universe, low_bits, low, high, sample), at

    def select(self, i: int) -> int:
        """Value i: the place of the i-th set bit, from its sample on, and the low bits."""
        place = int(self.sample[i // SAMPLE])
        rest = i % SAMPLE
        word = place >> 6
        bits = int(self.high[word]) >> (place & 63) << (place & 63)
        while (ones := bits.bit_count()) <= rest:
            rest -= ones
            word += 1
            bits = int(self.high[word])
        for _ in range(rest):
            bits &= bits - 1
        place = (word << 6) + (bits & -bits).bit_length() - 1
        first = i * self.low_bits
        low = int.from_bytes(self.low[first >> 3:(first + self.low_bits + 7) >> 3], "little") >> (first & 7)
        return (place - i) << self.low_bits | low & (1 << self.low_bits) - 1

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little", count=self.n * self.low_bits)
            out |= (bits.reshape(self.n, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out


def encode_block(doc_ids: list[int | None], ids: np.ndarray, counts: np.ndarray) -> bytes:
    known = [d for d in doc_ids if d is not None]
    least = known[0] if known else 0
    head = MAGIC + struct.pack("<IIQq", ids.dtype.itemsize, 0, len(doc_ids) - len(known), least)
    ends = np.concatenate([[0], np.cumsum(counts)])
    near = np.array([d - least for d in known], dtype=np.uint64)
    return head + EliasFano.of(ends).to_bytes() + EliasFano.of(near).to_bytes() + ids.tobytes()


class TokenBlock:
    """One block read back; ``document(i)`` uses select on the boundaries alone."""

    def __init__(self, payload: bytes):
        raw = memoryview(payload)
        if bytes(raw[:8]) != MAGIC:
            raise ValueError("not a token block")
        width, _, self.nulls, self.least = struct.unpack_from("<IIQq", raw, 8)
        self.bounds, at = EliasFano.read(raw, 32)
        self.near, at = EliasFano.read(raw, at)
        self.ids = np.frombuffer(raw, np.dtype(f"<u{width}"), offset=at)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [int(x) + self.least for x in self.near.values().tolist()]

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i):self.bounds.select(i + 1)]


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str, end_id: int,
                 block_ids: int = 1 << 19, block_docs: int = 1 << 14) -> None:
    """Encode every document, append ``end_id`` and write blocks in ascending doc_id order."""
    need(docs, "doc_id", "text")

    def run(batches):
        enc, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        names: list = []
        ids, counts, held = [], [], 0

        def block():
            all_ids, n = np.concatenate(ids), np.concatenate(counts)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int64()), "n_docs": pa.array([len(n)], pa.int64()),
                "n_ids": pa.array([len(all_ids)], pa.int64()), "payload": pa.array([encode_block(names, all_ids, n)], pa.binary())})

        for batch in batches:
            for rows in blocks(batch, "text", 1 << 18):
                got, n = enc.encode(rows.column("text"))
                ids.append(np.insert(got, np.cumsum(n), np.array(end_id, got.dtype)))
                counts.append(n + 1)
                names += rows.column("doc_id").to_pylist()
                held += len(ids[-1])
                if held >= block_ids or len(names) >= block_docs:
                    yield block()
                    names, ids, counts, held, seq = [], [], [], 0, seq + 1
        if names:
            yield block()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(run, BLOCK_SCHEMA).write.parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a token file: ``doc_id, start, n_tokens, ids_crc32, ids`` (ids as bytes
    of little-endian unsigned 32-bit integers), read from the blocks alone."""
    files = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.select("part", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("part_start"))  # one row a partition
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = (files.select("part", "seq", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("seq_start"))
              .join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("block_start")))

    def run(batches):
        for batch in batches:
            for part, seq, payload in zip(*(batch.column(c) for c in ("part", "seq", "payload"))):
                b = TokenBlock(payload.as_py())
                n, names = b.bounds.n - 1, b.doc_ids()
                for lo in range(0, n, 1024):
                    at = [b.bounds.select(i) for i in range(lo, min(lo + 1024, n) + 1)]
                    wide = b.ids[at[0]:at[-1]].astype("<u4").tobytes()     # bytes: pyarrow keeps memoryviews alive
                    docs = [wide[4 * (a - at[0]):4 * (z - at[0])] for a, z in zip(at, at[1:])]
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([part.as_py()] * len(docs), pa.int32()), "seq": pa.array([seq.as_py()] * len(docs), pa.int64()),
                        "doc_id": pa.array(names[lo:lo + len(docs)], pa.int64()), "at": pa.array(at[:-1], pa.int64()),
                        "n_tokens": pa.array([z - a for a, z in zip(at, at[1:])], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(d) for d in docs], pa.int64()), "ids": pa.array(docs, pa.binary())})

    docs = files.select("part", "seq", "payload").mapInArrow(
        run, "part int, seq long, doc_id long, at long, n_tokens long, ids_crc32 long, ids binary")
    return (docs.join(starts, ["part", "seq"])
            .select("doc_id", (F.col("block_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "ids"))


def token_file(docs: DataFrame, *, tokenizer: str, end_id: int) -> DataFrame:
    """Write ``docs`` to a new token file in the shared work folder and read it back."""
    path = work_dir(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer=tokenizer, end_id=end_id)
    return read_tokens(docs.sparkSession, path)
