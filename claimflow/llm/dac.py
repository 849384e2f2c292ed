"""Token ids as directly addressable codes (operator 8).

An id is cut into chunks of eight bits, the lowest first. Level 0 holds the
lowest chunk of every id; a bitmap beside it says which ids go on, and level 1
holds the next chunk of those only, with a bitmap of its own, and so on. A
rank directory over each bitmap, the number of ones before every 512 bits,
gives the place of an id's next chunk: any token is read from a handful of
places, without decoding what stands around it.

A segment's bytes (all numbers little-endian): ``DAC1``, 32 bits number of
ids, 32 bits number of levels; then per level 32 bits number of chunks, the
chunks, the bitmap (lowest bit first, filled up to whole bytes), and the
directory (32 bits each).

A data set of segments is a folder of Parquet files: rows (part, before,
doc_ids, lengths, n_tokens, codes), ``before`` being the ids of the part's
earlier segments. Parts follow each other in the order of document ids.

Null and empty
texts have the end id alone. A null document id comes first; rows that repeat
an id follow each other in the order of their texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vocab
from ..session import scratch_path

VOCABULARY = "byte_bpe_50k.json"
END = 0
#: Ids of a segment: closed when it has so many, so its last document may take it over.
SEGMENT = 1 << 20
SEGMENTS = "part int, before bigint, doc_ids array<bigint>, lengths array<bigint>, n_tokens bigint, codes binary"
_BLOCK = 512
_MAGIC = b"DAC1"


def encode(ids: np.ndarray) -> bytes:
    """The codes of ids below 2**32."""
    rest, levels = np.asarray(ids, np.uint32), []
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        counts = np.add.reduceat(more, np.arange(0, len(more), _BLOCK), dtype=np.uint32) if len(more) else []
        ranks = np.concatenate(([0], np.cumsum(counts)))[:max(1, len(counts))].astype("<u4")
        levels.append(np.uint32(len(rest)).tobytes() + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes()
                      + ranks.tobytes())
        rest = rest[more] >> np.uint32(8)
        if not len(rest):
            return _MAGIC + np.array([len(ids), len(levels)], "<u4").tobytes() + b"".join(levels)


class Codes:
    """Reads a segment: ``codes[i]`` any id, ``codes.all()`` all of them."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a DAC1 segment")
        self._n, n_levels = np.frombuffer(data, "<u4", 2, 4).tolist()
        at, self._levels = 12, []
        for _ in range(n_levels):
            n = int(np.frombuffer(data, "<u4", 1, at)[0])
            blocks = max(1, -(-n // _BLOCK))
            chunks = np.frombuffer(data, np.uint8, n, at + 4)
            bits = np.frombuffer(data, np.uint8, -(-n // 8), at + 4 + n)
            ranks = np.frombuffer(data, "<u4", blocks, at + 4 + n + len(bits))
            at += 4 + n + len(bits) + 4 * blocks
            self._levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return self._n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self._n:
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, ranks in self._levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            block = i // _BLOCK
            before = bits[block * _BLOCK // 8:(i >> 3) + 1].copy()
            before[-1] &= (1 << (i & 7)) - 1
            i = int(ranks[block]) + int(np.bitwise_count(before).sum(dtype=np.int64))
            shift += 8
        return value

    def all(self) -> np.ndarray:
        out = np.zeros(self._n, "<u4")
        at = None
        for level, (chunks, bits, _) in enumerate(self._levels):
            values = chunks.astype(np.uint32) << np.uint32(8 * level)
            if at is None:
                out |= values
                at = np.arange(self._n) if len(self._levels) > 1 else None
            else:
                out[at] |= values
            if level + 1 < len(self._levels):
                at = at[np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)]
        return out


# ---- tokens ----------------------------------------------------------------------------

def _segments(file: str, size: int):
    schema = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("lengths", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("codes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        encode_texts = vocab.byte_level(file)
        docs, parts, total = [], [], 0

        def segment():
            nonlocal docs, parts, total, before
            row = [[part], [before], [docs], [[len(p) for p in parts]], [total], [encode(np.concatenate(parts))]]
            before += total
            docs, parts, total = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for lo in range(0, len(batch), 128):
                ids, texts = (batch.column(n).slice(lo, 128).to_pylist() for n in ("doc_id", "text"))
                for doc, tokens in zip(ids, encode_texts([t or "" for t in texts], END)):
                    docs.append(doc)
                    parts.append(tokens)
                    total += len(tokens)
                    if total >= size:
                        yield segment()
        if docs:
            yield segment()
    return run


def write(docs: DataFrame, path: str, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text",
          segment: int = SEGMENT, order: str | None = None) -> None:
    """Encode the texts in the order of ids, or of the column ``order``, and write the segments to the folder ``path``."""
    file = vocabulary or vocab.path(VOCABULARY)
    columns = [F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")]
    if order is None:
        rows, by = docs.select(*columns), ["doc_id"]
    else:
        rows, by = docs.select(F.col(order).alias("order"), *columns), ["order", "doc_id"]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by, "text").select("doc_id", "text")
    ordered.mapInArrow(_segments(file, segment), SEGMENTS).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            ids = Codes(batch.column("codes")[i].as_py()).all()
            lengths = np.array(batch.column("lengths")[i].as_py(), np.int64)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            crc = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_ids")[i].values, pa.array(starts + batch.column("base")[i].as_py()),
                 pa.array(lengths), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a folder with ``base``, the number of ids before each."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    # one row for each part, so as many as the write had tasks
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    sums = np.concatenate(([0], np.cumsum([p.n for p in parts], dtype=np.int64))).tolist()
    base = spark.createDataFrame([(p.part, s) for p, s in zip(parts, sums)], "part int, part_base bigint")
    return segments.join(F.broadcast(base), "part").withColumn("base", F.col("part_base") + F.col("before"))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    return read(spark, path).mapInArrow(_documents, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id",
               text: str = "text", order: str | None = None) -> DataFrame:
    """Write the token files to the shared folder and list the documents in them."""
    path = scratch_path(docs.sparkSession, "tokens")
    write(docs, path, vocabulary, doc_id, text, order=order)
    return documents(docs.sparkSession, path)
