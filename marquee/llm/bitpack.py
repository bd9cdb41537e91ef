"""Token files: every id in the least number of bits that the vocabulary needs.

A file holds a run of documents in ascending order of their ids. Little-endian, in this order:

    8 bytes  TOKBITS1
    u32 bits of an id, u32 ids of a block, u64 documents, u64 ids
    i64 id of each document, u8 1 if that id is null, u64 ids of each document
    u64 byte offsets of the blocks, and of the end, counted from the first block
    blocks: ids from the lowest bit up; each block starts at a byte

Blocks can be read alone: `read_ids` seeks to those that hold a range and unpacks them as arrays.

Texts are range-partitioned by document id; each task encodes its range and writes files of about
`FILE_IDS` ids. A file is written under the name of the attempt and then renamed, so that a task
can be lost and repeated. Only the count of ids of each partition goes to the driver.

Cases: a null or empty text is a document of the end id alone. A null document id comes first, rows
with equal ids are ordered by a hash of the text. A document longer than a file gets one of its own.
An empty table gives no file and an empty result. Folders must be of a file system that pyarrow can
open on the executors. Columns of other names take no part.
"""

from __future__ import annotations

import sys
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F

from .codec import codec_of
from .common import small_batches, stored
from .words import release

MAGIC = b"TOKBITS1"
BLOCK = 4_096
FILE_IDS = 4_000_000
MANIFEST = "partition int, number int, path string, before long, n_docs long, n_ids long"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(each.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype("<u4")
    each = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=count * bits)
    return (each.reshape(count, bits).astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32).astype("<u4")


def to_file(docs: list[tuple[int | None, bytes]], bits: int, block: int = BLOCK) -> bytes:
    """The bytes of a file of documents (id, ids as little-endian unsigned 32-bit numbers)."""
    ids = np.frombuffer(b"".join(x for _, x in docs), "<u4")
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    blocks = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    return b"".join([
        MAGIC, np.array([bits, block], "<u4").tobytes(), np.array([len(docs), len(ids)], "<u8").tobytes(),
        np.array([d or 0 for d, _ in docs], "<i8").tobytes(), np.array([d is None for d, _ in docs], "u1").tobytes(),
        np.array([len(x) // 4 for _, x in docs], "<u8").tobytes(),
        np.cumsum([0, *map(len, blocks)]).astype("<u8").tobytes(), *blocks,
    ])


class TokenFile:
    """A file of documents that can be sought in."""

    def __init__(self, stream):
        self.stream = stream
        if stream.read(8) != MAGIC:
            raise ValueError("not a token file")
        self.bits, self.block = (int(x) for x in np.frombuffer(stream.read(8), "<u4"))
        n_docs, self.n_ids = (int(x) for x in np.frombuffer(stream.read(16), "<u8"))
        self.doc_ids = np.frombuffer(stream.read(8 * n_docs), "<i8")
        self.nulls = np.frombuffer(stream.read(n_docs), "u1").astype(bool)
        self.counts = np.frombuffer(stream.read(8 * n_docs), "<u8").astype(np.int64)
        n_blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(stream.read(8 * (n_blocks + 1)), "<u8").astype(np.int64)
        self.start = stream.tell()

    def read_ids(self, first: int, last: int) -> np.ndarray:
        """Ids `first` to `last` - 1 of the file; only their blocks are read."""
        first, last = max(first, 0), min(last, self.n_ids)
        if first >= last:
            return np.zeros(0, "<u4")
        a, b = first // self.block, -(-last // self.block)
        self.stream.seek(self.start + int(self.offsets[a]))
        data = self.stream.read(int(self.offsets[b] - self.offsets[a]))
        parts = []
        for i in range(a, b):
            at = int(self.offsets[i] - self.offsets[a])
            count = min(self.block, self.n_ids - i * self.block)
            parts.append(unpack(data[at : at + int(self.offsets[i + 1] - self.offsets[i])], count, self.bits))
        return np.concatenate(parts)[first - a * self.block : last - a * self.block]


def _file_system(folder: str):
    import pyarrow.fs

    short = folder.startswith("file:/") and not folder.startswith("file://")
    return pyarrow.fs.FileSystem.from_uri("file://" + folder[5:] if short else folder)


def write_tokens(
    docs: DataFrame, folder: str, spec: str, *, doc_id: str = "doc_id", text: str = "text",
    end_id: int = 2, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode and write all texts; the manifest, one row for each file, in MANIFEST's columns.
    `before` counts the ids of the files before it in its partition."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(spec)

    def write(batches):
        codec, partition = codec_of(sent.value), TaskContext.get().partitionId()
        bits, files = bits_for(codec.size), _file_system(folder)
        end = np.array([end_id], "<u4").tobytes()
        held, count, before, number = [], 0, 0, 0

        def flush():
            nonlocal held, count, before, number
            path = f"{files[1]}/tokens-{partition:06d}-{number:06d}.bits"
            attempt = f"{files[1]}/_{uuid.uuid4().hex}"
            files[0].create_dir(files[1], recursive=True)
            with files[0].open_output_stream(attempt) as out:
                out.write(to_file(held, bits))
            files[0].move(attempt, path)
            row = [partition, number, path.removeprefix(files[1] + "/"), before, len(held), count]
            held, count, before, number = [], 0, before + count, number + 1
            return pa.RecordBatch.from_pylist([dict(zip(names, row))], schema)

        names = [part.split()[0] for part in MANIFEST.split(", ")]
        schema = pa.schema([
            ("partition", pa.int32()), ("number", pa.int32()), ("path", pa.string()),
            ("before", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
        ])
        for batch in batches:
            encoded = codec.encode(batch.column("text"))
            for one, ids in zip(batch.column("id").to_pylist(), encoded):
                held.append((one, ids + end))
                count += len(ids) // 4 + 1
                if count >= file_ids:
                    yield flush()
        if held:
            yield flush()
        release()

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = (F.col("id"), F.xxhash64("text"))
    in_order = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(in_order.mapInArrow(write, MANIFEST), "token-files")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    spark = manifest.sparkSession
    totals = manifest.groupBy("partition").agg(F.sum("n_ids").alias("n")).orderBy("partition").collect()
    bases, so_far = {}, 0
    for row in totals:  # one for each task that wrote
        bases[row["partition"]] = so_far
        so_far += row["n"]

    def read(batches):
        files = _file_system(folder)
        for batch in batches:
            for partition, path, before in zip(*(batch.column(n).to_pylist() for n in ("partition", "path", "before"))):
                with files[0].open_input_file(f"{files[1]}/{path}") as stream:
                    file = TokenFile(stream)
                    ids = file.read_ids(0, file.n_ids)
                ends = np.cumsum(file.counts)
                sums = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends, file.counts)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(file.doc_ids, pa.int64(), mask=file.nulls),
                    pa.array(bases[partition] + before + ends - file.counts, pa.int64()),
                    pa.array(file.counts, pa.int64()), pa.array(sums, pa.int64()),
                ], names=["doc_id", "start", "n_tokens", "ids_crc32"])
        release()

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = manifest.select("partition", "path", "before").repartition(tasks, "path")
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def digest(docs: DataFrame, folder: str, spec: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files of all documents below `folder` and describe each document from them."""
    read = read_tokens(write_tokens(docs, folder, spec, doc_id=doc_id, text=text), folder)
    return read.withColumnRenamed("doc_id", doc_id)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
