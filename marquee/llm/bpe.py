"""BPE encoding and decoding; long texts are encoded in parts and joined as a tree.

A long text is cut into leaves that are dealt out over the cluster and encoded there. Halves are
then joined: the ids around a join are turned back into text, a window of it is encoded anew, and
the window grows until its first ids are those of the left half and its last ids those of the right
half. Why that is exact: pieces of the pattern depend only on what follows them, so that a shared
boundary of pieces carries everything after it over; and inside one piece a list of tokens is the
encoding if each two neighbours are, which the shared tokens pass on to both sides.

Cases: a null or empty text has no ids. Equal long texts are encoded once. Rows with equal ids
give a row each. An empty table gives an empty result. Columns of other names take no part.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, functions as F

from .codec import Codec, codec_of
from .common import small_batches, text_key
from .words import release

#: Code points of a leaf; longer texts are cut.
LEAF = 16_384
#: Bytes on each side of a join that are encoded anew at first, and that must agree.
WINDOW, AGREE = 128, 32


def _clean(table: list[bytes], ids: np.ndarray, at: int) -> bool:
    """Whether a token boundary is also one of characters."""
    return at >= len(ids) or table[ids[at]][0] & 0xC0 != 0x80


def join(left: np.ndarray, right: np.ndarray, codec: Codec) -> np.ndarray:
    """The ids of two adjacent texts put together, from the ids of each."""
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    tail = np.cumsum(codec.lengths[left[::-1]])
    head = np.cumsum(codec.lengths[right])
    window = WINDOW
    while True:
        a = len(left) - min(int(np.searchsorted(tail, window)) + 1, len(left))
        b = min(int(np.searchsorted(head, window)) + 1, len(right))
        while a > 0 and not _clean(codec.table, left, a):
            a -= 1
        while b < len(right) and not _clean(codec.table, right, b):
            b += 1
        text = codec.decode(left[a:]) + codec.decode(right[:b])
        middle = codec.plain(text.decode("utf-8"))
        n = min(len(middle), len(left) - a)
        differ = np.flatnonzero(middle[:n] != left[a : a + n])
        same_left = middle[: differ[0] if len(differ) else n]
        n = min(len(middle), b)
        differ = np.flatnonzero(middle[len(middle) - n :][::-1] != right[b - n : b][::-1])
        same_right = middle[len(middle) - (differ[0] if len(differ) else n) :]
        if (a == 0 or codec.lengths[same_left].sum() >= AGREE) and (
            b == len(right) or codec.lengths[same_right].sum() >= AGREE
        ):
            return np.concatenate([left[:a], middle, right[b:]])
        window *= 4


def join_all(parts: list[np.ndarray], codec: Codec) -> np.ndarray:
    """Neighbours are joined, level by level."""
    while len(parts) > 1:
        pairs = [join(x, y, codec) for x, y in zip(parts[::2], parts[1::2])]
        parts = pairs + parts[len(pairs) * 2 :]
    return parts[0] if parts else np.zeros(0, "<u4")


def _narrow(codec: Codec):
    return np.dtype("<u2" if len(codec.table) <= 1 << 16 else "<u4")


CODED = "struct<ids: binary, decoded: string>"


def _coded(ids: list[bytes], codec: Codec) -> pa.StructArray:
    """The ids, and the texts decoded from them; broken UTF-8 becomes replacement characters."""
    texts = [codec.decode(np.frombuffer(x, "<u4")).decode("utf-8", "replace") for x in ids]
    return pa.StructArray.from_arrays(
        [pa.array(ids, pa.binary()), pa.array(texts, pa.string())], names=["ids", "decoded"])


def encode_short(docs: DataFrame, spec: Broadcast, *, text: str, into: str = "coded") -> DataFrame:
    """`docs` with a struct of the ids of each text, little-endian unsigned 32-bit numbers in a
    binary field, and of the text decoded from them."""
    @F.arrow_udf(CODED)
    def coded(texts: pa.Array) -> pa.Array:
        codec = codec_of(spec.value)
        out = _coded(codec.encode(texts), codec)
        release()
        return out

    return docs.withColumn(into, coded(F.col(text)))


def encode_long(texts: DataFrame, spec: Broadcast, *, text: str = "text") -> DataFrame:
    """(k1, k2, coded): the ids of each different text, and the text decoded from them, as from
    `encode_short`; k1 and k2 are the hashes of the text from `text_key`."""
    k1, k2 = text_key(F.col(text))

    def cut(batches):
        for batch in batches:
            for a, b, whole in zip(*(batch.column(i).to_pylist() for i in range(3))):
                leaves = [whole[i : i + LEAF] for i in range(0, len(whole), LEAF)] or [""]
                for first in range(0, len(leaves), 64):
                    some = leaves[first : first + 64]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([a] * len(some), pa.int64()), pa.array([b] * len(some), pa.int64()),
                        pa.array(range(first, first + len(some)), pa.int32()), pa.array(some, pa.string()),
                    ], names=["k1", "k2", "leaf", "piece"])

    def encode(batches):
        codec = codec_of(spec.value)
        for batch in batches:
            ids = [
                np.frombuffer(x, "<u4").astype(_narrow(codec)).tobytes()
                for x in codec.encode(batch.column("piece"))
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("k1", "k2", "leaf")), pa.array(ids, pa.binary())],
                names=["k1", "k2", "leaf", "ids"],
            )
        release()

    def joined(key, table):
        codec = codec_of(spec.value)
        table = table.sort_by("leaf")
        parts = [np.frombuffer(x, _narrow(codec)).astype("<u4") for x in table["ids"].to_pylist()]
        out = pa.table({
            "k1": pa.array([key[0].as_py()], pa.int64()), "k2": pa.array([key[1].as_py()], pa.int64()),
            "coded": _coded([join_all(parts, codec).tobytes()], codec),
        })
        release()
        return out

    leaves = texts.select(k1.alias("k1"), k2.alias("k2"), F.col(text).alias("text")).mapInArrow(
        cut, "k1 long, k2 long, leaf int, piece string")
    once = leaves.dropDuplicates(["k1", "k2", "leaf"])
    encoded = once.mapInArrow(encode, "k1 long, k2 long, leaf int, ids binary")
    return encoded.groupBy("k1", "k2").applyInArrow(joined, f"k1 long, k2 long, coded {CODED}")


def decode(rows: DataFrame, spec: Broadcast, *, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`rows` with the text of their ids; broken UTF-8 becomes replacement characters."""
    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        return _coded(column.fill_null(b"").to_pylist(), codec_of(spec.value)).field("decoded")

    return rows.withColumn(into, text(F.col(ids)))


def digest(docs: DataFrame, spec: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for each row, all from the ids."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(spec)
    rows = docs.select(F.col(doc_id), F.coalesce(F.col(text), F.lit("")).alias("text"))
    is_long = F.length("text") > LEAF
    numbers = (
        (F.octet_length("coded.ids") / 4).cast("long").alias("n_tokens"), F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )
    short = encode_short(rows.where(~is_long), sent, text="text").select(doc_id, *numbers)
    k1, k2 = text_key(F.col("text"))
    by_text = encode_long(rows.where(is_long), sent).select("k1", "k2", *numbers)
    long = rows.where(is_long).select(doc_id, k1.alias("k1"), k2.alias("k2")).join(by_text, ["k1", "k2"])
    return short.unionByName(long.drop("k1", "k2"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
