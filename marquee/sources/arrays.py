"""JSON array files read in byte ranges.

Where a range begins, nobody knows whether the place is inside a string or how deep it is. So each
range first tells how many quotes it holds and by how much the depth changes, both ways: if it
begins outside a string and inside one. Sums over the ranges of a file before give the true state of
each. Then each range yields the elements that begin in it and reads on to the end of its last one.
Both passes run on arrays of bytes, a piece at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

RANGE_BYTES = 32 << 20
PIECE_BYTES = 1 << 20
#: A task takes several ranges beyond this.
MOST_TASKS = 100_000
#: A task takes ranges of about this many bytes of files in all.
TASK_BYTES = 64 << 20
#: Tasks of a listing job of many folders, for each core.
LISTING_TASKS_PER_CORE = 4
_QUOTE, _BACK, _COMMA, _OPEN, _CLOSE = (ord(c) for c in '"\\,[]')
_DEEPER = np.zeros(256, np.int64)
_DEEPER[[ord("["), ord("{")]] = 1
_DEEPER[[ord("]"), ord("}")]] = -1


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path as Spark names it, and the path there."""
    short = path.startswith("file:/") and not path.startswith("file://")
    return pyarrow.fs.FileSystem.from_uri("file://" + path[5:] if short else path)


def _quotes(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """Which bytes are quotes that no backslash escapes, and whether the next byte is escaped."""
    places = np.arange(len(data))
    other = np.maximum.accumulate(np.where(data != _BACK, places, -1))  # the last byte that is no backslash
    run = places - other  # backslashes up to here
    run[other < 0] += escaped
    before = np.concatenate(([int(escaped)], run[:-1]))
    return (data == _QUOTE) & (before % 2 == 0), bool(run[-1] % 2)


def _pieces(stream, start: int, end: int, first: int = PIECE_BYTES) -> Iterator[np.ndarray]:
    """Bytes from start to end: `first` bytes, then pieces twice as long each, up to PIECE_BYTES."""
    stream.seek(start)
    step = max(1, min(first, PIECE_BYTES))
    while start < end:
        data = stream.read(min(step, end - start))
        if not data:
            return
        start += len(data)
        step = min(2 * step, PIECE_BYTES)
        yield np.frombuffer(data, np.uint8)


def _escaped_at(stream, start: int) -> bool:
    """Whether an odd number of backslashes stands before a place."""
    count, step = 0, 64
    while start > count:
        first = max(0, start - count - step)
        stream.seek(first)
        data = stream.read(start - count - first)
        run = len(data) - len(data.rstrip(b"\\"))
        count += run
        if run < len(data):
            break
        step *= 2
    return count % 2 == 1


def summary(stream, start: int, end: int) -> tuple[int, int, int]:
    """Quotes modulo 2, and the change of depth if the range begins outside or inside a string."""
    odd, change, escaped = 0, [0, 0], _escaped_at(stream, start)
    for data in _pieces(stream, start, end):
        quotes, escaped = _quotes(data, escaped)
        inside = (np.cumsum(quotes) + odd) % 2 == 1
        deeper = _DEEPER[data]
        change[0] += int(deeper[~inside].sum())
        change[1] += int(deeper[inside].sum())
        odd = (odd + int(quotes.sum())) % 2
    return odd, change[0], change[1]


def elements(
    stream, start: int, end: int, size: int, in_string: bool, depth: int
) -> Iterator[tuple[int, bytes, bool]]:
    """(place, text, whole) of the elements that begin in the range. One that the array does not
    end, and what follows the array, is not whole."""
    place, escaped = start, _escaped_at(stream, start)
    held, begun, last = [], None, None  # parts of an element, where it begins, what stands before it
    # the range first; beyond it only the end of its last element is wanted
    for data in _pieces(stream, start, size, end - start):
        quotes, escaped = _quotes(data, escaped)
        inside = (np.cumsum(quotes) + in_string) % 2 == 1
        in_string = bool(inside[-1])
        deeper = np.where(inside, 0, _DEEPER[data])
        after = depth + np.cumsum(deeper)
        depth, before = int(after[-1]), after - deeper
        marks = ~inside & (((data == _COMMA) & (before == 1)) | ((data == _OPEN) & (before == 0)) | ((data == _CLOSE) & (before == 1)))
        so_far = 0
        for at in np.flatnonzero(marks):
            if begun is not None:
                text = b"".join(held) + data[so_far:at].tobytes()
                if text.strip() or last == _COMMA or (data[at] == _COMMA and last == _OPEN):
                    yield begun, text.strip(), last != _CLOSE
            held, so_far, begun, last = [], at + 1, None, data[at]
            if place + at >= end:
                return
            begun = place + int(at)
        if begun is not None:
            held.append(data[so_far:].tobytes())
        place += len(data)
        if begun is None and place >= end:
            return
    if begun is not None and (last != _CLOSE or b"".join(held).strip()):
        yield begun, b"".join(held).strip(), False


def first_byte(stream, size: int) -> int:
    """The first byte of a file that is no white space; 0 if there is none."""
    for data in _pieces(stream, 0, size):
        seen = data[~np.isin(data, np.frombuffer(b" \t\r\n", np.uint8))]
        if len(seen):
            return int(seen[0])
    return 0


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the matching files. Many folders are listed by a job of a few tasks for each
    core, not of a task for each folder; the setting of the session is restored."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)))
    try:
        return spark.read.format("binaryFile").load(path).select("path", "length")
    finally:
        spark.conf.set(name, before)


def array_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(source_file, place, record, whole) of each element of the arrays in all matching files:
    where it begins, its text, and whether the file has its end. A file that holds no array is one
    record. `path` must be of a file system that pyarrow can open on the executors."""
    found = _listed(spark, path).where("length > 0")
    ranges = found.select("path", "length", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    # tasks by the bytes of the files, as the few bytes of these rows would make all one task; a task
    # for each small range would spend more on starting than on reading
    counted_ranges, total = ranges.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    by_bytes = max(2 * spark.sparkContext.defaultParallelism, -(-int(total) // TASK_BYTES))
    tasks = min(max(counted_ranges, 1), by_bytes, MOST_TASKS)
    dealt = ranges.repartition(tasks, "path", "start")

    def count(batches):
        for batch in batches:
            rows = []
            for name, length, start in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "start"))):
                files, there = file_system(name)
                with files.open_input_file(there) as stream:
                    odd, outside, within = summary(stream, start, min(start + range_bytes, length))
                    rows.append((name, length, start, odd, outside, within, first_byte(stream, length) if start == 0 else None))
            yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in rows], counted)

    names = ["path", "length", "start", "odd", "outside", "within", "first"]
    counted = pa.schema([("path", pa.string()), *((n, pa.int64()) for n in names[1:])])
    sums = dealt.mapInArrow(count, "path string, " + ", ".join(f"{n} long" for n in names[1:]))
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    strings = sums.withColumns({
        "in_string": F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2,
        "first": F.first("first").over(Window.partitionBy("path").orderBy("start")),
    })
    change = F.when(F.col("in_string") == 1, F.col("within")).otherwise(F.col("outside"))
    states = strings.select(
        "path", "length", "start", "in_string", "first",
        F.coalesce(F.sum(change).over(earlier), F.lit(0)).alias("depth"),
    ).where((F.col("start") == 0) | (F.col("first") == _OPEN))

    def read(batches):
        for batch in batches:
            for name, length, start, in_string, first, depth in zip(*(
                batch.column(c).to_pylist() for c in ("path", "length", "start", "in_string", "first", "depth")
            )):
                files, there = file_system(name)
                with files.open_input_file(there) as stream:
                    if first == _OPEN:
                        end = min(start + range_bytes, length)
                        found = elements(stream, start, end, length, bool(in_string), depth)
                    else:
                        found = iter([(0, stream.read(), first == ord("{"))] if first else [])
                    held, size = [], 0
                    for place, text, whole in found:
                        held.append({"source_file": name, "place": place, "record": text.decode("utf-8", "replace"), "whole": whole})
                        size += len(text)
                        if size >= PIECE_BYTES:
                            yield pa.RecordBatch.from_pylist(held, records)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, records)

    records = pa.schema([("source_file", pa.string()), ("place", pa.int64()), ("record", pa.string()), ("whole", pa.bool_())])
    return states.repartition(tasks, "path", "start").mapInArrow(
        read, "source_file string, place long, record string, whole boolean")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
