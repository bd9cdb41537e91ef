import io
import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException

from marquee.sources import arrays, files

FIELDS = (("id", "int"), ("title", "string"))


def by_ranges(data, step):
    """All elements, range by range, as the two passes read them."""
    stream, found = io.BytesIO(data), []
    odd = depth = 0
    for start in range(0, len(data), step):
        end = min(start + step, len(data))
        found += list(arrays.elements(stream, start, end, len(data), bool(odd), depth))
        quotes, outside, inside = arrays.summary(stream, start, end)
        depth += inside if odd else outside
        odd = (odd + quotes) % 2
    return found


VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-99, 99) | st.text('ab"\\[]{},: \né', max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text('a"\\,', max_size=3), inner, max_size=3), max_leaves=8,
)


@settings(max_examples=150, deadline=None)
@given(st.lists(VALUES, max_size=6), st.integers(1, 40), st.sampled_from([None, 2]), st.booleans())
def test_any_range_finds_all_elements(values, step, indent, ascii_only):
    data = json.dumps(values, indent=indent, ensure_ascii=ascii_only).encode()
    found = by_ranges(data, step)
    assert [json.loads(text) for _, text, _ in found] == values
    assert all(whole for *_, whole in found) and [p for p, *_ in found] == sorted(p for p, *_ in found)


@pytest.mark.parametrize("step", [1, 3, 100])
def test_what_is_not_whole(step):
    assert [(t, w) for _, t, w in by_ranges(b'[{"a":1},{"b":', step)] == [(b'{"a":1}', True), (b'{"b":', False)]
    assert [(t, w) for _, t, w in by_ranges(b'[1,2]]x', step)] == [(b"1", True), (b"2", True), (b"]x", False)]
    assert [(t, w) for _, t, w in by_ranges(b'[,{}]', step)] == [(b"", True), (b"{}", True)]
    assert by_ranges(b" [ ] ", step) == []
    assert [(t, w) for _, t, w in by_ranges(b"[", step)] == [(b"", False)]


def test_pieces_are_no_matter(monkeypatch):
    monkeypatch.setattr(arrays, "PIECE_BYTES", 5)
    values = [{"a": 'x\\"]' * 7, "b": [1, {"c": "\\"}]}] * 9
    assert [json.loads(t) for _, t, _ in by_ranges(json.dumps(values).encode(), 17)] == values


def test_a_small_range_reads_about_its_own_bytes():
    class Counted(io.BytesIO):
        read_bytes = 0

        def read(self, size=-1):
            data = super().read(size)
            Counted.read_bytes += len(data)
            return data

    data = json.dumps([{"id": i, "title": "t" * 40} for i in range(40_000)]).encode()  # about 2 MB
    start, step = 1 << 20, 1 << 14
    odd, depth, _ = arrays.summary(io.BytesIO(data), 0, start)
    found = list(arrays.elements(Counted(data), start, start + step, len(data), bool(odd), depth))
    assert found and all(whole for *_, whole in found)
    assert Counted.read_bytes < 4 * step


def test_many_folders_are_listed_by_a_few_tasks(spark, tmp_path):
    for n in range(40):  # more folders than Spark lists on the driver
        (tmp_path / f"part={n}").mkdir()
        (tmp_path / f"part={n}" / "part-0").write_text(json.dumps([{"id": n}]))
    tracker, name = spark.sparkContext.statusTracker(), "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        rows = arrays.array_records(spark, str(tmp_path / "part=*" / "part-*"))
    finally:
        spark.sparkContext.setJobGroup("other", "other")
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(name) == before
    assert sorted(json.loads(r.record)["id"] for r in rows.collect()) == list(range(40))


def written(tmp_path, **texts):
    for name, text in texts.items():
        (tmp_path / f"tmdb_{name}.json").write_text(text)
    return str(tmp_path)


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    movies = [{"id": i, "title": f'Title "{i}" [', "extra": {"deep": [i]}} for i in range(2_000)]
    folder = written(tmp_path, big=json.dumps(movies, indent=2), small=json.dumps(movies[:3]), empty="[]", none="")
    split = files.read_records(spark, folder, fields=FIELDS, range_bytes=4_096)
    whole = files.read_movie_files(spark, folder, fields=FIELDS)
    assert sorted(map(tuple, split.select("id", "title").collect())) == sorted(map(tuple, whole.collect()))
    records = arrays.array_records(spark, f"{folder}/tmdb_*.json", 4_096)
    assert records.selectExpr("spark_partition_id() AS p").distinct().count() > 1
    big = split.where("source_file LIKE '%big%'").orderBy("ordinal").collect()
    assert [r.id for r in big] == list(range(2_000)) and json.loads(big[7].raw) == movies[7]


def test_small_ranges_share_tasks(spark, tmp_path):
    movies = [{"id": i, "title": f"t{i}"} for i in range(3_000)]
    folder = written(tmp_path, big=json.dumps(movies))
    records = arrays.array_records(spark, f"{folder}/tmdb_*.json", 64)
    assert records.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism  # not one a range
    assert sorted(json.loads(r.record)["id"] for r in records.collect()) == list(range(3_000))


def test_strict_and_tolerant(spark, tmp_path):
    folder = written(tmp_path, good='[{"id":1}]', cut='[{"id":2},{"id":3', odd='[{"id":4},5,{"id":x},{"id":6}]', one='{"id":7}', text="no json")
    tolerant = files.read_records(spark, folder, fields=FIELDS, strict=False, range_bytes=7)
    tolerant.write.parquet(str(tmp_path / "staged"))
    good, bad = files.split_malformed(spark.read.parquet(str(tmp_path / "staged")))
    assert sorted(r.id for r in good.collect()) == [1, 2, 4, 6, 7]
    assert sorted(r[files.CORRUPT] for r in bad.collect()) == ["5", "no json", '{"id":3', '{"id":x}']
    with pytest.raises(PySparkException, match="malformed record"):
        files.read_records(spark, folder, fields=FIELDS).collect()
    assert files.read_records(spark, folder, glob="tmdb_g*", fields=FIELDS).count() == 1


def test_raw_keys_are_written_again(spark, tmp_path):
    movies = [
        {"id": 1, "title": "One", "credits": {"cast": [{"name": "A", "id": 5}]}, "homepage": None, "n": 1.5, "a,b": "\\\"x"},
        {"id": 2, "title": None, "tags": [], "big": 12345678901234567890, "yes": True}, {"id": 3}, {"odd": "no typed field"},
        {"id": "not a number", "title": "Four"},
    ]
    folder = written(tmp_path, a=json.dumps(movies))
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "tmdb_b.json").write_text("\n".join(map(json.dumps, movies)) + "\n\n")
    for read in (files.read_records(spark, folder, fields=FIELDS, strict=False),
                 files.read_records(spark, folder + "/lines", fields=FIELDS, lines=True, strict=False)):
        enriched = read.where(f"{files.CORRUPT} IS NULL").drop("ordinal", files.CORRUPT).selectExpr("*", "'X' AS omdb_title")
        out = files.write_enhanced(enriched, f"{folder}/out{read.count()}{len(read.columns)}{id(read)}", "now")
        back = [json.loads(r.value) for r in spark.read.text(out).select("value").collect()]
        for one in back:
            assert one.pop("omdb_title") == "X" and one.pop("source_file")
        key = str
        assert sorted(back, key=key) == sorted(movies[:4], key=key)
    counted = files.output_files(spark, out, "now")
    assert [r.movies for r in counted.collect()] == [4]
