"""Line dedup: lines that many documents share stay in one of them.

Hashes of the long lines are range-partitioned by hash and document and sorted by document and
position in each range, so that the first occurrence of a line in a document streams out of the
sort; these are counted, and the last document of a line keeps it. A line of a third of all
documents is divided among ranges, each of which hands on one row for it. The result is a bitmap for each document as runs of dropped lines; texts are not moved until it is applied.
Only DataFrame functions run.

Cases: a null text is an empty one, with one empty line. A null id counts as one document, lower
than all others. Rows with the same id are one document: each keeps its own lines. Rows that are
equal get equal results. An empty table gives an empty result. A long text is a list of lines like
others. Columns of other names are kept, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import packed, stored, text_key, unpacked

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCUMENTS = 3


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(docs: DataFrame, *, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(id, k1, k2, pos, h1, h2): the long lines of each text as two 64-bit hashes."""
    whole = F.coalesce(F.col(text), F.lit(""))
    k1, k2 = text_key(whole)
    lines = docs.select(
        F.col(doc_id).alias("id"), k1.alias("k1"), k2.alias("k2"), F.posexplode(_lines(whole)).alias("pos", "line")
    ).select("id", "k1", "k2", "pos", line_key(F.col("line")).alias("key"))
    h1, h2 = text_key(F.col("key"))
    return lines.where(F.length("key") >= min_chars).select(
        "id", "k1", "k2", "pos", h1.alias("h1"), h2.alias("h2")
    )


def last_holders(hashes: DataFrame, min_documents: int) -> DataFrame:
    """(h1, h2, last): the lines of at least `min_documents` documents, and the largest id.

    The first occurrence of a line in a document streams out of its sorted range; a range hands on
    one row for each of its lines.
    """
    in_ranges = hashes.select("h1", "h2", "id", "pos").repartitionByRange("h1", "h2", "id")
    in_document = Window.partitionBy("h1", "h2", "id").orderBy("pos")
    firsts = in_ranges.withColumn("nth", F.row_number().over(in_document)).where("nth = 1")
    return (
        firsts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("documents"), F.max("id").alias("last"))
        .where(F.col("documents") >= min_documents).drop("documents")
    )


def keep_bitmaps(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
    min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """(id, k1, k2, dropped): for each text that loses lines, the runs of dropped positions as
    (first, last), in order. k1 and k2 are the hashes of the text from `text_key`."""
    hashes = stored(line_hashes(docs, doc_id=doc_id, text=text, min_chars=min_chars), "lines")
    # read from a table, both sides are dealt out for the join alone, so that Spark divides a hot line
    holders = stored(last_holders(hashes, min_documents), "holders")
    doomed = (
        hashes.join(holders, ["h1", "h2"])
        .where(~F.col("id").eqNullSafe(F.col("last")))
    )
    sorted_ = doomed.groupBy("id", "k1", "k2").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    at = F.col("at")
    starts = F.filter(at, lambda p, i: (i == 0) | (F.get(at, i - 1) != p - 1))
    ends = F.filter(at, lambda p, i: (i == F.size(at) - 1) | (F.get(at, i + 1) != p + 1))
    return sorted_.select(
        "id", "k1", "k2",
        F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), b.alias("last"))).alias("dropped"),
    )


def apply_bitmaps(rows: DataFrame, bitmaps: DataFrame, text: Column) -> DataFrame:
    """`rows` (with a column id) with the text that is left (kept), n_lines and n_dropped."""
    whole = F.coalesce(text, F.lit(""))
    k1, k2 = text_key(whole)
    both = rows.withColumns({"key1": k1, "key2": k2}).join(
        bitmaps.withColumnRenamed("id", "of"),
        (F.col("key1") == F.col("k1")) & (F.col("key2") == F.col("k2")) & F.col("id").eqNullSafe(F.col("of")),
        "left",
    ).drop("key1", "key2", "k1", "k2", "of")
    lines, runs = _lines(whole), F.col("dropped")
    gone = F.flatten(F.transform(runs, lambda r: F.sequence(r["first"], r["last"])))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    count = F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    rest = F.array_join(F.transform(F.col("left"), lambda i: F.get(F.col("lines"), i)), "\n")
    return both.withColumns({
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.coalesce(count, F.lit(0).cast("long")),
        "lines": F.when(runs.isNotNull(), lines),
        "left": F.when(runs.isNotNull(), left),
    }).withColumn("kept", F.when(runs.isNull(), whole).otherwise(rest)).drop("lines", "left", "dropped")


def digest(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) for each row."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return apply_bitmaps(rows, keep_bitmaps(docs, doc_id=doc_id, text=text, **limits), F.col("text")).select(
        F.col("id").alias(doc_id), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


def without_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """`docs` with the text that is left, and their other columns."""
    bitmaps = keep_bitmaps(docs, doc_id=doc_id, text=text, **limits)
    cut = apply_bitmaps(packed(docs, id=doc_id), bitmaps, F.col("row")[text])
    return unpacked(cut, docs, **{text: F.col("kept")})


SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k
  FROM lines
), shared AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= {MIN_CHARS}
  GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}
), marked AS (
  SELECT keyed.*, last IS NOT NULL AND last <> doc_id AS dropped FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
