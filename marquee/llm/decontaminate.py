"""Benchmark decontamination by canonical templates.

Texts become tokens; numbers, units and names (words with a capital inside a sentence) become typed
placeholders, all else is in lower case. Windows of tokens from all documents meet the windows of
the benchmark by hash. Each benchmark window has an anchor, its longest two literal tokens in a row
(or the longest one): documents are read into tokens once, and a window is built only where a table
of the anchors says that one may stand around the token. Hits of a document and an item are gathered
by diagonal (the distance of their places), and diagonals that differ by at most `GAP` into chains;
an item is found if one chain covers enough of it. Where a window holds placeholders, each value of the item must stand for one value
of the document all along the diagonal: a question with other numbers or names is caught, a chance
likeness of templates is not. Only DataFrame functions run.

Windows of the plain tokens in lower case are looked up beside the templates, whatever they hold:
they count without a test of values. Where the templates alone do not cover an item, both together
may; so a copy word for word is found whatever its values are and whatever stands around it.

Cases: a null or empty text on either side has no tokens and no hits. An item shorter than a window
is one window. Template windows with fewer than `MIN_LITERAL` literal tokens say nothing and are left
out, so that an item without that many is found in exact copies only. Of several chains the one that
covers most counts, then the one with fewest changes. Repeated items and documents are found each by
themselves; items with a null id are left out. An empty table on either side gives an empty result.
Columns of other names take no part and are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.pages import settled
from .common import packed, sent_if_small, stored, text_key, unpacked

WINDOW = 8
MIN_LITERAL = 4
#: Tokens of an item that a document must hold, or all of them if the item has fewer.
MIN_COVERED = 13
#: Tokens by which neighbouring diagonals of one passage may differ: words put in or left out.
GAP = 16
#: Slots of the table of anchors, a literal of so many bytes. Keys that share a slot cost time only.
SLOTS = 1 << 17
#: A capital inside a sentence gets a mark before the text goes to lower case.
MARK = "\x01"
INNER_CAPITAL = r"(?<=[\p{L}\p{M}0-9,;] )\p{Lu}(?=\p{Ll})"
TOKEN = r"\x01?(?:[0-9]++(?:[.,][0-9]++)*+|[\p{L}\p{M}]++(?:['’]\p{L}++)*+|[%$€£°])"
NUMBER, UNIT, NAME = "#number", "#unit", "#name"
UNITS = (
    "%", "$", "€", "£", "°", "mm", "cm", "m", "km", "inch", "inches", "feet", "foot", "yards", "mile", "miles",
    "mg", "g", "kg", "tons", "ounces", "pound", "pounds", "ml", "l", "liter", "liters", "gallons",
    "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months",
    "year", "years", "cent", "cents", "dollar", "dollars", "euro", "euros", "percent", "mph", "degrees",
)


def tokens(text: Column) -> Column:
    """Numbers, words and unit signs in lower case; a name begins with the mark."""
    marked = F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(" ")), INNER_CAPITAL, MARK + "$0")
    return F.regexp_extract_all(F.lower(marked), F.lit(TOKEN), F.lit(0))


def canonical(raw: Column) -> Column:
    """Tokens with placeholders."""
    def one(token: Column) -> Column:
        return (
            F.when((token >= "0") & (token < ":"), NUMBER).when(token < "\x02", NAME)
            .when(token.isin(*UNITS), UNIT).otherwise(token)
        )

    return F.transform(raw, one)


def plain(raw: Column) -> Column:
    """Tokens without the marks of names, apart from all canonical ones."""
    return F.transform(raw, lambda t: F.concat(F.lit(MARK), F.replace(t, F.lit(MARK), F.lit(""))))


def _is_slot(token: Column) -> Column:
    return token.startswith("#")


def _bare(token: Column) -> Column:
    return F.replace(token, F.lit(MARK), F.lit(""))


def templates(benchmark: DataFrame, *, item_id: str, text: str) -> DataFrame:
    """One row for each item: (item, tokens, canonical); items without tokens are left out."""
    raw = benchmark.select(F.col(item_id).alias("item"), tokens(F.col(text)).alias("tokens"))
    return raw.where("item IS NOT NULL AND size(tokens) > 0").withColumn("canonical", canonical(F.col("tokens"))).distinct()


def _pair_key(hashes: Column, place: Column) -> Column:
    return F.xxhash64(F.get(hashes, place), F.get(hashes, place + 1))


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """The windows of the items: (hash, item, item_at, length, has_slots, exact, key, offset).

    `key` is the anchor, the longest two literal tokens in a row (or the longest one), and `offset`
    its place in the window."""
    n = F.least(F.size("canonical"), F.lit(window))
    rows = items.select("item", "tokens", "canonical", n.alias("length")).select(
        "*", F.transform("tokens", _bare).alias("bare"), plain(F.col("tokens")).alias("plain"),
    ).select("*", F.transform("bare", lambda t: F.xxhash64(t)).alias("hashes"))

    def form(name: str, exact: bool) -> DataFrame:
        at = F.explode(F.sequence(F.lit(0), F.size("tokens") - F.col("length")))
        slices = rows.select("item", "bare", "hashes", "length", name, at.alias("item_at")).select(
            "*", F.slice(name, F.col("item_at") + 1, F.col("length")).alias("held"))
        literal = slices.withColumn("slots", F.size(F.filter("held", _is_slot)))
        def good(k):
            return ~_is_slot(F.get("held", k - F.col("item_at")))

        def length_of(k):
            return F.length(F.get("bare", k))

        places = F.sequence(F.col("item_at"), F.col("item_at") + F.col("length") - 1)
        end = F.col("item_at") + F.col("length") - 1
        pairs = F.transform(F.filter(places, lambda k: (k < end) & good(k) & good(k + 1)), lambda k: F.struct(
            (length_of(k) + length_of(k + 1)).alias("size"), _pair_key(F.col("hashes"), k).alias("key"), k.alias("k")))
        singles = F.transform(F.filter(places, good), lambda k: F.struct(
            length_of(k).alias("size"), F.get("hashes", k).alias("key"), k.alias("k")))
        anchored = literal.where(F.lit(exact) | (F.col("length") - F.col("slots") >= MIN_LITERAL)).withColumn(
            "anchor", F.coalesce(F.array_max(pairs), F.array_max(singles)))
        return anchored.select(
            F.xxhash64("held").alias("hash"), "item", "item_at", "length",
            (~F.lit(exact) & (F.col("slots") > 0)).alias("has_slots"), F.lit(exact).alias("exact"),
            F.col("anchor.key").alias("key"), (F.col("anchor.k") - F.col("item_at")).alias("offset"),
            F.array_max(pairs).isNull().alias("single"),
        )

    return form("canonical", False).unionAll(form("plain", True))


def _anchor_table(windows: DataFrame) -> tuple[Column, list[tuple[int, int]], bool]:
    """A byte for each of `SLOTS` slots of a key, whose bits tell the offsets of windows that may
    stand around it (modulo 8); the (length, offset) there are; and whether some anchors are single
    tokens."""
    rows = windows.select("length", "offset", "single").distinct().collect()  # at most 2 for each place in a window
    kinds = sorted({(r["length"], r["offset"]) for r in rows})
    bit = F.call_function("shiftleft", F.lit(1), F.pmod(F.col("offset"), F.lit(8)).cast("int"))
    table = bytearray(SLOTS)
    for row in windows.groupBy(_slot(F.col("key")).alias("slot")).agg(F.bit_or(bit).alias("bits")).collect():  # at most SLOTS
        table[row["slot"]] = row["bits"]
    return F.lit(bytes(table)), kinds, any(r["single"] for r in rows)


def _slot(key: Column) -> Column:
    return key.bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def doc_windows(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(k1, k2, at, hash): the windows of the texts (k1, k2, tokens) that stand around an anchor."""
    table, kinds, singles = _anchor_table(windows)
    if not kinds:
        return docs.limit(0).select("k1", "k2", F.lit(0).alias("at"), F.lit(0).cast("long").alias("hash"))
    hashed = settled(docs, ["k1", "k2", "tokens"], hashes=F.transform("tokens", lambda t: F.xxhash64(_bare(t))))
    hashes, size = F.col("hashes"), F.size("tokens")

    def looked_up(i: Column, key: Column) -> Column:
        return F.struct(i.alias("i"), F.substring(table, _slot(key) + 1, F.lit(1)).alias("byte"))

    def in_table(key_at) -> Column:
        found = F.transform(F.sequence(F.lit(0), size - 1), lambda i: looked_up(i, key_at(i)))
        return F.when(size > 0, F.filter(found, lambda x: x["byte"] != F.lit(b"\0"))).otherwise(F.array().cast(
            "array<struct<i:int,byte:binary>>"))

    places = in_table(lambda i: F.coalesce(_pair_key(hashes, i), F.lit(0)))
    if singles:
        places = F.concat(places, in_table(lambda i: F.get(hashes, i)))
    around = F.array(*(
        F.struct(F.lit(length).alias("length"), F.lit(offset).alias("offset")) for length, offset in kinds
    ))

    def standing(place: Column) -> Column:
        i, bits = place["i"], F.conv(F.hex(place["byte"]), 16, 10).cast("int")
        fits = F.filter(around, lambda c: (F.call_function("getbit", bits, c["offset"] % 8) == 1) & (i >= c["offset"])
                        & (i - c["offset"] + c["length"] <= size))
        return F.transform(fits, lambda c: F.struct((i - c["offset"]).alias("at"), c["length"].alias("length")))

    at = settled(hashed, ["k1", "k2", "tokens"], at=F.array_distinct(F.flatten(F.transform(places, standing))))
    held = at.where(F.size("at") > 0)

    def forms(w: Column) -> Column:
        held = F.slice("tokens", w["at"] + 1, w["length"])
        return F.array(*(F.struct(w["at"].alias("at"), F.xxhash64(form(held)).alias("hash")) for form in (canonical, plain)))

    return held.select("k1", "k2", F.inline(F.flatten(F.transform("at", forms))))


def chains(diagonals: DataFrame) -> DataFrame:
    """`diagonals` with the number of their chain: diagonals of a text and an item of which each
    lies within `GAP` of the next."""
    by_shift = Window.partitionBy("k1", "k2", "item").orderBy("shift")
    far = F.coalesce((F.col("shift") - F.lag("shift").over(by_shift) > GAP).cast("int"), F.lit(0))
    return diagonals.withColumn("far", far).withColumn(
        "chain", F.sum("far").over(by_shift.rangeBetween(Window.unboundedPreceding, 0))).drop("far")


def leaks(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, min_covered: int = MIN_COVERED,
) -> DataFrame:
    """(k1, k2, item, n_covered, n_changed): texts, by the hashes from `text_key`, that hold an
    item; how many of its tokens, and how many of those with another number, unit or name."""
    items = stored(templates(benchmark, item_id=item_id, text=item_text), "templates")
    windows = stored(item_windows(items, window), "item-windows")
    k1, k2 = text_key(F.col(text))
    doc_tokens = settled(docs, [], k1=k1, k2=k2, tokens=tokens(F.col(text)))
    hits = doc_windows(doc_tokens, windows).join(sent_if_small(windows.drop("key", "offset", "single")), "hash")
    diagonals = stored(
        hits.groupBy("k1", "k2", "item", (F.col("at") - F.col("item_at")).alias("shift"), "length", "exact")
        .agg(F.collect_set("item_at").alias("places"), F.max("has_slots").alias("has_slots")),
        "diagonals",
    )
    covered = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("length") - 1))))
    diagonals = diagonals.withColumn("covered", covered)

    literal = diagonals.where(~F.col("has_slots")).select(
        "k1", "k2", "item", "shift", "exact", "covered", F.array().cast("array<int>").alias("changed"))
    pairs = F.transform(
        F.filter("covered", lambda p: _is_slot(F.get(F.col("canonical"), p))),
        lambda p: F.struct(
            F.get(F.col("item_tokens"), p).alias("mine"), F.get(F.col("tokens"), p + F.col("shift")).alias("other"),
            p.alias("at"),
        ),
    )
    asked = diagonals.where("has_slots")
    slotted = (
        asked.join(items.withColumnRenamed("tokens", "item_tokens"), "item")
        .join(doc_tokens.join(asked.select("k1", "k2").distinct(), ["k1", "k2"]).dropDuplicates(["k1", "k2"]), ["k1", "k2"])
        .withColumn("pairs", pairs)
        .where(F.size(F.array_distinct("pairs.mine")) == F.size(F.array_distinct(
            F.transform("pairs", lambda x: F.struct(x["mine"], x["other"])))))
        .select("k1", "k2", "item", "shift", "exact", "covered",
                F.filter("pairs", lambda x: x["mine"] != x["other"])["at"].alias("changed"))
    )
    by_templates = F.array_distinct(F.flatten(F.collect_list(F.when(~F.col("exact"), F.col("covered")))))
    needed = F.least(F.col("n"), F.lit(min_covered))
    return (
        chains(literal.unionAll(slotted)).groupBy("k1", "k2", "item", "chain")
        .agg(by_templates.alias("by_templates"), F.array_distinct(F.flatten(F.collect_list("covered"))).alias("both"),
             F.size(F.array_distinct(F.flatten(F.collect_list("changed")))).cast("long").alias("changed"))
        .join(items.select("item", F.size("canonical").alias("n")), "item")
        .withColumn("covered", F.when(F.size("by_templates") >= needed, F.col("by_templates")).otherwise(F.col("both")))
        .where(F.size("covered") >= needed)
        .groupBy("k1", "k2", "item").agg(F.max(F.struct(
            F.size("covered").cast("long").alias("n_covered"), (-F.col("changed")).alias("kept"))).alias("best"))
        .select("k1", "k2", "item", "best.n_covered", (-F.col("best.kept")).alias("n_changed"))
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
) -> DataFrame:
    """(doc_id, item_id, n_covered, n_changed): one row for each document and item found in it."""
    found = leaks(docs.select(doc_id, text), benchmark, text=text, item_id=item_id)
    k1, k2 = text_key(F.col(text))
    return docs.select(doc_id, k1.alias("k1"), k2.alias("k2")).join(found, ["k1", "k2"]).select(
        doc_id, F.col("item").alias(item_id), "n_covered", "n_changed"
    )


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    found = stored(leaks(docs, benchmark, text=text, item_id=item_id).select("k1", "k2").distinct(), "leaks")
    key1, key2 = text_key(F.col("text"))
    rows = packed(docs, text=text).select("row", key1.alias("key1"), key2.alias("key2"))
    same = (F.col("key1") == F.col("k1")) & (F.col("key2") == F.col("k2"))
    return unpacked(rows.join(sent_if_small(found), same, "left_anti"), docs)
