"""Fields out of HTML pages, by one table of rules whose expressions run in the JVM.

A page is read once into numbered elements: each start tag gets a number, and its element ends at
the next mark of that number, where its own end tag stood or that of an element around it. Void and
self-closed elements end at once, stray end tags say nothing, and what is open at the end of the
page ends there. The innermost elements, which hold no open tag, are numbered first, then those
around them, a few levels by one pattern each; a walk over the tags that are left knows the rest. A rule is a path of steps; each is the first match inside the one before, so that
a step is one pattern that reads up to the mark of the number it found. Comments hold no elements,
nor do scripts and styles unless a rule asks for them; attributes may be quoted either way or not
at all.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from html.entities import html5
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    first_integer,
    parse_integer,
    parse_percent,
    parse_rating,
    strip_word,
    year_in_text,
)

_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s>"']+)"""
_ATTRIBUTES = rf"""(?:\s+[^\s=>/"']+(?:\s*=\s*{_VALUE})?)*"""
_COMMENT = r"(?s)<!--.*?-->"
_UNREAD = (
    r"(?i)<!--[^-]*+(?:-(?!->)[^-]*+)*+-->"
    r"|<(script|style)(?=[\s>])[^<]*+(?:<(?!/\1\s*>)[^<]*+)*+(?:</\1\s*>)?"
)
_HIDDEN = r"(?i)<(?:!--|script[\s>]|style[\s>])"
# The parts of a tag that is surely one: no other tag can begin in its attributes.
_SURE = r"""(?:\s+[^\s=>/"'<]+(?:\s*=\s*(?:"[^"<]*"|'[^'<]*'|[^\s>"'<]+))?)*+"""
_TAG = rf"</?[A-Za-z][^\s/>]*+{_ATTRIBUTES}[^>]*>"
#: A tag that closes itself: its slash is no part of an attribute.
_ALONE = r"""(?:["'\s]|(?:^|\s)[^\s="']*)/>$"""
_ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
_PAIR, _ENTRY = "\x02", "\x01"
#: Marks of a numbered page: before a start tag's number, in place of its `<`, after it, and around
#: the number where its element ends; the next end of that number is its own.
_START, _TAGGED, _CLOSE, _END = "\x02", "\x06", "\x04", "\x03"
_OPEN = "\x05"
_CONTROLS = _START + _TAGGED + _CLOSE + _END + _OPEN
_MARKED = rf"{_START}[0-9]+[^{_CLOSE}]*{_CLOSE}|{_END}[0-9]+{_END}"
#: Tags of a page that are walked over together, and levels that are numbered before the walk.
_PIECE, _LEVELS = 256, 3
#: What stands up to the end of the element whose number is the first group.
_UP_TO_END = rf"([^{_END}]*+(?:{_END}(?!\1{_END})[^{_END}]*+)*+)"
# Elements that have no end tag.
VOID = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _named() -> Column:
    entries = (f"{name[:-1]}{_PAIR}{text}" for name, text in sorted(html5.items()) if name.endswith(";"))
    return F.str_to_map(F.lit(_ENTRY.join(entries)), F.lit(_ENTRY), F.lit(_PAIR))


def decode(text: Column) -> Column:
    """Text with characters in place of entities: by name, as in the standard library's table, or
    by number. An unknown name stays."""
    named = _named()

    def character(entity: Column) -> Column:
        digits = F.regexp_replace(entity, "[^0-9a-fA-F]", "")
        number = F.when(entity.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("int")
        by_number = bound(number, lambda n: F.when(
            n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF),
            F.decode(F.unhex(F.when(n < 0x10000, F.lpad(F.hex(n), 4, "0")).otherwise(F.concat(
                F.lpad(F.hex(F.lit(0xD800) + F.floor((n - 0x10000) / 0x400)), 4, "0"),
                F.lpad(F.hex(F.lit(0xDC00) + (n - 0x10000) % 0x400), 4, "0"),
            ))), "UTF-16BE"),
        ).otherwise("\ufffd"))
        by_name = F.coalesce(F.element_at(named, F.btrim(entity, F.lit("&;"))), entity)
        return F.when(entity.startswith("&#"), by_number).otherwise(by_name)

    def woven(whole: Column) -> Column:
        characters = F.transform(F.regexp_extract_all(whole, F.lit(_ENTITY), F.lit(0)), character)
        return F.when(F.contains(whole, F.lit("&")), _woven(F.split(whole, _ENTITY, -1), characters)).otherwise(whole)

    return bound(text, woven)


def _woven(gaps: Column, pieces: Column) -> Column:
    """The first gap, the first piece, the second gap and so on."""
    return F.array_join(F.flatten(F.zip_with(
        gaps, pieces, lambda gap, piece: F.array(gap, F.coalesce(piece, F.lit(""))),
    )), "")


def _peeled(page: Column) -> Column:
    """The page with numbers for void elements (0) and for those that hold no tag without a number,
    level by level."""
    void = rf"<((?i:{'|'.join(VOID)})(?=[\s/>]){_SURE}\s*/?>)"
    page = F.regexp_replace(page, void, f"{_START}0{_TAGGED}$1{_CLOSE}{_END}0{_END}")
    whole = rf"<(([A-Za-z][^\s/><]*+){_SURE}\s*>)([^<]*+)</(?i:\2)\s*>"
    for level in range(1, _LEVELS + 1):
        page = F.regexp_replace(page, whole, f"{_START}{level}{_TAGGED}$1{_CLOSE}$3{_END}{level}{_END}")
    return page


def numbered(html: Column) -> Column:
    """The page without comments, scripts and styles, its elements numbered.

    The walk over the tags that `_peeled` leaves keeps the names of the open elements, the innermost
    first, as one text that is cheap to copy. Its marks are gathered in pieces, so that a page of
    many tags does not copy them all at each.
    """
    none = F.array().cast("array<string>")

    def step(state: Column, token: Column) -> Column:
        names, depth, tag, name = state["names"], state["depth"], token["tag"], token["name"]
        at = F.instr(names, F.concat(F.lit(_OPEN), name, F.lit(_OPEN)))  # 0 for a stray end tag
        inner = F.substring(names, F.lit(1), at)
        ended = F.length(inner) - F.length(F.replace(inner, F.lit(_OPEN), F.lit("")))
        ends = F.transform(F.sequence(depth - 1, depth - ended, F.lit(-1)), lambda d: F.concat(
            F.lit(_END), d.cast("string"), F.lit(_END)))
        start = F.concat(F.lit(_START), depth.cast("string"), F.lit(_TAGGED), F.substring(tag, F.lit(2), F.length(tag)), F.lit(_CLOSE))
        is_end, alone = F.startswith(tag, F.lit("</")), tag.rlike(_ALONE) | name.isin(*VOID)
        closes = is_end & (at > 0)
        return F.struct(
            F.when(closes, F.substring(names, at + F.length(name) + 1, F.length(names)))
            .when(is_end | alone, names).otherwise(F.concat(F.lit(_OPEN), name, names)).alias("names"),
            F.when(closes, depth - ended).when(is_end | alone, depth).otherwise(depth + 1).alias("depth"),
            F.concat(state["marks"], F.array(
                F.when(closes, F.array_join(ends, "")).when(is_end, F.lit(""))
                .when(alone, F.concat(start, F.lit(_END), depth.cast("string"), F.lit(_END))).otherwise(start)
            )).alias("marks"),
        )

    def state_of(names: Column, depth: Column, marks: Column) -> Column:
        return F.struct(names.alias("names"), depth.alias("depth"), marks.alias("marks"))

    def piece(state: Column, first: Column, tokens: Column) -> Column:
        return F.aggregate(
            F.slice(tokens, first, F.lit(_PIECE)), state_of(state["names"], state["depth"], none), step,
            lambda x: state_of(x["names"], x["depth"], F.concat(state["marks"], F.array(x["marks"]))),
        )

    def marks(tokens: Column) -> Column:
        nothing = state_of(F.lit(_OPEN), F.lit(_LEVELS + 1), F.array().cast("array<array<string>>"))
        firsts = F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1)), F.lit(_PIECE))
        return F.aggregate(firsts, nothing, lambda state, first: piece(state, first, tokens), lambda x: F.flatten(x["marks"]))

    def read(page: Column) -> Column:
        tokens = F.transform(F.regexp_extract_all(page, F.lit(_TAG), F.lit(0)), lambda tag: F.struct(
            tag.alias("tag"), F.lower(F.regexp_extract(tag, r"^</?([^\s/>]+)", 1)).alias("name")))
        walked = _woven(F.split(page, _TAG, -1), bound(tokens, marks))
        return F.when(F.contains(page, F.lit("<")), walked).otherwise(page)

    seen = F.when(html.rlike(_HIDDEN), F.regexp_replace(html, _UNREAD, "")).otherwise(html)
    return bound(_peeled(F.regexp_replace(seen, f"[{_CONTROLS}]", "")), read)


@dataclass(frozen=True)
class Step:
    """The first `tag`, or the first that has the attribute value (one of the names, for a class)."""

    tag: str
    attribute: str | None = None
    value: str | None = None

    def tag_pattern(self) -> str:
        """Its start tag after the `<`."""
        if not self.attribute:
            return rf"{self.tag}{_ATTRIBUTES}\s*/?>"
        value = re.escape(self.value)
        if self.attribute == "class":
            held = rf"""(?:"(?:[^"]*\s)?{value}(?:\s[^"]*)?"|'(?:[^']*\s)?{value}(?:\s[^']*)?'|{value}(?=[\s>]))"""
        else:
            held = rf"""(?:"{value}"|'{value}'|{value}(?=[\s>]))"""
        return rf"{self.tag}{_ATTRIBUTES}?\s+{self.attribute}\s*=\s*{held}{_ATTRIBUTES}\s*/?>"

    def opening(self) -> str:
        """Its start tag in a numbered page; the first group is the number."""
        return rf"(?is){_START}([0-9]+){_TAGGED}{self.tag_pattern()}{_CLOSE}"

    def inside(self, page: Column) -> Column:
        """What the first such element of a numbered page holds; nothing where there is none."""
        return F.regexp_extract(page, self.opening() + _UP_TO_END, 2)

    def inside_each(self, page: Column) -> Column:
        return F.regexp_extract_all(page, F.lit(self.opening() + _UP_TO_END), F.lit(2))

    def unread_inside(self, html: Column) -> Column:
        """What a script or style holds; `html` has no comments, and its elements no numbers."""
        return F.regexp_extract(html, rf"(?is)<{self.tag_pattern()}(.*?)(?:</{self.tag}\s*>|\z)", 1)


@dataclass(frozen=True)
class Rule:
    """Text at the end of a path, or an attribute there; then a pattern's group; then a type.
    With `every`, the texts of all elements that match the only step. A path into a script or
    style has that one step."""

    field: str
    path: tuple[Step, ...]
    attribute: str | None = None
    pattern: str | None = None
    kind: str = "string"
    every: bool = False

    @property
    def unread(self) -> bool:
        return self.path[0].tag in ("script", "style")

    def raw(self, page: Column, entered: bool = False) -> Column:
        """The text as the page has it (with `every`, the texts), from a numbered page, or from one
        without comments if `unread`; nothing where there is none. `entered`: from what the path's
        first step found."""
        *outer, last = self.path
        for step in outer[1:] if entered else outer:
            page = step.inside(page)
        if self.every:
            return F.transform(last.inside_each(page), _text)
        if not self.attribute:
            return last.unread_inside(page) if self.unread else _text(last.inside(page))
        # The first element of the step, whether it has the attribute or not.
        held = rf"""(?is)\s{self.attribute}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
        return bound(F.regexp_extract(page, last.opening(), 0), lambda tag: F.concat(
            *(F.regexp_extract(tag, held, group) for group in (1, 2, 3))))

    def typed(self, text: Column) -> Column:
        """The field from the decoded text."""
        if self.pattern:
            text = F.regexp_extract(text, self.pattern, 1)
        present = bound(text, lambda x: F.when(x != "", x))
        return present if self.kind == "string" else present.try_cast(self.kind)


def _text(html: Column) -> Column:
    """The text of a piece of a numbered page, without tags."""
    return F.regexp_replace(html, _MARKED, "")


def settled(rows: DataFrame, others: list[str], **values: Column) -> DataFrame:
    """`others` and the values, which what follows names freely: Spark copies no expression through
    a generator, neither into a later one nor into a filter."""
    held = F.array(F.struct(*(value.alias(name) for name, value in values.items())))
    return rows.select(*others, F.inline(held))


def _fields(pages: DataFrame, others: list[str], found: list[tuple[Rule, Column]], into: str | None = None) -> DataFrame:
    """`others` and the fields of the rules from their raw texts, or as one struct `into`. All texts
    are decoded by one expression."""
    single = [(rule, text) for rule, text in found if not rule.every]
    raw = {"_raw": F.transform(F.array(F.lit(None).cast("string"), *(text for _, text in single)), decode)}
    raw |= {f"_every_{rule.field}": F.transform(texts, decode) for rule, texts in found if rule.every}
    place = {rule.field: number for number, (rule, _) in enumerate(single, 1)}
    fields = {
        rule.field: F.col(f"_every_{rule.field}") if rule.every else rule.typed(F.get("_raw", F.lit(place[rule.field])))
        for rule, _ in found
    }
    if into:
        fields = {into: F.struct(*(value.alias(name) for name, value in fields.items()))}
    return settled(settled(pages, others, **raw), others, **fields)


def extract(pages: DataFrame, rules: list[Rule], html: str = "html", into: str | None = None) -> DataFrame:
    """The rules' fields beside the other columns, or as one struct `into`."""
    others = [f"`{name}`" for name in pages.columns if name != html]
    ready = {}
    if any(not rule.unread for rule in rules):
        ready["_page"] = numbered(F.col(html))
    if any(rule.unread for rule in rules):
        ready["_unread"] = F.regexp_replace(F.col(html), _COMMENT, "")
    read = settled(pages, others, **ready)
    firsts = [rule.path[0] for rule in rules if len(rule.path) > 1]
    shared = {step: f"_step{n}" for n, step in enumerate(dict.fromkeys(firsts)) if firsts.count(step) > 1}
    if shared:
        read = settled(read, [*others, *ready], **{name: step.inside(F.col("_page")) for step, name in shared.items()})
    found = []
    for rule in rules:
        entered = len(rule.path) > 1 and rule.path[0] in shared
        source = shared[rule.path[0]] if entered else "_unread" if rule.unread else "_page"
        found.append((rule, rule.raw(F.col(source), entered)))
    return _fields(read, others, found, into)


# Where the pages keep their scores.
_HERO = Step("div", "data-testid", "hero-metadata")
_CRITICS = Step("div", "data-testid", "critic-score-info")
_USERS = Step("div", "data-testid", "user-score-info")
_SCORE = (Step("div", "class", "c-siteReviewScore"), Step("span"))
METACRITIC_RULES = [
    Rule("year", (_HERO, Step("li"), Step("span"))),
    Rule("critic_score", (_CRITICS, *_SCORE)),
    Rule("critic_count", (_CRITICS, Step("a", "data-testid", "critic-path"))),
    Rule("user_score", (_USERS, *_SCORE)),
    Rule("user_count", (_USERS, Step("a", "data-testid", "user-path"))),
]
METACRITIC_MARKERS = ("hero-metadata",)

# The card is an element of its own name, or a div of that class.
_CARD = Step("media-scorecard"), Step("div", "class", "media-scorecard")
_SCORECARD = rf"(?is){_START}([0-9]+){_TAGGED}(?:{_CARD[0].tag_pattern()}|{_CARD[1].tag_pattern()}){_CLOSE}"
ROTTEN_TOMATOES_RULES = [
    Rule("any_critic_score", (Step("rt-text", "slot", "criticsScore"),)),
    Rule("any_user_score", (Step("rt-text", "slot", "audienceScore"),)),
    Rule("metadata", (Step("rt-text", "slot", "metadataProp"),), every=True),
]
SCORECARD_RULES = [
    Rule("critic_score", (Step("rt-text", "slot", "criticsScore"),)),
    Rule("critic_count", (Step("rt-link", "slot", "criticsReviews"),)),
    Rule("user_score", (Step("rt-text", "slot", "audienceScore"),)),
    Rule("user_count", (Step("rt-link", "slot", "audienceReviews"),)),
]
ROTTEN_TOMATOES_MARKERS = ("media-scorecard", "metadataProp", "criticsScore")
# End of fixed values.


def _marked(html: str, markers: tuple[str, ...]) -> Column:
    """The page if it has a marker; the rules of others are not tried."""
    return F.when(reduce(or_, (F.contains(F.col(html), F.lit(m)) for m in markers)), F.col(html))


def extract_metacritic(pages: DataFrame, html: str = "html") -> DataFrame:
    """Scores of each page; a page that states no year is not one and is left out."""
    page = extract(pages.withColumn(html, _marked(html, METACRITIC_MARKERS)), METACRITIC_RULES, html, "_page")
    others = [f"`{name}`" for name in page.columns if name != "_page"]
    return page.select(
        *others,
        parse_integer("_page.year").alias("year"),
        parse_rating("_page.critic_score").alias("critic_score"),
        first_integer("_page.critic_count").alias("critic_count"),
        parse_rating("_page.user_score").alias("user_score"),
        first_integer("_page.user_count", thousands=True).alias("user_count"),
        F.lit("metacritic").alias("data_source"),
    ).filter(F.col("year").isNotNull())


def extract_rotten_tomatoes(pages: DataFrame, html: str = "html") -> DataFrame:
    """Scores of each page, the years its details state, and whether both scores are shown."""
    others = [f"`{name}`" for name in pages.columns if name != html]
    read = settled(pages, others, _read=numbered(_marked(html, ROTTEN_TOMATOES_MARKERS)))
    card = F.regexp_extract("_read", _SCORECARD + _UP_TO_END, 2)
    shown = settled(read, [*others, "_read"], _card=card, _shown=F.col("_read").rlike(_SCORECARD))
    page = _fields(shown, [*others, "_shown"], [
        *((rule, rule.raw(F.col("_read"))) for rule in ROTTEN_TOMATOES_RULES),
        *((rule, rule.raw(F.col("_card"))) for rule in SCORECARD_RULES),
    ], "_page")
    years = F.array_compact(F.transform("_page.metadata", year_in_text))
    return page.select(
        *others,
        F.coalesce(years, F.array().cast("array<int>")).alias("years"),
        (F.coalesce(F.col("_shown"), F.lit(False)) & F.col("_page.any_critic_score").isNotNull()
         & F.col("_page.any_user_score").isNotNull()).alias("has_scorecard"),
        parse_percent("_page.critic_score").alias("critic_score"),
        first_integer("_page.critic_count").alias("critic_count"),
        parse_percent("_page.user_score").alias("user_score"),
        F.nullif(strip_word("_page.user_count"), F.lit("")).alias("user_count"),
        F.lit("rottentomatoes").alias("data_source"),
    )


def slug_of_url(url: Column | str, folder: str) -> Column:
    """Last part of a page address below its folder, as in `/movie/<slug>` or `/m/<slug>/`."""
    url = F.col(url) if isinstance(url, str) else url
    return F.nullif(F.regexp_extract(url, rf"/{folder}/([^/?#]+)", 1), F.lit(""))
