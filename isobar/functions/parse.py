"""Parsers of labels, tokens and inventory lines, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Words of a bin label: behind a number they close it on one side, before it they leave the number out.
CLOSING = {"above": "up", "higher": "up", "+": "up", "below": "down", "lower": "down", "under": "down"}
LEADING = {"over": "up", "above": "up", "greater than": "up", "under": "down", "below": "down", "less than": "down"}
UNITS, JOINERS, RANGES = ("f", "degree", "degrees"), ("or", "and"), ("-", "to", "through")
#: Without "or" before them these leave the number out, too.
EXCLUSIVE = ("below", "under")


def event_bin(label: Column) -> Column:
    """struct<lower, upper> of a bin label in whole degrees, closed; null if no rule fits.

    A label is read as numbers and words. In this order: a number with a
    closing word behind it (a unit and "or" or "and" may stand between) closes
    at the number, but "below" and "under" without "or" at the number less one;
    a leading word before a number leaves the number out; two numbers with a
    range word between them are a range, whichever is first; a number alone, or
    with F, is itself.
    """
    text = F.replace(F.lower(label), F.lit("°"), F.lit(""))
    return let(F.regexp_extract_all(text, F.lit(r"(\d+|[a-z]+|[^\sa-z\d])"), F.lit(1)), _bounds_of)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _side(table: dict[str, str], word: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), word)


def _bounds_of(words: Column) -> Column:
    """The bounds that a label's words give."""
    def at(place: Column) -> Column:
        return F.when(place >= 0, F.get(words, place))

    def read(word: Column, place: Column) -> Column:
        behind = F.when(at(place + 1).isin(*UNITS), place + 2).otherwise(place + 1)
        leading = F.when(at(place - 1) == "than", F.concat_ws(" ", at(place - 2), F.lit("than"))).otherwise(at(place - 1))
        return F.struct(
            word.try_cast("int").alias("n"), at(behind).alias("one"), at(behind + 1).alias("two"), _side(LEADING, leading).alias("leading"),
            F.when(at(place + 1).isin(*RANGES), at(place + 2).try_cast("int")).alias("other"),
        )

    def closed(x: Column) -> Column:
        joined = F.coalesce(x["one"].isin(*JOINERS), F.lit(False))
        word = F.when(joined, x["two"]).otherwise(x["one"])
        less = F.when(word.isin(*EXCLUSIVE) & ~(joined & (x["one"] == "or")), 1).otherwise(0)
        return F.struct(x["n"].alias("n"), _side(CLOSING, word).alias("closing"), less.alias("less"), x["leading"].alias("leading"), x["other"].alias("other"))

    def decide(numbers: Column) -> Column:
        def first(name: str, value: str | None = None) -> Column:
            return F.get(F.filter(numbers, lambda x: x[name].isNotNull() if value is None else x[name] == value), F.lit(0))

        def bounds(lower: Column, upper: Column) -> Column:
            return F.struct(lower.cast("int").alias("lower"), upper.cast("int").alias("upper"))

        none = F.lit(None).cast("int")
        up, down, under, over, ranged = first("closing", "up"), first("closing", "down"), first("leading", "down"), first("leading", "up"), first("other")
        alone = F.when((F.size(words) == 1) | ((F.size(words) == 2) & (at(F.lit(1)) == "f")), at(F.lit(0)).try_cast("int"))
        return (
            F.when(up.isNotNull(), bounds(up["n"], none))
            .when(down.isNotNull(), bounds(none, down["n"] - down["less"]))
            .when(under.isNotNull(), bounds(none, under["n"] - 1))
            .when(over.isNotNull(), bounds(over["n"] + 1, none))
            .when(ranged.isNotNull(), bounds(F.least(ranged["n"], ranged["other"]), F.greatest(ranged["n"], ranged["other"])))
            .when(alone.isNotNull(), bounds(alone, alone))
        )

    return let(F.transform(F.filter(F.transform(words, read), lambda x: x["n"].isNotNull()), closed), decide)


def json_list(text: Column) -> Column:
    """array<string> of a JSON list; null where the text is none."""
    return F.from_json(text, "array<string>")


def time_of(value: Column) -> Column:
    """A UTC instant from epoch seconds or ISO text, with or without an offset (without one it is UTC); null if it is neither."""
    text = F.trim(value.cast("string"))
    number = F.when(F.rlike(text, F.lit(r"^\d+(\.\d+)?$")), F.timestamp_seconds(text.cast("double")))
    offset = F.rlike(text, F.lit(r"(Z|[+-]\d{2}:?\d{2})$"))
    return F.coalesce(number, F.try_to_timestamp(F.when(offset, text).otherwise(F.concat(text, F.lit("Z"))))).cast("timestamp_ntz")


def metar_temperature_c(remarks: Column, fallback: Column) -> Column:
    """Tenths of a degree from the group TsTTTsDDD of the remarks, else ``fallback``."""
    sign, tenths = F.regexp_extract(remarks, r"\bT([01])(\d{3})[01]\d{3}\b", 1), F.regexp_extract(remarks, r"\bT([01])(\d{3})[01]\d{3}\b", 2)
    return F.when(sign != "", F.when(sign == "1", -1.0).otherwise(1.0) * F.try_to_number(F.nullif(tenths, F.lit("")), F.lit("999")).cast("double") / 10.0).otherwise(fallback)


def bulletin_value(token: Column, label: Column) -> Column:
    """A cell's number: blank, X and all-nines are null, as is text (the token itself is kept beside it)."""
    text = F.trim(token)
    nines = F.rlike(text, F.lit("^9+$"))
    return F.when(F.rlike(text, F.lit("^-?\\d+$")) & ~nines, text.cast("double"))


INVENTORY = r"^(\d+):(\d+):d=(\d{10}):([^:]*):([^:]*):([^:]*):?(.*)$"


def inventory_line(line: Column) -> Column:
    """struct<record, offset, init, short, level, step, extra> of an inventory line; null if it is none."""
    def part(k: int) -> Column:
        return F.regexp_extract(line, INVENTORY, k)

    return F.when(
        F.rlike(line, F.lit(INVENTORY)),
        F.struct(
            F.try_to_number(part(1), F.lit("9999999999")).cast("long").alias("record"), F.try_to_number(part(2), F.lit("999999999999999")).cast("long").alias("offset"), part(3).alias("init"),
            part(4).alias("short"), part(5).alias("level"), part(6).alias("step"), part(7).alias("extra"),
        ),
    )


def event_slug(day: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix + "-"), F.lower(F.date_format(day, "MMMM")), F.lit("-"), F.dayofmonth(day).cast("string"), F.lit("-"), F.year(day).cast("string"))
