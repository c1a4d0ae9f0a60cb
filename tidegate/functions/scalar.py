"""Scalar column functions; all are built-in expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

BLANKS = "[ \\t\\n\\r]+"
MONDAY = "1970-01-05"


def _weekdays_before(day: Column) -> Column:
    """Mon-Fri days between a fixed Monday and `day`."""
    n = F.datediff(day, F.lit(MONDAY).cast("date"))
    return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))


def business_days(start: Column, end: Column) -> Column:
    """Mon-Fri days in [start, end); negative for reversed dates, 0 when either is null."""
    start, end = start.cast("date"), end.cast("date")
    forward = _weekdays_before(end) - _weekdays_before(start)
    backward = _weekdays_before(end + F.expr("interval 1 day")) - _weekdays_before(start + F.expr("interval 1 day"))
    return F.coalesce(F.when(start <= end, forward).otherwise(backward), F.lit(0)).cast("bigint")


def register_functions(spark: SparkSession) -> None:
    """Make `DAY_BETWEEN(start, end)` callable from SQL, as a SQL function without Python workers."""
    wd = "(floor(datediff({d}, DATE'1970-01-05') / 7) * 5 + least(pmod(datediff({d}, DATE'1970-01-05'), 7), 5))"
    forward = f"{wd.format(d='e')} - {wd.format(d='s')}"
    backward = f"{wd.format(d='date_add(e, 1)')} - {wd.format(d='date_add(s, 1)')}"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION DAY_BETWEEN(s DATE, e DATE) RETURNS BIGINT "
        f"RETURN CAST(coalesce(CASE WHEN s <= e THEN {forward} ELSE {backward} END, 0) AS BIGINT)"
    )


def register_vectorized(spark: SparkSession, name: str, function: Callable, return_type: str) -> None:
    """Make a function of pandas Series callable from SQL, for what built-in expressions cannot say."""
    spark.udf.register(name, F.pandas_udf(function, return_type))


def conditional_add(value: Column, label: Column, amounts: Mapping[str, int], otherwise: int) -> Column:
    """`value` plus the amount configured for `label`; an unknown or null label adds `otherwise`."""
    added = F.lit(otherwise)
    for name, amount in amounts.items():
        added = F.when(label == name, F.lit(amount)).otherwise(added)
    return value + added


def words(text: Column) -> Column:
    """Non-empty words between blanks, tabs and line ends."""
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def first_word(text: Column) -> Column:
    return F.get(words(text), F.lit(0))


def last_word_length(text: Column) -> Column:
    return F.length(F.try_element_at(words(text), F.lit(-1)))


def reverse_words(text: Column) -> Column:
    return F.array_join(F.reverse(words(text)), " ")


def vowel_count(text: Column) -> Column:
    """Number of lower-case a, e, i, o, u."""
    return F.regexp_count(text, F.lit("[aeiou]"))


def is_palindrome(text: Column) -> Column:
    return text == F.reverse(text)


def zip_to_map(keys: Column, values: Column) -> Column:
    """Map of the pairs by position, up to the shorter array; of equal keys the last one stays."""
    shared = F.least(F.size(keys), F.size(values))
    cut = F.slice(keys, F.lit(1), shared)
    # Sorted by key and place, the last place of a key stands before another key: no scan per element.
    placed = F.array_sort(F.transform(cut, lambda k, i: F.struct(k.alias("key"), i.alias("i"))))
    last = F.zip_with(placed, F.slice(placed, F.lit(2), shared), lambda a, b: F.when(b.isNull() | ~a["key"].eqNullSafe(b["key"]), a))
    places = F.array_sort(F.transform(F.filter(last, lambda e: e.isNotNull()), lambda e: e["i"]))
    pairs = F.transform(places, lambda i: F.struct(F.get(keys, i).alias("key"), F.get(values, i).alias("value")))
    return F.when(shared > 0, F.map_from_entries(pairs)).otherwise(
        F.map_from_arrays(F.slice(keys, F.lit(1), F.lit(0)), F.slice(values, F.lit(1), F.lit(0)))
    )


def entries_by_key(mapping: Column) -> Column:
    """Entries of a map in ascending key order."""
    return F.array_sort(F.map_entries(mapping))


def field_of_each(items: Column, field: str) -> Column:
    return F.transform(items, lambda item: item[field])


def flatten_levels(nested: Column, levels: int = 1) -> Column:
    """Remove `levels` levels of array nesting."""
    for _ in range(levels):
        nested = F.flatten(nested)
    return nested


def root_to_node(path: Column) -> Column:
    return F.reverse(path)


def parse_time(text: Column, fmt: str) -> Column:
    """Timestamp, or null when the text does not fit the format."""
    return F.try_to_timestamp(text, F.lit(fmt))


def reformat_time(text: Column, source: str, target: str) -> Column:
    return F.date_format(parse_time(text, source), target)


def clean_message(text: Column, max_length: int | None = 2000) -> Column:
    """Log message, cut at `max_length` characters (None: not at all), then freed of quotes."""
    kept = text if max_length is None else F.left(text, F.lit(max_length))
    return F.translate(kept, "\"'", "")


def exact_cast(value: Column, kind: str) -> Column:
    """`value` as `kind`; a value that does not fit raises, whatever the session's ANSI setting."""
    cast = value.try_cast(kind)
    wrong = F.raise_error(F.concat(F.lit(f"not a {kind}: "), value.cast("string"))).cast(kind)
    return F.when(value.isNotNull() & cast.isNull(), wrong).otherwise(cast)
