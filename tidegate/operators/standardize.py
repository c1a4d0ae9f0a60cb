"""Column standardisation from a rule table.

A rule is `(column_name, function_name, function_params)`, the parameters as JSON text in which
single quotes are accepted. All rules of a dataset become one projection.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rule names and the parameters each one needs, in the order of application.
RULES: dict[str, tuple[str, ...]] = {
    "type_conversion": ("type",),
    "blank_conversion": (),
    "left_padding": ("padding_value", "length"),
    "right_padding": ("padding_value", "length"),
    "trim": (),
    "sub_string": ("start_index", "length"),
    "replace": ("to_replace", "value"),
    "zip_extractor": (),
    "date_conversion": ("src", "tgt"),
    "timezone_conversion": ("src_tz", "tgt_tz", "src_ts", "tgt_ts", "utc_format_conversion_flag"),
}
CASES = ("Upper", "Lower")
NUMBERS, NUMBER = ("length", "start_index"), "-?[0-9]{1,9}"


class RejectedRules(ValueError):
    """Raised in strict mode when a rule cannot be used."""


def blank_to_null(c: Column) -> Column:
    """Empty or whitespace-only text to null (a choice)."""
    return F.when(c.rlike("[^ \\t\\r\\n]"), c)


def zip_code(c: Column) -> Column:
    """The first five digits of the first run of at least five digits, else null (a choice)."""
    found = F.regexp_extract(c, "([0-9]{5})[0-9]*", 1)
    return F.when(found != "", found)


def convert_date(c: Column, source: str, target: str) -> Column:
    """Reprint a date; text that does not fit `source` becomes null."""
    return F.date_format(F.try_to_timestamp(c, F.lit(source)), target)


def convert_zone(c: Column, source_zone: str, target_zone: str, source: str, target: str) -> Column:
    """Read local time of `source_zone`, print local time of `target_zone`.

    Both zones are named by the rule, so its `utc_format_conversion_flag`, which must be given, changes nothing (a choice).
    """
    # Parsed without the session's zone, in which some local times do not exist.
    wall = F.try_to_timestamp(F.concat(c, F.lit(" +00:00")), F.lit(f"{source} XXX"))
    seconds = (F.unix_micros(wall) / 1_000_000).cast("decimal(18,6)")
    local = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)
    return F.date_format(F.convert_timezone(F.lit(source_zone), F.lit(target_zone), local), target)


def _apply(c: Column, function: str, p: Mapping) -> Column:
    match function:
        case "type_conversion":
            return F.upper(c) if p["type"] == "Upper" else F.lower(c)
        case "blank_conversion":
            return blank_to_null(c)
        case "left_padding":
            return F.lpad(c, int(p["length"]), str(p["padding_value"]))
        case "right_padding":
            return F.rpad(c, int(p["length"]), str(p["padding_value"]))
        case "trim":
            return F.trim(c)
        case "sub_string":
            return F.substring(c, int(p["start_index"]), int(p["length"]))
        case "replace":
            return F.replace(c, F.lit(str(p["to_replace"])), F.lit(str(p["value"])))
        case "zip_extractor":
            return zip_code(c)
        case "date_conversion":
            return convert_date(c, p["src"], p["tgt"])
        case "timezone_conversion":
            return convert_zone(c, p["src_tz"], p["tgt_tz"], p["src_ts"], p["tgt_ts"])
    raise RejectedRules(function)


def _parameters(rule: Mapping) -> dict | None:
    """Parsed parameters, or None when the rule must be rejected."""
    needed = RULES.get(rule["function_name"])
    if needed is None:
        return None
    if not needed:
        return {}
    try:
        params = json.loads((rule.get("function_params") or "").replace("'", '"'))
    except json.JSONDecodeError:
        return None
    if not isinstance(params, dict) or any(name not in params for name in needed):
        return None
    if rule["function_name"] == "type_conversion" and params["type"] not in CASES:
        return None
    if any(not re.fullmatch(NUMBER, str(params[name])) for name in needed if name in NUMBERS):
        return None
    return params


def _rank(rule: Mapping, params: Mapping) -> tuple[int, bool]:
    """Upper comes before lower within type conversion."""
    return list(RULES).index(rule["function_name"]), params.get("type") == "Lower"


def standardize(df: DataFrame, rules: Sequence[Mapping], strict: bool = False) -> DataFrame:
    """Apply all usable rules in one projection; without rules the frame is unchanged.

    `strict` raises on a rejected rule, otherwise it is skipped. Several time zone rules of one
    column apply in the order given.
    """
    usable = []
    for rule in rules:
        params = _parameters(rule)
        if params is not None:
            usable.append((rule, params))
        elif strict:
            raise RejectedRules(f"unusable rule: {dict(rule)}")
    usable.sort(key=lambda item: _rank(*item))
    columns = {c: F.col(c) for c in df.columns}
    for rule, params in usable:
        name = rule["column_name"]
        columns[name] = _apply(columns[name], rule["function_name"], params)
    return df.select(*[expression.alias(name) for name, expression in columns.items()])


def rejected_rules(rules: DataFrame) -> DataFrame:
    """The rules of a rule table that cannot be used, with the same conditions as `standardize`."""
    text = F.replace("function_params", F.lit("'"), F.lit('"'))
    parsed = F.from_json(text, "map<string,string>", {"mode": "PERMISSIVE"})
    needs = F.create_map(*[x for name, keys in RULES.items() for x in (F.lit(name), F.array(*map(F.lit, keys)).cast("array<string>"))])
    with_needs = rules.withColumn("__needs", F.try_element_at(needs, F.col("function_name"))).withColumn("__p", parsed)
    unknown = F.col("__needs").isNull()
    incomplete = (F.size("__needs") > 0) & (
        F.col("__p").isNull() | ~F.forall("__needs", lambda k: F.coalesce(F.map_contains_key(F.col("__p"), k), F.lit(False)))
    )
    bad_case = (F.col("function_name") == "type_conversion") & ~F.coalesce(
        F.try_element_at(F.col("__p"), F.lit("type")).isin(*CASES), F.lit(False)
    )
    no_number = (F.size("__needs") > 0) & F.exists(
        F.array_intersect("__needs", F.array(*map(F.lit, NUMBERS))),
        lambda k: ~F.coalesce(F.try_element_at(F.col("__p"), k).rlike(f"^(?:{NUMBER})$"), F.lit(False)),
    )
    return with_needs.filter(unknown | incomplete | bad_case | no_number).drop("__needs", "__p")
