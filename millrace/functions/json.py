"""JSON held in text columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_json(s: Column) -> Column:
    """1 for a well-formed object or array, 0 for anything else, NULL for NULL."""
    container = F.substring(F.ltrim(s), 1, 1).isin("{", "[")
    valid = container & F.try_parse_json(s).isNotNull()
    return F.when(s.isNotNull(), F.when(valid, 1).otherwise(0)).cast("bigint")


def strict_value(s: Column, path: str) -> Column:
    """Scalar by path; a missing path is an error rather than NULL."""
    value = F.get_json_object(s, path)
    message = F.concat(F.lit(f"no {path} in "), F.coalesce(s, F.lit("NULL")))
    return F.coalesce(value, F.raise_error(message).cast("string"))


def set_value(s: Column, path: str, value: Column) -> Column:
    """Set the member at a dotted path (``$.info.address.town``) of an object.

    The document is taken apart along the path only; other members keep their values
    (numbers are written in their shortest form, blanks between members go). Missing members of the path are added; a member of the path that is no object is
    replaced by one. A step may end in indexes (``$.b[0]``, ``$.rows[2][1].x``): an element
    that exists is replaced, one at the length of the array is appended, and a path through
    an element or array that is not there leaves the document as it is. A null value gives
    ``null``; a null document stays null, and what is no JSON object gives null.
    """
    steps: list[str | int] = []
    for part in path.removeprefix("$.").split("."):
        name, *indexes = re.split(r"\[(\d+)\]", part)
        if not name or "[" in name or any(indexes[1::2]):
            raise ValueError(f"not a member path: {path}")
        steps += [name, *map(int, indexes[::2])]
    return F.when(F.substring(F.ltrim(s), 1, 1) == "{", _put(s, steps, F.when(value.isNull(), "null").otherwise(_as_json(value))))


def _as_json(value: Column) -> Column:
    """The JSON text of one scalar."""
    return F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), 0)


def _members(s: Column) -> Column:
    """The members of an object as an array of (key, JSON text)."""
    raw, kinds = F.from_json(s, "map<string, string>"), F.from_json(s, "map<string, variant>")

    def read(both: Column) -> Column:
        def member(e: Column) -> Column:
            is_text = F.schema_of_variant(F.element_at(both["kinds"], e["key"])) == "STRING"
            text = F.when(is_text, _as_json(e["value"])).otherwise(F.coalesce(e["value"], F.lit("null")))
            return F.struct(e["key"].alias("key"), text.alias("value"))

        return F.transform(F.map_entries(both["raw"]), member)

    return _let(F.struct(raw.alias("raw"), kinds.alias("kinds")), read)


def _elements(s: Column) -> Column:
    """The elements of an array as JSON texts; null for what is no array."""
    raw, kinds = F.from_json(s, "array<string>"), F.from_json(s, "array<variant>")

    def read(both: Column) -> Column:
        def element(text: Column, kind: Column) -> Column:
            is_text = F.schema_of_variant(kind) == "STRING"
            return F.when(is_text, _as_json(text)).otherwise(F.coalesce(text, F.lit("null")))

        return F.zip_with(both["raw"], both["kinds"], element)

    return F.when(F.substring(F.ltrim(s), 1, 1) == "[", _let(F.struct(raw.alias("raw"), kinds.alias("kinds")), read))


def _put_element(s: Column, index: int, rest: list, value: Column) -> Column:
    """``s`` with the element replaced or appended; as it is where there is no such place."""

    def write(elements: Column) -> Column:
        own = F.get(elements, F.lit(index))
        new = _put(own, rest, value) if rest else value

        def place(text: Column) -> Column:
            replaced = F.transform(elements, lambda e, i: F.when(i == index, text).otherwise(e))
            done = F.when(own.isNotNull(), replaced)
            if not rest:
                done = done.when(F.size(elements) == index, F.concat(elements, F.array(text)))
            return F.coalesce(F.concat(F.lit("["), F.array_join(done, ","), F.lit("]")), s)

        return _let(F.coalesce(new, own) if rest else new, place)

    return _let(_elements(s), write)


def _put(s: Column, names: list[str | int], value: Column) -> Column:
    name, *rest = names
    if isinstance(name, int):
        return _put_element(s, name, rest, value)

    def write(members: Column) -> Column:
        own = F.get(F.filter(members, lambda e: e["key"] == name), 0)["value"]
        if rest and isinstance(rest[0], int):
            new = _put(own, rest, value)  # null without the member: nothing is changed
        elif rest:
            start = F.when(F.substring(own, 1, 1) == "{", own).otherwise("{}")
            new = _put(start, rest, value)
        else:
            new = value
        pair = lambda text: F.struct(F.lit(name).alias("key"), text.alias("value"))

        def place(text: Column) -> Column:
            kept = F.transform(members, lambda e: F.when(e["key"] == name, pair(text)).otherwise(e))
            added = F.when(own.isNull(), F.concat(members, F.array(pair(text)))).otherwise(kept)
            shown = F.transform(added, lambda e: F.concat(_as_json(e["key"]), F.lit(":"), e["value"]))
            return F.when(text.isNull(), s).otherwise(F.concat(F.lit("{"), F.array_join(shown, ","), F.lit("}")))

        return _let(new, place)

    return _let(_members(s), write)
