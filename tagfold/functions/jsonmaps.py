"""Portrait JSON text <-> long form.

Text form of a flat tag map:   {"tag":{"weight":1.0,"dateTime":"1563377094476"},...}
Text form of a nested tag map: {"module":{"tag":{"weight":..,"dateTime":".."},..},..}
Text form of a score map:      {"code":0.5,...}

Packing builds the text with string functions over entries sorted by an
explicit key, so the entry order is part of the plan (map order after a
shuffle is never relied on). Unpacking uses ``from_json`` (bad text -> no
entries).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAG_VALUE = "struct<weight:double,dateTime:string>"
FLAT_MAP = f"map<string,{TAG_VALUE}>"
NESTED_MAP = f"map<string,map<string,{TAG_VALUE}>>"
SCORE_MAP = "map<string,double>"


def json_string(s: Column) -> Column:
    """A JSON string literal for ``s``; quotes, backslashes and control
    characters are escaped by ``to_json``, so the text holds no line break."""
    one = F.to_json(F.array(s))
    return F.when(s.isNotNull(), F.substr(one, F.lit(2), F.length(one) - 2))


def tag_entry(tag: Column, weight: Column, last_ms: Column) -> Column:
    """``"tag":{"weight":w,"dateTime":"ms"}``; weights are 4-decimal values
    (rounded here so that the text does not depend on summation order)."""
    return F.concat(json_string(tag), F.lit(':{"weight":'), F.round(weight, 4).cast("string"),
                    F.lit(',"dateTime":"'), F.coalesce(last_ms.cast("string"), F.lit("")), F.lit('"}'))


def score_entry(key: Column, score: Column) -> Column:
    """``"key":score`` with the score rounded to 4 decimals."""
    return F.concat(json_string(key), F.lit(":"), F.round(score, 4).cast("string"))


def object_of(sorted_entries: Column) -> Column:
    """``{e1,e2,...}`` from an array of structs sorted by their leading
    fields whose last field ``e`` is the entry text."""
    return F.concat(F.lit("{"), F.array_join(F.transform(sorted_entries, lambda x: x["e"]), ","), F.lit("}"))


def flat_tags(text: Column) -> Column:
    """Flat tag map text -> map (null/bad/empty text -> empty map)."""
    m = F.from_json(text, FLAT_MAP)
    return F.coalesce(m, F.create_map().cast(FLAT_MAP))


def nested_tags(text: Column) -> Column:
    """Nested tag map text -> map; empty inner maps dropped."""
    m = F.coalesce(F.from_json(text, NESTED_MAP), F.create_map().cast(NESTED_MAP))
    return F.map_filter(m, lambda k, v: F.size(v) > 0)
