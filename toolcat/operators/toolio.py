"""Input and output ports from a tool's nested description. Tables are ``tool_id, io_json``."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolcat.functions.text import or_default
from toolcat.schemas import A, S, struct

_PORT = T.StructType([T.StructField("place", T.ArrayType(T.IntegerType())), *struct(name=S, type=S, extensions=A, collection_types=A).fields])


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def _texts(value) -> list | None:
    return [_text(v) for v in value] if isinstance(value, list) else None


def ports_of(description: str | None) -> list[dict]:
    """The data ports of one description in document order. What is still to be visited lies on a stack, each list with
    the path of positions that leads to it."""
    try:
        doc = json.loads(description or "null")
    except (ValueError, RecursionError):
        return []
    found, stack = [], [((), doc["inputs"])] if isinstance(doc, dict) and isinstance(doc.get("inputs"), list) else []
    while stack:
        at, items = stack.pop()
        if isinstance(items, dict):  # one item
            items, entries = None, [(at, items)]
        else:
            entries = [((*at, i), item) for i, item in enumerate(items)] if isinstance(items, list) else []
        for k, (place, item) in enumerate(entries):
            if not isinstance(item, dict):
                continue
            kind, below = item.get("type"), []
            if kind in ("data", "data_collection"):
                found.append({"place": list(place), "name": _text(item.get("name")), "type": kind, "extensions": _texts(item.get("extensions")), "collection_types": _texts(item.get("collection_types"))})
            elif kind == "section":
                below = [(place, item.get("inputs"))]
            elif kind == "conditional" and isinstance(item.get("cases"), list):
                below = [((*place, i), case.get("inputs")) for i, case in enumerate(item["cases"]) if isinstance(case, dict)]
            if below:  # first what lies below, then the rest of this list
                stack += [(p, x) for p, x in reversed(entries[k + 1 :])]
                stack += [(p, x) for p, x in reversed(below) if isinstance(x, list)]
                break
    return found


@F.pandas_udf(T.ArrayType(_PORT))
def _ports(descriptions: pd.Series) -> pd.Series:
    return descriptions.map(ports_of)


def data_inputs(io: DataFrame) -> DataFrame:
    """Data ports at any level, in document order; cases of conditionals and sections are entered, repeats are
    not. ``place`` is the port's path of positions. Each description is parsed once; one that is no JSON has no ports."""
    rows = io.select("tool_id", F.explode(_ports("io_json")).alias("p"))
    return rows.select("tool_id", "p.*")


def outputs(io: DataFrame) -> DataFrame:
    """Output ports in order; ``hidden`` is false by default."""
    kind = "array<struct<name:string,output_type:string,format:string,label:string,hidden:boolean>>"
    rows = io.select("tool_id", F.posexplode(F.from_json(F.get_json_object("io_json", "$.outputs"), kind)).alias("pos", "o"))
    return rows.select("tool_id", "pos", "o.name", F.col("o.output_type").alias("type"), "o.format", "o.label", or_default(F.col("o.hidden"), False).alias("hidden"))
