"""Descriptions of the stage responses: one nested description per record gives the parsing schema, the permitted keys of
every level and the permitted ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings.functions.scores import SCORE_DIMENSIONS, SCORE_MAXIMA

# Fields of the records. A dict is an object, a one-element list an array, a string a type, (0, n) an integer range.
FACT = {"fact_id": "string", "text": "string", "url": "string"}
SCORES = {d: (0, SCORE_MAXIMA[d]) for d in SCORE_DIMENSIONS}
FACTS = {"cluster_id": "string", "facts": [FACT], "rejected": [{"fact_id": "string", "item_id": "string", "reason": "string"}]}
SELECTION = {"cluster_id": "string", "picked": [{**FACT, "scores": SCORES, "strategic_flag": "boolean", "rationale": "string"}],
             "dropped": [{"fact_id": "string", "reason": "string"}], "notes": "string"}
DRAFT = {"topic_id": "string", "headline": "string", "bullets": [{"text": "string", "url": "string", "fact_ids": ["string"]}],
         "annotations": "map<string,boolean>", "notes": "string"}


def ddl(kind) -> str:
    """Schema text of a description."""
    if isinstance(kind, dict):
        return "struct<" + ",".join(f"{k}:{ddl(v)}" for k, v in kind.items()) + ">"
    if isinstance(kind, list):
        return f"array<{ddl(kind[0])}>"
    return "int" if isinstance(kind, tuple) else kind


def columns(record: dict) -> str:
    """Schema text of a record's fields."""
    return ", ".join(f"{k} {ddl(v)}" for k, v in record.items())


def known_keys(json: Column, kind) -> Column:
    """Whether an object (JSON text), and every object inside it, has no key that its description lacks. Values that
    are no object or no array where one is described have no keys: their type is checked by the schema."""
    if not isinstance(kind, dict):
        return F.lit(True)
    allowed = F.array(*[F.lit(k) for k in kind])
    ok = F.coalesce(F.size(F.array_except(F.json_object_keys(json), allowed)) == 0, F.lit(True))
    for name, inner in kind.items():
        part = F.get_json_object(json, f"$.{name}")
        if isinstance(inner, dict):
            ok = ok & known_keys(part, inner)
        elif isinstance(inner, list) and isinstance(inner[0], dict):
            each = F.coalesce(F.from_json(part, "array<string>"), F.array().cast("array<string>"))
            ok = ok & F.forall(each, _element(inner[0]))
    return ok


def _element(kind):
    return lambda e: F.coalesce(known_keys(e, kind), F.lit(True))


def within(value: Column, kind: tuple[int, int]) -> Column:
    """Whether an integer is there and in its range."""
    return F.coalesce(value.between(*kind), F.lit(False))
