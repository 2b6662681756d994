"""JSON contracts compiled to one errors column.

A contract is JSON Schema (a subset: required, closed objects, type, lengths, bounds,
pattern, enum, nested objects, a schema for additional properties). It is compiled on
the driver, once, to native expressions over a VARIANT parsed from the raw line, so
that absent, explicit null and wrongly typed fields stay apart.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The three contracts.
PAIR = {
    "type": "object",
    "required": ["instruction", "response", "score", "domain"],
    "properties": {
        "instruction": {"type": "string", "minLength": 10},
        "response": {"type": "string", "minLength": 50},
        "score": {"type": "number", "minimum": 0.0, "maximum": 1.0},
        "domain": {"type": "string", "minLength": 1},
        "metadata": {"type": "object"},
    },
    "additionalProperties": False,
}
_SPLIT = {
    "type": "object",
    "required": ["path", "count", "sha256"],
    "properties": {
        "path": {"type": "string"},
        "count": {"type": "integer", "minimum": 1},
        "sha256": {"type": "string", "pattern": "^[a-f0-9]{64}$"},
    },
}
VERTICALS = ["signal", "aviation", "core"]
MANIFEST = {
    "type": "object",
    "required": ["name", "version", "vertical", "pair_count", "splits"],
    "properties": {
        "name": {"type": "string"},
        "version": {"type": "string", "pattern": "^v[0-9]+$"},
        "vertical": {"type": "string", "enum": VERTICALS},
        "pair_count": {"type": "integer", "minimum": 1},
        "splits": {"type": "object", "required": ["train"], "properties": {"train": _SPLIT, "eval": _SPLIT}, "additionalProperties": False},
        "format_distribution": {"type": "object", "additionalProperties": {"type": "number", "minimum": 0, "maximum": 1}},
        "created_at": {"type": "string"},
        "metadata": {"type": "object"},
    },
    "additionalProperties": False,
}
EVAL_METRICS = ["accuracy", "completeness", "structure", "relevance", "sft_quality", "json_valid", "domain_accuracy", "loss"]
EVAL = {
    "type": "object",
    "required": ["run_id", "model", "metric", "score"],
    "properties": {
        "run_id": {"type": "string"},
        "model": {"type": "string"},
        "metric": {"type": "string", "enum": EVAL_METRICS},
        "score": {"type": "number"},
        "samples": {"type": "integer", "minimum": 1},
        "vertical": {"type": "string", "enum": VERTICALS},
        "timestamp": {"type": "string"},
        "metadata": {"type": "object"},
    },
    "additionalProperties": False,
}
MIN_LENGTH, MAX_LENGTH, MIN_SCORE = 200, 32000, 0.7
# End of fixed values.

#: What the schema's types may be in a VARIANT. A boolean counts as a number.
_TYPES = {
    "string": "^STRING$",
    "number": "^(BOOLEAN|BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "integer": r"^(BOOLEAN|BIGINT|INT|SMALLINT|TINYINT|DECIMAL\(\d+,0\))$",
    "object": "^OBJECT",
}


@dataclass(frozen=True)
class _Field:
    """A field somewhere in the document: its value, and how errors name it."""

    value: Column
    name: str

    def child(self, key: str) -> _Field:
        path = f"{self.name}.{key}" if self.name else key
        return _Field(F.try_variant_get(self.value, f"$['{key}']", "variant"), path)


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _said(name: str, what: str, *values: Column) -> Column:
    return F.format_string(f"Field '{name}': {what}".replace("%", "%%").replace("{}", "%s"), *values)


def _object_errors(at: _Field, spec: Mapping) -> list[Column]:
    """Arrays of errors of one object's fields."""
    keys = F.coalesce(F.json_object_keys(F.to_json(at.value)), F.array().cast("array<string>"))
    prefix = f"{at.name}." if at.name else ""
    wanted = F.array(*map(F.lit, spec.get("required", []))).cast("array<string>")
    out = [F.transform(F.array_except(wanted, keys), lambda k: F.concat(F.lit(f"Missing required field: {prefix}"), k))]
    known = spec.get("properties", {})
    extra = F.array_except(keys, F.array(*map(F.lit, known)).cast("array<string>"))
    if spec.get("additionalProperties") is False:
        out.append(F.transform(extra, lambda k: F.concat(F.lit(f"Unexpected field: {prefix}"), k)))
    elif isinstance(spec.get("additionalProperties"), Mapping):
        out.append(_map_errors(at, spec["additionalProperties"]))
    for key, inner in known.items():
        out += _field_errors(at.child(key), inner)
    return out


def _map_errors(at: _Field, spec: Mapping) -> Column:
    """Numbers under free keys, within bounds."""
    values = F.from_json(F.to_json(at.value), "map<string,string>")
    low, high = spec.get("minimum", float("-inf")), spec.get("maximum", float("inf"))
    number = lambda v: F.try_cast(v, "double") if hasattr(F, "try_cast") else v.try_cast("double")
    bad = F.map_filter(values, lambda k, v: number(v).isNull() | (number(v) < low) | (number(v) > high))
    keys = F.transform(F.map_keys(bad), lambda k: F.concat(F.lit(f"Field '{at.name}."), k, F.lit("': out of bounds")))
    return F.coalesce(keys, F.array().cast("array<string>"))


def _field_errors(at: _Field, spec: Mapping) -> list[Column]:
    kind, expected = _kind(at.value), spec.get("type")
    present = at.value.isNotNull()
    fits = kind.rlike(_TYPES[expected]) if expected else F.lit(True)
    rules = [(~fits, _said(at.name, f"expected {expected}", ))] if expected else []
    text = F.try_variant_get(at.value, "$", "string")
    size = F.length(text)
    # NaN compares as false in the contract; a boolean counts as 0 or 1.
    number = F.when(kind == "BOOLEAN", F.try_variant_get(at.value, "$", "boolean").cast("double")).otherwise(F.try_variant_get(at.value, "$", "double"))
    number = F.when(~F.isnan(number), number)
    checks = {
        "minLength": lambda n: (size < n, _said(at.name, f"length {{}} < minLength {n}", size.cast("string"))),
        "minimum": lambda n: (number < n, _said(at.name, f"below minimum {n}")),
        "maximum": lambda n: (number > n, _said(at.name, f"above maximum {n}")),
        "pattern": lambda p: (~text.rlike(p), _said(at.name, "does not match the pattern")),
        "enum": lambda e: (~text.isin(*e), _said(at.name, "not one of the allowed values")),
    }
    rules += [(fits & bad, text) for key, make in checks.items() if key in spec for bad, text in [make(spec[key])]]
    out = [F.array_compact(F.array(*[F.when(present & bad, said) for bad, said in rules])).cast("array<string>")] if rules else []
    if expected == "object" and (spec.get("properties") or spec.get("additionalProperties") is not None):
        nested = F.flatten(F.array(*_object_errors(at, spec)))
        out.append(F.when(present & fits, nested).otherwise(F.array().cast("array<string>")))
    return out


def errors(line: Column, contract: Mapping) -> Column:
    """All errors of a JSON line against a contract; empty if it is valid. A line
    that isn't a JSON object has the one error ``malformed``."""
    value = F.try_parse_json(line)
    found = F.flatten(F.array(*_object_errors(_Field(value, ""), contract)))
    whole = F.coalesce(_kind(value).rlike(_TYPES["object"]), F.lit(False))
    return F.when(whole, F.array_sort(found)).otherwise(F.array(F.lit("malformed")))


def validated(lines: DataFrame, line: str, contract: Mapping = PAIR, on_malformed: str = "quarantine") -> DataFrame:
    """``lines`` with ``errors``; ``on_malformed='fail'`` raises at run time instead."""
    out = lines.withColumn("errors", errors(F.col(line), contract))
    if on_malformed == "fail":
        stop = F.when(F.array_contains("errors", "malformed"), F.raise_error(F.lit("malformed JSON line")).cast("array<string>"))
        out = out.withColumn("errors", F.coalesce(stop, "errors"))
    return out


def missing_inputs(required: Column, given: Column) -> Column:
    return F.array_except(required, given)


def good_pair(instruction: Column, response: Column, score: Column, errors_: Column) -> Column:
    """Valid by contract, both texts together 200 to 32000 characters, score 0.7 up."""
    total = F.length(instruction) + F.length(response)
    return (F.size(errors_) == 0) & total.between(MIN_LENGTH, MAX_LENGTH) & (F.isnan(score) | (score >= MIN_SCORE))


def load(text: str) -> dict:
    return json.loads(text)
