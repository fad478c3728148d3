"""Message contracts: what a topic's JSON object must look like, checked in one projection."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """One property of a message. `kind` is string, integer, number or integers (an array)."""

    name: str
    kind: str
    spark: T.DataType
    required: bool = False
    nullable: bool = False
    low: float | None = None
    high: float | None = None
    shortest: int | None = None
    longest: int | None = None


@dataclass(frozen=True)
class Contract:
    """A closed object: properties that are not listed are errors."""

    topic: str
    rules: tuple[Rule, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(r.name, r.spark) for r in self.rules])


_S, _I, _F, _D = T.StringType(), T.IntegerType(), T.FloatType(), T.DoubleType()


def _text(name, required=False, nullable=False, shortest=None, longest=None):
    return Rule(name, "string", _S, required, nullable, shortest=shortest, longest=longest)


def _number(name, required=False, nullable=False, low=None, high=None, spark=_F):
    return Rule(name, "number", spark, required, nullable, low, high)


def _whole(name, required=False, nullable=False, low=None, high=None):
    return Rule(name, "integer", _I, required, nullable, low, high)


# The six message contracts.
SENSORS = Contract("sensors", (
    _text("timestamp", required=True),
    _text("sensor_id", required=True, shortest=1, longest=64),
    _whole("sensor_index", nullable=True, low=0),
    _number("speed", required=True, low=0, high=150),
    _number("ingested_at", low=0, spark=_D),
))
GPS = Contract("gps", (
    _text("pickup_time", required=True, shortest=1),
    _text("dropoff_time", required=True, shortest=1),
    _whole("pickup_zone", required=True, low=0),
    _whole("dropoff_zone", required=True, low=0),
    _number("distance_miles", required=True, low=0, high=500),
    _number("ingested_at", low=0, spark=_D),
))
CCTV_RAW = Contract("cctv_raw", (
    _text("camera_id", required=True, shortest=1, longest=128),
    _text("frame_id", required=True, shortest=1, longest=256),
    _number("timestamp", required=True, low=0, spark=_D),
    _text("frame_b64", required=True, shortest=1),
    _number("ingested_at", low=0, spark=_D),
    _text("producer_id", longest=64),
))
CCTV_INFERRED = Contract("cctv_inferred", (
    _text("camera_id", required=True, shortest=1, longest=128),
    _text("frame_id", required=True, shortest=1, longest=256),
    _number("timestamp", required=True, low=0, spark=_D),
    _whole("unique_count_5min", required=True, low=0),
    _whole("unique_count_session", required=True, low=0),
    Rule("track_ids", "integers", T.ArrayType(_I), required=True, low=0),
    _text("frame_url", required=True, shortest=1),
    _number("inference_ms", required=True, low=0),
    _text("model_version", required=True, shortest=1, longest=64),
    _text("worker_id", longest=64),
    _number("processed_at", low=0, spark=_D),
))
WEATHER = Contract("weather", (
    _text("city", required=True, shortest=1),
    _text("country", nullable=True),
    _text("observed_at", required=True, shortest=1),
    _number("temp_c", nullable=True),
    _number("feels_like_c", nullable=True),
    _number("temp_min_c", nullable=True),
    _number("temp_max_c", nullable=True),
    _whole("humidity", nullable=True, low=0, high=100),
    _whole("pressure_hpa", nullable=True, low=0),
    _number("wind_speed_mps", nullable=True, low=0),
    _whole("wind_deg", nullable=True, low=0, high=360),
    _whole("clouds_pct", nullable=True, low=0, high=100),
    _text("weather_main", nullable=True),
    _text("weather_description", nullable=True),
    _whole("weather_id", nullable=True),
    _number("timestamp", required=True, low=0, spark=_D),
    _number("ingested_at", low=0, spark=_D),
))
PREDICTIONS = Contract("speed_predictions", (
    _text("sensor_id", required=True, shortest=1, longest=64),
    _text("timestamp", required=True, shortest=1),
    _number("actual_speed", nullable=True),
    _number("predicted_speed", required=True),
    _whole("horizon_minutes", nullable=True, low=0),
    _text("model_version", required=True, shortest=1, longest=64),
    _number("inference_us", nullable=True, low=0),
    _number("processed_at", low=0, spark=_D),
))
CONTRACTS = {c.topic: c for c in (SENSORS, GPS, CCTV_RAW, CCTV_INFERRED, WEATHER, PREDICTIONS)}

_NUMERIC_ARRAY = r"^ARRAY<(VOID|BIGINT|DOUBLE|DECIMAL.*)>$"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it.

    Columns made by projections in a row are put in the place of their names when a filter on the last one is moved below
    them, and are then computed anew for each mention; the argument of a lambda is not.
    """
    return F.transform(F.array(value), use)[0]


def _facts(rule: Rule, body: Column) -> dict[str, Column]:
    """What the checks of a rule look at: the JSON type, and the number, length or items."""
    path = f"$.{rule.name}"
    facts = {f"kind_{rule.name}": F.schema_of_variant(F.variant_get(body, path, "variant"))}
    if rule.kind == "string":
        if rule.shortest is not None or rule.longest is not None:
            facts[f"fact_{rule.name}"] = F.length(F.try_variant_get(body, path, "string"))
    else:
        facts[f"fact_{rule.name}"] = F.try_variant_get(body, path, "array<double>" if rule.kind == "integers" else "double")
    return facts


def _checks(rule: Rule, facts: Column) -> list[Column]:
    """One column per check of the rule: the error's name, or null when the check passes."""
    kind, fact = facts[f"kind_{rule.name}"], facts[f"fact_{rule.name}"]

    def failed(when: Column, what: str) -> Column:
        return F.when(when, F.lit(f"{rule.name}:{what}"))

    checks = []
    if rule.required:
        checks.append(failed(kind.isNull(), "required"))
    if rule.kind == "string":
        right = kind == "STRING"
        if rule.shortest is not None:
            checks.append(failed(right & (fact < rule.shortest), "too_short"))
        if rule.longest is not None:
            checks.append(failed(right & (fact > rule.longest), "too_long"))
    elif rule.kind == "integers":
        right = kind.rlike(_NUMERIC_ARRAY) & F.forall(fact, lambda x: x.isNotNull() & (x == F.floor(x)))
        if rule.low is not None:
            checks.append(failed(right & F.exists(fact, lambda x: x < rule.low), "below_minimum"))
    else:
        numeric = kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
        right = numeric & (fact == F.floor(fact)) if rule.kind == "integer" else numeric
        if rule.low is not None:
            checks.append(failed(numeric & (fact < rule.low), "below_minimum"))
        if rule.high is not None:
            checks.append(failed(numeric & (fact > rule.high), "above_maximum"))
    present = kind.isNotNull() & (kind != "VOID")
    wrong = present & ~F.coalesce(right, F.lit(False))
    if not rule.nullable:
        wrong = wrong | (kind == "VOID")
    return [failed(wrong, "type"), *checks]


def _errors(contract: Contract, facts: Column) -> Column:
    """The sorted names of the broken rules."""
    allowed = F.array(*[F.lit(r.name) for r in contract.rules])
    extra = F.transform(F.array_except(facts["keys"], allowed), lambda k: F.concat(k, F.lit(":not_allowed")))
    found = F.array_compact(F.array(*[c for r in contract.rules for c in _checks(r, facts)]))
    return (F.when(~facts["json"], F.array(F.lit("not_json")))
            .when(facts["keys"].isNull(), F.array(F.lit("not_object")))
            .otherwise(F.sort_array(F.concat(found, extra))))


def validate(df: DataFrame, contract: Contract, value: str | Column = "value", out: str = "errors") -> DataFrame:
    """Add the sorted names of the broken rules of each message; an empty list keeps the contract (V7).

    Parse once, take type and value of each property once, check; also where rows are then filtered by the result.
    """

    def facts(text: Column, body: Column) -> Column:
        # Only an object has keys, an empty list of them if need be.
        known = {"json": body.isNotNull(), "keys": F.json_object_keys(text)}
        for rule in contract.rules:
            known.update(_facts(rule, body))
        return F.struct(*[c.alias(n) for n, c in known.items()])

    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    errors = _once(text, lambda t: _once(F.try_parse_json(t), lambda body: _once(facts(t, body), lambda f: _errors(contract, f))))
    return df.withColumn(out, errors)


def broken(row: T.StructType, contract: Contract) -> Column:
    """Whether a row sent as a JSON object would break the contract: what `validate` finds in its text, without writing and parsing it.

    As in the text, null columns are not there, and numbers without a finite value are texts.
    """
    if not set(row.names) <= {r.name for r in contract.rules}:
        return F.lit(True)
    return F.coalesce(reduce(or_, [_breaks(r, row[r.name].dataType if r.name in row.names else None) for r in contract.rules]), F.lit(False))


def _breaks(rule: Rule, kind: T.DataType | None) -> Column:
    """Whether the rule's column, of a type that the row has, breaks it; null where it is not there and need not be."""
    missing = F.lit(rule.required)
    if kind is None:
        return missing
    value, wrong = F.col(rule.name), []
    if rule.kind == "string":
        fits = isinstance(kind, T.StringType)
        if fits and rule.shortest is not None:
            wrong.append(F.length(value) < rule.shortest)
        if fits and rule.longest is not None:
            wrong.append(F.length(value) > rule.longest)
    elif rule.kind == "integers":
        fits = isinstance(kind, T.ArrayType)
        if fits and isinstance(kind.elementType, T.NumericType):
            wrong.append(F.exists(value, lambda x: x.isNull() | _off(x, rule, kind.elementType, True)))
        elif fits:
            wrong.append(F.size(value) > 0)
    else:
        fits = isinstance(kind, T.NumericType)
        if fits:
            wrong.append(_off(value, rule, kind, rule.kind == "integer"))
    return F.when(value.isNull(), missing).otherwise(reduce(or_, wrong, F.lit(not fits)))


def _off(value: Column, rule: Rule, kind: T.DataType, whole: bool) -> Column:
    """Whether a number is none in JSON, not whole though it must be, or out of the rule's range."""
    wrong = [F.lit(False)]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        wrong.append(F.isnan(value) | (F.abs(value) == float("inf")))
    if whole:
        wrong.append(value != F.floor(value))
    if rule.low is not None:
        wrong.append(value < rule.low)
    if rule.high is not None:
        wrong.append(value > rule.high)
    return reduce(or_, wrong)
