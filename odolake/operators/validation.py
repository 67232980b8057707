"""Validation of raw JSON events, compiled from a rule table into one projection.

``inspect`` turns raw text into typed columns plus ``reason``; the first failed check, in
rule order, names the reason, and a valid event has none. Batch and streaming frames
take the same path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolake import schemas as S
from odolake.functions.numeric import number_text
from odolake.functions.timing import parse_iso, seconds

OVERSIZE = "payload_too_large"

# fixed values: the characters that count as blank around an id, a time or a number
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_DIGITS = r"\d+(_\d+)*"
_NUMBER_TEXT = rf"(?i)^[+-]?(({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})(e[+-]?{_DIGITS})?|inf|infinity|nan)\z"
_KIND_LABEL = {"string": "str", "boolean": "bool", "double": "float"}


def computed_once(df: DataFrame, *columns: Column) -> DataFrame:
    """Add ``columns`` behind a one-row generator.

    Catalyst would otherwise paste each expression into every place that uses it, through
    all the steps of the check, and push whole chains below filters; a generator's output
    is computed once per row and nothing is inlined through it.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def json_type(text: Column) -> Column:
    """Short type name used in reasons (int, str, list, ...) for a value's JSON text."""
    first = F.substring(text, 1, 1)
    return (
        F.when(first == '"', "str")
        .when(first.isin("t", "f"), "bool")
        .when(first == "[", "list")
        .when(first == "{", "dict")
        .when(text.rlike("[.eE]"), "float")
        .otherwise("int")
    )


_MARK = "\0"  # where the failing number goes in a reason

# what JSON itself allows, and no more
_STRICT = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false"}


def _field(name: str) -> Column:
    return F.col(f"_d_{name}")


def _string(name: str) -> Column:
    return F.try_variant_get(_field(name), "$", "string")


def _typed(rule: S.FieldRule) -> Column:
    """The field's value in its expected type, NULL where it has none."""
    kind = F.col(f"_k_{rule.name}")
    if rule.kind == "string":
        return F.when(kind == "STRING", F.btrim(_string(rule.name), F.lit(BLANKS)))
    if rule.kind == "boolean":
        return F.when(kind == "BOOLEAN", F.try_variant_get(_field(rule.name), "$", "boolean"))
    bare = F.btrim(_string(rule.name), F.lit(BLANKS))
    number = F.when(bare.rlike(_NUMBER_TEXT), F.nullif(
        F.replace(bare, F.lit("_"), F.lit("")).try_cast("double"), F.lit(float("nan"))))
    return (
        F.when(kind == "STRING", number)
        .when(kind == "BOOLEAN", F.try_variant_get(_field(rule.name), "$", "boolean").cast("double"))
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.lit(None).cast("double"))
        .otherwise(F.try_variant_get(_field(rule.name), "$", "double"))
    )


def _field_reason(rule: S.FieldRule) -> Column:
    kind, value = F.col(f"_k_{rule.name}"), F.col(f"_v_{rule.name}")
    absent = kind.isNull() | (kind == "VOID")
    checks = []
    if rule.required:
        checks.append(F.when(absent, f"missing_field:{rule.name}"))
    label = _KIND_LABEL[rule.kind]
    if rule.kind == "double":
        untyped = F.lit(f"invalid_type:{rule.name}:cannot_coerce_to_{label}")
    else:
        untyped = F.concat(
            F.lit(f"invalid_type:{rule.name}:expected_{label}:got_"), json_type(F.to_json(_field(rule.name))))
    checks.append(F.when(~absent & value.isNull(), untyped))
    if rule.low is not None:
        checks.append(F.when(value < F.lit(rule.low), f"out_of_range:{rule.name}:{_MARK}<min({rule.low})"))
    if rule.high is not None:
        checks.append(F.when(value > F.lit(rule.high), f"out_of_range:{rule.name}:{_MARK}>max({rule.high})"))
    return F.coalesce(*checks)


def inspect(
    events: DataFrame,
    raw: str = "raw_payload",
    now: str | Column = "received_at",
    rules: Sequence[S.FieldRule] = S.TELEMETRY_RULES,
    key: str = "vehicle_id",
    time_field: str = "event_timestamp",
    max_bytes: int = S.MAX_PAYLOAD_BYTES,
    max_future_seconds: float = S.MAX_FUTURE_SECONDS,
    key_pattern: str = S.VEHICLE_ID_PATTERN,
    key_hint: str = S.VEHICLE_ID_FORMAT_HINT,
) -> DataFrame:
    """Add the typed fields, ``limiter_key`` and the two reasons to ``events``.

    ``entry_reason`` holds the checks made before rate limiting (size, empty body, JSON,
    key present); ``reason`` is the first failure of all. The limiter key is the id as
    sent, before trimming, and is NULL where an event never reaches the limiter.
    """
    now_col = F.col(now) if isinstance(now, str) else now
    body = F.col(raw)
    kept = [F.col(c) for c in events.columns]

    size = F.octet_length(body)
    # the parser never sees a text that is refused for its size; the document keeps its
    # fields as variants, from which type and value are read without another parse
    small = F.when((size > 0) & (size <= max_bytes), body)
    document = F.from_json(small, ", ".join(f"`{r.name}` variant" for r in rules), _STRICT)
    parsed = events.select("*", F.inline(F.array(document)).alias(*[f"_d_{r.name}" for r in rules]))
    kinds = computed_once(parsed, F.try_parse_json(small).isNotNull().alias("_valid"), *[F.schema_of_variant(_field(r.name)).alias(f"_k_{r.name}") for r in rules])
    values = computed_once(
        kinds, *[_typed(r).alias(f"_v_{r.name}") for r in rules],
        F.when(F.col(f"_k_{key}") == "STRING", _string(key)).alias("_sent"),
    )
    values = computed_once(values, parse_iso(F.col(f"_v_{time_field}")).alias("_when"))

    sent_key = F.col("_sent")
    entry = F.coalesce(
        F.when(size > max_bytes, OVERSIZE),
        F.when(body.isNull() | (size == 0), "empty_body"),
        F.when(~F.col("_valid"), "invalid_json"),
        F.when(~body.rlike(r"^\s*\{"), "invalid_format:payload_must_be_json_object"),
        F.when(sent_key.isNull() | (sent_key == ""), f"missing_field:{key}"),
    )
    stamp, ident = F.col(f"_v_{time_field}"), F.col(f"_v_{key}")
    after = [_field_reason(r) for r in rules] + [
        F.when(F.col("_when").isNull() & stamp.isNotNull(),
               F.concat(F.lit(f"invalid_timestamp:{time_field}:not_iso8601:"), stamp)),
        F.when(F.col("_when") > now_col + seconds(max_future_seconds),
               F.lit(f"invalid_timestamp:{time_field}:more_than_{max_future_seconds:g}s_in_future")),
        F.when(~ident.rlike(key_pattern),
               F.concat(F.lit(f"invalid_{key}:"), ident, F.lit(f":must_match_{key_hint}"))),
    ]
    flagged = computed_once(values, entry.alias("entry_reason"))
    flagged = computed_once(flagged, F.coalesce(F.col("entry_reason"), *after).alias("_why"))
    failing = F.coalesce(*[
        F.when(F.col("_why").startswith(f"out_of_range:{r.name}:"), F.col(f"_v_{r.name}"))
        for r in rules if r.kind == "double"])
    ranged = F.contains(F.col("_why"), F.lit(_MARK))
    flagged = computed_once(flagged, F.when(ranged, failing).alias("_number"))
    reason = F.when(ranged, F.replace(F.col("_why"), F.lit(_MARK), number_text(F.col("_number")))).otherwise(F.col("_why"))
    fields = [
        (F.col("_when") if r.name == time_field else F.col(f"_v_{r.name}")).alias(r.name) for r in rules
    ]
    return flagged.select(
        *kept, *fields, "entry_reason",
        F.when(F.col("entry_reason").isNull(), sent_key).alias("limiter_key"),
        reason.alias("reason"),
    )


def range_failure(rules: Sequence[S.FieldRule] = S.NUMERIC_RULES) -> Column:
    """Name of the first null or out-of-range field of an already typed row, else NULL.

    All null checks come before the range checks; a NaN is outside every range.
    """
    nulls = [F.when(F.col(r.name).isNull(), F.lit(f"null_field:{r.name}")) for r in rules]
    ranges = [
        F.when(~F.col(r.name).between(r.low, r.high), F.lit(f"out_of_range:{r.name}")) for r in rules
    ]
    return F.coalesce(*nulls, *ranges)


def reason_class(reason: Column) -> Column:
    """The part of a reason before its details: category and field."""
    parts = F.split(reason, ":")
    detailed = parts[0].isin("missing_field", "invalid_type", "out_of_range", "invalid_timestamp")
    return F.when(detailed, F.concat_ws(":", parts[0], F.get(parts, F.lit(1)))).otherwise(parts[0])
