"""Record and request validation with error codes instead of exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.schema import CUSTOMER_SCHEMA, DEFAULT_SEGMENT, RANGE_RULES, SEGMENTS

_TYPES = {f.name: f.dataType for f in CUSTOMER_SCHEMA.fields}


def _field_error(name: str, lo, hi) -> Column:
    """missing / type / range for one text field, NULL if fine."""
    text, value = F.col(name), F.col(name).try_cast(_TYPES[name])
    return (
        F.when(text.isNull(), f"{name}:missing")
        .when(value.isNull(), f"{name}:type")
        .when((value < lo) | (value > hi), f"{name}:range")
    )


def validate_requests(df: DataFrame, profile: str = "api") -> DataFrame:
    """Typed request columns plus `errors`, for text input columns.

    A missing segment takes the default; another value is an `enum` error. The
    satisfaction score is rounded to one decimal as at serving time.
    """
    rules = RANGE_RULES[profile]
    errors = [_field_error(*rule) for rule in rules]
    segment = F.coalesce("segmento", F.lit(DEFAULT_SEGMENT))
    errors.append(F.when(~segment.isin(*SEGMENTS), "segmento:enum"))
    typed = {name: F.col(name).try_cast(_TYPES[name]) for name, _, _ in rules}
    if "satisfaction_score" in typed:
        typed["satisfaction_score"] = F.bround(typed["satisfaction_score"], 1)
    checked = df.withColumn("errors", F.array_compact(F.array(*errors)))
    return checked.withColumns({**typed, "segmento": segment})


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows)."""
    ok = F.size("errors") == 0
    return validated.filter(ok).drop("errors"), validated.filter(~ok)


def error_counts(validated: DataFrame) -> DataFrame:
    return validated.select(F.explode("errors").alias("error")).groupBy("error").agg(
        F.count(F.lit(1)).alias("n")
    )


def validate_searches(
    df: DataFrame, text: str = "query", segment: str = "segmento", top_k: str = "top_k"
) -> DataFrame:
    """Text of 3 to 500 characters, optional segment, top_k of 1 to 10 (default 3)."""
    k = F.coalesce(F.col(top_k), F.lit(3))
    length_ok = F.coalesce(F.length(text).between(3, 500), F.lit(False))
    segment_ok = F.col(segment).isNull() | F.col(segment).isin(*SEGMENTS)
    return df.withColumns(
        {
            top_k: k,
            "errors": F.array_compact(
                F.array(
                    F.when(~length_ok, "query:length"),
                    F.when(~segment_ok, "segmento:enum"),
                    F.when(~k.between(1, 10), "top_k:range"),
                )
            ),
        }
    )


def key_contract(present: DataFrame, required: DataFrame, column: str) -> DataFrame:
    """Required keys that are absent (set difference)."""
    return required.select(column).subtract(present.select(column))
