"""Label text to class number."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from msgrisk.constants import LABEL_CLASSES
from msgrisk.functions.text import strip_whitespace


def coerce_label(label: Column, strict: bool = True) -> Column:
    """Known spellings by table, other text as a number cut to its integer part.

    Unknown text raises in strict mode and gives null otherwise.
    """
    value = strip_whitespace(F.lower(label))
    classes = F.create_map(*[F.lit(x) for pair in LABEL_CLASSES.items() for x in pair])
    number = F.try_cast(value, "double") if hasattr(F, "try_cast") else value.try_cast("double")
    number = F.when(~F.isnan(number) & (F.abs(number) < F.lit(2147483648.0)), number.cast("int"))
    result = F.coalesce(F.try_element_at(classes, value), number)
    if not strict:
        return result
    problem = F.concat(F.lit("unknown label: "), F.coalesce(label, F.lit("null")))
    return F.coalesce(result, F.raise_error(problem).cast("int"))
