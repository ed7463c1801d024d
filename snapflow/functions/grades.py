"""Grade lists such as ``1-5,8``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapflow.functions.text import strip

MIN_GRADE, MAX_GRADE = 1, 13  # fixed values: the grade domain


def grade_spec(spec: Column, strict: bool = True) -> Column:
    """Sorted distinct grades of a list of numbers and ranges.

    Blank parts are skipped, a reversed range gives nothing. A malformed part
    raises; with ``strict=False`` it makes the whole result null.
    """
    number = "^[+-]?[0-9]+$"
    raise_or_null = (
        F.raise_error(F.concat(F.lit("bad grade list: "), spec)) if strict else F.lit(None)
    ).cast("array<int>")

    parts = F.filter(F.transform(F.split(spec, ","), strip), lambda p: p != "")
    bounds = F.transform(
        parts,
        lambda p: F.when(
            F.contains(p, F.lit("-")),
            F.struct(
                strip(F.regexp_extract(p, "^([^-]*)-", 1)).alias("lo"),
                strip(F.regexp_extract(p, "^[^-]*-(.*)$", 1)).alias("hi"),
            ),
        ).otherwise(F.struct(p.alias("lo"), p.alias("hi"))),
    )
    well_formed = F.forall(bounds, lambda b: b["lo"].rlike(number) & b["hi"].rlike(number))

    def expand(b: Column) -> Column:
        # clamp before expanding, so a huge range costs nothing
        lo = F.greatest(b["lo"].try_cast("decimal(38,0)"), F.lit(MIN_GRADE)).cast("int")
        hi = F.least(b["hi"].try_cast("decimal(38,0)"), F.lit(MAX_GRADE)).cast("int")
        # sequence(5, 3) would count down
        return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    grades = F.sort_array(F.array_distinct(F.flatten(F.transform(bounds, expand))))
    return F.when(well_formed, grades).when(spec.isNotNull(), raise_or_null)
