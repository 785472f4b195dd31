"""Field-by-field differences of two copies of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _same(field: str, dtype: str, tol: float) -> str:
    a, b = f"__prior.`{field}`", f"__restated.`{field}`"
    if dtype in ("double", "float"):
        # <=> first: it settles nulls, NaN and infinities
        return f"({a} <=> {b} or coalesce(abs({a} - {b}) <= {tol!r}D, false))"
    return f"({a} <=> {b})"


def differences(prior: DataFrame, restated: DataFrame, keys: list[str], fields: list[str], tol: float = 1e-9) -> DataFrame:
    """(keys..., diff_kind, field_name): only_prior, only_restated, or differs with one row per differing field.

    Sides are tagged and united, one group by key collects one struct per side, and generated SQL compares the structs.
    A side that holds several unequal rows of one key is represented by its smallest (in struct order), so repeated rows
    change nothing. Null keys are a key of their own; null equals only null; doubles are equal within ``tol``, NaN equals
    NaN. Only key and compared fields leave the scan, so clashing extra columns do no harm.
    """
    for f in fields:
        if prior.schema[f].dataType != restated.schema[f].dataType:
            restated = restated.withColumn(f, F.col(f).cast(prior.schema[f].dataType))
    side = lambda df, n: df.select(*keys, F.lit(n).alias("_side"), F.struct(*fields).alias("_v"))
    both = side(prior, 0).unionByName(side(restated, 1))
    pick = lambda n: F.min(F.when(F.col("_side") == n, F.col("_v")))
    g = both.groupBy(*keys).agg(pick(0).alias("__prior"), pick(1).alias("__restated"))
    types = dict(prior.dtypes)
    checks = ", ".join(f"named_struct('f', '{f}', 'ok', {_same(f, types[f], tol)})" for f in fields)
    kinds = f"""
        case when __restated is null then array(named_struct('diff_kind', 'only_prior', 'field_name', ''))
             when __prior is null then array(named_struct('diff_kind', 'only_restated', 'field_name', ''))
             else transform(filter(array({checks}), x -> not x.ok), x -> named_struct('diff_kind', 'differs', 'field_name', x.f)) end"""
    return g.select(*keys, F.explode(F.expr(kinds)).alias("d")).select(*keys, "d.diff_kind", "d.field_name")
