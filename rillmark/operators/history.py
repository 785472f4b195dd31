"""Full attribute history from stacked landings, stored as checkpoints and patches.

A store is a folder of Parquet, one partition ``no=<landing>`` each: a checkpoint landing holds every present entity in full,
another only arrivals, patches and departures. A new landing is added by reading the last checkpoint and what follows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def landing_times(df: DataFrame, run: str, ts: str) -> DataFrame:
    """(run, at, no): a landing's time is its smallest ``ts``; landings are numbered from 0 by time, then run id. One row per run of the load job."""
    d = df.where(F.col(run).isNotNull()).groupBy(run).agg(F.min(ts).alias("at")).where("at is not null")
    return d.withColumn("no", F.row_number().over(W.orderBy("at", run)) - 1)


def build_store(df: DataFrame, entity: str, attrs: list[str], run: str, ts: str, every: int = 4) -> DataFrame:
    """Checkpoint-delta rows: (entity, no, at, kind, present, attrs..., set_<attr>...).

    Every ``every``-th landing is a checkpoint and holds each present entity in full (``kind`` full). Between
    checkpoints a row is written only where something changed against the landing before: an entity that came (full), a
    patch with just the changed attributes (``set_x`` says which; a patched value may be null), or an entity that left
    (gone). Rows of one landing and entity are united first: the smallest attribute tuple by value order stands, so
    repeated and late rows add nothing. Null entities are left out. The entity's windows are bounded by the number of landings.
    """
    lt = landing_times(df, run, ts)
    last = lt.select(F.max("no").alias("last")).scalar()
    # one row per landing: a count of loads, not of records; small whatever the table holds
    rows = df.where(F.col(entity).isNotNull()).groupBy(entity, run).agg(F.min(F.struct(*attrs)).alias("v")).join(lt, run)
    by_no = lt.select((F.col("no") - 1).alias("no"), F.col("at").alias("next_at"))
    rows = rows.join(by_no, "no", "left").select(entity, "no", "at", "next_at", "v.*")
    w = W.partitionBy(entity).orderBy("no")
    prev_no, next_no = F.lag("no").over(w), F.lead("no").over(w)
    rows = rows.withColumns({"_pn": prev_no, "_nn": next_no} | {f"_p_{a}": F.lag(a).over(w) for a in attrs})
    came = F.col("_pn").isNull() | (F.col("_pn") < F.col("no") - 1)
    cp = F.col("no") % every == 0
    full = came | cp
    changed = {a: ~F.col(a).eqNullSafe(F.col(f"_p_{a}")) for a in attrs}
    any_change = F.greatest(*[changed[a].cast("int") for a in attrs]) == 1
    live = rows.where(full | any_change).select(
        entity, "no", "at", F.when(full, "full").otherwise("patch").alias("kind"),
        *[F.when(full | changed[a], F.col(a)).alias(a) for a in attrs],
        *[(full | changed[a]).alias(f"set_{a}") for a in attrs],
    )
    left = rows.where((F.col("no") < last) & (F.col("_nn").isNull() | (F.col("_nn") > F.col("no") + 1)))
    gone = left.select(
        entity, (F.col("no") + 1).alias("no"), F.col("next_at").alias("at"), F.lit("gone").alias("kind"),
        *[F.lit(None).cast(df.schema[a].dataType).alias(a) for a in attrs],
        *[F.lit(False).alias(f"set_{a}") for a in attrs],
    )
    return live.unionByName(gone)


def write_store(store: DataFrame, path: str) -> None:
    """The rows of ``build_store`` as a store in ``path``, which must not exist: stores grow by ``append_landing`` alone."""
    store.repartition("no", F.pmod(F.xxhash64(*store.columns), F.lit(8))).write.partitionBy("no").mode("errorifexists").parquet(path)


def store_schema(df: DataFrame, entity: str, attrs: list[str], at: str) -> str:
    """The columns of a store for entities and attributes as ``df`` has them; ``at`` is the type of a landing's time."""
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = [(entity, kind[entity]), ("at", at), ("kind", "string"), *[(a, kind[a]) for a in attrs], *[(f"set_{a}", "boolean") for a in attrs], ("no", "int")]
    return ", ".join(f"`{c}` {t}" for c, t in cols)


def read_store(spark: SparkSession, path: str, schema: str, since: int | None = None) -> DataFrame:
    """The store's rows; with ``since`` only the partitions of that landing and later ones are read."""
    d = spark.read.schema(schema).parquet(path)
    return d if since is None else d.where(F.col("no") >= since)


def state(store: DataFrame, entity: str, attrs: list[str], every: int = 4) -> DataFrame:
    """(entity, attrs...) of the entities present after the last row of ``store``, which must begin at a checkpoint."""
    d = fold(store, entity, attrs, every)
    last = d.groupBy(entity).agg(F.max_by(F.struct("kind", *attrs), "no").alias("v"))
    return last.where("v.kind <> 'gone'").select(entity, *[F.col(f"v.{a}") for a in attrs])


def append_landing(spark: SparkSession, path: str, landing: DataFrame, entity: str, attrs: list[str], no: int, at: Column, every: int = 4, at_type: str = "timestamp") -> None:
    """Add landing ``no`` (the one after the last), known at ``at``, to the store in ``path``.

    Read are the last checkpoint and the patches since, never the landings before. ``landing``: (entity, attrs...); null
    entities are left out, repeated rows united by the smallest attribute tuple as in ``build_store``. A landing that is already
    there is refused. An empty landing that changes nothing leaves no partition.
    """
    base = read_store(spark, path, store_schema(landing, entity, attrs, at_type), (no - 1) // every * every)
    if not base.where(F.col("no") >= no).isEmpty():
        raise ValueError(f"landing {no} is already in the store")
    was = state(base, entity, attrs, every).select(F.col(entity), F.struct(*attrs).alias("_was"))
    now = landing.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.min(F.struct(*attrs)).alias("_now"))
    j = was.join(now, entity, "full_outer")
    gone, full = F.col("_now").isNull(), F.col("_was").isNull() | F.lit(no % every == 0)
    changed = {a: ~F.col(f"_now.{a}").eqNullSafe(F.col(f"_was.{a}")) for a in attrs}
    any_change = F.greatest(*[c.cast("int") for c in changed.values()]) == 1 if len(attrs) > 1 else changed[attrs[0]]
    rows = j.where(gone | full | any_change).select(
        entity, F.lit(no).alias("no"), at.alias("at"), F.when(gone, "gone").when(full, "full").otherwise("patch").alias("kind"),
        *[F.when(~gone & (full | changed[a]), F.col(f"_now.{a}")).alias(a) for a in attrs],
        *[(~gone & (full | changed[a])).alias(f"set_{a}") for a in attrs],
    )
    rows.write.partitionBy("no").mode("append").parquet(path)


def fold(store: DataFrame, entity: str, attrs: list[str], every: int = 4) -> DataFrame:
    """The state after each stored row: patches folded forward from the nearest checkpoint or arrival at or before them.

    A ``full`` row starts a new fold, so no fold spans more than ``every`` landings.
    """
    w = W.partitionBy(entity).orderBy("no").rowsBetween(W.unboundedPreceding, 0)
    d = store.withColumn("_base", F.sum((F.col("kind") == "full").cast("int")).over(w))
    f = W.partitionBy(entity, "_base").orderBy("no").rowsBetween(W.unboundedPreceding, 0)
    # a struct around the value keeps a patched null apart from "not patched"
    vals = {a: F.last(F.when(F.col(f"set_{a}"), F.struct(F.col(a).alias("v"))), ignorenulls=True).over(f) for a in attrs}
    return d.withColumns({f"_s_{a}": vals[a] for a in attrs}).select(entity, "no", "at", "kind", *[F.when(F.col("kind") != "gone", F.col(f"_s_{a}.v")).alias(a) for a in attrs])


def versions(store: DataFrame, entity: str, attrs: list[str], every: int = 4) -> DataFrame:
    """Validity rows (entity, attrs..., version_from, version_to, version_no, is_current) from a store; version_to null while current.

    Folded rows equal to the one before (checkpoints of an unchanged entity) are merged.
    """
    d = fold(store, entity, attrs, every)
    w = W.partitionBy(entity).orderBy("no")
    same = F.lag("kind").over(w).isNotNull() & ((F.lag("kind").over(w) == "gone") == (F.col("kind") == "gone"))
    for a in attrs:
        same = same & F.col(a).eqNullSafe(F.lag(a).over(w))
    d = d.withColumn("_same", same).where("not _same")
    d = d.withColumn("version_to", F.lead("at").over(w)).where("kind <> 'gone'")
    return d.select(entity, *attrs, F.col("at").alias("version_from"), "version_to", F.row_number().over(w).alias("version_no"), F.col("version_to").isNull().alias("is_current"))
