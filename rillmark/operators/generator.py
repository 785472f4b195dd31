"""Modeled rights rows from hashes of the recording id: no random state, the same on every layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillmark.functions.keys import hash_unit


@dataclass(frozen=True)
class RightsModel:
    """Fixed values of the generator: cumulative weights of 1-4 holders, of holder types and of payee statuses, share of recordings with a mid-period change, days of the defects, quotas of defects by hash rank."""

    holders: int = 1000
    reserved: int = 20
    holder_weights: tuple[float, ...] = (0.42, 0.76, 0.94, 1.0)
    change_share: float = 0.02
    change_day: str = "2026-06-15"
    base_day: str = "2025-01-01"
    open_day: str = "9999-12-31"
    holder_types: tuple[tuple[str, float], ...] = (("PUBLISHER", 0.34), ("LABEL", 0.60), ("INDIE_ARTIST", 0.90), ("ADMINISTRATOR", 1.0))
    payee_statuses: tuple[tuple[str, float], ...] = (("ACTIVE", 0.93), ("PENDING_VERIFICATION", 1.0))
    model_scope: str = "MODELED_GLOBAL_SINGLE_SCOPE"
    overlap: tuple[str, str] = ("2026-06-10", "2026-06-20")
    gap: tuple[str, str] = ("2026-06-05", "2026-06-20")
    invalid: tuple[str, str] = ("2026-06-15", "2026-06-01")
    broken_share_e4: int = 75_000
    orphans: int = 3
    quotas: tuple[tuple[str, int], ...] = (("SHARE_SUM", 5), ("OVERLAP", 4), ("GAP", 4), ("INVALID_INTERVAL", 2), ("MISSING_HOLDER", 3))


def _u(seed: str, *parts: Column) -> Column:
    return hash_unit(F.concat_ws("|", F.lit(seed), *parts))


def defects(universe: DataFrame, m: RightsModel) -> DataFrame:
    """(recording_mbid, defect): exact disjoint quotas, the recordings with the smallest salted hashes. Only as many rows as the quotas name are ranked."""
    total = sum(n for _, n in m.quotas)
    h = universe.select("recording_mbid").distinct().withColumn("h", F.sha2(F.concat(F.lit("defect|"), "recording_mbid"), 256))
    first = h.orderBy("h", "recording_mbid").limit(total)  # top-k, merged from each task's own top-k
    r = first.withColumn("rank", F.row_number().over(W.orderBy("h", "recording_mbid")))
    kind, upto = F.lit(None).cast("string"), 0
    case = None
    for name, n in m.quotas:
        upto += n
        case = F.when(F.col("rank") <= upto, name) if case is None else case.when(F.col("rank") <= upto, name)
    return r.select("recording_mbid", (case if case is not None else kind).alias("defect"))


def _members(m: RightsModel, key: Column) -> Column:
    """One share set as an array of (rights_holder_id, share_e4): one to four distinct holders, shares in 1/10000 percent that add up to 1,000,000 exactly.

    Holder rank is skewed by u cubed; a rank already taken moves on to the next. The first holder takes the rounding rest.
    """
    u, n, top = _u("n", key), F.lit(4), m.holders - m.reserved
    for k in (3, 2, 1):
        n = F.when(u < m.holder_weights[k - 1], k).otherwise(n)
    slots = F.transform(F.sequence(F.lit(1), n), lambda i: i.cast("string"))
    ranks = F.transform(F.transform(slots, lambda i: _u("h", key, i)), lambda v: F.floor(v * v * v * top).cast("bigint"))

    def free(taken: Column, x: Column) -> Column:
        for _ in range(3):  # at most three are taken
            x = F.when(F.array_contains(taken, x), (x + 1) % top).otherwise(x)
        return F.concat(taken, F.array(x))

    ids = F.transform(F.aggregate(ranks, F.array().cast("array<bigint>"), free), lambda x: F.concat(F.lit("GEN-"), F.lpad(x.cast("string"), 6, "0")))
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    raw = F.transform(slots, lambda i: (F.floor(_u("w", key, i) * 9000) + 1000).cast("bigint"))
    shares = F.transform(raw, lambda x: F.floor(x * 1_000_000 / total(raw)).cast("bigint"))
    shares = F.transform(shares, lambda x, i: x + F.when(i == 0, F.lit(1_000_000) - total(shares)).otherwise(0))
    return F.zip_with(ids, shares, lambda h, x: F.struct(h.alias("rights_holder_id"), x.cast("bigint").alias("share_e4")))


def generate_splits(universe: DataFrame, m: RightsModel = RightsModel()) -> DataFrame:
    """(recording_mbid, slot, rights_holder_id, share_e4): the first share set of each recording, without dates."""
    d = universe.select("recording_mbid").distinct().select("recording_mbid", F.posexplode(_members(m, F.col("recording_mbid"))).alias("i", "x"))
    return d.select("recording_mbid", (F.col("i") + 1).alias("slot"), "x.*")


def orphans(spark: SparkSession, m: RightsModel = RightsModel()) -> DataFrame:
    """(recording_mbid, defect): ids outside any catalogue, of UUID version 8."""
    h = F.sha2(F.concat(F.lit("orphan|"), F.col("id").cast("string")), 256)
    part = lambda a, n: F.substring(h, a, n)
    uuid = F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("8"), part(14, 3)), part(17, 4), part(21, 12))
    return spark.range(m.orphans).select(uuid.alias("recording_mbid"), F.lit("ORPHAN_RECORDING").alias("defect"))


def generate_ownership(universe: DataFrame, m: RightsModel = RightsModel(), labels: DataFrame | None = None) -> DataFrame:
    """(recording_mbid, split_version_id, valid_from, valid_to, slot, rights_holder_id, share_e4): the dated share sets of each recording.

    Intervals are half-open. A ``change_share`` of the recordings has two sets that meet on ``change_day``, all others one.
    ``labels`` (recording_mbid, defect; few rows) says which recordings come out broken and how; orphans are added to the universe.
    """
    day = lambda x: F.lit(x).cast("date")
    part = lambda salt, a, b: F.struct(F.lit(salt).alias("salt"), day(a).alias("valid_from"), day(b).alias("valid_to"))
    d = universe.select("recording_mbid").where("recording_mbid is not null").distinct()
    if labels is None:
        d = d.withColumn("defect", F.lit(None).cast("string"))
    else:
        d = d.unionByName(labels.where("defect = 'ORPHAN_RECORDING'").select("recording_mbid")).join(F.broadcast(labels), "recording_mbid", "left")  # as many rows as the quotas name
    one, kind = F.array(part("", m.base_day, m.open_day)), F.col("defect")
    healthy = F.when(_u("c", F.col("recording_mbid")) < m.change_share, F.array(part("", m.base_day, m.change_day), part("#b", m.change_day, m.open_day))).otherwise(one)
    sets = (
        F.when(kind == "OVERLAP", F.array(part("", m.base_day, m.overlap[1]), part("#b", m.overlap[0], m.open_day))).when(kind == "GAP", F.array(part("", m.base_day, m.gap[0]), part("#b", m.gap[1], m.open_day)))
        .when(kind == "INVALID_INTERVAL", F.array(part("", *m.invalid))).when(kind.isin("SHARE_SUM", "MISSING_HOLDER"), one).otherwise(healthy)
    )
    x = _rows(d.select("recording_mbid", "defect", F.explode(sets).alias("s")).select("recording_mbid", "defect", "s.*"), m)
    first = F.col("slot") == 1
    share = F.when(first & (kind == "SHARE_SUM"), F.greatest(F.col("share_e4") - m.broken_share_e4, F.lit(5_000).cast("bigint"))).otherwise(F.col("share_e4"))
    holder = F.when(first & (kind == "MISSING_HOLDER"), "GEN-999999").otherwise(F.col("rights_holder_id"))
    return x.withColumns({"share_e4": share, "rights_holder_id": holder}).drop("salt", "defect")


def _rows(sets: DataFrame, m: RightsModel) -> DataFrame:
    """The holder rows of dated sets; a set's id comes from its recording and first day."""
    svid = F.concat(F.lit("GSV-"), F.substring(F.sha2(F.concat_ws("|", F.lit("set"), "recording_mbid", F.col("valid_from").cast("string")), 256), 1, 16))
    x = sets.withColumn("split_version_id", svid).select("*", F.posexplode(_members(m, F.concat("recording_mbid", "salt"))).alias("i", "x"))
    return x.select("recording_mbid", "split_version_id", "valid_from", "valid_to", *[c for c in sets.columns if c not in ("recording_mbid", "valid_from", "valid_to")], (F.col("i") + 1).alias("slot"), "x.*")


def generate_holders(spark: SparkSession, m: RightsModel = RightsModel()) -> DataFrame:
    """(holder_id, display_name, holder_type, payee_status, model_scope, is_modeled): every holder, the reserved last ones included."""
    d = spark.range(m.holders).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("i"))

    def choice(seed: str, options: tuple[tuple[str, float], ...]) -> Column:
        u, out = _u(seed, F.col("i")), F.lit(options[-1][0])
        for name, upto in reversed(options[:-1]):
            out = F.when(u < upto, name).otherwise(out)
        return out

    return d.select(
        F.concat(F.lit("GEN-"), "i").alias("holder_id"), F.concat(F.lit("Modeled Rights Holder "), "i").alias("display_name"), choice("t", m.holder_types).alias("holder_type"),
        choice("p", m.payee_statuses).alias("payee_status"), F.lit(m.model_scope).alias("model_scope"), F.lit(True).alias("is_modeled"),
    )


def uncovered_days(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Days of [start, end) that no range covers: a calendar against a few ranges."""
    spark = ranges.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))).alias("day"))
    return days.join(F.broadcast(ranges), (F.col("day") >= F.col("range_from")) & (F.col("day") < F.col("range_to")), "left_anti")
