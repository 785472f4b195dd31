"""Validity of interval-dated share sets and their resolution to days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillmark.operators.skew import salted_join

KEYS = ["recording_mbid", "split_version_id"]


def sets_of(splits: DataFrame, holders: DataFrame) -> DataFrame:
    """(recording, set): interval bounds, share sum, holder rows, rows without a known holder, distinct intervals."""
    known = holders.select(F.col("holder_id").alias("rights_holder_id"), F.lit(1).alias("_known")).distinct()
    j = salted_join(splits, known, "rights_holder_id", "left")  # one holder may have a large part of all rows
    return j.groupBy(*KEYS).agg(
        F.min("valid_from").alias("valid_from"), F.max("valid_to").alias("valid_to"), F.sum("share_pct").cast("decimal(18,4)").alias("share_sum"), F.count(F.lit(1)).alias("holder_rows"),
        F.count_distinct("rights_holder_id").alias("holders"), F.count_if(F.col("_known").isNull()).alias("unknown_holders"), F.count_if((F.col("share_pct") < 0) | (F.col("share_pct") > 100)).alias("bad_shares"),
        F.count_distinct(F.struct("valid_from", "valid_to")).alias("intervals"),
    )


def overlaps(sets: DataFrame) -> DataFrame:
    """Per set the number of other sets of its recording that share a day with it; both intervals must be valid.

    Counted, not paired: of valid intervals those that meet [a, b) are the ones that start before b less the ones that end
    by a. Both are prefix sums over a recording's days, so a recording with very many sets costs no more than its rows.
    """
    v = sets.where("valid_from < valid_to").select(*KEYS, "valid_from", "valid_to")
    mark = F.array(F.struct(F.col("valid_from").alias("day"), F.lit(1).alias("s"), F.lit(0).alias("e")), F.struct(F.col("valid_to").alias("day"), F.lit(0).alias("s"), F.lit(1).alias("e")))
    days = v.select("recording_mbid", F.explode(mark).alias("m")).groupBy("recording_mbid", F.col("m.day").alias("day")).agg(F.sum("m.s").alias("s"), F.sum("m.e").alias("e"))
    w = W.partitionBy("recording_mbid").orderBy("day")
    days = days.select("recording_mbid", "day", F.coalesce(F.sum("s").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("begun"), F.sum("e").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("over"))
    at_end = days.select("recording_mbid", F.col("day").alias("valid_to"), "begun")
    at_start = days.select("recording_mbid", F.col("day").alias("valid_from"), "over")
    j = v.join(at_end, ["recording_mbid", "valid_to"]).join(at_start, ["recording_mbid", "valid_from"])
    return j.select(*KEYS, (F.col("begun") - F.col("over") - 1).alias("overlapping_sets")).where("overlapping_sets > 0")


def coverage(days: DataFrame, sets: DataFrame, number: str | None = None) -> DataFrame:
    """``days`` (recording_mbid, listen_date, streams; one row a day) with the numbers of sets in force, all and valid: prefix sums of interval ends over each recording's days.

    ``number``: a column of ``sets`` that numbers the valid sets of a recording; its sum over the valid sets in force comes
    out as ``which``, which is that set's number where there is just one.
    """
    v = sets.where("valid_from < valid_to").withColumn("v", F.coalesce("is_valid_set", F.lit(False)).cast("int"))
    v = v.withColumn("k", F.when(F.col("v") == 1, F.col(number)).otherwise(0).cast("bigint") if number else F.lit(0).cast("bigint"))
    mark = F.array(F.struct(F.col("valid_from").alias("day"), F.lit(1).alias("a"), F.col("v"), F.col("k")), F.struct(F.col("valid_to").alias("day"), F.lit(-1).alias("a"), (-F.col("v")).alias("v"), (-F.col("k")).alias("k")))
    m = v.select("recording_mbid", F.explode(mark).alias("m")).select("recording_mbid", "m.day", "m.a", "m.v", "m.k", F.lit(None).cast("bigint").alias("streams"), F.lit(0).alias("ev"))
    e = days.select("recording_mbid", F.col("listen_date").alias("day"), F.lit(0).alias("a"), F.lit(0).alias("v"), F.lit(0).cast("bigint").alias("k"), F.col("streams").cast("bigint").alias("streams"), F.lit(1).alias("ev"))
    g = m.unionByName(e).groupBy("recording_mbid", "day").agg(F.sum("a").alias("a"), F.sum("v").alias("v"), F.sum("k").alias("k"), F.max("streams").alias("streams"), F.max("ev").alias("ev"))
    w = W.partitionBy("recording_mbid").orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    which = [F.sum("k").over(w).alias("which")] if number else []
    return g.select("recording_mbid", F.col("day").alias("listen_date"), "streams", "ev", F.sum("a").over(w).alias("covering"), F.sum("v").over(w).alias("n"), *which).where("ev = 1").drop("ev")


def gaps(sets: DataFrame) -> DataFrame:
    """Recordings with a day between a set's end and the next start, by the previous row's end in (start, end) order."""
    v = sets.where("valid_from < valid_to")
    prev = F.lag("valid_to").over(W.partitionBy("recording_mbid").orderBy("valid_from", "valid_to", "split_version_id"))
    return v.withColumn("_p", prev).where(F.col("_p") < F.col("valid_from")).groupBy("recording_mbid").agg(F.count(F.lit(1)).alias("gaps"))


def validity(splits: DataFrame, holders: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row per set with eight independent defect flags and ``is_valid_set``, their strict absence."""
    s = sets_of(splits, holders)
    cat = catalogue.select("recording_mbid", F.lit(1).alias("_cat")).distinct()
    j = s.join(overlaps(s), KEYS, "left").join(gaps(s), "recording_mbid", "left").join(cat, "recording_mbid", "left")
    flags = {
        "share_sum_off": F.col("share_sum") != 100, "invalid_interval": ~(F.col("valid_from") < F.col("valid_to")), "missing_holder": F.col("unknown_holders") > 0,
        "orphan_recording": F.col("_cat").isNull(), "temporal_overlap": F.coalesce("overlapping_sets", F.lit(0)) > 0, "temporal_gap": F.coalesce("gaps", F.lit(0)) > 0,
        "share_out_of_range": F.col("bad_shares") > 0, "two_intervals": F.col("intervals") > 1,
    }
    j = j.withColumns(flags)
    bad = F.lit(False)
    for f in flags:
        bad = bad | F.coalesce(F.col(f), F.lit(True))
    return j.select(*KEYS, "valid_from", "valid_to", "share_sum", "holder_rows", *flags, (~bad).alias("is_valid_set"))


def range_counts(days: DataFrame, day: str, ranges: DataFrame, start: str, end: str) -> DataFrame:
    """How many of a few ``ranges`` cover each distinct day: (day, n, smallest id), days without one included.

    A join without an equality key, so it runs on the distinct days only and is joined back by the day; both sides are
    calendar-sized, not event-sized.
    """
    d = days.select(day).distinct()
    j = d.join(ranges, (F.col(day) >= F.col(start)) & (F.col(day) < F.col(end)), "left")
    return j.groupBy(day).agg(F.count(F.col(start)).alias("n_ranges"), F.min("range_id").alias("range_id"))


def resolution(days: DataFrame, sets: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """(recording, day) -> status and the one valid set in force, if it is one.

    Statuses in order: several valid sets; one, but no or several covering ranges; one; no set at all; none valid but
    covered by an invalid set; otherwise defective or a gap. Covering rows are counted, never picked from.
    """
    per = sets.groupBy("recording_mbid").agg(F.count(F.lit(1)).alias("sets"), F.count_if(F.col("is_valid_set")).alias("valid_sets"))
    no = F.row_number().over(W.partitionBy("recording_mbid").orderBy(F.col("is_valid_set").desc_nulls_last(), "valid_from", "split_version_id"))
    sets = sets.withColumn("_no", no)
    g = coverage(days, sets, "_no").join(per, "recording_mbid", "left").withColumns({"sets": F.coalesce("sets", F.lit(0)), "valid_sets": F.coalesce("valid_sets", F.lit(0))})
    # where just one valid set is in force the sum of their numbers is its number: an equality, not a join over days
    g = g.withColumn("_no", F.when(F.col("n") == 1, F.col("which")))
    g = g.join(sets.where("is_valid_set").select("recording_mbid", F.col("_no").cast("bigint").alias("_no"), F.col("split_version_id").alias("one")), ["recording_mbid", "_no"], "left").drop("_no", "which")
    if ranges is not None:
        g = g.join(range_counts(days, "listen_date", ranges, "range_from", "range_to"), "listen_date", "left")
    else:
        g = g.withColumn("n_ranges", F.lit(1))
    status = (
        F.when(F.col("n") > 1, "MULTIPLE_VALID_SETS").when((F.col("n") == 1) & (F.col("n_ranges") == 0), "RANGE_GAP").when((F.col("n") == 1) & (F.col("n_ranges") > 1), "RANGE_OVERLAP")
        .when(F.col("n") == 1, "RESOLVED").when(F.col("sets") == 0, "NO_OWNERSHIP_RECORD").when(F.col("valid_sets") == 0, "DEFECTIVE_OWNERSHIP")
        .when(F.col("covering") > 0, "COVERED_ONLY_BY_INVALID_SET").otherwise("OWNERSHIP_GAP_FOR_DATE")
    )
    return g.select("recording_mbid", "listen_date", "streams", status.alias("resolution_status"), F.when(F.col("n") == 1, F.col("one")).alias("split_version_id"), F.col("n").alias("valid_covering_sets"))
