"""Lead-time evidence of records, its summary per place, and the reliability that reviewers' reports give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlode.functions import placement as pl
from siftlode.functions.dates import months_observed, target_month
from siftlode.operators import aggregates

#: Observations that make a recommendation.
ENOUGH = 3
FAR_AHEAD = 24
KINDS = ("hospital-confirmed", "explicit-source", "student-reported", "historical-observed", "estimated")


def with_lead_times(records: DataFrame) -> DataFrame:
    """Records with ``observed_months``, ``place`` (the key of their lead time) and ``summary_id``, null without evidence."""
    out = records.withColumn("observed_months", months_observed(F.col("checked"), F.col("available_from"), F.col("booked_until")))
    out = out.withColumn("place", pl.lead_time_key(F.col("source_id"), F.col("institution"), F.coalesce("department_normalized", "department"), F.col("role_type")))
    some = F.col("explicit_months").isNotNull() | F.col("observed_months").isNotNull()
    return out.withColumn("summary_id", F.when(some, pl.hashed_id("leadtime-summary", F.col("place"))))


def evidence(records: DataFrame) -> DataFrame:
    """None, one or two rows per record: what its source says, and what was seen when it was checked."""
    target = target_month(F.col("available_from"), F.col("booked_until"))
    row = lambda kind, months, confidence, label: F.when(months.isNotNull(), F.struct(F.lit(kind).alias("kind"), months.cast("int").alias("months"), confidence.alias("confidence"), label.alias("label")))
    stated, seen = F.col("explicit_months"), F.col("observed_months")
    at_least = F.when(F.col("confidence") == "low", "medium").otherwise(F.col("confidence"))
    rows = F.array_compact(F.array(
        row("explicit-source", stated, at_least, F.concat(F.lit("Explicitly stated by source: apply "), stated, F.lit(" months ahead."))),
        row("historical-observed", seen, F.lit("low"), F.concat(F.lit("Estimated from public page history: observed "), seen, F.lit(" months ahead."))),
    ))
    out = records.select(F.col("id").alias("record_id"), "place", "source_id", target.alias("target"), F.col("checked").alias("observed_at"), F.inline(rows))
    # time as the day's text: the caller's zone has no part in an id
    identity = pl.hashed_id("leadtime-evidence", F.col("record_id"), F.col("kind"), F.col("months"), F.col("target"), F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    return out.withColumn("id", identity)


def summaries(rows: DataFrame, order: str = "record_id") -> DataFrame:
    """One row per place: what is recommended, on which basis and how surely, and the range of what was observed.

    Of several authoritative rows of a kind the first by ``order`` counts.
    """
    kind = F.col("kind")
    at = F.col(order)
    first = lambda k, *cs: F.min(F.when(kind == k, F.struct(at.alias("at"), *cs)))
    rows = rows.withColumn("seen", F.when(kind == "historical-observed", F.col("months")))
    # counts by place and months first: a place with many rows is spread over its months, and what is left of it is small
    counted = rows.groupBy("place", "seen").agg(
        F.min(F.struct(at.alias("at"), "source_id")).alias("source"), F.count("*").alias("n"), *(F.count_if(kind == k).alias(k) for k in KINDS),
        first("hospital-confirmed", "months").alias("confirmed"), first("explicit-source", "months", "confidence").alias("stated"),
    )
    pairs = F.collect_list(F.when(F.col("seen").isNotNull(), F.struct(F.col("seen").alias("value"), "n")))
    merged = counted.groupBy("place").agg(
        F.min("source").alias("source"), F.sum("n").alias("evidence"), F.coalesce(F.sum(F.when(F.col("seen").isNotNull(), F.col("n"))), F.lit(0)).alias("observed"), *(F.sum(f"`{k}`").alias(k) for k in KINDS),
        F.min("confirmed").alias("confirmed"), F.min("stated").alias("stated"), pairs.alias("pairs"), F.min("seen").alias("least"), F.max("seen").alias("most"),
    )
    out = merged.select(
        "place", F.col("source.source_id").alias("source_id"), "evidence", "observed", *(f"`{k}`" for k in KINDS), F.col("confirmed.months").alias("confirmed"), F.col("stated.months").alias("stated"),
        F.col("stated.confidence").alias("stated_confidence"), aggregates.rounded(aggregates.counted_median(F.col("pairs"))).cast("int").alias("median_months"), "least", "most",
    )
    n = {k: F.col(f"`{k}`") > 0 for k in KINDS}
    enough = F.col("observed") >= ENOUGH
    basis = (
        F.when(n["hospital-confirmed"], "hospital-confirmed").when(n["explicit-source"], "explicit-source").when(enough, "historical-observed")
        .when(n["student-reported"], "student-reported").when(F.col("observed") > 0, "historical-observed").otherwise("estimated")
    )
    sure = (
        F.when(n["hospital-confirmed"], "high")
        .when(n["explicit-source"], F.when(F.col("stated_confidence") == "low", "medium").otherwise(F.col("stated_confidence")))
        .when(enough, "medium")
        .otherwise("low")
    )
    advice = F.when(n["hospital-confirmed"], F.col("confirmed")).otherwise(F.col("stated"))
    months = lambda words, c, end: F.concat(F.lit(words), c.cast("string"), F.lit(end))
    label = (
        F.when(n["hospital-confirmed"], months("Hospital confirmed: apply ", advice, " months ahead."))
        .when(n["explicit-source"], months("Explicitly stated by source: apply ", advice, " months ahead."))
        .when(enough, months("Estimated from public page history: usually visible ", F.col("median_months"), " months ahead."))
        .when(n["student-reported"], "Student-reported lead time is present but not yet enough for a recommendation.")
        .when(n["estimated"] | (F.col("observed") > 0), "Estimated lead time is low confidence and should not be treated as fact.")
        .otherwise("No reliable apply-ahead recommendation is available.")
    )
    warned = F.array_compact(F.array(
        F.when((basis == "historical-observed") & ~enough, "Estimated recommendation is based on fewer than 3 observations."),
        F.when(advice > FAR_AHEAD, "Lead time is greater than 24 months and needs manual review."),
    ))
    return out.select(
        pl.hashed_id("leadtime-summary", F.col("place")).alias("id"), "place", "source_id", F.coalesce(advice, F.when(enough, F.col("least"))).alias("apply_min"),
        F.coalesce(advice, F.when(enough, F.col("most"))).alias("apply_max"), "median_months", "least", "most", "evidence", "observed", basis.alias("basis"), sure.alias("confidence"),
        label.alias("label"), warned.alias("warnings"),
    )


def positive() -> Column:
    """A reviewer's report that confirms a record and doubts nothing."""
    doubted = F.lit(False)
    for c in ("department_ok", "availability_ok", "link_ok"):
        doubted |= F.coalesce(F.col(c) == "no", F.lit(False))
    return (F.col("verdict") == "correct") & (F.col("source_ok") == "yes") & ~doubted


def negative() -> Column:
    """A report that rejects a record or doubts anything; not the opposite of ``positive``."""
    out = F.col("verdict").isin("wrong", "partly-wrong", "not-relevant")
    for c in ("source_ok", "department_ok", "availability_ok", "link_ok"):
        out |= F.coalesce(F.col(c) == "no", F.lit(False))
    return out


def reliability(records: DataFrame, reviews: DataFrame, reports: DataFrame) -> DataFrame:
    """Per record of ``records(id)``: numbers of reviews, a label, and the median and range of usable lead-time reports if they are enough.

    reviews: ``record_id, role, verdict, source_ok, department_ok, availability_ok, link_ok, created``; reports: ``record_id, months_ahead,
    kind, displayable``. Both sides are aggregated before they are joined.
    """
    seen = reviews.groupBy(F.col("record_id").alias("id")).agg(
        F.count("*").alias("reviews"), F.max("created").alias("latest"), F.count_if(positive()).alias("positive"), F.count_if(negative()).alias("negative"),
        F.coalesce(F.bool_or((F.col("role") == "administrator") & (F.col("verdict") == "correct")), F.lit(False)).alias("confirmed"),
    )
    usable = F.when(F.col("displayable") & (F.col("months_ahead") >= 0) & (F.col("kind") != "estimate"), F.col("months_ahead"))
    counted = reports.groupBy(F.col("record_id").alias("id"), usable.alias("value")).agg(F.count("*").alias("n"))
    some = F.col("value").isNotNull()
    told = counted.groupBy("id").agg(F.sum("n").alias("reports"), F.sum(F.when(some, F.col("n"))).alias("usable"), F.collect_list(F.when(some, F.struct("value", "n"))).alias("pairs"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    told = told.withColumn("m", aggregates.counted_median(F.col("pairs"))).drop("pairs")
    both = records.select("id").join(seen, "id", "left").join(told, "id", "left")
    n = {c: F.coalesce(c, F.lit(0)) for c in ("reviews", "positive", "negative", "reports", "usable")}
    conflicting = F.when((n["positive"] > 0) & (n["negative"] > 0), n["positive"] + n["negative"]).otherwise(0)
    label = (
        F.when(F.coalesce("confirmed", F.lit(False)), "hospital-confirmed").when(conflicting > 0, "conflicting-reports").when(n["positive"] >= 2, "multiple-student-checked")
        .when(n["positive"] == 1, "student-checked").otherwise("unverified")
    )
    enough = n["usable"] >= ENOUGH
    few = F.when((n["reports"] > 0) & ~enough, F.array(F.lit("Community lead-time reports are present but fewer than 3 usable reports."))).otherwise(F.array().cast("array<string>"))
    return both.select(
        "id", n["reviews"].alias("reviews"), "latest", n["positive"].alias("positive"), n["negative"].alias("negative"), conflicting.cast("long").alias("conflicting"), n["reports"].alias("reports"),
        F.when(enough, F.col("m")).alias("median_months"), F.when(enough, F.col("lo")).alias("least"), F.when(enough, F.col("hi")).alias("most"), label.alias("label"), few.alias("warnings"),
    )


def in_order(summaries: DataFrame) -> DataFrame:
    """Summaries by their ids, as a locale sorts them."""
    return summaries.orderBy(F.collate("id", "UNICODE"))


def with_summaries(records: DataFrame, summaries: DataFrame) -> DataFrame:
    """Records with what the summary of their ``summary_id`` says; those without one keep nulls."""
    return records.join(summaries, "summary_id", "left").drop("summary_id")
