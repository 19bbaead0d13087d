"""Rules over records and sources as named conditions, row constraints, and the quality gate.

Records have the columns of ``placement records`` (id, source_id, institution, department, role_type, status, available_from, booked_until,
explicit_months, observed_months, snippet, language, region, extraction_language, method, confidence, review_status, n_warnings, checked, url);
sources have id, language, region, status and urls (url, fetch_mode, parser).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlode.functions import lexicon as lex
from siftlode.functions import placement as pl
from siftlode.functions.dates import text_month_index
from siftlode.operators.rules import fired

#: Largest shares of failed pages and of lost records that pass.
FAILURE_RATE, DROP_RATE = 0.15, 0.25
#: Months ahead beyond which a lead time is doubted.
FAR_AHEAD = 24
VAGUE = ("not-specified", "unclear", "application-only")
LOW = "low-confidence review queue marker"


def _c(name: str) -> Column:
    return F.col(name)


def review_reasons(recent_change: Column | None = None) -> dict[str, Column]:
    """Why a record needs a person's eyes, by reason; those on availability name the status."""
    far = lambda c: F.coalesce(_c(c) > FAR_AHEAD, F.lit(False))
    out = {"low confidence": _c("confidence") == "low", "parser warnings": _c("n_warnings") > 0, "missing source snippet": F.coalesce(_c("snippet") == "", F.lit(True))}
    out |= {f"availability is {s}": _c("status") == s for s in VAGUE}
    out["lead time is greater than 24 months"] = far("explicit_months") | far("observed_months")
    out["availability date is in the past"] = pl.past_month(_c("available_from"), _c("booked_until"), _c("checked"))
    out["source text mentions fully booked but parser did not mark fully-booked-until"] = pl.says_booked(_c("snippet")) & (_c("status") != "fully-booked-until")
    if recent_change is not None:
        out["recent change"] = recent_change
    return out


def parser_type(parsers: Column) -> Column:
    """Whether a hospital's own parser reads a record's source; parsers: those of the source's addresses."""
    return F.when((_c("method") == "site-parser") | F.coalesce(F.exists(parsers, lambda p: p != "generic"), F.lit(False)), "site-specific").otherwise("generic")


def priority_reasons() -> dict[str, Column]:
    """What moves a record up the review queue; ``parser_type`` must be a column."""
    evidence = _c("explicit_months").isNotNull() | _c("observed_months").isNotNull()
    return {
        "low confidence": _c("confidence") == "low",
        "no site-specific parser": _c("parser_type") != "site-specific",
        "non-German source": _c("language") != "de",
        "availability date": _c("available_from").isNotNull() | _c("booked_until").isNotNull(),
        "lead-time evidence": evidence,
    }


def queue_order() -> list[Column]:
    """Most reasons first, then least sure, then by institution; ids end ties."""
    rank = F.when(_c("confidence") == "low", 0).when(_c("confidence") == "medium", 1).otherwise(2)
    return [F.desc("priority"), rank.asc(), F.col("institution").asc(), F.col("id").asc()]


def needs_verification() -> Column:
    return _c("status").isin("candidate", "needs-review")


def source_issues(sources: DataFrame) -> DataFrame:
    """(id, severity, reason) per rule that a source breaks, one for each address with an uncommon fetch mode."""
    told = lambda when, severity, reason: F.when(when, F.array(F.struct(F.lit(severity).alias("severity"), F.lit(reason).alias("reason"))))
    whole = [
        told((_c("language") == "unknown") | (_c("region") == "unknown"), "warning", "missing language or region metadata"),
        told(needs_verification(), "info", "source requires manual verification"),
        told((_c("language") != "de") & (_c("status") == "verified"), "warning", "non-German source marked verified"),
    ]
    special = F.transform(F.filter("urls", lambda u: u["fetch_mode"] != "html"), lambda u: F.struct(F.lit("info").alias("severity"), F.concat(F.lit("special fetch mode: "), u["fetch_mode"]).alias("reason")))
    return sources.select("id", "language", F.inline(F.flatten(F.array_compact(F.array(*whole, special)))))


#: What to do about an issue, by its reason; the fallback for all others.
ACTIONS = {
    "low-confidence record is not held for human review": "Force reviewStatus to needs-human-review.",
    "missing extracted source snippet": "Add a source snippet before treating extracted facts as reliable.",
    "missing placement source language or region": "Propagate sourceLanguage and region from the registry.",
    "unknown extraction language": "Confirm the parser selected the intended language pack.",
}
ACTION = "Review this placement against the official source page."


def record_issues(records: DataFrame) -> DataFrame:
    """(id, source_id, language, review_status, severity, reason, action) per rule that a record breaks."""
    low, published = _c("confidence") == "low", _c("review_status") == "auto-published"
    rules = [
        (low, "info", F.lit(LOW)),
        (low & (_c("review_status") != "needs-human-review"), "error", F.lit("low-confidence record is not held for human review")),
        (F.coalesce(_c("snippet") == "", F.lit(True)), "warning", F.lit("missing extracted source snippet")),
        ((_c("language") == "unknown") | (_c("region") == "unknown"), "warning", F.lit("missing placement source language or region")),
        (_c("extraction_language") == "unknown", "info", F.lit("unknown extraction language")),
        (_c("status").isin(*VAGUE), "info", F.concat(F.lit("sparse availability: "), _c("status"))),
        ((_c("status") == "fully-booked-until") & (_c("available_from").isNotNull() | published), "warning", F.lit("fully booked wording may be over-interpreted")),
        (~_c("language").isin("de", "unknown") & published & (_c("method") != "hospital-confirmed"), "warning", F.lit("non-German parser output auto-published")),
    ]
    found = F.array_compact(F.array(*(F.when(when, F.struct(F.lit(severity).alias("severity"), reason.alias("reason"))) for when, severity, reason in rules)))
    rows = records.select("id", "source_id", "language", "review_status", F.inline(found))
    return rows.withColumn("action", F.coalesce(pl.lookup(ACTIONS, F.col("reason")), F.lit(ACTION)))


def language_summaries(sources: DataFrame, records: DataFrame, issues: DataFrame) -> DataFrame:
    """Per language of either side: sources, placements, those that need review, sparse ones, sources to verify, and a status of three."""
    of = lambda df, *aggs: df.groupBy("language").agg(*aggs)
    s = of(sources, F.count("*").alias("sources"), F.count_if(needs_verification()).alias("to_verify"))
    r = of(records, F.count("*").alias("placements"), F.count_if(_c("review_status") == "needs-human-review").alias("needing_review"))
    i = of(issues.filter(F.col("reason") != LOW), F.count_distinct("id").alias("sparse"))
    both = s.join(r, "language", "full_outer").join(i, "language", "left")
    n = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("sources", "placements", "needing_review", "sparse", "to_verify")}
    status = F.when(n["placements"] == 0, "source-only").when((n["needing_review"] > 0) | (n["sparse"] > 0), "needs-review").otherwise("has-reviewed-records")
    return both.select("language", *n.values(), status.alias("status"))


def risky_counts(issues: DataFrame) -> DataFrame:
    """One row: ids with any issue but the low marker, and published ones with an issue that is more than information."""
    risky = (F.col("severity") != "info") & (F.col("review_status") == "auto-published")
    return issues.agg(F.count_distinct(F.when(F.col("reason") != LOW, F.col("id"))).alias("sparse"), F.count_distinct(F.when(risky, F.col("id"))).alias("risky"))


def phase_checks(report: DataFrame) -> DataFrame:
    """(phase, status) of a report row with ``sources, source_errors, record_errors, source_only_languages, risky``."""
    checks = {
        "A": F.when((_c("sources") >= 30) & (_c("source_errors") == 0), "pass").otherwise("warning"),
        "B": F.when(_c("record_errors") > 0, "fail").otherwise("pass"),
        "C": F.lit("pass"),
        "D": F.lit("pass"),
        "E": F.when(_c("source_only_languages") > 0, "warning").otherwise("pass"),
        "F": F.when(_c("risky") > 0, "warning").otherwise("pass"),
        "G": F.lit("pass"),
    }
    return report.select(F.inline(F.array(*(F.struct(F.lit(p).alias("phase"), s.alias("status")) for p, s in checks.items()))))


#: Ids and sources that a message of the gate names.
NAMED_AT_MOST = 20


def gate(records: DataFrame, sources: DataFrame, crawl: DataFrame, previous: DataFrame | None, now: Column, failure_rate: float = FAILURE_RATE, drop_rate: float = DROP_RATE) -> DataFrame:
    """One row: the fifteen metrics, ``errors``, ``warnings`` (joined by line feeds), their numbers ``n_errors`` and ``n_warnings``, and ``passed``.

    crawl: one row ``(urls, failures)``. Without ``previous`` records, or with none in it, there is no drop rate. Limits must be shares.
    """
    if not (0 <= failure_rate <= 1 and 0 <= drop_rate <= 1):
        raise ValueError("limits are shares of 1")
    start, until = _c("available_from"), _c("booked_until")
    when = lambda c, name: F.count_if(c).alias(name)
    main = records.agg(
        F.count("*").alias("placements"),
        when(pl.contradictory(_c("status"), start, until), "contradictory"),
        when((_c("method") == "generic-parser") & (_c("review_status") != "needs-human-review"), "generic_published"),
        when(_c("confidence") == "low", "low_confidence"),
        when(_c("review_status") == "needs-human-review", "needing_review"),
        when(_c("status").isin("not-specified", "unclear"), "not_specified"),
        when(pl.past_day(start, until, now), "past_dates"),
    )
    known = sources.select(F.col("id").alias("source_id"))
    doubled = records.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    # a message names so many at most, the first ones, and says how many there are besides; ``gate_details`` has them all
    first_few = lambda c: F.array_join(F.slice(F.array_sort(F.collect_list(c)), 1, NAMED_AT_MOST), ", ")
    orphans = records.join(known, "source_id", "left_anti").groupBy("source_id").agg(F.count("*").alias("n"))
    parts = [
        main,
        sources.agg(F.count("*").alias("sources")),
        doubled.agg(F.count("*").alias("duplicate_ids")), doubled.orderBy("id").limit(NAMED_AT_MOST).agg(first_few("id").alias("duplicates")),
        orphans.agg(F.sum("n").alias("orphans"), F.count("*").alias("orphan_sources")), orphans.orderBy("source_id").limit(NAMED_AT_MOST).agg(first_few("source_id").alias("unknown_sources")),
        known.join(records.select("source_id"), "source_id", "left_anti").agg(F.count("*").alias("without_records")),
        crawl.select(F.col("urls").alias("urls"), F.col("failures").alias("crawl_failures")),
        (previous if previous is not None else records.limit(0)).agg(F.count("*").alias("previous")),
    ]
    row = parts[0]
    for p in parts[1:]:
        row = row.join(p, F.lit(True))
    if previous is None:
        row = row.withColumn("previous", F.lit(None).cast("long"))
    row = row.withColumns({
        "orphans": F.coalesce("orphans", F.lit(0)),
        "crawl_failure_rate": F.coalesce(F.try_divide("crawl_failures", "urls"), F.lit(0.0)),
        "drop_rate": F.when(_c("previous") > 0, F.greatest(F.lit(0.0), (_c("previous") - _c("placements")) / _c("previous"))),
    })
    said = lambda when, *words: F.when(when, F.concat(*(F.lit(w) if isinstance(w, str) else w.cast("string") for w in words)))
    percent = lambda c: F.format_string("%.1f", c.cast("double") * 100)
    beyond = lambda c: F.when(_c(c) > NAMED_AT_MOST, F.concat(F.lit(" and "), (_c(c) - NAMED_AT_MOST).cast("string"), F.lit(" more"))).otherwise("")
    errors = [
        said(_c("placements") == 0, "No placement records were generated."),
        said(_c("crawl_failure_rate") > failure_rate, "Crawl failure rate ", percent(_c("crawl_failure_rate")), f"% exceeds the configured {failure_rate * 100:.1f}% limit."),
        said(_c("drop_rate") > drop_rate, "Placement count dropped ", percent(_c("drop_rate")), "% from ", _c("previous"), " to ", _c("placements"), f", above the configured {drop_rate * 100:.1f}% limit."),
        said(_c("duplicate_ids") > 0, "Duplicate placement IDs: ", _c("duplicates"), beyond("duplicate_ids"), "."),
        said(_c("orphans") > 0, "Placements reference unknown source IDs: ", _c("unknown_sources"), beyond("orphan_sources"), "."),
        said(_c("contradictory") > 0, "Contradictory availability fields found on ", _c("contradictory"), " placement records."),
        said(_c("generic_published") > 0, _c("generic_published"), " generic-parser records bypass human review status."),
    ]
    warnings = [
        said(_c("past_dates") > 0, _c("past_dates"), " placement records contain an availability date in the past."),
        said(_c("without_records") > 0, _c("without_records"), " registered sources produced no placement records."),
    ]
    texts = {"errors": F.array_compact(F.array(*errors)), "warnings": F.array_compact(F.array(*warnings))}
    row = row.withColumns(texts).withColumns({"n_errors": F.size("errors"), "n_warnings": F.size("warnings"), **{c: F.array_join(c, "\n") for c in texts}})
    return row.withColumn("passed", _c("n_errors") == 0).drop("duplicates", "unknown_sources", "orphan_sources", "urls")


def gate_details(records: DataFrame, sources: DataFrame) -> DataFrame:
    """(violation, name, n) of all that the gate's messages speak of: ids that stand more than once, and sources that the registry lacks."""
    doubled = records.groupBy(F.col("id").cast("string").alias("name")).agg(F.count("*").alias("n")).filter("n > 1")
    unknown = records.join(sources.select(F.col("id").alias("source_id")), "source_id", "left_anti").groupBy(F.col("source_id").cast("string").alias("name")).agg(F.count("*").alias("n"))
    return doubled.select(F.lit("duplicate id").alias("violation"), "name", "n").unionByName(unknown.select(F.lit("unknown source").alias("violation"), "name", "n"))


MONTH, PARTIAL_DATE = r"^\d{4}-(?:0[1-9]|1[0-2])$", r"^\d{4}-(?:0[1-9]|1[0-2])(?:-\d{2})?$"
#: Columns of feedback; others are an error.
FEEDBACK = (
    "id", "placementId", "sourceId", "submittedAt", "submittedByRole", "feedbackType", "institutionName", "departmentNormalized", "currentValue", "suggestedValue", "evidenceType",
    "evidenceUrl", "evidenceNote", "confidenceSuggested", "status", "reviewerNote",
)


def broken(constraints: dict[str, Column]) -> Column:
    """Names of the constraints that do not hold; an unknown truth counts as broken."""
    return fired({n: ~F.coalesce(c, F.lit(False)) for n, c in constraints.items()})


def record_constraints() -> dict[str, Column]:
    date = lambda c: _c(c).isNull() | _c(c).rlike(PARTIAL_DATE)
    return {
        "low confidence has a warning": (_c("confidence") != "low") | (_c("n_warnings") > 0),
        "durations are in order": _c("min_weeks").isNull() | _c("max_weeks").isNull() | (_c("min_weeks") <= _c("max_weeks")),
        "dates are months or days": date("available_from") & date("booked_until"),
    }


def change_constraints() -> dict[str, Column]:
    return {"an availability change has both sides": (_c("change_type") != "availability-changed") | (_c("before").isNotNull() & _c("after").isNotNull())}


def summary_constraints() -> dict[str, Column]:
    return {"recommended months are in order": _c("apply_min").isNull() | _c("apply_max").isNull() | (_c("apply_min") <= _c("apply_max"))}


def report_constraints() -> dict[str, Column]:
    ahead = text_month_index(_c("start_month")) - text_month_index(_c("apply_month"))
    return {"months are months": _c("start_month").rlike(MONTH) & _c("apply_month").rlike(MONTH), "months ahead follow from the months": _c("months_ahead") == ahead}


def feedback_constraints(json: str = "json") -> dict[str, Column]:
    """Of feedback as JSON text: keys, notes and targets."""
    field = lambda name: F.get_json_object(_c(json), f"$.{name}")
    return {
        "no unknown keys": F.size(F.array_except(F.json_object_keys(_c(json)), F.array(*map(F.lit, FEEDBACK)))) == 0,
        "accepted feedback has a note": ~F.coalesce(field("status") == "accepted", F.lit(False)) | F.coalesce(F.trim(field("reviewerNote")) != "", F.lit(False)),
        "feedback has a target": F.coalesce(field("feedbackType") == "missing-hospital-source", F.lit(False)) | field("placementId").isNotNull() | field("sourceId").isNotNull(),
    }


def source_constraints() -> dict[str, Column]:
    return {
        "id is in kebab case": _c("id").rlike("^[a-z0-9]+(?:-[a-z0-9]+)*$"),
        "priority is 1 to 5": _c("priority").between(1, 5),
        "there is an address": F.size("urls") > 0,
        "canton is known": _c("canton").isin(*lex.CANTONS),
    }


def snapshot_constraints() -> dict[str, Column]:
    return {"status code is one": _c("status_code").isNull() | _c("status_code").between(100, 599)}
