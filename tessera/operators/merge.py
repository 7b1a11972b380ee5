"""Scores merged into QA rows, statuses and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import constants as C


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with one key, the one that stands last."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def upsert(existing: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """All of ``new``, and of ``existing`` what it doesn't replace."""
    return new.unionByName(existing.join(new.select(key), key, "left_anti"), allowMissingColumns=True)


def pending(rows: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    return rows.join(done.select(key), key, "left_anti")


def first_by_id(rows: DataFrame, n: int | None, key: str = "id") -> DataFrame:
    rows = rows.orderBy(key)
    return rows if n is None else rows.limit(n)


def without(flags: Column, *names: str) -> Column:
    return F.filter(flags, lambda f: ~f.isin(*names))


def with_flag(flags: Column, name: Column | str, when: Column) -> Column:
    """``name`` at the end if ``when`` holds and it isn't there yet."""
    name = F.lit(name) if isinstance(name, str) else name
    return F.when(F.coalesce(when, F.lit(False)) & ~F.array_contains(flags, name), F.array_append(flags, name)).otherwise(flags)


def with_note(notes: Column, note: Column, when: Column) -> Column:
    """A note is added once, however often a merge is repeated."""
    return with_flag(F.coalesce(notes, F.array().cast("array<string>")), note, when)


def valid_score(score: str = "cometkiwi_score", error: str = "cometkiwi_error") -> Column:
    return F.col(score).isNotNull() & F.nullif(F.col(error), F.lit("")).isNull()


def qe_threshold(scores: DataFrame) -> DataFrame:
    """One row: the higher of the tenth percentile and the lower whisker, over valid scores; null without any."""
    q = F.percentile("cometkiwi_score", F.array(*map(F.lit, (0.10, 0.25, 0.75))))
    one = scores.where(valid_score()).agg(q.alias("q"))
    low = F.col("q")[1] - 1.5 * (F.col("q")[2] - F.col("q")[1])
    return one.select(F.greatest(F.col("q")[0], low).alias("threshold"))


def merge_qe(qa: DataFrame, scores: DataFrame) -> DataFrame:
    """QE scores into QA. A score without value counts as an error. Without valid scores QA stays as it is."""
    found = scores.select("id", F.col("cometkiwi_score").alias("__score"), F.coalesce(F.nullif("cometkiwi_error", F.lit("")), F.when(F.col("cometkiwi_score").isNull(), F.lit("no score"))).alias("__error"), F.lit(True).alias("__met"))
    rows = qa.join(found, "id", "left").crossJoin(F.broadcast(qe_threshold(scores)))
    met = F.coalesce(F.col("__met"), F.lit(False)) & F.col("threshold").isNotNull()
    bad, low = F.col("__error").isNotNull(), F.col("__score") <= F.col("threshold")
    flags = without(F.col("flags"), C.QE_LOW, C.QE_ERROR)
    flags = with_flag(with_flag(flags, C.QE_ERROR, bad), C.QE_LOW, ~bad & low)
    note = F.concat(F.lit("cometkiwi_error: "), F.col("__error"))
    new = {
        "flags": flags,
        "notes": with_note(F.col("notes"), note, bad),
        "cometkiwi_score": F.when(~bad, F.bround("__score", 4)),
        "cometkiwi_threshold": F.bround("threshold", 4),
        "cometkiwi_flagged": bad | low,
    }
    rows = rows.select(*[(F.when(met, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c)) for c in qa.columns])
    return rows


def merge_judge(qa: DataFrame, results: DataFrame) -> DataFrame:
    found = results.select(
        "id", F.col("judge_score").alias("__score"), F.coalesce("judge_flagged", F.lit(False)).alias("__flagged"), F.col("judge_raw_response").alias("__raw"),
        F.nullif("judge_error", F.lit("")).alias("__error"), F.lit(True).alias("__met"),
    )
    rows = qa.join(found, "id", "left")
    met, bad = F.coalesce(F.col("__met"), F.lit(False)), F.col("__error").isNotNull()
    flags = without(F.col("flags"), C.JUDGE_LOW, C.JUDGE_ERROR)
    flags = with_flag(with_flag(flags, C.JUDGE_ERROR, bad), C.JUDGE_LOW, ~bad & F.col("__flagged"))
    new = {
        "flags": flags,
        "notes": with_note(F.col("notes"), F.concat(F.lit("judge_error: "), F.col("__error")), bad),
        "judge_selected": F.lit(True),
        "judge_skip_reason": F.lit(None).cast("string"),
        "judge_score": F.col("__score"),
        "judge_flagged": F.col("__flagged"),
        "judge_raw_response": F.col("__raw"),
    }
    return rows.select(*[(F.when(met, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c)) for c in qa.columns])


def soft_failed() -> Column:
    return F.coalesce(F.col("cometkiwi_flagged"), F.lit(False)) | F.coalesce(F.col("judge_flagged"), F.lit(False))


def with_status(qa: DataFrame) -> DataFrame:
    passed = F.coalesce(F.col("hard_gate_passed"), F.lit(False))
    return qa.withColumn("status", F.when(passed & ~soft_failed(), C.ACCEPTED).when(passed, C.SOFT).otherwise(F.col("status")))


def finalised(qa: DataFrame, scores: DataFrame | None = None, results: DataFrame | None = None) -> DataFrame:
    qa = merge_qe(qa, scores) if scores is not None else qa
    qa = merge_judge(qa, results) if results is not None else qa
    return with_status(qa)


def to_remediate(qa: DataFrame) -> DataFrame:
    return qa.where(F.coalesce(F.col("hard_gate_passed"), F.lit(False)) & soft_failed())


def qe_stats(qa: DataFrame, scores: DataFrame) -> DataFrame:
    """merged, flagged, errors, threshold of a QE merge; without valid scores every row is an error."""
    known = scores.join(qa.select("id"), "id", "left_semi")
    one = known.crossJoin(F.broadcast(qe_threshold(scores)))
    bad = ~valid_score()
    got = one.agg(
        F.count("*").alias("merged"), F.count_if(~bad & (F.col("cometkiwi_score") <= F.col("threshold"))).alias("flagged"), F.count_if(bad).alias("errors"), F.bround(F.max("threshold"), 4).alias("threshold")
    )
    whole = scores.agg(F.count("*").alias("all"), F.count_if(valid_score()).alias("valid"))
    none = F.col("valid") == 0
    return got.crossJoin(F.broadcast(whole)).select(
        F.when(none, 0).otherwise(F.col("merged")).alias("merged"), F.when(none, 0).otherwise(F.col("flagged")).alias("flagged"),
        F.when(none, F.col("all")).otherwise(F.col("errors")).alias("errors"), F.when(~none, F.col("threshold")).alias("threshold"),
    )


def judge_stats(qa: DataFrame, results: DataFrame, errors_flagged: bool = False) -> DataFrame:
    """merged, flagged, errors of a judge merge; an error counts as flagged only on request."""
    known = results.join(qa.select("id"), "id", "left_semi")
    bad = F.nullif("judge_error", F.lit("")).isNotNull()
    flagged = F.coalesce(F.col("judge_flagged"), F.lit(False)) & (F.lit(errors_flagged) | ~bad)
    return known.agg(F.count("*").alias("merged"), F.count_if(flagged).alias("flagged"), F.count_if(bad).alias("errors"))


def final_counts(records: DataFrame, qa: DataFrame) -> DataFrame:
    passed = F.coalesce(F.col("hard_gate_passed"), F.lit(False))
    one = qa.agg(
        F.count("*").alias("qa_records"), F.count_if(F.col("status") == C.ACCEPTED).alias("accepted"), F.count_if(F.col("status") == C.SOFT).alias("accepted_with_soft_flags"),
        F.count_if(~passed).alias("hard_gate_failures"), F.count_if(soft_failed()).alias("soft_qa_flagged"),
    )
    return records.agg(F.count("*").alias("records")).crossJoin(F.broadcast(one))


def qa_of(records: DataFrame, qa: DataFrame) -> DataFrame:
    """A QA row for each record; where there is none, a default one with the record's id as source id."""
    found = qa.withColumn("__met", F.lit(True))
    rows = records.select("id", F.col("source_length_bucket").alias("__b"), F.col("source_word_count").alias("__w")).join(found, "id", "left")
    lacks = F.col("__met").isNull()
    new = {
        "source_id": F.col("id"), "status": F.lit(C.ACCEPTED), "flags": F.array().cast("array<string>"), "notes": F.array().cast("array<string>"), "hard_gate_passed": F.lit(True),
        "source_length_bucket": F.col("__b"), "source_word_count": F.col("__w"),
    }
    return rows.select(*[(F.when(lacks, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c)) for c in qa.columns])
