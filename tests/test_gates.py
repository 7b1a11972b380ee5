import pytest
from pyspark.sql import functions as F

from tessera import constants as C
from tessera.functions import text as T
from tessera.operators import gates, merge

MARK = "yang dan di ke dari "


def gated(spark, source, reference):
    rows = spark.createDataFrame([("a", source, reference)], "id string, source string, reference string")
    return gates.hard_gates(rows.withColumn("source_word_count", T.word_count(F.col("source")))).first()


def test_empty_reference(spark):
    for blank in ("  ", None):
        assert gated(spark, "w " * 10, blank).flags == [C.EMPTY, C.LANGUAGE, C.RATIO]


@pytest.mark.parametrize("words,bad", [(4, False), (22, False), (3, True), (23, True)])
def test_ratio_bounds(spark, words, bad):
    assert (C.RATIO in gated(spark, "w " * 10, "yang " * words).flags) == bad


@pytest.mark.parametrize("items,kept,bad", [(3, 0, True), (3, 1, False), (10, 3, True), (10, 4, False), (2, 0, False)])
def test_list_gate(spark, items, kept, bad):
    got = gated(spark, "\n".join(["- x"] * items), MARK + "\n" + "\n".join(["- y"] * kept))
    assert (C.LISTS in got.flags) == bad


def test_heading_gate(spark):
    assert C.HEADINGS not in gated(spark, "1. a\n2. b", MARK + "\n2. c\n9. d").flags
    assert C.HEADINGS in gated(spark, "1. a\n2. b", MARK + "\n9. d").flags


VERDICTS = [
    ('{"overall":4,"accuracy":4}', False), ('{"overall":4.5,"adequacy":3.9}', True), ('{"overall":5,"accuracy":5,"readability":2}', True),
    ('{"overall":5,"accuracy":5,"critical_error":"yes"}', True), ('{"accuracy":5}', True), ("so: ```json\n{\"overall\":5,\"accuracy\":\"5\"}\n``` done", False), ("{bad", None), ("5", None), ("null", None),
]


def test_verdicts(spark):
    rows = spark.createDataFrame([(str(k), v) for k, (v, _) in enumerate(VERDICTS)], "id string, response string")
    for r in gates.judged(rows).collect():
        want = VERDICTS[int(r.id)][1]
        assert r.judge_flagged == (want is not False) and (r.judge_error is not None) == (want is None), VERDICTS[int(r.id)]


def test_selection(spark):
    rows = spark.createDataFrame([("clean", [], None), ("qe", [C.QE_LOW], True), ("hard", [C.LISTS], False)], "id string, flags array<string>, cometkiwi_flagged boolean")
    pick = lambda **k: {r.id for r in rows.where(gates.judge_selected(**k)).collect()}
    assert pick(mode="all") == {"clean", "qe", "hard"}
    assert pick(mode="flagged") == {"qe", "hard"} == pick(mode="sample", audit_rate=0.0)
    assert pick(mode="flagged", forced=["clean"]) == {"clean", "qe", "hard"} == pick(mode="sample", audit_rate=1.0)


def qe_rows(spark, scores):
    return spark.createDataFrame([(str(k), None if isinstance(s, str) else s, s if isinstance(s, str) else None) for k, s in enumerate(scores)], "id string, cometkiwi_score double, cometkiwi_error string")


def qa_rows(spark, n):
    return spark.createDataFrame([(str(k),) for k in range(n)], "id string").select(
        "id", F.array().cast("array<string>").alias("flags"), F.lit(None).cast("array<string>").alias("notes"), F.lit(True).alias("hard_gate_passed"), F.lit("accepted").alias("status"), F.lit(None).cast("double").alias("cometkiwi_score"),
        F.lit(None).cast("double").alias("cometkiwi_threshold"), F.lit(None).cast("boolean").alias("cometkiwi_flagged"), F.lit(None).cast("boolean").alias("judge_flagged"),
    )


def test_qe_threshold_and_merge(spark):
    scores = qe_rows(spark, [round(0.1 * k, 1) for k in range(1, 11)])
    assert merge.qe_threshold(scores).first()[0] == pytest.approx(0.19)
    done = merge.merge_qe(merge.merge_qe(qa_rows(spark, 10), scores), scores)
    assert [r.id for r in done.where("cometkiwi_flagged").collect()] == ["0"]
    assert done.where("id = '0'").first().flags == [C.QE_LOW]


def test_qe_without_valid_scores(spark):
    qa, scores = qa_rows(spark, 2), qe_rows(spark, ["x", "y"])
    assert merge.merge_qe(qa, scores).collect() == qa.collect()
    assert merge.qe_stats(qa, scores).first().asDict() == {"merged": 0, "flagged": 0, "errors": 2, "threshold": None}


def test_status_and_notes(spark):
    qa = qa_rows(spark, 4).withColumn("hard_gate_passed", F.col("id") != "3").withColumn("status", F.when(F.col("id") == "3", C.FAILED).otherwise("x"))
    scores = qe_rows(spark, ["broken", 0.9, 0.95, 0.1])
    twice = merge.finalised(merge.finalised(qa, scores), scores)
    got = {r.id: r for r in twice.collect()}
    assert [got[k].status for k in "0123"] == [C.SOFT, C.ACCEPTED, C.ACCEPTED, C.FAILED]
    assert got["0"].notes == ["cometkiwi_error: broken"]


def test_default_qa(spark):
    records = spark.createDataFrame([("r", "short", 5)], "id string, source_length_bucket string, source_word_count int")
    qa = qa_rows(spark, 0).withColumns({"source_id": F.col("id"), "source_length_bucket": F.lit("x"), "source_word_count": F.lit(0)})
    assert merge.qa_of(records, qa).first().source_id == "r"
