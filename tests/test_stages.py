"""Stores, configuration, providers, and all stages with the stand-ins."""

import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera import schemas
from tessera.functions import prompts
from tessera.operators import topics
from tessera.plans.rounds import generate
from tessera.plans.stages import Stages
from tessera.sources import providers as P
from tessera.sources.config import Config, load, override
from tessera.sources.corpus import load_corpus
from tessera.sources.store import load_env, read_keyed, read_manifest, write_keyed, write_manifest


def test_keyed_lines(spark, tmp_path):
    at = str(tmp_path / "x.jsonl")
    assert read_keyed(spark, at, schemas.QE).isEmpty()
    (tmp_path / "x.jsonl").write_text('{"id":"a","cometkiwi_score":1}\n\n{"id":"b","more":2}\n{"id":"a","cometkiwi_score":2}\n')
    got = {r.id: r.cometkiwi_score for r in read_keyed(spark, at, schemas.QE).collect()}
    assert got == {"a": 2.0, "b": None}
    rows = read_keyed(spark, at, schemas.QE).withColumn("cometkiwi_model", F.lit("é"))
    write_keyed(rows, at)  # what is read may be replaced
    lines = [json.loads(x) for p in sorted((tmp_path / "x.jsonl").glob("part*.json")) for x in p.read_text().splitlines()]
    assert [x["id"] for x in lines] == ["a", "b"] and lines[1]["cometkiwi_score"] is None and lines[0]["cometkiwi_model"] == "é"
    (tmp_path / "bad.jsonl").write_text('{"id":\n')
    with pytest.raises(Exception):
        read_keyed(spark, str(tmp_path / "bad.jsonl"), schemas.QE).collect()


def test_manifest(spark, tmp_path):
    at = str(tmp_path / "sub" / "m.json")
    assert read_manifest(spark, at, {"a": 1}) == {"a": 1}
    write_manifest(spark, at, {"b": {"c": "é"}})
    assert read_manifest(spark, at) == {"b": {"c": "é"}}


def test_env(tmp_path, monkeypatch):
    monkeypatch.setenv("HAS", "old")
    monkeypatch.delenv("NEW_ONE", raising=False)
    (tmp_path / ".env").write_text("# c\nNEW_ONE='v=1'\nHAS=new\nnothing\n")
    load_env(str(tmp_path / ".env"))
    assert os.environ["NEW_ONE"] == "v=1" and os.environ["HAS"] == "old"


def test_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"sampling": {"sample_size": 9}, "judge": {"judge_min_adequacy": 3.5}, "junk": 1, "paths": {"output": "x/y"}}))
    c = load(tmp_path / "c.json")
    assert (c.sample_size, c.judge_min_accuracy, str(c.output)) == (9, 3.5, "x/y")
    assert override(c, limit=3).sample_size == 3 and override(c, dry_run=True).dry_run and override(c).sample_size == 9


def test_corpus_fallback(spark, tmp_path):
    spark.createDataFrame([("t",)], "text string").write.parquet(str(tmp_path / "c"))
    rows, name, failed = load_corpus(spark, str(tmp_path / "missing"), str(tmp_path / "c"))
    assert rows.count() == 1 and name.endswith("/c") and len(failed) == 1
    with pytest.raises(RuntimeError):
        load_corpus(spark, str(tmp_path / "missing"))


def test_answers():
    assert P.answer_of({"choices": [{"message": {"content": " "}, "text": "b"}]}) == "b"
    assert P.answer_of({"choices": [{"message": {"content": ["a", {"text": "b"}, {"content": "c"}, 3]}}]}) == "abc"
    assert P.answer_of({"response": {"output_text": "z"}}) == "z"
    with pytest.raises(RuntimeError):
        P.answer_of({"choices": []})


def test_answer_column(spark):
    rows = spark.createDataFrame([('{"choices":[{"message":{"content":" "},"text":"b "}]}',), ("{}",)], "j string")
    assert [r[0] for r in rows.select(P.answer_column(F.col("j"))).collect()] == ["b", None]


def test_pace_and_retries():
    now, slept = [0.0], []
    pace = P.Pace(30, clock=lambda: now[0], sleep=lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    for _ in range(3):
        pace.wait()
    assert slept == [2.0, 2.0]
    waits, calls = [], []

    def call():
        calls.append(1)
        if len(calls) < 4:
            raise P.Overloaded("busy")
        return b"ok"

    assert P.retried(call, 3, waits.append) == b"ok" and waits == [5.0, 10.0, 20.0]
    with pytest.raises(ValueError):
        P.retried(lambda: (_ for _ in ()).throw(ValueError()), 3, waits.append)
    with pytest.raises(ValueError):
        P.chat_of("nobody", Config())
    with pytest.raises(RuntimeError):
        P.chat_of("http", Config(api_key_env="NOT_SET_ANYWHERE"))


def test_content_of_objects():
    """In an object the text comes before the content; in a message it is the other way round."""
    assert P.content_of({"text": "a", "content": "b"}) == "a" and P.content_of({"text": " ", "output_text": "c"}) == "c"
    assert P.answer_of({"choices": [{"message": {"text": "a", "content": "b"}}]}) == "b"
    assert P.answer_of({"choices": [{"message": {"content": {"text": "a", "content": "b"}}}]}) == "a"


CONFIGURED = {
    "generation": {"generator_provider": "far_api", "generator_model": "g"},
    "api": {"api_base_url": "https://example.invalid/v1", "api_key_env": "SOME_KEY", "requests_per_minute": 12, "api_concurrency": 3},
    "judge": {"enable_judge": True, "judge_provider": "near_local", "judge_mode": "all"},
    "qwen3vl": {"qwen3vl_model": "some/model", "qwen3vl_dtype": "bfloat16", "qwen3vl_max_new_tokens": 7},
    "qa": {"enable_cometkiwi": True, "cometkiwi_model": "some/estimator", "cometkiwi_gpus": None},
}


def test_configured_providers(tmp_path, monkeypatch):
    """Provider names of configuration files dispatch by their kind; nothing falls back to a stand-in."""
    (tmp_path / "c.json").write_text(json.dumps(CONFIGURED))
    c = load(tmp_path / "c.json")
    monkeypatch.setenv("SOME_KEY", "k")
    far, near = P.chat_of(c.generator_provider, c), P.chat_of(c.judge_provider, c)
    assert isinstance(far, P.HttpChat) and far.base_url == "https://example.invalid/v1" and far.per_minute == 4
    assert isinstance(near, P.LocalChat) and near.load == P.LocalModel("some/model", "bfloat16", "auto", None) and near.max_new_tokens == 7
    with pytest.raises(ValueError):
        P.chat_of("near_local", c, kinds=("http",))
    monkeypatch.setattr(P, "find_spec", lambda name: None)
    with pytest.raises(RuntimeError):
        P.scorer_of(c)
    monkeypatch.setattr(P, "find_spec", lambda name: name)
    scorer = P.scorer_of(c)
    assert scorer.load == P.QeModel("some/estimator", 8, None) and scorer.load.resolved_gpus() == 0
    assert P.QeModel("m", gpus=-2).resolved_gpus() == 0 and P.QeModel("m", gpus=3).resolved_gpus() == 3
    P.register_scorer("some/estimator", lambda config: P.FakeScorer())
    try:
        assert isinstance(P.scorer_of(c), P.FakeScorer)
    finally:
        P._SCORERS.pop("some/estimator")


def test_scoring_without_a_scorer_fails(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "find_spec", lambda name: None)
    config = Config(cometkiwi_model="real/model", output=tmp_path / "r", cometkiwi_output=tmp_path / "q")
    with pytest.raises(RuntimeError):
        Stages(spark, config).run("cometkiwi")
    assert not (tmp_path / "q").exists()


def test_models_behind_their_packages(monkeypatch):
    """The local model and the estimator against stand-ins of their packages: arguments, the prompt's tokens stripped, scores as floats."""
    import sys
    from contextlib import nullcontext
    from types import SimpleNamespace as N

    calls = {}

    class Asked(dict):
        def to(self, device):
            return self

    class Reader:
        def apply_chat_template(self, messages, **options):
            calls["messages"] = messages
            return Asked(input_ids=[[1, 2, 3]])

        def batch_decode(self, ids, **options):
            return [" ".join(map(str, r)) + " " for r in ids]

    model = N(device="cpu", eval=lambda: None, generate=lambda input_ids, max_new_tokens, do_sample: [[*input_ids[0], 8, 9][: 3 + max_new_tokens]])
    kinds = N(AutoProcessor=N(from_pretrained=lambda name: Reader()), AutoModelForImageTextToText=N(from_pretrained=lambda name, **o: calls.update(o) or model))
    monkeypatch.setitem(sys.modules, "torch", N(bfloat16="b16", inference_mode=nullcontext, cuda=N(is_available=lambda: True)))
    monkeypatch.setitem(sys.modules, "transformers", kinds)
    chat = P.LocalChat(P.LocalModel("m/1", attention="x"), 2)
    assert chat.chat("unused", [{"role": "user", "content": "hi"}]) == "8 9"
    assert calls["torch_dtype"] == "b16" and calls["attn_implementation"] == "x" and calls["messages"][0]["content"] == [{"type": "text", "text": "hi"}]
    with pytest.raises(ValueError):
        P.LocalModel("m/2", "int7")()
    predict = lambda data, batch_size, gpus: N(scores=[len(d["src"]) + batch_size + gpus for d in data])
    monkeypatch.setitem(sys.modules, "comet", N(download_model=lambda name: name, load_from_checkpoint=lambda at: N(predict=predict)))
    assert P.ModelScorer(P.QeModel("m/3", 4)).score([{"src": "ab", "mt": ""}]) == [7.0]


def test_local_model_loads_once():
    loads = []
    chat = P.LocalChat(lambda: (loads.append(1), lambda parts, n: f" {parts[0]['content'][0]['text']}{n} ")[1])
    assert [chat.chat("m", [{"role": "user", "content": "x"}]) for _ in range(2)] == ["x1024", "x1024"] and loads == [1]


def test_prompts(spark):
    rows = spark.createDataFrame([("S", "R")], "s string, r string")
    plain, strict, judge, parts = rows.select(
        prompts.generation(F.col("s")), prompts.generation(F.col("s"), True), prompts.judging(F.col("s"), F.col("r")), prompts.multimodal(prompts.generation(F.col("s")))
    ).first()
    assert [m.role for m in plain] == ["system", "user"] and plain[1].content == "<text>\nS\n</text>" and len(strict[1].content) > len(plain[1].content)
    assert "<source>\nS\n</source>" in judge[1].content and "overall" in judge[1].content
    assert parts[1].content[0].text == plain[1].content and parts[1].content[0].type == "text"


def stub(bad=()):
    """Passes a text of markers, but fails for some sources. A local class, so that workers need no test module."""

    class Chat:
        def chat(self, model, messages, temperature=0.0, max_tokens=0):
            if any(b in messages[-1]["content"] for b in bad):
                raise RuntimeError("no")
            return "yang dan di ke dari"

    return Chat()


def rows_of(spark, names):
    return spark.createDataFrame([(f"e{k}", f"w {n} x y", n, 4, 7, "short") for k, n in enumerate(names)], "id string, source string, source_id string, source_word_count int, source_char_count int, source_length_bucket string")


def test_rounds_replace(spark):
    spare = rows_of(spark, ["p", "q", "r"]).drop("id").withColumn("cand_rank", F.row_number().over(Window.partitionBy("source_length_bucket").orderBy("source_id")))
    config = Config(max_retries=1, max_replacements=2)
    made = generate(rows_of(spark, ["a", "b"]), spare, stub(bad=(" a ", " p ")), config)
    got = {r.id: (r.source_id, r.retry_count, r.replacement_count) for r in made.qa.collect()}
    assert got == {"e0": ("q", 0, 2), "e1": ("b", 0, 0)} and made.records.count() == 2 and made.exhausted.isEmpty()
    with pytest.raises(RuntimeError):
        generate(rows_of(spark, ["a"]), spare.limit(0), stub(bad=(" a ",)), config)
    lost = generate(rows_of(spark, ["a"]), spare.limit(0), stub(bad=(" a ",)), config, fail_on_exhaustion=False)
    assert [r.status for r in lost.exhausted.collect()] == ["generation_error"] and lost.records.isEmpty()


def test_all_stages(spark, tmp_path):
    words = [f"w{chr(97 + k % 26)}{'x' * (k // 26)}" for k in range(60)]
    spark.createDataFrame([(" ".join(words[:n]),) for n in range(12, 60, 2)], "text string").write.parquet(str(tmp_path / "corpus"))
    config = Config(
        dataset_name=str(tmp_path / "corpus"), sample_size=6, min_words=10, enable_cometkiwi=True, enable_judge=True, judge_mode="all",
        **{n: tmp_path / n for n in ("output", "qa_output", "manifest_output", "cometkiwi_output", "judge_output")},
    )
    Stages(spark, override(config, dry_run=True)).run("generate")
    assert not (tmp_path / "output").exists() and (tmp_path / "manifest_output").exists()
    Stages(spark, config).run("all")
    counts = read_manifest(spark, str(tmp_path / "manifest_output"))["final_counts"]
    assert counts["records"] == counts["qa_records"] == 6 == counts["accepted"] + counts["accepted_with_soft_flags"]
    before = {r.id: r.source for r in read_keyed(spark, str(config.output), schemas.RECORD).collect()}
    Stages(spark, override(config, resume=True)).run("all")
    assert before == {r.id: r.source for r in read_keyed(spark, str(config.output), schemas.RECORD).collect()}
    soft = counts["soft_qa_flagged"]
    Stages(spark, config).run("remediate")
    assert read_keyed(spark, str(config.cometkiwi_output), schemas.QE).count() == 6 - soft
    with pytest.raises(ValueError):
        Stages(spark, config).run("other")


def test_topics_against_dense(spark):
    import numpy as np

    texts = ["red green blue apple", "red red green stone", "blue stone apple river", "river stone water red", "water river green", "sky"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    counts = topics.term_counts(rows)
    words = topics.vocabulary(counts, 6, min_docs=2)
    weighted = topics.weights(counts, words, 6)
    terms = [r.term for r in words.collect()]
    matrix = topics.gram(weighted, terms)
    dense = np.zeros((6, len(terms)))
    for r in weighted.collect():
        dense[r.doc_id, terms.index(r.term)] = r.weight
    assert np.allclose(matrix, dense.T @ dense) and matrix.trace() == pytest.approx((dense.any(axis=1)).sum())
    found, shares = topics.components(matrix, 2)
    got = {r.doc_id: r.topic for r in topics.assigned(weighted, topics.loadings(spark, found, terms)).collect()}
    want = np.abs(dense @ found.T).argmax(axis=1)
    assert all(got[k] == f"topic_{want[k] + 1:02d}" for k in got) and shares.sum() <= 1


def test_streaming_ingest(spark, tmp_path):
    from tessera.streaming.ingest import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id":"a","cometkiwi_score":1}\n{"id":"a","cometkiwi_score":2}\n')
    go = lambda: ingest(spark, str(tmp_path / "in"), schemas.QE, str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()
    go()
    (tmp_path / "in" / "b.json").write_text('{"id":"a","cometkiwi_score":3}\n{"id":"b"}\n')
    go()
    assert {r.id: r.cometkiwi_score for r in read_keyed(spark, str(tmp_path / "t"), schemas.QE).collect()} == {"a": 3.0, "b": None}
