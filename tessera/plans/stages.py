"""The stages: generate, score, judge, finalize, remediate; each reads and replaces keyed files."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.functions import prompts
from tessera.functions import text as T
from tessera.operators import gates, merge, pool
from tessera.plans.rounds import as_qa, attempt, generate, record_of
from tessera.session import written
from tessera.sources.config import Config
from tessera.sources.corpus import load_corpus
from tessera.sources.providers import Chat, Scorer, answered, chat_of, is_local, scored, scorer_of
from tessera.sources.store import exists, load_env, read_keyed, read_manifest, write_keyed, write_manifest

# Names of the stages.
ALL = ["generate", "cometkiwi", "judge", "finalize"]
STAGES = [*ALL, "remediate", "all"]


def now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def generator_of(config: Config) -> Chat:
    """Texts are generated over HTTP or by a registered provider; local models only judge."""
    return chat_of(config.generator_provider, config, kinds=("http",))


class Stages:
    """Runs stages over one configuration. Providers may be passed in; else they come from the registry."""

    def __init__(self, spark: SparkSession, config: Config, chat: Chat | None = None, judge: Chat | None = None, scorer: Scorer | None = None):
        self.spark, self.config, self._chat, self._judge, self._scorer = spark, config, chat, judge, scorer

    def run(self, stage: str) -> None:
        if stage not in STAGES:
            raise ValueError(f"unknown stage {stage}; known: {', '.join(STAGES)}")
        load_env()
        for name in ALL if stage == "all" else [stage]:
            enabled = {"cometkiwi": self.config.enable_cometkiwi, "judge": self.config.enable_judge}.get(name, True)
            if enabled or stage != "all":
                getattr(self, name)()

    def _read(self, what: str) -> DataFrame:
        at, schema = {
            "records": (self.config.output, schemas.RECORD), "qa": (self.config.qa_output, schemas.QA),
            "qe": (self.config.cometkiwi_output, schemas.QE), "judge": (self.config.judge_output, schemas.JUDGE),
        }[what]
        return read_keyed(self.spark, str(at), schema, defaults=schemas.QA_DEFAULTS if what == "qa" else None)

    # The keys of manifests.

    def manifest(self, source: str, eligible: int, buckets: dict[str, int]) -> dict:
        c = self.config
        return {
            "created_at_utc": now(), "dataset_source": source, "source_language": "en", "target_language": "id",
            "sampling": {"sample_size": c.sample_size, "min_words": c.min_words, "seed": c.seed, "eligible_rows": eligible, "bucket_counts": dict(sorted(buckets.items())), "strategy": "equal allocation over source word-count terciles"},
            "generation": {"provider": c.generator_provider, "model": c.generator_model, "max_retries": c.max_retries, "max_replacements": c.max_replacements, "chunking": "disabled", "requests_per_minute": c.requests_per_minute, "concurrency": max(1, c.api_concurrency)},
            "qa": {
                "sanity_checks": "enabled", "length_ratio_min": c.length_ratio_min, "length_ratio_max": c.length_ratio_max, "copy_rate_max": c.copy_rate_max, "cometkiwi_enabled": c.enable_cometkiwi,
                "judge": {"enabled": c.enable_judge, "provider": c.judge_provider, "model": c.judge_model_id, "mode": c.judge_mode},
            },
            "outputs": {"dataset": str(c.output), "qa": str(c.qa_output), "cometkiwi": str(c.cometkiwi_output), "judge": str(c.judge_output), "manifest": str(c.manifest_output)},
        }

    def sampled(self) -> tuple[DataFrame, DataFrame, str, DataFrame]:
        corpus, source, _ = load_corpus(self.spark, self.config.dataset_name)
        eligible = pool.eligible_pool(corpus, self.config.min_words)
        chosen = written(pool.with_texts(pool.sample(eligible, self.config.sample_size, self.config.seed), corpus))
        pool.check_sample(chosen, self.config.sample_size, self.config.min_words)
        return eligible, chosen, source, corpus

    def generate(self) -> None:
        eligible, chosen, source, corpus = self.sampled()
        counts = {r[0]: r[1] for r in chosen.groupBy("source_length_bucket").count().collect()}
        write_manifest(self.spark, str(self.config.manifest_output), self.manifest(source, eligible.count(), counts))
        if self.config.dry_run:
            return
        records, qa = self._read("records"), self._read("qa")
        if not self.config.resume:
            records, qa = records.limit(0), qa.limit(0)
        todo = merge.pending(chosen, records)
        # Sources of earlier runs, replacements included, aren't candidates again.
        used = chosen.select("source_id").unionByName(qa.select("source_id"))
        most = pool.most_replacements(self.config.sample_size, self.config.max_replacements)
        spare = written(pool.with_texts(pool.replacements(eligible, used, most, self.config.seed), corpus))
        made = generate(todo, spare, self._chat or generator_of(self.config), self.config)
        new_qa = gates.mark_pending(made.qa, self.config.enable_judge)
        write_keyed(written(merge.upsert(records, made.records)), str(self.config.output))
        write_keyed(written(merge.upsert(qa, new_qa)), str(self.config.qa_output))

    def cometkiwi(self) -> None:
        """Scores records that have no score yet (all of them without resume)."""
        done = self._read("qe") if self.config.resume else self._read("qe").limit(0)
        todo = merge.pending(merge.first_by_id(self._read("records"), self.config.sample_size), done)
        if self.config.dry_run:
            return
        new = scored(todo, self._scorer or scorer_of(self.config), self.config.cometkiwi_model, self.config.cometkiwi_batch_size)
        new = written(new.withColumn("created_at_utc", T.utc_now()))
        write_keyed(written(merge.upsert(done, new)), str(self.config.cometkiwi_output))

    def judge(self) -> None:
        c = self.config
        done = self._read("judge") if c.resume else self._read("judge").limit(0)
        records = merge.first_by_id(self._read("records"), c.sample_size)
        qa = merge.qa_of(records, self._read("qa"))
        picked = qa.where(gates.judge_selected(c.judge_mode, c.judge_random_audit_rate, c.seed)).select("id")
        todo = merge.pending(records, done).join(picked, "id", "left_semi")
        if c.dry_run:
            return
        asked = todo.select("id", prompts.judging(F.col("source"), F.col("reference")).alias("messages"))
        answers = written(answered(asked, self._judge or chat_of(c.judge_provider, c), c.judge_model_id, partitions=1 if is_local(c.judge_provider) else c.api_concurrency, max_tokens=1024))
        new = gates.judged(answers, error="error")
        new = new.select("id", F.lit(c.judge_provider).alias("judge_provider"), F.lit(c.judge_model_id).alias("judge_model"), "judge_score", "judge_flagged", "judge_raw_response", "judge_error", T.utc_now().alias("created_at_utc"))
        write_keyed(written(merge.upsert(done, new)), str(c.judge_output))

    def finalize(self) -> None:
        c = self.config
        records, qa = self._read("records"), self._read("qa")
        if records.isEmpty() or qa.isEmpty():
            raise RuntimeError("finalize needs records and QA rows")
        scores = self._read("qe") if exists(self.spark, str(c.cometkiwi_output)) else None
        results = self._read("judge") if exists(self.spark, str(c.judge_output)) else None
        done = written(merge.finalised(qa, scores, results))
        qe = merge.qe_stats(qa, scores).first().asDict() if scores is not None else {}
        judge = merge.judge_stats(qa, results).first().asDict() if results is not None else {}
        counts = merge.final_counts(records, done).first().asDict()
        write_keyed(done, str(c.qa_output))
        manifest = read_manifest(self.spark, str(c.manifest_output), {"created_at_utc": now(), "outputs": {"manifest": str(c.manifest_output)}})
        stages = manifest.get("stages", {}) | {"finalize": {"completed_at_utc": now(), "cometkiwi_stats": qe, "judge_stats": judge}}
        write_manifest(self.spark, str(c.manifest_output), manifest | {"completed_at_utc": now(), "stages": stages, "final_counts": counts})

    def remediate(self) -> None:
        """Soft-flagged rows are generated once more, strictly; where the gates pass, record and QA row are replaced.

        Scores of replaced rows are dropped from the score files, so that a later merge can't bring them back.
        """
        c = self.config
        records, qa = written(self._read("records")), written(self._read("qa"))
        todo = merge.to_remediate(qa).select("id", "source_id", F.col("retry_count").alias("__retry"), "replacement_count")
        rows = todo.join(records, "id")
        missing = merge.pending(todo, records)
        if not missing.isEmpty():
            raise KeyError(f"no record for {missing.first()['id']}")
        if c.dry_run:
            return
        rows = rows.select("id", "source_id", "source", "source_word_count", "source_char_count", "source_length_bucket", "replacement_count", (F.col("__retry") + 1).alias("retry_count"), F.lit(True).alias("strict"))
        tried = written(attempt(rows, self._chat or generator_of(c), c).where("hard_gate_passed"))
        write_keyed(written(merge.upsert(records, record_of(tried))), str(c.output))
        write_keyed(written(merge.upsert(qa, as_qa(tried))), str(c.qa_output))
        for what, at in (("qe", c.cometkiwi_output), ("judge", c.judge_output)):
            if exists(self.spark, str(at)):
                write_keyed(written(merge.pending(self._read(what), tried)), str(at))
