"""One Spark query per operator, over the whole driver tables.

``documents`` serves with two labels: by ``source``, copies of a text carry
different labels; by ``lang``, copies agree. ``events`` has many rows and
several labels per key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import settings
from labelloom import Roles
from labelloom.operators import duplicates, features, metrics, models, policies, profile, split, state, validate
from labelloom.operators.groups import keep_rows
from labelloom.operators.pin import scratch_path, settle
from labelloom.plans.cleaning import clean_table
from labelloom.plans.splitting import split_table
from labelloom.sources.config import SplitSettings
from labelloom.sources.tables import read_csv, read_parquet, read_splits, write_splits, write_table

Query = Callable[[SparkSession, str], DataFrame]

DOC = Roles("text", "label", "doc_id")
EVENT = Roles("props", "event_type", "event_id")
TALK = Roles("text", "role", ("conv_id", "turn"))
ORDER = Roles("customer", "o_orderstatus", "o_orderkey")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, label: str = "source") -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", F.col(label).alias("label"))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language after policy D: every text once.

    Which rows stay is settled once; the passes of a split or fit that follow
    then read only the columns they need.
    """
    chosen = settle(policies.chosen_rows(documents(spark, sf_dir, "lang"), "D", DOC))
    return keep_rows(documents(spark, sf_dir, "lang"), DOC, chosen)


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(clean(spark, sf_dir), DOC, seed=settings.SEED)


def settled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split as the split job writes it, for work that goes over the texts more than once."""
    return settle(assigned(spark, sf_dir))


def assigned_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source, split while copies are still in."""
    return split.stratified_split(documents(spark, sf_dir), DOC, seed=settings.SEED)


def train_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("split") == "train")


def guessed_language(text: Column) -> Column:
    """A rule to evaluate: language by its accented letters."""
    guess = F.lit("en")
    for language, letters in reversed(settings.LETTERS.items()):
        guess = F.when(text.rlike(f"[{letters}]"), F.lit(language)).otherwise(guess)
    return guess


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "html")


def guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "lang")
    return docs.withColumn("guess", guessed_language(F.col("text")))


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def _on_documents(operator: Callable[..., DataFrame], label: str = "source", **options) -> Query:
    return lambda spark, sf: operator(documents(spark, sf, label), DOC, **options)


#: Buckets of a state that is kept for one query.
STATE_BUCKETS = 16


def _from_state(operator: Callable[..., DataFrame]) -> Query:
    """``operator`` over counts kept of most rows of ``documents``, with the other rows merged in."""

    def run(s: SparkSession, d: str) -> DataFrame:
        docs = documents(s, d)
        later = F.col("doc_id") % 4 == 3
        kept = state.build(docs.where(~later), DOC).save(scratch_path(s), STATE_BUCKETS)
        return operator(kept.merged(docs.where(later), DOC), DOC)

    return run


def _on_ratings(operator: Callable[..., DataFrame], **options) -> Query:
    """Documents by their quality rating, which most of them lack."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ratings = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
        return operator(table(spark, sf_dir, "documents").select("doc_id", "text").join(ratings, "doc_id", "left"), DOC, **options)

    return run


def _on_events(operator: Callable[..., DataFrame], **options) -> Query:
    return lambda spark, sf: operator(
        table(spark, sf, "events").select("event_id", "props", "event_type"), EVENT, **options
    )


def _events_by_place(s: SparkSession, d: str) -> DataFrame:
    """Policy B on a table without an order column of its own: first is who stands first in the files."""
    events = read_parquet(s, f"{d}/events.parquet", ["event_id", "props", "event_type", "place"], "place")
    return policies.policy_b(events, Roles("props", "event_type", "place")).drop("place")


def _on_orders(operator: Callable[..., DataFrame], **options) -> Query:
    """Customers as texts: their orders carry several statuses, some with a majority."""
    return lambda spark, sf: operator(
        table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"), "o_orderstatus"),
        ORDER,
        **options,
    )


def _profiling() -> dict[str, Query]:
    docs = lambda s, d: documents(s, d)
    return {
        "profile_shape": lambda s, d: profile.shape(table(s, d, "documents")),
        "class_distribution": lambda s, d: profile.class_distribution(docs(s, d)),
        "class_distribution_zero_filled": lambda s, d: profile.class_distribution_zero_filled(
            policies.policy_d(docs(s, d), DOC), docs(s, d)
        ),
        "missing_values": lambda s, d: profile.missing_values(table(s, d, "documents")),
        "duplicate_rows": lambda s, d: profile.duplicate_rows(table(s, d, "documents"), ["text", "lang", "source"]),
        "duplicate_counts": _on_documents(profile.duplicate_counts),
        "blank_texts": lambda s, d: profile.blank_texts(docs(s, d)),
        "char_length_stats": lambda s, d: profile.char_length_stats(docs(s, d)),
        "word_length_stats": lambda s, d: profile.word_length_stats(documents(s, d)),
        "text_flags_per_row": lambda s, d: profile.text_flags(documents(s, d).select("doc_id", "text")).drop("text"),
        "page_flags_per_row": lambda s, d: profile.text_flags(pages(s, d), "html").drop("html"),
        "feature_presence": lambda s, d: profile.feature_presence(documents(s, d)),
        "page_feature_presence": lambda s, d: profile.feature_presence(pages(s, d), "html"),
        "non_ascii_rows": lambda s, d: profile.non_ascii_rows(docs(s, d)),
        "examples_per_class": _on_documents(profile.examples_per_class, "lang"),
        "non_ascii_preview": _on_documents(profile.non_ascii_preview),
        "profile_report": lambda s, d: profile.profile_report(documents(s, d), DOC),
        "conversation_profile": lambda s, d: profile.profile_report(table(s, d, "conversations"), TALK),
        "column_roles": lambda s, d: validate.column_roles(table(s, d, "documents")),
        "null_audit": lambda s, d: validate.null_audit(table(s, d, "documents"), ["text", "source"]),
        "class_coverage_gaps": _coverage,
        "unique_text_check": _on_documents(validate.unique_text_check),
        "conversation_unique_texts": lambda s, d: validate.unique_text_check(table(s, d, "conversations"), TALK),
        "expected_value_mismatches": _mismatches,
    }


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources without a document of some toxicity rating."""
    docs = documents(spark, sf_dir)
    rated = docs.select("doc_id", "label").join(table(spark, sf_dir, "labels"), "doc_id")
    rated = rated.select("label", F.col("toxic").cast("string").alias("split"))
    return validate.class_coverage_gaps(rated, docs.select("label").distinct(), ["0", "1"])


def _mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class counts after policy D, held against those of the raw table."""
    raw = documents(spark, sf_dir)
    count = lambda df: profile.class_distribution(df).select("label", F.col("n").alias("value"))
    return validate.expected_value_mismatches(count(policies.policy_d(raw, DOC)), count(raw), ["label"])


def _duplicates() -> dict[str, Query]:
    return {
        "exact_duplicates": _on_documents(duplicates.exact_duplicates),
        "duplicate_samples": _on_documents(duplicates.duplicate_samples),
        "text_multiplicity": _on_documents(duplicates.text_multiplicity),
        "multiplicity_histogram": _on_documents(duplicates.multiplicity_histogram),
        "event_multiplicity_histogram": _on_events(duplicates.multiplicity_histogram),
        "text_label_profile": lambda s, d: duplicates.text_label_profile(documents(s, d), DOC, with_text=True).select(
            F.col("first_order").alias("first_doc"),
            "text",
            F.array_join("labels", ",").alias("labels"),
            "n_labels",
            "n_rows",
        ),
        "consistent_vs_conflicting": _on_documents(duplicates.consistent_vs_conflicting),
        "label_combinations": _on_documents(duplicates.label_combinations),
        "event_label_combinations": _on_events(duplicates.label_combinations),
        "combination_examples": _on_documents(duplicates.combination_examples),
        "conflict_frequency": _on_documents(duplicates.conflict_frequency),
        "conflict_impact_by_class": _on_documents(duplicates.conflict_impact_by_class),
        "majority_check": _on_documents(duplicates.majority_check),
        "event_majority_check": _on_events(duplicates.majority_check),
        "order_majority_check": _on_orders(duplicates.majority_check),
        "consistent_by_class": _on_documents(duplicates.consistent_by_class),
        "consistent_by_language": _on_documents(duplicates.consistent_by_class, "lang"),
        "remaining_duplicates": _on_documents(duplicates.remaining_duplicates),
        "duplicate_report": _on_documents(duplicates.duplicate_report),
        "duplicate_report_from_state": _from_state(duplicates.duplicate_report),
        "combination_examples_from_state": _from_state(duplicates.combination_examples),
    }


def _policies() -> dict[str, Query]:
    def delta(s: SparkSession, d: str) -> DataFrame:
        raw = documents(s, d)
        return policies.distribution_delta(
            profile.class_distribution(raw, dropna=True),
            profile.class_distribution(policies.policy_d(raw, DOC), dropna=True),
        )

    return {
        "policy_a": _on_documents(policies.policy_a),
        "events_kept_by_place": _events_by_place,
        "policy_b": _on_documents(policies.policy_b),
        "policy_c": _on_documents(policies.policy_c),
        "policy_d": _on_documents(policies.policy_d),
        "policy_summary": _on_documents(policies.policy_summary),
        "policy_comparison": _on_documents(policies.policy_comparison),
        "policy_class_matrix": _on_documents(policies.policy_class_matrix),
        "before_after_delta": delta,
        "cleaning_report": _on_documents(policies.cleaning_report),
        "policy_impact_report": _on_documents(policies.policy_impact_report),
        "majority_resolved": _on_documents(policies.majority_resolved),
        "rated_majority_resolved": _on_ratings(policies.majority_resolved),
        "rated_majority_check": _on_ratings(duplicates.majority_check),
        "order_majority_resolved": _on_orders(policies.majority_resolved),
    }


def _splits() -> dict[str, Query]:
    def reproducible(s: SparkSession, d: str) -> DataFrame:
        rows = clean(s, d).select("doc_id", "label")
        again = rows.repartition(13)
        return split.split_differences(
            split.stratified_split(rows, DOC, seed=settings.SEED),
            split.stratified_split(again, DOC, seed=settings.SEED),
            DOC,
        )

    def report(s: SparkSession, d: str) -> DataFrame:
        rows = clean(s, d)
        first, again = (split.stratified_split(rows, DOC, seed=settings.SEED) for _ in range(2))
        return split.split_report(first, DOC, rerun=again, source=rows)

    return {
        "stratified_split": lambda s, d: assigned(s, d).select("doc_id", "label", "split"),
        "leakage_audit": lambda s, d: split.leakage_audit(assigned(s, d), DOC),
        "leakage_audit_raw": lambda s, d: split.leakage_audit(assigned_raw(s, d), DOC),
        "split_stats": lambda s, d: split.split_stats(assigned(s, d)),
        "split_reproducible": reproducible,
        "split_report": report,
        "class_split_matrix": lambda s, d: split.class_split_matrix(assigned(s, d)),
        "cross_split_dedup": lambda s, d: split.cross_split_dedup(assigned_raw(s, d), DOC).select(
            "doc_id", "label", "split"
        ),
    }


def _vocabulary(rows: DataFrame) -> DataFrame:
    return features.tfidf_vocabulary(
        train_rows(rows), max_features=settings.MAX_FEATURES, stop_words=settings.stop_words()
    )


def _words(rows: DataFrame) -> DataFrame:
    return features.sequence_vocabulary(train_rows(rows), DOC, settings.VOCAB_SIZE)


def _features() -> dict[str, Query]:
    def on_rows(operator: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda s, d: operator(settled_texts(s, d))

    def padded(*sides: str) -> Query:
        return on_rows(
            lambda rows: _joined(
                features.padded_sequences(rows, _words(rows), DOC, settings.SEQUENCE_LENGTH, *sides)
            )
        )

    return {
        "label_index": lambda s, d: features.label_index(train_rows(assigned(s, d))),
        "label_round_trip": _round_trip,
        "tfidf_vocabulary": on_rows(lambda rows: rounded(_vocabulary(rows), idf=6)),
        "tfidf_weights": on_rows(
            lambda rows: rounded(features.tfidf_weights(rows, _vocabulary(rows), DOC), weight=6)
        ),
        "sequence_vocabulary": on_rows(_words),
        "padded_sequences": padded(),
        "padded_sequences_pre": padded("pre", "pre"),
        "normalized_text": lambda s, d: features.normalized_text(documents(s, d)).select("doc_id", "normalized"),
        "normalized_pages": lambda s, d: features.normalized_text(pages(s, d), "html").select("page_id", "normalized"),
    }


def _joined(sequences: DataFrame) -> DataFrame:
    return sequences.select("doc_id", F.array_join("sequence", " ").alias("sequence"))


def _round_trip(s: SparkSession, d: str) -> DataFrame:
    docs = documents(s, d, "lang").select("doc_id", "label")
    index = features.label_index(docs)
    return features.decode_labels(features.encode_labels(docs, index), index, out="decoded")


def _evaluation() -> dict[str, Query]:
    return {
        "argmax_class": lambda s, d: metrics.with_argmax(table(s, d, "embeddings"), "embedding").select(
            "vec_id", "predicted"
        ),
        "overall_metrics": lambda s, d: metrics.overall_metrics(guesses(s, d), "label", "guess", digits=6),
        "confusion_matrix": lambda s, d: metrics.confusion_matrix(guesses(s, d), "label", "guess"),
        "confusion_matrix_wide": lambda s, d: metrics.confusion_wide(
            guesses(s, d), "label", "guess", [*settings.LETTERS, "en"]
        ),
        "classification_report": lambda s, d: metrics.classification_report(
            guesses(s, d), "label", "guess", digits=6
        ),
        "error_summary": lambda s, d: metrics.error_summary(guesses(s, d), "label", "guess"),
        "misclassified": lambda s, d: metrics.misclassified(guesses(s, d), "label", "guess").select(
            "doc_id", "label", "guess"
        ),
        "misclassified_preview": lambda s, d: metrics.misclassified_preview(
            guesses(s, d), "label", "guess", ["doc_id"]
        ),
    }


def _jobs() -> dict[str, Query]:
    """Whole jobs over the tables, written to the shared folder and read back."""

    def csv_round_trip(s: SparkSession, d: str) -> DataFrame:
        docs = documents(s, d, "lang")
        return read_csv(s, write_table(docs, scratch_path(s), "csv"), docs.schema)

    def split_round_trip(s: SparkSession, d: str) -> DataFrame:
        path, rows = scratch_path(s), assigned(s, d)
        write_splits(rows, path)
        return read_splits(s, path).select("doc_id", "label", "split")

    def cleaning_job(s: SparkSession, d: str) -> DataFrame:
        return clean_table(s, documents(s, d), scratch_path(s), scratch_path(s), DOC, "csv").report

    def split_job(s: SparkSession, d: str) -> DataFrame:
        source = write_table(clean(s, d), scratch_path(s))
        values = {"source_dataset": source, "split_output": scratch_path(s), "report_output": scratch_path(s), "stratify": True}
        return split_table(s, SplitSettings.from_mapping(values | {"random_seed": settings.SEED})).report

    return {
        "csv_round_trip": csv_round_trip,
        "split_round_trip": split_round_trip,
        "cleaning_job": cleaning_job,
        "split_job": split_job,
    }


def _rule_guesses(s: SparkSession, d: str) -> DataFrame:
    """The split with a row per rule: ``model, predicted``."""

    def guess(patterns: Mapping[str, str]) -> Column:
        found = F.lit("en")
        for language, pattern in reversed(patterns.items()):
            found = F.when(F.col("text").rlike(pattern), F.lit(language)).otherwise(found)
        return found

    rules = F.array(*[F.struct(F.lit(name).alias("model"), guess(p).alias("predicted")) for name, p in settings.RULES.items()])
    return assigned(s, d).select("split", "label", F.inline(rules))


def _rules() -> dict[str, Query]:
    def scores(rows: DataFrame, part: str) -> DataFrame:
        return metrics.overall_metrics(rows.where(F.col("split") == part), "label", "predicted", by=["model"], digits=4)

    def test(s: SparkSession, d: str) -> DataFrame:
        """Chosen on validation, scored once on test."""
        rows = settle(_rule_guesses(s, d))
        chosen = models.select_model(scores(rows, "val")).first()["model"]
        return scores(rows.where(F.col("model") == chosen), "test")

    return {
        "rule_benchmark": lambda s, d: scores(_rule_guesses(s, d), "val"),
        "rule_selected": lambda s, d: models.select_model(scores(_rule_guesses(s, d), "val")),
        "rule_test_evaluation": test,
    }


def _train(s: SparkSession, d: str) -> tuple[DataFrame, models.Trained]:
    """The written split and the models trained on it, once for all queries of a session."""
    return _trained(s.sparkContext.applicationId, d)


@lru_cache(maxsize=1)
def _trained(application: str, d: str) -> tuple[DataFrame, models.Trained]:
    rows = settled_texts(SparkSession.active(), d)
    chosen = models.variants(hidden=settings.HIDDEN_UNITS, iterations=settings.ITERATIONS, rectified=True)
    return rows, models.train(rows, DOC, chosen, settings.MAX_FEATURES, settings.stop_words())


def _models() -> dict[str, Query]:
    def benchmark(s: SparkSession, d: str) -> DataFrame:
        return models.model_benchmark(*_train(s, d))

    def invariants(s: SparkSession, d: str) -> DataFrame:
        """What holds for any model: all validation rows scored, known classes predicted, probabilities that add up to 1."""
        rows, trained = _train(s, d)
        scored = trained.transform(rows.where(F.col("split") == "val"))
        total = F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b)
        return scored.groupBy("model").agg(
            F.count(F.lit(1)).alias("rows_scored"),
            F.count("predicted").alias("in_domain"),
            F.count_if(F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        )

    return {
        "model_benchmark": benchmark,
        "model_invariants": invariants,
        "selected_model": lambda s, d: models.select_model(benchmark(s, d)),
        "test_evaluation": lambda s, d: models.test_evaluation(*_train(s, d)),
    }


def all_queries() -> dict[str, Query]:
    return {
        **_profiling(),
        **_duplicates(),
        **_policies(),
        **_splits(),
        **_features(),
        **_evaluation(),
        **_jobs(),
        **_rules(),
        **_models(),
    }
