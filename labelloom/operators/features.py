"""Text features, always fitted on the rows passed in: pass the train split only.

Fitted state is small by construction (a label list, a vocabulary of a given
size), so it is broadcast; the tables it is applied to are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, StopWordsRemover
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions import text as tx
from labelloom.operators.pin import pin
from labelloom.operators.validate import require_columns
from labelloom.roles import Roles

# Default sizes, the id of unknown words and of padding.
TFIDF_FEATURES = 5_000
SEQUENCE_VOCABULARY = 10_000
SEQUENCE_LENGTH = 100
UNKNOWN_ID = 1
PADDING_ID = 0

#: A fitted vocabulary up to this many rows (some megabytes) is broadcast.
MAX_BROADCAST_VOCABULARY = 200_000

#: Terms and words that fitted state may have, since it goes to every task, and classes that are numbered.
MAX_VOCABULARY = 1_000_000
MAX_LABELS = 100_000


def label_index(df: DataFrame, label: str = "label", expected: Iterable[str] | None = None) -> DataFrame:
    """``label, label_id``: sorted labels numbered from 0, pinned. Raises if an expected class is absent."""
    require_columns(df, label)
    labels = df.where(F.col(label).isNotNull()).select(F.col(label).alias("label")).distinct()
    if labels.limit(MAX_LABELS + 1).count() > MAX_LABELS:
        raise ValueError(f"{label} has more than {MAX_LABELS} values; it isn't a class label")
    # One row per class, of which there are few.
    index = pin(labels.select("label", (F.row_number().over(Window.orderBy("label")) - 1).alias("label_id")))
    if expected is None:
        return index
    wanted = df.sparkSession.createDataFrame([(c,) for c in expected], "label string")
    absent = sorted(r["label"] for r in wanted.join(index, "label", "left_anti").collect())
    if absent:
        raise ValueError(f"expected classes not found in the labels: {absent}")
    return index


def encode_labels(df: DataFrame, index: DataFrame, label: str = "label") -> DataFrame:
    """``df`` with ``label_id``; null for labels the index does not know."""
    known = index.select(F.col("label").alias("_label"), "label_id")
    return df.join(known, F.col(label) == F.col("_label"), "left").drop("_label")


def decode_labels(df: DataFrame, index: DataFrame, label_id: str = "label_id", out: str = "label") -> DataFrame:
    """``df`` with the label of each ``label_id`` in column ``out``."""
    known = index.select(F.col("label").alias(out), F.col("label_id").alias("_label_id"))
    return df.join(known, F.col(label_id) == F.col("_label_id"), "left").drop("_label_id")


def default_stop_words() -> list[str]:
    """Spark's own English list. Needs a running session."""
    return StopWordsRemover.loadDefaultStopWords("english")


def tfidf_vocabulary(
    df: DataFrame,
    text: str = "text",
    max_features: int = TFIDF_FEATURES,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """``term_id, term, tf, df, idf`` of the most frequent terms after stop words.

    Terms rank by corpus count, then by name, and are numbered alphabetically.
    ``idf`` is ``ln((1 + texts) / (1 + df)) + 1``. One shuffle of per-task
    term counts; the number of texts travels along as the count of a null term.
    """
    require_columns(df, text)
    if not 1 <= max_features <= MAX_VOCABULARY:
        raise ValueError(f"max_features must be from 1 to {MAX_VOCABULARY}")
    stop = list(default_stop_words() if stop_words is None else stop_words)
    # Three lists per text: every word for tf, every distinct word for df, and
    # one null word that counts the text itself.
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def part(terms: Column, tf: Column, df_: Column) -> Column:
        return F.struct(terms.alias("terms"), tf.alias("tf"), df_.alias("df"))

    lists = df.select(tx.word_tokens(F.col(text)).alias("words")).select(
        F.inline(
            F.array(
                part(F.col("words"), one, zero),
                part(F.array_distinct("words"), zero, one),
                part(F.array(F.lit(None).cast("string")), zero, one),
            )
        )
    )
    counts = (
        lists.select(F.explode("terms").alias("term"), "tf", "df")
        .where(F.col("term").isNull() | ~F.col("term").isin(stop) if stop else F.lit(True))
        .groupBy("term")
        .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    )
    # From here on at most max_features + 1 rows; the null term sorts first.
    top = counts.orderBy(F.col("term").isNotNull(), F.desc("tf"), "term").limit(max_features + 1)
    texts = F.max(F.when(F.col("term").isNull(), F.col("df"))).over(Window.partitionBy())
    numbered = top.select("*", texts.alias("texts")).where(F.col("term").isNotNull())
    return numbered.select(
        (F.row_number().over(Window.orderBy("term")) - 1).alias("term_id"),
        "term",
        "tf",
        "df",
        (F.log((F.col("texts") + 1) / (F.col("df") + 1)) + 1).alias("idf"),
    )


def tfidf_model(vocabulary: DataFrame, text_tokens: str = "tokens", out: str = "features") -> PipelineModel:
    """Spark ML stages that turn a token column into L2-normalised TF-IDF vectors.

    Applying them is a map over rows: nothing is shuffled and vectors stay sparse.
    """
    rows = vocabulary.orderBy("term_id").select("term", "idf").limit(MAX_VOCABULARY + 1).collect()
    if not rows:
        raise ValueError("the vocabulary is empty")
    if len(rows) > MAX_VOCABULARY:
        raise ValueError(f"the vocabulary has more than {MAX_VOCABULARY} terms")
    counts = CountVectorizerModel.from_vocabulary(
        [r["term"] for r in rows], inputCol=text_tokens, outputCol="term_counts"
    )
    weigh = ElementwiseProduct(
        scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="term_counts", outputCol="weighted"
    )
    return PipelineModel([counts, weigh, Normalizer(p=2.0, inputCol="weighted", outputCol=out)])


def tfidf_vectors(df: DataFrame, vocabulary: DataFrame, text: str = "text", out: str = "features") -> DataFrame:
    """``df`` with a sparse TF-IDF vector per row."""
    tokens = df.withColumn("tokens", tx.word_tokens(F.col(text)))
    return tfidf_model(vocabulary, out=out).transform(tokens).drop("tokens", "weighted", "term_counts")


def tfidf_weights(df: DataFrame, vocabulary: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Long form: order columns, ``term, tf, weight`` for every vocabulary term of every text.

    The vectors are computed row by row and unfolded in place; the term names
    come from the broadcast vocabulary. No shuffle.
    """
    names = pin(vocabulary.select("term_id", "term", "idf"), MAX_BROADCAST_VOCABULARY)
    tokens = df.select(*roles.order_columns, tx.word_tokens(F.col(roles.text)).alias("tokens"))
    vectors = tfidf_model(names, out="features").transform(tokens)
    counts, weights = F.unwrap_udt("term_counts"), F.unwrap_udt("features")
    entries = vectors.select(
        *roles.order_columns,
        F.inline(
            F.arrays_zip(
                counts["indices"].alias("term_id"),
                counts["values"].alias("tf"),
                weights["values"].alias("weight"),
            )
        ),
    )
    return entries.join(names.select("term_id", "term"), "term_id").select(
        *roles.order_columns, "term", F.col("tf").cast("bigint").alias("tf"), "weight"
    )


def sequence_vocabulary(
    df: DataFrame, roles: Roles = Roles(), vocab_size: int = SEQUENCE_VOCABULARY
) -> DataFrame:
    """``word, n, word_id`` with ids below ``vocab_size``; 1 is the id of unknown words.

    Words rank by count; equal counts go by first occurrence, in order of rows
    and then of words within a row.
    """
    require_columns(df, roles.text, *roles.order_columns)
    if not 2 <= vocab_size <= MAX_VOCABULARY:
        raise ValueError(f"vocab_size must be from 2 to {MAX_VOCABULARY}")
    order_type = df.select(roles.order_value().alias("o")).schema["o"].dataType
    words = df.select(
        roles.order_value().alias("row_order"), F.posexplode(tx.sequence_tokens(F.col(roles.text))).alias("place", "word")
    )
    if isinstance(order_type, T.IntegralType):
        # A fixed-width number, so that the minimum stays in the hash aggregate.
        seen = F.col("row_order").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("place")
    else:
        seen = F.struct("row_order", "place")
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.min(seen).alias("first_seen"))
    by_use = [F.desc("n"), F.asc("first_seen")]
    # At most vocab_size - 2 rows are left to be numbered.
    top = counts.orderBy(*by_use).limit(vocab_size - 2)
    return top.select("word", "n", (F.row_number().over(Window.orderBy(*by_use)) + UNKNOWN_ID).alias("word_id"))


def padded_sequences(
    df: DataFrame,
    vocabulary: DataFrame,
    roles: Roles = Roles(),
    length: int = SEQUENCE_LENGTH,
    padding: str = "post",
    truncating: str = "post",
) -> DataFrame:
    """Order columns and ``sequence``: word ids of each text, cut or padded to ``length``.

    Every word has exactly one id, so the words that will be cut are cut before
    the lookup. The ids are looked up in the row, in Arrow batches against the
    vocabulary, which is as small as ``vocab_size`` made it: nothing is unfolded
    or shuffled. A text without words becomes one unknown word.
    """
    require_columns(df, roles.text, *roles.order_columns)
    kept = tx.truncate(tx.sequence_tokens(F.col(roles.text)), length, truncating)
    rows = vocabulary.select("word", "word_id").limit(MAX_VOCABULARY + 1).collect()
    if len(rows) > MAX_VOCABULARY:
        raise ValueError(f"the vocabulary has more than {MAX_VOCABULARY} words")
    known = df.sparkSession.sparkContext.broadcast({row["word"]: row["word_id"] for row in rows})

    @F.pandas_udf("array<int>")
    def ids(lists: pd.Series) -> pd.Series:
        look_up = known.value.get
        return lists.map(lambda words: [UNKNOWN_ID] if words is None or not len(words) else [look_up(w, UNKNOWN_ID) for w in words])

    found = df.select(*roles.order_columns, ids(kept).alias("ids"))
    return found.select(*roles.order_columns, tx.pad(F.col("ids"), length, padding, PADDING_ID).alias("sequence"))


def normalized_text(df: DataFrame, text: str = "text", out: str = "normalized") -> DataFrame:
    """``df`` with handles and links replaced by ``<USER>`` and ``<URL>``."""
    require_columns(df, text)
    return df.withColumn(out, tx.mask_handles_and_links(F.col(text)))
