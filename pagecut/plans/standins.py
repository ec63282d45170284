"""How the corpus tables stand in for bundles, pages, labels and scores.

* ``events``: bundle = ``user_id``, page order = ``(ts, event_id)``, a first
  page is a ``signup`` event; score = ``value / 500``, label = ``error``.
* ``documents``: bundle = ``doc_id``, one line of ``text`` = one page.
* ``conversations``: bundle ``conv_<conv_id>``, page = ``turn``, first pages
  (label store targets) = ``user`` turns; as one long bundle ordered by
  ``(conv_id, turn)`` its segments at ``turn = 0`` rebuild the conversations.
* ``lineitem``: bundle = ``l_orderkey``, page = ``l_linenumber - 1``; predicted
  first pages = returned lines (``R``), true ones = open lines (``O``).
* ``labels`` + ``documents``: label = ``quality``, score = ``n_chars``,
  prediction = ``n_chars > 500``.
* ``embeddings``: features = ``embedding`` (also an 8 x 8 image), counting
  label = ``label = 0``, learnable label ``y`` = first 8 dims sum > 0.45.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecut.functions.arrays import prefix_sum, quantise
from pagecut.operators.pages import text_to_pages
from pagecut.sources.tables import table

# Fixed values of the stand-in mapping.
FIRST_EVENT = "signup"
SCORE_SCALE = 500.0
PRED_MIN_CHARS = 500
Y_DIMS = 8
Y_CUT = 0.45
IMG_H = IMG_W = 8
PAGE_ROOT = "pages"


def is_signup() -> Column:
    return F.col("event_type") == F.lit(FIRST_EVENT)


def events(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events")


def document_pages(spark: SparkSession, root: str) -> DataFrame:
    return text_to_pages(table(spark, root, "documents"), "doc_id", "text")


def conversation_pages(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "conversations")
    return c.select(F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("bundle"), "conv_id",
                    F.col("turn").cast("int").alias("page_number"), "role", "text",
                    (F.col("role") == "user").alias("is_first"))


def line_pages(spark: SparkSession, root: str) -> DataFrame:
    li = table(spark, root, "lineitem")
    return li.select("l_orderkey", (F.col("l_linenumber") - 1).cast("int").alias("page_number"),
                     "l_returnflag", "l_linestatus")


def is_predicted() -> Column:
    return F.col("l_returnflag") == "R"


def is_true() -> Column:
    return F.col("l_linestatus") == "O"


def predicted_lines(pages: DataFrame) -> DataFrame:
    return pages.where(is_predicted()).select("l_orderkey", "page_number")


def true_lines(pages: DataFrame) -> DataFrame:
    return pages.where(is_true()).select("l_orderkey", "page_number")


def doc_predictions(spark: SparkSession, root: str) -> DataFrame:
    """``(doc_id, label, score, prediction)`` for labelled documents."""
    docs = table(spark, root, "documents").select("doc_id", "n_chars")
    lab = table(spark, root, "labels").select("doc_id", "quality")
    return lab.join(docs, "doc_id", "inner").select(
        "doc_id", F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("score"),
        (F.col("n_chars") > PRED_MIN_CHARS).cast("int").alias("prediction"))


def embedding_rows(spark: SparkSession, root: str) -> DataFrame:
    e = table(spark, root, "embeddings")
    return e.select("vec_id", "embedding", "label",
                    (F.col("label") == 0).cast("int").alias("label_zero"),
                    (prefix_sum(F.col("embedding"), Y_DIMS) > F.lit(Y_CUT)).cast("int").alias("y"))


def pixels(col: Column) -> Column:
    """Embedding as 8-bit gray pixels."""
    return quantise(col)


def doc_label_targets(spark: SparkSession, root: str) -> DataFrame:
    """Label store of ``labels``: page 0 when ``quality = 1``, page 1 when ``toxic = 1``."""
    lab = table(spark, root, "labels")
    return lab.select(F.col("doc_id").alias("bundle"), F.explode(F.array_compact(F.array(
        F.when(F.col("quality") == 1, F.lit(0)), F.when(F.col("toxic") == 1, F.lit(1))))).alias("page_number"))
