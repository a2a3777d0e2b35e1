"""From raw documents to a training mix: language, near-duplicates, benchmark passages, personal data, source weights.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.llm import decontaminate, jaccard_join, language, mixing, pii
from kelpline.llm.registry import PUBLIC_KEY, table
from kelpline.llm.storage import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text of at least so many letters is rejected if too few of its n-grams are known (``least_known`` of the fitted model): it is in
#: no learned language. Shorter texts tell too little to be rejected for that.
TELLING_LETTERS = 100


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters, and those that are in no learned language, go.

    Null and empty texts go; all else about the rows stays as it is. Without any labelled row nothing is known, and all go.
    """
    model = language.train(docs)
    found = language.identify(docs, model, keep=COLUMNS[1:])
    letters = F.regexp_count("_kept_text", F.lit(r"\p{L}"))
    kept = found.where((F.col("lang_pred") != "und") & ((F.col("known") >= (model.least_known if model else 0.0)) | (letters < TELLING_LETTERS)))
    return kept.select("doc_id", *[F.col(f"_kept_{c}").alias(c) for c in COLUMNS[1:]])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each group of linked ones (five words, similarity 0.8): that of smallest id, none last.

    Rows that share an id are told apart by their text, and rows without an id are rows as all others; of
    equal rows one stays, the least in its other columns. Rows without words link only with those equal to them.
    """
    stays = materialise(jaccard_join.one_per_component(docs), "pipeline-stays")
    rows = docs.select(F.xxhash64("text").alias("_hash"), *COLUMNS)
    same = (F.col("_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id"))
    single = rows.join(stays.where("copies = 1"), same, "left_semi").select(*COLUMNS)
    # Grouped by a computed key, so that equal rows are reduced where they lie before they meet.
    equal = rows.join(stays.where("copies > 1"), same).groupBy(F.col("hash").bitwiseXOR(F.lit(0).cast("long")).alias("_h"), F.struct("id").alias("_i"))
    return single.unionByName(equal.agg(F.min(F.struct(*COLUMNS)).alias("_d")).select("_d.*"))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten words in a row of the benchmark (and without a shorter item as a whole)."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), keep=COLUMNS[1:])
    return found.where(F.size("spans") == 0).select("doc_id", *[F.col(f"_kept_{c}").alias(c) for c in COLUMNS[1:]])


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data under the session's key (a public one if it sets none); n_chars follows the text."""
    done = pii.pseudonymise(docs.select(*COLUMNS), key=spark.conf.get(pii.KEY_SETTING, PUBLIC_KEY))
    return done.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (``copy`` counts from 1), sources weighed 1, 2, 3 in turn."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("personal_data", replace_personal_data),
    ("mixing", mix),
]

#: SQL can express neither the classifier nor the pseudonyms; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
