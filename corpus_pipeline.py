"""From documents to packed training sequences.

Language identification, exact dedup, near-duplicate join, suffix dedup and packing, each
stage on all that the one before it kept. A stage takes (spark, docs, sf_dir) and returns a
DataFrame; all but the last return the columns of ``docs``. Stages that drop rows find them
by id and text, so a row without an id is treated like any other; whole texts never pass
through more than the joins of the operator itself, because only rows that may be dropped
are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import drop_rows, stamp, text_or_empty
from millrace.llm.exact_dedup import exact_duplicates
from millrace.llm.jaccard import jaccard_components
from millrace.llm.langid import document_records, identify
from millrace.llm.packing import pack
from millrace.llm.suffix_dedup import remove_repeats, whole_characters
from millrace.sources.tables import materialise

#: Passages of this many bytes that repeat are removed (about 40 words), and those of this
#: many words, however short they are.
PASSAGE_BYTES = 256
PASSAGE_WORDS = 51


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the known languages. Texts that are null, empty, without letters
    or in none of these languages go."""
    records = document_records(docs).withColumn("id", F.struct(F.col("id").alias("doc_id"), stamp("text").alias("t")))
    judged = identify(records)
    return drop_rows(docs, judged.where("NOT accepted").select("id.doc_id", "id.t"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the smallest id. Of rows that
    repeat an id and its text one stays, also where a group has no id at all. Built-in
    functions only."""
    judged = materialise(exact_duplicates(docs).select("doc_id", "keep_id", "kept", "t"), "pipeline-exact")
    single = drop_rows(docs, judged.where("NOT kept AND keep_id IS NOT NULL"), thin=False)
    again = judged.where("kept OR keep_id IS NULL").groupBy("doc_id", "t").count().where("count > 1")
    again = materialise(again.select("doc_id", "t"), "pipeline-repeated")
    if again.isEmpty():
        return single
    others = drop_rows(single, again, thin=False)
    named = again.select(F.col("doc_id").alias("_d"), F.col("t").alias("_t"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (stamp("text") == F.col("_t"))
    repeated = single.join(named, same, "left_semi").withColumn("_text", text_or_empty("text"))
    return others.unionByName(repeated.dropDuplicates(["doc_id", "_text"]).drop("_text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (five words, 0.75): that with the
    smallest id. A component without any id stays whole."""
    found = jaccard_components(docs)
    other = F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id"))
    return drop_rows(docs, found.where(other).select("doc_id", "t"))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document, or the same one further up, has
    already; the first copy stays. ``n_chars`` follows the text. No document goes."""
    cut = remove_repeats(docs, PASSAGE_BYTES, keep_first=True, words=PASSAGE_WORDS)
    changed = F.col("_spans").isNotNull()
    text = F.when(changed, whole_characters(F.col("_kept"))).otherwise(F.col("text"))
    out = cut.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document: its sequence and its place in it."""
    return pack(docs)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", suffix_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Likelihoods, components, repeated strings and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.lower().replace(" ", "-"))
    return docs
