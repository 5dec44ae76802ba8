"""Word search over a stored inverted index.

The index is a table of postings ``word, id``, one row for each word of each document, range
partitioned and sorted by word and id. A word is in one stretch of neighbouring files, and a
word of very many documents is spread over several, since the id is part of the key. Searches
filter on the word; the filter reaches the scan, which skips files and row groups by their
least and greatest word. Texts are read once, when the index is built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.tables import discard, materialise

#: A term that ends with this stands for all words that begin with it.
ANY_END = "*"
MAX_CLAUSES = 60


def words_of(text: Column) -> Column:
    """The distinct words of a text: runs of letters, in lower case; NULL has none."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+")), "")


def build_index(docs: DataFrame, id_col: str, text_col: str, path: str) -> None:
    """Write the postings of ``docs`` to ``path``. Rows with one id are one document; a word
    they share is listed for each, and counts once in a search. The postings are stored
    before they are dealt, so that finding the ranges does not read the texts again."""
    found = docs.select(F.explode(words_of(F.col(text_col))).alias("word"), F.col(id_col).alias("id"))
    found = materialise(found, "postings")
    found.repartitionByRange("word", "id").sortWithinPartitions("word", "id").write.parquet(path)
    discard(found)


def _meets(term: str) -> Column:
    word = F.col("word")
    if term.endswith(ANY_END):
        return word.startswith(term[: -len(ANY_END)].lower())
    return word == term.lower()


def search_index(
    spark: SparkSession, path: str, searches: Mapping[str, Sequence[Sequence[str]]]
) -> DataFrame:
    """``search, id`` for every document that answers a search.

    A search is a list of clauses that must all hold; a clause is a list of terms of which
    one must occur, as a whole word in any case, or as the beginning of a word where the
    term ends with ``*``. All searches are answered by one scan of the postings they name.
    A search without clauses and one with more than ``MAX_CLAUSES`` are refused; a clause
    without terms never holds."""
    clauses = [(name, n, terms) for name, search in searches.items() for n, terms in enumerate(search)]
    for name, search in searches.items():
        if not 0 < len(search) <= MAX_CLAUSES:
            raise ValueError(f"search {name!r} needs between 1 and {MAX_CLAUSES} clauses")
    terms = sorted({term for _, _, some in clauses for term in some})
    plain = [term.lower() for term in terms if not term.endswith(ANY_END)]
    named = reduce(or_, [_meets(t) for t in terms if t.endswith(ANY_END)], F.col("word").isin(plain))
    hits = F.array_compact(
        F.array(
            *[
                F.when(reduce(or_, map(_meets, some), F.lit(False)), F.struct(F.lit(name).alias("search"), F.lit(1 << n).cast("bigint").alias("held")))
                for name, n, some in clauses
            ]
        )
    )
    met = spark.read.parquet(path).where(named).select("id", F.inline(hits))
    all_held = F.create_map(*[F.lit(x) for name, search in searches.items() for x in (name, (1 << len(search)) - 1)])
    held = met.groupBy("search", "id").agg(F.bit_or("held").alias("held"))
    return held.where(F.col("held") == all_held[F.col("search")]).select("search", "id")
