"""Language identification by fusing evidence with Bayes' rule.

Evidence for a record and language l:

* the text: letter trigrams under a multinomial of each language, tempered, because
  neighbouring trigrams are not independent;
* the declared language (a page's ``lang`` attribute, a record's label): how often each
  language is declared so, counted over the corpus with the text's own posterior as weight;
* where it comes from: a prior of the host, shrunk towards that of its domain, that of
  the address suffix and that of the whole corpus, one after the other. The counts are
  grouped sums of the text posteriors of all rows; a row's own share is taken out before
  it is used.

A background model (every trigram alike) stands for "none of these". A record whose text
fits it better than every language is rejected as ``und``, and so is one without letters.

The text model is fitted on at most ``SAMPLE_ROWS`` declared records for each language,
chosen by a hash of their text; everything else covers all rows and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_or_empty
from millrace.sources.tables import materialise

LANGUAGES = ("en", "fr", "de", "es")
#: Bound on the records of each language the text model is fitted on.
SAMPLE_ROWS = 2_000
BUCKETS = 1 << 15
#: A text counts as this many independent trigrams at most.
EVIDENCE = 60.0
#: Rows' worth of the wider level in the prior of the narrower one.
SHRINK = 20.0
WINDOW_CHARS = 1 << 20


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the bytes of the lower-cased words, a space on either side;
    other characters than letters part words."""
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), "uint8").astype("int64")
    letter = (raw >= 128) | (raw >= 97) & (raw <= 122)
    raw = np.where(letter, raw, 32)
    keep = np.ones(len(raw), bool)
    keep[1:] = letter[1:] | letter[:-1]  # one space between words
    raw = raw[keep]
    code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    code = code[(raw[1:-1] != 32)]
    return (code * 0x9E3779B1 >> 7) & (BUCKETS - 1)


def windows(text: str) -> Iterator[np.ndarray]:
    """Trigrams of a text of any length, a bounded stretch at a time."""
    for i in range(0, len(text), WINDOW_CHARS):
        yield trigrams(text[i : i + WINDOW_CHARS])


class TextModel:
    """Mean log likelihood of a text's trigrams under each language, against the
    background."""

    def __init__(self, counts: np.ndarray):
        smoothed = counts + 0.5
        # a row for each language; the background gives each trigram in use the same share
        self.log = (np.log(smoothed) - np.log(smoothed.sum(1, keepdims=True)) + np.log(BUCKETS)).T.copy()

    def fit_of(self, text: str) -> tuple[int, np.ndarray]:
        n, total = 0, np.zeros(self.log.shape[1])
        for grams in windows(text):
            n, total = n + len(grams), total + self.log[grams].sum(0)
        return n, total / max(1, n)


def fit_text(rows: DataFrame, languages: Sequence[str], sample_rows: int) -> TextModel:
    """Trigram counts of a bounded sample of declared records."""
    declared = rows.where(F.col("declared").isin(list(languages)))
    sizes = {r["declared"]: r["count"] for r in declared.groupBy("declared").count().collect()}
    draw = F.shiftrightunsigned(F.xxhash64("id", "text"), 11) / F.lit(2.0**53)
    chance = F.coalesce(*(F.when(F.col("declared") == k, F.lit(sample_rows / n)) for k, n in sizes.items()), F.lit(0.0))
    sample = declared.where(draw < chance).select("declared", "text")
    kinds = list(languages)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for kind, text in zip(batch["declared"], batch["text"]):
                grams = sum(np.bincount(g, minlength=BUCKETS) for g in windows(text)) + np.zeros(BUCKETS)
                share = grams / max(1.0, grams.sum() / 500)  # a long text counts like one of 500 trigrams at most
                sums[kind] = sums.get(kind, 0) + share
        for kind, n in sums.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"kind": kinds.index(kind), "bucket": at, "n": n[at]})

    found = sample.mapInPandas(count, "kind int, bucket int, n double").groupBy("kind", "bucket").agg(F.sum("n").alias("n"))
    table = found.toPandas()
    counts = np.zeros((len(kinds), BUCKETS))
    counts[table["kind"], table["bucket"]] = table["n"]
    return TextModel(counts)


def primary_tag(tag: Column | str) -> Column:
    """``de`` of ``de-AT`` or ``DE_at``; null for null and empty tags."""
    tag = F.col(tag) if isinstance(tag, str) else tag
    main = F.lower(F.regexp_extract(tag, r"^\s*([A-Za-z]+)", 1))
    return F.when(main != "", main)


def address_levels(host: Column | str) -> list[Column]:
    """Host, domain (two last labels) and suffix (last label); empty levels are null."""
    host = F.col(host) if isinstance(host, str) else host
    parts = F.split(host, r"\.")
    domain = F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - 1), 2), ".")
    suffix = F.when(F.size(parts) > 1, F.element_at(parts, -1))
    return [F.when(c != "", c) for c in (host, domain, suffix)]


def identify(
    records: DataFrame, languages: Sequence[str] = LANGUAGES, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``id, lang, confidence, accepted, text_lang, declared`` for each row of ``records``,
    which has ``id``, ``text``, ``declared`` (a language tag) and ``host``; all may be null.

    ``lang`` is the likeliest language, or ``und`` where the text is null, empty, without
    letters, or fits no language better than the background; ``accepted`` is false for
    those. ``text_lang`` is what the text alone says. Of equally likely languages the
    first of ``languages`` counts. Rows without an id and repeated rows are judged like
    all others; further columns are not read.
    """
    kinds, n = list(languages), len(languages)
    tag = primary_tag("declared")
    declared = F.when(tag.isin(kinds), tag)
    levels = [c.alias(name) for c, name in zip(address_levels("host"), ("host", "domain", "suffix"))]
    rows = records.select("id", text_or_empty("text").alias("text"), declared.alias("declared"), *levels)
    model = fit_text(rows, kinds, sample_rows)
    schema = "grams long, known boolean, fit array<double>, own array<double>"

    @F.pandas_udf(schema)
    def judge(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            size, fit = model.fit_of(text)
            scaled = fit * min(size, EVIDENCE)
            own = np.exp(scaled - scaled.max())
            known = size > 0 and fit.max() > 0
            own = own / own.sum() if known else np.zeros(n)
            out.append((size, bool(known), scaled, own))
        return pd.DataFrame(out, columns=["grams", "known", "fit", "own"])

    judged = rows.withColumn("t", judge("text")).select(
        "id", "declared", "host", "domain", "suffix", "t.known", "t.fit", "t.own"
    )
    seen = materialise(judged, "langid")
    sums = [F.sum(F.element_at("own", i + 1)).alias(f"s{i}") for i in range(n)]
    packed = F.array(*(f"s{i}" for i in range(n)))
    whole = [x or 0.0 for x in seen.agg(*sums).first()]
    confusion = {k: np.full(n, 1.0) for k in kinds}
    for r in seen.where("declared IS NOT NULL").groupBy("declared").agg(*sums).collect():
        confusion[r["declared"]] = confusion[r["declared"]] + [r[f"s{i}"] or 0.0 for i in range(n)]
    table = np.array([confusion[k] for k in kinds])  # a row for each declared language
    said = {k: (table[i] / table.sum(0)).tolist() for i, k in enumerate(kinds)}

    # Counts of the wider levels are summed from those of the hosts and joined to them; a
    # row meets one table, by its host.
    add = [F.sum(f"s{i}").alias(f"s{i}") for i in range(n)]
    hosts = materialise(seen.where("host IS NOT NULL").groupBy("host", "domain", "suffix").agg(*sums), "hosts")
    known = hosts.withColumn("at_host", packed).drop(*(f"s{i}" for i in range(n)))
    for level in ("domain", "suffix"):
        wider = hosts.where(F.col(level).isNotNull()).groupBy(F.col(level).alias("_k")).agg(*add)
        wider = materialise(wider.select("_k", packed.alias(f"at_{level}")), level)
        known = known.join(wider, known[level] == wider["_k"], "left").drop("_k")
    known = materialise(known.drop("domain", "suffix"), "host-levels")
    rows = seen.select("id", "declared", "host", "known", "fit", "own")
    counts = {f"at_{level}": F.lit(None).cast("array<double>") for level in ("host", "domain", "suffix")}
    out = rows.where("host IS NOT NULL").join(known, "host").unionByName(rows.where("host IS NULL").withColumns(counts))

    def shrunk(level: str, wider: Column) -> Column:
        """Counts at a level without the row's own share, and SHRINK rows of the wider prior."""
        others = F.transform(F.arrays_zip(F.col(f"at_{level}").alias("a"), F.col("own").alias("o")), lambda p: F.greatest(F.lit(0.0), p["a"] - p["o"]))
        total = F.aggregate(others, F.lit(0.0), lambda a, x: a + x) + SHRINK
        mixed = F.transform(
            F.arrays_zip(others.alias("c"), wider.alias("w")), lambda p: (p["c"] + SHRINK * p["w"]) / total
        )
        return F.when(F.col(f"at_{level}").isNull(), wider).otherwise(mixed)

    share = (np.array(whole) + 1) / (sum(whole) + n)
    prior = F.array(*map(F.lit, share.tolist()))
    for level in ("suffix", "domain", "host"):
        out = out.withColumn("prior", shrunk(level, prior))
        prior = F.col("prior")
    evidence = F.lit(None).cast("array<double>")
    for k in kinds:
        evidence = F.when(F.col("declared") == k, F.array(*map(F.lit, said[k]))).otherwise(evidence)
    evidence = F.coalesce(evidence, F.array(*[F.lit(1.0)] * n))
    logs = F.transform(
        F.arrays_zip(F.col("fit").alias("f"), F.col("prior").alias("p"), evidence.alias("e")),
        lambda p: p["f"] + F.ln(p["p"]) + F.ln(p["e"]),
    )
    out = out.withColumn("logs", logs).withColumn("top", F.array_max("logs"))
    mass = F.aggregate(F.transform("logs", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda a, x: a + x)
    name = F.array(*map(F.lit, kinds))
    best = F.element_at(name, F.array_position("logs", F.col("top")).cast("int"))
    alone = F.element_at(name, F.array_position("fit", F.array_max("fit")).cast("int"))
    return out.select(
        "id",
        F.when(F.col("known"), best).otherwise("und").alias("lang"),
        F.when(F.col("known"), 1 / mass).otherwise(0.0).alias("confidence"),
        F.col("known").alias("accepted"),
        F.when(F.col("known"), alone).otherwise("und").alias("text_lang"),
        "declared",
    )


def page_records(pages: DataFrame) -> DataFrame:
    """Records of web pages: visible text, the ``lang`` attribute of the html element,
    the host of the url."""
    from millrace.llm.url_filter import url_host

    unseen = r"(?is)<(script|style|title)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"
    return pages.select(
        F.col("page_id").alias("id"),
        F.regexp_replace("html", unseen, " ").alias("text"),
        F.regexp_extract("html", r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z-]+)", 1).alias("declared"),
        url_host("url").alias("host"),
    )


def document_records(docs: DataFrame) -> DataFrame:
    """Records of documents: the label is the declared language, the source the host."""
    return docs.select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"), F.col("source").alias("host")
    )
