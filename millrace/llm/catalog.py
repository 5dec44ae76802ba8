"""The operators of this folder bound to the given tables, with SQL where SQL can
state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import decode, encode
from millrace.llm.byte_bpe import decode_bytes, encode_bytes
from millrace.llm.common import text_or_empty
from millrace.llm.exact_dedup import exact_duplicates
from millrace.llm.jaccard import jaccard_components
from millrace.llm.langid import document_records, identify, page_records
from millrace.llm.packing import pack
from millrace.llm.prefix_trie import conversation_trie
from millrace.llm.quality import quality_scores
from millrace.llm.sharding import shard_by_bytes
from millrace.llm.suffix_dedup import remove_repeats, whole_characters
from millrace.llm.topk import top_k
from millrace.llm.url_filter import judge_urls
from millrace.llm.vector_codes import books_digest, compress
from millrace.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
    return build


@query
def op3_exact_dedup(t: Tables) -> DataFrame:
    return exact_duplicates(t.documents).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op3_exact_dedup"] = r"""
    WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
    g AS (SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
                 count(*) OVER (PARTITION BY norm) AS group_size FROM d)
    SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, false) AS kept, sha256(norm) AS text_sha256 FROM g
"""

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


@query
def op4_url_filter(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(t.pages, rules)


ORACLES["op4_url_filter"] = r"""
    WITH r(rule_host, rule_path, rule_verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    p AS (SELECT page_id,
        coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
    m AS (SELECT page_id, host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                 max_by(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
          FROM p LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
          GROUP BY ALL)
    SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM m
"""


SHARDS = 40


@query
def op5_sharding(t: Tables) -> DataFrame:
    placed = shard_by_bytes(t.documents, SHARDS)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query
def op6_best_fit_packing(t: Tables) -> DataFrame:
    return pack(t.documents)


def word_vocabulary() -> str:
    """Path of the vocabulary file the queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op7_bpe(t: Tables) -> DataFrame:
    path = word_vocabulary()
    read = decode(encode(t.documents, path), path)
    return read.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_quality(t: Tables) -> DataFrame:
    return quality_scores(t.documents, t.labels)


@query
def op9_language_id(t: Tables) -> DataFrame:
    """Documents and pages, each with its own priors; the other table's id is null."""
    columns = ["lang", "confidence", "accepted", "text_lang", "declared"]
    none = F.lit(None).cast("long")
    docs, pages = identify(document_records(t.documents)), identify(page_records(t.pages))
    return docs.select(F.col("id").alias("doc_id"), none.alias("page_id"), *columns).unionByName(
        pages.select(none.alias("doc_id"), F.col("id").alias("page_id"), *columns)
    )


@query
def op1_topk(t: Tables) -> DataFrame:
    return top_k(t.embeddings, F.col("vec_id") % 50 == 0, 5)


ORACLES["op1_topk"] = """
    WITH e AS (SELECT vec_id, [floor(256 * x::double)::bigint for x in embedding] AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::double[], c.v::double[])::bigint AS score
          FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op8_suffix_dedup(t: Tables) -> DataFrame:
    """Every copy goes here, the first one too. ``text`` is what is left of the text."""
    cut = remove_repeats(t.documents.select("doc_id", "text"), 400, keep_first=False)
    removed = F.aggregate("_spans", F.lit(0).cast("long"), lambda sum_, s: sum_ + s["end"] - s["begin"])
    return cut.select(
        "doc_id",
        F.col("_n_bytes").alias("n_bytes"),
        F.coalesce(removed, F.lit(0)).alias("n_removed"),
        F.coalesce(F.size("_spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
        F.when(F.col("_spans").isNull(), text_or_empty()).otherwise(whole_characters(F.col("_kept"))).alias("text"),
    )


@query
def op2_ngram_jaccard(t: Tables) -> DataFrame:
    return jaccard_components(t.documents).drop("t")


@query
def op11_prefix_trie(t: Tables) -> DataFrame:
    return conversation_trie(t.conversations).drop("node", "parent")


# CRC-32 of the decimal digits, bit by bit.
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
        [ascii(x)::bigint for x in string_split(conv_id::varchar, '')]), lambda crc, x: list_reduce(
            list_prepend(xor(crc, x), range(8)), lambda a, i: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

ORACLES["op11_prefix_trie"] = f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, list({{'role': role, 'text': text}}
              ORDER BY turn NULLS FIRST, sha256(strlen(role)::varchar || ':' || role || text)) AS own
          FROM t GROUP BY conv_id),
    s AS (SELECT conv_id, own, {CRC32} % 6 AS h FROM c),
    r AS (SELECT s.conv_id, list_concat(coalesce(b.own[1:s.h], []), s.own[s.h + 1:]) AS turns
          FROM s LEFT JOIN c b ON b.conv_id = s.conv_id - s.conv_id % 100),
    m AS (SELECT conv_id, len(turns) AS size, unnest(range(len(turns) + 1)) AS depth, turns FROM r),
    k AS (SELECT conv_id, size, depth, sha256(turns[1:depth]::varchar) AS node,
                 CASE WHEN depth > 0 THEN sha256(turns[1:depth - 1]::varchar) END AS parent,
                 CASE WHEN depth > 0 THEN length(turns[depth].text) ELSE 0 END AS chars FROM m),
    n AS (SELECT node, depth, parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
                 sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
          FROM k GROUP BY ALL),
    g AS (SELECT parent AS node, count(*) AS n_children FROM n GROUP BY parent),
    f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN g USING (node)),
    path AS (SELECT DISTINCT a.node AS above, b.node AS below FROM k a JOIN k b USING (conv_id) WHERE a.depth <= b.depth),
    sub AS (SELECT above AS node, count(*) FILTER (f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.chars) AS saved
            FROM path JOIN f ON f.node = path.below GROUP BY above)
    SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
           saved::bigint AS saved_tokens, f.ends_sha256
    FROM f JOIN sub USING (node) LEFT JOIN n p ON p.node = f.parent
"""


@query
def op12_vector_codes(t: Tables) -> DataFrame:
    coded, books = compress(t.embeddings)
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def vector_code_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same codes step by step: every entry is compared with every part."""
    steps = [f"""
    e AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label,
                 [floor({scale} * x::double)::bigint for x in embedding] AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    x AS MATERIALIZED (SELECT row, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})]::double[] AS v
          FROM e, range({parts}) r(p)),
    b0 AS MATERIALIZED (SELECT p, row - 1 AS k, v FROM x WHERE row <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
    d{i} AS (SELECT row, p, x.v, k, (list_dot_product(x.v, x.v) + list_dot_product(b.v, b.v)
                 - 2 * list_dot_product(x.v, b.v))::bigint AS gap FROM x JOIN b{i} b USING (p)),
    a{i} AS MATERIALIZED (SELECT row, p, any_value(v) AS v, min({{'gap': gap, 'k': k}}) AS near FROM d{i} GROUP BY row, p)""")
        if i < rounds:
            steps.append(f"""
    u{i} AS (SELECT p, near.k AS k, unnest(v)::bigint AS c, unnest(range(len(v))) AS place FROM a{i}),
    s{i} AS (SELECT p, k, place, sum(c)::bigint AS total, count(*) AS n FROM u{i} GROUP BY ALL),
    w{i} AS (SELECT p, k, list(((total - ((total % n) + n) % n) // n)::double ORDER BY place) AS v FROM s{i} GROUP BY p, k),
    b{i + 1} AS MATERIALIZED (SELECT p, k, coalesce(w.v, b.v) AS v FROM b{i} b LEFT JOIN w{i} w USING (p, k))""")
    return f"""
    WITH {",".join(steps)},
    z AS (SELECT row, string_agg(format('{{:02x}}', near.k), '' ORDER BY p) AS code, sum(near.gap)::bigint AS error
          FROM a{rounds} GROUP BY row),
    flat AS (SELECT p, k, unnest(v)::bigint AS c, unnest(range(len(v))) AS place FROM b{rounds}),
    h AS (SELECT sha256(string_agg(c::varchar, ',' ORDER BY p, k, place)) AS codebooks_sha256 FROM flat)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::bigint AS label_error, codebooks_sha256
    FROM z JOIN e USING (row), h
"""


ORACLES["op12_vector_codes"] = vector_code_sql()


def rank_vocabulary() -> tuple[str, str]:
    """Path of the rank file and its pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op13_byte_bpe(t: Tables) -> DataFrame:
    path, pattern = rank_vocabulary()
    return decode_bytes(encode_bytes(t.documents, path, pattern), path, pattern).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
