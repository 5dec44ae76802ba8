"""URL rules by a Bloom filter cascade.

The keys of a url are the ends of its host and the beginnings of its path that a
rule could have. Level 1 of a cascade holds the listed keys; level 2 holds the keys
of the whole corpus that are not listed but pass level 1; level 3 the listed keys
that pass level 2, and so on until a level has no false positives. Over the keys of
the corpus the cascade is then exact, and it is asked with bit arrays that are
constants of the plan: no join and no shuffle.

Two cascades are built: the keys of all rules among all keys, and the keys of block
rules among the rules. Their size follows the list of rules and the logarithm of the
corpus. Beyond ``MAX_LISTED`` rules the constants would be too large to ship with
every task; the same keys are then looked up by an equality join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
MAX_LISTED = 100_000
MAX_LEVELS = 64


def url_host(url: str) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def url_path(url: str) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def url_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """All keys a rule could have for this url: ends of the host of up to ``labels``
    labels, with the beginnings of the path of the given lengths. A key is a struct
    (n, h, key): length, length of its host, text."""
    parts = F.split(host, r"\.")
    start = F.greatest(F.lit(1), F.size(parts) - labels + 1)
    ends = F.transform(
        F.sequence(start, F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), ".")
    )
    fits = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path))
    begins = F.transform(fits, lambda n: F.substr(path, F.lit(1), n))
    pair = lambda h, p: F.struct(
        (F.length(h) + F.length(p)).alias("n"), F.length(h).alias("h"), F.concat(h, p).alias("key")
    )
    return F.flatten(F.transform(ends, lambda h: F.transform(begins, lambda p: pair(h, p))))


@dataclass(frozen=True)
class Level:
    seed: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.seed * 64 + i)), F.lit(self.bits)) for i in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        array = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")  # folded to a constant
        out = F.lit(True)
        for at in self.positions(key):
            out = out & (F.get(array, F.shiftright(at, 6).cast("int")).bitwiseAND(_one_bit(at)) != 0)
        return out


def _one_bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int"))


def fill_level(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    """A Bloom filter of ``n`` keys with about ``rate`` false positives. The bits of a
    word are joined before the shuffle."""
    bits = max(64, math.ceil(n * math.log(1 / rate) / math.log(2) ** 2))
    bits = -(-bits // 64) * 64
    empty = Level(seed, bits, max(1, round(math.log2(1 / rate))), ())
    at = keys.select(F.explode(F.array(*empty.positions(F.col("key")))).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(_one_bit(F.col("at"))).alias("set"))
    filled = [0] * (bits // 64)
    for r in words.toLocalIterator():
        filled[r["word"]] = r["set"]
    return Level(seed, bits, empty.hashes, tuple(filled))


def build_cascade(listed: DataFrame, others: DataFrame, n_others: int, seed: int = 1) -> list[Level]:
    """Levels that tell the keys of ``listed`` from all other keys of ``others``. Both
    have a column ``key``; ``others`` may repeat keys and hold listed ones."""
    n = listed.count()
    if not n:
        return []
    levels = [fill_level(listed, n, min(0.5, max(1e-9, n * math.sqrt(0.5) / max(1, n_others))), seed)]
    passed = others.where(levels[0].passes(F.col("key"))).distinct()
    inside, outside = listed, materialise(passed.join(listed, "key", "left_anti"), "cascade")
    while n := outside.count():
        if len(levels) == MAX_LEVELS:
            raise ValueError("the levels of the cascade do not end")
        levels.append(fill_level(outside, n, 0.5, seed + len(levels)))
        passed = inside.where(levels[-1].passes(F.col("key")))
        inside, outside = outside, materialise(passed, "cascade")
    return levels


def in_cascade(levels: list[Level], key: Column) -> Column:
    """True for listed keys: the first level that a key fails decides."""
    out = F.lit(len(levels) % 2 == 1)
    for number, level in reversed(list(enumerate(levels, 1))):
        out = F.when(level.passes(key), out).otherwise(F.lit(number % 2 == 0))
    return out


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
    max_listed: int = MAX_LISTED,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (block or allow). A rule fits its
    host and all hosts that end in a dot and it, if the path begins with the rule's;
    the longest fitting rule wins, of equally long ones that with the longer host. Of
    two rules for one key the blocking one counts; rules with a null are left out. A
    url that no rule fits, also a null or empty one, gets ``default`` and a null rule.
    Repeated rows stay repeated. Other columns are not read.
    """
    known = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
    listed = known.groupBy(F.concat("host", "path").alias("key")).agg(
        F.max(F.col("verdict") == "block").alias("blocks"),
        F.max(F.size(F.split("host", r"\."))).alias("labels"),
        F.collect_set(F.length("path")).alias("lengths"),
    )
    listed = materialise(listed, "rules")
    shape = listed.agg(
        F.max("labels").alias("labels"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("lengths")))).alias("lengths"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    urls = pages.select(F.col(id_col).alias("page_id"), url_host(url_col).alias("host"), url_path(url_col).alias("path"))
    plain = ["page_id", "host", "path"]
    if not shape["n"]:
        return urls.select(*plain, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    keyed = urls.withColumn("keys", url_keys(F.col("host"), F.col("path"), shape["labels"], shape["lengths"]))
    if shape["n"] > max_listed:
        return _by_join(keyed, listed, default)
    universe = keyed.select(F.explode("keys.key").alias("key"))
    n = keyed.agg(F.sum(F.size("keys"))).first()[0] or 0
    rule_keys = listed.select("key")
    any_rule = build_cascade(rule_keys, universe, n)
    blocking = build_cascade(listed.where("blocks").select("key"), rule_keys, shape["n"], seed=1000)
    best = F.array_max(F.filter("keys", lambda k: in_cascade(any_rule, k["key"])))
    verdict = F.when(in_cascade(blocking, F.col("rule")), "block").otherwise("allow")
    judged = keyed.select(*plain, best["key"].alias("rule"))
    return judged.withColumn("verdict", F.when(F.col("rule").isNull(), F.lit(default)).otherwise(verdict))


def _by_join(keyed: DataFrame, listed: DataFrame, default: str) -> DataFrame:
    """The same judgement by an equality join on the keys, for lists of any length."""
    numbered = keyed.withColumn("row", F.monotonically_increasing_id())
    stored = materialise(numbered, "urls")
    keys = stored.select("row", F.explode("keys").alias("k"))
    hits = keys.join(listed, keys["k.key"] == listed["key"]).groupBy("row")
    best = hits.agg(F.max(F.struct("k.n", "k.h", "k.key", "blocks")).alias("best"))
    verdict = F.when(F.col("best.blocks"), "block").when(F.col("best").isNotNull(), "allow").otherwise(default)
    return stored.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("best.key").alias("rule"), verdict.alias("verdict")
    )
