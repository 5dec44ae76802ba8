"""Prefix tree of conversations by block hashing.

Conversations are cut into blocks of ``BLOCK_TURNS`` turns. A block is known by the hash of
everything up to its end, and conversations are first grouped by these hashes: one row for
each distinct block under each distinct beginning, with its number of conversations and the
smallest of them. Where a beginning is followed by one block only, every turn of the block
has the members of the block, and its nodes are written down without looking at turns. Only
where several blocks follow one beginning are turn boundaries refined: the distinct blocks,
not the conversations, are taken apart into turns and added up by the hash of the prefix
that ends at each turn.

Prefix hashes are sums of hashes of (place, turn), so the hash at the end of each block is a
running sum over the blocks of a conversation, which the library computes in slices where
one conversation holds very many turns. A turn is known by the SHA-256 of its role and text,
a prefix by four sums of 32-bit hashes; texts themselves are read once and never shuffled.

Sums over subtrees follow from the smallest member of each node. The nodes whose smallest
member is c are the lower end of c's path. A node's subtree holds such an end of each of its
members: the part from the node downwards for its own smallest member, all of it for the
others. So each conversation sends the totals of its own nodes to the nodes above them,
added up by block before they are spread over turns.

Members that end at a node are sorted by Spark's range partitioner, joined into pieces of
bounded size in each partition, and the pieces of a node are hashed in order, one piece at a
time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.ordered import Heat, heat_of, running
from millrace.sources.tables import discard, materialise

BLOCK_TURNS = 4
LANES = 4
#: Most ids in one piece of a list of members.
PIECE_IDS = 65_536
NO_IDS = hashlib.sha256(b"").hexdigest()


def turn_digests(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, turn, digest, chars``: the SHA-256 of role and text, and the code points of
    the text. Null role or text is empty; rows without a conversation are left out."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(whole, 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )


def in_order(turns: DataFrame, heat: Heat | None = None) -> DataFrame:
    """``conv_id, pos, digest, chars``: turns numbered from 0 in the order of ``turn``, null
    first; turns with one number are in the order of their digests."""
    placed = running(turns, ["conv_id"], ["turn", "digest"], heat=heat, pos=("count", F.lit(1)))
    return placed.select("conv_id", (F.col("pos") - 1).alias("pos"), "digest", "chars")


def share_openings(placed: DataFrame, convs: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """Conversations that share their openings: the first h turns of c are replaced by the
    first h of conversation c - c % ``every`` (all of them if it has fewer, none if it is
    absent), where h is the CRC-32 of c in decimal modulo ``most`` + 1."""
    base = F.col("conv_id") - F.col("conv_id") % every
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    first = placed.where((F.col("conv_id") % every == 0) & (F.col("pos") < most))
    opening = F.sort_array(F.collect_list(F.struct("pos", "digest", "chars")))
    first = materialise(first.groupBy(F.col("conv_id").alias("base")).agg(opening.alias("opening")), "openings")
    begun = convs.withColumns({"base": base, "h": taken}).where("h > 0").join(first, "base")
    begun = begun.select("conv_id", F.explode(F.slice("opening", 1, F.col("h").cast("int"))).alias("t"))
    own = placed.withColumns({"base": base, "h": taken}).where("pos >= h")
    own = own.join(first.select("base", F.size("opening").alias("n")), "base", "left")
    shift = F.least("h", F.coalesce("n", F.lit(0)).cast("long")) - F.col("h")
    return begun.select("conv_id", "t.pos", "t.digest", "t.chars").unionByName(
        own.select("conv_id", (F.col("pos") + shift).alias("pos"), "digest", "chars")
    )


def _node(depth: Column, lanes: list[Column]) -> Column:
    """Name of a prefix."""
    return F.unhex(F.sha2(F.concat_ws(",", depth, *lanes), 256))


def _root() -> Column:
    return _node(F.lit(0).cast("long"), [F.lit(0).cast("long")] * LANES)


def _blocks(turns: DataFrame, heat: Heat) -> DataFrame:
    """A row for each block of each conversation: ``conv_id, block, before, inner, end``.
    ``before`` and ``end`` name the prefixes at its borders, ``inner`` the prefix after each
    of its turns, with the code points of that turn."""
    hashes = [F.xxhash64(F.lit(k), "digest", "pos") for k in range(LANES // 2)]
    halves = [half for h in hashes for half in (h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32))]
    names = [f"l{k}" for k in range(LANES)]
    rows = turns.withColumns(dict(zip(names, halves)))
    rows = rows.withColumn("block", F.floor(F.col("pos") / BLOCK_TURNS))
    made = rows.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.struct("pos", "chars", *names))).alias("turns"),
        *[F.sum(n).alias(n) for n in names],
    )
    made = running(made, ["conv_id"], ["block"], heat=heat, **{f"r{k}": ("sum", F.col(n)) for k, n in enumerate(names)})
    begun = [F.col(f"r{k}") - F.col(n) for k, n in enumerate(names)]

    def upto(i: Column, k: int) -> Column:
        return F.aggregate(F.slice("turns", F.lit(1), i + 1), begun[k], lambda sum_, t: sum_ + t[names[k]])

    inner = F.transform(
        "turns",
        lambda t, i: F.struct(_node(t["pos"] + 1, [upto(i, k) for k in range(LANES)]).alias("node"), t["chars"].alias("chars")),
    )
    return made.select(
        "conv_id", "block", _node(F.col("block") * BLOCK_TURNS, begun).alias("before"), inner.alias("inner")
    ).withColumn("end", F.element_at("inner", -1)["node"])


def _nodes(blocks: DataFrame, convs: DataFrame) -> DataFrame:
    """``node, parent, depth, n_convs, conv_id, chars`` of every prefix, the root included."""
    groups = blocks.groupBy("before", "end", "block").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("inner").alias("inner")
    )
    groups = materialise(groups, "trie-groups")
    siblings = groups.groupBy("before").agg(F.count(F.lit(1)).alias("siblings"))
    turns = groups.join(siblings, "before").select(
        "before", "block", "n_convs", "conv_id", "siblings", "inner", F.posexplode("inner").alias("i", "turn")
    )
    turns = turns.select(
        F.col("turn.node").alias("node"),
        F.when(F.col("i") == 0, F.col("before")).otherwise(F.get("inner", F.col("i") - 1)["node"]).alias("parent"),
        (F.col("block") * BLOCK_TURNS + F.col("i") + 1).alias("depth"),
        "n_convs", "conv_id", F.col("turn.chars").alias("chars"), "siblings",
    )
    whole = turns.where("siblings = 1").drop("siblings")
    refined = turns.where("siblings > 1").groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"), F.min("chars").alias("chars"),
    )
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    nothing = F.lit(0).cast("long")
    root = root.select(
        _root().alias("node"), F.lit(None).cast("binary").alias("parent"), nothing.alias("depth"), "n_convs", "conv_id",
        nothing.alias("chars"),
    )
    return whole.unionByName(refined).unionByName(root)


def _from_below(blocks: DataFrame, chains: DataFrame) -> DataFrame:
    """``node, saved, leaves``: totals of the chains of members other than the smallest."""
    first = F.col("block") * BLOCK_TURNS + 1
    met = blocks.join(chains.where("top > 0"), "conv_id").where(first < F.col("top"))
    cut = F.least(F.col("top") - first, F.size("inner").cast("long")).cast("int")
    sums = [F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")]
    by_block = met.groupBy("end", cut.alias("cut")).agg(F.first("inner").alias("inner"), *sums)
    spread = by_block.select(F.explode(F.slice("inner", 1, F.col("cut"))).alias("t"), "saved", "leaves")
    inside = spread.groupBy(F.col("t.node").alias("node")).agg(*sums)
    return inside.unionByName(chains.where("top > 0").agg(*sums).select(_root().alias("node"), "saved", "leaves"))


def ordered_digests(members: DataFrame, piece_ids: int = PIECE_IDS) -> DataFrame:
    """``node, ends_sha256`` of rows ``node, conv_id``: SHA-256 of the ids of each node in
    ascending order, in decimal, joined by commas."""

    kinds = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        done: dict[str, list] = {"node": [], "first": [], "ids": []}

        def close() -> None:
            for name, value in zip(done, (node, ids[0], ",".join(map(str, ids)))):
                done[name].append(value)

        for batch in batches:
            for n, c in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (n != node or len(ids) >= piece_ids):
                    close()
                    ids = []
                node = n
                ids.append(c)
            yield pa.RecordBatch.from_pydict(done, kinds)
            done = {name: [] for name in done}
        if ids:
            close()
            yield pa.RecordBatch.from_pydict(done, kinds)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = {"node": [], "ends_sha256": []}
            for n, text in zip(batch.column("node"), batch.column("ids")):
                n, text = n.as_py(), text.as_py()
                if n != node:
                    if state is not None:
                        done["node"].append(node)
                        done["ends_sha256"].append(state.hexdigest())
                    node, state = n, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_pydict(done, pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())]))
        if state is not None:
            yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [state.hexdigest()]})

    ordered = members.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    made = ordered.mapInArrow(pieces, "node binary, first long, ids string")
    return made.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashed, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, heat: Heat | None = None) -> DataFrame:
    """Nodes of the prefix tree of conversations.

    ``turns`` has ``conv_id, pos, digest, chars`` with places from 0 without gaps, ``convs``
    every ``conv_id`` once, those without turns included. One row for each node: ``node``
    and ``parent`` (names of prefixes), ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256`` (of the members that end there). Without conversations there is no node,
    not even the root. Repeated turns inside a conversation are turns of their own; equal
    conversations share all their nodes.
    """
    heat = heat or heat_of(turns, ["conv_id"])
    blocks = materialise(_blocks(turns, heat), "trie-blocks")
    nodes = materialise(_nodes(blocks, convs), "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    whole = nodes.join(children, "node", "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)).cast("long"),
        "_own": (F.col("n_convs") - 1) * F.col("chars"),
        "_up": -F.col("depth"),
    })
    held = materialise(running(whole, ["conv_id"], ["_up"], heat=heat, tail=("sum", F.col("_own"))), "trie-tails")
    leaf = (F.col("n_children") == 0).cast("long")
    chains = materialise(
        held.groupBy("conv_id").agg(F.min("depth").alias("top"), F.max("tail").alias("saved"), F.max(leaf).alias("leaves")),
        "trie-chains",
    )
    below = _from_below(blocks, chains)
    last = blocks.groupBy("conv_id").agg(F.max_by("end", "block").alias("node"))
    ends = convs.join(last, "conv_id", "left").select(F.coalesce("node", _root()).alias("node"), "conv_id")
    digests = ordered_digests(materialise(ends, "trie-ends"))
    own = held.join(chains.select("conv_id", F.col("leaves").alias("own_leaves")), "conv_id")
    own = own.join(below, "node", "left").join(digests, "node", "left")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = F.lit(0).cast("long")
    out = own.join(parents, "parent", "left").select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("own_leaves") + F.coalesce("leaves", none)).alias("n_leaves"),
        (F.col("tail") + F.coalesce("saved", none)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"),
    )
    out = materialise(out, "trie")
    for step in (blocks, nodes, held, chains):
        discard(step)
    return out


def conversation_trie(conversations: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """``prefix_trie`` of the conversations of a table ``conv_id, turn, role, text`` that
    share their openings as ``share_openings`` states. Rows without ``conv_id`` are left out;
    null role or text is empty; other columns are not read."""
    turns = materialise(turn_digests(conversations), "turns")
    heat = heat_of(turns, ["conv_id"])
    convs = materialise(turns.select("conv_id").distinct(), "conversations")
    placed = materialise(in_order(turns, heat), "turns-in-order")
    out = prefix_trie(share_openings(placed, convs, every, most), convs, heat)
    for step in (turns, convs, placed):
        discard(step)
    return out
