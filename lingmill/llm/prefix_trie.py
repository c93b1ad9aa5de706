"""A trie of conversations that share their first turns, built by bursting containers.

1. A turn becomes an id, a digest of its role and text; a conversation becomes the
   sequence of its ids. Equal sequences are one row from here on.
2. A container holds the sequences below one head of the trie. A container that is too large
   bursts: its sequences are followed to the turn at which they part, and go to
   one container for each next id. Containers are counted, never gathered, to find this out.
3. What remains is dealt to tasks by head and sorted; each container is swept into nodes.
4. Nodes above burst containers are sums over the containers' heads, round by round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingmill.session import settle

# Sequences that one container may hold.
CONTAINER = 512
# Hexadecimal digits of a turn's id.
DIGITS = 32
# Conversation ids that are hashed as one piece.
PIECE = 4096
SPACES = r"[\x20\x09-\x0D]+"
NONE = hashlib.sha256().hexdigest()
NODE = [
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
]
COLUMNS = [name for name, _ in NODE]
SWEPT = pa.schema([*NODE, ("head", pa.string()), ("is_head", pa.bool_())])
SWEPT_SQL = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends_sha256 string, head string, is_head boolean"
)


def turn_id(role: Column, text: Column) -> Column:
    """128 bits of the SHA-256 of a turn, in hexadecimal digits."""
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, DIGITS)


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): one row a conversation, its (id, words) in turn order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    words = F.size(F.filter(F.split(text, SPACES), lambda w: w != ""))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", turn_id(role, text).alias("id"), words.alias("words")).alias("one")
    )
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    return held.select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def share_openings(convs: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """``convs`` with their first h turns replaced by those of conversation c - c % ``every``.

    h is the unsigned CRC32 of the decimal conv_id, modulo ``most`` + 1.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    opening = convs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("opening")
    )
    based = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(opening, "base", "left")
    own = F.slice("turns", h + 1, F.size("turns") + 1)
    shared = F.slice("opening", F.lit(1), h)
    return based.select("conv_id", F.when(F.col("opening").isNull(), own).otherwise(F.concat(shared, own)).alias("turns"))


def id_digests(members: DataFrame) -> DataFrame:
    """(key, ends_sha256): the digest of each key's conv_ids, ascending and comma-joined.

    The ids are sorted by range, so that tasks share the ids of a key that has very many, and
    joined in pieces; one task a key hashes the pieces one after the other.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, str]] = []
        key, ids = None, []
        for batch in batches:
            for k, one in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (k != key or len(ids) == PIECE):
                    out.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(one)
            if out:
                yield rows_of(out)
                out = []
        if ids:
            yield rows_of([(key, ids[0], ",".join(map(str, ids)))])

    def rows_of(out: list[tuple[str, int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["key", "first", "piece"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            keys, found = [], []
            for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist()):
                if k == key:
                    digest.update(b",")
                else:
                    if digest is not None:
                        keys.append(key)
                        found.append(digest.hexdigest())
                    key, digest = k, hashlib.sha256()
                digest.update(piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(found, pa.string())], ["key", "ends_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

    ranged = members.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    joined = ranged.mapInArrow(pieces, "key string, first long, piece string")
    return joined.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "key string, ends_sha256 string")


def sequences(convs: DataFrame) -> DataFrame:
    """(seq, words, n, first, ends): every distinct sequence, the number and the smallest id of
    its conversations, and the digest of their ids."""
    sized = convs.select(
        "conv_id", F.array_join(F.col("turns")["id"], "").alias("seq"), F.col("turns")["words"].alias("words")
    ).withColumn("key", F.sha2("seq", 256))
    rows = settle(sized, "sequences")
    distinct = rows.groupBy("key").agg(
        F.first("seq").alias("seq"), F.first("words").alias("words"), F.count("*").alias("n"), F.min("conv_id").alias("first")
    )
    return distinct.join(id_digests(rows).withColumnRenamed("ends_sha256", "ends"), "key").drop("key")


def common_turns(a: Column, b: Column) -> Column:
    """How many turns two sequences share from the first on."""
    shorter = F.least(F.length(a), F.length(b)) / DIGITS
    places = F.sequence(F.lit(0), shorter.cast("int"))
    same = F.filter(places, lambda k: F.left(a, k * DIGITS) == F.left(b, k * DIGITS))
    return F.array_max(same)


def burst(seqs: DataFrame, container: int) -> tuple[DataFrame, list[DataFrame]]:
    """(contained, bursts): every sequence that does not end at a burst, with the ``head`` of its
    container, and per round the burst containers: ``head``, ``level`` (turns of the head),
    ``fork`` (turns to where they part), ``parent`` head, ``words`` and the sequence that
    ends at the fork, if any. The root's head is the empty text."""
    # Stored, so that the first head is a column to join on and no constant.
    live = settle(seqs.withColumns({"head": F.lit(""), "parent": F.lit(None).cast("string")}), "distinct")
    done, bursts = [], []
    while True:
        sizes = live.groupBy("head").agg(
            F.count("*").alias("size"), F.min(F.struct("seq", "words", "n", "first", "ends")).alias("low"),
            F.max("seq").alias("high"), F.first("parent").alias("parent"),
        )
        large = settle(
            sizes.where(F.col("size") > container).select(
                "head", "parent", (F.length("head") / DIGITS).cast("int").alias("level"),
                common_turns(F.col("low")["seq"], F.col("high")).alias("fork"), "low",
            ),
            "bursts",
        )
        if large.isEmpty():
            done.append(live.select("seq", "words", "n", "first", "ends", "head", "parent"))
            return settle(reduce(DataFrame.unionByName, done), "contained"), bursts
        bursts.append(large)
        forks = large.select("head", "fork")
        known = live.join(forks, "head", "left")
        done.append(settle(known.where("fork is null").select("seq", "words", "n", "first", "ends", "head", "parent"), "contained"))
        moved = known.where(F.length("seq") > F.col("fork") * DIGITS)
        live = settle(
            moved.select(
                "seq", "words", "n", "first", "ends", F.left("seq", (F.col("fork") + 1) * DIGITS).alias("head"),
                F.col("head").alias("parent"),
            ),
            "live",
        )


def swept(head: str, rows: Iterable[tuple[str, list[int], int, int, str]]) -> list[list]:
    """The nodes of one container, the head first; ``rows`` are (seq, words, n, first, ends) by
    ascending seq. A node is its columns in the order of COLUMNS."""
    level = len(head) // DIGITS
    nodes: list[list] = []
    parents: list[int] = []
    path: list[int] = []  # numbers of the open nodes, from the head on
    costs: list[int] = []
    before = head
    for seq, words, n, first, ends in rows:
        depth = len(seq) // DIGITS
        same = level
        while same < min(depth, len(before) // DIGITS) and seq[same * DIGITS : (same + 1) * DIGITS] == before[same * DIGITS : (same + 1) * DIGITS]:
            same += 1
        if nodes:
            del path[same - level + 1 :]
        for d in range(level if not nodes else same + 1, depth + 1):
            parents.append(path[-1] if path else -1)
            path.append(len(nodes))
            costs.append(words[d - 1] if d else 0)
            nodes.append([first, d, None, 0, 0, 0, 0, NONE])
        nodes[path[-1]][7] = ends
        for at in path:
            nodes[at][0] = min(nodes[at][0], first)
            nodes[at][3] += n
        before = seq
    # Children follow their parents, so the reverse meets them first.
    for at in range(len(nodes) - 1, -1, -1):
        node, up = nodes[at], parents[at]
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * costs[at]
        if up >= 0:
            node[2] = nodes[up][0]
            nodes[up][4] += 1
            nodes[up][5] += node[5]
            nodes[up][6] += node[6]
    return nodes


def sweep(contained: DataFrame) -> DataFrame:
    """The nodes of all containers, from their heads down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, rows = None, []

        def emitted() -> pa.RecordBatch:
            nodes = swept(head, rows)
            columns = [*zip(*nodes), [head] * len(nodes), [True] + [False] * (len(nodes) - 1)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SWEPT)], schema=SWEPT)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("head", "seq", "words", "n", "first", "ends"))
            for h, *row in zip(*columns):
                if rows and h != head:
                    yield emitted()
                    rows = []
                head = h
                rows.append(row)
        if rows:
            yield emitted()

    held = contained.select("head", "seq", "words", "n", "first", "ends").repartition("head")
    return held.sortWithinPartitions("head", "seq").mapInArrow(run, SWEPT_SQL)


def burst_nodes(large: DataFrame, heads: DataFrame) -> DataFrame:
    """The nodes of one round's burst containers, from head to fork, out of the ``heads`` below.

    ``heads`` has the columns of a node and ``parent``, the burst container above it.
    """
    below = heads.groupBy(F.col("parent").alias("head")).agg(
        F.sum("n_convs").alias("below_convs"), F.min("conv_id").alias("below_first"), F.count("*").alias("below_children"),
        F.sum("n_leaves").alias("below_leaves"), F.sum("saved_tokens").alias("below_saved"),
    )
    ending = F.length(F.col("low")["seq"]) == F.col("fork") * DIGITS
    joined = large.join(below, "head").select(
        "head", "level", "fork", F.col("low")["words"].alias("words"), "below_children", "below_leaves", "below_saved",
        (F.col("below_convs") + F.when(ending, F.col("low")["n"]).otherwise(0)).alias("n_convs"),
        F.least("below_first", F.when(ending, F.col("low")["first"])).alias("conv_id"),
        F.when(ending, F.col("low")["ends"]).otherwise(NONE).alias("ends"),
    )
    # Between head and fork all conversations go the same way.
    chain = joined.withColumn("depth", F.explode(F.sequence("level", "fork")))
    at_fork = F.col("depth") == F.col("fork")
    costs = F.aggregate(F.slice("words", F.greatest("depth", F.lit(1)), F.col("fork") - F.greatest("depth", F.lit(1)) + 1), F.lit(0).cast("long"), lambda s, w: s + w)
    return chain.select(
        "conv_id", F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > F.col("level"), F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        F.when(at_fork, F.col("below_children")).otherwise(1).alias("n_children"), F.col("below_leaves").alias("n_leaves"),
        (F.col("below_saved") + (F.col("n_convs") - 1) * costs).alias("saved_tokens"),
        F.when(at_fork, F.col("ends")).otherwise(NONE).alias("ends_sha256"), "head",
        (F.col("depth") == F.col("level")).alias("is_head"),
    )


def trie_of(convs: DataFrame, container: int = CONTAINER) -> DataFrame:
    """The nodes of the trie of ``convs``: (conv_id, turns array of (id, words)), one row a conversation.

    Per node: conv_id, its smallest member; depth; parent_conv_id; n_convs; n_children;
    n_leaves; saved_tokens; ends_sha256, the digest of the ids of those that end there.
    Without conversations there is no node.
    """
    contained, bursts = burst(sequences(convs), container)
    parents = contained.groupBy("head").agg(F.first("parent").alias("parent"))
    lower = settle(sweep(contained), "nodes")
    nodes = [lower]
    heads = settle(lower.where("is_head").join(parents, "head"), "heads")
    for large in reversed(bursts):
        made = settle(burst_nodes(large, heads), "nodes")
        nodes.append(made)
        heads = heads.unionByName(made.where("is_head").join(large.select("head", "parent"), "head"))
    if bursts:
        # A head's parent is the fork of the burst container above it.
        forks = reduce(DataFrame.unionByName, [
            made.groupBy("head").agg(F.min("conv_id").alias("__above")) for made in nodes[1:]
        ]).withColumnRenamed("head", "parent")
        above = heads.select("head", "parent").join(forks, "parent").select("head", "__above")
        every = reduce(DataFrame.unionByName, nodes)
        inner, outer = every.where("not is_head"), every.where("is_head").join(above, "head", "left")
        return inner.select(COLUMNS).unionByName(outer.withColumn("parent_conv_id", F.col("__above")).select(COLUMNS))
    return lower.select(COLUMNS)


def shared_prefixes(turns: DataFrame, container: int = CONTAINER) -> DataFrame:
    """The trie of conversations that share openings (``share_openings``), one row a node.

    Turns are ordered by number, null first, equal numbers by a digest of role and text.
    Null roles and texts are empty; rows without a conv_id belong to no conversation;
    repeated rows are turns of their own; columns other than conv_id, turn, role and text
    are ignored. An empty table gives no node. The ids of one conversation's turns
    are one row (32 bytes a turn); texts are read once and not exchanged.
    """
    return trie_of(share_openings(settle(ordered_turns(turns), "turns")), container)
