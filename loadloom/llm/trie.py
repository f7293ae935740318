"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

A node is a distinct sequence of the first d turns of some conversation. Its name is a digest, made in levels so that no task
holds a whole conversation: turns are digested in chunks of ``CHUNK``, the chunks of a conversation in chunks again, and so on.

Subtree totals: each round first rakes all leaves (their totals are final and go to their parents, summed before the shuffle),
then compresses chains of nodes with one child: stretches along one conversation are merged into their lowest node at once, and
where the only child follows another conversation, a coin picks nodes of which no two meet. A merged node leaves a link to the
node that it went into, with the weight between them. At the end the links are followed backwards, so every node has its total.
Rounds grow with the logarithm of the tree, whether it is one long chain, a star or anything between.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadloom.llm.graphs import written

#: Turns, or chunks, that are digested together.
CHUNK = 64
#: Depths along one conversation that are compressed together in the first round, and how much longer each round's stretch is.
STRETCH, GROWTH = 256, 4
#: Ids joined into one text before they are hashed one after another.
IDS = 4096
ROOT = "root"


def _digest(*parts: Column | str) -> Column:
    """128 bits of SHA-256 over parts without a slash in all but the last."""
    return F.left(F.sha2(F.concat_ws("/", *[F.lit(p) if isinstance(p, str) else p for p in parts]), 256), F.lit(32))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text): the turns of each conversation from 0, null role and text empty; written.

    Order: turn, null first; equal turns by role, then text; equal rows all stay. Rows without conv_id are left out. Rows are dealt
    by ranges of that order and counted per range, so a conversation may be of any length.
    """
    spark = conversations.sparkSession
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("copy"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    rows = rows.select("conv_id", "role", "text", F.shiftright(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("at"))
    rows = written(rows, "turns")
    parts = rows.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = rows.join(parts, ["conv_id", "part"])
    return placed.select("conv_id", (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "role", "text")


def with_shared_heads(turns: DataFrame, every: int = 20, lengths: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, pos, role, text) and all conversations (conv_id, total).

    Conversation c begins with the first h turns of conversation c - c % ``every`` (all if it has fewer, none if there is no
    such), and goes on with its own after its first h; h is the unsigned crc32 of c as a decimal, modulo ``lengths``.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % lengths
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("h", head).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    bases = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("lent", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = written(convs.select("conv_id", "base", "h", "lent", (F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")), "conversations")
    own = turns.join(convs, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "role", "text")
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < lengths - 1)).withColumnRenamed("conv_id", "base")
    lent = convs.join(heads, "base").where("pos < h").select("conv_id", "pos", "role", "text")
    return own.unionByName(lent), convs.select("conv_id", "total")


def _named(turns: DataFrame, level: int = 0) -> DataFrame:
    """(conv_id, pos, payload, name, parent) from (conv_id, pos, digest, payload): digests of every prefix and of the one before."""
    chunk = F.floor(F.col("pos") / CHUNK)
    chunks = turns.groupBy("conv_id", chunk.alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "payload"))).alias("turns"))
    begin = lambda n: F.array_join(F.transform(F.slice("turns", 1, n), lambda t: t["digest"]), "")
    inner = F.transform(F.sequence(F.lit(1), F.size("turns")), lambda n: _digest(f"in{level}", begin(n)))
    chunks = written(chunks.withColumn("inner", inner), "chunks")
    if chunks.where("chunk > 0").isEmpty():
        chunks = chunks.withColumn("names", F.transform("inner", lambda x: _digest(f"first{level}", x))).withColumn("head", F.lit(ROOT))
    else:
        upper = chunks.select("conv_id", F.col("chunk").alias("pos"), F.element_at("inner", -1).alias("digest"), F.lit(None).cast("string").alias("payload"))
        upper = _named(upper, level + 1).select("conv_id", F.col("pos").alias("chunk"), F.col("name").alias("whole"), F.col("parent").alias("head"))
        # A full chunk's last prefix is named as the chunk above it is, so that the next chunk finds its parent there.
        name = lambda x, i: F.when(i == CHUNK - 1, F.col("whole")).otherwise(_digest(f"next{level}", F.col("head"), x))
        chunks = chunks.join(upper, ["conv_id", "chunk"]).withColumn("names", F.transform("inner", name))
    each = F.transform("turns", lambda t, i: F.struct(t["pos"].alias("pos"), t["payload"].alias("payload"), F.get("names", i).alias("name"), F.when(i == 0, F.col("head")).otherwise(F.get("names", i - 1)).alias("parent")))
    return chunks.select("conv_id", F.explode(each).alias("t")).select("conv_id", "t.*")


def _sha_of_ids(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (node, conv_id): SHA-256 of the ids in order, joined by commas.

    Ids are joined into texts of ``IDS`` in parallel; a task then reads the texts of a node one by one into one hash.
    """
    import hashlib

    import pyarrow as pa

    def joined(batches):
        node, ids = None, []
        for batch in batches:
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (key != node or len(ids) == IDS):
                    yield pa.RecordBatch.from_pydict({"node": [node], "first": [ids[0]], "ids": [",".join(map(str, ids))]})
                    ids = []
                node = key
                ids.append(conv)
        if ids:
            yield pa.RecordBatch.from_pydict({"node": [node], "first": [ids[0]], "ids": [",".join(map(str, ids))]})

    def hashed(batches):
        node, state = None, None
        for batch in batches:
            nodes, shas = [], []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if state:
                    nodes.append(node)
                    shas.append(state.hexdigest())
                node, state = key, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.string()), "ends_sha256": pa.array(shas, pa.string())})
        if state:
            yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [state.hexdigest()]})

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = ends.repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(joined, "node string, first bigint, ids string")
    return texts.repartition(parts, "node").sortWithinPartitions("node", "first").mapInArrow(hashed, "node string, ends_sha256 string")


TOTALS = ("leaves", "saved")


def _rake(tree: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves with their totals, and the rest with the leaves' totals added.

    ``tree``: id, parent (null: root), label, depth, kids, and for each total its own sum and the sum of nodes merged above it.
    """
    leaf = F.col("kids") == 0
    add = [F.sum(F.when(leaf, F.col(t) + F.col(f"above_{t}"))).alias(f"raked_{t}") for t in TOTALS]
    only = F.min(F.when(~leaf, F.struct("id", "label")))
    sums = tree.where("parent is not null").groupBy("parent").agg(*add, F.count(F.when(~leaf, 1)).alias("kept"), only.alias("only"))
    rest = tree.where(~leaf).join(sums.withColumnRenamed("parent", "id"), "id")
    rest = rest.select(
        "id", "parent", "label", "depth", F.col("kept").alias("kids"),
        *[(F.col(t) + F.coalesce(F.col(f"raked_{t}"), F.lit(0))).alias(t) for t in TOTALS], *[f"above_{t}" for t in TOTALS],
        F.when((F.col("kept") == 1) & F.col("parent").isNotNull(), F.col("only")).alias("only"),
    )
    return tree.where(leaf).select("id", *TOTALS), rest


def _meets_another(turn: int) -> Column:
    """Whether a node goes into its only child of another label: its coin shows 1 and the child's 0, so no two such nodes meet."""
    coin = lambda c: F.pmod(F.xxhash64(c, F.lit(turn)), F.lit(2))
    gone = F.col("only").isNotNull() & (F.col("only.label") != F.col("label")) & (coin(F.col("id")) == 1) & (coin(F.col("only.id")) == 0)
    return F.coalesce(gone, F.lit(False))


def _compress_between(rest: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Merges nodes into an only child of another label. Returns the rest and the links (id, into, and the weight of each total
    between them)."""
    gone = _meets_another(turn)
    merged = rest.where(gone).select(F.col("only.id").alias("id"), F.col("id").alias("gone"), F.col("parent").alias("to"), *[F.col(t).alias(f"m_{t}") for t in TOTALS], *[F.col(f"above_{t}").alias(f"ma_{t}") for t in TOTALS])
    kept = written(rest.where(~gone).join(merged, "id", "left"), "between")
    zero = F.lit(0)
    links = kept.where("gone is not null").select(F.col("gone").alias("id"), F.col("id").alias("into"), *[(F.col(f"m_{t}") + F.col(f"above_{t}")).alias(t) for t in TOTALS])
    kept = kept.select(
        "id", F.when(F.col("gone").isNotNull(), F.col("to")).otherwise(F.col("parent")).alias("parent"), "label", "depth", "kids", *TOTALS,
        *[(F.col(f"above_{t}") + F.coalesce(F.col(f"m_{t}"), zero) + F.coalesce(F.col(f"ma_{t}"), zero)).alias(f"above_{t}") for t in TOTALS],
        "only",
    )
    return kept, links


def _compress_along(rest: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Merges runs of nodes with one child, along one label and within a stretch of depths, into their lowest node."""
    stretch = F.floor(F.col("depth") / (STRETCH * GROWTH**turn))
    along = Window.partitionBy("label", stretch).orderBy("depth")
    down = F.coalesce(F.col("only.id") == F.lead("id").over(along), F.lit(False))
    rows = rest.withColumn("down", down)
    # A run ends with a node that does not go down.
    ends = F.sum(F.when(F.col("down"), 0).otherwise(1)).over(along.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("run", F.coalesce(ends, F.lit(0)))
    run = Window.partitionBy("label", stretch, "run").orderBy(F.col("depth").desc())
    below, whole = run.rowsBetween(Window.unboundedPreceding, -1), run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0)
    columns = {"into": F.first("id").over(whole), "top": F.last("parent").over(whole)}
    for t in TOTALS:
        # All own sums in the run but the lowest node's, from here down; all sums above nodes below this one.
        columns[f"w_{t}"] = F.sum(F.when(F.col("down"), F.col(t)).otherwise(0)).over(run) + F.coalesce(F.sum(f"above_{t}").over(below), zero)
        columns[f"a_{t}"] = F.sum(F.when(F.col("down"), F.col(t)).otherwise(0) + F.col(f"above_{t}")).over(whole)
    rows = written(rows.withColumns(columns), "along")
    links = rows.where("down").select("id", "into", *[F.col(f"w_{t}").alias(t) for t in TOTALS])
    kept = rows.where("not down").select("id", F.col("top").alias("parent"), "label", "depth", "kids", *TOTALS, *[F.col(f"a_{t}").alias(f"above_{t}") for t in TOTALS])
    return kept, links


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """(id, leaves, saved): sums over each node's subtree, itself included.

    ``nodes``: id, parent (null for a root), label, depth, kids (children), leaves, saved (the node's own). Along a label no two
    nodes have one depth, and a node's label is that of one of its children, if it has any; this decides how fast chains shrink,
    not the result.
    """
    tree = written(nodes.select("id", "parent", "label", "depth", "kids", *TOTALS, *[F.lit(0).cast("bigint").alias(f"above_{t}") for t in TOTALS]), "tree")
    raked, links, turn = [], [], 0
    while not tree.isEmpty():
        leaves, rest = _rake(tree)
        raked.append(leaves)
        rest = written(rest, "raked")
        if not rest.where(_meets_another(turn)).isEmpty():
            rest, between = _compress_between(rest, turn)
            links.append(between)
        tree, along = _compress_along(rest, turn)
        links.append(along)
        turn += 1
    if not raked:
        return nodes.select("id", *TOTALS)
    known = [written(reduce(DataFrame.unionByName, raked), "totals")]
    for link in reversed(links):
        if link.isEmpty():
            continue
        totals = reduce(DataFrame.unionByName, known).select(F.col("id").alias("into"), *[F.col(t).alias(f"total_{t}") for t in TOTALS])
        found = link.join(totals, "into").select("id", *[(F.col(t) + F.col(f"total_{t}")).alias(t) for t in TOTALS])
        known.append(written(found, "totals"))
    return reduce(DataFrame.unionByName, known)


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per node.

    ``turns``: conv_id, pos (from 0, gapless), role, text; ``convs``: conv_id, total (its number of turns; with none it is a member
    of the root only). ``saved_tokens`` sums over the subtree each node's words (``[^\\x20\\x09-\\x0D]+`` of its last text) times
    one less than its members. Without conversations there is no node. Other columns are ignored.
    """
    words = F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    digest = _digest(F.length("role").cast("string"), F.concat("role", "text"))
    rows = turns.select("conv_id", "pos", digest.alias("digest"), words.cast("string").alias("payload"))
    rows = _named(rows).select("conv_id", (F.col("pos") + 1).alias("depth"), "name", "parent", F.col("payload").cast("bigint").alias("words"))
    rows = rows.join(convs, "conv_id")
    every = convs.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(ROOT).alias("name"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("bigint").alias("words"), "total")
    rows = written(rows.select(*every.columns).union(every), "members")
    nodes = rows.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.count("*").alias("n_convs"),
        F.max("words").alias("words"), F.max(F.struct("total", "conv_id"))["conv_id"].alias("label"),
    )
    nodes = written(nodes, "nodes")
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = written(nodes, "nodes")
    saved = (F.col("n_convs") - 1) * F.col("words")
    totals = subtree_totals(nodes.select(F.col("name").alias("id"), "parent", "label", "depth", F.col("n_children").alias("kids"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("leaves"), saved.alias("saved")))
    totals = totals.select(F.col("id").alias("name"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    shas = _sha_of_ids(rows.where("depth = total").select(F.col("name").alias("node"), "conv_id")).withColumnRenamed("node", "name")
    named = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, "name").join(shas, "name", "left").join(named, "parent", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
