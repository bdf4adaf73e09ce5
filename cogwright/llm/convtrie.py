"""The trie of conversation prefixes, by peeling turns off from the deepest end.

A prefix is known by the exclusive or of a 128-bit hash of each turn with its place, so stripping the last turn is one more
exclusive or, and a conversation's key is an aggregate that combines before it shuffles. Equal conversations are one class.
From the greatest depth down, the classes that end at a depth are merged with the nodes that survive from the depth
below; a merge gives a node all it needs of its subtree, and its last turn is stripped for the next.

A conversation's end that no other shares needs no merging. Keys at the powers of two tell where it begins, within a factor
of two; it is stripped in one go, and its nodes are written straight from its turns. So the rounds are at most twice as
many as the turns that two different conversations share, however long the longest is.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, key_or_null, key_or_sentinel, materialize, range_cuts, range_of, scratch_root, text_or_empty
from .mixing import word_count

#: Conversations that share the beginnings of their group's first, and how many beginnings there are.
GROUP, BEGINNINGS = 20, 4
#: Ranges of turn numbers within which a conversation's turns are ordered.
RANGES = 64
#: Turns that are summed or carried together, and the binary logarithm of the ids that are hashed together.
CHUNK, IDS_SHIFT = 64, 10
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _decimal(conv: Column) -> Column:
    return F.when(conv == F.lit(NULL_ID), F.lit("")).otherwise(conv.cast("string"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, h1, h2, words): the turns of each conversation from 1, without their texts.

    They are ranked within ranges of the turn's number, whose counts are summed first, so a conversation that has a great
    part of all turns is dealt over tasks.
    """
    role, text = text_or_empty("role"), text_or_empty("text")
    rows = conversations.select(
        key_or_sentinel("conv_id").alias("conv"), key_or_sentinel("turn").alias("_turn"), F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), text, role).alias("h2"), word_count("text").alias("words"),
    )
    rows = materialize(rows, "turns")
    rows = rows.withColumn("_part", range_of(F.col("_turn"), range_cuts(rows, "_turn", RANGES)))
    counts = rows.groupBy("conv", "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("conv").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("conv", "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = Window.partitionBy("conv", "_part").orderBy("_turn", "h1", "h2")
    return rows.withColumn("_place", F.row_number().over(inside)).join(starts, ["conv", "_part"]).select("conv", (F.col("_before") + F.col("_place")).alias("pos"), "h1", "h2", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): each with its group's beginning in place of as many turns of its own, turns (conv, pos, g1, g2, words).

    g1 and g2 are hashes of the turn and its new place.
    """
    own = turns.groupBy("conv").agg(F.count("*").alias("n"))
    h = F.crc32(_decimal(F.col("conv"))) % BEGINNINGS
    own = own.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % GROUP).alias("base"))
    heads = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = own.join(heads, "base", "left").select("conv", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("q"))
    convs = materialize(convs, "conversations")
    rest = turns.join(convs.select("conv", "h", "q"), "conv").filter("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("q")).alias("pos"), "h1", "h2", "words")
    begun = convs.filter("q > 0").select("conv", "base", "q").join(turns.filter(F.col("pos") < BEGINNINGS).withColumnRenamed("conv", "base"), "base")
    begun = begun.filter("pos <= q").select("conv", "pos", "h1", "h2", "words")
    keyed = begun.unionByName(rest).select("conv", "pos", F.xxhash64("h1", "h2", "pos").alias("g1"), F.xxhash64("pos", "h2", "h1").alias("g2"), "words")
    return convs.select("conv"), keyed


def _class_rows(members: DataFrame) -> DataFrame:
    """(k1, k2, length, rep, m, ends) of conversations (conv, k1, k2, length): equal ones, their least id and the digest of all ids.

    Ids are joined by runs of at most 2**IDS_SHIFT numbers; a class's runs go through one digest in their order, one after
    the other, so a class of any size needs no more memory.
    """
    run = members.groupBy("k1", "k2", "length", F.shiftright("conv", IDS_SHIFT).alias("run")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    run = run.select("k1", "k2", "length", "run", F.get("ids", F.lit(0)).alias("rep"), F.size("ids").cast("long").alias("m"), F.array_join(F.transform("ids", _decimal), ",").alias("ids"))
    ordered = run.repartition("k1", "k2", "length").sortWithinPartitions("k1", "k2", "length", "run")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, rep, m, sha = None, 0, 0, hashlib.sha256()
        for pdf in batches:
            done = []
            for k1, k2, length, first, n, ids in zip(pdf["k1"], pdf["k2"], pdf["length"], pdf["rep"], pdf["m"], pdf["ids"], strict=True):
                if key == (k1, k2, length):
                    sha.update(b",")
                    m += n
                else:
                    if key is not None:
                        done.append((*key, rep, m, sha.hexdigest()))
                    key, rep, m, sha = (k1, k2, length), first, n, hashlib.sha256()
                sha.update(ids.encode())
            yield pd.DataFrame(done, columns=["k1", "k2", "length", "rep", "m", "ends"])
        if key is not None:
            yield pd.DataFrame([(*key, rep, m, sha.hexdigest())], columns=["k1", "k2", "length", "rep", "m", "ends"])

    return ordered.mapInPandas(digest, "k1 long, k2 long, length long, rep long, m long, ends string")


def classes_of(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(rep, length, m, ends, e): equal conversations, and the depth `e` to which their unshared end is stripped at once.

    e is the length where the whole conversation, or its key at the greatest power of two, is shared by another class.
    """
    longest = turns.agg(F.max("pos")).first()[0] or 0
    powers = [1 << j for j in range(int(longest).bit_length())]
    firsts = [F.bit_xor(F.when(F.col("pos") <= p, F.col(g))).alias(f"{g}_{p}") for p in powers for g in ("g1", "g2")]
    keys = turns.groupBy("conv").agg(F.count("*").alias("length"), F.bit_xor("g1").alias("k1"), F.bit_xor("g2").alias("k2"), *firsts)
    zero = F.lit(0).cast("long")
    keys = materialize(convs.join(keys, "conv", "left").withColumns({c: F.coalesce(c, zero) for c in ("length", "k1", "k2")}), "keys")
    classes = materialize(_class_rows(keys.select("conv", "k1", "k2", "length")), "classes")
    each = F.array(*(F.struct(F.lit(p).cast("long").alias("p"), F.col(f"g1_{p}").alias("a"), F.col(f"g2_{p}").alias("b")) for p in powers)) if powers else None
    if each is None:
        return classes.select("rep", "length", "m", "ends", F.col("length").alias("e"))
    at = keys.join(classes.select(F.col("rep").alias("conv")), "conv").select("conv", F.explode(F.filter(each, lambda x: x["p"] <= F.col("length"))).alias("x"))
    alone = at.groupBy("x").agg(F.count("*").alias("n"), F.min("conv").alias("rep")).filter("n = 1").groupBy("rep").agg(F.min("x.p").alias("p"))
    return classes.join(alone, "rep", "left").select("rep", "length", "m", "ends", F.coalesce(F.col("p") - 1, F.col("length")).alias("e"))


def _tails(turns: DataFrame, classes: DataFrame) -> DataFrame:
    """Nodes of unshared ends: (conv, depth, e, n_convs, n_children, saved, ends) for turns beyond e of each class's first conversation.

    Words are summed from the end by chunks of turns, and only where there is more than one conversation.
    """
    rows = turns.join(classes.withColumnRenamed("rep", "conv"), "conv").filter("pos > e").withColumn("_chunk", F.floor((F.col("pos") - 1) / CHUNK))
    several = rows.filter("m > 1")
    later = Window.partitionBy("conv").orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    chunks = several.groupBy("conv", "_chunk").agg(F.sum("words").alias("_w")).select("conv", "_chunk", F.coalesce(F.sum("_w").over(later), F.lit(0)).alias("_later"))
    inside = Window.partitionBy("conv", "_chunk").orderBy(F.desc("pos"))
    summed = several.withColumn("_here", F.sum("words").over(inside)).join(chunks, ["conv", "_chunk"]).withColumn("saved", (F.col("_here") + F.col("_later")) * (F.col("m") - 1))
    both = rows.filter("m = 1").withColumn("saved", F.lit(0).cast("long")).unionByName(summed.drop("_here", "_later"))
    last = F.col("pos") == F.col("length")
    return both.select("conv", F.col("pos").alias("depth"), "e", F.col("m").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), "saved", F.when(last, F.col("ends")).alias("ends"))


def peel(turns: DataFrame, classes: DataFrame) -> DataFrame:
    """(depth, k1, k2, p1, p2, conv, n_convs, n_children, n_leaves, saved, ends) of the nodes that are merged, p1 and p2 the parent's key."""
    spark = turns.sparkSession
    zero = F.lit(0).cast("long")
    own = turns.join(classes.select(F.col("rep").alias("conv"), "e"), "conv")
    kept = F.col("pos") <= F.col("e")
    sums = own.groupBy("conv").agg(F.bit_xor(F.when(kept, F.col("g1"))).alias("k1"), F.bit_xor(F.when(kept, F.col("g2"))).alias("k2"), F.sum(F.when(~kept, F.col("words"))).alias("tail"))
    chunks = own.filter(kept).groupBy(F.col("conv").alias("r"), F.floor((F.col("pos") - 1) / CHUNK).alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("pos", "g1", "g2", "words"))).alias("path"))
    chunks = materialize(chunks, "trie-paths")
    last_chunk = F.floor((F.col("e") - 1) / CHUNK)
    entries = classes.withColumnRenamed("rep", "r").join(sums.withColumnRenamed("conv", "r"), "r", "left").withColumn("chunk", last_chunk).join(chunks, ["r", "chunk"], "left")
    cut = (F.col("length") > F.col("e")).cast("long")
    entries = entries.select(
        "e", "r", F.coalesce("k1", zero).alias("k1"), F.coalesce("k2", zero).alias("k2"), "path", F.col("m").alias("n_convs"), cut.alias("n_children"), cut.alias("n_leaves"),
        (cut * (F.col("m") - 1) * F.coalesce("tail", zero)).alias("saved"), F.when(cut == 0, F.col("ends")).alias("ends"),
    )
    entries = materialize(entries, "trie-entries")
    deepest = entries.agg(F.max("e")).first()[0]
    folder, schema, alive = f"{scratch_root(spark)}/trie-{uuid.uuid4().hex}", None, None
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        rows = entries.filter(F.col("e") == depth).drop("e")
        if alive is not None:
            turn = F.get("path", F.lit(depth % CHUNK))  # the turn at depth + 1, which is stripped
            stripped = alive.select(
                F.col("conv").alias("r"), F.col("k1").bitwiseXOR(turn["g1"]).alias("k1"), F.col("k2").bitwiseXOR(turn["g2"]).alias("k2"), "path", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved", F.lit(None).cast("string").alias("ends"),
            )
            if depth and depth % CHUNK == 0:
                stripped = stripped.drop("path").join(chunks.filter(F.col("chunk") == (depth - 1) // CHUNK).drop("chunk"), "r")
            rows = rows.unionByName(stripped)
        merged = rows.groupBy("k1", "k2").agg(
            F.min("r").alias("conv"), F.first("path").alias("path"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends"),
        )
        turn = F.get("path", F.lit((depth - 1) % CHUNK)) if depth else F.lit(None).cast("struct<pos:long,g1:long,g2:long,words:long>")
        nodes = merged.select(
            F.lit(depth).cast("long").alias("depth"), "k1", "k2", F.col("k1").bitwiseXOR(turn["g1"]).alias("p1"), F.col("k2").bitwiseXOR(turn["g2"]).alias("p2"), "conv", "path", "n_convs", "n_children",
            F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), (F.col("saved") + (F.col("n_convs") - 1) * F.coalesce(turn["words"], zero)).alias("saved"), "ends",
        )
        nodes.write.parquet(f"{folder}/at={depth}")
        schema = nodes.schema
        alive = spark.read.schema(schema).parquet(f"{folder}/at={depth}")
    if schema is None:
        return spark.createDataFrame([], "depth long, k1 long, k2 long, p1 long, p2 long, conv long, n_convs long, n_children long, n_leaves long, saved long, ends string")
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder).drop("path")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations (conv_id, turn, role, text).

    Returns conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. A null
    turn comes first; turns of equal number, repeated rows too, each count and follow in the order of a hash of role and
    text. Null role or text is empty. Rows without a conv_id are one conversation that sorts first, has an empty decimal and
    keeps its own turns. An empty table gives no rows. Other columns are ignored. Prefixes are told apart by 128 bits.
    """
    convs, turns = rebuilt(materialize(ordered_turns(conversations), "ordered"))
    turns = materialize(turns, "rebuilt")
    classes = materialize(classes_of(convs, turns).select("rep", "length", "m", "ends", "e"), "classes-cut")
    merged = peel(turns, classes)
    tails = _tails(turns, classes)
    # A tail's first node hangs on the node that its class was stripped to.
    cut = classes.filter("e < length and e > 0").select(F.col("rep").alias("conv"), "e")
    at_cut = turns.join(cut, "conv").filter("pos <= e").groupBy("conv").agg(F.bit_xor("g1").alias("p1"), F.bit_xor("g2").alias("p2"))
    shape = ["conv", "depth", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    one = F.lit(1).cast("long").alias("n_leaves")
    inner = tails.filter("depth > e + 1").select("conv", "depth", "n_convs", "n_children", one, "saved", "ends", F.col("conv").alias("parent"))
    tops = tails.filter("depth = e + 1").select("conv", "depth", "n_convs", "n_children", one, "saved", "ends").join(at_cut, "conv", "left")
    hanging = merged.filter("depth > 0").select(*shape, "p1", "p2").unionByName(tops.select(*shape, "p1", "p2"))
    above = merged.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent"))
    root = merged.filter("depth = 0")
    # The root is one row; its children may be all there are.
    first = hanging.filter("depth = 1").crossJoin(F.broadcast(root.select(F.col("conv").alias("parent")))).select(*shape, "parent")
    deeper = hanging.filter("depth > 1").join(above.filter("depth > 1"), ["depth", "p1", "p2"]).select(*shape, "parent")
    parts = [root.select(*shape, F.lit(None).cast("long").alias("parent")), first, deeper, inner.select(*shape, "parent")]
    out = reduce(DataFrame.unionByName, parts)
    return out.select(
        key_or_null("conv").alias("conv_id"), "depth", key_or_null("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


_CRC_STEP = "list_reduce([{x}, 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)"
#: DuckDB SQL for conversation_trie over `conversations`; the checksum of the decimal is worked out bit by bit.
REPORT_SQL = f"""
WITH ordered AS (
  SELECT conv_id, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations),
ids AS (SELECT DISTINCT conv_id AS c, [CAST(ascii(x) AS BIGINT) for x in string_split(CAST(conv_id AS VARCHAR), '')] AS letters FROM conversations),
sums AS (SELECT c, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), letters), lambda a, b: {_CRC_STEP.format(x="xor(a, b)")}), 4294967295) AS crc FROM ids),
convs AS (SELECT c, crc % 4 AS h, c - c % 20 AS base FROM sums),
turns AS (
  SELECT c, 0 AS part, pos, turn FROM convs JOIN ordered ON conv_id = base AND pos <= h
  UNION ALL SELECT c, 1, pos, turn FROM convs JOIN ordered ON conv_id = c AND pos > h),
seqs AS (SELECT convs.c, coalesce(list(turn ORDER BY part, pos) FILTER (turn IS NOT NULL), []) AS s FROM convs LEFT JOIN turns USING (c) GROUP BY convs.c),
prefixes AS (SELECT c, d, s[1:d] AS p, len(s) AS n FROM seqs, LATERAL (SELECT unnest(generate_series(0, len(s))) AS d)),
nodes AS (
  SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256,
         CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(p[-1].t, '[^\\x20\\x09-\\x0D]+')) END AS own
  FROM prefixes GROUP BY d, p),
shape AS (SELECT nodes.*, EXISTS (SELECT 1 FROM nodes k WHERE k.d = nodes.d + 1 AND k.p[1:len(k.p) - 1] = nodes.p) AS inner_node FROM nodes),
above AS (SELECT a, p[1:a] AS q, d, own, inner_node FROM shape, LATERAL (SELECT unnest(generate_series(0, d)) AS a)),
sub AS (SELECT a, q, sum(own) AS saved, count(*) FILTER (d = a + 1) AS n_children, count(*) FILTER (NOT inner_node) AS n_leaves FROM above GROUP BY a, q)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs, CAST(n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sub ON sub.a = n.d AND sub.q = n.p LEFT JOIN nodes up ON up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]
"""
