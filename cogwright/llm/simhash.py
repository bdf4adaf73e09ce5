"""SimHash fingerprints and search within a Hamming radius, in DataFrame operations only.

Terms are pairs of neighbouring words (a lone word is a term by itself). A term weighs one and the binary logarithm of
its count in the text. Its 128 hash bits each vote with that weight; a fingerprint bit is set where more weight is for
it than against. The votes of two bits are summed in the two halves of one long, so 64 sums count 128 bits.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_RE, key_or_null, key_or_sentinel, materialize, range_cuts, range_of, text_or_empty

BITS = 128
#: Weights are counted in quarters.
UNIT = 4
RADIUS = 3
#: Radius of op2_simhash: near copies of five-word similarity 0.8 lie about 11 bits apart, few of them beyond 20.
NEAR_RADIUS = 20
#: Blocks that a fingerprint has at most when every block must agree; beyond that, blocks may differ in some bits.
EXACT_BLOCKS = 8
#: Fewer blocks would ask for more keys than a table of them should have.
LEAST_BLOCKS = 4
#: One in this many documents is looked up by near_report.
QUERY_EVERY = 50
#: Ranges of ids within which documents are ordered; see following().
RANGES = 256


def weighted_terms(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, term, n) for rows of (keys, text): hashes of word pairs with their counts, one row for each.

    Each step is a projection of its own, so that an array is made once and not in each place that refers to it. Equal
    terms are counted in the sorted array, by the places where one ends.
    """
    words = texts.select(*keys, F.split("text", SPACE_RE, -1).alias("w"))
    hashed = words.select(*keys, F.transform(F.filter("w", lambda w: w != ""), lambda w: F.xxhash64(w)).alias("h"))
    pairs = F.zip_with(F.slice("h", F.lit(1), F.size("h") - 1), F.slice("h", F.lit(2), F.size("h") - 1), lambda a, b: F.xxhash64(a, b))
    ordered = hashed.select(*keys, F.when(F.size("h") > 1, pairs).otherwise(F.col("h")).alias("t")).select(*keys, F.sort_array("t").alias("s"))
    last = F.filter(F.sequence(F.lit(0), F.size("s") - 1), lambda i: ~F.get(F.col("s"), i).eqNullSafe(F.get(F.col("s"), i + 1)))
    ends = ordered.select(*keys, "s", F.when(F.size("s") > 0, last).alias("e"))
    each = F.transform("e", lambda i, j: F.struct(F.get(F.col("s"), i).alias("term"), (i - F.coalesce(F.get(F.col("e"), j - 1), F.lit(-1))).alias("n")))
    # A plain explode would have its input's size tested below all these steps, which makes every array again.
    return ends.select(*keys, F.explode_outer(each).alias("x")).select(*keys, "x.term", "x.n").filter("term is not null")


def _votes(h: Column, step: int) -> Column:
    """Bits `step` and `step + 32` of a hash as counts in the halves of a long."""
    return F.shiftrightunsigned(h, step).bitwiseAND(F.lit(0x0000000100000001))


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, hi, lo) for rows of (keys, text): one row for each key whose text has words."""
    counted = weighted_terms(texts, keys)
    weight = (F.lit(UNIT) * (1 + F.log2("n"))).cast("long")
    weighed = counted.select(*keys, "term", F.xxhash64("term").alias("other"), weight.alias("w"))
    sums = [F.sum(_votes(F.col(c), i) * F.col("w")).alias(f"{c}{i}") for c in ("term", "other") for i in range(32)]
    voted = weighed.groupBy(*keys).agg(F.sum("w").alias("all"), *sums)

    def word(c: str) -> Column:
        bits = []
        for i in range(32):
            low, high = F.col(f"{c}{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(f"{c}{i}"), 32)
            bits.append(F.when(2 * low > F.col("all"), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
            top = 1 << (i + 32)
            bits.append(F.when(2 * high > F.col("all"), F.lit(top if i < 31 else -(2**63))).otherwise(F.lit(0)).cast("long"))
        return reduce(lambda a, b: a.bitwiseOR(b), bits)

    return voted.select(*keys, word("term").alias("hi"), word("other").alias("lo"))


def hex_of(hi: str, lo: str) -> Column:
    return F.lower(F.concat(*(F.lpad(F.hex(F.coalesce(F.col(c), F.lit(0).cast("long"))), 16, "0") for c in (hi, lo))))


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return 1 - distance(a, b) / F.lit(float(BITS))


def following(ids: DataFrame) -> DataFrame:
    """(_id, _sub, _next_id, _next_sub) for distinct (_id, _sub): the next in order, the first after the last.

    Ids are ordered within ranges of about equal size; the ranges' first ids, of which there are RANGES at most, are
    what follows the last of the range before.
    """
    place = F.struct("_id", "_sub")
    parts = ids.withColumn("_part", range_of(F.col("_id"), range_cuts(ids, "_id", RANGES)))
    inner = parts.withColumn("_next", F.lead(place).over(Window.partitionBy("_part").orderBy("_id", "_sub")))
    heads = parts.groupBy("_part").agg(F.min(place).alias("_head"))
    all_heads = Window.orderBy("_part")
    first = F.first("_head").over(all_heads.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("_part", F.coalesce(F.lead("_head").over(all_heads), first).alias("_jump"))
    out = inner.join(F.broadcast(heads), "_part").withColumn("_next", F.coalesce("_next", "_jump"))
    return out.select("_id", "_sub", F.col("_next._id").alias("_next_id"), F.col("_next._sub").alias("_next_sub"))


def _flips(width: int, slack: int) -> int:
    """How many keys lie within `slack` bits of a block's own."""
    return sum(comb(width, n) for n in range(slack + 1))


def _blocks_of(radius: int, blocks: int) -> list[tuple[int, int, int]]:
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    return [(a, b, (radius + 1 + i) // blocks - 1) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]


def search_cost(plan: list[tuple[int, int, int]], rows: int) -> float:
    """Keys that a query probes, and fingerprints of `rows` random ones that it meets under them."""
    return sum(_flips(b - a, slack) * (1 + rows / 2 ** (b - a)) for a, b, slack in plan)


def block_plan(radius: int, rows: int = 0) -> list[tuple[int, int, int]]:
    """(first bit, end, slack) of each block: fingerprints within the radius differ in at most `slack` bits of some block.

    If they differed in more bits of each, the sum of slack + 1 over the blocks, radius + 1, would be beyond the radius.
    Small radii have a block for each bit more, all of which must agree. For others the number of blocks is what makes a
    search among `rows` fingerprints cheapest: the more there are, the wider the blocks, so that what a query meets by chance
    grows much slower than they do.
    """
    if not 1 <= radius < BITS:
        raise ValueError("the radius is at least 1 and less than the bits")
    if radius < EXACT_BLOCKS:
        return _blocks_of(radius, radius + 1)
    return min((_blocks_of(radius, n) for n in range(LEAST_BLOCKS, radius + 2)), key=lambda p: search_cost(p, rows))


def _block(a: int, b: int) -> Column:
    """Bits a..b-1 from the top of hi, lo; blocks are at most 64 bits wide."""
    if b <= 64:
        return F.shiftrightunsigned(F.shiftleft(F.col("hi"), a), 64 - (b - a))
    if a >= 64:
        return F.shiftrightunsigned(F.shiftleft(F.col("lo"), a - 64), 64 - (b - a))
    return F.shiftleft(_block(a, 64), b - 64).bitwiseOR(F.shiftrightunsigned(F.col("lo"), 128 - b))


def block_tables(prints: DataFrame, plan: list[tuple[int, int, int]]) -> DataFrame:
    """Rows (table, key, ...) of one table for each block of block_plan: the fingerprint with that block as its key."""
    keys = F.array(*(_block(a, b) for a, b, _ in plan))
    return prints.select("*", F.posexplode(keys).alias("table", "key"))


def probes(queries: DataFrame, plan: list[tuple[int, int, int]]) -> DataFrame:
    """Rows (table, key, ...) of every key within a block's slack of the query's own, in each table."""
    own = F.array(*(_block(a, b) for a, b, _ in plan))
    rows = queries.select("*", F.posexplode(own).alias("table", "_own"))
    masks = [[sum(1 << i for i in bits) for n in range(slack + 1) for bits in combinations(range(b - a), n)] for a, b, slack in plan]
    if all(len(m) == 1 for m in masks):
        return rows.withColumnRenamed("_own", "key")
    flips = queries.sparkSession.createDataFrame([(i, m - 2**64 if m >= 2**63 else m) for i, own_masks in enumerate(masks) for m in own_masks], "table int, _flip long")
    return rows.join(F.broadcast(flips), "table").withColumn("key", F.col("_own").bitwiseXOR(F.col("_flip"))).drop("_own", "_flip")


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs of a query fingerprint and each fingerprint at most `radius` bits away, itself included.

    queries, prints: distinct (hi, lo); prints are counted first, so pass a written table. Two fingerprints that close differ in no more bits than its slack in one of the
    blocks, so one of the tables has them under a probed key; a pair that several tables have comes from the first. The
    distance is a condition of the join, so only pairs within the radius leave it. Returns (q_hi, q_lo, hi, lo, distance).
    """
    plan = block_plan(radius, prints.count())
    q = probes(queries.select("hi", "lo"), plan).select(F.col("hi").alias("q_hi"), F.col("lo").alias("q_lo"), "table", "key")
    p = block_tables(prints.select("hi", "lo"), plan)
    x_hi, x_lo = F.col("q_hi").bitwiseXOR(F.col("hi")), F.col("q_lo").bitwiseXOR(F.col("lo"))
    earlier = F.lit(False)
    for i, (a, b, slack) in enumerate(plan):
        mask = ((1 << (b - a)) - 1) << (BITS - b)
        top, low = (m - 2**64 if m >= 2**63 else m for m in (mask >> 64, mask & (2**64 - 1)))
        differ = F.bit_count(x_hi.bitwiseAND(F.lit(top).cast("long"))) + F.bit_count(x_lo.bitwiseAND(F.lit(low).cast("long")))
        earlier = earlier | ((F.lit(i) < q["table"]) & (differ <= slack))
    near = (F.bit_count(x_hi) + F.bit_count(x_lo)) <= radius
    joined = q.join(p, (q["table"] == p["table"]) & (q["key"] == p["key"]) & near & ~earlier)
    return joined.select("q_hi", "q_lo", "hi", "lo", (F.bit_count(x_hi) + F.bit_count(x_lo)).alias("distance"))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, hi, lo of each row's text; a text without words has no set bit."""
    rows = docs.select(key_or_sentinel("doc_id").alias("_id"), text_or_empty().alias("_text")).withColumn("_sub", F.xxhash64("_text"))
    prints = fingerprints(rows.select("_id", "_sub", F.col("_text").alias("text")).dropDuplicates(["_id", "_sub"]), ["_id", "_sub"])
    out = rows.select("_id", "_sub").join(prints, ["_id", "_sub"], "left")
    return out.select(key_or_null("_id").alias("doc_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("hi", "lo")))


def near_report(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Fingerprints of every text and of its edited text, their likeness, and what lies within the radius.

    The edited text has its last floor(n/4) code points replaced by the first as many (or all) of the next document's.
    n_within counts the other documents within `radius` bits, for documents whose id is divisible by QUERY_EVERY; for
    others it is null. A null text is empty. A null doc_id comes first; several texts with one doc_id follow each other
    in the order of a hash, and rows that repeat both are one document, of which each gets the result. An empty table
    gives no rows. docs must read the same each time.
    """
    rows = docs.select(key_or_sentinel("doc_id").alias("_id"), text_or_empty().alias("_text"))
    repeats = not rows.groupBy("_id").count().filter("count > 1").isEmpty()
    rows = rows.withColumn("_sub", F.xxhash64("_text") if repeats else F.lit(0).cast("long"))
    ids = rows.groupBy("_id", "_sub").agg(F.count("*").alias("_rows"), F.max(F.char_length("_text")).alias("_n"))
    ids = materialize(ids, "ids")
    order = materialize(following(ids).join(ids, ["_id", "_sub"]), "order")
    one = rows.dropDuplicates(["_id", "_sub"]) if repeats else rows
    tails = one.join(order.select(F.col("_next_id").alias("_id"), F.col("_next_sub").alias("_sub"), F.col("_id").alias("_for"), F.col("_sub").alias("_for_sub"), "_n"), ["_id", "_sub"])
    tails = tails.select(F.col("_for").alias("_id"), F.col("_for_sub").alias("_sub"), F.substring("_text", F.lit(1), F.floor(F.col("_n") / 4).cast("int")).alias("_tail"))
    both = one.join(tails, ["_id", "_sub"])
    n = F.char_length("_text")
    edited = F.concat(F.substring("_text", F.lit(1), (n - F.floor(n / 4)).cast("int")), F.col("_tail"))
    kinds = both.select("_id", "_sub", n.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"), F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("_text").alias("t")), F.struct(F.lit(1).alias("k"), edited.alias("t")))).alias("_kind"))
    prints = fingerprints(kinds.select("_id", "_sub", F.col("_kind.k").alias("_edited"), F.col("_kind.t").alias("text")), ["_id", "_sub", "_edited"])
    prints = materialize(prints, "prints")
    meta = kinds.filter("_kind.k = 0").select("_id", "_sub", "n_chars", "edited_sha256")
    zero = F.lit(0).cast("long")

    def side(edited_flag: int, hi: str, lo: str) -> DataFrame:
        return prints.filter(F.col("_edited") == edited_flag).select("_id", "_sub", F.col("hi").alias(hi), F.col("lo").alias(lo))

    table = meta.join(side(0, "hi", "lo"), ["_id", "_sub"], "left").join(side(1, "e_hi", "e_lo"), ["_id", "_sub"], "left").join(order, ["_id", "_sub"])
    following_prints = side(0, "n_hi", "n_lo").withColumnsRenamed({"_id": "_next_id", "_sub": "_next_sub"})
    table = table.join(following_prints, ["_next_id", "_next_sub"], "left").withColumns({c: F.coalesce(c, zero) for c in ("hi", "lo", "e_hi", "e_lo", "n_hi", "n_lo")})

    own = order.select("_id", "_sub", "_rows").join(side(0, "hi", "lo"), ["_id", "_sub"], "left").withColumns({c: F.coalesce(c, zero) for c in ("hi", "lo")})
    classes = materialize(own.groupBy("hi", "lo").agg(F.sum("_rows").alias("_docs"), F.max(F.col("_id") % QUERY_EVERY == 0).alias("_asked")), "classes")
    found = within_radius(classes.filter("_asked"), classes, radius).join(classes.select("hi", "lo", "_docs"), ["hi", "lo"])
    found = found.groupBy(F.col("q_hi").alias("hi"), F.col("q_lo").alias("lo")).agg((F.sum("_docs") - 1).alias("_within"))
    table = table.join(found, ["hi", "lo"], "left")
    result = table.select(
        "_id",
        "_sub",
        "n_chars",
        "edited_sha256",
        hex_of("hi", "lo").alias("fingerprint"),
        hex_of("e_hi", "e_lo").alias("edited_fingerprint"),
        likeness((F.col("hi"), F.col("lo")), (F.col("e_hi"), F.col("e_lo"))).alias("near_edited"),
        likeness((F.col("hi"), F.col("lo")), (F.col("n_hi"), F.col("n_lo"))).alias("near_next"),
        F.when((F.col("_id") != F.lit(-(2**63))) & (F.col("_id") % QUERY_EVERY == 0), F.col("_within")).alias("n_within"),
        "_rows",
    )
    if repeats:
        result = result.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))))
    return result.select(key_or_null("_id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_within")
