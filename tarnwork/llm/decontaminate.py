"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Only DataFrame functions. Each item has its weighted word n-grams (five words; a shorter item is one
n-gram of all its words) and a SimHash of BITS bits. A document's windows have an item's number of words; a document
shorter than that is one window.

1. Prefilter: a document goes on if the n-grams that any item holds weigh enough in it for the lightest item. A
   window's similarity cannot exceed the share of its weight that items hold, so this loses nothing.
2. In these documents windows are formed from running sums over segments of SEGMENT starts, so that a window costs the
   same whatever its length: all windows of each distinct item length, but for lengths of whose items the segment holds no n-gram,
   segments too light for any item, and windows whose held weight is below the threshold's share of their weight. No
   item can reach the threshold there; which item holds what does not matter. The others get their SimHash from the same sums.
3. Windows and items of their length meet in the block index: the fingerprint is cut into blocks, and item
   fingerprints are entered under every value within the block's own radius. The radii are such that two
   fingerprints within `radius` bits meet in one block at least (their sum plus the number of blocks exceeds it).
   The key is length, block and value; nothing else ties a window to an item. Pairs within the radius go on.
4. Pairs are verified by exact weighted Jaccard similarity of their n-gram bags.

An n-gram weighs log(1 + items / items that hold it) per occurrence; one that no item holds weighs as one that a single item holds.
Fingerprints take the square root of the weight as an n-gram's vote: then two bags of n-grams that do not repeat, of weighted
similarity J, have a cosine of 2J / (1 + J) at least, whatever the weights, and the radius is the smallest that such a pair at
the threshold exceeds with probability MISS at most. Where an n-gram repeats within a window or item, the cosine may be lower: a window
whose count of an n-gram differs from the item's by D has a cosine of 1 - D * (1 - J) / (2 * J) at least, so a pair at
the threshold in which that is small may be missed. Weights and votes are in 64ths, rounded. Words are lower-cased runs of other than space and \\t..\\r.

Defined cases: null and blank texts and items have no words and match nothing; rows with one
doc_id are reported as one document, each of its texts being searched on its own; of windows with equal similarity the first
is reported; repeated items are separate items; an empty benchmark or empty documents give no rows. Long texts are
cut into segments that overlap by the longest item, so no row grows with a text beyond its own words.
"""

from __future__ import annotations

import functools
import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, private_name, small_side

SIZE = 5
THRESHOLD = 0.8
LANE = 31  # two counters of 31 bits share a bigint
BITS = 2 * LANE
BLOCKS = 5
MISS = 1e-3
SEGMENT = 128
SCALE, SLACK = 64, 0.97  # weights are summed in 64ths: rounding changes a share of a weight, at least log 2, by less than 3 %
PAIR_OF_ONES = 1 | 1 << LANE
# Rows up to which a side may be broadcast (n-grams of items, index entries, keys of documents); at about 40 bytes a row
# 20 MB, 60 MB and 40 MB. Beyond, the same joins shuffle.
MAX_GRAMS, MAX_ENTRIES, MAX_KEYS = 500_000, 1_500_000, 1_000_000


def radius_for(threshold: float, miss: float = MISS) -> int:
    """The smallest radius that a pair at the similarity threshold exceeds with probability at most `miss`."""
    cosine = 2 * threshold / (1 + threshold)
    p = math.acos(cosine) / math.pi
    tail, k = 1.0, -1
    while tail > miss:
        k += 1
        tail -= math.comb(BITS, k) * p**k * (1 - p) ** (BITS - k)
    return k


RADIUS = radius_for(THRESHOLD)


def ball(bits: int, radius: int) -> int:
    """Values within `radius` of one of `bits` bits."""
    return sum(math.comb(bits, k) for k in range(radius + 1))


def block_plan(radius: int = RADIUS) -> list[tuple[int, int, int]]:
    """(first bit, bits, own radius) of each block. Own radii add up to radius - blocks + 1, where they let the fewest values in."""
    cuts = [BITS * k // BLOCKS for k in range(BLOCKS + 1)]
    sizes = [b - a for a, b in zip(cuts, cuts[1:])]
    own = [-1] * BLOCKS  # -1: the block is not used
    share = lambda k, r: ball(sizes[k], r) / 2 ** sizes[k] if r >= 0 else 0.0
    for _ in range(radius + 1):
        k = min(range(BLOCKS), key=lambda k: (share(k, own[k] + 1) - share(k, own[k]), k))
        own[k] += 1
    return [(a, n, r) for a, n, r in zip(cuts, sizes, own) if r >= 0]


def flips(bits: int, radius: int) -> list[int]:
    """All masks of at most `radius` of `bits` bits."""
    return [sum(1 << i for i in c) for k in range(radius + 1) for c in itertools.combinations(range(bits), k)]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def fixed_grams(words: Column, size: int) -> Column:
    """array<long>: hashes of all n-grams of exactly `size` words. words: a plain column."""
    n = F.size(words)
    one = lambda i: F.xxhash64(F.lit(size), *[F.get(words, i + k) for k in range(size)])
    return F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), one)).otherwise(F.array().cast("array<bigint>"))


def vote_lanes(h: Column, votes: Column) -> list[Column]:
    """LANE bigints; counter j of lane k has the votes if bit k + LANE * j of the hash is set."""
    return [F.shiftrightunsigned(h, k).bitwiseAND(F.lit(PAIR_OF_ONES)) * votes for k in range(LANE)]


def print_of(after: Column, before: Column, total: Column) -> Column:
    """A SimHash from summed lanes, two arrays whose difference counts: a bit is set where at most half of the votes are.

    Both counters of a lane are compared at once; lane k's two results are bits LANE - 1 - k of the print's halves.
    """
    even = F.lit(PAIR_OF_ONES << (LANE - 1)) + total * F.lit(PAIR_OF_ONES)
    bits = lambda a, b: F.shiftrightunsigned(even - (a - b) * 2, LANE - 1).bitwiseAND(F.lit(PAIR_OF_ONES))
    push = lambda acc, c: F.shiftleft(acc, 1).bitwiseOR(c)
    # In two parts: as each array is used twice, it is taken from its row first and does not drag the row along.
    part = lambda first, n: F.aggregate(F.zip_with(F.slice(after, first, n), F.slice(before, first, n), bits), F.lit(0).cast("bigint"), push)
    low = LANE // 2
    return F.shiftleft(part(1, LANE - low), low).bitwiseOR(part(LANE - low + 1, low))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _key(length: Column, block: int, value: Column) -> Column:
    return length.cast("bigint") * F.lit(1 << 20) + F.lit(block << 16) + value


def index_keys(length: Column, fingerprint: Column, plan, near: bool) -> Column:
    """Keys of all blocks; with near, those of all values within each block's radius."""


    def keys(block, first, bits, own):
        value = F.shiftrightunsigned(fingerprint, first).bitwiseAND(F.lit((1 << bits) - 1))
        if not near:
            return F.array(_key(length, block, value))
        masks = F.split(F.lit(",".join(map(str, flips(bits, own)))), ",").cast("array<bigint>")
        return F.transform(masks, lambda m: _key(length, block, value.bitwiseXOR(m)))

    return F.concat(*[keys(k, *b) for k, b in enumerate(plan)])


def text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes of a whole text; texts of equal hashes are taken as equal."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return [F.xxhash64(t).alias("t1"), F.xxhash64(F.lit("text"), t, F.length(t)).alias("t2")]


TEXT = ["t1", "t2"]
LANES = [f"c{k}" for k in range(LANE)]


class Index:
    """What documents are searched for: items, weights of n-grams, fingerprints in blocks. All in the cluster's shared folder."""

    def __init__(self, benchmark: DataFrame, threshold: float, item: str, text: str):
        rows = benchmark.select(F.monotonically_increasing_id().alias("row"), F.col(item).alias("item_id"), words_of(F.col(f"`{text}`")).alias("words")).where(F.size("words") > 0)
        rows = rows.withColumn("len", F.size("words"))
        grams = functools.reduce(lambda g, s: g.when(F.col("len") == s, fixed_grams(F.col("words"), s)), range(1, SIZE), F.when(F.col("len") >= SIZE, fixed_grams(F.col("words"), SIZE)))
        self.items = cut(rows.select("row", "item_id", "len", F.least("len", F.lit(SIZE)).alias("size"), grams.alias("grams")))  # the row numbers must not change on a retry
        self.radius = radius_for(threshold)
        self.plan = block_plan(self.radius)
        total = self.items.agg(F.count("*").alias("n"), F.sum(F.size("grams")).alias("grams"), F.max(F.size("grams")).alias("longest")).first()
        self.n, self.n_grams, self.longest = total["n"], total["grams"] or 0, total["longest"] or 0
        if not self.n:
            return
        weight = F.log(1 + F.lit(float(self.n)) / F.count("*"))
        held = self.items.select("len", F.explode(F.array_distinct("grams")).alias("h")).groupBy("h").agg(weight.alias("w"), F.collect_set("len").alias("lens"))
        self.weights = cut(held.withColumn("votes", F.round(F.col("w") * SCALE).cast("bigint")).withColumn("pull", F.round(F.sqrt("w") * SCALE).cast("bigint")))
        self.default = math.log(1 + self.n)
        bags = self.items.select("row", "len", "size", F.explode("grams").alias("h")).groupBy("row", "len", "size", "h").agg(F.count("*").alias("held")).join(small_side(self.weights, self.n_grams, MAX_GRAMS), "h")
        self.bags = cut(bags)
        counted = self.bags.select("row", "len", "size", *[(F.col(c) * F.col("held")).alias(c) for c in ("votes", "pull", "w")], "h")
        sums = [F.sum("votes").alias("total"), F.sum("pull").alias("pulls"), F.sum("w").alias("weight")]
        summed = counted.groupBy("row", "len", "size").agg(*sums, *[F.sum(c).alias(n) for c, n in zip(vote_lanes(F.col("h"), F.col("pull")), LANES)])
        p = print_of(F.array(*LANES), F.array_repeat(F.lit(0).cast("bigint"), LANE), F.col("pulls"))
        self.prints = cut(summed.select("row", "len", "size", "total", "weight", p.alias("print")))
        self.lengths = sorted(tuple(r) for r in self.prints.groupBy("size", "len").agg(F.min("total").alias("least")).collect())  # at most one row per distinct length
        self.entries = sum(ball(bits, own) for _, bits, own in self.plan) * self.n

    def index(self) -> DataFrame:
        """key, row, item_print: an entry for each value near a block of an item."""
        keys = index_keys(F.col("len"), F.col("print"), self.plan, near=True)
        return small_side(self.prints.select(F.explode(keys).alias("key"), "row", F.col("print").alias("item_print")), self.entries, MAX_ENTRIES)

    def known(self, *columns: str) -> DataFrame:
        return small_side(self.weights.select("h", *columns), self.n_grams, MAX_GRAMS)


def candidate_texts(docs: DataFrame, found: Index, threshold: float, doc: str, text: str) -> DataFrame:
    """doc_id, t1, t2, size, n_words, grams of the distinct texts that pass the prefilter; texts are read twice, and only these are shuffled."""
    keyed = docs.select(F.col(f"`{doc}`").alias("doc_id"), *text_key(F.col(f"`{text}`")), F.col(f"`{text}`").alias("text"))
    rows = keyed.select("doc_id", *TEXT, words_of(F.col("text")).alias("words"))
    sizes = sorted({s for s, _, _ in found.lengths})
    least = {s: min(v for z, _, v in found.lengths if z == s) for s in sizes}
    hits = None
    for s in sizes:
        at = rows.select("doc_id", *TEXT, F.explode(fixed_grams(F.col("words"), s)).alias("h")).join(found.known("votes"), "h")
        part = at.groupBy("doc_id", *TEXT).agg(F.sum("votes").alias("v")).where(F.col("v") >= math.floor(least[s] * threshold * SLACK)).select(*TEXT, F.lit(s).alias("size"))
        hits = part if hits is None else hits.unionAll(part)
    keys = cut(hits.groupBy(*TEXT).agg(F.collect_set("size").alias("sizes")))
    texts = keyed.join(small_side(keys, keys.count(), MAX_KEYS), TEXT).groupBy("doc_id", *TEXT).agg(F.first("sizes").alias("sizes"), F.first("text").alias("text"))
    texts = texts.withColumn("words", words_of(F.col("text")))
    each = F.filter(F.array(*[F.struct(F.lit(s).alias("size"), fixed_grams(F.col("words"), s).alias("grams")) for s in sizes]), lambda x: F.array_contains(F.col("sizes"), x["size"]))
    return cut(texts.select("doc_id", *TEXT, F.size("words").alias("n_words"), F.inline(each)))


def window_prints(texts: DataFrame, found: Index, threshold: float) -> DataFrame:
    """doc_id, t1, t2, size, len, start, n (n-grams), print of every item-sized window that may reach the threshold."""
    keys = ["doc_id", *TEXT, "size", "n_words"]
    # dealt once by document, as whole arrays; all that follows is grouped within
    dealt = texts.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", *TEXT)
    at = dealt.select(*keys, F.posexplode("grams").alias("pos", "h")).join(found.known("votes", "pull", "lens"), "h", "left")
    at = at.withColumn("held", F.coalesce("votes", F.lit(0))).withColumn("votes", F.coalesce("votes", F.lit(round(found.default * SCALE))))
    at = at.withColumn("pull", F.coalesce("pull", F.lit(round(math.sqrt(found.default) * SCALE))))
    first = F.greatest(F.lit(0), F.ceil((F.col("pos") - (SEGMENT + found.longest - 2)) / SEGMENT).cast("int"))
    at = at.withColumn("segment", F.explode(F.sequence(first, F.floor(F.col("pos") / SEGMENT).cast("int"))))
    least = min(v for _, _, v in found.lengths) * threshold * SLACK
    at = at.withColumn("any", F.sum("held").over(Window.partitionBy(*keys, "segment"))).where(F.col("any") >= F.lit(least)).drop("any")
    run = Window.partitionBy(*keys, "segment").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(c).over(run).alias(n) for c, n in zip(vote_lanes(F.col("h"), F.col("pull")), LANES)]
    at = at.select(*keys, "segment", "pos", "lens", F.sum("votes").over(run).alias("total"), F.sum("held").over(run).alias("held"), F.sum("pull").over(run).alias("pulls"), *sums)
    row = F.struct("pos", "total", "held", "pulls", F.array(*LANES).alias("lanes"))
    none = F.lit(0).cast("bigint")
    zero = F.struct(F.lit(-1).alias("pos"), none.alias("total"), none.alias("held"), none.alias("pulls"), F.array_repeat(none, LANE).alias("lanes"))
    parts = at.groupBy(*keys, "segment").agg(F.concat(F.array(zero), F.sort_array(F.collect_list(row))).alias("run"), F.flatten(F.collect_set("lens")).alias("lens"))

    lengths = F.array(*[F.struct(F.lit(s).alias("size"), F.lit(n).alias("len")) for s, n, _ in found.lengths])
    parts = parts.select("*", F.inline(F.filter(lengths, lambda x: (x["size"] == F.col("size")) & F.array_contains("lens", x["len"]))).alias("same_size", "len")).drop("same_size")
    parts = parts.withColumn("n", F.least("len", "n_words") - F.col("size") + 1)
    base = F.col("segment") * SEGMENT
    last = F.least(F.greatest(F.lit(0), F.col("n_words") - F.col("len")), base + (SEGMENT - 1))
    starts = F.when(last >= base, F.sequence(base, last)).otherwise(F.array().cast("array<int>"))
    parts = parts.select("*", F.explode(starts).alias("start"))
    lo, hi = F.get("run", F.col("start") - base), F.get("run", F.col("start") - base + F.col("n"))
    sums = parts.withColumn("total", hi["total"] - lo["total"]).withColumn("held", hi["held"] - lo["held"]).withColumn("pulls", hi["pulls"] - lo["pulls"])
    able = sums.where(F.col("held") >= F.lit(threshold * SLACK) * F.col("total"))
    able = able.select("doc_id", *TEXT, "size", "len", "start", "n", "pulls", lo["lanes"].alias("lo"), hi["lanes"].alias("hi"))
    return able.select("doc_id", *TEXT, "size", "len", "start", "n", print_of(F.col("hi"), F.col("lo"), F.col("pulls")).alias("print"))


def near_pairs(windows: DataFrame, found: Index) -> DataFrame:
    """Windows and items that meet in a block and are within the radius: each pair once."""
    keys = index_keys(F.col("len"), F.col("print"), found.plan, near=False)
    met = windows.select("*", F.explode(keys).alias("key")).join(found.index(), "key")
    near = met.where(hamming(F.col("print"), F.col("item_print")) <= found.radius)
    return near.select("doc_id", *TEXT, "size", "start", "n", "row").distinct()


def verified(pairs: DataFrame, texts: DataFrame, found: Index, threshold: float) -> DataFrame:
    """doc_id, row, start, similarity of the pairs at the threshold: sum of w * min(n) over sum of w * max(n)."""
    same = (F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))) & (F.col("a.t1") == F.col("b.t1")) & (F.col("a.t2") == F.col("b.t2")) & (F.col("a.size") == F.col("b.size"))
    pair = ["doc_id", *TEXT, "row", "start"]
    grams = pairs.alias("a").join(texts.alias("b"), same).select("a.doc_id", "a.t1", "a.t2", "row", "start", F.explode(F.slice("grams", F.col("start") + 1, F.col("n"))).alias("h"))
    bags = grams.groupBy(*pair, "h").agg(F.count("*").alias("n")).join(found.known("w"), "h", "left")
    bags = bags.join(small_side(found.bags.select("row", "h", "held"), found.n_grams, MAX_GRAMS), ["row", "h"], "left")
    w = F.coalesce("w", F.lit(found.default))
    sums = bags.groupBy(*pair).agg(F.sum(w * F.col("n")).alias("window"), F.sum(w * F.least("n", F.coalesce("held", F.lit(0)))).alias("shared"))
    sums = sums.join(small_side(found.prints.select("row", "weight"), found.n, MAX_GRAMS), "row")
    sums = sums.withColumn("similarity", F.round(F.col("shared") / (F.col("window") + F.col("weight") - F.col("shared")), 9))
    return sums.where(F.col("similarity") >= threshold).select("doc_id", *TEXT, "row", "start", "similarity")


def matches(docs: DataFrame, found: Index, threshold: float, doc: str, text: str) -> DataFrame:
    """As verified, of all texts of docs."""
    texts = candidate_texts(docs, found, threshold, doc, text)
    return verified(near_pairs(window_prints(texts, found, threshold), found), texts, found, threshold)


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, threshold: float = THRESHOLD, text: str = "text", doc: str = "doc_id", item: str = "item_id") -> DataFrame:
    """doc_id, item_id, start (word at which the best window starts), similarity: one row per document and leaked item."""
    found = Index(benchmark, threshold, item, "text")
    if not found.n:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema[doc].dataType.simpleString()}, item_id {benchmark.schema[item].dataType.simpleString()}, start int, similarity double")
    best = matches(docs, found, threshold, doc, text).groupBy("doc_id", "row").agg(F.max(F.struct("similarity", (-F.col("start")).alias("start"))).alias("best"))
    named = best.join(small_side(found.items.select("row", "item_id"), found.n, MAX_GRAMS), "row")
    return named.select("doc_id", "item_id", (-F.col("best.start")).alias("start"), F.round("best.similarity", 6).alias("similarity"))


def drop_leaky(docs: DataFrame, benchmark: DataFrame, *, threshold: float = THRESHOLD, text: str = "text", doc: str = "doc_id", item: str = "item_id") -> DataFrame:
    """The rows of docs whose text holds no item, all columns as they were. A row goes by its text, whatever its doc_id, null included."""
    found = Index(benchmark, threshold, item, "text")
    if not found.n:
        return docs
    names = private_name(docs, "t1"), private_name(docs, "t2")
    texts = docs.select(F.lit(0).alias("doc_id"), F.col(f"`{text}`").alias("text"))
    leaky = cut(matches(texts, found, threshold, "doc_id", "text").select(*TEXT).distinct().toDF(*names))
    same = [a == leaky[b] for a, b in zip(text_key(docs[f"`{text}`"]), names)]
    return docs.join(small_side(leaky, leaky.count(), MAX_KEYS), same, "left_anti")
