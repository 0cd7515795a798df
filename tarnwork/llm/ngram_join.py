"""N-gram Jaccard self-join: MinHash banding, then exact verification on full n-gram sets.

1. Every whole text gives a fingerprint of its word sequence and MinHash band keys. Texts with one
   fingerprint are a class; only its representative (the smallest doc_id) goes on.
2. Band keys are dealt out; in each bucket all members are linked to its smallest one. The connected
   components of these links hold all pairs that share a bucket.
3. Pairs that share a bucket are verified in units of bounded size. Small components are packed together. A large one is
   split either into blocks of members, a unit for each pair of blocks, or into its buckets, cut into blocks alike:
   whichever deals out fewer rows. Blocks suit a group of near copies, which share nearly all buckets; buckets suit a
   chain of texts that share few, where the rows stay in proportion to the candidates. Both verify the same pairs.
   A unit counts intersections of full n-gram sets for all its pairs and returns, per member, its number
   of links and its smallest relative; pairs are never written out. A pair counts in the unit of its first shared band.
4. Smallest relatives are joined to classes of similar documents: components of verified links.

Two texts are linked at a Jaccard similarity of at least THRESHOLD of their sets of SIZE-word n-grams.
Words are lower-cased runs of letters, digits and underscores (ASCII punctuation and spaces separate them), so copies that
differ in case or punctuation alone are equal; a text of fewer than SIZE words is one n-gram.
Bands and rows are the most selective that reach RECALL at the threshold within MAX_HASHES.

Defined cases: null texts and texts without words have no n-grams: each is a class of its own without links. Rows with
equal doc_id are one document: they share its class and all are returned. A row with a null doc_id is
counted as a copy but represents no class; a class of only such rows has a null class_id.
An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, private_name, small_side
from .flatwords import NOT_ALPHANUMERIC, FlatWords, mix
from .graph import components
from .text_stats import map_texts

SIZE, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9999, 128
UNIT_MEMBERS, UNIT_GRAMS = 1024, 400_000
MAX_IDS = 1_000_000  # ids that may be broadcast, about 40 MB; beyond, the same joins shuffle


def banding(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band for which enough bands fit into max_hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        if threshold**rows * max_hashes < 1e-9:  # out of reach
            break
        bands = max(1, math.ceil(math.log1p(-recall) / math.log1p(-(threshold**rows))))
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("no banding reaches the recall within max_hashes")
    return best


def minhash_bands(grams: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band keys, texts x bands, of texts that all have n-grams."""
    rng = np.random.Generator(np.random.PCG64(97))
    xor = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
    mul = rng.integers(0, 2**32, bands * rows, dtype=np.uint32) | np.uint32(1)
    x, starts = (grams >> np.uint64(32)).astype(np.uint32), bounds[:-1]
    keys = np.zeros((len(starts), bands), np.uint64)
    v, w = np.empty_like(x), np.empty_like(x)
    for k in range(bands * rows):
        np.bitwise_xor(x, xor[k], out=v)
        np.multiply(v, mul[k], out=v)
        np.right_shift(v, 15, out=w)
        np.bitwise_xor(v, w, out=v)
        low = np.minimum.reduceat(v, starts).astype(np.uint64)
        band = k // rows
        keys[:, band] = mix(keys[:, band] + low + np.uint64(band + 1))
    return keys


def _sign(bands: int, rows: int, size: int):
    def make(buf, offs):
        w = FlatWords(buf, offs, NOT_ALPHANUMERIC)
        words = w.word_hashes()
        f1, f2 = w.text_hashes(words)
        grams, bounds = w.shingles(words, size)
        n = np.diff(bounds)
        some = n > 0
        keys = minhash_bands(grams, np.append(bounds[:-1][some], bounds[-1]), bands, rows) if some.any() else np.zeros((0, bands), np.uint64)
        return [f1.view(np.int64), f2.view(np.int64), n, (keys.reshape(-1).view(np.int64), np.concatenate([[0], np.cumsum(some * bands)]))]

    return make


def _gram_sets(size: int):
    def make(buf, offs):
        w = FlatWords(buf, offs, NOT_ALPHANUMERIC)
        words = w.word_hashes()
        f1, _ = w.text_hashes(words)
        grams, bounds = w.shingles(words, size)
        sets = [np.unique(grams[i:j]) for i, j in zip(bounds[:-1], bounds[1:])]
        flat = np.concatenate(sets) if sets else grams
        return [f1.view(np.int64), (flat.view(np.int64), np.concatenate([[0], np.cumsum([len(s) for s in sets])]))]

    return make


def intersections(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """n x n matrix of how many values owners i and j share. Frequent values by matrix products, rare ones by counting pairs."""
    order = np.lexsort((owner, values))
    values, owner = values[order], owner[order]
    new = np.append(True, values[1:] != values[:-1])
    group = np.cumsum(new) - 1
    freq = np.bincount(group)[group]
    out = np.zeros((n, n), np.float32)
    rare = (freq > 1) & (freq <= 32)
    g, o = group[rare], owner[rare]
    cells = np.zeros(n * n, np.int64)
    for d in range(1, int(freq[rare].max()) if rare.any() else 0):
        hit = np.flatnonzero(g[d:] == g[:-d])
        if len(hit) == 0:
            break
        cells += np.bincount(o[hit] * n + o[hit + d], minlength=n * n)
    out += cells.reshape(n, n)
    out += out.T
    often = freq > 32
    g, o = group[often], owner[often]
    if len(g):
        g = np.cumsum(np.append(True, g[1:] != g[:-1])) - 1
        for c in range(0, int(g[-1]) + 1, 1024):
            i, j = np.searchsorted(g, [c, c + 1024])
            m = np.zeros((n, 1024), np.float32)
            m[o[i:j], g[i:j] - c] = 1
            out += m @ m.T
    np.fill_diagonal(out, 0)
    return out


def smallest_relatives(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Per member the smallest id in its connected component of the boolean matrix."""
    rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable").astype(np.int32)
    label = rank.copy()
    while True:
        near = np.where(linked, label[None, :], np.int32(2**31 - 1)).min(1)
        new = np.minimum(label, near)
        if (new == label).all():
            return np.sort(ids)[label]
        label = new


def sharing(linked: np.ndarray, keys: np.ndarray, band: int) -> np.ndarray:
    """linked without pairs that share no band key; with a band, without those that share an earlier one too."""
    i, j = np.nonzero(np.triu(linked))
    out = np.zeros_like(linked)
    for k in range(0, len(i), 1 << 14):
        a, b = i[k : k + (1 << 14)], j[k : k + (1 << 14)]
        same = keys[a] == keys[b]
        good = same.any(1) if band < 0 else same.argmax(1) == band
        good &= same.any(1)
        out[a[good], b[good]] = out[b[good], a[good]] = True
    return out


UNIT = "rep long, root long, links long"


def _verify(threshold: float):
    def unit(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        col = {c: table.column(c) for c in table.column_names}
        num = lambda c: col[c].to_numpy()
        rep, f1, comp, copies, block, lo, hi, band = (num(c) for c in ("rep", "f1", "comp", "copies", "block", "lo", "hi", "band"))
        keys = np.asarray(col["bands"].flatten() if isinstance(col["bands"], pa.Array) else col["bands"].chunk(0).flatten()).reshape(len(rep), -1)
        lists = col["grams"].chunk(0) if isinstance(col["grams"], pa.ChunkedArray) else col["grams"]
        offs = lists.offsets.to_numpy()
        values = lists.values.to_numpy()
        _, first = np.unique(np.stack([rep, f1], 1), axis=0, return_index=True)  # repeated rows are one text
        first = np.sort(first)
        size = np.diff(offs)[first]
        take = np.concatenate([values[offs[i] : offs[i + 1]] for i in first])
        n = len(first)
        rep, comp, copies, block = rep[first], comp[first], copies[first], block[first]
        shared = intersections(take, np.repeat(np.arange(n), size), n)
        linked = shared * (1 + threshold) >= threshold * (size[:, None] + size[None, :]) - 1e-6
        linked &= shared > 0
        linked &= comp[:, None] == comp[None, :]
        np.fill_diagonal(linked, False)
        if lo[0] != hi[0]:
            linked &= block[:, None] != block[None, :]
        linked = sharing(linked, keys[first], int(band[0]))
        links = linked @ copies
        some = np.flatnonzero(linked.any(1))
        root = smallest_relatives(linked, rep) if len(some) else rep
        return pa.table({"rep": pa.array(rep[some], pa.int64()), "root": pa.array(root[some], pa.int64()), "links": pa.array(links[some], pa.int64())})

    return unit


def _blocks(members: str, grams: str):
    return F.greatest(F.ceil(F.col(members) / UNIT_MEMBERS), F.ceil(F.col(grams) / UNIT_GRAMS)).cast("int")


def _split(unit, band, blocks):
    """A member's units in one group: its block with every block."""
    block = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    one = lambda o: F.struct(unit.alias("unit"), F.least(block, o).alias("lo"), F.greatest(block, o).alias("hi"), band.cast("int").alias("band"), block.alias("block"))
    return F.transform(F.sequence(F.lit(0), blocks - 1), one)


def place(members: DataFrame) -> tuple[DataFrame, bool]:
    """members with `units` (unit, lo, hi, band, block), the units to which each goes; and whether any component is spread over several."""
    sizes = cut(members.groupBy("comp").agg(F.count("*").alias("m"), F.sum("n_grams").alias("g")).withColumn("blocks", _blocks("m", "g")))
    alone = F.col("blocks") == 1
    total = sizes.agg(F.sum(F.when(alone, F.col("m"))).alias("m"), F.sum(F.when(alone, F.col("g"))).alias("g"), F.count_if(~alone).alias("large")).first()
    packs = max(1, -(-(total["m"] or 0) // (UNIT_MEMBERS // 2)), -(-(total["g"] or 0) // (UNIT_GRAMS // 2)))
    whole = F.array(F.struct(F.pmod(F.xxhash64("comp"), F.lit(packs)).alias("unit"), F.lit(-1).alias("lo"), F.lit(-1).alias("hi"), F.lit(-1).alias("band"), F.lit(0).alias("block")))
    if not total["large"]:
        return cut(members.withColumn("units", whole)), False
    large = members.join(sizes.where("blocks > 1").select("comp", "m", "blocks"), "comp")
    keyed = cut(large.select("comp", "rep", "n_grams", F.posexplode("bands").alias("band", "key")))
    buckets = cut(keyed.groupBy("comp", "band", "key").agg(F.count("*").alias("n"), F.sum("n_grams").alias("g")).where("n > 1").withColumn("parts", _blocks("n", "g")))
    cost = buckets.groupBy("comp").agg(F.sum(F.col("n") * F.col("parts")).alias("by_bucket"))
    chosen = cut(sizes.join(cost, "comp", "left").select("comp", "blocks", ((F.col("blocks") > 1) & (F.col("by_bucket") < F.col("m") * F.col("blocks"))).alias("bucketed")))
    dealt = keyed.join(buckets.select("comp", "band", "key", "parts"), ["comp", "band", "key"]).join(chosen.where("bucketed").select("comp"), "comp", "left_semi")
    by_bucket = dealt.groupBy("rep").agg(F.flatten(F.collect_list(_split(F.col("key"), F.col("band"), F.col("parts")))).alias("bucket_units"))
    rows = members.join(chosen, "comp").join(by_bucket, "rep", "left")
    units = F.when(alone, whole).when(F.col("bucketed"), F.col("bucket_units")).otherwise(_split(F.col("comp"), F.lit(-1), F.col("blocks")))
    return cut(rows.withColumn("units", units).where("units is not null").select(*members.columns, "units")), True


def join_classes(docs: DataFrame, *, text: str = "text", threshold: float = THRESHOLD, size: int = SIZE, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its group of similar documents), n_links (other documents at the threshold), one row per row of docs."""
    bands, rows = banding(threshold, recall)
    lowered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col(f"`{text}`")).alias("t"))
    fields = [T.StructField(c, T.LongType()) for c in ("f1", "f2", "n_grams")] + [T.StructField("bands", T.ArrayType(T.LongType()))]
    signed = cut(map_texts(lowered, "t", _sign(bands, rows, size), fields, ["doc_id"]))
    worded = signed.where("n_grams > 0")
    classes = cut(worded.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands")))

    keyed = classes.where("rep is not null").select("rep", F.explode("bands").alias("key"))
    # cut off, so that the join has plain shuffles on both sides, which AQE can split at a hot bucket
    hubs = cut(keyed.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1").select("key", "hub"))
    links = keyed.join(hubs, "key").where("rep <> hub").select(F.col("hub").alias("u"), F.col("rep").alias("v"))
    candidates = components(links)

    members = cut(classes.select("rep", "f1", "copies", "n_grams", "bands").join(candidates.select(F.col("node").alias("rep"), F.col("component").alias("comp")), "rep"))
    placed, several = place(members)

    # texts are cut to the members by their ids before they are shuffled
    ids = placed.select(F.col("rep").alias("doc_id"))
    n_ids = ids.count()
    narrow = lowered.join(F.broadcast(ids), "doc_id", "left_semi") if n_ids <= MAX_IDS else lowered
    texts = narrow.join(placed.withColumnRenamed("rep", "doc_id").withColumnRenamed("f1", "want"), "doc_id")
    sets = map_texts(texts, "t", _gram_sets(size), [T.StructField("f1", T.LongType()), T.StructField("grams", T.ArrayType(T.LongType()))], ["doc_id", "want", "comp", "copies", "bands", "units"])
    dealt = sets.where("f1 = want").select(F.col("doc_id").alias("rep"), "f1", "comp", "copies", "bands", "grams", F.inline("units"))
    verified = cut(dealt.groupBy("unit", "lo", "hi", "band").applyInArrow(_verify(threshold), UNIT))

    per_rep = verified.groupBy("rep").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    if several:
        grown = components(verified.select(F.col("rep").alias("u"), F.col("root").alias("v")))
        per_rep = per_rep.join(grown.select(F.col("node").alias("rep"), "component"), "rep", "left").select("rep", "links", F.coalesce("component", "root").alias("root"))
    named = classes.select("f1", "f2", "rep", "copies").join(per_rep, "rep", "left").select("f1", "f2", F.coalesce("root", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    found = worded.select("doc_id", "f1", "f2").join(named, ["f1", "f2"]).select("doc_id", "class_id", "n_links")
    return found.unionAll(signed.where("n_grams = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that represent their class, all columns as they were. Rows with a null doc_id stay."""
    key = private_name(docs, "gone")
    gone = cut(join_classes(docs, **options).where("doc_id <> class_id").select(F.col("doc_id").alias(key)).distinct())
    return docs.join(small_side(gone, gone.count(), MAX_IDS), docs["doc_id"].cast("long") == gone[key], "left_anti")
