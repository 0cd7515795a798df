"""MinHash near-deduplication: an inverted join on signature coordinates, with prefix and skip merging.

1. Every whole text gives the set of its distinct SIZE-word shingles, a fingerprint of the set and a MinHash signature of COORDINATES
   values. Texts of equal sets are one class; only classes go on.
2. A class is posted under its pairs (coordinate, value). Two classes at the threshold share `matches` of them at least, with
   probability RECALL; so if each posts only the COORDINATES - matches + 1 pairs that come first in one order of all
   pairs, they still meet (prefix merging). The order is by frequency, rare first, so pairs that many texts share, such as those
   of boilerplate, are posted only by classes that have little else. Frequencies come from a sketch of fixed size over all signatures;
   its errors change the order, never the result.
3. In each posting list all members are held against one pivot, the collisions of both signatures are counted, coordinate block by
   block, leaving out pairs that can no longer reach `matches` (skip merging), and those retained are confirmed on full sets. After
   ROUNDS pivots, lists whose members all lie in one component of the links, as two steps along them show, are done: copies that are near
   their pivot are settled in linear work.
4. What is left of the other lists is dealt to units of bounded size, pairs of member blocks for long lists: collisions are
   counted for all pairs of a unit between different components, then full sets for members that have any partner there. A unit
   returns one link per member at most, so pairs are never written out.
5. Components of all links give each class its smallest doc_id.

Words are runs of characters other than space and \\t..\\r, A-Z in lower case. Two texts are linked if
100 * intersection >= 100 * threshold * union of their sets; a text of fewer than SIZE words has one shingle, all its words.

Defined cases: null texts and texts without words have no shingles and are linked with nothing. Each row is a document, linked by its
own text; rows that repeat have equal results, and rows of equal doc_id and different texts may lie in different components.
A null doc_id takes part in links but is never the smallest; a component of null doc_ids has a null component_id,
and its rows are kept. An empty table gives no rows. Further columns are ignored.
Shingles of equal 64-bit hash are equal, and sets of equal 128-bit fingerprint; a class is named by the first half of it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, cut, small_side
from .flatwords import FlatWords, mix
from .graph import components
from .ngram_join import intersections, smallest_relatives
from .text_stats import map_texts

SIZE, THRESHOLD, RECALL, COORDINATES = 4, 0.8, 0.9999, 64
CELLS = 1 << 20  # of the sketch: 8 MB on the driver, 4 MB a broadcast, whatever the corpus
ROUNDS = 1
UNIT_MEMBERS, UNIT_GRAMS = 1024, 400_000
MAX_IDS = 1_000_000  # ids that may be broadcast, about 40 MB; beyond, the same join shuffles
STEP = 8  # coordinates between two looks at which pairs can still match


def matches_at(threshold: float = THRESHOLD, recall: float = RECALL, coordinates: int = COORDINATES) -> int:
    """The most matching coordinates that a pair at the threshold reaches with probability recall."""
    below = 0.0
    for t in range(coordinates + 1):
        below += math.comb(coordinates, t) * threshold**t * (1 - threshold) ** (coordinates - t)
        if below > 1 - recall:
            return max(1, t)
    return coordinates


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, flat, and len+1 bounds."""
    w = FlatWords(lower_ascii(buf), offs)
    grams, bounds = w.shingles(w.word_hashes(), size)
    text = np.repeat(np.arange(w.n), np.diff(bounds))
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    return grams[new], np.concatenate([[0], np.cumsum(np.bincount(text[new], minlength=w.n))])


def signatures(grams: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """MinHash values, texts x coordinates, of texts that all have shingles."""
    rng = np.random.Generator(np.random.PCG64(4211))
    xor = rng.integers(0, 2**32, coordinates, dtype=np.uint32)
    mul = rng.integers(0, 2**32, coordinates, dtype=np.uint32) | np.uint32(1)
    x = (grams >> np.uint64(32)).astype(np.uint32) ^ grams.astype(np.uint32)
    out = np.empty((len(starts), coordinates), np.uint32)
    v, w = np.empty_like(x), np.empty_like(x)
    for k in range(coordinates):
        np.bitwise_xor(x, xor[k], out=v)
        np.multiply(v, mul[k], out=v)
        np.right_shift(v, 15, out=w)
        np.bitwise_xor(v, w, out=v)
        out[:, k] = np.minimum.reduceat(v, starts)
    return out


def _sign(size: int, coordinates: int):
    def make(buf, offs):
        grams, bounds = shingle_sets(buf, offs, size)
        n = np.diff(bounds)
        some = n > 0
        prints = []
        for salt in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)):
            run = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams ^ salt), dtype=np.uint64)])
            prints.append(mix(run[bounds[1:]] - run[bounds[:-1]] + n.astype(np.uint64)).view(np.int64))
        sig = signatures(grams, bounds[:-1][some], coordinates) if some.any() else np.zeros((0, coordinates), np.uint32)
        return [*prints, n, (sig.reshape(-1).view(np.int32), np.concatenate([[0], np.cumsum(some * coordinates)]))]

    return make


def _sets(size: int):
    def make(buf, offs):
        grams, bounds = shingle_sets(buf, offs, size)
        run = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams ^ np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)])
        name = mix(run[bounds[1:]] - run[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64)
        return [name, (grams.view(np.int64), bounds)]

    return make


def _matrix(column: pa.Array, coordinates: int) -> np.ndarray:
    """Signatures x coordinates of a list column."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(-1, coordinates).view(np.uint32)


def tokens(sig: np.ndarray) -> np.ndarray:
    """(coordinate, value) as one number."""
    return sig.astype(np.uint64) | (np.arange(sig.shape[1], dtype=np.uint64) << np.uint64(32))


def cells(token: np.ndarray) -> np.ndarray:
    return (mix(token) >> np.uint64(40)) & np.uint64(CELLS - 1)


def frequency_sketch(classes: DataFrame, coordinates: int) -> np.ndarray:
    """How many classes fall into each cell of a hash of (coordinate, value): CELLS counts, never too small for a pair."""

    def count(batches):
        for batch in batches:
            n = np.bincount(cells(tokens(_matrix(batch.column("sig"), coordinates))).ravel().astype(np.int64), minlength=CELLS)
            at = np.flatnonzero(n)
            yield pa.record_batch({"cell": pa.array(at, pa.int32()), "n": pa.array(n[at], pa.int64())})

    counts = classes.select("sig").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CELLS, np.int64)
    out[counts["cell"].to_numpy()] = counts["n"].to_numpy()
    return np.minimum(out, 2**32 - 1).astype(np.uint32)


def postings(classes: DataFrame, coordinates: int, prefix: int) -> DataFrame:
    """(token, f1): each class under the first `prefix` of its pairs, rare ones first; pairs that no other class can have are left out."""
    sketch = classes.sparkSession.sparkContext.broadcast(frequency_sketch(classes, coordinates))

    def post(batches):
        for batch in batches:
            token = tokens(_matrix(batch.column("sig"), coordinates))
            n = sketch.value[cells(token).astype(np.int64)]
            order = np.lexsort((mix(token), n), axis=1)[:, :prefix]
            token, n = np.take_along_axis(token, order, 1), np.take_along_axis(n, order, 1)
            shared = n > 1
            bounds = np.concatenate([[0], np.cumsum(shared.sum(1))])
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(token[shared].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("f1"), lists], ["f1", "tokens"])

    return classes.select("f1", "sig").mapInArrow(post, "f1 long, tokens array<long>").select("f1", F.explode("tokens").alias("token"))


def enough(a: np.ndarray, b: np.ndarray, matches: int) -> np.ndarray:
    """Rows in which signatures a and b collide in `matches` coordinates at least; those that cannot are left early."""
    coordinates = a.shape[1]
    alive, count = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k in range(0, coordinates, STEP):
        count += (a[alive, k : k + STEP] == b[alive, k : k + STEP]).sum(1)
        can = count + max(0, coordinates - k - STEP) >= matches
        alive, count = alive[can], count[can]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def retained(pairs: DataFrame, classes: DataFrame, coordinates: int, matches: int, threshold: float) -> DataFrame:
    """Those of the pairs (f1, pivot) whose sizes and collisions allow the threshold."""
    bound_batches(pairs.sparkSession)

    def keep(batches):
        for batch in batches:
            good = enough(_matrix(batch.column("sig"), coordinates), _matrix(batch.column("pivot_sig"), coordinates), matches)
            yield batch.select(["f1", "pivot", "n", "pivot_n"]).filter(pa.array(good))

    sized = pairs.join(classes.select("f1", F.col("n_shingles").alias("n"), "sig"), "f1")
    both = sized.join(classes.select(F.col("f1").alias("pivot"), F.col("n_shingles").alias("pivot_n"), F.col("sig").alias("pivot_sig")), "pivot")
    near = both.where(F.least("n", "pivot_n") >= threshold * F.greatest("n", "pivot_n") - 1e-6)
    return near.mapInArrow(keep, "f1 long, pivot long, n long, pivot_n long")


def full_sets(docs: DataFrame, classes: DataFrame, names: DataFrame, size: int) -> DataFrame:
    """f1, grams of the named classes, from the texts of their smallest documents. Repeated rows of a document give repeated rows."""
    wanted = cut(classes.join(names.distinct(), "f1", "left_semi").select("f1", F.col("rep").alias("rep_id")))
    n = wanted.count()
    ids = small_side(wanted.select("rep_id").distinct(), n, MAX_IDS)
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["rep_id"]), "left_semi")
    made = map_texts(texts, "t", _sets(size), [T.StructField("f1", T.LongType()), T.StructField("grams", T.ArrayType(T.LongType()))], [])
    return made.join(small_side(wanted.select("f1"), n, MAX_IDS), "f1", "left_semi")


def confirmed(near: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs of `near` that are linked by their full sets, as u, v."""
    pct = round(100 * threshold, 6)
    both = near.join(sets.withColumnRenamed("grams", "mine"), "f1").join(sets.select(F.col("f1").alias("pivot"), F.col("grams").alias("its")), "pivot")
    common = both.select("f1", "pivot", "n", "pivot_n", F.size(F.array_intersect("mine", "its")).alias("common"))
    return common.where(F.lit(100) * F.col("common") >= F.lit(pct) * (F.col("n") + F.col("pivot_n") - F.col("common"))).select(F.col("f1").alias("u"), F.col("pivot").alias("v"))


def _lists(table: pa.Table):
    """(rows of one posting list, as indices) of a unit."""
    token = table["token"].to_numpy()
    order = np.argsort(token, kind="stable")
    for rows in np.split(order, np.flatnonzero(token[order][1:] != token[order][:-1]) + 1):
        if len(rows) > 1:
            yield rows


def _apart(table: pa.Table, rows: np.ndarray) -> np.ndarray:
    """Pairs of a list that lie in different components, and in different blocks if the unit is of two."""
    root, block = table["root"].to_numpy()[rows], table["block"].to_numpy()[rows]
    apart = root[:, None] != root[None, :]
    if table["lo"][0].as_py() != table["hi"][0].as_py():
        apart &= block[:, None] != block[None, :]
    return apart


def _partnered(coordinates: int, matches: int):
    """Members of a unit that collide enough with a member of another component, where no earlier list holds both."""

    def unit(table: pa.Table) -> pa.Table:
        sig, good = _matrix(table["sig"], coordinates), np.zeros(len(table), bool)
        lists = table["tokens"].combine_chunks()
        offs, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        for rows in _lists(table):
            count, at, n = np.zeros((len(rows), len(rows)), np.uint8), sig[rows], len(rows)
            for k in range(coordinates):
                count += at[:, k][:, None] == at[:, k][None, :]
            near = (count >= matches) & _apart(table, rows)
            if near.any():  # a pair counts in the first list that both are in
                own = np.concatenate([values[offs[i] : offs[i + 1]] for i in rows])
                owner, before = np.repeat(np.arange(n), (offs[1:] - offs[:-1])[rows]), own < table["token"][rows[0]].as_py()
                if before.any():
                    near &= intersections(own[before], owner[before], n) == 0
            good[rows] |= near.any(1)
        return table.select(["unit", "lo", "hi", "block", "token", "f1", "root"]).filter(pa.array(good))

    return unit


def _linked(threshold: float):
    """Per member of a unit that has links to other components, the smallest class that they reach."""

    def unit(table: pa.Table) -> pa.Table:
        f1, grams = table["f1"].to_numpy(), table["grams"].combine_chunks()
        offs, values = grams.offsets.to_numpy(), grams.values.to_numpy()
        out = []
        for rows in _lists(table):
            sizes = (offs[1:] - offs[:-1])[rows]
            common = intersections(np.concatenate([values[offs[i] : offs[i + 1]] for i in rows]), np.repeat(np.arange(len(rows)), sizes), len(rows))
            linked = (common > 0) & (common * (1 + threshold) >= threshold * (sizes[:, None] + sizes[None, :]) - 1e-6) & _apart(table, rows)
            some = np.flatnonzero(linked.any(1))
            if len(some):
                out.append(np.stack([f1[rows][some], smallest_relatives(linked, f1[rows])[some]]))
        u, v = np.concatenate(out, 1) if out else np.zeros((2, 0), np.int64)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return unit


def rest_links(docs: DataFrame, members: DataFrame, classes: DataFrame, size: int, coordinates: int, matches: int, threshold: float) -> DataFrame:
    """Links (u, v) between components within the posting lists (token, f1, root), in units of bounded size."""
    in_lists = members.groupBy("f1").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    sized = members.join(classes.select("f1", "n_shingles", "sig").join(in_lists, "f1"), "f1")
    lists = cut(sized.groupBy("token").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("g")).withColumn("blocks", F.greatest(F.ceil(F.col("m") / UNIT_MEMBERS), F.ceil(F.col("g") / UNIT_GRAMS)).cast("int")))
    whole = lists.where("blocks = 1").agg(F.sum("m").alias("m"), F.sum("g").alias("g")).first()
    packs = max(1, -(-(whole["m"] or 0) // (UNIT_MEMBERS // 2)), -(-(whole["g"] or 0) // (UNIT_GRAMS // 2)))
    block = F.pmod(F.xxhash64("f1"), F.col("blocks")).cast("int")
    other = lambda o: F.struct(F.col("token").alias("unit"), F.least(block, o).alias("lo"), F.greatest(block, o).alias("hi"), block.alias("block"))
    packed = F.array(F.struct(F.pmod(F.xxhash64("token"), F.lit(packs)).alias("unit"), F.lit(-1).alias("lo"), F.lit(-1).alias("hi"), F.lit(0).alias("block")))
    units = F.when(F.col("blocks") == 1, packed).otherwise(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), other))
    dealt = sized.join(lists.select("token", "blocks"), "token").select("token", "f1", "root", "sig", "tokens", F.inline(units))
    kept = "unit long, lo int, hi int, block int, token long, f1 long, root long"
    partnered = cut(dealt.groupBy("unit", "lo", "hi").applyInArrow(_partnered(coordinates, matches), kept))
    sets = full_sets(docs, classes, partnered.select("f1"), size).dropDuplicates(["f1"])
    return partnered.join(sets, "f1").groupBy("unit", "lo", "hi").applyInArrow(_linked(threshold), "u long, v long")


def with_roots(members: DataFrame, links: DataFrame) -> DataFrame:
    """members and a class of the same component as theirs, their own where they have no link: two steps along links to smaller pivots.

    Equal roots mean one component; the reverse need not hold, so a list may stay open for nothing, never the other way.
    """
    near = links.groupBy(F.col("u").alias("f1")).agg(F.min("v").alias("v")).select("f1", F.least("f1", "v").alias("near"))
    far = near.select(F.col("f1").alias("near"), F.col("near").alias("far"))
    return members.join(near.join(far, "near", "left").select("f1", F.coalesce("far", "near").alias("root")), "f1", "left").withColumn("root", F.coalesce("root", "f1"))


def open_lists(members: DataFrame) -> DataFrame:
    """Posting lists of members in several components."""
    members = cut(members)
    still = members.groupBy("token").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("token")
    return cut(members.join(still, "token"))


def near_copies(docs: DataFrame, *, text: str = "text", threshold: float = THRESHOLD, size: int = SIZE, recall: float = RECALL, coordinates: int = COORDINATES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs."""
    matches = matches_at(threshold, recall, coordinates)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    fields = [T.StructField(c, T.LongType()) for c in ("f1", "f2", "n_shingles")] + [T.StructField("sig", T.ArrayType(T.IntegerType()))]
    signed = cut(map_texts(texts, "t", _sign(size, coordinates), fields, ["doc_id"]))
    grouped = signed.where("n_shingles > 0").groupBy("f1", "f2")
    classes = cut(grouped.agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")))

    posted = postings(classes, coordinates, coordinates - matches + 1)
    shared = posted.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token")
    members = cut(posted.join(shared, "token").select("token", "f1", F.col("f1").alias("root")))
    links = texts.select(F.col("doc_id").alias("u"), F.col("doc_id").alias("v")).where("false")
    for k in range(ROUNDS):
        first = F.min(F.struct(F.xxhash64("f1", F.lit(k)), "f1", "root"))
        pivots = members.groupBy("token").agg(first["f1"].alias("pivot"), first["root"].alias("pivot_root"), F.count("*").alias("n")).where("n > 1")
        held = cut(members.join(pivots, "token").where("f1 <> pivot"))
        near = cut(retained(held.where("root <> pivot_root").select("f1", "pivot").distinct(), classes, coordinates, matches, threshold))
        found = confirmed(near, full_sets(texts, classes, near.select("f1").unionAll(near.select(F.col("pivot").alias("f1"))), size), threshold)
        links = cut(links.unionAll(found))
        members = open_lists(with_roots(held.where("n > 2").select("token", "f1"), links))
        if not members.limit(1).count():
            break
    else:
        links = cut(links.unionAll(rest_links(texts, members, classes, size, coordinates, matches, threshold)))

    reached = cut(components(links).withColumnRenamed("node", "f1"))
    linked = classes.select("f1", "f2", "rep").join(reached, "f1")
    least = linked.groupBy("component").agg(F.min("rep").alias("component_id"))
    copies = classes.where("copies > 1").join(reached, "f1", "left_anti").select("f1", "f2", F.col("rep").alias("component_id"))
    ids = linked.join(least, "component").select("f1", "f2", "component_id").unionAll(copies)
    out = signed.select("doc_id", "n_shingles", "f1", "f2").join(ids, ["f1", "f2"], "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE_SQL = r"""
WITH RECURSIVE worded AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS g FROM worded),
shingles AS (SELECT r, unnest(g) AS x FROM sets),
common AS (SELECT a.r AS u, b.r AS v, count(*) AS n FROM shingles a JOIN shingles b ON a.x = b.x AND a.r < b.r GROUP BY 1, 2),
near AS (SELECT u, v FROM common JOIN sets a ON a.r = u JOIN sets b ON b.r = v WHERE 100 * n >= 80 * (len(a.g) + len(b.g) - n)),
links AS (SELECT u, v FROM near UNION ALL SELECT v, u FROM near),
reached AS (SELECT r, r AS other FROM sets UNION SELECT reached.r, links.v FROM reached JOIN links ON links.u = reached.other),
least AS (SELECT reached.r, min(sets.doc_id) AS component_id FROM reached JOIN sets ON sets.r = reached.other GROUP BY 1)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM sets JOIN least USING (r)"""
