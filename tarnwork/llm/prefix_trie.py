"""Prefix trie of conversations: a global range sort of turn arrays, adjacent LCPs, a stack sweep, open stacks stitched.

1. A turn (role, text) becomes a 16-byte key and its number of words; texts are never gathered. A conversation is the
   array of its turns' keys in turn order, rebuilt from the first turns of another one where the caller asks for it.
2. Arrays are range-sorted over all partitions by (keys, conv_id), so equal conversations spread over partitions too.
3. In each partition the longest common prefixes (LCP) of neighbours are swept with a stack: a node of depth d opens at
   the first row that has it and closes where the LCP falls below d. Counts over subtrees are differences of running
   sums, as nodes come in preorder.
4. Nodes that hold the first or last row of a partition may go on in the next one. These open nodes, a path or two a
   partition, carry a digest of their prefix; parts of equal digest are summed. Sums over their subtrees take steps of
   1, 2, 4, ... ancestors, so the rounds grow with the logarithm of the longest such path.
5. The ids of conversations that end at an open node are written as text in pieces, in order, and hashed as a stream.

Defined cases: a null role or text is empty. Turns are ordered by turn, nulls first; equal turns by role, then by the md5 of
the turn. Rows of one conv_id are one conversation, however often they repeat. Rows with a null conv_id belong to
no conversation and are left out. The remainder of a negative conv_id is
that of SQL, not above zero. An empty table gives no rows, not even a root. Further columns are ignored.
A conversation's keys, 40 bytes a turn while they are gathered, fit in one row: some 50 million turns.
Turns of equal md5 (of role length, role and text) are taken as equal.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, flat_text, small_side

GROUP, SHARED = 20, 4  # the dealt query: conversations of a block of GROUP ids share the first turns of its first one
PIECE = 1 << 16  # characters of ids in one row
MAX_OPEN = 100_000  # open nodes that may be broadcast, some 10 MB
PART_TURNS = 200_000  # turns of a partition, which its sweep holds in memory
SPACES = " \t\n\u000b\f\r"
NO_ENDS = hashlib.sha256(b"").hexdigest()

KIND = {"boolean": pa.bool_(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "string": pa.string()}
SWEPT = (
    "open boolean, digest binary, parent_digest binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, words long, ends_sha256 string, part int, piece int, ids string"
)
ARROW = pa.schema([(name, KIND[kind]) for name, kind in (f.split(" ") for f in SWEPT.split(", "))])
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and \\t..\\r."""
    plain = F.trim(F.translate(text, SPACES, " " * len(SPACES)))
    return F.when(plain == "", F.lit(0)).otherwise(F.size(F.split(plain, " +"))).cast("long")


def turn_key(role: Column, text: Column) -> Column:
    """32 hexadecimal digits that stand for a turn."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def turn_arrays(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: array of (key, words) in turn order."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), turn_key(role, text).alias("key"), word_count(text).alias("words"))
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "key", "words"))).alias("rows"))
    return gathered.select("conv_id", F.transform("rows", lambda r: F.struct(r["key"].alias("key"), r["words"].alias("words"))).alias("turns"))


def rebuild(arrays: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """Conversation c starts with the first h turns of c - c % group, h = crc32(c) % shared, then has its own turns after its first h."""
    first = arrays.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, shared - 1).alias("head"))
    own = arrays.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int").alias("h"))
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    return own.join(first, "base", "left").select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def adjacent_lcp(keys: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per row the number of leading keys that it shares with the row before; 0 for the first."""
    lens = np.diff(offs)
    lcp = np.zeros(len(lens), np.int64)
    at = np.arange(1, len(lens))
    while len(at):
        at = at[(lens[at] > lcp[at]) & (lens[at - 1] > lcp[at])]
        at = at[keys[offs[at] + lcp[at]] == keys[offs[at - 1] + lcp[at]]]
        lcp[at] += 1
    return lcp


def stack_sweep(lcp: np.ndarray, opened: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node the last row that it holds and its parent (-1: none), per row the node at which it ends.

    Row i closes the nodes deeper than lcp[i] and opens the next opened[i] nodes; nodes are numbered as they open.
    """
    n, total = len(lcp), int(opened.sum())
    end, parent, ends_at = np.full(total, n - 1), np.arange(total) - 1, np.zeros(n, np.int64)
    stack: list[int] = []  # the open node of each depth
    new = 0
    for i, (depth, more) in enumerate(zip(lcp.tolist(), opened.tolist())):
        if i and len(stack) > depth + 1:
            end[stack[depth + 1 :]] = i - 1
            del stack[depth + 1 :]
        if more:
            parent[new] = stack[-1] if stack else -1
            stack.extend(range(new, new + more))
            new += more
        ends_at[i] = stack[-1]
    return end, parent, ends_at


def prefix_digests(keys: np.ndarray) -> list[bytes]:
    """A digest of each prefix of an array of keys, the empty one first."""
    out = [hashlib.blake2b(digest_size=16).digest()]
    for k in keys:
        out.append(hashlib.blake2b(out[-1] + k.tobytes(), digest_size=16).digest())
    return out


def id_pieces(ids: list[int]):
    """The ids, comma-joined, in texts of about PIECE characters."""
    for i in range(0, len(ids), PIECE // 8):
        yield ",".join(map(str, ids[i : i + PIECE // 8]))


def sweep(part: int, convs: np.ndarray, keys: np.ndarray, words: np.ndarray, offs: np.ndarray) -> pa.Table:
    """The nodes of one sorted partition, parts of open nodes, and the ids that end at these."""
    n, lens = len(convs), np.diff(offs)
    lcp = adjacent_lcp(keys, offs)
    opened = lens - lcp
    opened[0] += 1  # the root
    first = np.concatenate([[0], np.cumsum(opened)])
    end, parent, ends_at = stack_sweep(lcp, opened)
    start = np.repeat(np.arange(n), opened)
    depth = np.arange(len(end)) - first[start] + lcp[start] + 1 - (start == 0)
    last_words = np.zeros(len(end), np.int64)
    last_words[depth > 0] = words[(offs[start] + depth - 1)[depth > 0]]

    smallest = np.minimum.reduceat(np.append(convs, np.iinfo(np.int64).max), np.stack([start, end + 1], 1).ravel())[::2]
    count = end - start + 1
    is_open = (start == 0) | (end == n - 1)
    closed_child = ~is_open & (parent >= 0)
    children = np.bincount(parent[closed_child], minlength=len(end))
    after = first[end + 1]  # nodes come in preorder: a subtree is a range of them
    sums = []
    for own in (np.where(is_open | (children > 0), 0, 1), np.where(is_open, 0, (count - 1) * last_words)):
        run = np.concatenate([[0], np.cumsum(own)])
        total = run[after] - run[:-1]
        inner = np.flatnonzero(is_open & (parent >= 0))
        mine = total.copy()
        np.subtract.at(mine, parent[inner], total[inner])  # an open child brings its own share
        sums.append(np.where(is_open, mine, total))

    digest = np.full(len(end), None, object)
    for row in {0, n - 1}:
        path, v = prefix_digests(keys[offs[row] : offs[row + 1]]), int(ends_at[row])
        while v >= 0:
            digest[v] = path[depth[v]]
            v = int(parent[v])

    shas = np.full(len(end), NO_ENDS, object)
    pieces = []
    turn_over = np.flatnonzero(np.diff(ends_at, prepend=-1, append=-1))
    for i, j in zip(turn_over[:-1], turn_over[1:]):
        v, texts = ends_at[i], id_pieces(convs[i:j].tolist())
        if is_open[v]:
            pieces += [(digest[v], part, k, t) for k, t in enumerate(texts)]
        else:
            sha = hashlib.sha256()
            for k, t in enumerate(texts):
                sha.update(b"," * (k > 0) + t.encode())
            shas[v] = sha.hexdigest()

    inside = parent.clip(0)
    known = (parent >= 0) & ~is_open[inside]
    nodes = {
        "open": is_open, "digest": digest, "parent_digest": np.where(parent >= 0, digest[inside], None), "depth": depth, "conv_id": smallest,
        "parent_conv_id": pa.array(smallest[inside], pa.int64(), mask=~known), "n_convs": count, "n_children": children, "n_leaves": sums[0], "saved_tokens": sums[1], "words": last_words, "ends_sha256": shas,
    }
    columns = {}
    for f in ARROW:
        own = nodes.get(f.name)
        columns[f.name] = pa.nulls(len(end), f.type) if own is None else own if isinstance(own, pa.Array) else pa.array(own, f.type)
    table = pa.table(columns, schema=ARROW)
    ids = [dict(zip(("open", "digest", "part", "piece", "ids"), (True, *p))) for p in pieces]
    return pa.concat_tables([table, pa.Table.from_pylist(ids, schema=ARROW)])


def _sweep_partition(batches):
    held = [b for b in batches if b.num_rows]
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        data, ends = flat_text(rows["keys"])
        lists = rows["words"].chunk(0) if rows["words"].num_chunks else rows["words"].combine_chunks()
        yield from sweep(rows["part"][0].as_py(), rows["conv_id"].to_numpy(), np.frombuffer(bytes(data), "S32"), lists.flatten().to_numpy(), ends // 32).to_batches(max_chunksize=10_000)


def _stream_digests(batches):
    """Per digest, whose pieces come in order, the SHA-256 of the comma-joined ids."""
    now, sha = None, None
    for batch in batches:
        out = []
        for digest, ids in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist()):
            if digest != now:
                if now is not None:
                    out.append((now, sha.hexdigest()))
                now, sha = digest, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        yield pa.record_batch({"digest": pa.array([d for d, _ in out], pa.binary()), "ends_sha256": pa.array([h for _, h in out], pa.string())})
    if now is not None:
        yield pa.record_batch({"digest": pa.array([now], pa.binary()), "ends_sha256": pa.array([sha.hexdigest()], pa.string())})


def subtree_sums(nodes: DataFrame, *columns: str) -> DataFrame:
    """digest, and each column summed over the node and all below it. Ancestors at 1, 2, 4, ... steps: a round each."""
    now = cut(nodes.select("digest", F.col("parent_digest").alias("up"), *columns))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    for _ in range(deepest.bit_length()):
        below = now.where("up is not null").groupBy(F.col("up").alias("digest")).agg(*[F.sum(c).alias(f"more_{c}") for c in columns])
        further = now.select(F.col("digest").alias("up"), F.col("up").alias("further"))
        summed = now.join(below, "digest", "left").join(further, "up", "left")
        now = cut(summed.select("digest", F.col("further").alias("up"), *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in columns]))
    return now.select("digest", *columns)


def trie_nodes(arrays: DataFrame) -> DataFrame:
    """One row per node of the trie of arrays (conv_id, turns): RESULT, see the module's docstring."""
    spark = arrays.sparkSession
    flat = cut(arrays.select("conv_id", F.array_join("turns.key", "").alias("keys"), F.col("turns.words").alias("words")))
    turns = flat.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-turns // PART_TURNS))
    ordered = flat.repartitionByRange(parts, "keys", "conv_id").sortWithinPartitions("keys", "conv_id").withColumn("part", F.spark_partition_id())
    swept = cut(ordered.mapInArrow(_sweep_partition, SWEPT))

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    stitched = cut(swept.where("open and ids is null").groupBy("digest", "parent_digest", "depth", "words").agg(F.min("conv_id").alias("conv_id"), *sums))
    kids = stitched.groupBy(F.col("parent_digest").alias("digest")).agg(F.count("*").alias("kids"))
    counted = stitched.join(kids, "digest", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    counted = counted.withColumn("n_leaves", F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"))
    ends = swept.where("ids is not null").select("digest", "part", "piece", "ids").repartition("digest").sortWithinPartitions("digest", "part", "piece").mapInArrow(_stream_digests, "digest binary, ends_sha256 string")
    whole = counted.drop("n_leaves", "saved_tokens").join(subtree_sums(counted, "n_leaves", "saved_tokens"), "digest").join(ends, "digest", "left")
    spine = cut(whole.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))).withColumn("parent_conv_id", F.lit(None).cast("long")))

    up = small_side(spine.select(F.col("digest").alias("parent_digest"), F.col("conv_id").alias("up_conv")), spine.count(), MAX_OPEN)
    inputs = [*RESULT, "parent_digest"]
    rows = swept.where("not open").select(*inputs).unionByName(spine.select(*inputs)).join(up, "parent_digest", "left")
    return rows.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv")).select(*RESULT)


def conversation_trie(conversations: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie_nodes(rebuild(cut(turn_arrays(conversations)), group, shared))


ORACLE_SQL = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
keyed AS (SELECT conv_id, turn, role, md5(concat(length(role), ':', role, text)) AS key, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM turns),
own AS (SELECT conv_id, list({'k': key, 'w': words} ORDER BY turn NULLS FIRST, role, key) AS turns,
    xor(list_reduce([4294967295] || list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i])),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 4 AS h
  FROM keyed GROUP BY conv_id),
built AS (SELECT o.conv_id, list_concat(coalesce(list_slice(b.turns, 1, o.h), []), list_slice(o.turns, o.h + 1, len(o.turns))) AS turns
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
prefixes AS (SELECT conv_id, len(turns) AS n, d, md5(list_transform(list_slice(turns, 1, d), lambda t: t.k)::VARCHAR) AS id, CASE WHEN d > 0 THEN turns[d].w ELSE 0 END AS words,
    CASE WHEN d > 0 THEN md5(list_transform(list_slice(turns, 1, d - 1), lambda t: t.k)::VARCHAR) END AS up
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM built)),
nodes AS (SELECT d, id, any_value(up) AS up, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256 FROM prefixes GROUP BY d, id),
kids AS (SELECT up AS id, count(*) AS n_children FROM nodes GROUP BY up),
counted AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.id = n.id),
sums AS (SELECT p.id, sum(CASE WHEN c.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((c.n_convs - 1) * c.words) AS saved_tokens
  FROM counted c JOIN prefixes p ON p.conv_id = c.conv_id AND p.d <= c.d GROUP BY p.id)
SELECT c.conv_id, CAST(c.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(c.n_convs AS BIGINT) AS n_convs, CAST(c.n_children AS BIGINT) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums s ON s.id = c.id LEFT JOIN nodes u ON u.id = c.up"""
