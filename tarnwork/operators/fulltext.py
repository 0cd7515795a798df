"""Full-text search: an inverted index as a table, and a query language of AND, OR, NOT, "phrases" and prefixes.

Words are runs of letters and digits, lower-cased, without accents, stemmed. Ranking is BM25 (k1 1.2, b 0.75).
Terms of a query select postings before any join, so the work follows the postings of its terms.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stemming import stem
from .lineage import cut

K1, B, IDF_FLOOR = 1.2, 0.75, 1e-6
WORD = r"[\p{L}\p{N}]+"
GAP = 10_000_000  # between the positions of text columns
# Latin letters with marks and their bare forms.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
BARE = "aaaaaaceeeeiiiinooooouuuuyy"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.lower(F.coalesce(text, F.lit(""))), ACCENTED, BARE), F.lit(WORD), F.lit(0))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _stems(tokens):
    """Each distinct word of a batch is stemmed once."""
    codes, distinct = pd.factorize(tokens.explode())
    stems = np.array([stem(w) for w in distinct] + [None], object)[codes]
    ends = np.cumsum(np.maximum(tokens.map(len), 1))  # explode gives an empty list one row
    return pd.Series([s[: len(ws)].tolist() for s, ws in zip(np.split(stems, ends[:-1]), tokens)])


def listed_stems(tokens: Column, forms: dict[str, str]) -> Column:
    """Words by a short list of forms and their stems; words that it lacks stay as they are."""
    known = F.create_map(*[F.lit(x) for pair in forms.items() for x in pair])
    return F.transform(tokens, lambda w: F.coalesce(F.try_element_at(known, w), w))


def postings(docs: DataFrame, key: str, *texts: str, stemmed: bool = True, forms: dict[str, str] | None = None) -> DataFrame:
    """(key, term, pos): one row per word; positions run on over the given text columns with a gap between them.

    forms: stems of listed words, in place of Porter's."""
    parts = docs.select(key, *[words(F.col(c)).alias(f"w{i}") for i, c in enumerate(texts)])
    out = None
    for i in range(len(texts)):
        tokens = F.col(f"w{i}")
        tokens = listed_stems(tokens, forms) if forms else _stems(tokens) if stemmed else tokens
        one = parts.select(key, F.posexplode(tokens).alias("p", "term")).select(key, "term", (F.col("p") + F.lit(i * GAP)).alias("pos"))
        out = one if out is None else out.unionAll(one)
    return out


@dataclass
class Node:
    kind: str  # term, prefix, phrase, and, or, not
    value: tuple


def parse(query: str, stem: Callable[[str], str] = stem) -> Node:
    """Terms side by side are joined by AND; NOT binds closer than AND, AND closer than OR. Raises ValueError on bad syntax.

    stem: as the index stems its words."""
    lexed = re.findall(r'"[^"]*"|\(|\)|[^\s()"]+', query)
    if query.count('"') % 2:
        raise ValueError("unterminated string")
    pos = 0

    def peek() -> str | None:
        return lexed[pos] if pos < len(lexed) else None

    def either() -> Node:
        nonlocal pos
        left = both()
        while peek() == "OR":
            pos += 1
            left = Node("or", (left, both()))
        return left

    def both() -> Node:
        nonlocal pos
        left = less()
        while peek() not in (None, ")", "OR"):
            if peek() == "AND":
                pos += 1
            left = Node("and", (left, less()))
        return left

    def less() -> Node:
        nonlocal pos
        left = atom()
        while peek() == "NOT":
            pos += 1
            left = Node("not", (left, atom()))
        return left

    def atom() -> Node:
        nonlocal pos
        token = peek()
        if token is None or token in ("AND", "OR", "NOT", ")"):
            raise ValueError(f"syntax error near {token!r}")
        pos += 1
        if token == "(":
            inner = either()
            if peek() != ")":
                raise ValueError("missing )")
            pos += 1
            return inner
        prefix = token.endswith("*") and not token.startswith('"')
        if not token.startswith('"') and re.search(r"[^\w*]", token):
            raise ValueError(f"syntax error near {token!r}")
        bare = "".join(c for c in unicodedata.normalize("NFKD", token.lower()) if not unicodedata.combining(c))
        ws = re.findall(r"[^\W_]+", bare)
        if not ws:
            raise ValueError(f"no words in {token!r}")
        if prefix and len(ws) == 1:
            return Node("prefix", (ws[0], stem(ws[0])))
        return Node("term", (stem(ws[0]),)) if len(ws) == 1 else Node("phrase", tuple(stem(w) for w in ws))

    if not lexed:
        raise ValueError("empty query")
    tree = either()
    if pos != len(lexed):
        raise ValueError(f"syntax error near {peek()!r}")
    return tree


def _has_prefix(text: str, stemmed: str | None = None) -> Column:
    """Terms that begin with the text as written or with its stem (Porter's, if none is given), as words that end there are stored stemmed."""
    return F.col("term").startswith(text) | F.col("term").startswith(stem(text) if stemmed is None else stemmed)


def _hits(node: Node, index: DataFrame, key: str) -> DataFrame:
    """(key) of documents that satisfy the node."""
    if node.kind == "term":
        return index.where(F.col("term") == node.value[0]).select(key).distinct()
    if node.kind == "prefix":
        return index.where(_has_prefix(*node.value)).select(key).distinct()
    if node.kind == "phrase":
        out = index.where(F.col("term") == node.value[0]).select(key, "pos")
        for i, term in enumerate(node.value[1:], 1):
            out = out.join(index.where(F.col("term") == term).select(key, (F.col("pos") - i).alias("pos")), [key, "pos"], "left_semi")
        return out.select(key).distinct()
    a, b = (_hits(x, index, key) for x in node.value)
    if node.kind == "or":
        return a.union(b).distinct()
    return a.join(b, key, "left_semi" if node.kind == "and" else "left_anti")


def _leaves(node: Node) -> list[Node]:
    if node.kind == "not":
        return _leaves(node.value[0])
    return [node] if node.kind in ("term", "prefix", "phrase") else [x for n in node.value for x in _leaves(n)]


def leaf_terms(leaf: Node) -> list[str]:
    return list(leaf.value) if leaf.kind == "phrase" else [leaf.value[0]]


def _all_leaves(node: Node) -> list[Node]:
    """Leaves, those behind NOT too."""
    return [node] if node.kind in ("term", "prefix", "phrase") else [x for n in node.value for x in _all_leaves(n)]


def wanted(tree: Node) -> Column:
    """The terms whose postings a query needs."""
    keep = F.lit(False)
    for leaf in _all_leaves(tree):
        keep = keep | (_has_prefix(*leaf.value) if leaf.kind == "prefix" else F.col("term").isin(leaf_terms(leaf)))
    return keep


def lengths_of(docs: DataFrame, key: str, *texts: str) -> DataFrame:
    """(key, dl): how many words the documents have that have any, without a row per word."""
    sizes = [F.size(words(F.col(c))).cast("long") for c in texts]
    return docs.select(key, sum(sizes[1:], sizes[0]).alias("dl")).where("dl > 0").groupBy(key).agg(F.sum("dl").alias("dl"))


def search(index: DataFrame, query: str, key: str = "cve_id", limit: int | None = 20, lengths: DataFrame | None = None) -> DataFrame:
    """(key, score) of the documents that match, best first; keys break ties. lengths: as lengths_of gives them; without it the index is counted.

    The postings of the query's terms are read out once and kept, not once for each place where the ranking needs them."""
    tree = parse(query)
    if lengths is None:
        lengths = index.groupBy(key).agg(F.count("*").alias("dl"))
    lengths, found = cut(lengths), cut(index.where(wanted(tree)))
    return rank(tree, found, key, lengths, lengths.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl")), limit)


def rank(tree: Node, index: DataFrame, key: str, lengths: DataFrame, totals: DataFrame, limit: int | None) -> DataFrame:
    """index: postings (key, term, pos) of the query's terms at least; lengths (key, dl) of their documents; totals: a row (n, avgdl)."""
    found = _hits(tree, index, key)
    tf = None
    for i, leaf in enumerate(_leaves(tree)):
        terms = leaf_terms(leaf)
        keep = _has_prefix(*leaf.value) if leaf.kind == "prefix" else F.col("term").isin(terms)
        one = index.where(keep).groupBy(key).agg((F.count("*") / len(terms)).alias("tf")).withColumn("leaf", F.lit(i))
        tf = one if tf is None else tf.unionAll(one)
    df = tf.groupBy("leaf").agg(F.count("*").alias("df"))
    idf = F.greatest(F.lit(IDF_FLOOR), F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    scored = tf.join(found, key, "left_semi").join(df, "leaf").join(lengths, key).crossJoin(totals).groupBy(key).agg(F.sum(weight).alias("score"))
    out = scored.orderBy(F.desc("score"), key)
    return out.limit(limit) if limit else out
