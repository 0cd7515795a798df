"""Token counts by greedy longest match, in one left-to-right pass per word.

The vocabulary becomes a trie. Each node has a failure link and the number of pieces that are
popped on following it, both computed once from shallower nodes: if the longest piece that starts
at the word's current start is known, it is popped and the rest of the node's string is walked
again. A word is then counted without building pieces or looking back: on a missing
edge the pops are added and the link followed. A null link means the word cannot be segmented;
it counts as one unknown token.

Words are runs of other than space and \\t..\\r; a word starts with the vocabulary's space mark,
so pieces with the mark match only at word starts. Defined cases: a null or blank text has no
tokens; repeated rows each get their own result.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_COUNTERS: dict[tuple[str, str], "LongestMatchCounter"] = {}


class LongestMatchCounter:
    CACHE_WORDS = 400_000

    def __init__(self, vocabulary: list[str], mark: str = "▁"):
        self.mark = mark
        edges: list[dict[str, int]] = [{}]
        is_piece, text = [False], [""]
        for piece in vocabulary:
            node = 0
            for ch in piece:
                nxt = edges[node].get(ch)
                if nxt is None:
                    nxt = len(edges)
                    edges[node][ch] = nxt
                    edges.append({})
                    is_piece.append(False)
                    text.append(text[node] + ch)
                node = nxt
            is_piece[node] = True
        self.edges = edges
        # link[v]: where matching goes on after pops; pops[v]: how many; link -1: no segmentation.
        n = len(edges)
        self.link, self.pops = [-1] * n, [0] * n
        level = [(0, ch, v) for ch, v in edges[0].items()]
        while level:  # breadth first: a link leads to a shallower node
            below = []
            for parent, ch, v in level:
                if is_piece[v]:
                    self.link[v], self.pops[v] = 0, 1
                else:
                    z, count = self.link[parent], self.pops[parent]
                    while z >= 0 and ch not in edges[z]:
                        count += self.pops[z]
                        z = self.link[z] if z else -1
                    if z >= 0:
                        self.link[v], self.pops[v] = edges[z][ch], count
                below += [(v, c, w) for c, w in edges[v].items()]
            level = below
        self.cache: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Pieces of one word; 1 if it cannot be segmented."""
        edges, link, pops = self.edges, self.link, self.pops
        node = count = 0
        for ch in self.mark + word:
            nxt = edges[node].get(ch)
            while nxt is None:
                if node == 0 or link[node] < 0:
                    return 1
                count += pops[node]
                node = link[node]
                nxt = edges[node].get(ch)
            node = nxt
        while node:
            if link[node] < 0:
                return 1
            count += pops[node]
            node = link[node]
        return count

    def text(self, text: str) -> tuple[int, int]:
        """Words and tokens of a whole text."""
        words = WORD.findall(text)
        cache = self.cache
        if len(cache) > self.CACHE_WORDS:
            cache = self.cache = {}
        for w in set(words):
            if w not in cache:
                cache[w] = self.word(w)
        return len(words), sum(map(cache.__getitem__, words))


def piece_vocabulary(model_path: str) -> list[str]:
    """The ordinary pieces of a SentencePiece model: no control, unknown or byte pieces."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model_path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


def counter(model_path: str, mark: str = "▁") -> LongestMatchCounter:
    key = (model_path, mark)
    if key not in _COUNTERS:
        _COUNTERS[key] = LongestMatchCounter(piece_vocabulary(model_path), mark)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (all, if None), n_words and n_tokens of every whole text. One narrow pass, no shuffle."""
    keep = docs.columns if keep is None else keep
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches):
        c = counter(model_path)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            got = [c.text(x.as_py() or "") for x in column]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(len(keep))] + [pa.array([g[i] for g in got], pa.int64()) for i in (0, 1)], names=schema.fieldNames())

    return docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"].alias("\0text")).mapInArrow(run, schema)
