"""Token counts by a linear longest-match automaton.

The vocabulary becomes a trie with two roots (first piece of a word, later pieces). Each
node has a failure link and the number of pieces that are complete when the link is taken;
one walk over the bytes of a word then gives the number of pieces that greedy longest match
would cut, without building any.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabwright.llm.common import scratch_name

FIRST, LATER = 0, 1
DEAD = -1


class Automaton:
    """Pieces counted by greedy longest match; a word that cannot be cut counts as one unknown piece."""

    def __init__(self, first: Iterable[bytes], later: Iterable[bytes]):
        self.next: dict[int, int] = {}
        children: list[list[tuple[int, int]]] = [[], []]
        ends = [False, False]
        for root, pieces in ((FIRST, first), (LATER, later)):
            for piece in pieces:
                at = root
                for c in piece:
                    to = self.next.get(at << 8 | c)
                    if to is None:
                        to = len(children)
                        self.next[at << 8 | c] = to
                        children[at].append((c, to))
                        children.append([])
                        ends.append(False)
                    at = to
                if piece:
                    ends[at] = True
        self.fail = [DEAD] * len(children)
        self.popped = [0] * len(children)
        queue = deque([FIRST, LATER])
        while queue:
            u = queue.popleft()
            for c, v in children[u]:
                queue.append(v)
                if ends[v]:
                    self.fail[v], self.popped[v] = LATER, 1
                    continue
                z, gone = self.fail[u], 0
                while z != DEAD and (z << 8 | c) not in self.next:
                    gone += self.popped[z]
                    z = self.fail[z]
                if z != DEAD:
                    self.fail[v], self.popped[v] = self.next[z << 8 | c], self.popped[u] + gone

    def tables(self) -> tuple[dict[int, int], list[int], list[int]]:
        return self.next, self.fail, self.popped

    @classmethod
    def of_tables(cls, tables: tuple[dict[int, int], list[int], list[int]]) -> Automaton:
        made = cls((), ())
        made.next, made.fail, made.popped = tables
        return made

    def count(self, word: bytes) -> int:
        """Pieces of a whole word (0 for the empty word, 1 for one that cannot be cut)."""
        step, fail, popped = self.next, self.fail, self.popped
        at, n = FIRST, 0
        for c in word:
            to = step.get(at << 8 | c)
            while to is None:
                n += popped[at]
                at = fail[at]
                if at == DEAD:
                    return 1
                to = step.get(at << 8 | c)
            at = to
        while at != LATER and at != FIRST:
            n += popped[at]
            at = fail[at]
            if at == DEAD:
                return 1
        return n


def read_pieces(path: str, mark: bytes = b" ") -> tuple[list[bytes], list[bytes]]:
    """First and later pieces of a rank file: first ones begin with the word mark."""
    with open(path, "rb") as lines:
        pieces = [base64.b64decode(x.split()[0]) for x in lines if x.strip()]
    return [p for p in pieces if p[:1] == mark], [p for p in pieces if p[:1] != mark]


class _Known(dict):
    """Counts of words seen before; forgotten when there are too many."""

    def __init__(self, automaton: Automaton, mark: bytes, most: int = 300_000):
        super().__init__()
        self.automaton, self.mark, self.most = automaton, mark, most

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(self.mark + word)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = n
        return n


def count_tokens(
    spark: SparkSession, docs: DataFrame, automaton: Automaton, mark: bytes = b" ",
    text_col: str = "text", n_words: str = "n_words", n_tokens: str = "n_tokens",
) -> DataFrame:
    """``docs`` without the text, plus words and pieces of each whole text.

    Words are runs without ASCII white space, each fed with ``mark`` in front. Null, empty
    and blank texts have none of either. Rows are independent, so repeated rows repeat
    their counts; an empty table stays empty; columns named as the two counts are replaced.
    The automaton is broadcast: its size is that of the vocabulary.
    """
    docs = docs.drop(*({n_words, n_tokens} & set(docs.columns)))
    shared = spark.sparkContext.broadcast(automaton.tables())
    body = scratch_name(docs, "_text")
    rest = [c for c in docs.columns if c != text_col]

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Known(Automaton.of_tables(shared.value), mark)
        for part in parts:
            words = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in part[body]]
            part = part[rest].copy()
            part[n_words] = [len(w) for w in words]
            part[n_tokens] = [sum(map(known.__getitem__, w)) for w in words]
            yield part

    fields = [docs.schema[c] for c in rest] + [T.StructField(n_words, T.LongType()), T.StructField(n_tokens, T.LongType())]
    return docs.withColumnRenamed(text_col, body).mapInPandas(count, T.StructType(fields))
