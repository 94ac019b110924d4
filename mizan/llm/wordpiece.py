"""Token counts by a linear longest-match automaton.

A trie of the vocabulary has failure links and, for each, the number of tokens that taking
the link pops; walking a word through it counts its greedy longest-match pieces in time
linear in the word, without building a piece (Song et al., "Fast WordPiece Tokenization", 2021).
"""

from __future__ import annotations

import re
from collections import deque
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, carried, schema_with, table

MODEL = "piece_bpe_32k.model"
#: Words: runs of letters and digits (and whatever is no ASCII mark or white space); each ASCII mark is a word.
WORDS = re.compile(r"[^\s!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]")
REMEMBERED = 300_000


def vocabulary(path: str, mark: str = "▁") -> tuple[frozenset[str], frozenset[str]]:
    """Pieces that begin words (marked in the model) and pieces that continue them."""
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [lib.id_to_piece(i) for i in range(lib.get_piece_size()) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
    return frozenset(p[1:] for p in names if p[0] == mark and p.strip(mark)), frozenset(p for p in names if mark not in p)


class Automaton:
    """Counts greedy longest-match pieces; a word with a part that matches nothing is one unknown token."""

    def __init__(self, first: frozenset[str], rest: frozenset[str]):
        #: Node 0 is where words begin, node 1 where pieces that continue them do.
        self.next: list[dict[str, int]] = [{}, {}]
        final = [False, False]
        for root, pieces in enumerate((first, rest)):
            for piece in pieces:
                node = root
                for c in piece:
                    to = self.next[node].get(c)
                    if to is None:
                        to = self.next[node][c] = len(self.next)
                        self.next.append({})
                        final.append(False)
                    node = to
                final[node] = True
        n = len(self.next)
        #: Where to go on when a node has no edge, and how many tokens that pops; -1: nothing is left.
        self.link, self.popped = [-1] * n, [0] * n
        queue = deque((child, root, c) for root in (0, 1) for c, child in self.next[root].items())
        while queue:
            node, parent, c = queue.popleft()
            if final[node]:
                self.link[node], self.popped[node] = 1, 1
            else:
                at, popped = self.link[parent], self.popped[parent]
                while at >= 0 and c not in self.next[at]:
                    popped, at = popped + self.popped[at], self.link[at]
                if at >= 0:
                    self.link[node], self.popped[node] = self.next[at][c], popped
            queue.extend((child, node, d) for d, child in self.next[node].items())

    def count(self, word: str) -> int:
        """Tokens of a word; 0 for an empty one."""
        edges, link, popped = self.next, self.link, self.popped
        node, tokens = 0, 0
        for c in word:
            while (to := edges[node].get(c)) is None:
                tokens += popped[node]
                node = link[node]
                if node < 0:
                    return 1
            node = to
        while node > 1:  # what is open at the end of the word
            tokens += popped[node]
            node = link[node]
        return 1 if node < 0 else tokens


class Counts:
    """Counts for texts; remembers the words seen last."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.known = automaton, {}

    def __call__(self, text: str | None) -> tuple[int, int]:
        """(words, tokens) of a text."""
        words, known = WORDS.findall(text or ""), self.known
        try:
            return len(words), sum(map(known.__getitem__, words))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for w in set(words).difference(known):
                known[w] = self.automaton.count(w)
            return len(words), sum(map(known.__getitem__, words))


def longest_match(word: str, first: frozenset[str], rest: frozenset[str]) -> int:
    """The same count by trying the longest piece first, for tests."""
    i, n = 0, 0
    while i < len(word):
        j = next((j for j in range(len(word), i, -1) if word[i:j] in (rest if i else first)), 0)
        if not j:
            return 1
        i, n = j, n + 1
    return n


@lru_cache(maxsize=2)
def counter(path: str) -> Counts:
    return Counts(Automaton(*vocabulary(path)))


def counted(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, n_words and n_tokens of each text; a kept column named like a new one is an error."""
    docs = carried(docs, keep, ("n_words", "n_tokens"), "text")

    def run(batch: pa.RecordBatch, count: Counts) -> pa.RecordBatch:
        got = [count(t) for t in batch.column("text").to_pylist()]
        new = [pa.array([g[k] for g in got], pa.int64()) for k in (0, 1)]
        return pa.record_batch([batch.column("row"), *new], names=["row", "n_words", "n_tokens"])

    out = arrow_map(docs, run, schema_with(docs, ("row",), "n_words bigint, n_tokens bigint"), lambda: counter(path))
    return out.select("row.*", "n_words", "n_tokens")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens of the whole text.

    Null and empty texts have none; repeated rows and rows without doc_id stay; there are no ties to break.
    """
    return counted(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(MODEL))


QUERIES = {"op4_token_counts": op4_token_counts}
ORACLES: dict[str, str] = {}
