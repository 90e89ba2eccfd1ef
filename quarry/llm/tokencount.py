"""Token counts by a linear longest-match automaton.

Greedy longest-match word pieces are counted without building them: the vocabulary is a trie,
every node has a failure link to the node reached after popping the pieces that its string
is sure to start with, and the number of those pieces is precomputed.  Reading a word then takes
one trie step per character, plus links that only ever shorten the pending string, so the time
is linear in the word's length.

The vocabulary is that of a public SentencePiece model: pieces that begin with its word mark
(U+2581) start a word, the others continue one; the mark alone is a piece too, and may be all that
fits at a word's start.  Words are the runs of characters other than
ASCII white space; a word that the pieces cannot cover is one unknown token.

Defined cases: null text counts as empty; a text without words has no tokens; repeated rows and
null ids are counted like others; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import per_worker, schema_of, slices

MARK = "▁"
#: Words remembered per worker.
REMEMBERED = 1 << 19


def vocabulary(name: str = "piece_bpe_32k.model") -> list[str]:
    """Pieces of a public SentencePiece model (32,000), without control and byte pieces."""
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    return [sp.id_to_piece(i) for i in range(sp.vocab_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


class Automaton:
    """Trie of the pieces with failure links and counts of popped pieces.

    Node 0 starts a word (it holds the mark), node 1 continues one.  ``link[u]`` is the node that holds what is left of
    u's string after the longest-match pieces that are certain (-1: none fits), and
    ``popped[u]`` their number."""

    def __init__(self, pieces: list[str]) -> None:
        self.next: list[dict[str, int]] = [{}, {}]
        parent, letter, final = [-1, -1], ["", ""], [False, False]
        for piece in pieces:
            starts = piece.startswith(MARK)
            body = piece[1:] if starts else piece
            u = 0 if starts else 1
            for c in body:
                if c not in self.next[u]:
                    self.next[u][c] = len(self.next)
                    self.next.append({})
                    parent.append(u)
                    letter.append(c)
                    final.append(False)
                u = self.next[u][c]
            if body:
                final[u] = True
        n = len(self.next)
        self.link, self.popped = [-1] * n, [0] * n
        if MARK in pieces:                         # node 0 holds the mark, which is a piece itself
            self.link[0], self.popped[0] = 1, 1
        order, at = [0, 1], 0
        while at < len(order):                     # breadth first: links lead to shorter strings
            order.extend(self.next[order[at]].values())
            at += 1
        for v in order[2:]:
            if final[v]:
                self.link[v], self.popped[v] = 1, 1
                continue
            z, count, c = self.link[parent[v]], self.popped[parent[v]], letter[v]
            while z >= 0 and c not in self.next[z]:
                count += self.popped[z]
                z = self.link[z]
            if z >= 0:
                self.link[v], self.popped[v] = self.next[z][c], count

    def count(self, word: str) -> int:
        """Number of pieces of one word; -1 if they cannot cover it."""
        u, n = 0, 0
        for c in word:
            while (v := self.next[u].get(c)) is None:
                n += self.popped[u]
                u = self.link[u]
                if u < 0:
                    return -1
            u = v
        while u > 1:                              # what is pending at the word's end
            n += self.popped[u]
            u = self.link[u]
        return n if u == 1 else -1


def count_tokens(docs: DataFrame, pieces: list[str] | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_tokens`` and ``n_unknown`` (words that are one unknown token)."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces if pieces is not None else vocabulary())
    key = f"automaton-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = per_worker(key, lambda: (Automaton(shared.value), {}))
        for batch in (s for b in batches for s in slices(b)):
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                words = text.split() if text else []       # bytes: ASCII white space only
                new = {w for w in words if w not in known} if words else ()
                if len(known) + len(new) > REMEMBERED:
                    known.clear()
                    new = set(words)
                for w in new:
                    known[w] = automaton.count(w.decode())
                n = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                out[:, i] = len(words), np.abs(n).sum(), (n < 0).sum()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x) for x in out]],
                                             ["doc_id", "n_words", "n_tokens", "n_unknown"])

    return docs.select("doc_id", "text").mapInArrow(
        run, schema_of(docs, ["doc_id"], "n_words long, n_tokens long, n_unknown long"))
