"""Token counts by a linear longest-match automaton.

Words are split on ASCII white space and marked with the vocabulary's word
start.  From left to right each takes the longest piece of the vocabulary that
fits; single bytes are pieces too, so a character the vocabulary lacks counts
as its bytes.

The automaton is the byte trie of all pieces.  Where the trie has no way on, a
node's pops are the pieces that greedy matching has then settled, and its
failure link is the node of what is left.  Both are found breadth first, so
reading a word is linear in its bytes and no piece is ever built.  The
automaton is made once on the driver; its size is that of the vocabulary.

Words advance together, byte by byte, while they are many; the few longest, as a text
without white space is, are read one by one.

Edge cases: null, empty and blank texts have no words and no tokens.  Repeated
rows are counted alike; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.runtime import plain
from tickloom.llm.textwords import RAW, chunks, split_words, text_bytes

#: Words that are left at a length and then read one by one.
FEW = 24


@dataclass
class Automaton:
    """Trie edges as sorted keys node * 256 + byte; per node pops, failure link and tokens up to the end."""

    keys: np.ndarray
    nodes: np.ndarray
    pops: np.ndarray
    fail: np.ndarray
    flush: np.ndarray
    mark: bytes
    # the same as plain Python values, made in a task that meets a long word
    _edges: dict[int, int] | None = None
    _plain: tuple[list[int], list[int]] | None = None

    @classmethod
    def build(cls, pieces: Iterable[bytes], mark: bytes) -> Automaton:
        children: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in [*(bytes([b]) for b in range(256)), *pieces]:
            at = 0
            for byte in piece:
                if byte not in children[at]:
                    children[at][byte] = len(children)
                    children.append({})
                    whole.append(False)
                at = children[at][byte]
            whole[at] = at != 0
        size = len(children)
        pops, fail, flush = [0] * size, [0] * size, [0] * size
        level = [0]
        while level:
            below = []
            for up in level:
                for byte, node in children[up].items():
                    if whole[node]:
                        pops[node], fail[node] = 1, 0
                    else:
                        # what the parent settles, and then whatever has to go until this byte fits on
                        settled, rest = pops[up], fail[up]
                        while byte not in children[rest]:
                            settled, rest = settled + pops[rest], fail[rest]
                        pops[node], fail[node] = settled, children[rest][byte]
                    flush[node] = pops[node] + flush[fail[node]]
                    below.append(node)
            level = below
        edges = sorted((node * 256 + byte, child) for node, out in enumerate(children) for byte, child in out.items())
        return cls(np.array([k for k, _ in edges], np.int64), np.array([c for _, c in edges], np.int32), np.array(pops, np.int32), np.array(fail, np.int32), np.array(flush, np.int32), mark)

    def counts(self, words: pa.Array) -> np.ndarray:
        """The number of tokens of each word; all words advance together, byte by byte."""
        offsets, data = text_bytes(words)
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = offsets[:-1][order], sizes[order]
        state, count = self._start(len(order))
        left = len(order)
        for at in range(int(sizes[0]) if len(sizes) else 0):
            while left and sizes[left - 1] <= at:
                left -= 1
            if left <= FEW:
                # the longest words, each on its own: a step of few words costs as much as one of many
                for word in range(left):
                    rest = data[starts[word] + at : starts[word] + sizes[word]].tobytes()
                    state[word], count[word] = self._walk(int(state[word]), int(count[word]), rest)
                break
            byte = data[starts[:left] + at].astype(np.int64)
            self._advance(state[:left], count[:left], byte)
        out = np.empty(len(order), np.int64)
        out[order] = count + self.flush[state]
        return out

    def _walk(self, state: int, count: int, rest: bytes) -> tuple[int, int]:
        """The state and count after the rest of one word."""
        if self._edges is None:
            self._edges = dict(zip(self.keys.tolist(), self.nodes.tolist(), strict=True))
            self._plain = self.pops.tolist(), self.fail.tolist()
        ways, (pops, fail) = self._edges.get, self._plain
        for byte in rest:
            while (node := ways(state << 8 | byte)) is None:
                count += pops[state]
                state = fail[state]
            state = node
        return state, count

    def _start(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        state, count = np.zeros(1, np.int64), np.zeros(1, np.int64)
        for byte in self.mark:
            self._advance(state, count, np.array([byte]))
        return np.repeat(state, n), np.repeat(count, n)

    def _advance(self, state: np.ndarray, count: np.ndarray, byte: np.ndarray) -> None:
        todo = np.arange(len(state))
        while len(todo):
            key = state[todo] * 256 + byte[todo]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            state[todo[found]] = self.nodes[at[found]]
            todo = todo[~found]
            count[todo] += self.pops[state[todo]]
            state[todo] = self.fail[state[todo]]


def sentencepiece_vocabulary(name: str = "piece_bpe_32k.model") -> tuple[list[bytes], bytes]:
    """The plain pieces of an installed public vocabulary, and its word start."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    plain_ids = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    return [model.id_to_piece(i).encode() for i in plain_ids], "▁".encode()


def count_tokens(documents: DataFrame, vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, n_words and n_tokens of every text."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(Automaton.build(*sentencepiece_vocabulary(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in chunks(batches):
            words = split_words(batch.column("text"), RAW)
            each = automaton.counts(words.dictionary)[words.codes]
            upto = np.concatenate([[0], np.cumsum(each)])
            yield pa.record_batch([batch.column("doc_id"), pa.array(words.counts, pa.int64()), pa.array(np.diff(upto[words.bounds]), pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return plain(documents, doc_id="long", text="string").mapInArrow(run, "doc_id long, n_words long, n_tokens long")
