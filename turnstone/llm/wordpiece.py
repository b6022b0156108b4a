"""Token counts by a linear longest-match automaton.

Greedy word-piece splitting takes, again and again, the longest vocabulary
entry that begins the rest of a word. The automaton does it in one pass: a
trie of the vocabulary whose nodes have a failure link and the number of
tokens that are popped when the link is taken (the pieces are never built).
Words of a slice are run in lockstep: one numpy step advances all distinct
words by one byte, so each distinct word of a slice costs one walk.

A word is a run without white space, and the text that is split is the word's
UTF-8 bytes after one space, as the byte-level vocabulary spells word
beginnings. All 256 bytes are entries, so no word is unknown.

Defined cases: a null or empty text has no words and no tokens. Repeated rows
count alike; a null doc_id keeps its row. Further columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from turnstone.llm.arrays import NOT_SPACE, SAME, Words, slices, text_array


def vocabulary(path: str) -> list[bytes]:
    """Entries of a byte-level tokenizer file, as bytes, without its special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec["added_tokens"]}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in plain}
    char |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return [bytes(char[c] for c in t) for t in spec["model"]["vocab"] if t not in special]


class LongestMatch:
    """Trie with failure links and popped-token counts, as flat arrays."""

    def __init__(self, entries: list[bytes]):
        child: list[dict[int, int]] = [{}]
        is_entry = [False]
        for e in entries:
            node = 0
            for b in e:
                nxt = child[node].get(b)
                if nxt is None:
                    nxt = child[node][b] = len(child)
                    child.append({})
                    is_entry.append(False)
                node = nxt
            is_entry[node] = True
        missing = [b for b in range(256) if b not in child[0] or not is_entry[child[0][b]]]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:8]}")
        fail, pops = [-1] * len(child), [0] * len(child)
        queue = [0]
        for u in queue:  # breadth first; grows while it is read
            for b, v in child[u].items():
                queue.append(v)
                if is_entry[v]:
                    fail[v], pops[v] = 0, 1
                    continue
                z, n = fail[u], pops[u]
                while z >= 0 and b not in child[z]:
                    n += pops[z]
                    z = fail[z]
                fail[v], pops[v] = (child[z][b], n) if z >= 0 else (-1, n)
        edges = sorted((u * 256 + b, v) for u, kids in enumerate(child) for b, v in kids.items())
        self.keys = np.array([k for k, _ in edges], np.int64)
        self.to = np.array([v for _, v in edges], np.int32)
        self.fail, self.pops = np.array(fail, np.int32), np.array(pops, np.int32)
        self.space = int(self.to[np.searchsorted(self.keys, 32)])

    def counts(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of pieces of each word ``data[start:end]``, with a space before it."""
        out = np.zeros(len(start), np.int64)
        state = np.full(len(start), self.space, np.int32)
        order = np.argsort(start - end, kind="stable")  # longest first: the active words are a prefix
        start, length = start[order], (end - start)[order]
        state, total = state[order], out[order]
        for j in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -j, side="left"))  # words longer than j
            at = np.arange(live)
            byte = data[start[:live] + j].astype(np.int64)
            while len(at):
                key = state[at].astype(np.int64) * 256 + byte[at]
                k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                ok = self.keys[k] == key
                state[at[ok]] = self.to[k[ok]]
                at = at[~ok]  # no edge: pop tokens and follow the failure link
                total[at] += self.pops[state[at]]
                state[at] = self.fail[state[at]]
        at = np.flatnonzero(state)
        while len(at):
            total[at] += self.pops[state[at]]
            state[at] = self.fail[state[at]]
            at = at[state[at] > 0]
        out[order] = total
        return out


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens."""
    if path is None:
        from turnstone.llm.packing import default_vocabulary
        path = default_vocabulary()
    machine = docs.sparkSession.sparkContext.broadcast(LongestMatch(vocabulary(path)))

    def run(batches):
        for batch in batches:
            for s in slices(text_array(batch)):
                w = Words(s, NOT_SPACE, SAME)
                _, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
                n = machine.value.counts(s.data, w.start[first], w.end[first])[back]
                tokens = np.concatenate([[0], np.cumsum(n)])[w.first]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.first, s.n), pa.array(np.diff(w.first), pa.int64()),
                     pa.array(np.diff(tokens), pa.int64())], ["doc_id", "n_words", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(docs["doc_id"], docs["text"]).mapInArrow(run, f"doc_id {kind}, n_words bigint, n_tokens bigint")
