"""Token counts by greedy longest match, from an automaton that never builds the pieces."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.llm.common import map_batches, raw_texts, slices

#: Mark of a word's first piece in the vocabulary.
MARK = "▁"

#: Distinct words a task remembers; the memory is emptied when it is full.
REMEMBERED = 200_000


def vocabulary(path: str) -> list[str]:
    """Pieces of a sentencepiece file without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]


class LongestMatch:
    """Trie of the pieces with failure links and the numbers of pieces that they pop.

    Node v stands for a string that has been read but not yet cut. If no edge goes on, the longest pieces at its front
    are popped, ``popped[v]`` of them, and reading goes on at ``fail[v]``, the node of what is left. ``rest[v]`` is the
    number of pieces if the word ends at v. Every character is read once, so counting is linear. A character that no
    piece starts with counts its UTF-8 bytes.
    """

    def __init__(self, pieces: list[str]) -> None:
        edges: list[dict[str, int]] = [{}]
        ends, parent, letter = [False], [0], [""]
        for piece in {*pieces, *(c for p in pieces for c in p)}:
            v = 0
            for c in piece:
                v = edges[v].setdefault(c, len(edges)) if c in edges[v] else self._new(edges, ends, parent, letter, v, c)
            ends[v] = True
        n = len(edges)
        fail, popped, rest = [-1] * n, [0] * n, [0] * n
        queue = deque(edges[0].values())
        while queue:
            v = queue.popleft()
            queue.extend(edges[v].values())
            if ends[v]:
                fail[v], popped[v] = 0, 1
            else:
                u, c = parent[v], letter[v]
                count, z = popped[u], fail[u]
                while z >= 0 and c not in edges[z]:
                    count += popped[z]
                    z = fail[z]
                fail[v], popped[v] = edges[z][c], count  # every letter is a piece, so the root has an edge
            rest[v] = popped[v] + rest[fail[v]]
        self.edges, self.fail, self.popped, self.rest = edges, fail, popped, rest

    @staticmethod
    def _new(edges, ends, parent, letter, v, c) -> int:
        edges[v][c] = len(edges)
        edges.append({})
        ends.append(False)
        parent.append(v)
        letter.append(c)
        return len(edges) - 1

    def count(self, word: str) -> int:
        edges, fail, popped = self.edges, self.fail, self.popped
        v = total = 0
        for c in word:
            w = edges[v].get(c)
            while w is None and v:
                total += popped[v]
                v = fail[v]
                w = edges[v].get(c)
            if w is None:
                total += len(c.encode("utf-8", "surrogatepass"))
                v = 0
            else:
                v = w
        return total + self.rest[v]


class Lengths(dict):
    """Pieces per word (UTF-8 bytes); a miss asks the automaton."""

    def __init__(self, automaton: LongestMatch) -> None:
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = n = self.automaton.count(MARK + word.decode())
        return n


def token_counts(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: (id, n_words, n_tokens): greedy longest-match pieces of every word of the whole text.

    Words are the runs without tab to carriage return and blank; each is read after the mark of a first piece. NULL
    and empty texts have no words and no tokens. Rows are counted where they lie: no shuffle, one row out per row in,
    whatever repeats; an empty table gives none, and a text of any length is read whole. The vocabulary file is read by every task from a path that all machines have.
    """
    kind = dict(docs.dtypes)[id]

    def make():
        lengths = Lengths(LongestMatch(vocabulary(path)))

        def step(batch):
            for part in slices(batch):
                split = [t.split() for t in raw_texts(part)]
                yield {"doc_id": part.column("doc_id"), "n_words": [len(w) for w in split], "n_tokens": [sum(map(lengths.__getitem__, w)) for w in split]}

        return step

    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, f"doc_id {kind}, n_words long, n_tokens long", make).withColumnRenamed("doc_id", id)
