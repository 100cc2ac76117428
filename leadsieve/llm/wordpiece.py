"""Token counts of greedy longest-match word pieces, in time linear in the text and without building pieces.

The vocabulary is a trie with two roots, for pieces that begin a word and pieces that go on. Each node has a failure link
and the number of pieces that following it takes off the front: those the greedy match is sure of once the next character
doesn't fit. A word is read once from left to right; the sum of these numbers is its token count.
"""

from __future__ import annotations

import functools
from collections import deque

import regex
from pyspark.sql import DataFrame

from leadsieve.llm.pieces import Kept, chunks, latin, per_text

#: Words are runs without white space and marks; each mark is a word (punctuation, and the ASCII signs besides).
WORDS = regex.compile(r"[^\s\p{P}$+<=>^`|~]+|[\p{P}$+<=>^`|~]")
BEGIN, GO_ON = 0, 1
#: A character beyond Unicode, so that node and character make one key.
WIDE = 0x110000


def word_pieces(path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin a word and pieces that go on, from a sentencepiece file whose word-initial pieces have a mark."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [p[1:] for p in usable if p[0] == "▁" and len(p) > 1], [p for p in usable if "▁" not in p]


class Matcher:
    def __init__(self, begin: list[str], go_on: list[str]):
        self.step: dict[int, int] = {}
        ends = [False, False]
        below: list[list[tuple[int, int]]] = [[], []]
        for root, pieces in ((BEGIN, begin), (GO_ON, go_on)):
            for piece in pieces:
                node = root
                for c in piece:
                    key = node * WIDE + ord(c)
                    if key not in self.step:
                        self.step[key] = len(ends)
                        below[node].append((ord(c), len(ends)))
                        ends.append(False)
                        below.append([])
                    node = self.step[key]
                ends[node] = True
        self.link: list[int | None] = [None] * len(ends)
        self.popped = [0] * len(ends)
        queue = deque([BEGIN, GO_ON])
        while queue:
            parent = queue.popleft()
            for c, node in below[parent]:
                queue.append(node)
                if ends[node]:
                    self.link[node], self.popped[node] = GO_ON, 1
                    continue
                at, count = self.link[parent], self.popped[parent]
                while at is not None and at * WIDE + c not in self.step:
                    count += self.popped[at]
                    at = self.link[at]
                if at is not None:
                    self.link[node], self.popped[node] = self.step[at * WIDE + c], count

    def count(self, word: str) -> int:
        """Pieces of a word; one (the unknown token) if it can't be cut into pieces greedily."""
        at, total, step, link, popped = BEGIN, 0, self.step, self.link, self.popped
        for c in map(ord, word):
            while (to := step.get(at * WIDE + c)) is None:
                total += popped[at]
                at = link[at]
                if at is None:
                    return 1
            at = to
        while at > GO_ON:
            total += popped[at]
            at = link[at]
            if at is None:
                return 1
        return total


class Counter:
    def __init__(self, begin: tuple[str, ...], go_on: tuple[str, ...]):
        self.matcher = Matcher(begin, go_on)
        self.of_chunk = Kept(self._chunk)

    def _chunk(self, chunk: str) -> tuple[int, int]:
        words = [chunk] if chunk.isalpha() else WORDS.findall(chunk)
        return len(words), sum(map(self.matcher.count, words))

    def count(self, text: str) -> tuple[int, int]:
        found = list(map(self.of_chunk.__getitem__, chunks(text, lone_marks=latin(text))))
        return sum([f[0] for f in found]), sum([f[1] for f in found])


@functools.lru_cache(maxsize=2)
def counter(begin: tuple[str, ...], go_on: tuple[str, ...]) -> Counter:
    return Counter(begin, go_on)


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_pieces for each document, counted over the whole text.

    Null and empty texts, and texts of white space only, count 0 and 0. A word with a character that no piece has, or
    that the greedy match can't finish, is one piece, however long. Repeated rows and null ids stay rows of their own;
    columns besides the two are ignored. An empty table gives no rows.
    """
    begin, go_on = word_pieces(path)
    sent = docs.sparkSession.sparkContext.broadcast((tuple(begin), tuple(go_on)))  # one vocabulary
    return per_text(docs, doc_id, text, "n_words long, n_pieces long", lambda: counter(*sent.value),
                    lambda tool, t: tool.count(t))
