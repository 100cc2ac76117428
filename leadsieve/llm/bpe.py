"""Byte-pair encoding with word ends by backtracking, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary lists, for each place of a word, the tokens that start there. The encoder
takes the longest one whose pair with the token before is compatible, that is, the merges would keep both apart; if none
is left it takes back the token before. Each place is given up once at most, so a word costs linear time, and the result
is exactly what applying the merges in order gives. Compatibility of a pair is worked out once and kept in a table.
"""

from __future__ import annotations

import functools
import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from leadsieve.llm.pieces import Kept, chunks, latin, per_text

#: Tokens decoded at once; bounds a task's memory for very long texts.
DECODE_TOKENS = 200_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, and its byte: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """Tables of a vocabulary: what each token is made of, and when."""

    def __init__(self, vocabulary: dict[str, int], merges: list, end: str):
        import ahocorasick
        letters = byte_letters()

        def symbols(token: str) -> str:
            """Bytes as characters; the one that ends a word is 256 higher."""
            body = token[:-len(end)] if end and token.endswith(end) else token
            plain = "".join(chr(letters[c]) for c in body)
            return plain if body is token else plain[:-1] + chr(256 + ord(plain[-1]))

        count = max(vocabulary.values()) + 1
        self.length = [0] * count
        self.born = [-1] * count
        self.halves: list = [None] * count
        self.merged: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right = vocabulary[a], vocabulary[b]
            token = vocabulary[a + b]
            self.merged[left, right] = rank
            self.born[token], self.halves[token] = rank, (left, right)
        self.automaton = ahocorasick.Automaton()
        for text, token in vocabulary.items():
            self.length[token] = len(symbols(text))
        #: Whether the merges keep two tokens side by side apart, by left << 20 | right.
        self.apart = Kept(lambda pair: self._undone(pair >> 20, pair & 0xFFFFF, len(self.merged)), 500_000)
        for text, token in vocabulary.items():
            if self.reachable(token):
                self.automaton.add_word(symbols(text), token)
        self.automaton.make_automaton()

    def reachable(self, token: int) -> bool:
        """Whether merging the token's own symbols gives the token: its last merge joins halves that stay apart until then."""
        halves = self.halves[token]
        return halves is None or (self.reachable(halves[0]) and self.reachable(halves[1])
                                  and self._undone(*halves, self.born[token]))

    def _undone(self, left: int, right: int, before: int) -> bool:
        """Take back the later of the merges on both sides of the seam, until no merge before `before` can cross it.

        At the seam stand the last part of left and the first part of right as they are at some time. A merge of the two
        wins if it comes earlier than the merge that next changes one of them. Of equal merges the left one comes first.
        """
        while True:
            crossing = self.merged.get((left, right))
            if crossing is not None and crossing < before:
                return False
            a, b = self.born[left], self.born[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                # Up to merge a the left part was its halves; merge a itself takes these before a pair across the seam.
                before, left = a, self.halves[left][1]
            else:
                # Up to merge b the right part was its halves; a pair across the seam lies further left, so it would be
                # taken first by merge b itself.
                before, right = b + 1, self.halves[right][0]

    def encode(self, word: str) -> list[int]:
        """Token IDs of one word, given as symbols."""
        starts: list[list[int]] = [[] for _ in word]
        length, apart, size = self.length, self.apart, len(word)
        for end, token in self.automaton.iter(word):
            starts[end - length[token] + 1].append(token)
        lost = bytearray(size + 1)
        out: list[int] = []
        left = [len(starts[0])]  # at each place of the path, how many tokens are still to try, the longest last
        at = 0
        while at < size:
            here, k = starts[at], left[-1] - 1
            while k >= 0 and (lost[at + length[here[k]]] or out and not apart[out[-1] << 20 | here[k]]):
                k -= 1
            if k >= 0:
                left[-1] = k
                out.append(here[k])
                at += length[here[k]]
                if at < size:
                    left.append(len(starts[at]))
            elif out:
                lost[at] = 1
                left.pop()
                at -= length[out.pop()]
            else:
                raise ValueError("the vocabulary lacks a byte")
        return out


class Coder:
    """Encoder and decoder of a tokenizer file of this kind: NFC, lower case, words by a pattern, byte-level BPE."""

    def __init__(self, config: str):
        made = json.loads(config)
        model, split = made["model"], made["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in made["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or made["decoder"] is not None:
            raise ValueError("this coder reads byte-level BPE files with NFC, lower case and no decoder")
        end = model["end_of_word_suffix"] or ""
        self.merges = Merges(model["vocab"], model["merges"], end)
        self.library, self.letters = Tokenizer.from_str(config), byte_letters()
        self.special = {t["content"]: t["id"] for t in made["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words = regex.compile(split["pattern"]["Regex"])
        names = {i: t for t, i in (model["vocab"] | self.special).items()}
        count = max(names) + 1
        self.type, self.code = (np.dtype("<u2"), "H") if count <= 1 << 16 else (np.dtype("<u4"), "I")
        shown = [(names.get(i, "") + " ").encode() for i in range(count)]
        self.sizes = np.array([len(s) for s in shown], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        self.shown = np.frombuffer(b"".join(shown), dtype=np.uint8)
        self.of_chunk = Kept(self._chunk)

    def _symbols(self, raw: str) -> bytes:
        """IDs of a word whose bytes are given as characters."""
        return array(self.code, self.merges.encode(raw[:-1] + chr(256 + ord(raw[-1])))).tobytes()

    def _word(self, word: str) -> bytes:
        return self._symbols(word.encode("utf-8").decode("latin-1"))

    def _plain(self, chunk: str) -> bytes:
        if latin(chunk):
            return b"".join([self._word(w) for w in self.words.findall(chunk.lower())])
        parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
        return b"".join([self._symbols("".join(chr(self.letters[c]) for c in part)) for part, _ in parts])

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha() and latin(chunk):
            return self._word(chunk.lower())
        if "<|" not in chunk:
            return self._plain(chunk)
        return b"".join(np.array([self.special[p]], dtype=self.type).tobytes() if p in self.special else self._plain(p)
                        for p in self.specials.split(chunk))

    def encode(self, text: str) -> np.ndarray:
        """IDs of a text. Only where all is Latin-1, words are sure to be the same in every version of Unicode; for the
        rest, the tokenizer's own normaliser and word pattern are asked."""
        plain = "<|" not in text and latin(text)
        pieces = chunks(text.lower() if plain else text, lone_marks=plain)
        return np.frombuffer(b"".join(map(self.of_chunk.__getitem__, pieces)), dtype=self.type)

    def decoded(self, ids: np.ndarray) -> Iterator[bytes]:
        """The decoded text as UTF-8 in parts: tokens joined by blanks, their bytes gathered through the offset table."""
        for at in range(0, len(ids), DECODE_TOKENS):
            part = ids[at:at + DECODE_TOKENS].astype(np.int64)
            sizes = self.sizes[part]
            ends = np.cumsum(sizes)
            places = np.arange(ends[-1]) + np.repeat(self.offsets[part] - (ends - sizes), sizes)
            last = at + DECODE_TOKENS >= len(ids)
            yield self.shown[places[:-1] if last else places].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self.decoded(ids)).decode("utf-8")


@functools.lru_cache(maxsize=2)
def coder(config: str) -> Coder:
    """One coder for each tokenizer file in a worker."""
    return Coder(config)


def read_config(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


ENCODED = "ids array<int>, decoded string"
DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids and the text decoded from them, for each document.

    IDs are those of the tokenizers library for the file at path, without added special tokens; special tokens written in
    a text are taken as such. Null and empty texts give no IDs and an empty decoded text. Any length, ties, repeated
    rows and null ids pass through; columns besides the two are ignored. An empty table gives no rows.
    """
    config = docs.sparkSession.sparkContext.broadcast(read_config(path))  # one tokenizer file
    return per_text(docs, doc_id, text, ENCODED, lambda: coder(config.value), _both)


def _both(tool: Coder, text: str) -> tuple[list[int], str]:
    ids = tool.encode(text)
    return ids.astype(np.int32).tolist(), tool.decode(ids)


def _digest(tool: Coder, text: str) -> tuple[int, str, str]:
    ids = tool.encode(text)
    shown = hashlib.sha256()
    for part in tool.decoded(ids):
        shown.update(part)
    return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), shown.hexdigest()


def encode_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As encode_documents, with SHA-256 of IDs (as 32-bit integers) and of the decoded text in place of both."""
    config = docs.sparkSession.sparkContext.broadcast(read_config(path))
    return per_text(docs, doc_id, text, DIGEST, lambda: coder(config.value), _digest)
