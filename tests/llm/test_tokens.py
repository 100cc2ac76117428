import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import ROWS, documents, empty
from tokenizers import Tokenizer
from tokenizers.models import WordPiece
from tokenizers.pre_tokenizers import BertPreTokenizer

from leadsieve.llm import bpe, token_files, wordpiece
from leadsieve.llm.common import shared_folder

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = list("aeiIT'sSldmtve !?.,\t\n\r\x0b\x1c\x85\xa0é́ÉßİΣς0123½²ǅﬁ한글漢字😀‍_-") + ["<|endoftext|>", "'ll", "tion"]


def random_texts(count, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 30))) for _ in range(count)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def test_encoder_agrees_with_the_library(library):
    own = bpe.Coder(bpe.read_config(WORDS))
    for text in random_texts(3000, 1) + [t or "" for _, t, _ in ROWS]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids
        assert own.decode(np.array(ids, dtype="<u2")) == library.decode(ids, skip_special_tokens=False)


def test_backtracking_on_runs_of_one_letter(library):
    own = bpe.Coder(bpe.read_config(WORDS))
    for letter in "aeshot":
        for size in range(1, 40):
            assert own.encode(letter * size).tolist() == library.encode(letter * size, add_special_tokens=False).ids


def test_encoded_documents(spark, library):
    got = bpe.encode_documents(documents(spark), WORDS).collect()
    want = [library.encode(t or "", add_special_tokens=False).ids for _, t, _ in ROWS]
    assert sorted(map(str, (r.ids for r in got))) == sorted(map(str, want))
    assert bpe.encode_digests(empty(spark), WORDS).count() == 0


@pytest.mark.parametrize("path, end", [(WORDS, 2), (BYTES, None)])
def test_files_round_trip(spark, path, end):
    folder = shared_folder(spark, "test-files")
    token_files.write_token_files(documents(spark), folder, path, end_id=end)
    got = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    tool, start, left = Tokenizer.from_file(path), 0, []
    for i, t, _ in ROWS:
        ids = tool.encode(t or "", add_special_tokens=False).ids + ([] if end is None else [end])
        left.append((i, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    assert sorted(left, key=str) == sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str)
    for r in got:
        assert r.start == start or r.n_tokens == 0
        start = max(start, r.start + r.n_tokens)
    ids = [r.doc_id for r in got if r.n_tokens]
    assert [i for i in ids if i is not None] == sorted(i for i in ids if i is not None)


def test_files_of_an_empty_table(spark):
    folder = shared_folder(spark, "test-empty")
    assert token_files.write_token_files(empty(spark), folder, WORDS).count() == 0
    assert token_files.read_token_files(spark, folder).count() == 0


def test_word_piece_counts_agree_with_the_library(spark):
    begin, go_on = wordpiece.word_pieces(PIECES)
    names = {p: k for k, p in enumerate(dict.fromkeys(["[UNK]", *begin, *["##" + p for p in go_on]]))}
    library = Tokenizer(WordPiece(names, unk_token="[UNK]", max_input_chars_per_word=10 ** 7))
    library.pre_tokenizer = BertPreTokenizer()
    own = wordpiece.Counter(tuple(begin), tuple(go_on))
    for text in random_texts(2000, 2):
        text = text.replace("\x1c", "")
        assert own.count(text)[1] == len(library.encode(text).ids), repr(text)
    got = {r.doc_id: r for r in wordpiece.count_tokens(documents(spark), PIECES).collect()}
    assert (got[2].n_words, got[2].n_pieces, got[4].n_pieces) == (0, 0, 0)
    assert wordpiece.count_tokens(empty(spark), PIECES).count() == 0


def test_popped_counts_are_those_of_greedy_matching():
    begin, go_on = ("a", "abcdx", "ab"), ("b", "c", "cdy", "dz", "bc")
    own = wordpiece.Matcher(begin, go_on)

    def greedy(word):
        count, at = 0, 0
        while at < len(word):
            pieces = go_on if at else begin
            size = max((len(p) for p in pieces if word.startswith(p, at)), default=0)
            if not size:
                return 1
            count, at = count + 1, at + size
        return count

    draw = random.Random(3)
    for _ in range(2000):
        word = "a" + "".join(draw.choice("abcdxyz") for _ in range(draw.randint(0, 9)))
        assert own.count(word) == greedy(word), word
