"""Registered queries: token files, token counts, byte-pair encoding."""

import public_tokenizers

from leadsieve.llm import bpe, token_files, wordpiece
from leadsieve.llm.common import shared_folder
from leadsieve.llm.registry import query, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_token_files(spark, sf):
    folder = shared_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf, "documents"), folder, WORD_BPE, end_id=2)
    return token_files.read_token_files(spark, folder)


@query
def op3_token_counts(spark, sf):
    return wordpiece.count_tokens(table(spark, sf, "documents"), PIECES)


@query
def op9_bpe(spark, sf):
    return bpe.encode_digests(table(spark, sf, "documents"), WORD_BPE)
