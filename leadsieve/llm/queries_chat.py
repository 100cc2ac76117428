"""Registered queries: chat formatting."""

import public_tokenizers

from leadsieve.llm import chat
from leadsieve.llm.registry import query, table

CONTROLS = "</s>[INST] ok [/INST]"


@query
def op2_chat_windows(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROLS), (-7, 1, "assistant", CONTROLS)], rows.schema)
    return chat.digests(chat.windows(rows.union(extra), public_tokenizers.path("word_bpe_49k.json")))
