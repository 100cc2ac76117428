"""All registered queries of this subpackage."""

from leadsieve.llm import queries_chat, queries_dedup, queries_scores, queries_tokens, queries_vectors  # noqa: F401
from leadsieve.llm.registry import ORACLES, QUERIES  # noqa: F401
