"""All queries of this subpackage."""

from tallymark.llm import q_dedup, q_filters, q_search, q_tokens  # noqa: F401
from tallymark.llm.registry import ORACLES, QUERIES  # noqa: F401
