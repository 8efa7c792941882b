"""All queries of the subpackage."""

from sparkq.llm import q_align, q_lines, q_manifest, q_mixture, q_packing, q_pieces, q_quality, q_secrets, q_simhash, q_tokens, q_topk, q_toxicity, q_warc  # noqa: F401  (each module registers its query)
from sparkq.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
