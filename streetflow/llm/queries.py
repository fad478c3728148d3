"""All queries of this folder; importing it registers them."""

from streetflow.llm import (archives, chat, hard_negatives, jaccard_join, latent_leaks, license_scan, line_dedup, mixing, ngram_quality, piece_counts,  # noqa: F401
                            span_dedup, url_rules, word_runs)
from streetflow.llm.tables import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
