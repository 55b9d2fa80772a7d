"""All queries of this subpackage, by name."""

from wireglean.llm import best_positions, collocations, fm_index, grid_order_join, grouping_genetics, jaccard_join, language, personal_data, piece_bpe, reply_trees, suffix_dedup, toxicity, warc  # noqa: F401
from wireglean.llm.common import ORACLES, QUERIES  # noqa: F401
