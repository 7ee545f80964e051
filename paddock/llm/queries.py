"""All queries of this folder: importing the modules registers them."""

from paddock.llm import q_article, q_chat, q_cube, q_decontaminate, q_jaccard, q_langid, q_lbl, q_maxsketch, q_packing, q_pivots, q_secrets, q_trie, q_warc  # noqa: F401
from paddock.llm.registry import ORACLES, QUERIES  # noqa: F401
