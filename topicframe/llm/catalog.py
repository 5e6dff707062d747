"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from topicframe.llm.alignment import op13_cross_tokenizer_alignment
from topicframe.llm.chat import OP1_SQL, op1_chat_perspectives
from topicframe.llm.common import bounded_batches
from topicframe.llm.decontaminate import op2_cgk_decontamination
from topicframe.llm.ngram_join import op4_ngram_jaccard
from topicframe.llm.packing import op7_best_fit_packing
from topicframe.llm.perplexity import op8_ngram_perplexity
from topicframe.llm.pii import op12_personal_data
from topicframe.llm.secrets import op3_secret_scan
from topicframe.llm.shards import op5_histogram_shards
from topicframe.llm.suffix_tree import op10_suffix_tree_lm
from topicframe.llm.toxicity import op6_toxicity
from topicframe.llm.trie import op11_prefix_trie
from topicframe.llm.url_filter import OP9_SQL, op9_url_filter

BUILDERS = {
    "op1_chat_perspectives": op1_chat_perspectives,
    "op2_cgk_decontamination": op2_cgk_decontamination,
    "op3_secret_scan": op3_secret_scan,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_histogram_shards": op5_histogram_shards,
    "op6_toxicity": op6_toxicity,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_ngram_perplexity": op8_ngram_perplexity,
    "op9_url_filter": op9_url_filter,
    "op10_suffix_tree_lm": op10_suffix_tree_lm,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_personal_data": op12_personal_data,
    "op13_cross_tokenizer_alignment": op13_cross_tokenizer_alignment,
}

BUILDERS = {name: bounded_batches(query) for name, query in BUILDERS.items()}

ORACLES = {
    "op1_chat_perspectives": OP1_SQL,
    "op9_url_filter": OP9_SQL,
}
