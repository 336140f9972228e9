"""The operators' registered queries, and DuckDB SQL for those that SQL can express."""

from ledgerline.llm.divergence import OP11_SQL, op11_source_divergence
from ledgerline.llm.embed_dedup import OP8_SQL, op8_embedding_near_dedup
from ledgerline.llm.exact_dedup import OP2_SQL, op2_exact_dedup
from ledgerline.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from ledgerline.llm.hmm import op4_hmm_scoring
from ledgerline.llm.jaccard import OP5_SQL, op5_ngram_jaccard
from ledgerline.llm.language_id import op12_language_id
from ledgerline.llm.mixing import OP6_SQL, op6_mixing
from ledgerline.llm.packing import op3_best_fit_packing
from ledgerline.llm.pii import op7_pii_pseudonyms
from ledgerline.llm.substring import OP9_SQL, op9_substring_dedup
from ledgerline.llm.toxicity import op10_toxicity
from ledgerline.llm.warc import OP1_SQL, op1_warc

QUERIES = {
    "op1_warc": op1_warc,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_hmm_scoring": op4_hmm_scoring,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_mixing": op6_mixing,
    "op7_pii_pseudonyms": op7_pii_pseudonyms,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_source_divergence": op11_source_divergence,
    "op12_language_id": op12_language_id,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL = {
    "op1_warc": OP1_SQL,
    "op2_exact_dedup": OP2_SQL,
    "op5_ngram_jaccard": OP5_SQL,
    "op6_mixing": OP6_SQL,
    "op8_embedding_near_dedup": OP8_SQL,
    "op9_substring_dedup": OP9_SQL,
    "op11_source_divergence": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
}
