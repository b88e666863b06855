"""The operators' queries, and their SQL where SQL can express them."""

from strandline.llm.ann import OP1_SQL, op1_embedding_dedup
from strandline.llm.counts import op13_token_counts
from strandline.llm.decontam import OP4_SQL, op4_decontamination
from strandline.llm.jaccard import OP8_SQL, op8_ngram_jaccard
from strandline.llm.language import op7_language_id
from strandline.llm.lm import op10_lm_scores
from strandline.llm.negatives import OP11_SQL, op11_hard_negatives
from strandline.llm.pii import op9_pii
from strandline.llm.quality import op5_quality
from strandline.llm.secrets import op2_secret_scan
from strandline.llm.tokens import op3_token_files, op6_pack
from strandline.llm.trie import OP12_SQL, op12_prefix_trie

QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_token_files": op3_token_files,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_pack": op6_pack,
    "op7_language_id": op7_language_id,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_pii": op9_pii,
    "op10_lm_scores": op10_lm_scores,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_token_counts": op13_token_counts,
}
ORACLES: dict[str, str] = {"op1_embedding_dedup": OP1_SQL, "op4_decontamination": OP4_SQL, "op8_ngram_jaccard": OP8_SQL, "op11_hard_negatives": OP11_SQL, "op12_prefix_trie": OP12_SQL}
