"""Queries of the corpus operators, and SQL where SQL can express them."""

from cadenza.llm.chat import OP2_SQL, op2_chat_format
from cadenza.llm.ctw import op4_lm_scoring
from cadenza.llm.langid import op3_language_id
from cadenza.llm.media import op7_media
from cadenza.llm.mixing import op8_mixing
from cadenza.llm.ngram_join import OP1_SQL, op1_ngram_jaccard_join
from cadenza.llm.rans import op6_token_files
from cadenza.llm.secrets import OP9_SQL, op9_secret_scan
from cadenza.llm.sentencepieces import op10_sentencepiece
from cadenza.llm.simhash import op5_simhash

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_chat_format": op2_chat_format,
    "op3_language_id": op3_language_id,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_simhash": op5_simhash,
    "op6_token_files": op6_token_files,
    "op7_media": op7_media,
    "op8_mixing": op8_mixing,
    "op9_secret_scan": op9_secret_scan,
    "op10_sentencepiece": op10_sentencepiece,
}

ORACLES = {"op1_ngram_jaccard_join": OP1_SQL, "op2_chat_format": OP2_SQL, "op9_secret_scan": OP9_SQL}
