"""The operators' queries, and SQL for those that SQL can express."""

from __future__ import annotations

from tallyhouse.llm.bytepairs import op11_bytepairs
from tallyhouse.llm.dialogues import op12_dialogues
from tallyhouse.llm.fingerprints import op10_fingerprints
from tallyhouse.llm.jaccard import op7_ngram_join
from tallyhouse.llm.lines import OP8_SQL, op8_line_dedup
from tallyhouse.llm.neighbours import op3_nearest
from tallyhouse.llm.packing import op6_packing
from tallyhouse.llm.pieces import op2_sentencepiece
from tallyhouse.llm.runs import op13_periodic_runs
from tallyhouse.llm.secrets import op1_secret_scan
from tallyhouse.llm.shards import op5_shards
from tallyhouse.llm.tokens import op4_token_counts
from tallyhouse.llm.toxicity import op9_toxicity

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_nearest": op3_nearest,
    "op4_token_counts": op4_token_counts,
    "op5_shards": op5_shards,
    "op6_packing": op6_packing,
    "op7_ngram_join": op7_ngram_join,
    "op8_line_dedup": op8_line_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_fingerprints": op10_fingerprints,
    "op11_bytepairs": op11_bytepairs,
    "op12_dialogues": op12_dialogues,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op8_line_dedup": OP8_SQL,
}
