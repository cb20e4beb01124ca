"""The registered queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from locusmill.llm.chat import OP4_SQL, op4_chat
from locusmill.llm.contamination import op3_decontamination
from locusmill.llm.language import op2_language
from locusmill.llm.lines import OP9_SQL, op9_line_dedup
from locusmill.llm.near import OP10_SQL, op10_near_duplicates
from locusmill.llm.negatives import OP12_SQL, op12_hard_negatives
from locusmill.llm.packing import op11_packing
from locusmill.llm.periodic import OP13_SQL, op13_periodic_runs
from locusmill.llm.pieces import op6_sentencepiece
from locusmill.llm.quality import op7_quality
from locusmill.llm.token_files import op1_token_counts
from locusmill.llm.toxicity import op5_toxicity
from locusmill.llm.warc import OP8_SQL, op8_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_language, op3_decontamination, op4_chat, op5_toxicity, op6_sentencepiece, op7_quality, op8_warc,
        op9_line_dedup, op10_near_duplicates, op11_packing, op12_hard_negatives, op13_periodic_runs,
    )
}
ORACLE = {
    "op4_chat": OP4_SQL, "op8_warc": OP8_SQL, "op9_line_dedup": OP9_SQL, "op10_near_duplicates": OP10_SQL,
    "op12_hard_negatives": OP12_SQL, "op13_periodic_runs": OP13_SQL,
}
