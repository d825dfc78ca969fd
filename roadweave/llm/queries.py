"""The corpus operators' queries over the synthetic tables, and SQL for those that SQL can express."""

from __future__ import annotations

from roadweave.llm.bytebpe import op9_byte_bpe
from roadweave.llm.cotraining import op10_cotraining
from roadweave.llm.matroska import op6_matroska
from roadweave.llm.order_minhash import op1_order_minhash
from roadweave.llm.packing import op8_packing
from roadweave.llm.pii import op5_pii
from roadweave.llm.quality_rules import ORACLE as QUALITY_RULES_SQL
from roadweave.llm.quality_rules import op7_quality_rules
from roadweave.llm.secrets import op2_secrets
from roadweave.llm.toxicity import op3_toxicity
from roadweave.llm.wavelet import op4_wavelet_tokens

QUERIES = {
    f.__name__: f
    for f in (op1_order_minhash, op2_secrets, op3_toxicity, op4_wavelet_tokens, op5_pii, op6_matroska, op7_quality_rules, op8_packing, op9_byte_bpe, op10_cotraining)
}
ORACLES = {"op7_quality_rules": QUALITY_RULES_SQL}
