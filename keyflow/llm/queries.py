"""Registered queries of this subpackage: one per operator, and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from keyflow.llm.divergence import op13_divergence_audit
from keyflow.llm.imi import op7_imi_search
from keyflow.llm.licenses import op1_license_scan
from keyflow.llm.mixing import op9_mixing
from keyflow.llm.oracle import ORACLE_SQL
from keyflow.llm.periods import op12_periodic_runs
from keyflow.llm.pieces import op2_sentencepiece
from keyflow.llm.quality import op4_quality_rules
from keyflow.llm.radix import op11_radix_dedup
from keyflow.llm.rans import op6_rans_tokens
from keyflow.llm.secrets import op10_secret_scan
from keyflow.llm.simhash import op3_simhash_neardup
from keyflow.llm.urlfilter import op8_url_filter
from keyflow.llm.warc import op5_warc_bundles

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_simhash_neardup": op3_simhash_neardup,
    "op4_quality_rules": op4_quality_rules,
    "op5_warc_bundles": op5_warc_bundles,
    "op6_rans_tokens": op6_rans_tokens,
    "op7_imi_search": op7_imi_search,
    "op8_url_filter": op8_url_filter,
    "op9_mixing": op9_mixing,
    "op10_secret_scan": op10_secret_scan,
    "op11_radix_dedup": op11_radix_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_divergence_audit": op13_divergence_audit,
    "pipeline": corpus_pipeline.run,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
