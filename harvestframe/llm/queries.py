"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from .decontam import ORACLE_OP5, op5_benchmark_decontamination
from .divergence import ORACLE_OP13, op13_source_divergence
from .exactdedup import ORACLE_OP11, op11_exact_dedup
from .linededup import ORACLE_OP10, op10_line_dedup
from .mixing import op2_mix_sources
from .pseudonyms import op6_pii_pseudonyms
from .quality import ORACLE_OP8, op8_quality_rules
from .secretscan import op9_secret_scan
from .sharding import op1_shard_hilbert
from .simhash import op3_simhash_near_dedup
from .simplexcluster import ORACLE_OP12, op12_centroid_clustering
from .tokens import op4_token_orc
from .urltree import ORACLE_OP7, op7_url_filter

QUERIES = {
    "op1_shard_hilbert": op1_shard_hilbert,
    "op2_mix_sources": op2_mix_sources,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_token_orc": op4_token_orc,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_pii_pseudonyms": op6_pii_pseudonyms,
    "op7_url_filter": op7_url_filter,
    "op8_quality_rules": op8_quality_rules,
    "op9_secret_scan": op9_secret_scan,
    "op10_line_dedup": op10_line_dedup,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_source_divergence": op13_source_divergence,
}
ORACLE: dict[str, str] = {
    "op5_benchmark_decontamination": ORACLE_OP5,
    "op7_url_filter": ORACLE_OP7,
    "op8_quality_rules": ORACLE_OP8,
    "op10_line_dedup": ORACLE_OP10,
    "op11_exact_dedup": ORACLE_OP11,
    "op12_centroid_clustering": ORACLE_OP12,
    "op13_source_divergence": ORACLE_OP13,
}
