"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .align import op11_interval_alignment
from .ann import op3_cross_polytope
from .bpe import op13_rank_queue_bpe
from .lines import op7_line_runs
from .manifest import OP12_SQL, op12_octopus_manifest
from .mixing import OP8_SQL, op8_pfair_mix
from .neardup import op9_lsh_forest
from .packing import op4_bin_completion
from .pii import op10_disclosure
from .quality import op1_kneser_ney
from .rules import op6_covariance_outliers
from .secrets import op2_secret_scan
from .sharding import op5_virtual_slots

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kneser_ney": op1_kneser_ney,
    "op2_secret_scan": op2_secret_scan,
    "op3_cross_polytope": op3_cross_polytope,
    "op4_bin_completion": op4_bin_completion,
    "op5_virtual_slots": op5_virtual_slots,
    "op6_covariance_outliers": op6_covariance_outliers,
    "op7_line_runs": op7_line_runs,
    "op8_pfair_mix": op8_pfair_mix,
    "op9_lsh_forest": op9_lsh_forest,
    "op10_disclosure": op10_disclosure,
    "op11_interval_alignment": op11_interval_alignment,
    "op12_octopus_manifest": op12_octopus_manifest,
    "op13_rank_queue_bpe": op13_rank_queue_bpe,
}

SQL: dict[str, str] = {
    "op8_pfair_mix": OP8_SQL,
    "op12_octopus_manifest": OP12_SQL,
}
