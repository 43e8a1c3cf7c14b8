"""DataFrame -> DataFrame operators of the layered job."""

from strata.operators.contract import Contract, load_contract, parse_contract
from strata.operators.layers import (LayerResult, append_manifest, layer_path, read_layer,
                                     safe_run_id, write_layer)
from strata.operators.marts import (aggregate_by, build_gold, fits_broadcast, head_rows,
                                    lookup_left_join, sized_broadcast)
from strata.operators.quality import (freshness_report, gold_rules, quality_report,
                                      require_rows, run_freshness, schema_report)
from strata.operators.refine import filter_valid, refine, valid_rows

__all__ = [
    "Contract", "load_contract", "parse_contract", "append_manifest", "run_freshness",
    "LayerResult", "layer_path", "read_layer", "safe_run_id", "write_layer",
    "aggregate_by", "build_gold", "fits_broadcast", "head_rows", "lookup_left_join",
    "sized_broadcast", "freshness_report", "gold_rules", "quality_report", "require_rows",
    "schema_report", "filter_valid", "refine", "valid_rows",
]
