from .gold import CdcFlow, flow_log, merge_batch, read_target, run_flow
from .silver import SilverSpec, read_silver, reset_silver, run_silver, silver_stream, table_stream

__all__ = ["CdcFlow", "SilverSpec", "flow_log", "merge_batch", "read_silver", "read_target",
           "reset_silver", "run_flow", "run_silver", "silver_stream", "table_stream"]
