"""tidemark: incremental lakehouse pipelines on PySpark.

Watermark-driven extraction into bronze, run-once checkpointed file streams
into silver, keyed SCD type 1 / type 2 gold targets, drop-on-violation data
quality rules and config-driven star joins -- all as DataFrame / SQL /
Structured Streaming jobs.
"""

from .config import JdbcOptions, JoinSpec, Namespace, SourceTable
from .paths import Layout
from .session import build_session, scratch, work_root

__all__ = ["JdbcOptions", "JoinSpec", "Layout", "Namespace", "SourceTable",
           "build_session", "scratch", "work_root"]
