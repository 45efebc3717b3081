from .bronze import append_bronze
from .tables import create_table, drop_table, preview, reset_table, use_namespace

__all__ = ["append_bronze", "create_table", "drop_table", "preview", "reset_table", "use_namespace"]
