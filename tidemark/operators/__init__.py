from .cdc import (END, START, closed_versions, current_versions, lineage, resolve_ties,
                  scd1_latest, scd2_versions)
from .quality import duplicate_keys, expect_all_or_drop, expectation_metrics, observe_rules
from .star import star_join

__all__ = ["END", "START", "closed_versions", "current_versions", "duplicate_keys",
           "expect_all_or_drop", "expectation_metrics", "lineage", "observe_rules",
           "resolve_ties", "scd1_latest", "scd2_versions", "star_join"]
