"""Folder layout of the medallion tree (parameterised dataset paths).

One ``Layout`` per pipeline root. Every table gets plain, predictable
folders so that a new table is a config row, not new code.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/")] + [p.strip("/") for p in parts])

    # bronze: one flat folder of parquet files per table (append only)
    def bronze(self, table: str) -> str:
        return self._p("bronze", table)

    # watermark log of a table, next to its bronze folder
    def watermark(self, table: str) -> str:
        return self._p("bronze", f"{table}_cdc")

    # values that did not convert on the way to bronze, and their rows
    def rejects(self, table: str) -> str:
        return self._p("bronze", f"{table}_rejects")

    def silver_data(self, table: str) -> str:
        return self._p("silver", table, "data")

    def silver_checkpoint(self, table: str) -> str:
        return self._p("silver", table, "checkpoint")

    def silver_schema(self, table: str) -> str:
        return self._p("silver", table, "schema.json")

    def gold(self, table: str) -> str:
        return self._p("gold", table)

    def gold_checkpoint(self, flow: str) -> str:
        return self._p("gold", "_checkpoints", flow)

    def reports(self) -> str:
        return self._p("reports", "ingest")
