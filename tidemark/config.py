"""Declarative configuration objects (ingest list, namespaces, join lists)."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence


@dataclass(frozen=True)
class SourceTable:
    """One entry of the ingest list: which table, which change column.

    ``from_date`` is the backfill override; the empty string counts as
    "not given" so the stored watermark is used.
    ``keys`` is informational for extraction and drives the gold flows.
    """

    table: str
    cdc_col: str
    schema: str = "dbo"
    from_date: str = ""
    keys: tuple[str, ...] = ()
    #: how far below the stored mark rows may still arrive ("30 days"; a plain
    #: number for a numeric change column); "" = rows below the mark are not read
    lookback: str = ""

    @property
    def qualified(self) -> str:
        return f"{self.schema}.{self.table}" if self.schema else self.table


@dataclass(frozen=True)
class Namespace:
    """Catalog / schema pair so one code base serves dev and prod."""

    catalog: str | None = None
    schema: str | None = None

    def qualify(self, name: str) -> str:
        parts = [p for p in (self.catalog, self.schema) if p]
        return ".".join(parts + [name])


@dataclass(frozen=True)
class JoinSpec:
    """One entry of a star-join list.

    The first entry is the FROM table and has no ``condition``; every later
    entry is LEFT OUTER joined on its boolean ``condition`` (SQL text over
    the aliases). ``cols`` are alias-qualified names, kept in this order.
    """

    table: str
    alias: str
    cols: Sequence[str]
    condition: str | None = None
    #: the table's size is bounded whatever the facts' size (a calendar, a band
    #: table): it may be sent to every task, and its condition needs no equality
    bounded: bool = False
    #: ... and has at most so many rows (counted before it is sent); beyond that it
    #: is joined like any other table, which needs an equality
    max_rows: int = 1_000_000


@dataclass
class JdbcOptions:
    """Options for reading a relational source in parallel.

    ``partition_column`` (an integer or date column, usually the key) with
    ``num_partitions`` splits the read into range queries so the extract is not a
    single reader: equal widths between given bounds, or, without bounds, equal
    numbers of rows by cut points that the database measures.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    lower_bound: int | None = None
    upper_bound: int | None = None
    num_partitions: int | None = None
    fetch_size: int = 10000
    query_timeout_s: int = 7200
    #: fraction digits that the change column keeps and accepts in a text literal
    #: (3 for DATETIME, 6 or 7 for DATETIME2); marks are cut to it, downwards
    fraction_digits: int = 3
