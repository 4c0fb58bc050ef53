"""Parameters of a warehouse run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from tillstar import fixed_values as fixed


@dataclass(frozen=True)
class WarehouseConfig:
    """What a run may vary; the defaults are the business rules.

    ``constraint_policy`` governs violations for which the source system aborts
    its load (bad region, price not positive, repeated primary key): ``fail``
    stops the run before anything is published, ``quarantine`` moves the rows
    out, ``report`` keeps them and only counts them.
    ``gate_policy`` governs audit findings and orphans: ``warn`` or ``fail``.
    ``account_rows`` traces every sales line to one outcome and stops the run when
    lines are missing; it costs one more pass over the staged sales.
    """

    spine_start: date = date.fromisoformat(fixed.SPINE_START)
    spine_end: date = date.fromisoformat(fixed.SPINE_END)
    receipt_repeat_limit: int = fixed.RECEIPT_REPEAT_LIMIT
    constraint_policy: str = "fail"
    gate_policy: str = "warn"
    partition_fact_by_month: bool = True
    account_rows: bool = True

    def __post_init__(self) -> None:
        if self.spine_end < self.spine_start:
            raise ValueError("spine_end lies before spine_start")
        if self.constraint_policy not in ("fail", "quarantine", "report"):
            raise ValueError(f"unknown constraint policy {self.constraint_policy!r}")
        if self.gate_policy not in ("warn", "fail"):
            raise ValueError(f"unknown gate policy {self.gate_policy!r}")
