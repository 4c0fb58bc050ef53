"""Quality gate on audit findings and orphans."""

from __future__ import annotations

import logging
from collections.abc import Mapping

log = logging.getLogger("tillstar")


class QualityGateError(RuntimeError):
    """Findings exceed what the gate lets through."""


def quality_gate(name: str, findings: Mapping[str, int], policy: str) -> bool:
    """True when nothing was found; otherwise warn and go on, or stop the run."""
    found = {k: v for k, v in findings.items() if v}
    if not found:
        return True
    if policy == "fail":
        raise QualityGateError(f"{name}: {found}")
    log.warning("%s: %s", name, found)
    return False
