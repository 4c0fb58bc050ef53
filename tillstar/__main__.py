"""Full refresh from the command line: ``spark-submit`` or ``python -m tillstar``."""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import date

from tillstar import fixed_values as fixed
from tillstar.config import WarehouseConfig
from tillstar.plans.pipeline import run_landed
from tillstar.session import build_session


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tillstar", description=__doc__)
    parser.add_argument("landing", help="folder with sales/<sheet>/*.csv and masters/<list>/*.csv")
    parser.add_argument("root", help="folder of the warehouse, shared by all executors")
    day = date.fromisoformat
    parser.add_argument("--spine-start", type=day, default=day(fixed.SPINE_START))
    parser.add_argument("--spine-end", type=day, default=day(fixed.SPINE_END))
    parser.add_argument("--constraints", choices=("fail", "quarantine", "report"), default="fail")
    parser.add_argument("--gate", choices=("warn", "fail"), default="warn")
    options = parser.parse_args(arguments)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    config = WarehouseConfig(
        spine_start=options.spine_start,
        spine_end=options.spine_end,
        constraint_policy=options.constraints,
        gate_policy=options.gate,
    )
    try:
        result = run_landed(build_session(), options.landing, options.root, config)
    except Exception:
        logging.exception("run failed, nothing was published")
        return 1
    for name, rows in result.metrics.summary().items():
        logging.info("%s: %s rows", name, f"{rows:,}")
    for check, rows in result.orphans.items():
        logging.info("%s: %s orphans", check, f"{rows:,}")
    logging.info("published run %s", result.run.run_id)
    return 0


if __name__ == "__main__":
    sys.exit(main())
