"""Command line: run months of the validated KPI pipeline. Exit 0 if all were published, 1 if not, 2 on bad arguments."""

from __future__ import annotations

import argparse
import logging
import sys
from pathlib import Path

from plumbline.plans import month as plan
from plumbline.session import build
from plumbline.settings import Month, load


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--month", action="append", required=True, metavar="YYYY-MM", help="may be repeated")
    how = p.add_mutually_exclusive_group()
    how.add_argument("--offline", action="store_true", help="use preserved inputs only")
    how.add_argument("--refresh", action="store_true", help="ask sources for new versions")
    p.add_argument("--allow-unreconciled", action="store_true", help="publish despite a control mismatch")
    p.add_argument("--config", type=Path, help="settings file")
    args = p.parse_args(argv)
    try:
        months = sorted({Month.parse(m) for m in args.month})
    except ValueError as e:
        p.error(str(e))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    done = plan.run(build(), months, load(args.config), offline=args.offline, refresh=args.refresh, allow_unreconciled=args.allow_unreconciled)
    return 0 if done["status"] == "OK" else 1


if __name__ == "__main__":
    sys.exit(main())
