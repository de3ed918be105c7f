"""Refusals. What can't be published stops with one exception that carries the check it failed.

The check alone tells what a caller does: which stage stopped, and whether the same run may pass later with nothing
changed here. Audits and evidence name the check.
"""

from __future__ import annotations

#: Stages by the letters of a check's id.
STAGES = {"SRC": "retrieval", "ZON": "reference", "FIL": "file", "REC": "reconciliation"}
#: Checks whose subject may change by itself: a server that is down, a file that isn't whole yet.
PASSING = frozenset({"SRC01", "FIL03"})


class Refused(Exception):
    """Nothing is published, and what was published before stands."""

    def __init__(self, check: str, message: str) -> None:
        super().__init__(message)
        self.check = check

    @property
    def stage(self) -> str:
        return STAGES[self.check[:3]]

    @property
    def may_pass_later(self) -> bool:
        return self.check in PASSING


class Unavailable(Refused):
    """A source that can't be had: not published, out of reach, or not whole."""

    def __init__(self, message: str) -> None:
        super().__init__("SRC01", message)


class Altered(Refused):
    """A preserved copy that isn't what its manifest says."""

    def __init__(self, message: str) -> None:
        super().__init__("SRC02", message)
