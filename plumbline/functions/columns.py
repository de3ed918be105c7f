"""Column expressions with the exact semantics that the metrics rest on. All are built-in expressions: none leaves the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_between(begin: Column | str, end: Column | str) -> Column:
    """Second boundaries between two zone-less times: differences of whole seconds, so that parts add up to the whole."""
    return F.unix_seconds(_col(end).cast("timestamp")) - F.unix_seconds(_col(begin).cast("timestamp"))


def minutes_between(begin: Column | str, end: Column | str) -> Column:
    """Minutes with fractions, exact to the microsecond."""
    return (F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(_col(begin).cast("timestamp"))) / 6e7


def half_open_band(value: Column, bands: Sequence[tuple]) -> Column:
    """The label of the band low <= value < high; null where none holds."""
    out = None
    for low, high, label in bands:
        holds = (value >= low) & (value < high)
        out = F.when(holds, F.lit(label)) if out is None else out.when(holds, F.lit(label))
    return out


def right_closed_band(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """The label of the band low < value <= high; null outside all of them."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for low, high, label in zip(edges, edges[1:], labels):
        out = out.when((value > low) & (value <= high), F.lit(label))
    return out


def first_match(*branches: tuple[Column, str], otherwise: str | None = None) -> Column:
    """The label of the first condition that holds."""
    out = F.when(*branches[0])
    for condition, label in branches[1:]:
        out = out.when(condition, label)
    return out.otherwise(F.lit(otherwise))


def last_match(*branches: tuple[Column, str], otherwise: str | None = None) -> Column:
    """The label of the last condition that holds: assignments in order, later ones win."""
    return first_match(*reversed(branches), otherwise=otherwise)


def share(part: Column | str, whole: Column | str) -> Column:
    """part / whole as a double; null where the whole is zero or null."""
    return F.try_divide(_col(part).cast("double"), _col(whole).cast("double"))


def passes(predicate: Column) -> Column:
    """A rule's verdict: an unknown predicate fails."""
    return F.coalesce(predicate, F.lit(False))


def joined_ids(flags: Sequence[tuple[str, Column]]) -> Column:
    """Comma-joined names of the flags that are set, empty if none is."""
    return F.concat_ws(",", *[F.when(flag, F.lit(name)) for name, flag in flags])


def normalised(value: Column | str, blank: str | None = None) -> Column:
    """Trimmed and in lower case; blanks inside become `blank` where one is given."""
    out = F.lower(F.trim(_col(value)))
    return F.replace(out, F.lit(" "), F.lit(blank)) if blank is not None else out


def lenient_time(value: Column | str) -> Column:
    """A text as zone-less time; null where it can't be read."""
    return F.try_to_timestamp(_col(value)).cast("timestamp_ntz")


def flat_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, km_lat: float = 111.0, km_lon: float = 108.2) -> Column:
    """Distance on a plane with fixed kilometres a degree, for places within one city."""
    return F.sqrt(F.pow((lat1 - lat2) * km_lat, 2) + F.pow((lon1 - lon2) * km_lon, 2))


def when_known(condition: Column, value: Column) -> Column:
    """value where the condition holds, else null: a figure is withheld rather than shown without support."""
    return F.when(condition, value)


def wilson(rate: Column, n: Column, z: float = 1.959964) -> tuple[Column, Column]:
    """Wilson score interval of a proportion: (low, high)."""
    n = n.cast("double")
    centre = rate + z * z / (2 * n)
    spread = z * F.sqrt(rate * (1 - rate) / n + z * z / (4 * n * n))
    scale = 1 + z * z / n
    return F.try_divide(centre - spread, scale), F.try_divide(centre + spread, scale)


def total(flags: Sequence[Column]) -> Column:
    """How many of the flags are set."""
    return reduce(add, [F.coalesce(f.cast("int"), F.lit(0)) for f in flags])


def holds(text: Column | str, word: str) -> Column:
    """Whether a text holds a word in any case; false for a null text. Any text holds the empty word."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.contains(F.lower(c), F.lower(F.lit(word))), F.lit(False))
