"""The file form of product declarations (EXT01): what a run needs to know about its products.

A JSON document ``{"products": [{...}, ...]}`` gives for every product its declaration (table family, grain, time
style, columns) and how it is collected: cadence, lookback, when it counts as stale and since when it is
collected. Everything that is wrong with the document is reported at once: unknown and missing
fields, values of another type or out of range, products declared twice, and every fault of a
declaration itself.
"""

from __future__ import annotations

import datetime as dt
import json
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from asofspark.plans.declare import Declaration

# How often a product is published.
CADENCES = ("daily", "hourly", "15min", "5min")

#: field -> (types, required)
_FIELDS = {
    "product": ((str,), True), "table": ((str,), True), "interval_minutes": ((int,), True), "time_style": ((str,), True),
    "columns": ((dict,), True), "api_columns": ((dict,), False), "series": ((dict,), False), "keep_flag": ((str,), False),
    "keep_point_prefixes": ((list,), False), "cadence": ((str,), True), "lookback_hours": ((int,), True),
    "stale_after_min": ((int,), True), "collected_from": ((str,), False), "total": ((str,), False),
}
_DECLARED = ("product", "table", "interval_minutes", "time_style", "columns", "api_columns", "series", "keep_flag")


@dataclass(frozen=True)
class Product:
    """A declared product and how it is collected. ``total`` names the series that the others sum to."""

    declaration: Declaration
    cadence: str
    lookback_hours: int
    stale_after_min: int
    collected_from: dt.datetime | None = None  # UTC wall clock; None: since ever
    total: str | None = None

    @property
    def key(self) -> str:
        return self.declaration.product

    @property
    def table(self) -> str:
        return self.declaration.table

    @property
    def zones(self) -> tuple[str, ...]:
        """The series that the total is the sum of; none without a total."""
        return tuple(s for s in self.declaration.series.values() if s != self.total) if self.total else ()


def _is(value, types) -> bool:
    return isinstance(value, types) and not (isinstance(value, bool) and bool not in types)


def _instant(text: str) -> dt.datetime | None:
    try:
        at = dt.datetime.fromisoformat(text)
    except ValueError:
        return None
    return at.astimezone(dt.UTC).replace(tzinfo=None) if at.tzinfo else None


def _product(n: int, entry) -> tuple[Product | None, list[str]]:
    if not isinstance(entry, dict):
        return None, [f"entry {n} is not an object"]
    name = entry.get("product") if isinstance(entry.get("product"), str) else f"entry {n}"
    found = [f"{name}: no field is called {f!r}" for f in sorted(set(entry) - set(_FIELDS))]
    found += [f"{name}: {f!r} is missing" for f, (_, needed) in _FIELDS.items() if needed and entry.get(f) is None]
    given = {f: v for f, v in entry.items() if f in _FIELDS and v is not None}
    odd = [f for f, v in given.items() if not _is(v, _FIELDS[f][0])]
    texts = [f for f in ("columns", "api_columns", "series") if f in given and f not in odd
             and not all(isinstance(v, str) for v in given[f].values())]
    if "keep_point_prefixes" in given and "keep_point_prefixes" not in odd and not all(isinstance(v, str) for v in given["keep_point_prefixes"]):
        texts.append("keep_point_prefixes")
    found += [f"{name}: {f!r} is not {' or '.join(t.__name__ for t in _FIELDS[f][0])}" for f in odd]
    found += [f"{name}: {f!r} holds something else than text" for f in texts]
    good = {f: v for f, v in given.items() if f not in odd and f not in texts}
    if "cadence" in good and good["cadence"] not in CADENCES:
        found.append(f"{name}: no cadence is called {good['cadence']!r} (there are {', '.join(CADENCES)})")
    found += [f"{name}: {f!r} is not positive" for f in ("lookback_hours", "stale_after_min") if f in good and good[f] <= 0]
    since = _instant(good["collected_from"]) if "collected_from" in good else None
    if "collected_from" in good and since is None:
        found.append(f"{name}: 'collected_from' is not an ISO time with its offset")
    if "total" in good and good["total"] not in good.get("series", {}).values():
        found.append(f"{name}: the total {good['total']!r} is none of its series")
    if any(f not in good for f in _DECLARED[:5]):
        return None, found
    parts = {f: good[f] for f in _DECLARED if f in good}
    parts["keep_point_prefixes"] = tuple(good.get("keep_point_prefixes", ()))
    declaration = object.__new__(Declaration)  # its own faults are listed with all others
    for f, v in {"series": {}, "keep_flag": None, "source": "archive", "api_columns": {}, **parts}.items():
        object.__setattr__(declaration, f, v)
    found += [f"{name}: {x}" for x in declaration.faults()]
    if found:
        return None, found
    return Product(declaration, good["cadence"], good["lookback_hours"], good["stale_after_min"], since, good.get("total")), []


def parse_products(text: str) -> list[Product]:
    """The products of a document; a ``ValueError`` names everything that is wrong with it."""
    try:
        document = json.loads(text)
    except json.JSONDecodeError as e:
        raise ValueError(f"product document: not JSON ({e})") from None
    entries = document.get("products") if isinstance(document, dict) else None
    if not isinstance(entries, list):
        raise ValueError("product document: no list of products")
    read = [_product(n, e) for n, e in enumerate(entries)]
    found = [f for _, faults in read for f in faults]
    names = Counter(e["product"] for e in entries if isinstance(e, dict) and isinstance(e.get("product"), str))
    found += [f"{name}: declared {n} times" for name, n in names.items() if n > 1]
    if found:
        raise ValueError("product document: " + "; ".join(found))
    return [p for p, _ in read]


def load_products(spark: SparkSession, path: str) -> list[Product]:
    """The products of one JSON file on any file system that Spark reads."""
    (row,) = spark.read.option("wholetext", "true").text(path).collect()
    return parse_products(row[0])


def declarations(products: Sequence[Product]) -> dict[str, Declaration]:
    return {p.key: p.declaration for p in products}


def tables(products: Sequence[Product]) -> dict[str, str]:
    """Product -> table family, as the lake's reader takes it."""
    return {p.key: p.table for p in products}
