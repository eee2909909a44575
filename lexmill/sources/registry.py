"""Sources by name: how to read their payloads and how to make case rows of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lexmill.schema import SOURCES
from lexmill.sources import builders


@dataclass(frozen=True)
class Source:
    """A kind of court. ``build`` takes a table of parsed payloads and the query, and returns case rows."""

    name: str
    build: Callable[[DataFrame, str], DataFrame]


REGISTRY: dict[str, Source] = {
    "drt": Source("drt", lambda df, q: builders.build_tribunal(df, "DRT", q)),
    "drat": Source("drat", lambda df, q: builders.build_tribunal(df, "DRAT", q)),
    "nclt": Source("nclt", lambda df, q: builders.build_nclt(df, q)),
    "ncdrc": Source("ncdrc", lambda df, q: builders.build_consumer(df, "NCDRC", q)),
    "scdrc": Source("scdrc", lambda df, q: builders.build_consumer(df, "SCDRC", q)),
    "dcdrc": Source("dcdrc", lambda df, q: builders.build_consumer(df, "DCDRC", q)),
    "high_court": Source("high_court", lambda df, q: builders.build_hc_on_demand(df, q, "")),
    "district_court": Source("district_court", lambda df, q: builders.build_dc_on_demand(df, q)),
    "supreme_court": Source("supreme_court", lambda df, q: builders.build_sc_on_demand(df, q)),
}


def known_sources(names: list[str]) -> tuple[list[Source], list[str]]:
    """The known ones of the names, in the order given, and the names that are not known."""
    return [REGISTRY[n] for n in names if n in REGISTRY], [n for n in names if n not in REGISTRY]


def all_sources() -> list[str]:
    return [n for n in SOURCES if n in REGISTRY]
