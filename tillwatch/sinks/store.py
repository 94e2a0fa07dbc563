"""Where tables live: three zones, each a folder or a catalog schema."""

from __future__ import annotations

from dataclasses import dataclass

ZONES = ("working", "historical", "quality")


class TableNotFound(LookupError):
    """A required table exists in no zone."""


@dataclass(frozen=True)
class Store:
    """A zone whose location holds a '/' is a folder, any other a catalog schema.

    The quality zone is a catalog schema because clearing staged metrics drops a partition.
    """

    working: str
    historical: str
    quality: str
    format: str = "parquet"

    def location(self, zone: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"unknown zone {zone!r}, expected one of {ZONES}")
        return getattr(self, zone)

    def is_catalog(self, zone: str) -> bool:
        return "/" not in self.location(zone)

    def path(self, zone: str, name: str) -> str:
        return f"{self.location(zone).rstrip('/')}/{name}"

    def table(self, zone: str, name: str) -> str:
        parts = self.location(zone).split(".") + [name]
        return ".".join(f"`{part}`" for part in parts)


@dataclass(frozen=True)
class Run:
    """Identity of one run; both values are kept as text."""

    run_id: str
    run_timestamp: str
    task_name: str = "weekly"
