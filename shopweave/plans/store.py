"""The tables of one side of a migration."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

from pyspark.sql import DataFrame

from ..session import Workspace


@dataclass(frozen=True)
class Store:
    """Frames of one store. A job never changes one; it returns a store with new frames."""

    users: DataFrame | None = None
    usermeta: DataFrame | None = None
    posts: DataFrame | None = None
    postmeta: DataFrame | None = None
    order_items: DataFrame | None = None
    order_itemmeta: DataFrame | None = None
    options: DataFrame | None = None
    terms: DataFrame | None = None
    term_taxonomy: DataFrame | None = None
    term_relationships: DataFrame | None = None
    wc_orders: DataFrame | None = None
    wc_orders_meta: DataFrame | None = None
    wc_order_addresses: DataFrame | None = None
    wc_order_operational_data: DataFrame | None = None
    status_backup: DataFrame | None = None
    #: Where the tables lie that a job has written.
    folders: dict[str, str] = field(default_factory=dict)

    def having(self, **tables: DataFrame) -> "Store":
        folders = {n: folder for n, folder in self.folders.items() if n not in tables}
        return replace(self, **tables, folders=folders)

    def written(self, workspace: Workspace, *names: str) -> "Store":
        """The named tables, all if none are named, written to a fresh location and read back: what a job
        leaves behind. Counts and checks then see what is stored, and the old tables stay as they are."""
        present = self.tables()
        chosen = [n for n in names or present if n in present]
        folders = {n: workspace.store(present[n], n) for n in chosen}
        stored = {n: workspace.read(present[n], folder) for n, folder in folders.items()}
        return replace(self, **stored, folders={**self.folders, **folders})

    def tables(self) -> dict[str, DataFrame]:
        """The tables that are present, by name."""
        named = {f.name: getattr(self, f.name) for f in fields(self) if f.name != "folders"}
        return {name: frame for name, frame in named.items() if frame is not None}
