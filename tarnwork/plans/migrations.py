"""Versioned migrations of stored snapshots: an ordered registry, run when a store is opened.

Each migration is a function of the model that may be run again without effect. The number of the last one is kept in the manifest and
committed with the data it changed, so a migration that fails leaves the store as it was and is run again at the next opening. Columns that a
snapshot lacks read as null, and are written when their table next is.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import SparkSession

from ..operators import merge as M
from ..operators.tables import Tables
from .store import BUCKETS, WHOLE, Store, changed_tables, is_bucketed


class Migration(NamedTuple):
    number: int
    name: str
    apply: Callable[[Tables], Tables]


MIGRATIONS = (
    Migration(1, "scores of zero mean not scored", lambda t: t.replaced(intel=M.null_unscored(t["intel"])) if "intel" in t else t),
    Migration(2, "flags that nothing assessed are unknown", lambda t: t.replaced(exploit=M.tri_state(t["exploit"])) if "exploit" in t else t),
    Migration(3, "one platform match per record and criteria", lambda t: M.dedupe_cpe(t) if "cpe_match" in t else t),
    Migration(4, "one product per vendor and folded name", lambda t: M.dedupe_products(t) if "product" in t else t),
    Migration(5, "no unused blank vendor", lambda t: M.drop_orphan_sentinel(t) if "vendor" in t else t),
)


def migrate(store: Store, migrations: tuple[Migration, ...] = MIGRATIONS) -> list[str]:
    """Bring a store up to the last migration, in one commit. Returns the names of those that ran.

    Tables of records that an older layout holds whole are written in buckets on the way.
    """
    version, entries = store._manifest()
    if not version:
        return []
    done = store.migrated()
    todo = sorted(m for m in migrations if m.number > done)
    whole = [n for (n, b) in entries if b == WHOLE and not n.startswith("__") and is_bucketed(n)]
    if not todo and not whole:
        return []
    before = store.load()
    after = before
    for m in todo:
        after = m.apply(after)
    store.commit(after, sorted({*changed_tables(before, after), *whole}), migrated=todo[-1].number if todo else done)
    return [m.name for m in todo]


def open_store(spark: SparkSession, root: str, buckets: int = BUCKETS) -> Store:
    """A store whose data has seen all migrations. A new one is marked at its first migration, which finds nothing to do."""
    store = Store(spark, root, buckets)
    migrate(store)
    return store
