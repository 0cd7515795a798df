"""The build pipeline: ingest, enrich in order, derive, write flags. Each phase is one commit with its state row."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import functions as F

from ..operators import identity
from ..operators.tables import Tables
from ..sources import feeds, records
from .coverage import all_landed
from .store import Store, changed_tables, stamp, state

ORDER = ("ingest", "kev", "nvd", "placeholder_products", "vendor_index", "product_candidates", "epss", "osv", "nuclei", "exploitdb", "metasploit", "exploit_flags")
EXPLOIT_PHASES = ("nuclei", "exploitdb", "metasploit")


def run_pipeline(store: Store, inputs: dict[str, str], *, skip: tuple[str, ...] = (), now: str | None = None, versions: dict[str, str] | None = None) -> Tables:
    """inputs: phase -> path of landed files; phases without input or in `skip` do not run.

    versions: phase -> version of its corpus; a phase whose stored watermark equals it is skipped, unless the records
    were ingested in this run, which wipes their enrichment. A phase that fails records no completion and leaves the last commit.
    """
    spark, versions = store.spark, versions or {}
    now = now or datetime.now(timezone.utc).isoformat()
    ran_ingest = "ingest" in inputs and "ingest" not in skip
    t = store.load()

    def commit(phase: str, make: Callable[[Tables], Tables], watermark: str | None = None) -> None:
        nonlocal t
        new = stamp(make(t), phase, now, watermark)
        t = store.commit(new, changed_tables(t, new))

    def due(phase: str) -> bool:
        if phase in skip or phase not in inputs:
            return False
        _, seen = state(t, phase)
        return ran_ingest or phase not in versions or versions[phase] != seen

    if ran_ingest:
        commit("ingest", lambda t: records.ingest(t, records.parse(records.read_records(spark, inputs["ingest"]))))
    if due("kev"):
        commit("kev", lambda t: feeds.merge_kev(t, feeds.read_kev(spark, inputs["kev"])), versions.get("kev"))
    if due("nvd"):
        _, mark = state(t, "nvd")
        rows = feeds.since(feeds.read_nvd(spark, inputs["nvd"]), None if ran_ingest else mark)
        top = rows.agg(F.max("lastModified")).first()[0]
        whole = all_landed(spark, inputs["nvd"])  # else the mark stays, so that what lacks is fetched again
        commit("nvd", lambda t: feeds.merge_nvd(t, rows), (top or mark) if whole else mark)
    derived = {
        "placeholder_products": identity.resolve_placeholders,
        "vendor_index": identity.build_vendor_index,
        "product_candidates": lambda t: t.replaced(product_candidate=identity.product_candidates(t)),
    }
    for phase, make in derived.items():
        if phase not in skip:
            commit(phase, make)
    if due("epss"):
        commit("epss", lambda t: feeds.merge_epss(t, feeds.read_epss(spark, inputs["epss"])))
    if due("osv"):
        commit("osv", lambda t: feeds.merge_osv(t, feeds.read_osv(spark, inputs["osv"])))
    readers = {
        "nuclei": lambda p: feeds.read_nuclei(spark, p, "https://templates.example", versions.get("nuclei", "main")),
        "exploitdb": lambda p: feeds.read_exploitdb(spark, p, "https://exploits.example"),
        "metasploit": lambda p: feeds.read_metasploit(spark, p, "https://modules.example"),
    }
    for phase in EXPLOIT_PHASES:
        if due(phase):
            commit(phase, lambda t, phase=phase: feeds.merge_artefacts(t, readers[phase](inputs[phase])), versions.get(phase))
    if "exploit_flags" not in skip:
        commit("exploit_flags", lambda t: t.replaced(exploit=identity.write_exploit_flags(t)))
    return t
