"""Keyed merges: set-based, idempotent, one pass each. Old and new snapshots go in, the next snapshot comes out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut, parts_of_rows
from .tables import CVE_CHILDREN, Tables


def _matched(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of keys, so that a missing part of a key is a value of its own."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def without(old: DataFrame, keys_of: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of old whose key is not in keys_of."""
    k = keys_of.select(*keys).distinct()
    return old.join(k, _matched(old, k, keys), "left_anti")


def keep_first(df: DataFrame, keys: list[str], *order: Column | str, last: bool = False) -> DataFrame:
    """One row per key: the first by `order` (ascending), or the last."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() if last else c.asc_nulls_first() for c in cols])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Rows of new with unseen keys are added; of equal new keys the first by `order` counts."""
    fresh = keep_first(new, keys, *(order or keys))
    return old.unionByName(without(fresh, old, keys))


def overwrite(old: DataFrame, new: DataFrame, keys: list[str], *order: str, known: DataFrame | None = None) -> DataFrame:
    """New rows replace old ones by key, the last by `order`; with `known`, keys not in it are dropped."""
    fresh = keep_first(new, keys, *(order or keys), last=True)
    if known is not None:
        k = known.select(*[c for c in keys if c in known.columns]).distinct()
        fresh = fresh.join(k, k.columns, "left_semi").select(*new.columns)
    return without(old, fresh, keys).unionByName(fresh.select(*old.columns))


def fold(new: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """One row per key: in each column the last non-null value by `order`, ties and no order by the greatest value."""
    rest = [c for c in new.columns if c not in keys]
    last = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col(c).alias("value"))))["value"]
    return new.groupBy(*keys).agg(*[last(c).alias(c) for c in rest]).select(*new.columns)


def coalesce_merge(old: DataFrame, new: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Non-null new values replace old ones; a null never erases. New rows of one key are folded first, so each key keeps one row."""
    new = fold(new, keys, *order)
    rest = [c for c in old.columns if c not in keys]
    a, b = old.alias("a"), new.alias("b")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return a.join(b, cond, "full_outer").select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], *[F.coalesce(f"b.{c}", f"a.{c}").alias(c) for c in rest]).select(*old.columns)


def replace_group(old: DataFrame, new: DataFrame, group: str) -> DataFrame:
    """All old rows of a group go when new has rows of it; groups without new rows stay."""
    return without(old, new, [group]).unionByName(new.select(*old.columns))


def keep_newest(old: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row with the greatest version per key; old rows win ties."""
    both = old.withColumn("__age", F.lit(1)).unionByName(new.select(*old.columns).withColumn("__age", F.lit(0)))
    return keep_first(both, keys, version, "__age", last=True).drop("__age")


def guarded_upsert(old: DataFrame, new: DataFrame, keys: list[str], guard: Column) -> DataFrame:
    """As overwrite, but old rows for which `guard` holds are never replaced."""
    locked = old.where(guard)
    return overwrite(old, without(new, locked, keys), keys)


def cascade_delete(t: Tables, ids: DataFrame) -> Tables:
    """All tables without the records in ids(cve_id) and their children."""
    ids = ids.select("cve_id").distinct()
    out = {n: t[n].join(ids, "cve_id", "left_anti") for n in ("cve", *CVE_CHILDREN)}
    gone = t["affected_product"].join(ids, "cve_id", "left_semi").select(F.col("id").alias("affected_product_id"))
    out["version_range"] = t["version_range"].join(gone, "affected_product_id", "left_anti").select(*t["version_range"].columns)
    refs = t["reference"].join(ids, "cve_id", "left_semi").select(F.col("id").alias("reference_id"))
    out["reference_tag"] = t["reference_tag"].join(refs, "reference_id", "left_anti").select(*t["reference_tag"].columns)
    return t.replaced(**out)


def replace_graph(t: Tables, new: Tables, steps: tuple[str, ...] | None = None) -> Tables:
    """Delete the records that new holds, with all children, and add new's rows to every table.

    `steps` limits which child tables are written again; records and deletion are always done.
    """
    kept = cascade_delete(t, new["cve"])
    parts = ["cve", *(n for n in (*CVE_CHILDREN, "version_range", "reference_tag") if steps is None or n in steps)]
    return kept.replaced(**{n: kept[n].unionByName(new[n].select(*kept[n].columns)) for n in parts if n in new})


def upsert_scores(t: Tables, scores: DataFrame) -> Tables:
    """Scores of known records without touching their graph; a null never erases; of several scores of a record the greatest counts."""
    known = scores.join(t["cve"].select("cve_id"), "cve_id", "left_semi")
    return t.replaced(intel=coalesce_merge(t["intel"], known.select("cve_id", "epss_score", "epss_percentile"), ["cve_id"]))


def assign_ids(df: DataFrame, existing: DataFrame, id_column: str, *order: str) -> DataFrame:
    """df with ids that continue the largest existing one, in the order of natural keys, which must be unique: the same on every run.

    Ids are dense per range of the order: counts per range are summed, so no single task numbers all rows.
    """
    start = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("m"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    dealt = cut(dealt.withColumn("__in", F.row_number().over(Window.partitionBy("__part").orderBy(*order))))
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return dealt.join(sizes.select("__part", "__before"), "__part").crossJoin(start).withColumn(id_column, F.col("m") + F.col("__before") + F.col("__in")).drop("__part", "__in", "__before", "m")


def ensure_dimension(existing: DataFrame, new: DataFrame, id_column: str, key: dict[str, Column], seq: str) -> DataFrame:
    """Surrogate-key dimension: unseen keys are added with new ids, with the spelling that came first by `seq`."""
    names = list(key)
    fresh = keep_first(new.withColumns({f"__{k}": e for k, e in key.items()}), [f"__{k}" for k in names], seq)
    have = existing.withColumns({f"__{k}": e for k, e in key.items()}).select(*[f"__{k}" for k in names])
    fresh = cut(without(fresh, have, [f"__{k}" for k in names]))
    cols = [c for c in existing.columns if c != id_column]
    numbered = assign_ids(fresh.select(*cols, *[f"__{k}" for k in names]), existing, id_column, *[f"__{k}" for k in names])
    return existing.unionByName(numbered.select(*existing.columns))


def vendor_key() -> dict[str, Column]:
    return {"name": F.lower(F.trim("name"))}


def product_key() -> dict[str, Column]:
    return {"vendor_id": F.col("vendor_id"), "name": F.lower(F.trim("name")), "component": F.lower(F.trim(F.coalesce("component", F.lit(""))))}


def dedupe(df: DataFrame, keys: list[Column | str], id_column: str) -> DataFrame:
    """The row with the lowest id per key."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    named = df.withColumns({f"__k{i}": c for i, c in enumerate(cols)})
    keys_ = [f"__k{i}" for i in range(len(cols))]
    return keep_first(named.repartition(parts_of_rows(df), *keys_), keys_, id_column).drop(*keys_)


def keeper_map(df: DataFrame, keys: list[Column], id_column: str) -> DataFrame:
    """(old, keeper): every id and the lowest id with its key."""
    w = Window.partitionBy(*keys)
    return df.select(F.col(id_column).alias("old"), F.min(id_column).over(w).alias("keeper"))


def repoint(child: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """child with ids in `column` replaced by their keepers."""
    m = mapping.where("old <> keeper").select(F.col("old").alias(column), "keeper")
    return child.join(m, column, "left").withColumn(column, F.coalesce("keeper", column)).select(*child.columns)


def dedupe_affected(t: Tables) -> Tables:
    ap = dedupe(t["affected_product"], ["cve_id", "product_id"], "id")
    vr = t["version_range"].join(ap.select(F.col("id").alias("affected_product_id")), "affected_product_id", "left_semi").select(*t["version_range"].columns)
    return t.replaced(affected_product=ap, version_range=vr)


def dedupe_products(t: Tables) -> Tables:
    """Case variants of a product become the one with the lowest id; edges follow and are deduped."""
    keys = list(product_key().values())
    mapping = keeper_map(t["product"], keys, "product_id")
    product = dedupe(t["product"], keys, "product_id")
    return dedupe_affected(t.replaced(product=product, affected_product=repoint(t["affected_product"], mapping, "product_id")))


def dedupe_cpe(t: Tables) -> Tables:
    return t.replaced(cpe_match=dedupe(t["cpe_match"], ["cve_id", "criteria", F.coalesce("match_criteria_id", F.lit(""))], "id"))


def null_unscored(intel: DataFrame) -> DataFrame:
    """A score and percentile of 0 both mean "not scored"."""
    none = (F.col("epss_score") == 0) & (F.col("epss_percentile") == 0)
    return intel.withColumns({c: F.when(~F.coalesce(none, F.lit(False)), F.col(c)) for c in ("epss_score", "epss_percentile")})


def tri_state(exploit: DataFrame) -> DataFrame:
    """Legacy flags: false was also written for "not assessed", so it becomes null."""
    return exploit.withColumns({c: F.when(F.col(c).cast("boolean"), F.lit(True)) for c in ("public_poc", "metasploit")})


def drop_orphan_sentinel(t: Tables) -> Tables:
    """Blank-named vendors that no edge and no product uses go."""
    blank = t["vendor"].where(F.trim(F.coalesce("name", F.lit(""))) == "").select("vendor_id")
    orphan = blank.join(t["cve_vendor"], "vendor_id", "left_anti").join(t["product"], "vendor_id", "left_anti")
    return t.replaced(vendor=t["vendor"].join(orphan, "vendor_id", "left_anti"))
