"""Derived vendor and product identity: from structured platform identifiers and from prose.

All are pure functions of the base tables, recomputed whole; running one twice changes nothing.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from .lineage import cut
from .merge import assign_ids, dedupe, keep_first
from .tables import Tables
from .token_automaton import TokenAutomaton, find

# Thresholds of the identity rules.
MAX_SLUGS, MIN_SHARE, MIN_ROWS, DOMINANT = 8, 0.05, 2, 0.80
MIN_NAME = 3


# slugs of products and records


def product_slug_tally(t: Tables) -> DataFrame:
    """(product_id, slug, n): identifiers of the records that a product affects, after the own-vendor guard.

    Identifiers are counted per record and slug before the join, so that a product of many records does not
    multiply their rows.
    """
    guard = X.is_cpe("criteria")
    cpe = t["cpe_match"].where(guard).select("cve_id", X.cpe_slug("criteria").alias("slug")).where(~F.col("slug").isin(*X.DEGENERATE_SLUGS)).groupBy("cve_id", "slug").agg(F.count("*").alias("k"))
    owner = t["product"].select("product_id", "vendor_id").join(t["vendor"].select("vendor_id", F.col("name").alias("owner")), "vendor_id", "left").select("product_id", "owner")
    j = t["affected_product"].select("cve_id", "product_id", "source").join(cpe, "cve_id").join(owner, "product_id", "left")
    own = X.norm_key("slug") == X.norm_key(F.coalesce("owner", F.lit("")))
    return j.where(~F.col("source").eqNullSafe("cpe") | own).groupBy("product_id", "slug").agg(F.sum("k").alias("n"))


def product_cpe_vendor(t: Tables) -> DataFrame:
    """Slugs that speak for a product: of at most MAX_SLUGS, those with MIN_ROWS rows and MIN_SHARE of all its rows."""
    w = Window.partitionBy("product_id")
    tally = product_slug_tally(t).withColumn("total", F.sum("n").over(w)).withColumn("slugs", F.count("*").over(w))
    return tally.where((F.col("slugs") <= MAX_SLUGS) & (F.col("n") >= MIN_ROWS) & (F.col("n") / F.col("total") >= MIN_SHARE)).select("product_id", "slug", "n")


def cve_cpe_vendor(t: Tables) -> DataFrame:
    c = t["cpe_match"].where(F.col("vulnerable") & X.is_cpe("criteria"))
    return c.select("cve_id", X.cpe_slug("criteria").alias("slug")).where(~F.col("slug").isin(*X.DEGENERATE_SLUGS)).distinct()


def dominant_slug(t: Tables) -> DataFrame:
    """(product_id, slug) of blank-vendor products with a single or dominant slug."""
    blank = t["vendor"].where(~X.not_blank("name")).select("vendor_id")
    mine = t["product"].join(blank, "vendor_id", "left_semi").where(~X.is_placeholder_product("name")).select("product_id")
    w = Window.partitionBy("product_id")
    tally = product_slug_tally(t).join(mine, "product_id", "left_semi").withColumn("total", F.sum("n").over(w)).withColumn("rn", F.row_number().over(w.orderBy(F.desc("n"), "slug")))
    return tally.where((F.col("rn") == 1) & (F.col("n") / F.col("total") >= DOMINANT)).select("product_id", "slug")


def repoint_sentinel_products(t: Tables) -> Tables:
    """Products of the blank vendor move to the existing vendor that their slug names; twins there are merged."""
    names = t["vendor"].where(X.not_blank("name")).select("vendor_id", F.lower(F.trim("name")).alias("folded"))
    slugs = cut(dominant_slug(t))
    tries = slugs.select("product_id", F.lower("slug").alias("folded"), F.lit(0).alias("rank")).unionAll(slugs.select("product_id", F.lower(F.translate("slug", "_", " ")).alias("folded"), F.lit(1).alias("rank")))
    moves = keep_first(tries.join(names, "folded"), ["product_id"], "rank", "vendor_id").select("product_id", F.col("vendor_id").alias("to"))
    return move_products(t, moves)


def move_products(t: Tables, moves: DataFrame) -> Tables:
    """moves: (product_id, to). Products that then share vendor, name and component become the one that was there, or the lowest id."""
    p = t["product"].join(moves, "product_id", "left").withColumn("moved", F.col("to").isNotNull()).withColumn("vendor_id", F.coalesce("to", "vendor_id"))
    key = [F.col("vendor_id"), F.lower(F.trim("name")), F.lower(F.trim(F.coalesce("component", F.lit(""))))]
    w = Window.partitionBy(*key).orderBy("moved", "product_id")
    p = cut(p.withColumn("keeper", F.first("product_id").over(w)))
    mapping = p.select(F.col("product_id").alias("old"), "keeper")
    product = p.where(F.col("product_id") == F.col("keeper")).select(*t["product"].columns)
    ap = t["affected_product"].join(mapping.withColumnRenamed("old", "product_id"), "product_id", "left")
    # of two rows of one record and product, the one that was the keeper's own stays
    ap = ap.withColumn("other", F.coalesce((F.col("keeper") != F.col("product_id")).cast("int"), F.lit(0))).withColumn("product_id", F.coalesce("keeper", "product_id"))
    ap = keep_first(ap, ["cve_id", "product_id"], "other", "id").select(*t["affected_product"].columns)
    vr = t["version_range"].join(ap.select(F.col("id").alias("affected_product_id")), "affected_product_id", "left_semi").select(*t["version_range"].columns)
    return t.replaced(product=product, affected_product=ap, version_range=vr)


def build_vendor_index(t: Tables) -> Tables:
    """Index, repoint, index again: the second pass sees the moved products."""
    moved = repoint_sentinel_products(t.replaced(product_cpe_vendor=product_cpe_vendor(t)))
    return moved.replaced(product_cpe_vendor=product_cpe_vendor(moved), cve_cpe_vendor=cve_cpe_vendor(moved))


# placeholders


def pairs_to_resolve(cpe_match: DataFrame) -> DataFrame:
    """(cve_id, vendor, product): all vulnerable pairs of a record, or its only platform pair; else none."""
    parts = cpe_match.select("cve_id", "vulnerable", X.cpe_parts("criteria").alias("p")).where("p is not null")
    sets = parts.groupBy("cve_id").agg(F.collect_set(F.when(F.col("vulnerable"), F.col("p"))).alias("v"), F.collect_set(F.when(~F.coalesce("vulnerable", F.lit(True)), F.col("p"))).alias("o"))
    chosen = F.when(F.size("v") > 0, F.col("v")).when(F.size("o") == 1, F.col("o"))
    return sets.select("cve_id", F.explode(chosen).alias("p")).select("cve_id", "p.vendor", "p.product")


def _resolve(keys: DataFrame, held: DataFrame, group: list[str], name: str, key: str) -> DataFrame:
    """keys(*group, key) with `id`: the one held row with its norm key, else the one with its humanised name, else null."""
    single = held.withColumn("nk", X.norm_key(name)).groupBy(*group, "nk").agg(F.count("*").alias("c"), F.min("id").alias("by_key")).where("c = 1 and nk <> ''").drop("c")
    exact = held.groupBy(*group, F.lower(F.trim(name)).alias("folded")).agg(F.min("id").alias("by_name"))
    k = keys.withColumn("nk", X.norm_key(key)).withColumn("folded", F.lower(X.humanise(key)))
    return k.join(single, [*group, "nk"], "left").join(exact, [*group, "folded"], "left").withColumn("id", F.coalesce("by_key", "by_name")).select(*keys.columns, "nk", "id")


def resolve_identities(t: Tables, pairs: DataFrame) -> tuple[Tables, DataFrame]:
    """Vendors and products for distinct (vendor, product) pairs, created where none fits; the pairs with product_id and vendor_id.

    New names that share a norm key become one, spelled by the smallest.
    """
    pairs = pairs.select("vendor", "product").distinct()
    held = t["vendor"].where(X.not_blank("name")).select(F.col("vendor_id").alias("id"), "name")
    found = cut(_resolve(pairs.select("vendor").distinct(), held, [], "name", "vendor"))
    new = found.where("id is null").groupBy("nk").agg(X.humanise(F.min("vendor")).alias("name"))
    numbered = cut(assign_ids(new, t["vendor"], "vendor_id", "nk"))
    vendor = t["vendor"].unionByName(numbered.select("vendor_id", "name"), allowMissingColumns=True)
    vendors = found.join(numbered.select("nk", F.col("vendor_id").alias("made")), "nk", "left").select("vendor", F.coalesce("id", "made").alias("vendor_id"))
    wanted = pairs.join(vendors, "vendor").select("vendor", "product", "vendor_id")
    held = t["product"].where(~X.is_placeholder_product("name")).select("vendor_id", F.col("product_id").alias("id"), "name")
    found = cut(_resolve(wanted, held, ["vendor_id"], "name", "product"))
    new = found.where("id is null").groupBy("vendor_id", "nk").agg(X.humanise(F.min("product")).alias("name"))
    numbered = cut(assign_ids(new, t["product"], "product_id", "vendor_id", "nk"))
    product = t["product"].unionByName(numbered.select("product_id", "name", "vendor_id", F.lit("UNKNOWN").alias("product_type"), F.lit("").alias("component")), allowMissingColumns=True)
    ids = found.join(numbered.select("vendor_id", "nk", F.col("product_id").alias("made")), ["vendor_id", "nk"], "left").select("vendor", "product", "vendor_id", F.coalesce("id", "made").alias("product_id"))
    return t.replaced(vendor=vendor, product=product), ids


def resolve_placeholders(t: Tables) -> Tables:
    """Placeholder products of a record are replaced by what its platform identifiers name.

    The lowest anchor row moves to the first target that the record does not hold; other targets become new rows.
    """
    anchors = t["affected_product"].join(t["product"].where(X.is_placeholder_product("name")).select("product_id"), "product_id", "left_semi")
    anchor = anchors.groupBy("cve_id").agg(F.min("id").alias("anchor_id"))
    pairs = cut(pairs_to_resolve(t["cpe_match"].join(anchor, "cve_id", "left_semi")))
    t2, ids = resolve_identities(t, pairs)
    targets = pairs.join(ids, ["vendor", "product"]).groupBy("cve_id", "product_id").agg(F.min(F.struct("vendor", "product")).alias("pair"), F.min("vendor_id").alias("vendor_id"))
    targets = targets.join(t["affected_product"].select("cve_id", "product_id"), ["cve_id", "product_id"], "left_anti").join(anchor, "cve_id")
    ranked = cut(targets.withColumn("rk", F.row_number().over(Window.partitionBy("cve_id").orderBy("pair"))))
    moved = ranked.where("rk = 1").select(F.col("anchor_id").alias("id"), F.col("product_id").alias("to"))
    ap = t["affected_product"].join(moved, "id", "left").withColumn("product_id", F.coalesce("to", "product_id")).withColumn("source", F.when(F.col("to").isNotNull(), "cpe").otherwise(F.col("source"))).select(*t["affected_product"].columns)
    extra = ranked.where("rk > 1").select("cve_id", "product_id", F.lit(True).alias("affected"), F.lit("cpe").alias("source"))
    extra = cut(assign_ids(extra, t["affected_product"], "id", "cve_id", "product_id"))
    ap = ap.unionByName(extra, allowMissingColumns=True).select(*t["affected_product"].columns)
    edges = ranked.select("cve_id", "vendor_id", F.lit("affected").alias("role")).distinct()
    primary = t["cve_vendor"].where("role = 'primary'").select("cve_id", "vendor_id")
    edges = edges.join(primary, ["cve_id", "vendor_id"], "left_anti").join(t["cve_vendor"], ["cve_id", "vendor_id", "role"], "left_anti")
    return t2.replaced(affected_product=ap, cve_vendor=t["cve_vendor"].unionByName(edges.select(*t["cve_vendor"].columns)))


# candidates from prose

TOKEN = r"[A-Za-z0-9][A-Za-z0-9.+_-]*"


def tokens_of(text: Column) -> tuple[Column, Column]:
    """(tokens as written, tokens folded to [a-z0-9])."""
    raw = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return raw, F.transform(raw, lambda w: F.translate(F.lower(w), ".+_-", ""))  # tokens hold no other characters to drop


def only_placeholder_cves(t: Tables) -> DataFrame:
    """Records whose every product is a placeholder."""
    named = t["product"].where(~X.is_placeholder_product("name")).select("product_id")
    return t["affected_product"].select("cve_id").distinct().subtract(t["affected_product"].join(named, "product_id", "left_semi").select("cve_id"))


def candidate_dictionary(t: Tables) -> DataFrame:
    """(product_id, v, p, first): folded tokens of vendor and product, for products worth looking for."""
    v = t["vendor"].where(X.not_blank("name")).select("vendor_id", F.col("name").alias("vendor_name"))
    j = t["product"].where(~X.is_placeholder_product("name")).select("product_id", "vendor_id", F.col("name").alias("product_name")).join(v, "vendor_id").where(~X.is_placeholder_vendor("vendor_name"))
    fit = (F.length(X.norm_key("vendor_name")) >= MIN_NAME) & (F.length(X.norm_key("product_name")) >= MIN_NAME) & (X.norm_key("vendor_name") != X.norm_key("product_name"))
    d = j.where(fit).select("product_id", tokens_of(F.col("vendor_name"))[1].alias("v"), tokens_of(F.col("product_name"))[1].alias("p"))
    return d.where((F.size("v") > 0) & (F.size("p") > 0)).withColumn("first", F.get("v", F.lit(0)))


MAX_NAMES, MAX_NAME_TOKENS = 300_000, 2_000_000  # of a dictionary that is broadcast as an automaton, some 500 MB at most
FOUND = "cve_id {}, product_id bigint, matched_text string"


def find_candidates(texts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """texts(cve_id, text): (cve_id, product_id, matched_text), the first match per product.

    The vendor's tokens must be followed by the product's, or be the start of a product name that contains them. The last
    token may end in digits and dots. A dictionary of counted size is broadcast as an automaton that walks each text
    once, without a shuffle of texts; a larger one is split by first token and joined.
    """
    size = dictionary.agg(F.count("*").alias("names"), F.coalesce(F.sum(F.size("v") + F.size("p")), F.lit(0)).alias("tokens")).first()
    if size["names"] > MAX_NAMES or size["tokens"] > MAX_NAME_TOKENS:
        return join_candidates(texts, dictionary)
    names = dictionary.select("product_id", "v", "p").collect()
    sequences = [(r["product_id"], 0, [*r["v"], *r["p"]]) for r in names] + [(r["product_id"], 1, r["p"]) for r in names if r["p"][: len(r["v"])] == r["v"]]
    shared = texts.sparkSession.sparkContext.broadcast(TokenAutomaton(sequences))

    def walk(batches):
        token, dropped = re.compile(TOKEN), dict.fromkeys(map(ord, ".+_-"))
        for batch in batches:
            at, ids, found = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for ident, matched in find(shared.value, text or "", token, dropped):
                    at.append(i)
                    ids.append(ident)
                    found.append(matched)
            yield pa.RecordBatch.from_arrays([batch.column("cve_id").take(pa.array(at, pa.int32())), pa.array(ids, pa.int64()), pa.array(found, pa.string())], ["cve_id", "product_id", "matched_text"])

    return texts.select("cve_id", "text").mapInArrow(walk, FOUND.format(texts.schema["cve_id"].dataType.simpleString()))


def join_candidates(texts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """As find_candidates, by a join of texts' tokens with the vendors' first tokens."""
    longest = dictionary.agg(F.max(F.size("v") + F.size("p"))).first()[0] or 0
    raw, folded = tokens_of(F.col("text"))
    rows = texts.select("cve_id", raw.alias("raw"), folded.alias("tok"))
    # each token carries the few that follow it, not the whole text
    run = F.transform(F.sequence(F.lit(0), F.size("tok") - 1), lambda i: F.struct(F.get("tok", i).alias("first"), F.slice("tok", i + 1, F.lit(longest)).alias("tok"), F.slice("raw", i + 1, F.lit(longest)).alias("raw"), i.alias("i")))
    rows = rows.where(F.size("tok") > 0).select("cve_id", F.inline(run))
    j = rows.join(dictionary, "first")

    def matches(want: Column) -> Column:
        n = F.size(want)
        have = F.slice("tok", F.lit(1), n)
        last = F.element_at(want, -1)
        tail = F.substring(F.get(have, n - 1), F.length(last) + 1, F.lit(1 << 20))
        head = F.slice(have, F.lit(1), n - 1) == F.slice(want, F.lit(1), n - 1)
        return (F.size(have) == n) & head & F.get(have, n - 1).startswith(last) & tail.rlike("^[0-9.]*$")

    whole = F.concat("v", "p")
    own = F.slice("p", F.lit(1), F.size("v")) == F.col("v")
    n = F.when(matches(whole), F.size(whole)).when(own & matches(F.col("p")), F.size("p"))
    hits = j.withColumn("n", n).where("n is not null").withColumn("matched_text", F.array_join(F.slice("raw", F.lit(1), F.col("n")), " "))
    return keep_first(hits.select("cve_id", "product_id", "i", "matched_text"), ["cve_id", "product_id"], "i").select("cve_id", "product_id", "matched_text")


def product_candidates(t: Tables) -> DataFrame:
    texts = t["cve"].join(only_placeholder_cves(t), "cve_id", "left_semi").select("cve_id", F.concat_ws("\n", "title", "summary").alias("text"))
    return find_candidates(texts, candidate_dictionary(t))


# exploit flags

PUBLIC_PHASES, METASPLOIT_PHASES = ("nuclei", "exploitdb"), ("metasploit",)


def write_exploit_flags(t: Tables) -> DataFrame:
    """The exploit table with flags set by artefacts, but only where every phase behind a flag has completed; else untouched."""
    done = {r[0] for r in t["pipeline_run"].where(F.col("last_completed_at").isNotNull()).select("phase").collect()}
    out = t["exploit"]
    for column, phases in (("public_poc", PUBLIC_PHASES), ("metasploit", METASPLOIT_PHASES)):
        if set(phases) <= done:
            has = t["exploit_artefact"].where(F.col("source").isin(*phases)).select("cve_id").distinct().withColumn("__has", F.lit(True))
            out = out.join(has, "cve_id", "left").withColumn(column, F.coalesce("__has", F.lit(False))).drop("__has")
    return out.select(*t["exploit"].columns)


def dedupe_vendors(vendor: DataFrame) -> DataFrame:
    return dedupe(vendor, [F.lower(F.trim("name"))], "vendor_id")
