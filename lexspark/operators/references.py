"""The reference graph: resolution, reach in hops, and renames with their guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.functions import ids
from lexspark.functions.scratch import folder
from lexspark.functions.text import compact_name


def has_head(provision: Column, head: Column) -> Column:
    """The id is the head itself or goes on after it with # or :."""
    return F.startswith(provision, head) & F.substr(provision, F.length(head) + 1, F.lit(1)).isin("", "#", ":")


def swap_head(provision: Column, old: Column, new: Column) -> Column:
    return F.when(has_head(provision, old), F.concat(new, F.substr(provision, F.length(old) + 1))).otherwise(provision)


def resolve(edges: DataFrame, provisions: DataFrame, reference: str = "reference_id", provision: str = "provision_id") -> DataFrame:
    """edges with `resolved`: some provision has the referenced id."""
    there = provisions.select(F.col(provision).alias(reference), F.lit(True).alias("resolved")).distinct()
    return edges.join(there, reference, "left").withColumn("resolved", F.coalesce("resolved", F.lit(False)))


def reach(edges: DataFrame, start: DataFrame, hops: int) -> DataFrame:
    """(source, target, hops): targets within so many hops, each at its fewest."""
    step = edges.select(F.col("source").alias("m"), F.col("target").alias("t")).distinct()
    found = start.select(F.col("source"), F.col("source").alias("target"), F.lit(0).alias("hops"))
    front = found
    for k in range(1, hops + 1):
        front = front.join(step, front["target"] == step["m"]).select("source", F.col("t").alias("target")).distinct().join(found.select("source", "target"), ["source", "target"], "left_anti").withColumn("hops", F.lit(k))
        found = found.unionByName(front)
    return found.where("hops > 0")


def head_of(provision: Column) -> Column:
    """What stands before the unit in an id."""
    return F.regexp_extract(provision, r"^([^#]*)", 1)


def rename_heads(records: DataFrame) -> DataFrame:
    """domain, law_id, old_head, new_head and at (the first line) of rename records (doc_target, old_name, new_name); names that compare equal are no rename."""
    target = F.coalesce("doc_target", F.lit(""))
    prefix = F.when(target.isin("", "eflaw", "law"), "law").when(target == "admrul", "admrul").otherwise("SchlPubRul")
    head = lambda c: F.concat(prefix, F.lit(":"), compact_name(F.col(c)))
    line = F.col("line_no") if "line_no" in records.columns else F.lit(0)
    out = records.select(ids.route(F.col("doc_target"), F.col("law_id"), F.col("domain")).alias("domain"), "law_id", head("old_name").alias("old_head"), head("new_name").alias("new_head"), line.cast("long").alias("at"))
    return out.where("old_head <> new_head").groupBy("domain", "law_id", "old_head", "new_head").agg(F.min("at").alias("at"))


def final_heads(moves: DataFrame) -> DataFrame:
    """old_head and new_head (where references to it end) of moves (old_head, new_head, at), one after the other: a to b, then b to c takes a to c.

    Every move points at the first later move from where it leads. Pointers are doubled, so that a chain of n moves takes log2(n) rounds;
    each is written, as moves are few and plans would double, too. Of several first moves of a head the last by name counts.
    """
    spark = moves.sparkSession
    m = moves.groupBy("old_head", "at").agg(F.max("new_head").alias("head"))
    later = m.select(F.col("old_head").alias("head"), F.col("at").alias("then"))
    step = m.join(later, "head", "left").groupBy("old_head", "at", "head").agg(F.min(F.when(F.col("then") > F.col("at"), F.col("then"))).alias("then"))
    step = step.select("old_head", "at", "head", F.when(F.col("then").isNotNull(), F.col("head")).alias("from"), "then")
    base, n = folder(spark, "heads"), 0
    while True:
        step.write.parquet(f"{base}/{n}")
        step = spark.read.parquet(f"{base}/{n}")
        if step.where("then is not null").isEmpty():
            break
        far = step.select(F.col("old_head").alias("from"), F.col("at").alias("then"), F.col("head").alias("__head"), F.col("from").alias("__from"), F.col("then").alias("__then"))
        step = step.join(far, ["from", "then"], "left").select("old_head", "at", F.coalesce("__head", "head").alias("head"), F.col("__from").alias("from"), F.col("__then").alias("then"))
        n += 1
    return step.groupBy("old_head").agg(F.min_by("head", "at").alias("new_head")).where("old_head <> new_head")


def _told(columns: list[str]) -> Column:
    """All ids that a stored row refers to, in whichever of its columns."""
    none = F.array().cast("array<string>")
    refs = F.coalesce("reference_ids", none)
    if "relation_refs" in columns:
        refs = F.array_union(refs, F.coalesce(F.transform("relation_refs", lambda r: r["reference_id"]), none))
    if "meta" in columns:
        refs = F.array_union(refs, F.regexp_extract_all(F.coalesce("meta", F.lit("")), F.lit(r'"reference_id":"((?:[^"\\\\]|\\\\.)*)"'), F.lit(1)))
    return F.array_distinct(refs)


def referring(rows: DataFrame, renames: DataFrame) -> DataFrame:
    """Rows with a reference to an old head of renames. Ids and references alone are read where the caller asks for no more."""
    old = renames.select(F.col("old_head").alias("__head")).distinct()
    told = rows.withColumn("__ref", F.explode(_told(rows.columns))).withColumn("__head", head_of(F.col("__ref")))
    return told.join(old, "__head", "left_semi").select(*rows.columns)


def apply_renames(rows: DataFrame, renames: DataFrame, key: str = "uuid", elsewhere: DataFrame | None = None) -> DataFrame:
    """rows after renames of documents: their own rows under the old head go, and references to it move to the new one.

    rows: key, domain, law_id, provision_id, reference_ids (and relation_refs, whose reference_id moves along, and meta,
    JSON of which holds such relations). renames: domain, law_id, old_head, new_head, and at where their order counts. Where other rows still bear the old head a reference to it may mean them: it
    stays. Only rows with a reference that moves are rewritten; applying a rename again changes nothing. elsewhere:
    rows (provision_id) of the same table that aren't in rows, but may bear an old head.
    """
    own = renames.select("domain", "law_id", F.col("old_head").alias("__head")).distinct()
    kept = rows.withColumn("__head", head_of(F.col("provision_id"))).join(own, ["domain", "law_id", "__head"], "left_anti")
    alive = kept.select("__head")
    if elsewhere is not None:
        alive = alive.unionByName(elsewhere.select(head_of(F.col("provision_id")).alias("__head")))
    alive = alive.distinct()
    at = F.col("at") if "at" in renames.columns else F.lit(0).cast("long")
    moves = renames.select("old_head", "new_head", at.alias("at")).join(alive.withColumnRenamed("__head", "old_head"), "old_head", "left_anti")
    moves = final_heads(moves).select(F.col("old_head").alias("__head"), F.col("new_head").alias("__new"))
    kept = kept.drop("__head")
    more, told = "relation_refs" in rows.columns, "meta" in rows.columns
    flat = kept.select(key, F.explode(_told(rows.columns)).alias("ref")).where("ref is not null").withColumn("__head", head_of(F.col("ref"))).join(moves, "__head")
    moved = flat.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("ref", F.concat("__new", F.expr("substring(ref, length(__head) + 1)"))))).alias("__moved"))
    out = kept.join(moved, key, "left")
    to = lambda r: F.coalesce(F.element_at("__moved", r), r)
    touched = F.col("__moved").isNotNull()
    out = out.withColumn("reference_ids", F.when(touched, F.transform("reference_ids", to)).otherwise(F.col("reference_ids")))
    if more:
        out = out.withColumn("relation_refs", F.when(touched, F.transform("relation_refs", lambda r: r.withField("reference_id", to(r["reference_id"])))).otherwise(F.col("relation_refs")))
    if told:
        quoted = lambda r: F.concat(F.lit('"reference_id":"'), r, F.lit('"'))
        swap = F.aggregate(F.map_entries("__moved"), F.col("meta"), lambda m, e: F.replace(m, quoted(e["key"]), quoted(e["value"])))
        out = out.withColumn("meta", F.when(touched & F.col("meta").isNotNull(), swap).otherwise(F.col("meta")))
    return out.select(*rows.columns)


def unambiguous(renames: DataFrame, rows: DataFrame) -> DataFrame:
    """Renames whose old head no row bears any more."""
    heads = rows.select(head_of(F.col("provision_id")).alias("old_head")).distinct()
    return renames.join(heads, "old_head", "left_anti")


def self_reference_faults(relations: DataFrame, articles: DataFrame) -> DataFrame:
    """Relations of a document to an article of its own that it doesn't have, where it has numbered articles at all.

    relations: doc, target_doc, target_unit; articles: doc, unit (JO0001 and so on).
    """
    numbered = articles.where(F.startswith("unit", F.lit("JO"))).select("doc").distinct()
    own = relations.where(F.col("doc") == F.col("target_doc")).where(F.startswith("target_unit", F.lit("JO")))
    return own.join(numbered, "doc", "left_semi").join(articles.select("doc", F.col("unit").alias("target_unit")).distinct(), ["doc", "target_unit"], "left_anti")


def drop_phantoms(relations: DataFrame, articles: DataFrame) -> DataFrame:
    """relations without those of self_reference_faults."""
    bad = self_reference_faults(relations, articles).select("doc", "target_doc", "target_unit").distinct()
    return relations.join(bad, ["doc", "target_doc", "target_unit"], "left_anti").select(*relations.columns)
