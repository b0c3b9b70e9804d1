"""Entity resolution: mentions, groups by name, one-hop alias merges, canonical entities, the alias index.

Every step is a keyed aggregation or an equi-join. The greedy merge, which visits names in collation
order, has a closed form: a name k has one edge to the only owner o of k as an alias, if o sorts after k;
o is absorbed if some k with an edge to it is not absorbed itself, and the smallest such k absorbs it.
Names whose predecessors are decided are decided together, level by level; chains are short."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as X

LOCALE = "UNICODE"


def collated(c: Column) -> Column:
    return F.collate(c, LOCALE)


def rank(c: Column, order: tuple[str, ...]) -> Column:
    out = F.when(c == order[0], 0)
    for i, v in enumerate(order[1:], 1):
        out = out.when(c == v, i)
    return out.otherwise(0)


def unrank(c: Column, order: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, order)), (c + 1).cast("int"))


def provenance(excerpt: Column | None = None, sourceId="sourceId", segmentId="segmentId", ordinal="ordinal", locator="locator") -> Column:
    """The lineage struct; an empty excerpt counts as none."""
    quoted = F.lit(None).cast("string") if excerpt is None else F.when(excerpt != "", excerpt)
    return F.struct(F.col(sourceId).alias("sourceId"), F.col(segmentId).alias("segmentId"), F.col(ordinal).cast("int").alias("segmentOrdinal"), F.col(locator).alias("locator"), quoted.alias("excerpt"))


def located(extractions: DataFrame, segments: DataFrame) -> DataFrame:
    """Extractions with their segment's place; those of unknown segments are left out."""
    where = segments.select(F.col("id").alias("segmentId"), "sourceId", "ordinal", "locator")
    return extractions.join(where, "segmentId")


def each(rows: DataFrame, column: str, *names: str) -> DataFrame:
    """A row for each element of a list with the place of its segment: pos and the element, by names.

    The outer form: from the other one a filter would be inferred, which builds the list once more next to the scan."""
    out = rows.select("sourceId", "segmentId", "ordinal", "locator", F.posexplode_outer(column).alias(*names))
    return out.filter(F.col(names[0]).isNotNull())


def mentions(extractions: DataFrame, segments: DataFrame, unicode: bool = True) -> DataFrame:
    """A row for each entity mention: its segment's place, pos, its own fields, and its key."""
    rows = each(located(extractions, segments), "entities", "pos", "e")
    rows = rows.select("sourceId", "segmentId", "ordinal", "locator", "pos", "e.*")
    return rows.withColumn("key", F.concat_ws(":", "category", X.identity(F.col("name"), unicode)))


def alias_owners(mentions: DataFrame, unicode: bool = True) -> DataFrame:
    """(alias_key, owners): the keys of mentions that list a name as an alias, by category."""
    rows = mentions.select("key", "category", F.explode("aliases").alias("alias"))
    return rows.withColumn("alias_key", F.concat_ws(":", "category", X.identity(F.col("alias"), unicode))).groupBy("alias_key").agg(F.array_sort(F.collect_set("key")).alias("owners"))


def merge_edges(keys: DataFrame, owners: DataFrame) -> DataFrame:
    """(k, o): k may absorb o."""
    one = owners.filter(F.size("owners") == 1).select(F.col("alias_key").alias("k"), F.col("owners")[0].alias("o"))
    known = keys.select(F.col("key").alias("k"))
    return one.join(known, "k").filter(collated(F.col("o")) > collated(F.col("k")))


def checkpoint_dir(df: DataFrame) -> None:
    """Sets a local folder for checkpoints only where the session has none and all runs on one machine."""
    context = df.sparkSession.sparkContext
    named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is not None:
        return
    if not named and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(named or f"{tempfile.gettempdir()}/quillgraph-checkpoints")


def greedy_merge(keys: DataFrame, edges: DataFrame) -> DataFrame:
    """(key, group): the key whose group each key ends up in."""
    checkpoint_dir(keys)
    edges = edges.checkpoint()
    waiting = edges.select(F.col("o").alias("key")).distinct()
    state = keys.select("key").distinct().join(waiting.withColumn("w", F.lit(True)), "key", "left").select("key", F.when(F.col("w").isNull(), F.lit(False)).alias("absorbed")).checkpoint()
    while True:
        known = edges.join(state.select(F.col("key").alias("k"), F.col("absorbed").alias("gone")), "k")
        per = known.groupBy("o").agg(F.every(F.col("gone").isNotNull()).alias("ready"), F.bool_or(F.coalesce(~F.col("gone"), F.lit(False))).alias("taken"))
        new = state.join(per.withColumnRenamed("o", "key"), "key", "left").select("key", F.coalesce("absorbed", F.when(F.col("ready"), F.col("taken"))).alias("absorbed")).checkpoint()
        if new.filter(F.col("absorbed").isNull()).isEmpty():
            break
        state = new
    free = edges.join(new.filter(~F.col("absorbed")).select(F.col("key").alias("k")), "k")
    by = free.groupBy("o").agg(F.min_by("k", collated(F.col("k"))).alias("by"))
    return new.join(by.withColumnRenamed("o", "key"), "key", "left").select("key", F.coalesce("by", "key").alias("group"))


def terms(mentions: DataFrame) -> DataFrame:
    """(key, category, aliases) of mentions, those that repeat once: all that merging looks at, written so that it is read from there."""
    checkpoint_dir(mentions)
    return mentions.select("key", "category", "aliases").distinct().checkpoint()


def group_mentions(mentions: DataFrame, unicode: bool = True, known: DataFrame | None = None) -> DataFrame:
    """mentions with group and seq, its place in the group: by ordinal, then the group's own key first, then text order.

    known: terms(), if they are there already."""
    known = terms(mentions) if known is None else known
    keys = known.select("key").distinct()
    groups = greedy_merge(keys, merge_edges(keys, alias_owners(known, unicode)))
    order = W.partitionBy("group").orderBy("ordinal", F.col("key") != F.col("group"), "sourceId", "segmentId", "pos")
    return mentions.join(groups, "key").withColumn("seq", F.row_number().over(order))


def alias_collisions(owners: DataFrame) -> DataFrame:
    return owners.filter(F.size("owners") > 1).select(F.concat(F.lit("Alias "), "alias_key", F.lit(" maps to "), F.array_join("owners", ", ")).alias("message"), "alias_key")


def first_by(value: str, *keys: Column) -> Column:
    return F.min_by(value, F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]))


def canonical(grouped: DataFrame, unicode: bool = True) -> DataFrame:
    """One row for each group: category, canonicalName and the folded fields, without an id yet."""
    seq = F.col("seq")
    rows = grouped.withColumn("prov", provenance(F.col("excerpt")))
    # the longest summary, the first of equals
    folded = rows.groupBy("group").agg(
        F.min_by("category", seq).alias("category"),
        first_by("name", -X.capitalised(F.col("name")), collated(F.col("name")), seq).alias("canonicalName"),
        F.flatten(F.collect_list(F.concat(F.array("name"), "aliases"))).alias("names"),
        F.max_by("summary", F.struct(F.length("summary"), -seq)).alias("summary"),
        unrank(F.max(rank(F.col("salience"), schemas.SALIENCE)), schemas.SALIENCE).alias("salience"),
        unrank(F.max(rank(F.col("certainty"), schemas.CERTAINTY)), schemas.CERTAINTY).alias("certainty"),
        F.min_by("prov", F.struct("ordinal", seq)).alias("firstSeen"),
    )
    seen = rows.groupBy("group", "segmentId", F.coalesce("prov.excerpt", F.lit("")).alias("x")).agg(F.min(F.struct("seq", "prov")).alias("p"))
    seen = seen.groupBy("group").agg(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["prov"]).alias("mentions"))
    named = folded.select("group", "canonicalName", F.explode(F.array_distinct("names")).alias("alias"))
    other = named.filter(X.identity(F.col("alias"), unicode) != X.identity(F.col("canonicalName"), unicode))
    aliases = other.groupBy("group").agg(F.transform(F.array_sort(F.collect_list(F.struct(collated(F.col("alias")).alias("c"), "alias"))), lambda s: s["alias"]).alias("aliases"))
    out = folded.drop("names").join(seen, "group").join(aliases, "group", "left")
    return out.withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))


def with_ids(entities: DataFrame) -> DataFrame:
    """entities with id: category and slug, and part of the name's hash from the second of equals on."""
    base = F.concat_ws("-", "category", X.slugify(F.col("canonicalName")))
    rows = entities.withColumn("base", base)
    again = F.row_number().over(W.partitionBy("base").orderBy(collated(F.col("group"))))
    tail = F.substring(X.sha256(F.col("canonicalName")), 1, 8)
    return rows.withColumn("id", F.when(again == 1, F.col("base")).otherwise(F.concat_ws("-", "base", tail))).drop("base")


def attribute_values(grouped: DataFrame) -> DataFrame:
    """(group, seq, name, value, json) of every attribute of every mention."""
    rows = grouped.select("group", "seq", F.explode(F.from_json(F.to_json("attributes"), "map<string,variant>")).alias("name", "value"))
    return rows.withColumn("json", F.to_json("value"))


def merge_attributes(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((group, attributes), conflicts (group, seq, name)): the first value of a name stays, later different ones conflict.

    Values are compared with their keys sorted."""
    over = W.partitionBy("group", "name").orderBy("seq")
    marked = values.withColumn("first", F.first("json").over(over)).withColumn("n", F.row_number().over(over))
    kept = marked.filter("n = 1").groupBy("group").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "json")))).alias("j"))
    kept = kept.select("group", F.transform_values("j", lambda _, v: F.parse_json(v)).alias("attributes"))
    return kept, marked.filter(F.col("json") != F.col("first")).select("group", "seq", "name")


def alias_index(entities: DataFrame, unicode: bool = True) -> DataFrame:
    """(name, owners): the entities that each name, canonical or alias, belongs to, over all categories."""
    rows = entities.select("id", F.explode(F.concat(F.array("canonicalName"), "aliases")).alias("n"))
    return rows.groupBy(X.identity(F.col("n"), unicode).alias("name")).agg(F.array_sort(F.collect_set("id")).alias("owners"))


def unambiguous(index: DataFrame) -> DataFrame:
    return index.filter(F.size("owners") == 1).select("name", F.col("owners")[0].alias("entity"))


def resolve(rows: DataFrame, column: str, out: str, index: DataFrame, when: Column | None = None, unicode: bool = True) -> DataFrame:
    """rows with out, the only entity that a name resolves to, or null; when: where to look at all."""
    name = X.identity(F.col(column), unicode)
    key = name if when is None else F.when(when, name)
    found = unambiguous(index).select(F.col("name").alias("__name"), F.col("entity").alias(out))
    return rows.withColumn("__key", key).join(found, F.col("__key") == F.col("__name"), "left").drop("__key", "__name")
