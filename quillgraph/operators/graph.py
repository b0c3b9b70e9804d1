"""The canonical graph: entities, claims, relationships, passages, questions, merges and issues."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from . import identity as I
from .collect import with_defaults
from .ordering import numbered

#: The mark of literal objects and the reason that merges give.
LITERAL = "literal:"
REASON = "Unambiguous normalized name or alias match within the same category"


@dataclass
class Graph:
    entities: DataFrame
    claims: DataFrame
    relationships: DataFrame
    passages: DataFrame
    questions: DataFrame
    merges: DataFrame
    issues: DataFrame


def literal_object(c: Column) -> Column:
    """What follows the literal mark, trimmed; null for a reference."""
    return F.when(c.startswith(LITERAL), X.trim(F.substring(c, len(LITERAL) + 1, 1 << 30)))


def _issue(rows: DataFrame, severity: str, code: Column | str, message: Column, phase: int, *order: Column, segment: Column | None = None, entity: Column | None = None) -> DataFrame:
    """order: columns as strings that sort as the issues were found."""
    none = F.lit(None).cast("string")
    return rows.select(F.lit(phase).alias("phase"), F.concat_ws("\x00", *order).alias("at"), F.lit(severity).alias("severity"), (F.lit(code) if isinstance(code, str) else code).alias("code"), message.alias("message"), (none if segment is None else segment).alias("segmentId"), (none if entity is None else entity).alias("entityId"))


def _n(c: str) -> Column:
    return F.lpad(F.col(c).cast("string"), 10, "0")


def relationships(placed: DataFrame, index: DataFrame, unicode: bool = True) -> DataFrame:
    """Every stated relationship with subjectId, objectId and literalObject; unresolved ones are still there."""
    rows = I.each(placed, "relationships", "pos", "r").select("sourceId", "segmentId", "ordinal", "locator", "pos", "r.*")
    rows = rows.withColumn("literalObject", literal_object(F.col("object")))
    rows = I.resolve(rows, "subject", "subjectId", index, unicode=unicode)
    return I.resolve(rows, "object", "objectId", index, F.col("literalObject").isNull(), unicode)


def passages(placed: DataFrame, index: DataFrame, unicode: bool = True) -> tuple[DataFrame, DataFrame]:
    """(passages, names of passages that do not resolve)."""
    rows = I.each(placed, "passages", "pos", "p").select("sourceId", "segmentId", "ordinal", "locator", "pos", "p.*")
    rows = I.resolve(rows.withColumn("speaker", F.when(F.col("speaker") != "", F.col("speaker"))), "speaker", "speakerId", index, unicode=unicode)
    named = I.resolve(rows.select("segmentId", "ordinal", "sourceId", "pos", F.posexplode("entities").alias("place", "name")), "name", "entity", index, unicode=unicode)
    linked = named.filter(F.col("entity").isNotNull()).select("segmentId", "pos", "entity").distinct().groupBy("segmentId", "pos").agg(F.transform(F.array_sort(F.collect_list(F.struct(I.collated(F.col("entity")).alias("c"), "entity"))), lambda s: s["entity"]).alias("entityIds"))
    rows = rows.join(linked, ["segmentId", "pos"], "left").withColumn("entityIds", F.coalesce("entityIds", F.array().cast("array<string>")))
    return rows, named.filter(F.col("entity").isNull())


def normalise(segments: DataFrame, extractions: DataFrame, unicode: bool = True) -> Graph:
    """The whole resolution stage as DataFrames."""
    return numbered_issues(resolve(segments, extractions, unicode))


def numbered_issues(graph: Graph) -> Graph:
    """graph with its issues' ids, which follow the order in which they were found."""
    I.checkpoint_dir(graph.issues)
    rows = graph.issues.checkpoint()  # numbering reads them twice
    every = numbered(rows, "phase", "at", "message")
    every = every.select(F.concat(F.lit("issue-"), F.col("number").cast("string")).alias("id"), "severity", "code", "message", "segmentId", "entityId")
    return replace(graph, issues=every)


def resolve(segments: DataFrame, extractions: DataFrame, unicode: bool = True) -> Graph:
    """The same, but the issues have no ids yet, only phase and at."""
    extractions = with_defaults(extractions)
    unknown = extractions.join(segments.select(F.col("id").alias("segmentId")), "segmentId", "left_anti")
    placed = I.located(extractions, segments)
    found = I.mentions(extractions, segments, unicode)
    known = I.terms(found)
    owners = I.alias_owners(known, unicode)
    grouped = I.group_mentions(found, unicode, known).checkpoint()
    entities = I.with_ids(I.canonical(grouped, unicode))
    kept, conflicts = I.merge_attributes(I.attribute_values(grouped))
    entities = entities.join(kept, "group", "left").checkpoint()
    ids = entities.select("group", F.col("id").alias("entityId"), "canonicalName")
    own = grouped.join(ids, "group")

    claims = own.select("sourceId", "segmentId", "ordinal", "locator", "entityId", F.posexplode("claims").alias("pos", "c"))
    claims = claims.select(X.stable_id("claim", F.col("entityId"), F.col("segmentId"), F.col("pos").cast("string"), F.col("c.text")).alias("id"), "entityId", F.col("c.text").alias("text"), F.col("c.certainty").alias("certainty"), I.provenance(F.col("c.excerpt")).alias("provenance"))
    merged = own.filter(X.identity(F.col("name"), unicode) != X.identity(F.col("canonicalName"), unicode))
    merges = merged.select(F.col("entityId").alias("canonicalEntityId"), F.col("name").alias("mergedName"), F.lit(REASON).alias("reason"), F.lit(True).alias("automatic")).orderBy(I.collated(F.col("mergedName")), "canonicalEntityId")

    index = I.alias_index(entities, unicode).checkpoint()
    stated = relationships(placed, index, unicode)
    linked = F.col("subjectId").isNotNull() & (F.col("objectId").isNotNull() | F.col("literalObject").isNotNull())
    edges = stated.filter(linked).select(X.stable_id("relation", F.col("segmentId"), F.col("pos").cast("string"), F.col("subject"), F.col("predicate")).alias("id"), "subjectId", "predicate", "objectId", "literalObject", "certainty", I.provenance(F.col("excerpt")).alias("provenance"))
    quoted, nameless = passages(placed, index, unicode)
    quotes = quoted.select(X.stable_id("passage", F.col("segmentId"), F.col("pos").cast("string"), F.col("title")).alias("id"), "title", "kind", "speakerId", "text", "context", "significance", "entityIds", "complete", "certainty", I.provenance(F.col("text")).alias("provenance"))
    asked = I.each(placed, "openQuestions", "pos", "text")
    questions = asked.select(X.stable_id("question", F.col("segmentId"), F.col("pos").cast("string"), F.col("text")).alias("id"), "text", I.provenance().alias("provenance"))

    segment, lost, unlinked = F.col("segmentId"), F.col("subjectId").isNull(), stated.filter(~linked)
    issues = [
        _issue(unknown, "error", "unknown-segment", F.concat(F.lit("Extraction references "), segment), 1, segment),
        _issue(I.alias_collisions(owners), "review", "alias-collision", F.col("message"), 2, F.col("alias_key")),
        _issue(conflicts.join(ids, "group"), "review", "attribute-conflict", F.concat(F.lit("Conflicting "), "name", F.lit(" values for "), "entityId"), 3, F.col("group"), _n("seq"), F.col("name"), entity=F.col("entityId")),
        _issue(index.filter(F.size("owners") > 1), "review", "global-alias-collision", F.concat("name", F.lit(" maps to "), F.array_join("owners", ", ")), 4, F.col("name")),
        _issue(unlinked, "error", F.when(lost, "unresolved-subject").otherwise("unresolved-object"), F.when(lost, F.concat(F.lit("Cannot resolve relationship subject "), "subject")).otherwise(F.concat(F.lit("Cannot resolve relationship object "), "object")), 5, F.col("sourceId"), _n("ordinal"), F.lit("1"), _n("pos"), segment=segment),
        _issue(nameless, "review", "unresolved-passage-entity", F.concat(F.lit("Cannot resolve passage entity "), "name"), 5, F.col("sourceId"), _n("ordinal"), F.lit("2"), _n("pos"), _n("place"), segment=segment),
    ]
    every = issues[0]
    for more in issues[1:]:
        every = every.unionByName(more)
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))
    nodes = entities.select("id", "category", "canonicalName", "aliases", "summary", "salience", "certainty", "firstSeen", "mentions", F.coalesce("attributes", none).alias("attributes"))
    return Graph(nodes, claims, edges, quotes, questions, merges, every)


def provenances(graph: Graph) -> DataFrame:
    """The lineage of mentions, claims, relationships and passages, one row each."""
    rows = graph.entities.select(F.explode("mentions").alias("p"))
    for t in (graph.claims, graph.relationships, graph.passages):
        rows = rows.unionByName(t.select(F.col("provenance").alias("p")))
    return rows.select("p.*")
