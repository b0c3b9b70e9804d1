"""Verification gates. Each returns its failing details as a DataFrame (detail); report() counts them."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as X
from ..sources import documents
from .graph import Graph, provenances
from .taxonomy import Taxonomy


@dataclass
class Gate:
    id: str
    details: DataFrame
    passed: str
    failed: str
    status: str = "fail"  # what details mean


def _all(first: DataFrame, *more: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), more, first)


def _say(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("detail")


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Values that break the schema's constraints: empty required strings and enum members that don't exist."""
    none = F.lit(False)
    empty = lambda c: F.coalesce(F.length(F.col(c)) == 0, F.lit(True))
    bad = lambda c, values: ~F.coalesce(F.col(c).isin(*values), none)
    rules = {
        "segments": {"id": empty("id"), "sourceId": empty("sourceId"), "ordinal": ~F.coalesce(F.col("ordinal") >= 1, none), "title": empty("title"), "sha256": empty("sha256")},
        "extractions": {"segmentId": empty("segmentId"), "entities.certainty": F.exists("entities", lambda e: ~F.coalesce(e["certainty"].isin(*schemas.CERTAINTY), none)), "entities.salience": F.exists("entities", lambda e: ~F.coalesce(e["salience"].isin(*schemas.SALIENCE), none))},
        "entities": {"id": empty("id"), "category": empty("category"), "certainty": bad("certainty", schemas.CERTAINTY), "salience": bad("salience", schemas.SALIENCE)},
        "claims": {"id": empty("id"), "text": empty("text"), "certainty": bad("certainty", schemas.CERTAINTY)},
        "relationships": {"id": empty("id"), "subjectId": empty("subjectId"), "predicate": empty("predicate"), "certainty": bad("certainty", schemas.CERTAINTY)},
        "passages": {"id": empty("id"), "title": empty("title"), "kind": empty("kind"), "certainty": bad("certainty", schemas.CERTAINTY)},
        "issues": {"id": empty("id"), "severity": bad("severity", schemas.SEVERITY), "code": empty("code")},
    }
    parts = []
    for name, df in tables.items():
        if name in rules:
            found = F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(True)), F.lit(f"{name}.{field} is not valid")) for field, rule in rules[name].items()]))
            parts.append(df.select(F.explode(found).alias("detail")))
    return _all(*parts)


def coverage(segments: DataFrame, extractions: DataFrame) -> DataFrame:
    counts = extractions.groupBy(F.col("segmentId").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    wrong = segments.select("id").join(counts, "id", "left").filter(n != 1).select(_say(F.col("id"), ": ", n.cast("string"), " extraction records"))
    unknown = extractions.select(F.col("segmentId").alias("id")).join(segments.select("id"), "id", "left_anti").select(_say("Unknown extraction ", F.col("id")))
    return _all(wrong, unknown)


def ordering(segments: DataFrame, source: str = "sourceId", ordinal: str = "ordinal") -> DataFrame:
    """Sources whose ordinals are not 1 .. n. Equal counts, distinct counts and ends say so without a list of them."""
    n, low, high, kinds = F.count(F.lit(1)), F.min(ordinal), F.max(ordinal), F.count_distinct(F.col(ordinal))
    per = segments.groupBy(source).agg(n.alias("n"), low.alias("low"), high.alias("high"), kinds.alias("kinds"))
    return per.filter((F.col("low") != 1) | (F.col("high") != F.col("n")) | (F.col("kinds") != F.col("n"))).select(_say(F.col(source).cast("string"), ": ", F.col("low").cast("string"), "..", F.col("high").cast("string"), " in ", F.col("n").cast("string"), " segments"))


def matches_type(value: Column, kind: Column) -> Column:
    """Whether a variant is of a taxonomy attribute type."""
    shape = F.schema_of_variant(value)
    text = shape == "STRING"
    return (
        F.when(kind.isin("string", "entity-ref"), text)
        .when(kind == "number", shape.isin("BIGINT", "DOUBLE", "FLOAT") | shape.startswith("DECIMAL"))
        .when(kind == "boolean", shape == "BOOLEAN")
        .when(kind == "string-list", shape.isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.coalesce(F.to_json(value).rlike(r"(^\[|,)null(,|\]$)"), F.lit(False)))
        .otherwise(shape.startswith("OBJECT"))
    )


def conformance(extractions: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """Categories, attributes, passage kinds and predicates that the taxonomy lacks.

    The taxonomy is configuration, so it is part of the expressions: one scan of the extractions, no join."""
    literal = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)
    categories = literal([c["id"] for c in taxonomy.categories], "array<string>")
    types = literal({f"{c['id']}\0{k}": a["type"] for c in taxonomy.categories for k, a in c.get("attributes", {}).items()}, "map<string,string>")
    needed = literal({c["id"]: [k for k, a in c.get("attributes", {}).items() if a.get("required")] for c in taxonomy.categories}, "map<string,array<string>>")
    relations = literal(sorted({*taxonomy.relationVocabulary, *(r for c in taxonomy.categories for r in c.get("relations", []))}), "array<string>")
    kinds = literal(taxonomy.passageKinds, "array<string>")
    inside = lambda values, c: F.coalesce(F.array_contains(values, c), F.lit(False))
    say = lambda *parts: F.concat(F.col("segmentId"), *[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])

    def entity(e: Column) -> Column:
        values = F.from_json(F.to_json(e["attributes"]), "map<string,variant>")
        kind = lambda x: F.try_element_at(types, F.concat(e["category"], F.lit("\0"), x["key"]))
        value = lambda x: F.when(kind(x).isNull(), say(": ", e["category"], ".", x["key"], " is not locked")).when(~matches_type(x["value"], kind(x)), say(": ", e["category"], ".", x["key"], " has the wrong type"))
        absent = F.filter(F.try_element_at(needed, e["category"]), lambda k: ~F.coalesce(F.map_contains_key(values, k), F.lit(False)))
        none = F.array().cast("array<string>")
        found = F.concat(F.coalesce(F.transform(F.map_entries(values), value), none), F.coalesce(F.transform(absent, lambda k: say(": ", e["category"], ".", k, " is required")), none))
        return F.when(inside(categories, e["category"]), found).otherwise(F.array(say(": category ", e["category"])))

    lacking = lambda column, values, what: F.transform(F.filter(column, lambda x: ~inside(values, x)), lambda x: say(f": {what} ", x))
    parts = [F.flatten(F.transform("entities", entity)), lacking(F.col("passages.kind"), kinds, "passage kind"), lacking(F.col("relationships.predicate"), relations, "relation")]
    every = F.concat(*[F.coalesce(F.array_compact(p), F.array().cast("array<string>")) for p in parts])
    return extractions.select(F.explode_outer(every).alias("detail")).filter(F.col("detail").isNotNull()).distinct()


def excerpts(extractions: DataFrame) -> DataFrame:
    """(segmentId, excerpt) of everything that must stand verbatim in its segment."""
    quoted = F.concat(F.transform("entities", lambda e: e["excerpt"]), F.flatten(F.transform("entities", lambda e: F.transform(e["claims"], lambda c: c["excerpt"]))), F.transform("relationships", lambda r: r["excerpt"]), F.transform("passages", lambda p: p["text"]))
    return extractions.select("segmentId", F.posexplode(quoted).alias("n", "excerpt"))


def evidence(segments: DataFrame, extractions: DataFrame) -> DataFrame:
    """Excerpts that are not in their segment; an equi-join, so each is looked for in one text only."""
    rows = excerpts(extractions).join(segments.select(F.col("id").alias("segmentId"), "text"), "segmentId")
    return rows.filter(~F.contains("text", "excerpt")).select(_say(F.col("segmentId"), " excerpt ", (F.col("n") + 1).cast("string"), ": ", F.substring("excerpt", 1, 80)))


def duplicate_ids(rows: DataFrame, column: str = "id") -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def identity(entities: DataFrame, issues: DataFrame) -> DataFrame:
    twice = duplicate_ids(entities).select(_say("Duplicate ID ", F.col("id")))
    return _all(twice, issues.filter(F.col("code").contains("alias-collision")).select(F.col("message").alias("detail"))).distinct()


def endpoints(entities: DataFrame, relationships: DataFrame, key: str = "id", subject: str = "subjectId", object: str = "objectId", literal: str | None = "literalObject") -> DataFrame:
    known = entities.select(F.col(key).alias("__id"))
    name = F.col("id").cast("string")
    no_subject = relationships.join(known, F.col(subject) == F.col("__id"), "left_anti").select(_say(name, ": subject ", F.col(subject).cast("string")))
    there = F.col(object).isNotNull() & (F.col(object).cast("string") != "")
    no_object = relationships.filter(there).join(known, F.col(object) == F.col("__id"), "left_anti").select(_say(name, ": object ", F.col(object).cast("string")))
    parts = [no_subject, no_object]
    if literal:
        parts.append(relationships.filter(~there & (F.coalesce(F.length(literal), F.lit(0)) == 0)).select(_say(name, ": missing object")))
    return _all(*parts)


def provenance(segments: DataFrame, values: DataFrame) -> DataFrame:
    where = segments.select(F.col("id").alias("segmentId"), F.col("sourceId").alias("__source"))
    rows = values.join(where, "segmentId", "left")
    unknown = rows.filter(F.col("__source").isNull()).select(_say("Unknown segment ", F.col("segmentId")))
    wrong = rows.filter(F.col("__source") != F.col("sourceId")).select(_say(F.col("segmentId"), ": source mismatch"))
    return _all(unknown, wrong).distinct()


def spoilers(values: DataFrame, most: int | None) -> DataFrame:
    late = values.filter(F.col("segmentOrdinal") > most) if most is not None else values.limit(0)
    return late.select(_say(F.col("segmentId"), " is segment ", F.col("segmentOrdinal").cast("string")))


def raw_difference(names: DataFrame, segments: DataFrame) -> DataFrame:
    """names (name) of raw responses against segments (id), in both directions with one full join."""
    rows = names.select("name").distinct().join(segments.select(F.col("id")), F.col("name") == F.col("id"), "full_outer")
    return rows.filter(F.col("name").isNull() | F.col("id").isNull()).select(F.when(F.col("name").isNull(), F.concat(F.lit("Missing "), "id")).otherwise(F.concat(F.lit("Unexpected "), "name")).alias("detail"))


def broken_links(pages: DataFrame) -> DataFrame:
    """Wikilinks of Markdown pages (path, content) that lead to no page, by its path or by its name."""
    own = pages.filter(F.col("path").endswith(".md")).withColumn("page", F.regexp_replace("path", r"\.md$", ""))
    targets = own.select(F.col("page").alias("target")).unionByName(own.select(F.substring_index("page", "/", -1).alias("target"))).distinct()
    links = own.select("path", F.explode(X.wikilinks(F.col("content"))).alias("target"))
    return links.join(targets, "target", "left_anti").select(_say(F.col("path"), " -> ", F.col("target"))).distinct()


def review(issues: DataFrame) -> Gate:
    """Errors block; without any, what is left to review only warns."""
    errors = issues.filter("severity = 'error'").select(F.col("message").alias("detail"))
    if not errors.isEmpty():
        return Gate("review-queue", errors, "No review items are left", "Blocking issues")
    reviews = issues.filter("severity = 'review'").select(F.col("message").alias("detail"))
    return Gate("review-queue", reviews, "No review items are left", "Records need human review", "warning")


def found(gates: list[Gate]) -> DataFrame:
    """(id, detail) of everything that the gates found; a table, as any gate may find very much."""
    return _all(*[g.details.select(F.lit(g.id).alias("id"), "detail") for g in gates])


def report(spark: SparkSession, gates: list[Gate], details: DataFrame | None = None) -> DataFrame:
    """(id, status, message, n) in the order of gates; n: how many details there are; details: found(), if it is written already."""
    ids = spark.createDataFrame([(i, g.id, g.passed, g.failed, g.status) for i, g in enumerate(gates)], "place int, id string, passed string, failed string, bad string")
    counts = (found(gates) if details is None else details).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    rows = ids.join(counts, "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    fine = F.col("n") == 0
    return rows.orderBy("place").select("id", F.when(fine, "pass").otherwise(F.col("bad")).alias("status"), F.when(fine, F.col("passed")).otherwise(F.col("failed")).alias("message"), "n")


def passes(report: DataFrame) -> bool:
    return bool(report.agg(F.coalesce(F.every(F.col("status") != "fail"), F.lit(True))).first()[0])


def checks(segments: DataFrame, extractions: DataFrame, graph: Graph, taxonomy: Taxonomy, lock: dict | None, raw: DataFrame | None = None, pages: DataFrame | None = None, most: int | None = None) -> list[Gate]:
    """All gates in order; if values break the schema, that gate alone. raw: (name[, response]) of raw responses."""
    spark = segments.sparkSession
    broken = constraint_violations({"segments": segments, "extractions": extractions, "entities": graph.entities, "claims": graph.claims, "relationships": graph.relationships, "passages": graph.passages, "issues": graph.issues})
    if raw is not None and "response" in raw.columns:
        wrong = documents.wrong_types(raw.select("name", F.col("response").alias("line")), schemas.EXTRACTIONS, "name")
        broken = broken.unionByName(wrong.select(_say(F.col("name"), ": ", F.col("field"), " is ", F.col("found"))))
    contract = Gate("schema-contract", broken, "All artifacts follow their schemas", "Artifacts break their schemas")
    if not broken.isEmpty():
        return [contract]
    lineage = provenances(graph)
    text = "detail string"
    locked = lock is not None and lock.get("taxonomyHash") == taxonomy.hash()
    gates = [
        contract,
        Gate("source-coverage", coverage(segments, extractions), "Exactly one extraction covers each segment", "Coverage is incomplete or duplicated"),
        Gate("source-order", ordering(segments), "Ordinals are contiguous within each source", "Ordinals are not contiguous"),
        Gate("taxonomy-lock", spark.createDataFrame([] if locked else [("the taxonomy differs from its lock",)], text), "The taxonomy equals its lock", "The taxonomy differs from its lock"),
        Gate("taxonomy-conformance", conformance(extractions, taxonomy), "Every extracted type is in the locked taxonomy", "Extractions use values that are not locked"),
        Gate("evidence-exactness", evidence(segments, extractions), "Every excerpt is an exact substring of its segment", "Excerpts are not present verbatim"),
        Gate("identity", identity(graph.entities, graph.issues), "Entity ids and aliases resolve unambiguously", "Entity identity has collisions"),
        Gate("relationship-endpoints", endpoints(graph.entities, graph.relationships), "Every endpoint resolves", "Endpoints do not resolve"),
        Gate("provenance", provenance(segments, lineage), "Every record points to a segment", "Records have invalid provenance"),
        Gate("spoiler-boundary", spoilers(lineage, most), "No record exceeds the boundary", "Records exceed the boundary"),
        review(graph.issues),
    ]
    if raw is not None:
        gates.append(Gate("raw-consumption", raw_difference(raw, segments), "Every raw response is consumed once", "Raw responses do not match the segments"))
    if pages is None:
        gates.append(Gate("published-links", spark.createDataFrame([("nothing has been rendered yet",)], text), "", "Nothing has been rendered yet", "warning"))
    else:
        gates.append(Gate("published-links", broken_links(pages), "All wikilinks resolve", "Pages have broken wikilinks"))
    return gates


def verify(segments: DataFrame, *tables, **options) -> DataFrame:
    """The report of all checks()."""
    return report(segments.sparkSession, checks(segments, *tables, **options))
