"""Projection of the graph to linked Markdown pages, as a DataFrame (path, content).

Each kind of page is one aggregation by its subject: neighbours are joined by key, turned into lines, and
put in order inside the group. The disjunctive match of passages (speaker or linked) is one exploded key."""

from __future__ import annotations

import os
from collections.abc import Callable, Collection, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from .graph import Graph
from .identity import collated
from .ordering import numbered
from .taxonomy import Taxonomy

#: Lines of an index page at most, where an index may be several pages; of a block of lines elsewhere.
INDEX_LINES = 100_000
#: Kinds of pages; indexes are of chapters, entities and passages.
KINDS = ("home", "chapters", "entities", "passages", "indexes", "taxonomy")


def front_matter(*pairs: tuple[str, Column]) -> Column:
    """YAML lines of quoted strings, numbers and lists."""
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in pairs]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n\n"))


def quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit('"'))


def listed(c: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(c, quoted), ", "), F.lit("]"))


def page(front: Column, *body: Column | str) -> Column:
    text = F.concat_ws("\n", *[F.lit(b) if isinstance(b, str) else b for b in body])
    return F.concat(front, X.trim(text), F.lit("\n"))


def link(path: Column, label: Column) -> Column:
    return F.concat(F.lit("[["), path, F.lit("|"), label, F.lit("]]"))


def quote(excerpt: Column, include: bool, most: int) -> Column:
    """A dash and the quoted excerpt, if there is one to show."""
    return F.when(F.lit(include) & (F.coalesce(F.length(excerpt), F.lit(0)) > 0), F.concat(F.lit(" — “"), X.truncate(excerpt, most), F.lit("”"))).otherwise("")


def in_order(rows: DataFrame, key: str, line: Column, *order: Column, out: str = "lines") -> DataFrame:
    """(key, lines): each key's lines in order."""
    items = F.array_sort(F.collect_list(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], line.alias("line"))))
    return rows.groupBy(key).agg(F.transform(items, lambda x: x["line"]).alias(out))


def entity_paths(entities: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """(id, path): folder and slug; from the second of equals on with the end of the id."""
    folders = F.broadcast(taxonomy.tables(entities.sparkSession)[0].select("category", "folder"))
    base = F.concat_ws("/", F.coalesce("folder", F.lit("Other")), X.slugify(F.col("canonicalName")))
    rows = entities.select("id", "category", "canonicalName").join(folders, "category", "left").withColumn("base", base)
    again = F.row_number().over(W.partitionBy("base").orderBy(collated(F.col("id"))))
    return rows.select("id", F.when(again == 1, F.col("base")).otherwise(F.concat_ws("-", "base", F.right("id", F.lit(8)))).alias("path"))


def chapters(segments: DataFrame, number: Callable[[Column], Column] = X.padded) -> DataFrame:
    """(segmentId, chapter, label, title, ...) of every segment."""
    title = X.inline(F.col("title"))
    return segments.select(F.col("id").alias("segmentId"), "sourceId", "ordinal", "locator", X.chapter_path(F.col("ordinal"), F.col("title"), number).alias("chapter"), X.chapter_label(F.col("ordinal"), title).alias("label"), title.alias("title"))


def passage_links(passages: DataFrame) -> DataFrame:
    """(id, entity, path, title): a row for each entity that a passage links or that speaks it."""
    ids = F.array_distinct(F.array_compact(F.concat("entityIds", F.array("speakerId"))))
    return passages.select("id", "title", X.passage_path(F.col("title"), F.col("id")).alias("path"), F.explode(ids).alias("entity"))


def one_page(lines: DataFrame) -> DataFrame:
    """(part 0, text) of numbered lines: blocks of them are joined where they lie, then the blocks, a row each."""
    join = lambda order, c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, c))), lambda x: x[c]), "\n")
    blocks = lines.groupBy(F.floor((F.col("number") - 1) / INDEX_LINES).alias("block")).agg(join("number", "line").alias("text"))
    return blocks.groupBy().agg(join("block", "text").alias("text")).select(F.lit(0).cast("long").alias("part"), "text")


def several_pages(lines: DataFrame, path: Callable[[Column], Column], head: str) -> DataFrame:
    """(part, text) of numbered lines, INDEX_LINES each, all but the last with a link to the next."""
    part = F.floor((F.col("number") - 1) / INDEX_LINES)
    found = lines.groupBy(part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("number", "line"))).alias("all"))
    if not found.filter("part = 0").count():
        found = lines.sparkSession.createDataFrame([(0, [])], found.schema)
    last = found.agg(F.max("part")).first()[0]
    more = F.when(F.col("part") < last, F.concat(F.lit("\n- "), link(path(F.col("part") + 1), F.lit(f"{head}, continued")))).otherwise("")
    return found.select("part", F.concat(F.array_join(F.transform("all", lambda x: x["line"]), "\n"), more).alias("text"))


def render(segments: DataFrame, extractions: DataFrame, graph: Graph, taxonomy: Taxonomy, title: str, excerpts: bool = True, most: int = 280, paged: bool = True, kinds: Collection[str] = KINDS, number: Callable[[Column], Column] = X.padded) -> DataFrame:
    """kinds: which pages to make; number: how a chapter's path spells its ordinal; paged: whether an index longer than INDEX_LINES is several pages, or one whatever its length."""
    spark = segments.sparkSession
    where = chapters(segments, number)
    names = graph.entities.select("id", "canonicalName").join(entity_paths(graph.entities, taxonomy), "id")
    place = where.select("segmentId", "chapter", "label")
    pages = []
    if "home" in kinds:
        pages += [
            spark.createDataFrame([("index.md", f"# {title}\n\nA source-grounded narrative graph.\n\n## Browse\n\n- [[Chapters/index|Reading order]]\n- [[Entities|Entity index]]\n- [[Passages/index|Passage index]]\n- [[Taxonomy|Taxonomy]]\n", title, "home")], "path string, body string, title string, type string").select("path", page(front_matter(("title", quoted(F.col("title"))), ("type", F.col("type"))), F.col("body")).alias("content")),
            spark.createDataFrame([(".obsidian/app.json", "{}\n"), (".obsidian/graph.json", "{}\n")], "path string, content string"),
        ]

    def index(rows: DataFrame, path: str, head: str, line: Column, *order: Column) -> DataFrame:
        stem = path.removesuffix(".md")
        lines = numbered(rows.select(*[o.alias(f"o{i}") for i, o in enumerate(order)], line.alias("line")), *[f"o{i}" for i in range(len(order))])
        name = lambda k: F.when(k == 0, F.lit(stem)).otherwise(F.concat(F.lit(f"{stem}-"), (k + 1).cast("string")))
        found = several_pages(lines, name, head) if paged else one_page(lines)
        return found.select(F.concat(name(F.col("part")), F.lit(".md")).alias("path"), page(front_matter(("title", quoted(F.lit(head))), ("type", F.lit("index"))), f"# {head}", "", F.col("text")).alias("content"))

    if "chapters" in kinds:
        seen = graph.entities.select(F.col("id"), "canonicalName", "summary", F.explode(F.array_distinct(F.transform("mentions", lambda m: m["segmentId"]))).alias("segmentId")).join(names.drop("canonicalName"), "id")
        seen = in_order(seen, "segmentId", F.concat(link(F.col("path"), F.col("canonicalName")), F.lit(" — "), F.col("summary")), collated(F.col("id")), out="entities")
        told = graph.passages.select("id", "title", F.col("provenance.segmentId").alias("segmentId"))
        told = in_order(told, "segmentId", link(X.passage_path(F.col("title"), F.col("id")), F.col("title")), collated(F.col("id")), out="passages")
        chapter = where.join(extractions.select("segmentId", "summary", "plotBeats", "themes").dropDuplicates(["segmentId"]), "segmentId").join(seen, "segmentId", "left").join(told, "segmentId", "left")
        front = front_matter(("title", quoted(F.col("title"))), ("type", F.lit("chapter")), ("ordinal", F.col("ordinal").cast("string")), ("source", quoted(F.col("sourceId"))), ("locator", quoted(F.col("locator"))), ("tags", F.lit("[graph/chapter]")))
        body = page(front, F.concat(F.lit("# "), "title"), "", F.col("summary"), "", "## Plot beats", "", X.bullets(F.col("plotBeats")), "", "## Entities", "", X.bullets(F.col("entities")), "", "## Themes", "", X.bullets(F.col("themes")), "", "## Passages", "", X.bullets(F.col("passages")))
        pages.append(chapter.select(F.concat("chapter", F.lit(".md")).alias("path"), body.alias("content")))

    if "entities" in kinds:
        facts = graph.claims.select("id", "entityId", "text", "provenance.segmentId", "provenance.excerpt").join(place, "segmentId", "left")
        fact = F.concat("text", F.lit(" ("), link(F.col("chapter"), F.col("label")), F.lit(")"), quote(F.col("excerpt"), excerpts, most))
        facts = in_order(facts, "entityId", fact, collated(F.col("id")), out="facts").withColumnRenamed("entityId", "id")
        to = graph.relationships.join(names.select(F.col("id").alias("objectId"), F.col("path").alias("p"), F.col("canonicalName").alias("n")), "objectId", "left")
        outward = to.select(F.col("subjectId").alias("entity"), F.lit(0).alias("side"), "id", F.concat("predicate", F.lit(" → "), F.coalesce(link(F.col("p"), F.col("n")), F.col("literalObject"), F.lit("unresolved"))).alias("text"))
        of = graph.relationships.filter(F.col("objectId").isNotNull()).join(names.select(F.col("id").alias("subjectId"), F.col("path").alias("p"), F.col("canonicalName").alias("n")), "subjectId", "left")
        inward = of.select(F.col("objectId").alias("entity"), F.lit(1).alias("side"), "id", F.coalesce(F.concat(link(F.col("p"), F.col("n")), F.lit(" — "), F.col("predicate")), F.col("subjectId")).alias("text"))
        relations = in_order(outward.unionByName(inward), "entity", F.col("text"), F.col("side"), collated(F.col("id")), out="relations").withColumnRenamed("entity", "id")
        appears = graph.entities.select("id", F.posexplode("mentions").alias("pos", "m")).select("id", "pos", "m.segmentId", "m.excerpt").join(place, "segmentId", "left")
        appears = in_order(appears, "id", F.concat(link(F.col("chapter"), F.col("label")), quote(F.col("excerpt"), excerpts, most)), F.col("pos"), out="appearances")
        quotes = passage_links(graph.passages)
        spoken = in_order(quotes.withColumnRenamed("id", "passage"), "entity", link(F.col("path"), F.col("title")), collated(F.col("passage")), out="spoken").withColumnRenamed("entity", "id")
        own = graph.entities.join(names.select("id", "path"), "id").join(facts, "id", "left").join(relations, "id", "left").join(appears, "id", "left").join(spoken, "id", "left")
        extra = F.array_join(F.transform(F.map_entries(F.transform_values("attributes", lambda _, v: F.to_json(v))), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
        head = F.concat(F.lit("---\n"), F.concat_ws("\n", F.concat(F.lit("title: "), quoted(F.col("canonicalName"))), F.concat(F.lit("aliases: "), listed(F.col("aliases"))), F.concat(F.lit("type: "), "category"), F.concat(F.lit("salience: "), "salience"), F.concat(F.lit("certainty: "), "certainty"), F.concat(F.lit("firstSeen: "), F.col("firstSeen.segmentOrdinal").cast("string")), F.concat(F.lit("tags: [graph/entity, graph/"), "category", F.lit("]")), F.when(F.size("attributes") > 0, extra)), F.lit("\n---\n\n"))
        body = page(head, F.concat(F.lit("# "), "canonicalName"), "", F.col("summary"), "", "## Facts", "", X.bullets(F.col("facts")), "", "## Relationships", "", X.bullets(F.col("relations")), "", "## Appearances", "", X.bullets(F.col("appearances")), "", "## Passages", "", X.bullets(F.col("spoken")))
        pages.append(own.select(F.concat("path", F.lit(".md")).alias("path"), body.alias("content")))

    if "passages" in kinds:
        linked = graph.passages.select("id", F.posexplode("entityIds").alias("pos", "entity")).join(names.select(F.col("id").alias("entity"), "path", "canonicalName"), "entity")
        linked = in_order(linked, "id", link(F.col("path"), F.col("canonicalName")), F.col("pos"), out="linked")
        said = graph.passages.withColumn("segmentId", F.col("provenance.segmentId")).join(place, "segmentId", "left").join(linked, "id", "left")
        front = front_matter(("title", quoted(F.col("title"))), ("type", F.lit("passage")), ("kind", quoted(F.col("kind"))), ("certainty", F.col("certainty")), ("complete", F.col("complete").cast("string")), ("tags", F.concat(F.lit("[graph/passage, graph/passage/"), "kind", F.lit("]"))))
        body = page(front, F.concat(F.lit("# "), "title"), "", F.concat(F.lit("> "), X.truncate(F.col("text"), most)), "", F.col("context"), "", F.concat(F.lit("**Why it matters:** "), "significance"), "", F.concat(F.lit("**Source:** "), link(F.col("chapter"), F.col("label"))), "", "## Entities", "", X.bullets(F.col("linked")))
        pages.append(said.select(F.concat(X.passage_path(F.col("title"), F.col("id")), F.lit(".md")).alias("path"), body.alias("content")))

    if "indexes" in kinds:
        pages.append(index(where, "Chapters/index.md", "Reading order", F.concat(F.lit("- "), link(F.col("chapter"), F.concat(F.col("ordinal").cast("string"), F.lit(". "), F.col("title")))), F.col("sourceId"), F.col("ordinal")))
        pages.append(index(graph.passages, "Passages/index.md", "Passage index", F.concat(F.lit("- "), link(X.passage_path(F.col("title"), F.col("id")), F.col("title"))), collated(F.col("id"))))
        # the entity index by category, in the taxonomy's order; empty categories are left out
        categories = F.broadcast(taxonomy.tables(spark)[0])
        per = names.join(graph.entities.select("id", "category"), "id").join(categories, "category")
        part = per.select("place", F.lit(1).alias("row"), "id", F.concat(F.lit("- "), link(F.col("path"), F.col("canonicalName"))).alias("line"))
        some = per.select("place", "plural").distinct()
        part = part.unionByName(some.select("place", F.lit(0).alias("row"), F.lit("").alias("id"), F.concat(F.lit("## "), "plural", F.lit("\n")).alias("line"))).unionByName(some.select("place", F.lit(2).alias("row"), F.lit("").alias("id"), F.lit("").alias("line")))
        pages.append(index(part, "Entities.md", "Entity index", F.col("line"), F.col("place"), F.col("row"), collated(F.col("id"))))

    if "taxonomy" in kinds:
        pages.append(index(taxonomy.tables(spark)[0], "Taxonomy.md", "Taxonomy", F.concat(F.lit("## "), "plural", F.lit("\n\n"), "definition", F.lit("\n")), F.col("place")))

    out = pages[0]
    for p in pages[1:]:
        out = out.unionByName(p)
    return out


def digest(pages: DataFrame) -> tuple[int, str]:
    """(files, hash) of pages: each page is hashed where it is, the hashes in 4096 buckets by path, then the buckets'."""
    put = lambda key, value: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, value))), lambda x: F.concat(x[key], F.lit("\x00"), x[value])), "\x00"), 256)
    rows = pages.select("path", X.sha256(F.col("content")).alias("h"), F.substring(X.sha256(F.col("path")), 1, 3).alias("b"))
    rows = rows.groupBy("b").agg(F.count(F.lit(1)).alias("n"), put("path", "h").alias("h"))
    return tuple(rows.agg(F.coalesce(F.sum("n"), F.lit(0)), put("b", "h")).first())


def empty(root: str) -> None:
    """Removes all files under a folder."""
    for folder, _, files in os.walk(root, topdown=False):
        for name in files:
            os.remove(os.path.join(folder, name))


def write_pages(pages: DataFrame, root: str, clear: bool = True) -> int:
    """Writes pages as files under root, a folder that the driver and all workers share, after emptying it.

    Each partition writes its own; a task that runs again writes the same files again."""
    if clear:
        empty(root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = os.path.join(root, name)
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(path, "w", encoding="utf-8") as f:
                    f.write(content)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return pages.select("path", "content").mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

