"""The driver's tables as the engine's: which columns stand for segments, mentions, names and lineage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_drafts(docs: DataFrame) -> DataFrame:
    """Each line of a document of 20 characters or more as a draft segment."""
    lines = docs.filter(F.col("text").isNotNull()).select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("sourceId"), F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    rows = lines.filter(F.length("text") >= 20)
    return rows.select("sourceId", "pos", F.lit("").alias("title"), "text", F.concat_ws("#", "sourceId", F.col("pos").cast("string")).alias("locator"))


def part_mentions(part: DataFrame) -> DataFrame:
    """Parts as entity mentions: type as category, name as name, brand as alias, key as ordinal."""
    key = F.col("p_partkey")
    name = F.initcap("p_name")
    return part.select(
        F.lit("part").alias("sourceId"), F.concat(F.lit("part-"), key.cast("string")).alias("segmentId"), key.cast("int").alias("ordinal"), F.lit("part").alias("locator"), F.lit(0).alias("pos"),
        F.when(key % 3 == 0, name).otherwise(F.col("p_name")).alias("name"), F.col("p_type").alias("category"), F.array("p_brand").alias("aliases"),
        F.concat(F.col("p_brand"), F.lit(" of size "), F.col("p_size").cast("string")).alias("summary"),
        F.when(F.col("p_size") > 40, "primary").when(F.col("p_size") > 20, "supporting").otherwise("reference").alias("salience"),
        F.when(F.col("p_retailprice") > 1500, "explicit").when(F.col("p_retailprice") > 1000, "inferred").otherwise("unresolved").alias("certainty"),
        F.col("p_name").alias("excerpt"),
    )


def event_attributes(events: DataFrame) -> DataFrame:
    """Events as attribute values of a user, in the order of their ids."""
    rows = events.filter(F.col("props").isNotNull())
    attributes = F.from_json("props", "map<string,string>")
    return rows.select(F.col("user_id").alias("group"), F.col("event_id").alias("seq"), F.explode(attributes).alias("name", "raw")).select("group", "seq", "name", F.parse_json("raw").alias("value"), F.col("raw").alias("json"))


def place_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations and regions as entities; a nation has its number as an alias."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    n = nation.select(F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("canonicalName"), F.array(F.concat(F.lit("zone "), (F.col("n_nationkey") % 20).cast("string"))).alias("aliases"))
    r = region.select(F.concat(F.lit("region-"), F.col("r_regionkey").cast("string")).alias("id"), F.col("r_name").alias("canonicalName"), F.array().cast("array<string>").alias("aliases"))
    return n.unionByName(r)


def _character_runs(docs: DataFrame, sizes: list[int], piece: int = 1 << 16) -> DataFrame:
    """(doc_id, k) of all runs of so many characters of a text, those of each piece of it once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in enumerate(batch.column(1).to_pylist()):
                for at in range(0, max(1, len(text)), piece):
                    found = {text[i : i + g] for g in sizes for i in range(at, min(at + piece, len(text) - g + 1))}
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([row] * len(found), pa.int64())), pa.array(list(found), pa.string())], ["doc_id", "k"])

    return docs.select("doc_id", "text").mapInArrow(run, StructType([docs.schema["doc_id"], StructField("k", StringType())]))


#: Keys of items that are sent along as a set at most.
FEW_KEYS = 10_000


def quotations(docs: DataFrame, items: DataFrame, words: int = 6) -> DataFrame:
    """(item_id, doc_id) of items that stand verbatim in a document.

    The items' second to seventh words are a key: documents yield all runs of as many words, so the match is
    an equi-join on a hash, and only pairs that share it are searched for the whole item. The first and the
    last word of an item can be parts of a document's; items without as many words between them have their
    first twelve characters, or all if they are fewer, as a key instead."""
    split = lambda c: F.split(F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " ")), " ")
    hashes = lambda w: F.transform(w, lambda x: F.xxhash64(x))
    run = lambda h, at: F.xxhash64(*[F.get(h, at + k) for k in range(words)])  # noqa: E731  h: hashes of words
    texts = docs.filter(F.col("text").isNotNull())
    cut = items.filter(F.col("text").isNotNull()).withColumn("w", split("text"))
    keyed = cut.filter(F.size("w") > words + 1).select("item_id", F.col("text").alias("item"), run(hashes(F.slice("w", 2, words)), F.lit(0)).alias("k"))
    split_docs = texts.select("doc_id", hashes(split("text")).alias("h"))
    runs = split_docs.select("doc_id", F.when(F.size("h") >= words, F.transform(F.sequence(F.lit(0), F.size("h") - words), lambda i: run(F.col("h"), i))).alias("ks"))
    wanted = [r.k for r in keyed.select("k").distinct().limit(FEW_KEYS + 1).collect()]
    if len(wanted) <= FEW_KEYS:  # then runs that no item has are left out before they become rows
        runs = runs.withColumn("ks", F.filter("ks", lambda k: k.isin(wanted) if wanted else F.lit(False)))
    # the outer form: from the other one a filter would be inferred that computes the hashes again for each run
    met = runs.select("doc_id", F.explode_outer("ks").alias("k")).join(keyed.select("k"), "k", "left_semi").distinct()
    pairs = met.join(keyed, "k").select("doc_id", "item_id", "item")
    short = cut.filter(F.size("w") <= words + 1).select("item_id", F.col("text").alias("item"), F.substring("text", 1, 12).alias("k"))
    sizes = sorted(r[0] for r in short.select(F.length("k")).distinct().collect())  # at most 13
    if sizes:
        met = _character_runs(texts, sizes).join(short.select("k"), "k", "left_semi").distinct()
        pairs = pairs.unionByName(met.join(short, "k").select("doc_id", "item_id", "item"))
    return pairs.join(docs.select("doc_id", "text"), "doc_id").filter(F.contains("text", "item")).select("item_id", "doc_id").distinct()
