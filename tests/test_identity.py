import random

from pyspark.sql import functions as F

from quillgraph.functions import text as X
from quillgraph.operators import identity as I


def scan(owners: dict[str, set[str]], keys: list[str]) -> dict[str, str]:
    """The greedy visit of names in order, one absorption each."""
    used, out = set(), {}
    for k in sorted(keys):
        if k in used:
            continue
        used.add(k)
        out[k] = k
        if len(owners.get(k, ())) == 1:
            (o,) = owners[k]
            if o != k and o not in used:
                out[o] = k
                used.add(o)
    return out


def test_greedy_merge_against_a_scan(spark):
    rng = random.Random(5)
    rows, expected = [], {}
    for case in range(60):
        names = [chr(97 + i) for i in range(rng.randint(1, 7))]
        listed = {n: rng.sample(names + ["zz"], rng.randint(0, min(3, len(names)))) for n in names}
        owners: dict[str, set[str]] = {}
        for n, aliases in listed.items():
            rows.append((f"c{case}", n, aliases))
            for a in aliases:
                owners.setdefault(a, set()).add(n)
        expected |= {f"c{case}:{k}": f"c{case}:{g}" for k, g in scan(owners, names).items()}
    m = spark.createDataFrame(rows, "category string, name string, aliases array<string>").withColumn("key", F.concat_ws(":", "category", X.identity(F.col("name"))))
    got = {r.key: r.group for r in I.greedy_merge(m, I.merge_edges(m, I.alias_owners(m))).collect()}
    assert got == expected


def test_preferred_names_and_folds(spark):
    rows = [
        ("s", "s-1", 2, "l", 0, "croquet", "game", [], "short", "reference", "inferred", "x"),
        ("s", "s-0", 1, "l", 0, "Croquet", "game", ["The Game"], "longer summary", "supporting", "unresolved", "y"),
        ("s", "s-0", 1, "l", 1, "croquet", "game", ["croquet"], "also a summary", "reference", "explicit", "y"),
    ]
    m = spark.createDataFrame(rows, "sourceId string, segmentId string, ordinal int, locator string, pos int, name string, category string, aliases array<string>, summary string, salience string, certainty string, excerpt string")
    g = I.group_mentions(m.withColumn("key", F.concat_ws(":", "category", X.identity(F.col("name")))))
    e = I.with_ids(I.canonical(g)).first()
    assert (e.id, e.canonicalName, e.aliases, e.summary, e.salience, e.certainty) == ("game-croquet", "Croquet", ["The Game"], "longer summary", "supporting", "explicit")
    assert e.firstSeen.segmentId == "s-0" and [p.segmentId for p in e.mentions] == ["s-0", "s-1"]


def test_equal_slugs_get_distinct_ids(spark):
    rows = spark.createDataFrame([("a", "item", "Gull!"), ("b", "item", "Gull?")], "group string, category string, canonicalName string")
    ids = [r.id for r in I.with_ids(rows).orderBy("group").collect()]
    assert ids[0] == "item-gull" and ids[1].startswith("item-gull-") and len(ids[1]) == len("item-gull-") + 8


def test_first_attribute_value_stays(spark):
    rows = [("g", 1, "k", "1"), ("g", 2, "k", "2"), ("g", 3, "k", "1"), ("g", 2, "m", '{"b":1,"a":2}'), ("g", 3, "m", '{"a":2,"b":1}')]
    v = spark.createDataFrame(rows, "group string, seq int, name string, raw string").select("group", "seq", "name", F.parse_json("raw").alias("value")).withColumn("json", F.to_json("value"))
    kept, conflicts = I.merge_attributes(v)
    assert kept.select(F.to_json("attributes").alias("j")).first().j == '{"k":1,"m":{"a":2,"b":1}}'
    assert [(r.seq, r.name) for r in conflicts.collect()] == [(2, "k")]
