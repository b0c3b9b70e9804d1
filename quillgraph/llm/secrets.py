"""Secret scans over a trigram inverted index; DataFrame functions only.

1. Each rule's regular expression is parsed once on the driver into a Boolean query over lower-case
   trigrams that every match must satisfy (None: it has no mandatory trigram and scans everything).
2. The index holds postings (trigram, document key) for the trigrams that the queries name.
3. Postings are intersected by document: a bit per trigram, OR-ed with partial aggregates, then the
   Boolean queries. The candidate table is written first, so its real size decides between a broadcast
   and a shuffled join.
4. The full expression verifies candidates and yields spans in code points, end exclusive.

Defined results: null and empty texts have no spans; repeated rows each get their own result; matches of
a rule are leftmost and don't overlap, those of different rules may; a match whose measured part is too
short is dropped after matching; a text of any length is scanned whole; spans are ordered by start, then by the rule's place in the list;
other columns pass through unless they have the name of a result, which replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as C
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep

KEY = "__secret_key"


@dataclass(frozen=True)
class Rule:
    """pattern: an expression that Java and Python read alike. Matches whose group is under least characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The three base rules, then those of common credential formats.
BASE_RULES = (
    Rule("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # a maximal run either way: shorter ones are dropped
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"sk_live_[0-9a-zA-Z]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

#: Strings that a part of an expression may expand to before it counts as unknown.
MOST_STRINGS = 64


def _and(parts: list) -> object:
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _or(parts: list) -> object:
    if any(p is None for p in parts) or not parts:
        return None
    needs = {p: set(trigrams(p)) for p in dict.fromkeys(parts)}
    plain = {p for p in needs if isinstance(p, str) or all(isinstance(x, str) for x in p[1:]) and p[0] == "and"}
    # an alternative that asks for more than a plain one does adds nothing
    parts = [p for p in needs if not any(q != p and p in plain and needs[q] < needs[p] for q in plain)]
    return parts[0] if len(parts) == 1 else ("or", *parts)


def _of_strings(strings: set[str]) -> object:
    """What any one of the strings requires."""
    return _or([_and([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _members(items) -> set[str] | None:
    out: set[str] = set()
    for op, arg in items:
        if op is C.LITERAL:
            out.add(chr(arg).lower())
        elif op is C.RANGE and arg[1] - arg[0] < MOST_STRINGS:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _sequence(items) -> tuple[set[str] | None, object]:
    """(all strings it can match, or None; the trigram query of its matches)."""
    known, whole, needs = {""}, True, []

    def flush():
        nonlocal known, whole
        needs.append(_of_strings(known))
        known, whole = {""}, False

    for op, arg in items:
        own: set[str] | None = None
        query = None
        if op is C.LITERAL:
            own = {chr(arg).lower()}
        elif op is C.IN:
            own = _members(arg)
        elif op is C.SUBPATTERN:
            own, query = _sequence(arg[3])
        elif op is C.BRANCH:
            parts = [_sequence(x) for x in arg[1]]
            own = set().union(*(p[0] for p in parts)) if all(p[0] is not None for p in parts) else None
            query = _or([_of_strings(p[0]) if p[0] is not None else p[1] for p in parts])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, inner = arg
            strings, inner_query = _sequence(inner)
            if strings is not None and high == 1:
                own = strings | {""} if low == 0 else strings
            elif low > 0:
                query = inner_query if strings is None else _of_strings(strings)
        elif op is C.AT:
            own = {""}
        if own is not None and len(known) * len(own) <= MOST_STRINGS:
            known = {a + b for a in known for b in own}
        else:
            flush()
            if own is not None:
                known = own
            else:
                needs.append(query)
    return (known if whole else None), _and([*needs, _of_strings(known)])


def trigram_query(pattern: str) -> object:
    """A Boolean query: a trigram, ("and", ...), ("or", ...), or None where nothing is mandatory."""
    return _sequence(parser.parse(pattern))[1]


def trigrams(query: object) -> list[str]:
    if query is None:
        return []
    return [query] if isinstance(query, str) else sorted({t for part in query[1:] for t in trigrams(part)})


def _holds(query: object, bit: dict[str, Column]) -> Column:
    if isinstance(query, str):
        return bit[query]
    out = _holds(query[1], bit)
    for part in query[2:]:
        out = out & _holds(part, bit) if query[0] == "and" else out | _holds(part, bit)
    return out


def postings(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """The inverted index's rows: (trigram number, document key)."""
    low = docs.select(KEY, F.lower("text").alias("low"))
    named = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(wanted)]))
    return low.select(F.explode(named).alias("trigram"), KEY)


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(document key, rules array<int>): the rules whose trigram queries the document's postings satisfy."""
    asked = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern)) is not None}
    wanted = sorted({t for q in asked.values() for t in trigrams(q)})
    words = range(-(-len(wanted) // 62))
    bits = [F.bit_or(F.when(F.floor(F.col("trigram") / 62) == w, F.expr(f"shiftleft(1L, trigram - {62 * w})")).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in words]
    met = postings(docs, wanted).groupBy(KEY).agg(*bits)
    bit = {t: F.col(f"w{i // 62}").bitwiseAND(F.lit(1 << (i % 62))) != 0 for i, t in enumerate(wanted)}
    rows = met.select(KEY, F.array_compact(F.array(*[F.when(_holds(q, bit), F.lit(i)) for i, q in asked.items()])).alias("__rules"))
    return rows.filter(F.size("__rules") > 0)


BLOCK = 256


def _spans(df: DataFrame, rule: Rule, number: int, active: Column) -> DataFrame:
    """Adds __s<number>: array<struct<start, rule, kind, end>> of the rule's verified matches."""
    m, g, p, x, lens, sums, offs = (f"__{c}{number}" for c in ("m", "g", "p", "x", "lens", "sums", "offs"))
    re = F.lit(rule.pattern)
    hit = active & F.col("text").rlike(rule.pattern)
    df = df.withColumn(x, F.coalesce(hit, F.lit(False)))
    df = df.withColumns({
        m: F.when(F.col(x), F.regexp_extract_all("text", re, F.lit(0))),
        g: F.when(F.col(x), F.regexp_extract_all("text", re, F.lit(rule.group))),
        p: F.when(F.col(x), F.split("text", rule.pattern, -1)),
    })
    # lengths in turn: text before the first match, the first match, text before the second, ...
    both = F.flatten(F.zip_with(p, m, lambda a, b: F.array(F.length(a).cast("long"), F.coalesce(F.length(b), F.lit(0)).cast("long"))))
    df = df.withColumn(lens, F.when(F.col(x), both))
    # running sums in two levels, so that many matches don't cost the square of their number
    cut = lambda b: F.slice(lens, b * BLOCK + 1, F.lit(BLOCK))
    blocks = F.sequence(F.lit(0), F.floor((F.size(lens) - 1) / BLOCK).cast("int"))
    df = df.withColumn(sums, F.when(F.col(x), F.transform(blocks, lambda b: F.aggregate(cut(b), F.lit(0).cast("long"), lambda a, v: a + v))))
    grow = lambda a, v: F.concat(a, F.array(F.element_at(a, -1) + v))
    df = df.withColumn(offs, F.when(F.col(x) & F.col(sums).isNotNull(), F.aggregate(sums, F.array(F.lit(0).cast("long")), grow)))
    inside = F.flatten(F.transform(blocks, lambda b: F.slice(F.aggregate(cut(b), F.slice(offs, b + 1, F.lit(1)), grow), F.lit(1), F.size(cut(b)))))
    df = df.withColumn(sums, F.when(F.col(x) & F.col(offs).isNotNull() & (F.size(lens) > 0), inside))
    one = lambda i: F.struct(F.element_at(F.col(sums), 2 * i + 2).alias("start"), F.lit(number).alias("rule"), F.lit(rule.kind).alias("kind"), (F.element_at(F.col(sums), 2 * i + 2) + F.length(F.element_at(F.col(m), i + 1))).alias("end"), F.length(F.element_at(F.col(g), i + 1)).alias("n"))
    every = F.transform(F.sequence(F.lit(0), F.size(m) - 1), one)
    kept = F.transform(F.filter(every, lambda s: s["n"] >= rule.least), lambda s: F.struct(s["start"].alias("start"), s["rule"].alias("rule"), s["kind"].alias("kind"), s["end"].alias("end")))
    empty = F.array().cast("array<struct<start:bigint,rule:int,kind:string,end:bigint>>")
    df = df.withColumn(f"__s{number}", F.coalesce(F.when(F.col(x) & (F.size(m) > 0), kept), empty))
    return df.drop(m, g, p, x, lens, sums, offs)


def _joined(docs: DataFrame, rules: tuple[Rule, ...]) -> tuple[DataFrame, list[Column]]:
    """Documents with their candidate rules, and for each rule the condition under which it is verified."""
    keyed = docs.withColumn(KEY, F.xxhash64(*[c for c in ("doc_id", "text") if c in docs.columns]))
    found = keep(candidates(keyed, rules))
    out = keyed.join(found, KEY, "left")
    active = [F.array_contains("__rules", i) if trigram_query(r.pattern) is not None else F.lit(True) for i, r in enumerate(rules)]
    return out, active


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with spans: array<struct<start, rule, kind, end>> by start, then by rule."""
    names = [c for c in docs.columns if c != "spans"]
    df, active = _joined(docs.drop("spans"), rules)
    for i, rule in enumerate(rules):
        df = _spans(df, rule, i, active[i])
    return df.select(*[F.col(f"`{c}`") for c in names], F.array_sort(F.concat(*[f"__s{i}" for i in range(len(rules))])).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """docs whose text has each secret replaced, rule after rule; documents without any stay as they are.

    Of an assignment only the value goes. Spans of a later rule inside an earlier one's are already gone."""
    names = docs.columns
    df, active = _joined(docs, rules)
    for rule, on in zip(rules, active, strict=True):
        hit = F.coalesce(on & F.col("text").rlike(rule.pattern), F.lit(False))
        df = df.withColumn("__hit", hit)
        df = df.withColumns({"__m": F.when(F.col("__hit"), F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))), "__g": F.when(F.col("__hit"), F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))), "__p": F.when(F.col("__hit"), F.split("text", rule.pattern, -1))})
        # the measured group ends its match, so the rest of the match is what stands before it
        put = F.zip_with("__m", "__g", lambda m, g: F.when(F.length(g) >= rule.least, F.concat(F.substring(m, F.lit(1), F.length(m) - F.length(g)), F.lit(mark))).otherwise(m))
        text = F.array_join(F.flatten(F.zip_with("__p", put, lambda p, m: F.array(p, F.coalesce(m, F.lit(""))))), "")
        df = df.withColumn("text", F.when(F.col("__hit"), text).otherwise(F.col("text"))).drop("__hit", "__m", "__g", "__p")
    return df.select(*[F.col(f"`{c}`") for c in names])


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
