import hashlib
import random
import re
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.llm import chats, graph, mixing, neardup, pieces, queries, repeats, secrets, suffixes, top_k
from quillgraph.llm.anchors import WINDOW

# ---------------------------------------------------------------- near duplicates


def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def linked_components(rows):
    """The smallest id reachable over all linked pairs, by comparing every pair."""
    own = [(d, shingles(t)) for d, t in rows]
    boss = list(range(len(own)))

    def find(i):
        while boss[i] != i:
            i = boss[i]
        return i

    for i, (_, a) in enumerate(own):
        for j in range(i):
            b = own[j][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b) and find(i) != find(j):
                boss[find(i)] = find(j)
    least = {}
    for i, (d, s) in enumerate(own):
        if d is not None and s:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, (d, s) in enumerate(own)]


def test_components_against_all_pairs(corpus, empty, texts):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(corpus).collect())
    assert got == Counter(linked_components(texts))
    assert neardup.near_duplicates(empty).count() == 0


def test_large_group_with_few_links(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 4)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(4)
    base = [f"w{rng.randrange(900)}" for _ in range(150)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(5000)}"
        rows.append((i, " ".join(w)))
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    expected = Counter(linked_components(rows))
    assert len({c for _, _, c in expected}) > 20
    assert got == expected


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 2**63, 800, dtype=np.uint64)) for _ in range(2))
    both = np.union1d(a, b)
    sa, sb, su = (neardup.sketches(x, np.asarray([0, len(x)]))[0] for x in (a, b, both))
    assert (np.maximum(sa, sb) == su).all()
    for share in (0.5, 0.8, 0.9):
        n = int(2000 * share / (1 + share))
        pool = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
        x, y = np.sort(pool[:1000]), np.sort(np.concatenate([pool[:n], pool[1000 : 2000 - n]]))
        s = [neardup.sketches(z, np.asarray([0, len(z)]))[0] for z in (x, y)]
        estimate = neardup.likely(np.asarray([len(x)]), np.asarray([len(y)]), np.asarray([(s[0] > s[1]).sum()]), np.asarray([(s[0] < s[1]).sum()]))[0]
        assert abs(estimate - n / (2000 - n)) < 0.13


def test_pipeline_links_at_080(spark):
    """Pairs of similarities from 0.80 to 0.85 lose one document in the stage; op 10 keeps both."""
    import corpus_pipeline

    rng, rows = random.Random(12), []
    for k in range(30):
        w = [f"w{k}x{rng.randrange(10**6)}" for _ in range(104)]
        # two changed words far apart: of 100 shingles 90 stay, 90 of 110 together
        for changed in (0, 2):
            v = list(w)
            for c in range(changed):
                v[20 + 30 * c] = f"e{k}x{c}"
            rows.append((2 * k + changed // 2, " ".join(v)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = shingles(rows[0][1]), shingles(rows[1][1])
    assert 80 * len(a | b) <= 100 * len(a & b) < 85 * len(a | b)
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == list(range(0, 60, 2))
    assert neardup.near_duplicates(docs).filter("kept").count() == 60


def test_pipeline_keeps_one_of_a_group_without_ids(spark):
    import corpus_pipeline

    rng, rows, groups = random.Random(14), [], {}
    # two groups without ids, and one id with two texts that are not alike
    for g, ids in enumerate([[None] * 4, [None] * 3, [7, 8], [7, 9]]):
        w = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        for k, d in enumerate(ids):
            rows.append((d, " ".join([*w[:-1], f"end{k}"])))
            groups[rows[-1]] = g
    rows += [(None, ""), (None, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stay = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted((groups[r], r[0]) for r in stay if r in groups) == [(0, None), (1, None), (2, 7), (3, 7)]
    assert sorted((r for r in stay if r not in groups), key=str) == sorted(rows[-3:], key=str)


def test_one_id_with_two_texts(spark):
    """Each text of a repeated doc_id is linked by its own set."""
    rng, rows = random.Random(13), []
    for k in range(20):
        for _ in range(2):
            w = [f"w{rng.randrange(10**6)}" for _ in range(120)]
            rows += [(4 * k, " ".join(w)), (4 * k + 1 + len(rows) % 4 // 2, " ".join([*w[:-1], "other"]))]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter(linked_components(rows))
    assert {c for _, _, c in got} == set(range(0, 80, 4))


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101), (7, None)], "a long, b long")
    got = dict(tuple(r) for r in graph.components(edges).collect())
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


# ---------------------------------------------------------------- repeats


def removed(rows):
    counts = Counter(b[i : i + WINDOW] for _, b in rows for i in range(len(b) - WINDOW + 1))
    out = []
    for d, b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - WINDOW + 1):
            if counts[b[i : i + WINDOW]] > 1:
                gone[i : i + WINDOW] = b"\1" * WINDOW
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("most", [6000, 1])
def test_removal_against_all_windows(corpus, empty, texts, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_CONTEXTS", most)
    monkeypatch.setattr(repeats, "SHARD", 4000)
    got = repeats.remove(corpus)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == removed([(d, (t or "").encode()) for d, t in texts])
    assert set(corpus.columns) < set(got.columns)
    assert Counter((r.doc_id, r.passage_windows) for r in got.collect()) == passages(texts)
    assert repeats.remove(empty).count() == 0


def passages(rows):
    words = [(d, (t or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)).encode().split()) for d, t in rows]
    runs = [(d, [tuple(w[i : i + 51]) for i in range(len(w) - 50)]) for d, w in words]
    counts = Counter(r for _, own in runs for r in own)
    return Counter((d, sum(counts[r] > 1 for r in own)) for d, own in runs)


def test_passages_of_over_fifty_words(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8)))
    passage, short = [word() for _ in range(51)], [word() for _ in range(50)]
    rows = []
    for i in range(60):
        w = [word() for _ in range(rng.randint(0, 120))]
        put = {0: passage, 1: short, 2: [x.upper() for x in passage]}.get(i % 6, [])
        at = rng.randint(0, len(w))
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(w[:at] + put + w[at:])))
    rows += [(90, " ".join(passage + passage)), (91, " ".join(passage[:-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (6000, 1):
        monkeypatch.setattr(repeats, "MOST_CONTEXTS", most)
        got = {r.doc_id: r.passage_windows for r in repeats.remove(docs, with_text=False).collect()}
        assert Counter(got.items()) == passages(rows)
        assert {d for d, n in got.items() if n} == {d for d, _ in rows[:60] if d % 6 in (0, 2)} | {90}


def test_long_texts_are_anchored_in_parts(spark):
    rng = random.Random(6)
    long = "".join(rng.choice("abcdefgh ") for _ in range(1 << 14)) * 1040  # over 16 MB
    docs = spark.createDataFrame([(1, long), (2, long[5000:7000])], "doc_id long, text string")
    rows = {r.doc_id: r for r in repeats.remove(docs, with_text=False).collect()}
    assert rows[1].n_removed == rows[1].n_bytes == len(long) and rows[2].n_removed == 2000
    assert {(d, r.passage_windows) for d, r in rows.items()} == set(passages([(1, long), (2, long[5000:7000])]))


def test_suffix_arrays_and_common_prefixes():
    rng = random.Random(1)
    for _ in range(600):
        k = rng.choice([2, 3, 5, 9])
        t = [rng.randint(1, k - 1) for _ in range(rng.randint(1, 50))]
        t = (t * 3 if rng.random() < 0.3 else t) + [0]
        order = sorted(range(len(t)), key=lambda i: t[i:])
        s = np.asarray(t)
        sa = suffixes.suffix_array(s, k)
        assert sa.tolist() == order == suffixes._doubled(s).tolist()
        plcp, phi = suffixes.common_prefixes(s.astype(np.uint16), sa)
        for a, b in zip(order, order[1:], strict=False):
            n = 0
            while max(a, b) + n < len(t) and t[a + n] == t[b + n]:
                n += 1
            assert (phi[b], plcp[b]) == (a, n)


# ---------------------------------------------------------------- mixing


def filled(sizes, weights, share, most):
    """Targets by resharing what is above again and again."""
    total, full = share * sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in full)
        w = sum(weights[i] for i in range(len(sizes)) if i not in full)
        target = [most * sizes[i] if i in full else rest * weights[i] / w for i in range(len(sizes))]
        new = {i for i in range(len(sizes)) if i not in full and target[i] > most * sizes[i] + 1e-9}
        if not new:
            return target
        full |= new


def test_mix(spark, corpus, empty, texts):
    rows = mixing.shares(corpus).collect()
    again = mixing.shares(corpus.repartition(5)).collect()
    key = lambda rs: Counter((r.doc_id, r.h, r.copies, r.target) for r in rs)
    assert key(rows) == key(again) and len(rows) == len(texts)
    size = lambda t: len((t or "").encode().split())
    assert sorted(r.size for r in rows) == sorted(size(t) for _, t in texts)
    sources = sorted({r.source for r in rows}, key=lambda s: (s is None, s or ""))
    totals = [sum(r.size for r in rows if r.source == s) for s in sources]
    for s, target, total in zip(sources, filled(totals, [(3, 1, 2)[i % 3] for i in range(len(sources))], 1.5, 2), totals, strict=True):
        own = [r for r in rows if r.source == s]
        assert all(abs(r.target - target) < 1e-6 and r.source_size == total and 0 <= r.copies <= 2 for r in own)
        assert abs(sum(r.copies * r.size for r in own) - target) <= max(r.size for r in own)
    out = mixing.mix(corpus)
    assert out.columns == corpus.columns
    taken = Counter()
    for r in rows:
        taken[r.doc_id, r.size] += r.copies
    assert Counter((r.doc_id, size(r.text)) for r in out.collect()) == +taken
    assert mixing.mix(empty).count() == mixing.shares(empty).count() == 0


def test_flights_keep_their_totals(spark, monkeypatch):
    rng = random.Random(8)
    p = np.asarray([rng.random() for _ in range(400)])
    size = -np.sort(-np.asarray([float(rng.choice([0, 1, 5, 5, 900])) for _ in p]))
    q = mixing.fly(p, size, rng.random, False)
    assert ((q > 0) & (q < 1)).sum() <= 2 and ((q >= 0) & (q <= 1)).all()
    assert abs(p.sum() - q.sum()) < 1e-6 and abs(p @ size - q @ size) < 1e-4
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), "big") for i in range(500)] + [(1000 + i, "w " * 300, "small") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "BLOCK", 20)
    found = mixing.decide.__defaults__
    monkeypatch.setattr(mixing.decide, "__defaults__", (20, *found[1:]))  # several levels
    out = mixing.shares(docs).collect()
    for s in ("big", "small"):
        own = [r for r in out if r.source == s]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= max(r.size for r in own)


def test_every_document_keeps_its_probability():
    rng = np.random.default_rng(4)
    long_ones = np.r_[900, 700, 500, -np.sort(-rng.integers(40, 223, 27))].astype(float)
    for p, size in ((np.full(30, 0.4), long_ones), (rng.random(30), long_ones), (rng.random(7), np.zeros(7)), (rng.random(9), np.full(9, 3.0))):
        draws = np.asarray([mixing.fly(p, size, np.random.default_rng([k, 1]).random, True) for k in range(3000)])
        assert set(np.unique(draws)) <= {0.0, 1.0}
        assert np.abs(draws.mean(axis=0) - p).max() < 4.5 * 0.5 / 3000**0.5
        # the words of a draw are off by what a few of the shortest documents weigh, however long the others are
        assert np.abs(draws @ size - p @ size).mean() <= size[-3:].sum()


# ---------------------------------------------------------------- top k


def test_top_k_against_sorting(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).round(3).tolist()) for i in range(120)] + [(200 + i, [0.5] * 6) for i in range(30)] + [(300, [1.0, 2.0]), (301, [3.0, -1.0]), (302, []), (303, None), (304, [1.0, None, 2.0, 1.0, 1.0, 1.0]), (305, [float("nan")] * 6), (306, [float("inf")] * 6), (None, [1.0] * 6), (350, [0.5] * 6), (350, [-0.5] * 6)]
    table = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<double>, score string")
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for bins in (1024, 4):
        got = Counter(tuple(r) for r in top_k.top_k(table, F.col("vec_id") % 50 == 0, query_block=3, bins=bins).collect())
        expected = Counter()
        for q, v in good:
            if q % 50 == 0:
                near = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v))[:5]
                expected.update((q, k + 1, i, -s) for k, (s, i) in enumerate(near))
        assert got == expected
    assert top_k.top_k(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_large_components_are_exact(spark):
    rows = [(0, [1e9, 1e9]), (50, [1e9, -1e9]), (3, [2.0, 1e9])]
    got = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    x = 256 * 10**9
    clip = lambda v: max(-top_k.LONG, min(top_k.LONG, v))
    assert {(r.query_id, r.vec_id): r.score for r in got} == {(0, 50): 0, (0, 3): clip(512 * x + x * x), (50, 0): 0, (50, 3): clip(512 * x - x * x)}


# ---------------------------------------------------------------- chats


def cheapest(roles):
    """The least cost over every repair that there is: roles, joins and up to two empty messages at each place."""
    legal = re.compile("s?(ua)*")
    letter = {"system": "s", "user": "u", "assistant": "a"}
    empties = ["", "u", "a", "ua", "au"]
    found = {("", 0)}
    for k, role in enumerate(roles):
        new = set()
        for sequence, cost in found:
            for put in empties:
                for own in "sua":
                    change = 0 if own == letter.get(role) else 4 if role in letter else 1
                    new.add((sequence + put + own, cost + 3 * len(put) + change))
            if k:
                new.add((sequence, cost + (1 if role == roles[k - 1] else 6)))
        # what cannot become legal any more goes, and of equal sequences all but the cheapest
        best = {}
        for sequence, cost in new:
            if legal.fullmatch(sequence) or legal.fullmatch(sequence + "a"):
                best[sequence] = min(cost, best.get(sequence, cost))
        found = set(best.items())
    return min(cost + 3 * len(put) for sequence, cost in found for put in ("", "a", "ua") if legal.fullmatch(sequence + put))


def test_one_repair_however_it_is_dealt(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice(["", None, "x", "y"])) for c in range(60) for t in range(300 if c == 5 else rng.randint(1, 7))]
    rows += [(None, 1, "user", "a"), (None, 1, "user", "a")]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    number, coalesce = (spark.conf.get(f"spark.sql.{k}") for k in ("shuffle.partitions", "adaptive.coalescePartitions.enabled"))
    found = []
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (1, 3, 17):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            found.append(Counter(map(tuple, chats.format_chats(docs).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", number)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert found[0] == found[1] == found[2]


def test_repairs_are_legal_and_cheapest(spark):
    rng = random.Random(2)
    roles = {c: [rng.choice(["user", "assistant", "system", "tool", None, "user", "assistant"]) for _ in range(900 if c == 7 else rng.randint(1, 9))] for c in range(40)}
    rows = [(c, t, r, None if t == 2 else f"m{c}-{t}", "clash") for c, rs in roles.items() for t, r in enumerate(rs)]
    out = {}
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for r in chats.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string").repartition(6)).collect():
            out.setdefault(r.conv_id, []).append(r)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    for c, rs in roles.items():
        got = sorted(out[c], key=lambda r: (r.message, r.piece))
        assert [r.turn for r in got if r.change != "inserted"] == list(range(len(rs)))
        cost, seen = 0, []
        for r in got:
            if r.change == "inserted":
                cost += chats.INSERT
                assert r.text == ""
            elif r.change == "joined":
                cost += chats.JOIN if r.turn and rs[r.turn] == rs[r.turn - 1] else chats.JOIN_OTHER
                continue
            elif r.role != rs[r.turn]:
                cost += chats.RELABEL if rs[r.turn] in chats.ROLES else chats.FOREIGN
            seen.append(r.role)
        sides = seen[1:] if seen[0] == "system" else seen
        assert sides and sides == ["user", "assistant"] * (len(sides) // 2)
        if len(rs) < 10:
            assert cost == cheapest(rs)
        assert "".join(r.rendered for r in got).count("<|end|>\n") == len(seen)


def test_odd_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chats.format_chats(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, None, None, None), (None, 1, "user", ""), (5, 0, "system", "s")]
    got = chats.format_chats(spark.createDataFrame(rows + rows[:1], schema)).orderBy("message", "piece").collect()
    assert [(r.role, r.change) for r in got if r.conv_id == 5] == [("system", "kept"), ("user", "inserted"), ("assistant", "inserted")]
    assert sum(r.change != "inserted" for r in got) == 4


# ---------------------------------------------------------------- pipeline


def test_pipeline(spark, tmp_path, corpus):
    import corpus_pipeline

    docs = corpus.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, read, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        before, read = read, spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert read.columns == docs.columns, name
        if name == "language_id":
            assert read.filter("text IS NULL OR trim(text) = ''").count() == 0
        if name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            kept = sorted((r.doc_id is None, r.doc_id or 0) for r in read.collect())
            assert kept == sorted({(c is None, c or 0) for _, _, c in linked_components(rows)})
        if name == "secret_scan":
            texts = Counter()
            for r in before.collect():
                text = r.text
                for rule in secrets.RULES:
                    text = re.sub(rule.pattern, lambda m, rule=rule: m[0][: len(m[0]) - len(m[rule.group])] + "[SECRET]" if len(m[rule.group]) >= rule.least else m[0], text)
                texts[r.doc_id, text, r.lang, r.source, len(text)] += 1
            assert Counter(map(tuple, read.collect())) == texts
        if name == "mix":
            given, taken = Counter(map(tuple, before.collect())), Counter(map(tuple, read.collect()))
            assert all(0 < n <= 2 * given[row] for row, n in taken.items())
            words = lambda rows, source: sum(n * len(row[1].encode().split()) for row, n in rows.items() if row[3] == source)  # noqa: B023, E731
            sources = sorted({row[3] for row in given}, key=lambda s: (s is None, s or ""))
            sizes = [words(given, s) for s in sources]
            for s, target in zip(sources, filled(sizes, [(3, 1, 2)[i % 3] for i in range(len(sources))], 1.5, 2), strict=True):
                assert abs(words(taken, s) - target) <= max(len(row[1].encode().split()) for row in given if row[3] == s)
        if name == "encode":
            v = pieces.Vocabulary.load()
            assert Counter((r.doc_id, v.decode(r.ids) if r.ids else "") for r in read.collect()) == Counter((r.doc_id, r.text) for r in before.collect())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == read.count()
    none = spark.createDataFrame([], docs.schema)
    none.write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


def test_every_operator_has_a_query():
    names = queries.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
