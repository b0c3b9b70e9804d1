import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quillgraph.llm import langid, pieces, ppm, secrets

# ---------------------------------------------------------------- language ID


def test_language_id(spark, corpus, empty):
    rng = random.Random(3)
    say = lambda stems, n: " ".join("".join(rng.choice(stems) for _ in range(3)) for _ in range(n))
    kinds = {"aa": ["ka", "lo", "mi"], "bb": ["ßü", "tré", "ona"], "cc": ["da", "ber", "lo"]}
    rows = [(say(s, 40), k) for k, s in kinds.items() for _ in range(30)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    test = [(say(s, 12), k, "kept") for k, s in kinds.items() for _ in range(20)] + [(None, "und", "kept"), ("", "und", "kept"), ("12 + 3 = 15!", "und", "kept"), ("zzzz", None, "kept")]
    out = langid.predict(spark.createDataFrame(test, "text string, truth string, score string"), model).collect()
    assert all(r.truth in (None, r.lang_pred) for r in out) and all(0 <= r.score <= 1 for r in out)
    assert [r.score for r in out if r.lang_pred == "und"] == [0, 0, 0]
    assert "n" in langid.predict(corpus, model).columns and langid.predict(corpus, model).count() == corpus.count()
    assert langid.predict(empty, model).count() == 0
    nothing = langid.predict(corpus, langid.fit(empty))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}


def test_filter_returns_every_language_of_a_gram():
    members = {f"l{i}": np.arange(i * 100, i * 100 + 300, dtype=np.uint32) + 1000 for i in range(11)}
    f = langid.Filter.build(members, "l0")
    g = np.arange(1000, 2400, dtype=np.uint32)
    for i, name in enumerate(f.languages):
        mask = f.planes[i // 8][langid.slots(g)[0]]
        for s in langid.slots(g)[1:]:
            mask = mask & f.planes[i // 8][s]
        hit = (mask >> (i % 8)) & 1 == 1
        assert hit[np.isin(g, members[name])].all() and hit[~np.isin(g, members[name])].mean() < 0.01


def plain_grams(text):
    """Runs of four bytes of the folded text between two spaces on either side."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in (text or "").encode())
    framed = b"  " + raw + b"  "
    return [g for g in (framed[i : i + 4] for i in range(len(raw) + 1)) if g != b"    "]


def test_shares_against_plain_sets():
    rng = random.Random(12)
    alphabet = ["ab", "ka", "ré", "ß", "ло", " ", " ", ", ", "7", "X"]
    say = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    sets_of = {f"l{k:02d}": {g for _ in range(30) for g in plain_grams(say(rng.randint(5, 60)))} for k in range(19)}
    model = langid.Filter.build({k: np.asarray(sorted(int.from_bytes(g, "little") for g in v), np.uint32) for k, v in sets_of.items()}, "l00")
    texts = [say(rng.randint(0, 80)) for _ in range(200)] + ["", " ", "a"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    doc, g = langid.grams(np.frombuffer(b"".join(raw), np.uint8), offsets)
    found = model.shares(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for i, t in enumerate(texts):
        own = plain_grams(t)
        assert sorted(int(x) for x in g[doc == i]) == sorted(int.from_bytes(x, "little") for x in own)
        exact = [sum(x in sets_of[name] for x in own) / max(1, len(own)) for name in model.languages]
        # a false positive can only add to a share, and is rare with as few members
        assert np.abs(found[i] - exact).max() <= 0.02 + (2 / len(own) if own else 0)


# ---------------------------------------------------------------- prediction by partial matching


def brute(train, order, discount):
    trie = [defaultdict(Counter) for _ in range(order + 1)]
    for s in train:
        for i in range(order, len(s)):
            for k in range(order + 1):
                trie[k][s[i - k : i]][s[i]] += 1

    def log10(s):
        total = 0.0
        for i in range(order, len(s)):
            out, p = set(), 0.0
            for k in range(order, -1, -1):
                seen = {a: n for a, n in trie[k].get(s[i - k : i], {}).items() if a not in out}
                if not seen:
                    continue
                room = sum(seen.values())
                if s[i] in seen:
                    p += math.log((seen[s[i]] - discount) / room)
                    break
                p += math.log(discount * len(seen) / room)
                out |= set(seen)
            else:
                p -= math.log(256 - len(out))
            total += p
        return total / math.log(10)

    return log10


def test_scores_against_a_plain_trie(corpus, empty, texts):
    training = F.coalesce(F.col("doc_id") % 4 != 0, F.lit(True))
    rows = ppm.score(corpus, training).collect()
    held = lambda d: d is not None and d % 4 == 0
    framed = lambda t: b"\xfe" * ppm.ORDER + (t or "").encode().lower() + b"\xff"
    log10 = brute([framed(t) for d, t in texts if not held(d)], ppm.ORDER, ppm.DISCOUNT)
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    counts = Counter(w for d, t in texts if not held(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id, r.n_tokens].append(r)
    assert len(rows) == len(texts)
    for d, t in texts:
        own = tokens(t)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert any(abs(r.base_score - base) < 1e-6 and r.n_known == sum(counts[w] > 0 for w in own) and r.train_tokens == n and r.held_out == held(d) and abs(r.score - log10(framed(t))) < 1e-3 * abs(r.score) + 1e-4 for r in by[d, len(own)]), (d, base)
    assert ppm.score(empty, training).count() == 0


def test_without_training(corpus):
    rows = ppm.score(corpus.filter("doc_id = 161"), F.lit(False)).collect()
    assert rows[0].base_score == 0 and abs(rows[0].score + 4 * math.log10(256)) < 1e-6 and rows[0].train_tokens == 0


def test_rare_grams_count(corpus, texts, monkeypatch):
    """With few n-grams broadcast and small shards every n-gram still has its own count."""
    monkeypatch.setattr(ppm, "MOST_GRAMS", 50)
    if ppm.fit_trie.__defaults__:
        monkeypatch.setattr(ppm.fit_trie, "__defaults__", (50,))
    monkeypatch.setattr(ppm, "_STEP", 40, raising=False)
    held = lambda d: d is not None and d % 4 == 0
    framed = lambda t: b"\xfe" * ppm.ORDER + (t or "").encode().lower() + b"\xff"
    log10 = brute([framed(t) for d, t in texts if not held(d)], ppm.ORDER, ppm.DISCOUNT)
    got, expected = defaultdict(list), defaultdict(list)
    for r in ppm.score(corpus, F.coalesce(F.col("doc_id") % 4 != 0, F.lit(True))).collect():
        got[r.doc_id].append(r.score)
    for d, t in texts:
        expected[d].append(log10(framed(t)))
    assert got.keys() == expected.keys()
    for d in got:
        assert np.allclose(sorted(got[d]), sorted(expected[d]), rtol=1e-5, atol=1e-5), d


def test_pruning_keeps_suffixes(corpus):
    trie = ppm.fit_trie(corpus.select("text"), most=200)
    assert all(len(k) <= 200 for k in trie.keys)
    for k in range(1, ppm.ORDER + 1):
        assert np.isin(ppm._low(trie.keys[k], k), trie.keys[k - 1]).all()


# ---------------------------------------------------------------- secrets


def test_trigram_queries():
    q = secrets.trigram_query
    assert q("abcd") == ("and", "abc", "bcd") and q("[0-9a-f]{24,}") is None and q("(abc|xyz)+") == ("or", "abc", "xyz")
    assert q("ab[cd]e?") == ("or", "abc", "abd") and q("(abc)?def") == "def" and q("a.c") is None and q("(foo|.)bar") == "bar"
    for rule in secrets.RULES:  # every match satisfies its query
        query = secrets.trigram_query(rule.pattern)
        holds = lambda x, s: x in s if isinstance(x, str) else (all if x[0] == "and" else any)(holds(p, s) for p in x[1:])  # noqa: B023, E731
        for s in ["password = abcdef1", "API_KEY:'zzzzzz9'", "apikey=123456", "AKIA" + "A1" * 9, "ghp_" + "a" * 40, "xoxb-1234567890", "AIza" + "b" * 35, "sk_live_" + "a" * 24, "eyJabcdefghijk.eyJabcdefghijk.abcdefghijk", "-----BEGIN RSA PRIVATE KEY-----"]:
            if query is not None and re.search(rule.pattern, s):
                assert holds(query, s.lower()), (rule, s)


def test_spans_and_redaction(spark, corpus, empty):
    rng = random.Random(9)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", " = ", ":", "=", '"', "'", "abc", "abcdef", "0123456789abcdef", "AKIA", "ABCDEFGH12345678", " ", "é💡", "\n", "ghp_" + "x" * 36, "=secret: zzzzzz"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(300)] + [(300, None), (301, ""), (302, "token=abcdef1 " * 700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.scan(docs).collect()}
    clean = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    for d, t in rows:
        expected = [(m.start(), k, r.kind, m.end()) for k, r in enumerate(secrets.RULES) for m in re.finditer(r.pattern, t or "", re.A) if len(m[r.group]) >= r.least]
        assert got[d] == sorted(expected), (d, t)
        text = t
        for r in secrets.RULES:
            text = None if text is None else re.sub(r.pattern, lambda m, r=r: m[0][: len(m[0]) - len(m[r.group])] + "[SECRET]" if len(m[r.group]) >= r.least else m[0], text)
        assert clean[d] == text
    assert secrets.scan(corpus).columns == [c for c in corpus.columns if c != "spans"] + ["spans"] and secrets.scan(corpus).count() == corpus.count()
    assert secrets.redact(empty).count() == secrets.scan(empty).count() == 0


# ---------------------------------------------------------------- pieces


def every_path(v, text):
    t, out = " " + text, []

    def go(i, score, ids):
        if i == len(t):
            out.append((score, tuple(ids)))
            return
        for j in range(i + 1, min(len(t), i + v.longest) + 1):
            if t[i:j] in v.ids:
                go(j, score + v.score[t[i:j]], [*ids, v.ids[t[i:j]]])
        if t[i] not in v.ids:
            raw = t[i].encode()
            go(i + 1, score + v.byte_score * len(raw), ids + [v.bytes_from[b] for b in raw])

    go(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


def test_n_best_are_the_n_best():
    s = pieces.segmenter()
    v = s.vocabulary
    rng = random.Random(3)
    for text in ["hello the", "a b c", "x", "  hi", "né▁ó\n the", "\U0001f600 ok", "the the th"] + ["".join(rng.choice("thean  e") for _ in range(rng.randint(1, 12))) for _ in range(60)]:
        paths = every_path(v, text)
        for n in (1, 2, 4, 7):
            best = s.encode(text, n)
            assert len(best) == min(n, len(paths)) == len({tuple(x) for _, x in best})
            assert all(abs(a[0] - b[0]) < 1e-9 for a, b in zip(best, paths, strict=False))
            scores = {ids: score for score, ids in paths}
            assert all(abs(scores[tuple(x.tolist())] - score) < 1e-9 and v.decode(x.tolist()) == text for score, x in best)


def test_tables_of_pieces(corpus, empty, texts):
    rows = pieces.digest(corpus, ids=True).collect()
    assert len(rows) == len(texts) and all(r.round_trip and r.n_pieces == len(r.ids) for r in rows)
    again = pieces.digest(corpus.repartition(7)).collect()
    assert Counter((r.doc_id, r.nbest_sha256) for r in rows) == Counter((r.doc_id, r.nbest_sha256) for r in again)
    best = pieces.encode(corpus.filter("doc_id = 162 or doc_id = 150 or doc_id = 151"), 3)
    out = {r.doc_id: r for r in pieces.decode(best.withColumn("ids", F.col("nbest")[0]["ids"])).collect()}
    assert out[150].nbest is None and out[150].decoded is None and out[151].decoded == "" and out[162].decoded == dict(texts)[162]
    assert pieces.digest(empty).count() == 0


class Rows:
    """Stands for a table: gives the function that mapInArrow would run."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):  # noqa: N802
        return run


def test_chunks_of_a_part_are_those_of_its_texts():
    s = pieces.segmenter()
    rng = random.Random(5)
    texts = ["", "a", " a", "a ", "a  b", " ", "\n", "a b\nc a", "né▁ó the", "\U0001f600 \x00 ok", "the the th"] + ["".join(rng.choice("the an \n") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for some in (texts, [""], [" x", "  "], [*texts, "half \ud800 a  character"]):
        chunks, places = s.dealt(some)
        assert [[chunks[k] for k in own] for own in places] == [s.chunks(t) if t else [] for t in some]
    plain = [t for t in texts if not t.startswith(" ") and not t.endswith(" ") and "  " not in t]
    chunks, _ = s.dealt(plain)
    assert len(chunks) == len(set(chunks))


def test_round_trips_spell_a_text_once_and_tell_wrong_runners_up(monkeypatch):
    texts = ["hello the thing", "a b c", "one\ntwo", "", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    run, calls, decode, best = pieces.digest(Rows()), [], pieces.Vocabulary.decode, pieces.Segmenter.encode_all
    monkeypatch.setattr(pieces.Vocabulary, "decode", lambda v, ids: calls.append(1) or decode(v, ids))
    assert all(all(b["round_trip"]) for b in (x.to_pydict() for x in run([batch]))) and len(calls) == 3
    for wrong in (lambda x: x[:-1], lambda x: x[1:], lambda x: np.append(x, x[-1]), lambda x: np.concatenate([x[:1], x])):
        spoilt = lambda s, part, n, wrong=wrong: ([*b[:-1], (b[-1][0], wrong(b[-1][1]))] if len(b) > 1 else b for b in best(s, part, n))
        monkeypatch.setattr(pieces.Segmenter, "encode_all", spoilt)
        assert [x.to_pydict()["round_trip"] for x in run([batch])] == [[False, False, False, True, True]]
