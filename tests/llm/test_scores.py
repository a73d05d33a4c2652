import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from millrace.llm import metric_topk as M
from millrace.llm import mixing as X
from millrace.llm import quality_rules as Q
from millrace.llm import toxicity as T
from millrace.llm import url_filter as U
from millrace.llm.learning import held_out, labelled_sample
from millrace.session import Stash


def brute_top(rows, k=5):
    ok = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((i, [math.floor(float(np.float32(x)) * 256) for x in v]))
    out = []
    for i, q in {(i, tuple(q)) for i, q in ok if i % 50 == 0}:
        s = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for j, c in ok if j != i and len(c) == len(q))
        out += [(i, n + 1, j, -v) for n, (v, j) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize(("shard", "block"), [(7, 60), (64, 1 << 20), (16384, 8)])
def test_metric_topk(spark, shard, block, monkeypatch):
    monkeypatch.setattr(M, "PAGE", 8)
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(220, 6)).astype("f4"))]
    rows += [(300 + i, rows[7][1]) for i in range(60)]  # one common vector, ties
    rows += [(600 + i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(60, 3)) * 10.0 ** rng.integers(0, 8, (60, 1)))]  # scores of up to 2 ** 61
    rows += [(700, [9.0e6, 1.0]), (750, [-9.0e6, 2.0]), (701, [1.0e7, 3.0]), (702, [0.0, 0.0])]
    rows += [(400, None), (401, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (None, rows[0][1]), (450, [1.0, 2.0]), (451, [2.0, 1.0]), (500, [-0.001] * 6)]
    frame = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<float>, score double").repartition(3)
    x = M.quantised(frame)
    got = M.top_k(x, x.filter("vec_id % 50 = 0"), shard_rows=shard, block=block)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows)
    none = x.filter("vec_id < 0")
    assert M.top_k(none, none).count() == 0


def test_metric_topk_refuses_what_is_too_large(spark):
    frame = lambda *rows: spark.createDataFrame(list(rows), "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="36028797018963968 or more"):
        M.quantised(frame((0, [1.0, 2.0]), (1, [2.0**55, 0.0]))).count()
    assert M.quantised(frame((0, [1.0, -(2.0**54)]), (1, [2.0**55, float("nan")]), (2, [float("inf"), 2.0**56]), (None, [2.0**55, 0.0]))).count() == 1
    x = M.quantised(frame((0, [2.0**30, 1.0]), (1, [2.0**40, 1.0])))
    with pytest.raises(Exception, match="doesn't fit 64 bits"):
        M.top_k(x, x).count()


def test_tree_saves_work():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 16)) * 300
    x = (centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 16)) * 5).astype(int)
    tree = M.MTree(np.arange(4000), x, 64)
    seen = []

    class Page(tuple):
        def __iter__(self):
            seen.append(len(self[1]))
            return super().__iter__()

    tree.pages = [Page(p) for p in tree.pages]
    for q in x[:20]:
        want = sorted((-int(v), i) for i, v in enumerate(x @ q) if i != 5)[:5]
        assert [(-s, i) for s, i in tree.search(q, 5, 5)] == want
    assert sum(seen) < 20 * 4000 * 0.7


URLS = ["http://a.net", "http://a.net/", "https://X.Example.NET/en/1", "https://example.net/en", "http://EXAMPLE.com/de/x?y#z", "http://notexample.com/de/", "http://a.org/fr/", "http://a.org/FR/", "http://org/fr/q", "ftp://cheap-pills.example.com/", "no scheme", "", None, "http://?q", "http://h#f/de/", "x://a.net?p=/en/", "http://net/", "http://spam.a.org/fr/", "http://a.net/\n/x", "a://b://c.net/", "http://u@a.net:80/"]


def brute_url(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
        rest = rest[n:]
        path = rest[: next((i for i, c in enumerate(rest) if c in "?#"), len(rest))]
    fits = []
    for rule, verdict in (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")):
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    own = "block" if set(re.split("[^a-z0-9]+", (host + path).lower())) & set(U.WORDS) else "allow"
    return (host, path, *(max(fits)[1:] if fits else (None, own)))


@pytest.mark.parametrize("inline", [256, 0])
def test_url_filter(spark, inline):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[0]), (0, URLS[0])]
    rows += [(900, "http://a.net/" + "spam/" * 40_000), (901, "x" * 200_000), (902, "http://" + "a." * 50_000 + "net/")]
    frame = spark.createDataFrame([(i, u, "x", "mine", "k", 3) for i, u in rows], "page_id long, url string, host string, _host string, _key string, _rest int")
    got = U.filter_urls(frame, inline=inline)
    assert got.columns == ["page_id", "url", "_host", "_key", "_rest", "host", "path", "rule", "verdict"]
    assert {(r._host, r._key, r._rest) for r in got.collect()} == {("mine", "k", 3)}
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()), key=repr) == sorted(((i, *brute_url(u)) for i, u in rows), key=repr)
    assert U.filter_urls(frame.limit(0), inline=inline).count() == 0


def test_url_filter_is_native(spark, small):
    plan = U.op7_url_filter(spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_folding_and_hits():
    m = T.Matcher({"idiot": 5.0, "lowei*": 4.0, "trash": 3.0})
    assert [w for *_, w in m.hits(T.fold("You 1D10T, loweischaft! іdiоt idiots"))] == [5.0, 4.0, 5.0]
    assert m.hits(T.fold("put it in the trash can, not elsewhere")) == []
    assert len(m.hits(T.fold("trash canned"))) == 1
    assert m.hits(T.fold("fallowei")) == []
    assert len(T.fold("ЖИЗНЬ İß")) == 8
    assert m.features(None) == m.features("") == (0.0, 0.0)
    assert [w for *_, w in m.hits(T.fold("tr@sh!"))] == [3.0]


def test_matcher_against_a_plain_scan():
    """Hits found word by word, without an automaton; a phrase of two words spares the hits in both."""
    rng = np.random.default_rng(7)
    for _ in range(300):
        word = lambda n: "".join(rng.choice(list("abc"), n))
        lexicon = {word(rng.integers(2, 5)) + ("*" if rng.random() < 0.4 else ""): float(rng.integers(1, 9)) for _ in range(6)}
        phrases = tuple(f"{word(2)} {word(3)}" for _ in range(3))
        text = T.fold("".join(rng.choice([word(rng.integers(1, 6)), " ", " ", "9", ",", "-"]) for _ in range(40)))
        words, want = list(re.finditer(r"[^\W\d_]+", text)), []
        for i, m in enumerate(words):
            fits = [v for t, v in lexicon.items() if (m[0].startswith(t[:-1]) if t.endswith("*") else m[0] == t)]
            pairs = [text[x.start() : y.end()] for x, y in zip(words, words[1:], strict=False) if x is m or y is m]
            if fits and not set(pairs) & set(phrases):
                want.append((m.start(), max(fits)))
        assert [(a, w) for a, _, w in T.Matcher(lexicon, phrases).hits(text)] == want


def test_toxicity_scores(spark, tiny):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), 4)) for _ in range(400)]
    docs, labels = [], []
    for i in range(600):
        text = list(rng.choice(words, 30))
        toxic = i % 5 == 0
        if toxic:
            for w in rng.choice(["vilex", "grotta", "morbu" + "xyz"[i % 3]], 2):
                text.insert(int(rng.integers(0, 30)), w)
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    frame = tiny([*docs, (None, "vilex"), (900, None), (901, ""), (902, "vilex " * 20000), (3, docs[3][1])])
    lab = spark.createDataFrame([*labels, (None, 1), (5000, 1), (901, None)], "doc_id long, toxic int")
    model = T.train(frame, lab)
    got = T.score_toxicity(frame, *model).collect()
    by = {}
    for r in got:
        assert 0 <= r.score <= 1
        by.setdefault(r.doc_id, []).append(r.score)
    right = [(by[i][0] >= 0.5) == bool(y) for i, y in labels]
    assert np.mean(right) > 0.97 and len(got) == 605
    assert by[900] == by[901] and by[900][0] < 0.5 <= by[902][0] and len(set(by[3])) == 1
    none = T.train(tiny([]), lab.limit(0))
    assert {r.score for r in T.score_toxicity(tiny([(1, "a"), (2, None)]), *none).collect()} == {T.score_toxicity(tiny([(1, "a")]), *none).first().score}
    assert T.score_toxicity(tiny([]), *model).count() == 0
    with pytest.raises(ValueError, match="clashes"):
        T.score_toxicity(frame, *model, keep=("doc_id", "score"))


def test_learned_exceptions(spark):
    rows = [(f"{a} vilex {b}", 1) for a in "pqrs" for b in ("tt", "uu", "vv")] + [(f"the vilex fish {w}", 0) for w in ("aa", "bb", "cc")] + [("one vilex pond", 0)]
    found = T.learn_exceptions(spark.createDataFrame(rows, "text string, y int"), {"vilex": 5.0})
    assert {"the vilex", "vilex fish"} == set(found) - set(T.EXCEPTIONS)
    m = T.Matcher({"vilex": 5.0}, found)
    assert m.hits("a vilex fish") == [] and len(m.hits("a vilex fisher")) == 1 and len(m.hits("one vilex pond")) == 1


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = [(r.score, labels[r.doc_id]) for r in T.op8_toxicity(spark, d).collect() if r.held_out and r.doc_id in labels]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = np.mean([(a > b) + (a == b) / 2 for a in pos for b in neg])
    assert auc > 0.95


def brute_repeat(words, n=5):
    seen, out = {}, set()
    for i in range(len(words) - n + 1):
        seen.setdefault(tuple(words[i : i + n]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            out |= {i + k for i in at for k in range(n)}
    return len(out)


def test_repeated_words():
    rng = np.random.default_rng(1)
    for _ in range(300):
        words = [str(x) for x in rng.integers(0, rng.integers(1, 6), rng.integers(0, 60))]
        assert Q.repeated_words(words) == brute_repeat(words)
    words = [str(x) for x in rng.integers(0, 30000, 40000)]
    words[20000:20030] = words[100:130]
    assert Q.repeated_words(words) == brute_repeat(words)


def test_base_counts():
    assert Q.base_counts(None) == Q.base_counts("") == (0, 0, 0, 0, 0)
    assert Q.base_counts("a\x0b\xa0b #*\n\na\x0b\xa0b #*\n \n ") == (6, 10, 4, 1, 0)  # \xa0 belongs to a word


def test_quality(spark, tiny):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(500)]
    good = [(i, " ".join(rng.choice(words, 60))) for i in range(300)]
    bad = [(1000 + i, " ".join(w + "###" for w in rng.choice(words, 60))) for i in range(40)]
    frame = tiny([*good, *bad, (None, None), (2000, ""), (2001, "a b c"), (2002, "same " * 50000), (7, good[7][1])])
    labels = spark.createDataFrame([(i, 1) for i, _ in good[:200]] + [(i, 0) for i, _ in bad[:25]] + [(None, 1), (77777, 0), (2000, None)], "doc_id long, quality int")
    rows = Q.judge_quality(frame, labels).collect()
    kept = {r.doc_id: r.kept for r in rows}
    assert len(rows) == 345 and np.mean([kept[i] for i, _ in good]) > 0.98 and np.mean([kept[i] for i, _ in bad]) < 0.1
    failed = {r.doc_id for r in rows if r.base_failed}
    assert failed == {None, 2000, 2001, 2002} and not any(r.kept for r in rows if r.base_failed)
    again = {r.doc_id: r.anomaly for r in Q.judge_quality(frame.repartition(5), labels.repartition(3)).collect()}
    assert again == {r.doc_id: r.anomaly for r in rows}
    free = Q.judge_quality(frame, labels.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in free)
    assert Q.judge_quality(tiny([]), labels).count() == 0


def plain_threshold(score, good, keep=Q.KEEP):
    if not good.any():
        return math.inf
    least = np.quantile(score[good], keep, method="higher")
    if good.all():
        return np.nextafter(least, math.inf)
    cuts = np.unique(score[score > least])
    both = [(score[~good] >= c).sum() / (~good).sum() + (score[good] < c).sum() / good.sum() for c in cuts]
    return cuts[int(np.argmax(both))] if len(cuts) else math.inf


@pytest.mark.parametrize("case", range(5))
def test_quality_threshold_is_exact(spark, case):
    rng = np.random.default_rng(case)
    score, good = np.round(rng.random(400), 2 if case < 2 else 9), rng.random(400) < (0, 1, 0.5, 0.9, 0.9)[case]
    score[~good] = score[~good] ** 0.2
    frame = spark.createDataFrame([(float(s), int(g)) for s, g in zip(score, good, strict=True)], "anomaly double, y int").repartition(3)
    assert Q.threshold(frame, 0.97) == plain_threshold(score, good, 0.97)


def test_quality_learns_from_all_labelled_rows(spark):
    """The only bad rows come last in the order of a sample of 20,000 rows."""
    ids = sorted(range(27_000), key=lambda i: hashlib.sha256(f"sample|{i}".encode()).hexdigest())
    bad = set(ids[26_000:])
    rng = random.Random(4)
    letters = [[rng.choice("aeiousrt") for _ in range(9)] for _ in range(50)]
    docs = [(i, " ".join("".join(rng.choice(letters)[: rng.randint(2, 9)]) + ("#" if i in bad and rng.random() < 0.2 else "") for _ in range(rng.randint(10, 20)))) for i in ids]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i not in bad)) for i in ids], "doc_id long, quality int")
    rows = Q.judge_quality(frame, labels).collect()
    seen = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 and not r.base_failed]
    cut = plain_threshold(np.array([r.anomaly for r in seen]), np.array([r.doc_id not in bad for r in seen]))
    assert len(seen) > 20_000 and all(r.kept == (not r.base_failed and r.anomaly < cut) for r in rows)
    assert len(rows) == len(docs)


def test_quality_draws(spark):
    rows = spark.range(5000).selectExpr("id doc_id", "array(cast(id as double)) stats")
    got = Q.draws(rows)
    assert len(got) == Q.TREES and all(x.shape == (Q.DRAW, 1) and len(np.unique(x)) == Q.DRAW for x in got)
    assert len({x.tobytes() for x in got}) == Q.TREES and abs(np.mean(got) - 2500) < 50
    assert all((a == b).all() for a, b in zip(got, Q.draws(rows.repartition(7)), strict=True))
    assert [len(x) for x in Q.draws(rows.limit(9))] == [9] * Q.TREES and Q.draws(rows.limit(0)) == []


def test_quality_on_held_out_rows(spark):
    """The forest's own verdict, on labelled rows that neither it nor its cut has seen."""
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality").withColumn("held", held_out())
    labels = {r.doc_id: (r.quality, r.held) for r in labels.collect()}
    rows = [(*labels[r.doc_id], r.base_failed, r.kept) for r in Q.op6_quality_rules(spark, d).collect() if r.doc_id in labels]
    bad, good = [k for y, h, f, k in rows if y == 0 and h and not f], [k for y, h, f, k in rows if y == 1 and h and not f]
    print("held out", len(bad), 1 - np.mean(bad), len(good), np.mean(good))
    assert len(bad) > 40 and 1 - np.mean(bad) > 0.85
    assert np.mean(good) > 0.985


def test_quality_base_counts_of_a_whole_table(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = Q.op6_quality_rules(spark, small).collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id])
        lines, seen, dup = docs[r.doc_id].split("\n"), set(), 0
        for x in lines:
            if re.search(r"[^\x20\x09-\x0D]", x):
                dup += x in seen
                seen.add(x)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", docs[r.doc_id])), dup, brute_repeat(words))
        assert r.base_failed == (len(words) < 10 or 100 * r.n_repeat_words > 20 * len(words)) and not (r.kept and r.base_failed)


def test_isolation_forest_against_plain_paths():
    """Path lengths walked one row and tree at a time."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 4))
    x[:5] += 9
    forest = Q.Forest(x, trees=20, draw=64)
    for row in (0, 1, 100, 200):
        total = 0.0
        for feature, cut, left, right, depth in forest.trees:
            at = 0
            while feature[at] >= 0:
                at = left[at] if x[row, feature[at]] < cut[at] else right[at]
            total += depth[at]
        assert abs(forest.anomaly(x)[row] - 2 ** (-(total / 20) / forest.norm)) < 1e-12
    score = forest.anomaly(x)
    assert score[:5].min() > np.quantile(score[5:], 0.95)


def test_mixing_meets_targets(spark, tiny):
    rng = np.random.default_rng(8)
    p = rng.dirichlet([0.3, 0.3, 0.3], 2000)
    n = rng.integers(0, 500, 2000)
    rows = spark.createDataFrame([(int(i), int(k), [float(x) for x in v]) for i, (k, v) in enumerate(zip(n, p, strict=True))], "doc_id long, n long, p array<double>")
    rows = Stash(spark, "t").put(rows)
    out, before, goal, after = X.solve_rates(rows, (0.5, 0.3, 0.2), steps=80)
    got = out.collect()
    r = np.array([x.rate for x in sorted(got, key=lambda x: x.doc_id)])
    assert (r >= 0).all() and np.allclose((r * n) @ p, after) and np.allclose(goal, np.array([0.5, 0.3, 0.2]) * n.sum())
    assert np.abs(after / goal - 1).max() < 0.03 < np.abs(before / goal - 1).max()
    # The same steps on the whole matrix, in one place.
    x, eta = np.ones(2000), 1 / (np.max(np.maximum(before, goal) / goal) + X.PULL)
    for _ in range(80):
        gap = ((x * n) @ p - goal) / goal
        if np.abs(gap).max() < 1e-3:
            break
        x = np.where(n > 0, np.maximum(0, x - eta * (p @ gap + X.PULL * (x - 1))), 1.0)
    assert np.allclose(x, r)


@pytest.mark.parametrize("low", [0.13, 0.4, 0.8])
def test_mixing_meets_targets_at_any_mix(spark, low):
    rng = np.random.default_rng(5)
    n = rng.integers(1, 500, 2000)
    p = [[0.97, 0.03] if rng.random() < low else [0.03, 0.97] for _ in n]
    rows = Stash(spark, "t").put(spark.createDataFrame([(int(k), v) for k, v in zip(n, p, strict=True)], "n long, p array<double>"))
    out, _, goal, after = X.meet_targets(rows, X.TARGETS)
    got = out.collect()
    met = sum(np.array(r.p) * r.n * r.rate for r in got)
    assert min(r.rate for r in got) >= 0 and np.allclose(met, after) and np.abs(met / goal - 1).max() < X.TOLERANCE
    assert X.meet_targets(rows.limit(0), X.TARGETS)[0].count() == 0


def test_mixing_says_when_targets_cannot_be_met(spark):
    rows = Stash(spark, "t").put(spark.createDataFrame([(10, [0.5, 0.5])] * 20, "n long, p array<double>"))
    with pytest.warns(UserWarning, match="no rates found"):
        out = X.meet_targets(rows, X.TARGETS)[0]
    assert all(0 <= r.rate < 10 for r in out.collect())


@pytest.mark.parametrize("low", [0.13, 0.5])
def test_mixing_shares_with_bounds(spark, low):
    """Rates between a row's least and 1, and the shares met; against scipy-free plain steps on the whole arrays."""
    rng = np.random.default_rng(7)
    n = rng.integers(1, 500, 1500)
    p = [[a, 1 - a] for a in np.where(rng.random(1500) < low, rng.uniform(0.6, 0.99, 1500), rng.uniform(0.01, 0.4, 1500))]
    rows = Stash(spark, "t").put(spark.createDataFrame([(int(k), [float(x) for x in v], float(v[1] >= 0.5)) for k, v in zip(n, p, strict=True)], "n long, p array<double>, least double"))
    got = X.meet_targets(rows, (0.1, 0.9), shares=True, least="least", most=1.0)[0].collect()
    assert all(r.least <= r.rate <= 1 for r in got)
    met = sum(np.array(r.p) * r.n * r.rate for r in got)
    best = sum(np.array(r.p) * r.n * r.least for r in got)  # nothing but the bounded rows
    assert abs(met[0] / met.sum() - 0.1) < 2e-4 or best[0] / best.sum() > 0.1


def test_mixing_stage_follows_the_rates(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet").select("doc_id", "quality")
    rates = {r.doc_id: (r.rate, r.p[1]) for r in X.mix(docs, labels, keep=1, shares=True, most=1.0).collect()}
    kept = {r.doc_id for r in X.mix_stage(spark, docs, small).collect()}
    u = lambda i: int(hashlib.sha256(f"mix|{i}".encode()).hexdigest()[:12], 16) / 16**12
    assert kept == {i for i, (rate, _) in rates.items() if u(i) < rate}
    assert all(rate == 1.0 for rate, high in rates.values() if high >= 0.5) and any(rate < 1 for rate, _ in rates.values())


def test_posteriors_against_plain_arrays(spark, small):
    """op1's posteriors and rates from the same labelled rows, without Spark."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect() if r.doc_id in docs}
    x, y = np.array([X.features(docs[i]) for i in labels]), np.array(list(labels.values()))
    order = np.lexsort(np.vstack([x.T[::-1], y]))
    model = X.Softmax(x[order], y[order], 2)
    got = X.op1_mixing(spark, small).collect()
    assert len(got) == len(docs)
    p = {i: model.posteriors(np.array([X.features(t)]))[0] for i, t in docs.items()}
    assert all(np.allclose((r.p_low, r.p_high), p[r.doc_id]) and r.n_tokens == len(docs[r.doc_id].split()) and r.rate >= 0 for r in got)
    total = sum(r.n_tokens for r in got)
    met = np.array([sum(r.rate * r.n_tokens * q for r, q in ((r, getattr(r, f"p_{d}")) for r in got)) for d in X.DOMAINS])
    assert np.abs(met / (np.array(X.TARGETS) * total) - 1).max() < X.TOLERANCE


def test_labelled_sample_is_bounded(spark):
    docs = spark.createDataFrame([(1, "a")] * 8 + [(2, "b"), (3, "c"), (4, None), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(1, 9)], "doc_id long, quality int")
    for rows in (0, 2, 5, 11, 20):
        assert labelled_sample(docs, labels, "quality", rows).count() <= rows
    assert labelled_sample(docs, labels, "quality", 20).count() == 11


def test_mixing_edges(spark, tiny):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (99, 0)], "doc_id long, quality int")
    docs = [(1, "fine words in a row, all of them."), (2, "### $$$ %%%"), (3, None), (4, ""), (None, "fine words"), (5, "w " * 50000), (1, "fine words in a row, all of them.")]
    got = X.mix(tiny(docs), labels).collect()
    assert len(got) == 7 and all(r.rate >= 0 and abs(sum(r.p) - 1) < 1e-9 for r in got)
    assert {r.rate for r in got if r.doc_id in (3, 4)} == {1.0} and len({r.rate for r in got if r.doc_id == 1}) == 1
    assert X.mix(tiny([]), labels).count() == 0
    assert {tuple(r.p) for r in X.mix(tiny(docs), labels.limit(0)).collect()} == {(0.5, 0.5)}


def test_pipeline(spark, small):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{small}/documents.parquet")
    stash, kept = Stash(spark, "t"), []
    for name, stage in C.STAGES[:-1]:
        before, docs = docs, stash.put(stage(spark, docs, small))
        assert docs.columns == before.columns and docs.count() > 0
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert kept[-1] <= {r.doc_id for r in before.select("doc_id").collect()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    every = {r.doc_id for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id").collect()}
    clean = [i for i, r in labels.items() if r.toxic == 0 and i in every]
    assert len([i for i in clean if i in kept[0]]) >= 0.98 * len(clean)
    from tests.llm.test_dedup import brute_classes

    rest = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert len({c for _, c in brute_classes(rest)}) == len(rest)  # nothing left to dedup
    from tests.llm.test_tokens import check_pieces

    check_pieces(C.STAGES[-1][1](spark, docs, small).collect(), rest)
    assert len({x for x in itertools.chain(*kept)}) <= len(every)


def test_pipeline_empty(spark, tiny, small):
    import corpus_pipeline as C

    docs = tiny([])
    for _, stage in C.STAGES:
        docs = stage(spark, docs, small) if stage is not C.pack else stage(spark, docs, small)
    assert docs.count() == 0
