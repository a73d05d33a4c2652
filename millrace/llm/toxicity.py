"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text.

Folding lower-cases a text, maps look-alike letters of other scripts and digits (and @ $ ! between letters) to
the Latin letters they stand for, and keeps its length. An entry of the lexicon is a word, or a stem that a word
begins with; entries and their weights (log odds) are learned from labelled rows. A hit within an exception phrase
doesn't count: a few are given, and others are learned (a hit's word with the word before or behind it, found in clean texts and never in
a toxic one). The weights of a text's hits are summed and also normalised by its number of words; a logistic
curve fitted to labelled rows turns both into a score from 0 to 1.

Null and empty texts have no hits and get the score of such a text. Null ids, repeated rows and ties stay: every
row is scored by itself, and whole, however long. An empty table gives no rows. Without labelled rows the lexicon is empty and all scores equal.
Columns that are not kept are not read; a kept column must not be named `score`.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.columns import packed, unpacked
from millrace.llm.learning import held_out, labelled_sample, logistic
from millrace.session import Stash

#: Labelled rows used at most, for the lexicon and for the curve.
TRAIN_ROWS = 20_000
#: Toxic texts that a term must be in, and its least log odds, to be an entry; and lengths of stems.
OFTEN, LEAST, STEMS = 3, 3.0, (4, 5, 6, 8)
#: Clean texts that a phrase must be in to be learned as an exception.
EXCEPTION_TEXTS = 3

#: Letters that look like Latin ones, and digits that stand for letters.
LOOKALIKE = dict(zip("аеорсухіјѕԁһӏвкмнтαοεικνρτυχ", "aeopcyxijsdhlbkmhtaoeiknptux", strict=True))
DIGITS = dict(zip("013457", "oieast", strict=True))
SIGNS = {"@": "a", "$": "s", "!": "i"}
#: Phrases in which a harsh word is none.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pond scum", "stupid mistake of mine")

_TABLE = str.maketrans(LOOKALIKE | DIGITS)
_SIGN = re.compile(r"(?<=[^\W\d_])[@$!]+(?=[^\W\d_])")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    out = text.replace("\u0130", "i").lower().translate(_TABLE)  # the one letter that lower() makes longer
    if "@" in out or "$" in out or "!" in out:
        out = _SIGN.sub(lambda m: "".join(SIGNS[c] for c in m[0]), out)
    return out


def terms_of(text: str) -> set[str]:
    """The words of a text, and their stems marked with a star."""
    words = set(_WORD.findall(fold(text)))
    out = {w for w in words if 3 <= len(w) <= 24}
    for n in STEMS:
        out |= {w[:n] + "*" for w in words if len(w) > n}
    return out


def _term_counts(batches):
    seen: Counter = Counter()
    flush = lambda: pa.RecordBatch.from_pydict({"term": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})
    for b in batches:
        for text in b.column("text").to_pylist():
            seen.update(terms_of(text or ""))
            if len(seen) > 500_000:
                yield flush()
                seen.clear()
    yield flush()


def _contexts(wanted):
    """(term, a hash of the word before) of the wanted terms' finds."""

    def run(batches):
        known = wanted.value
        for b in batches:
            found = set()
            for text in b.column("text").to_pylist():
                before = ""
                for w in _WORD.findall(fold(text or "")):
                    for t in (w, *(w[:n] + "*" for n in STEMS if len(w) > n)):
                        if t in known:
                            found.add((t, zlib.crc32(before.encode())))
                    before = w
            found = sorted(found)
            yield pa.RecordBatch.from_pydict({"term": pa.array([t for t, _ in found], pa.string()), "c": pa.array([c for _, c in found], pa.int64())})

    return run


def _surplus(n: int, others: int, share: float) -> float:
    """n + others times the divergence of n's share from the share of toxic texts: minus the log of how likely chance makes it."""
    total = n + others
    p = n / total
    if p <= share:
        return 0.0
    out = n * math.log(p / share)
    return out + others * math.log((1 - p) / (1 - share)) if others else out


def distinct_texts(sample: DataFrame, stash: Stash) -> DataFrame:
    """(text, y) of each text once; a text is toxic if any of its labels says so."""
    one = sample.filter(F.col("text").isNotNull()).groupBy(F.md5("text").alias("k")).agg(F.first("text").alias("text"), F.max("y").alias("y"))
    return stash.put(one.select("text", "y"))


def learn_lexicon(distinct: DataFrame) -> dict[str, float]:
    """Entry (a word, or a stem with a star) to weight, from distinct_texts().

    An entry's log odds are at least LEAST, and chance alone would hardly have made its share among as many terms. Its
    finds count by the different words before them, so that copies of a toxic text don't make its plain words toxic. A stem
    goes before longer ones and the words it begins. All terms are considered and all that pass are kept: the sample's bound is theirs.
    """
    size = {r["y"]: r["count"] for r in distinct.groupBy("y").count().collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    if not pos or not neg:
        return {}
    counts = lambda y, n: distinct.filter(F.col("y") == y).select("text").mapInArrow(_term_counts, f"term string, {n} long").groupBy("term").agg(F.sum(n).alias(n))
    often = counts(1, "n").filter(F.col("n") >= OFTEN)
    rows = often.join(counts(0, "n").withColumnRenamed("n", "m"), "term", "left").fillna(0, ["m"])
    odds = F.log((F.col("n") + 0.5) / (pos - F.col("n") + 0.5)) - F.log((F.col("m") + 0.5) / (neg - F.col("m") + 0.5))
    known = rows.withColumn("odds", odds)
    totals = known.agg(F.count("*").alias("terms")).first()
    share, least = pos / (pos + neg), math.log(max(1, totals["terms"])) + 2
    likely = known.filter(F.col("odds") >= LEAST).collect()
    good = {r["term"]: r for r in likely if _surplus(r["n"], r["m"], share) >= least}
    seen = distinct.filter("y = 1").select("text").mapInArrow(_contexts(distinct.sparkSession.sparkContext.broadcast(set(good))), "term string, c long")
    found = {r["term"]: r["n"] for r in seen.groupBy("term").agg(F.countDistinct("c").alias("n")).collect()}
    out: dict[str, float] = {}
    for t in sorted(good, key=lambda t: (len(t.rstrip("*")), not t.endswith("*"), t)):
        word = t.rstrip("*")
        if _surplus(max(1, min(good[t]["n"], found.get(t, 0))), good[t]["m"], share) >= least and not any(word[:n] + "*" in out for n in STEMS if n <= len(word)):
            out[t] = good[t]["odds"]
    return out


def _phrases(lexicon, exceptions):
    """Each text's phrases of a hit's word with its neighbour: (phrase, toxic texts, clean texts)."""

    def run(batches):
        m = Matcher(lexicon.value, exceptions)
        for b in batches:
            toxic, clean = Counter(), Counter()
            for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), strict=True):
                text, mine = fold(text), set()
                for a, e, _ in m.hits(text):
                    while e < len(text) and text[e].isalpha():
                        e += 1
                    before, behind = re.search(r"[^\W\d_]+ $", text[max(0, a - 40) : a]), re.match(r" [^\W\d_]+", text[e : e + 40])
                    mine |= {x for x in (before and before[0] + text[a:e], behind and text[a:e] + behind[0]) if x}
                (toxic if y else clean).update(mine)
            names = list(toxic | clean)
            yield pa.RecordBatch.from_pydict({"phrase": pa.array(names, pa.string()), "bad": pa.array([toxic[x] for x in names], pa.int64()), "good": pa.array([clean[x] for x in names], pa.int64())})

    return run


def learn_exceptions(distinct: DataFrame, lexicon: dict[str, float], least: int = EXCEPTION_TEXTS) -> tuple[str, ...]:
    """The given phrases, and those around a hit that `least` clean texts hold and no toxic one."""
    if not lexicon:
        return EXCEPTIONS
    rows = distinct.mapInArrow(_phrases(distinct.sparkSession.sparkContext.broadcast(lexicon), EXCEPTIONS), "phrase string, bad long, good long")
    found = rows.groupBy("phrase").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter((F.col("bad") == 0) & (F.col("good") >= least))
    return (*EXCEPTIONS, *sorted(r["phrase"] for r in found.collect()))  # the bounded sample's


class Matcher:
    """The automaton of a lexicon and its exception phrases."""

    def __init__(self, lexicon: dict[str, float], exceptions=EXCEPTIONS):
        self.auto = ahocorasick.Automaton()
        entries: dict[str, list] = {}
        for t, w in lexicon.items():
            entries.setdefault(t.rstrip("*"), []).append(("stem" if t.endswith("*") else "word", w))
        for p in exceptions:
            entries.setdefault(fold(p), []).append(("exception", 0.0))
        for t, kinds in entries.items():
            self.auto.add_word(t, (len(t), kinds))
        self.auto.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the hits in a folded text; of hits in the same word the heaviest."""
        found, spared = {}, []
        for last, (n, kinds) in self.auto.iter(text):
            at, end = last - n + 1, last + 1
            if at and text[at - 1].isalpha():
                continue
            whole = end == len(text) or not text[end].isalpha()
            for kind, w in kinds:
                if kind == "exception":
                    if whole:
                        spared.append((at, end))
                elif (kind == "stem" or whole) and w > found.get(at, (0, 0.0))[1]:
                    found[at] = end, w
        return [(a, e, w) for a, (e, w) in sorted(found.items()) if not any(x <= a and e <= y for x, y in spared)]

    def features(self, text: str | None) -> tuple[float, float]:
        """Sum of weights (log scale), and sum by number of words."""
        if not text:
            return 0.0, 0.0
        text = fold(text)
        total = sum(w for _, _, w in self.hits(text))
        return math.log1p(total), math.log1p(100 * total / (10 + text.count(" ") + text.count("\n"))) if total else 0.0


def _features(lexicon, exceptions):
    def run(batches):
        m = Matcher(lexicon.value, exceptions)
        for b in batches:
            x = [m.features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"y": b.column("y"), "a": pa.array([v[0] for v in x], pa.float64()), "b": pa.array([v[1] for v in x], pa.float64())})

    return run


def _score(lexicon, exceptions, weights, names):
    def run(batches):
        m = Matcher(lexicon.value, exceptions)
        for b in batches:
            x = np.array([(*m.features(t), 1.0) for t in b.column("text").to_pylist()]).reshape(-1, 3)
            score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(score)], [*names, "score"])

    return run


def fit(sample: DataFrame) -> tuple[dict[str, float], tuple[str, ...], np.ndarray]:
    """Lexicon, exception phrases and curve from (text, y) rows of a bounded sample."""
    stash = Stash(sample.sparkSession, "toxicity")
    sample = stash.put(sample.select("text", F.col("y").cast("int").alias("y")))
    distinct = distinct_texts(sample, stash)
    lexicon = learn_lexicon(distinct)
    exceptions = learn_exceptions(distinct, lexicon)
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)
    rows = sample.mapInArrow(_features(shared, exceptions), "y int, a double, b double").collect()  # at most TRAIN_ROWS
    x = np.array([(r["a"], r["b"]) for r in rows]).reshape(-1, 2)
    stash.drop(sample, distinct)
    return lexicon, exceptions, logistic(x, np.array([r["y"] for r in rows], float))


def score_toxicity(docs: DataFrame, lexicon: dict[str, float], exceptions: tuple[str, ...], weights: np.ndarray, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in `keep` and `score`, row by row."""
    if "score" in keep:
        raise ValueError("a column to keep clashes with `score`")
    names = list(dict.fromkeys([*keep, "text"]))
    schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    return docs.select(*names).mapInArrow(_score(shared, exceptions, np.asarray(weights), names), f"{schema}, score double").select(*keep, "score")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS):
    return fit(labelled_sample(docs, labels, "toxic", rows, where=~held_out()))


def op8_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = score_toxicity(docs, *train(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(spark, docs, sf_dir, threshold: float = 0.5):
    """Pipeline stage: documents scored toxic go; all others stay as they are, nulls, empty texts and repeated rows included.

    Equal texts have equal scores, so ties go or stay together. An empty table gives no rows; other columns pass through, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = score_toxicity(packed(docs), *train(docs, labels), keep=("doc_id", "text", "_rest"))
    return unpacked(scored.filter(F.col("score") < threshold), docs.columns)
