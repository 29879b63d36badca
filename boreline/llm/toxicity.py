"""Toxicity from a learned lexicon, spelling automata and the words around a hit.

The lexicon comes from labelled documents: words, and stems that many words
start with, which occur in toxic documents far more often than in others. All
terms stand in one trie. For each distinct word of the corpus a Levenshtein
automaton (bit sets of the positions reached with no and with one edit) walks
that trie, so misspelled terms are found without listing misspellings. A hit
between quotation marks, or after a word of reporting, counts as quoted. A
logistic model over a few sums of a document's hits gives the score.

The model is fitted on at most ``SAMPLE`` labelled documents of each label;
everything else reads whole tables and whole texts.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boreline.llm.rows import map_rows, text_of

#: Labelled documents of each label that the model is fitted on, at most: those whose hashed ids are smallest.
SAMPLE = {1: 4000, 0: 8000}
#: Terms of the lexicon at most, best first.
MAX_TERMS = 2000
#: A term must be in so many toxic documents of the sample, and so many times likelier there than in others.
MIN_SHARE, MIN_DOCS, MIN_ODDS = 0.01, 4, 12.0
STEM = range(3, 9)
LEVELS = range(3)
#: Terms of at least so many letters may be hit with one edit.
FUZZY_LETTERS = 5
#: Words on each side of a hit that are its context.
WINDOW = 4
CACHE_ENTRIES = 150_000

# Words that report somebody else's words, in the corpus's languages.
REPORTING = frozenset(
    "said says say quote quoted quotes called calls wrote writes term word slur dit disait écrit appelé mot terme sagte sagt schrieb genannt wort begriff dijo dice escribió llamado palabra término".split()
)
QUOTES = re.compile("[\"“”«»„‹›]")
WORDS = re.compile(r"\w+")


class Trie:
    """Terms with their numbers; ``stem`` terms match words that go on."""

    def __init__(self, terms: list[tuple[str, bool]]):
        self.root: dict = {}
        self.fuzzy = [len(t) >= FUZZY_LETTERS for t, _ in terms]
        for number, (term, stem) in enumerate(terms):
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[1 if stem else 0] = number
        # With one edit at most, a word has the first half of the term at its start, or the second one place off at most.
        self.heads: dict[int, set[str]] = {}
        self.tails: dict[tuple[int, int], set[str]] = {}
        for k, (term, _) in enumerate(terms):
            half = len(term) // 2
            self.heads.setdefault(half, set()).add(term[:half])
            if self.fuzzy[k]:
                for start in (half - 1, half, half + 1):
                    self.tails.setdefault((start, start + len(term) - half), set()).add(term[half:])

    def possible(self, word: str) -> bool:
        return any(word[:n] in starts for n, starts in self.heads.items()) or any(word[a:b] in parts for (a, b), parts in self.tails.items())

    def hits(self, word: str) -> list[tuple[int, int]]:
        """(term, edits) of all terms within one edit of the word, or of a start of it."""
        at: dict[str, int] = {}
        for k, letter in enumerate(word):
            at[letter] = at.get(letter, 0) | 1 << k
        full = 1 << len(word)
        found: dict[int, int] = {}
        # Bit k: k letters of the word are read, with no edit (r0) or one at most (r1).
        todo = [(self.root, 1, 3)]
        while todo:
            node, r0, r1 = todo.pop()
            for letter, below in node.items():
                if letter == 0:
                    if r0 & full:
                        found[below] = 0
                    elif r1 & full and self.fuzzy[below]:
                        found.setdefault(below, 1)
                elif letter == 1:
                    if r0 & (full - 1):
                        found[below] = 0
                    elif r1 & (full - 1) and self.fuzzy[below]:
                        found.setdefault(below, 1)
                else:
                    mask = at.get(letter, 0)
                    n0 = (r0 & mask) << 1
                    n1 = ((r1 & mask) << 1 | r0 | r0 << 1 | n0 << 1 | n0) & (2 * full - 1)
                    if n1:
                        todo.append((below, n0, n1))
        return list(found.items())


class Finder(dict):
    """Hits of each distinct word, up to a fixed number of words."""

    def __init__(self, trie: Trie):
        super().__init__()
        self.trie = trie

    def __missing__(self, word: str) -> tuple[tuple[int, int], ...]:
        hits = tuple(self.trie.hits(word)) if self.trie.possible(word) else ()
        if len(self) < CACHE_ENTRIES:
            self[word] = hits
        return hits

    def read(self, text: str) -> tuple[int, list[tuple[int, int, bool]]]:
        """The number of words, and (term, edits, quoted) of every hit."""
        lowered = text.lower()
        words = WORDS.findall(lowered)
        if not any(map(self.__getitem__, set(words))):
            return len(words), []
        out = []
        spans = [(m.start(), m.end()) for m in WORDS.finditer(lowered)]
        for k, word in enumerate(words):
            if hits := self[word]:
                first, last = max(0, k - WINDOW), min(len(words) - 1, k + WINDOW)
                before, behind = lowered[spans[first][0] : spans[k][0]], lowered[spans[k][1] : spans[last][1] + 1]
                quoted = bool(QUOTES.search(before) and QUOTES.search(behind)) or not REPORTING.isdisjoint(words[first:k])
                out.extend((term, edits, quoted) for term, edits in hits)
        return len(words), out


@lru_cache(maxsize=2)
def finder_of(terms: tuple[tuple[str, bool], ...]) -> Finder:
    """One per Python worker, which serves many tasks."""
    return Finder(Trie(list(terms)))


@dataclass
class Model:
    terms: list[tuple[str, bool]]
    exact: list[list[float]]
    fuzzy: list[float]
    weights: list[float] = field(default_factory=list)

    def features(self, n_words: int, hits: list[tuple[int, int, bool]]) -> list[float]:
        direct: Counter = Counter()
        quoted: Counter = Counter()
        near: dict[int, float] = {}
        for term, edits, in_quotes in hits:
            if not edits:
                (quoted if in_quotes else direct)[term] += 1
            elif self.fuzzy[term] > 0:
                near[term] = max(near.get(term, 0.0), self.fuzzy[term] * (0.25 if in_quotes else 1.0))
        n = max(1, n_words)
        meant = {t: w for t, c in direct.items() if (w := self.exact[t][level_of(c, n)]) > 0}
        said = {t: w for t, c in quoted.items() if t not in meant and (w := self.exact[t][level_of(c, n)]) > 0}
        off = sum(w for t, w in near.items() if t not in meant and t not in said)
        times = sum(c for t, c in direct.items() if t in meant)
        return [1.0, sum(meant.values()), sum(said.values()), off, math.log1p(1000 * times / n)]

    def score(self, n_words: int, hits: list[tuple[int, int, bool]]) -> float:
        z = sum(w * x for w, x in zip(self.weights, self.features(n_words, hits), strict=True))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


#: What the sums of hits are worth before any document is seen: a quoted one a quarter.
PRIOR = np.array([-4.0, 0.6, 0.15, 0.4, 0.3])


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 5 == 0


def labelled_sample(labels: DataFrame, key: str, label: str) -> DataFrame:
    """Bounded: the smallest hashed ids of each label outside the held-out fold."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key))).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    parts = [known.where(F.col("label") == value).orderBy(F.xxhash64(key), key).limit(most) for value, most in SAMPLE.items()]
    return parts[0].unionByName(parts[1])


def level_of(times: int, n_words: int) -> int:
    """How much a document uses a term: 0 once or rarely, 1 repeatedly, 2 repeatedly in one of a hundred words."""
    if times < 2 or 1000 * times < 3 * n_words:
        return 0
    return 2 if 100 * times >= n_words else 1


class TermCounts:
    """Documents that use each word (False) or stem (True): numbers of one flat array, so that a term costs no objects but its text and its place."""

    def __init__(self, width: int):
        self.width = width
        self.clear()

    def clear(self) -> None:
        self.places: dict[bool, dict[str, int]] = {False: {}, True: {}}
        self.counts = array("q")
        self.blank = array("q", [0] * self.width)

    def __len__(self) -> int:
        return sum(map(len, self.places.values()))

    def add(self, term: str, stem: bool, first: int, levels: int) -> None:
        """One more document in columns ``first`` to ``first + levels``."""
        places = self.places[stem]
        start = places.get(term)
        if start is None:
            start = places[term] = len(self.counts)
            self.counts.extend(self.blank)
        for k in range(start + first, start + first + levels + 1):
            self.counts[k] += 1

    def batches(self, names: list[str], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(self.counts, np.int64).reshape(-1, self.width)
        for stem, places in self.places.items():
            known = iter(places.items())
            while part := list(islice(known, rows)):
                found = table[[start // self.width for _, start in part]]
                columns = [pa.array([t for t, _ in part], pa.string()), pa.array([stem] * len(part), pa.bool_())]
                columns += [pa.array(np.ascontiguousarray(found[:, k])) for k in range(self.width)]
                yield pa.RecordBatch.from_arrays(columns, names=["term", "stem", *names])


def _term_counts(sample: DataFrame) -> DataFrame:
    """How many toxic and other documents use each word and stem, at each level at least; counted within a task first."""
    names = [f"{kind}{k}" for kind in ("other", "toxic") for k in LEVELS]

    def run(batches):
        counts = TermCounts(len(names))

        def flush():
            yield from counts.batches(names)
            counts.clear()

        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = Counter(WORDS.findall(text.lower()))
                n = words.total()
                whole: Counter = Counter()
                stems: Counter = Counter()
                for word, times in words.items():
                    if len(word) >= STEM[0]:
                        whole[word] += times
                    for k in STEM:
                        if len(word) > k:
                            stems[word[:k]] += times
                for stem, uses in ((False, whole), (True, stems)):
                    for term, times in uses.items():
                        counts.add(term, stem, len(LEVELS) * label, level_of(times, n))
                if len(counts) > 400_000:
                    yield from flush()
        yield from flush()

    parts = sample.select("text", "label").mapInArrow(run, "term string, stem boolean, " + ", ".join(f"{n} bigint" for n in names))
    return parts.groupBy("term", "stem").agg(*(F.sum(n).alias(n) for n in names))


def _odds(toxic: float, other: float, n_toxic: int, n_other: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((other + 0.5) / (n_other + 1))


def _distinct_terms(rows: list) -> list:
    """Of nested stems the longest that covers as much, then the shortest of those left."""
    stems = {r.term: r for r in rows if r.stem}
    narrowed = {o[:-1] for o, q in stems.items() if (r := stems.get(o[:-1])) and q.toxic0 >= 0.9 * r.toxic0 and q.best >= 0.9 * r.best}
    whole = {r.term: r for r in rows if not r.stem}
    narrowed |= {t for t, r in stems.items() if any(w.startswith(t) and q.toxic0 >= 0.9 * r.toxic0 for w, q in whole.items())}
    left = stems.keys() - narrowed
    return [r for r in rows if (r.term in left or not r.stem) and not any(r.term[:k] in left for k in STEM if k < len(r.term))]


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learn lexicon, weights and model from the labelled documents outside the held-out fold."""
    chosen = labelled_sample(labels.select(key, label), key, label)
    sample = df.select(F.col(key), text_of(text).alias("text")).join(F.broadcast(chosen), key).select(key, "text", "label")
    # Copies of one document say no more than it does; which of them stays makes no difference.
    sample = sample.dropDuplicates(["text", "label"])
    sizes = dict(sample.groupBy("label").count().collect())
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_other:
        return Model([], [], [], PRIOR.tolist())
    least = max(MIN_DOCS, math.ceil(MIN_SHARE * n_toxic))
    worth = []
    for k in LEVELS:
        ratio = (F.col(f"toxic{k}") + 0.5) / (n_toxic + 1) / ((F.col(f"other{k}") + 0.5) / (n_other + 1))
        worth.append(F.when((F.col(f"toxic{k}") >= least) & (ratio >= MIN_ODDS), F.col(f"toxic{k}") * F.log(ratio)).otherwise(0.0))
    best = _term_counts(sample).withColumn("best", F.greatest(*worth)).where("best > 0").orderBy("best", "term", "stem", ascending=[False, True, True]).limit(MAX_TERMS)
    rows = _distinct_terms(best.collect())
    terms = [(r.term, r.stem) for r in rows]
    exact = [list(accumulate((_odds(r[f"toxic{k}"], r[f"other{k}"], n_toxic, n_other) for k in LEVELS), max)) for r in rows]

    seen = _hits(sample, terms, "label").collect()
    parsed = [(r.label, r.n_words, list(zip(r.terms, r.edits, r.quoted, strict=True))) for r in seen]
    near = {0: Counter(), 1: Counter()}
    for value, _, hits in parsed:
        whole = {t for t, e, _ in hits if not e}
        near[value].update({t for t, e, _ in hits if e} - whole)
    fuzzy = []
    for t, weights in enumerate(exact):
        known = near[0][t] + near[1][t]
        least_odds = _odds(near[1][t], near[0][t], n_toxic, n_other)
        fuzzy.append(max(0.0, min(0.7 * weights[0], least_odds) if known else 0.7 * weights[0]))
    model = Model(terms, exact, fuzzy)
    x = np.array([model.features(n, hits) for _, n, hits in parsed])
    y = np.array([value for value, _, _ in parsed], float)
    model.weights = _logistic(x, y).tolist()
    return model


def _logistic(x: np.ndarray, y: np.ndarray, pull: float = 2.0) -> np.ndarray:
    """Newton steps on the likelihood with a Gaussian prior around ``PRIOR``."""
    w = PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (p - y) + pull * (w - PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w)), gradient)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _hits(df: DataFrame, terms: list[tuple[str, bool]], carry: str) -> DataFrame:
    def make():
        finder = finder_of(tuple(terms))

        def work(carried, texts):
            found = [finder.read(t) for t in texts]
            return [carried, [n for n, _ in found], *([[h[k] for h in hits] for _, hits in found] for k in range(3))]

        return work

    return map_rows(df.select(carry, "text"), f"{carry} int, n_words bigint, terms array<int>, edits array<int>, quoted array<boolean>", make)


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` and ``n_hits`` of every row, from its text alone.

    Null and empty texts have no hits and get the score of a document without
    any. Equal texts get equal scores. Labels are not needed here.
    """

    def make():
        finder = finder_of(tuple(model.terms))

        def work(keys, texts):
            found = [finder.read(t) for t in texts]
            return [keys, [model.score(*f) for f in found], [len(h) for _, h in found]]

        return work

    kind = dict(df.dtypes)[key]
    return map_rows(df.select(F.col(key), text_of(text)), f"`{key}` {kind}, score double, n_hits bigint", make)


def score_column(model: Model, text: Column) -> Column:
    """The score as a column, for filters that keep whole rows."""

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        finder = finder_of(tuple(model.terms))
        return pd.Series([model.score(*finder.read(t)) for t in texts], dtype="float64")

    return scores(F.coalesce(text, F.lit("")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits")
