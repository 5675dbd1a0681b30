"""Toxicity: a weighted lexicon, matched by Aho-Corasick after folding.

Folding lower-cases, maps look-alike letters of other scripts to Latin, and
reads digits and signs inside words as the letters they stand for.  The
automaton holds whole words and word stems with weights, and exception
phrases: a match inside one of them does not count.  The weighted sum,
normalised by the length in words, becomes a probability by a logistic curve.

Lexicon, exceptions and curve are learnt on the driver from the whole texts of
at most TRAIN_ROWS labelled rows, 48 MB together (the documented bound of the
sample).  Near copies among them count once, so that the words of one
much-copied text are not taken for toxic ones.  The least number of texts of a
pattern is chosen over folds of these rows; held-out rows are never looked at.

Defined edge cases: null and empty texts have no match and get the curve's
value at 0; without labels of both kinds all scores are close to 0; an empty
table gives an empty result; repeated rows and repeated or null doc_ids are
scored each; folding and matching take time in proportion to the text, also
for one very long word; ``drop_toxic`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import math
import re
import unicodedata
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from corpusloom.llm.common import free_names, table
from corpusloom.llm.learning import TRAIN_BYTES, split_of, training_texts

TRAIN_ROWS = 6000
STEM, LONGEST_STEM = 4, 9  # in characters
MIN_DOCS = (3, 4, 6)  # least number of toxic texts with a pattern: the settings to choose from
FOLDS = 3
NEAR = 0.8
MIN_PURITY = 0.9
THRESHOLD = 0.3
WORD = re.compile(r"\w+")
#: Letters of other scripts that look like Latin ones.
LOOKS = dict(zip("асеорхуіјѕһԁԛԝгмткњвнѵӏɑɡıոսօհցκοανρτυιηχε", "aceopxyijshdqwrmtkhbhvlagiuuohgkoavptuinxe"))
#: Characters without width, and combining marks that no composed letter has taken in.
UNSEEN = re.compile("[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u206a-\u206f\ufe00-\ufe0f\ufeff]")
LOOSE = re.compile("[\u0300-\u036f]")
HOMOGLYPHS, SEEN = str.maketrans(LOOKS), re.compile(f"[{''.join(LOOKS)}]")
#: Digits and signs that stand for letters inside words.
DIGITS = str.maketrans("013457@$!", "oieastasi")
#: A whole run of word characters and signs with a digit or sign in it; each place of a text is looked at once.
RUN = re.compile(r"(?<![\w@$!])[^\W0-9]*+[0-9@$!][\w@$!]*+")
INSIDE = re.compile(r"[^\W\d_][0-9@$!]+[^\W\d_]")
AHEAD = re.compile(r"[0-9][0-9@$]*[^\W\d_]{2}")


def _spelled(run: re.Match) -> str:
    """The run with digits and signs read as letters if they stand between or before letters; signs at its ends stay."""
    word = run[0]
    body = word.strip("!")
    if not (INSIDE.search(body) or AHEAD.match(body)):
        return word
    return word.replace(body, body.translate(DIGITS), 1)


def fold(text: str | None) -> str:
    """Words in folded form between single spaces, with a space at both ends.

    Fullwidth, mathematical and other compatibility forms become plain letters (NFKC), marks that stand on look-alikes or
    on nothing a composed letter has, and characters without width, are left out.
    """
    t = (text or "").lower()
    if not t.isascii():
        t = unicodedata.normalize("NFKC", UNSEEN.sub("", t)).lower()
        if SEEN.search(t):
            t = t.translate(HOMOGLYPHS)
        t = unicodedata.normalize("NFC", t)
        if LOOSE.search(t):
            t = LOOSE.sub("", t)
    return " " + " ".join(WORD.findall(RUN.sub(_spelled, t))) + " "


class Lexicon:
    """Weighted patterns and exception phrases over folded text, and the curve from weight and length to a probability."""

    def __init__(self, weights: dict[str, float], exceptions: Iterable[str] = (), curve: tuple[float, float, float] = (-4.0, 6.0, 1.0)) -> None:
        self.weights, self.exceptions, self.curve = dict(weights), frozenset(exceptions), curve

    @functools.cached_property
    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for p in self.weights.keys() | self.exceptions:
            a.add_word(p, (len(p), self.weights.get(p, 0.0), p in self.exceptions))
        a.make_automaton()
        return a

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve}

    def total(self, folded: str) -> float:
        """Weight of all matches that are not inside an exception phrase."""
        if not self.weights:
            return 0.0
        found: list[tuple[int, int, float]] = []
        excused: list[tuple[int, int]] = []
        for end, (size, weight, exception) in self.automaton.iter(folded):
            if exception:
                excused.append((end + 1 - size, end))
            elif weight:
                found.append((end + 1 - size, end, weight))
        if not excused:
            return sum(w for _, _, w in found)
        excused.sort()
        starts, reach = [s for s, _ in excused], list(itertools.accumulate((e for _, e in excused), max))

        def counts(start: int, end: int) -> bool:
            i = bisect.bisect_right(starts, start)
            return not i or reach[i - 1] < end

        return sum(w for s, e, w in found if counts(s, e))

    def features(self, folded: str) -> tuple[float, float]:
        """Matched weight: whether any, and per hundred words on a log scale."""
        total = self.total(folded)
        return min(1.0, total), math.log1p(100 * total / (folded.count(" ") + 20))

    def score(self, text: str | None) -> float:
        return self.probability(fold(text))

    def probability(self, folded: str) -> float:
        a, b = self.features(folded)
        c0, c1, c2 = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, c0 + c1 * a + c2 * b))))


_SKETCH = np.random.RandomState(31).randint(0, 1 << 62, 8, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _shingles(words: list[str]) -> np.ndarray:
    """Sorted hashes of the distinct three-word shingles."""
    grams = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    return np.sort(np.fromiter(map(xxhash.xxh3_64_intdigest, grams), np.uint64, len(grams)))


def without_near_copies(rows: Iterable[tuple[str, int]]) -> list[tuple[int, str]]:
    """(label, folded text) of the texts with words that are no near copy of an earlier one that stayed.

    A near copy has NEAR of all three-word shingles of both in common; the sets
    are compared wherever one of eight minimum hashes is equal.
    """
    met: list[dict[int, list[int]]] = [defaultdict(list) for _ in _SKETCH]
    sets: list[np.ndarray] = []
    docs = []
    for text, y in rows:
        folded = fold(text)
        words = folded.split()
        if not words:
            continue
        own = _shingles(words)
        lows = [int((own * f ^ (own * f >> np.uint64(32))).min()) for f in _SKETCH]
        near = {i for m, low in zip(met, lows) for i in m.get(low, ())}
        shared = ((len(np.intersect1d(own, sets[i], assume_unique=True)), len(sets[i])) for i in near)
        if any(both >= NEAR * (len(own) + n - both) for both, n in shared):
            continue
        for m, low in zip(met, lows):
            m[low].append(len(sets))
        sets.append(own)
        docs.append((y, folded))
    return docs


class _Counted:
    """In how many texts of each fold and label each whole word and stem occurs."""

    def __init__(self, docs: list[tuple[int, str]]) -> None:
        self.docs = docs
        self.fold = [xxhash.xxh3_64_intdigest(f) % FOLDS for _, f in docs]
        self.texts = np.zeros((FOLDS, 2), int)
        self.df: dict[str, array] = defaultdict(lambda: array("I", bytes(8 * FOLDS)))
        for (y, folded), k in zip(docs, self.fold):
            self.texts[k, y] += 1
            keys = set()
            for w in set(folded.split()):
                keys.add(f" {w} ")
                keys.update(f" {w[:n]}" for n in range(STEM, min(len(w), LONGEST_STEM) + 1))
            for key in keys:
                self.df[key][2 * k + y] += 1

    def fit(self, min_docs: int, without: int | None = None) -> Lexicon:
        """The lexicon of all folds but one."""
        used = [k for k in range(FOLDS) if k != without]
        n = self.texts[used].sum(axis=0).tolist()
        if not n[0] or not n[1]:
            return Lexicon({}, curve=(-30.0, 0.0, 0.0))
        count = lambda key: (sum(self.df[key][2 * k] for k in used), sum(self.df[key][2 * k + 1] for k in used))
        good: dict[str, tuple[int, int]] = {}
        for key, c in self.df.items():
            if sum(c[1::2]) >= min_docs:
                clean, toxic = count(key)
                share = toxic / n[1] / (toxic / n[1] + clean / n[0] + 1e-12)
                if toxic >= min_docs and share >= MIN_PURITY and toxic >= 0.8 * (clean + toxic):
                    good[key] = clean, toxic
        weights: dict[str, float] = {}
        for k in sorted(good, key=lambda k: (len(k.rstrip()), k)):
            stem = k.rstrip()
            if not any(stem[:i] in good and not stem[:i].endswith(" ") and stem[:i] != k for i in range(STEM + 1, min(len(stem), LONGEST_STEM + 1) + 1)):
                weights[k] = round(math.log((good[k][1] + 0.5) / n[1] / ((good[k][0] + 0.5) / n[0])), 4)
        docs = [d for d, k in zip(self.docs, self.fold) if k != without]
        phrases: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        matcher = Lexicon(weights)
        for y, f in docs:
            for end, _w in matcher.automaton.iter(f) if weights else ():
                for phrase in _around(f, end):
                    phrases[phrase][y] += 1
        lex = Lexicon(weights, {p for p, c in phrases.items() if c[0] >= 3 and not c[1]})
        x = np.array([[1.0, *lex.features(f)] for _, f in docs])
        y = np.array([y for y, _ in docs], float)
        beta = np.zeros(3)
        for _ in range(30):  # Newton steps with a small ridge
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            hess = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
            beta = beta + np.linalg.solve(hess, x.T @ (y - p) - 0.05 * beta)
        lex.curve = tuple(float(b) for b in beta)
        return lex

    def loss(self, min_docs: int) -> float:
        """Mean log loss of the texts of each fold under the lexicon of the others."""
        total = 0.0
        for k in range(FOLDS):
            lex = self.fit(min_docs, without=k)
            for (y, f), own in zip(self.docs, self.fold):
                if own == k:
                    total -= math.log(max(1e-9, lex.probability(f) if y else 1 - lex.probability(f)))
        return total / max(1, len(self.docs))


def learn(texts: list[str], labels: list[int], settings: tuple[int, ...] = MIN_DOCS) -> Lexicon:
    """Lexicon from labelled texts; of the settings that with the least loss over folds of these very texts, the first of equals."""
    counted = _Counted(without_near_copies(zip(texts, labels)))
    chosen = min(settings, key=counted.loss) if len(settings) > 1 else settings[0]
    return counted.fit(chosen)


def _around(folded: str, end: int) -> list[str]:
    """The two-word phrases around the word that ends about ``end``."""
    stop = folded.find(" ", end if folded[end] == " " else end + 1)
    start = folded.rfind(" ", 0, stop)
    before, after = folded.rfind(" ", 0, start), folded.find(" ", stop + 1)
    return [p for p in (folded[before : stop + 1] if before >= 0 else "", folded[start : after + 1] if after > 0 else "") if p]


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, total: int = TRAIN_BYTES) -> Lexicon:
    return learn(*training_texts(docs, labels, "toxic", split_of(F.col("doc_id"), 4) != 2, rows, total))


def with_score(docs: DataFrame, lexicon: Lexicon, name: str = "score") -> DataFrame:
    """``docs`` with the toxicity of each text as column ``name``."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    kept = docs.drop(name)
    at = kept.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [sent.value.score(t.as_py()) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], names=[*b.schema.names, name])

    return kept.mapInArrow(run, StructType([*kept.schema.fields]).add(name, DoubleType()))


def drop_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose toxicity is below ``threshold``; columns as given."""
    (name,) = free_names(docs, "_toxicity")
    return with_score(docs, lexicon, name).filter(F.col(name) < threshold).drop(name)


def op7_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = with_score(docs.select("doc_id", "text"), fit_toxicity(docs, labels))
    return scored.select("doc_id", (split_of(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op7_lexicon_toxicity": op7_lexicon_toxicity}
ORACLES: dict[str, str] = {}
