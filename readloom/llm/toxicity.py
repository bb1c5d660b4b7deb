"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text.

Folding lower-cases, replaces look-alike letters of other scripts and digit or
sign substitutions by the letters they imitate, and turns everything that is
not a letter into blanks; ``l`` and ``i`` fold to one letter because ``1`` and
``|`` stand for both.  Lexicon entries are word stems anchored at a word start.
An exception phrase takes back the hits it contains.

Entries and weights (log odds of appearing in toxic against clean documents),
exception phrases and the calibration from hit weight and hit weight per length
to a probability are learned from ``SAMPLE`` labelled documents at most, chosen
by a hash of the id; of near copies among them (five-word shingles, similarity
of 0.8 or more as estimated from the sketches of operator 2) with the same label
only the one with the smallest id counts.  The driver holds
the lexicon, which is bounded by the sample's distinct words, none left out.

Results: scores depend on nothing but the text.  Null and empty texts have no
hits and get the score of a text without any; so are all texts where no label
is given.  Documents repeated in the input are scored each; labels repeated for
an id count once, toxic if any says so; labels of unknown or null ids don't
count.  An id that stands on several texts lends its label to each.  An empty
table gives an empty one.  Texts and words of any length are taken whole.
Further columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.bytesops import slices
from readloom.llm.near_dedup import sketch_rows
from readloom.llm.shared import stored

#: Labelled documents that the model is fitted on, at most.
SAMPLE = 20_000
#: Distinct toxic documents an entry needs, and its least log odds.
SUPPORT, ODDS = 6, 2.5
STEMS = range(4, 9)
#: Phrases that are harmless although they hold a lexicon word (fixed values; further ones are learned).
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "idiot proof", "circus clown", "clown fish", "pathetic fallacy")

# Letters that look like Latin ones (fixed values, from the shapes of the letters).
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ⅼ": "l",
}
_SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "|": "i"}
_TABLE = {i: " " for i in range(128) if not chr(i).isalpha()}
_TABLE |= {ord(a): b for a, b in (_LOOKALIKES | _SUBSTITUTES).items()}
_TABLE |= {0xFF41 + i: chr(97 + i) for i in range(26)}
_TABLE = {k: "i" if v == "l" else v for k, v in _TABLE.items()} | {ord("l"): "i"} | {c: " " for c in (0x2018, 0x2019, 0x201C, 0x201D, 0x2026, 0x2013, 0x2014, 0xAB, 0xBB, 0xA0)}
_AUTOMATA: dict[str, object] = {}


def fold(text: str) -> str:
    """Folded text, one blank ahead; as long as the lower-cased text plus one."""
    return " " + text.lower().translate(_TABLE)


@dataclass
class ToxicModel:
    """Lexicon weights, exception phrases and calibration."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    coef: tuple[float, float, float] = (-2.0, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        key = hashlib.sha256(repr((sorted(self.weights.items()), self.exceptions)).encode()).hexdigest()
        if key not in _AUTOMATA:
            a = ahocorasick.Automaton()
            for entry, w in self.weights.items():
                a.add_word(" " + entry, (len(entry) + 1, w))
            for phrase in self.exceptions:
                a.add_word(" " + phrase, (len(phrase) + 1, None))
            if len(a):
                a.make_automaton()
            _AUTOMATA[key] = a
        return _AUTOMATA[key]

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """Start, end and weight of the hits that no exception phrase covers; of nested hits the heaviest."""
        a = self.automaton()
        found, free = [], []
        for end, (size, w) in a.iter(folded) if len(a) else ():
            (free if w is None else found).append((end + 1 - size, end + 1, w))
        if free:
            found = [h for h in found if not any(s <= h[0] and h[1] <= e for s, e, _ in free)]
        best: dict[int, tuple[int, int, float]] = {}
        for h in found:
            if h[0] not in best or best[h[0]][2] < h[2]:
                best[h[0]] = h
        return list(best.values())

    def features(self, text: str | None) -> tuple[float, float]:
        """Log of the total hit weight, and of the weight per thousand characters."""
        folded = fold(text or "")
        total = sum(w for _, _, w in self.hits(folded))
        return math.log1p(total), math.log1p(1000 * total / len(folded))

    def score(self, text: str | None) -> float:
        x = self.coef[0] + sum(c * v for c, v in zip(self.coef[1:], self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def _fold_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([fold(t or "") for t in batch.column(0).to_pylist()], pa.string())], ["toxic", "folded"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = (Counter(), Counter())
    for batch in batches:
        for toxic, folded in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seen[toxic].update({w for w in folded.split() if len(w) >= 3})
    words = list(seen[0].keys() | seen[1].keys())
    yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([seen[1][w] for w in words], pa.int64()), pa.array([seen[0][w] for w in words], pa.int64())], ["word", "bad", "good"])


def _phrases(model: ToxicModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for toxic, folded in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = set()
                for start, end, _ in model.hits(folded):
                    before = re.search(r"(\S+) *$", folded[max(0, start - 40) : start + 1])
                    after = re.match(r"\S* +(\S+)", folded[end : end + 60])
                    entry = folded[start + 1 : end]
                    own |= {f"{before[1]} {entry}"} if before else set()
                    own |= {folded[start + 1 : end + after.end()]} if after else set()
                seen[toxic].update(own)
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([seen[1][w] for w in names], pa.int64()), pa.array([seen[0][w] for w in names], pa.int64())], ["phrase", "bad", "good"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the intercept comes first."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    keep = np.diag([1e-6] + [ridge] * (x.shape[1] - 1)) * len(x)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T * (p * (1 - p)) @ x + keep, x.T @ (p - y) + keep @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, exceptions: tuple[str, ...] = EXCEPTIONS, id_col: str = "doc_id", text_col: str = "text") -> ToxicModel:
    """Learn lexicon, exceptions and calibration from labelled documents (``doc_id, toxic``)."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("sha"))
    texts = stored(plain.join(F.broadcast(chosen), "doc_id"), "toxic-texts")  # chosen is bounded by the sample
    classes = sketch_rows(texts).select(F.col("id").alias("doc_id"), "sha", "low").distinct()
    once = texts.join(classes, ["doc_id", "sha"]).groupBy("low", "toxic").agg(F.min(F.struct("doc_id", "sha", "text")).alias("one")).select("one.text", "toxic")
    held = stored(once.mapInArrow(_fold_sample, "toxic int, folded string"), "toxic-sample")
    bad, good = held.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1)) - F.coalesce(F.sum("toxic"), F.lit(0))).first()
    words = held.mapInArrow(_word_counts, "word string, bad long, good long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    stems = words.select(F.explode(F.array_distinct(F.array("word", *(F.substring("word", 1, k) for k in STEMS)))).alias("stem"), "bad", "good")
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    picked = stems.groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).withColumn("w", odds).filter((F.length("stem") >= min(STEMS)) & (F.col("bad") >= SUPPORT) & (F.col("w") >= ODDS))
    model = ToxicModel(exceptions=sorted({fold(p).strip() for p in exceptions}))
    for stem, w in sorted(picked.select("stem", "w").collect(), key=lambda r: (len(r[0]), r[0])):
        if not any(model.weights.get(stem[:k], -1) >= w - 0.5 for k in range(min(STEMS), len(stem))):
            model.weights[stem] = round(w, 6)
    learned = held.mapInArrow(_phrases(model), "phrase string, bad long, good long").groupBy("phrase").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).filter("bad = 0 and good >= 3")
    model.exceptions += [r[0] for r in learned.select("phrase").orderBy("phrase").collect()]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = [sum(w for _, _, w in model.hits(f)) for f in batch.column(1).to_pylist()]
            sizes = [len(f) for f in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.float64()), pa.array(sizes, pa.int64())], ["toxic", "total", "size"])

    rows = np.array([tuple(r) for r in held.mapInArrow(features, "toxic int, total double, size long").collect()], float).reshape(-1, 3)
    if bad and good:
        x = np.column_stack((np.log1p(rows[:, 1]), np.log1p(1000 * rows[:, 1] / np.maximum(rows[:, 2], 1))))
        model.coef = tuple(float(c) for c in _logistic(x, rows[:, 0], 1e-4))
    return model


def score_toxicity(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id, held_out, score, predicted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            scores = [model.score(t) for t in batch.column(1).to_pylist()]
            held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.bool_()), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out fifth."""
    return labels.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)


def drop_toxic(docs: DataFrame, model: ToxicModel, text_col: str = "text") -> DataFrame:
    """The documents with a score under one half, with all their columns; decided row by row, so without a join."""
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, at)):
            yield batch.filter(pa.array([model.score(t) < 0.5 for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, schema)
