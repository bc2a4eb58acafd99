"""Toxicity: a logistic model over words and word beginnings, with counterfactual regularisation.

Training. A bounded sample of labelled texts (``max_train`` rows, those whose id
has the smallest hash) is cut into features inside tasks; Spark counts how many
positive and negative texts hold each, and the ``max_features`` with the
strongest association stay. The driver gets, per sampled text, the numbers of
its selected features only, and fits a logistic regression by gradient descent.

Counterfactual term. Sentences of the sample that hold an identity term are
repeated with the term replaced by others of its group. A change of the score
between the two is penalised by its square, so the weights of identity terms
(and of what only tells them apart) are drawn together, and a neutral sentence
scores alike whichever group it mentions.

Scoring. The model is at most ``max_features`` weights; every whole text is
scored in Spark tasks. Labels, ids and all other columns stay out of a score.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import name

WORD = re.compile(r"[^\W\d_]+(?:[-'*][^\W\d_]+)*")
SENTENCE = re.compile(r"[^.!?\n]+")
PREFIXES = (4, 5, 6)
CHUNK = 1 << 20

# Groups of identity terms; a term may be replaced by any other of its group.
IDENTITY_GROUPS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "lesbian", "bisexual", "straight", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "blind", "deaf", "old", "young"),
)
PARTNERS = {t: tuple(o for o in g if o != t) for g in IDENTITY_GROUPS for t in g}


@dataclass(frozen=True)
class Settings:
    max_train: int = 20_000  # labelled rows that are learned from, at most
    max_features: int = 8_192
    min_texts: int = 3  # a feature is in so many sampled texts at least
    counterfactual: float = 4.0  # weight of the penalty on score changes
    least_ratio: float = 20.0  # likelihood ratio from which a feature isn't taken for chance
    ridge: float = 5e-4
    steps: int = 600


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def scorer(self) -> Callable[[str], float]:
        table, bias = self.weights, self.bias

        def score(text: str) -> float:
            z = bias + sum(table[f] for f in text_features(text, table))
            return 1 / (1 + np.exp(-z)) if z > -500 else 0.0

        return score


def words_of(text: str) -> set[str]:
    """The different words of a whole text in lower case, a megabyte in work at a time."""
    found: set[str] = set()
    at = 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and not text[end].isspace():
            end += 1
        found.update(WORD.findall(text[at:end].lower()))
        at = end
    return found


def features(word: str) -> list[str]:
    return [word, *[word[:n] + "~" for n in PREFIXES if len(word) > n]]


def text_features(text: str, known) -> set[str]:
    """The features of a text that are ``known``; each counts once, however often it occurs."""
    return {f for w in words_of(text) for f in features(w) if f in known}


def swapped(text: str) -> Iterator[tuple[str, str]]:
    """Sentences that hold an identity term, each with the sentence in which all of them are replaced."""
    for m in SENTENCE.finditer(text):
        sentence = m[0].lower()
        if not any(w in PARTNERS for w in WORD.findall(sentence)):
            continue
        for turn in range(2):
            other = WORD.sub(lambda w: PARTNERS[w[0]][turn % len(PARTNERS[w[0]])] if w[0] in PARTNERS else w[0], sentence)
            yield sentence, other



def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """(id, text, y) of at most ``most`` labelled rows.

    The list of ids has a proven bound, so it is broadcast and texts don't move.
    """
    known = labels.where(name(label_col).isNotNull() & name(id_col).isNotNull())
    y = known.groupBy(name(id_col).alias("id")).agg(F.max(name(label_col).cast("int")).alias("y"))
    there = y.join(docs.select(name(id_col).alias("id")).distinct(), "id", "left_semi")
    chosen = there.orderBy(F.xxhash64("id"), "id").limit(most)
    texts = docs.select(name(id_col).alias("id"), F.coalesce(name(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("text", "y")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    settings: Settings = Settings(),
) -> Model:
    """Learn from the labelled rows; without any, or without both labels, a model that scores 0.

    A null label or id isn't learned from; of repeated labels of an id the larger counts.
    """
    sample = _sample(docs, labels, id_col, text_col, label_col, settings.max_train)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, y in zip(b.column(0), b.column(1), strict=True):
                text = text.as_py()
                mine = list({f for w in words_of(text) for f in features(w)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mine, pa.string()), pa.array([y.as_py()] * len(mine), pa.int32())], ["feature", "y"]
                )

    counts = (
        sample.mapInArrow(cut, "feature string, y int").groupBy("feature")
        .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q")).where(F.col("p") + F.col("q") >= settings.min_texts)
    )
    size = sample.agg(F.coalesce(F.sum("y"), F.lit(0)), F.coalesce(F.sum(1 - F.col("y")), F.lit(0))).first()
    n_pos, n_neg = int(size[0]), int(size[1])
    if not n_pos or not n_neg:
        return Model({}, -700.0)
    # likelihood ratio statistic of being in a positive text; what speaks for clean text isn't used:
    # however much of it there is, it doesn't outweigh an insult
    p, q, n = F.col("p"), F.col("q"), n_pos + n_neg
    part = lambda c, of: F.when(c > 0, c * F.log(c * n / ((p + q) * of))).otherwise(0.0)
    ratio = 2 * (part(p, n_pos) + part(q, n_neg))
    telling = counts.where((p * n_neg > q * n_pos) & (ratio >= settings.least_ratio))
    top = telling.orderBy(ratio.desc(), "feature").limit(settings.max_features).collect()
    index = {r["feature"]: i for i, r in enumerate(top)}

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, ys, kinds = [], [], []
            for text, y in zip(b.column(0), b.column(1), strict=True):
                text = text.as_py()
                rows.append(sorted(index[f] for f in text_features(text, index)))
                ys.append(y.as_py())
                kinds.append(0)
                pairs = set()
                for one, other in swapped(text):
                    f, g = text_features(one, index), text_features(other, index)
                    if f != g:
                        pairs.add((tuple(sorted(index[x] for x in f - g)), tuple(sorted(index[x] for x in g - f))))
                for f, g in sorted(pairs):
                    # what the swap takes away as it is, what it brings as -1 - number
                    rows.append([*f, *[-1 - x for x in g]])
                    ys.append(0)
                    kinds.append(1)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.list_(pa.int32())), pa.array(ys, pa.int32()), pa.array(kinds, pa.int32())],
                    ["f", "y", "kind"],
                )

    got = sample.mapInArrow(numbers, "f array<int>, y int, kind int").groupBy("f", "y", "kind").count().collect()
    got.sort(key=lambda r: (r["kind"], r["y"], r["f"]))
    weights, bias = _descend([r for r in got if r["kind"] == 0], [r for r in got if r["kind"] == 1], len(index), settings)
    return Model({f: float(weights[i]) for f, i in index.items() if weights[i]}, float(bias))


def _sparse(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(r["f"]) for r in rows], np.int64)
    flat = np.array([x for r in rows for x in r["f"]], np.int64)
    sign = np.where(flat < 0, -1.0, 1.0)
    return np.repeat(np.arange(len(rows)), lengths), np.where(flat < 0, -1 - flat, flat), sign, np.array([r["count"] for r in rows], float)


def _descend(texts: list, pairs: list, k: int, s: Settings) -> tuple[np.ndarray, float]:
    """Adam over the whole sample; both labels weigh alike."""
    at, col, _, n = _sparse(texts)
    y = np.array([r["y"] for r in texts], float)
    n = n * np.where(y == 1, 0.5 / max(n[y == 1].sum(), 1), 0.5 / max(n[y == 0].sum(), 1))
    p_at, p_col, p_sign, p_n = _sparse(pairs)
    p_n = p_n / max(p_n.sum(), 1)
    w, m, v = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, s.steps + 1):
        z = np.bincount(at, w[col], len(y)) + w[k]
        off = n * (1 / (1 + np.exp(-z)) - y)
        grad = np.append(np.bincount(col, off[at], k), off.sum())
        grad[:k] += s.ridge * w[:k]
        if len(p_at):
            change = p_n * np.bincount(p_at, p_sign * w[p_col], len(p_n))
            grad[:k] += s.counterfactual * np.bincount(p_col, p_sign * change[p_at], k)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:k], w[k]


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if not given) with ``out``: 0 to 1, higher if toxicity is likelier.

    Null and empty texts hold no features and get the score of the bias. Texts
    of any length are read whole.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.weights, model.bias))  # at most max_features weights

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        of = Model(*sent.value).scorer()
        return pd.Series([of(t) if isinstance(t, str) else of("") for t in texts], dtype="float64")

    columns = [name(c) for c in (docs.columns if keep is None else keep)]
    return docs.select(*columns, scores(name(text_col)).alias(out))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(name(id_col).cast("string")) % 3 == 1, F.lit(False))


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7
) -> DataFrame:
    """(id, held_out, score, predicted) per row of ``docs``; learns from rows that aren't held out only."""
    seen = docs.where(~held_out(id_col))
    model = fit(seen, labels.where(~held_out(id_col)), id_col, text_col)
    scored = score(docs, model, text_col, "score", [id_col])
    return scored.select(
        name(id_col), held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_clean(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7
) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, in all their columns."""
    seen = docs.where(~held_out(id_col))
    model = fit(seen, labels.where(~held_out(id_col)), id_col, text_col)
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # names of their own, whatever the columns are called
    mine = docs.select(*[name(c).alias(a) for c, a in at.items()])
    kept = score(mine, model, at[text_col], "toxicity").where(F.col("toxicity") < threshold)
    return kept.select(*[F.col(a).alias(c) for c, a in at.items()])
