"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence has the probability
``sigmoid(b + sum of its words' weights)``, a document the noisy-or of its
sentences, ``1 - prod(1 - p_s)``, and only document labels are needed to train
the weights: the likelihood's gradient flows through the noisy-or to the
sentences that explain the label.  Afterwards the sentence probabilities
locate the offending sentences.

Words are lower-cased runs of letters and digits; a word stands for itself
and for its first four and five letters, so word families share evidence.

Training runs in one task on a bounded sample: at most ``max_bags`` labelled
documents of each class, those whose id hashes lowest.  Only the ids are
ranked; the texts of the sample, whole, are then fetched by id.  The model is
a table of at most ``max_features`` weights.  Scoring is one pass over all
documents without a shuffle.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqweave.llm.common import chunks, id_text
from seqweave.session import ship_package

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")
BIAS = ""  # the key of the bias in the weight table


def word_features(word: str) -> tuple[str, ...]:
    """A word's own feature and those of its first letters."""
    return (word, "4" + word[:4] + "*", "5" + word[:5] + "*") if len(word) > 3 else (word,)


def sentences(text: str) -> list[tuple[int, int]]:
    """Offsets (code points) of the sentences: runs without ``. ! ?`` or line ends."""
    return [m.span() for m in _SENTENCE.finditer(text)]


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _evidence(pos: np.ndarray, n: np.ndarray, rate: float) -> np.ndarray:
    """Log-likelihood ratio (G2) of a feature's share of toxic documents against the overall share.

    Features below about ``2 ln(number of features)`` are what chance alone brings; leaving them out
    keeps the noisy-or from explaining labels by rare words.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(pos > 0, pos * np.log(pos / (n * rate)), 0.0)
        b = np.where(n > pos, (n - pos) * np.log((n - pos) / (n * (1 - rate))), 0.0)
    return 2 * (a + b)


def fit_noisy_or(texts: list[str], labels: list[int], min_docs: int = 4, max_features: int = 100_000,
                 steps: int = 150, rate: float = 0.1, l2: float = 1e-4) -> dict[str, float]:
    """Weights of a noisy-or model (full-batch Adam); equal texts count once.

    Without both classes the model is the bias alone.
    """
    bags = {t: y for t, y in sorted(zip(texts, labels, strict=True))}
    total = max(1, len(bags))
    rate_pos = (sum(bags.values()) + 0.5) / (total + 1.0)
    if not 0 < sum(bags.values()) < len(bags):
        return {BIAS: float(np.log(rate_pos / (1 - rate_pos)) - 3.0)}
    ids: dict[str, int] = {}
    rows, cols, sent_doc, df, df_doc = [], [], [], [], []
    for d, text in enumerate(bags):
        seen: set[int] = set()
        for sentence in _SENTENCE.findall(text.lower()):
            feats = {f for w in set(_WORD.findall(sentence)) for f in word_features(w)}
            mine = [ids.setdefault(f, len(ids)) for f in feats]
            rows.extend([len(sent_doc)] * len(mine))
            cols.extend(mine)
            sent_doc.append(d)
            seen.update(mine)
        df.extend(seen)
        df_doc.extend([d] * len(seen))
    rows, cols = np.array(rows, np.int32), np.array(cols, np.int32)
    sent_doc = np.array(sent_doc, np.int32)
    df, df_doc = np.array(df, np.int64), np.array(df_doc, np.int64)
    y = np.array(list(bags.values()), float)
    freq = np.bincount(df, minlength=len(ids))
    gain = _evidence(np.bincount(df, y[df_doc], len(ids)), freq, y.mean())
    order = np.lexsort((np.arange(len(ids)), -gain))
    kept = order[:max_features]
    kept = kept[(freq[kept] >= min_docs) & (gain[kept] >= 2 * np.log(len(ids)) + 8)]
    place = np.full(len(ids), -1, np.int32)
    place[kept] = np.arange(len(kept))
    use = place[cols] >= 0
    rows, cols = rows[use], place[cols[use]]
    n_sent, n_feat, n_doc = len(sent_doc), len(kept), len(y)
    theta = np.zeros(n_feat + 1)
    theta[-1] = -5.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        z = np.bincount(rows, theta[cols], n_sent) + theta[-1]
        p = 1 / (1 + np.exp(-z))
        miss = np.bincount(sent_doc, _softplus(z), n_doc)  # -log(1 - P)
        prob = np.clip(-np.expm1(-miss), 1e-12, 1.0)
        per_doc = np.where(y == 1, -np.exp(-miss) / prob, 1.0)
        dz = p * per_doc[sent_doc] / n_doc
        grad = np.append(np.bincount(cols, dz[rows], n_feat), dz.sum())
        grad[:-1] += l2 * theta[:-1] / n_doc
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    names = list(ids)
    model = {names[i]: float(theta[k]) for k, i in enumerate(kept) if abs(theta[k]) > 1e-4}
    model[BIAS] = float(theta[-1])
    return model


class SentenceScorer:
    def __init__(self, model: dict[str, float]):
        self.bias = model.get(BIAS, -5.0)
        get = model.get
        self.weight = lru_cache(200_000)(lambda w: sum(get(f, 0.0) for f in word_features(w)))

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's probability and (start, end, probability) of each sentence."""
        low, weight = text.lower(), self.weight
        same = len(low) == len(text)  # a few letters change length in lower case
        spans = sentences(text if not same else low)
        if not same:
            parts = [text[a:b].lower() for a, b in spans]
        else:
            parts = [low[a:b] for a, b in spans]
        # a text without a sentence counts as one sentence without words
        z = np.array([self.bias + sum(map(weight, set(_WORD.findall(s)))) for s in parts] or [self.bias])
        prob = 1 / (1 + np.exp(-z))
        return float(-np.expm1(-_softplus(z).sum())), [(a, b, float(p)) for (a, b), p in zip(spans, prob, strict=False)]


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", max_bags: int = 3000) -> DataFrame:
    """The model as a table ``feature string, weight double``, learnt from ``labels`` (one row per id).

    Rows without a label are ignored.  Empty input gives a model with the bias alone.
    """
    spark = docs.sparkSession
    ship_package(spark)
    lab = labels.select(F.col(id_col).alias("_lid"), F.col(label_col).cast("int").alias("_y"))
    lab = lab.filter(F.col("_y").isNotNull() & F.col("_lid").isNotNull())
    order = [F.xxhash64("_lid"), F.col("_lid")]
    sample = None
    for y in (0, 1):
        part = lab.filter(F.col("_y") == y).orderBy(*order).limit(max_bags)
        sample = part if sample is None else sample.unionByName(part)
    # at most 2 * max_bags narrow rows: bounded by the parameter
    bags = id_text(docs, id_col, text_col).join(F.broadcast(sample), F.col("_id") == F.col("_lid")).select(
        "_text", "_y")

    def fit(batches):
        texts, ys = [], []
        for b in batches:
            texts += b.column(0).to_pylist()
            ys += b.column(1).to_pylist()
        model = fit_noisy_or(texts, ys)
        yield pa.RecordBatch.from_arrays([pa.array(list(model)), pa.array(list(model.values()), pa.float64())],
                                         names=["feature", "weight"])

    return bags.repartition(1).mapInArrow(fit, "feature string, weight double")


def score_toxicity(docs: DataFrame, model: dict[str, float], id_col: str = "doc_id", text_col: str = "text",
                   located: float = 0.5) -> DataFrame:
    """Per document: ``_id, _key`` (hash of the text) ``, score, n_sentences, offending`` (offsets and probability of the
    sentences at or above ``located``).  Empty and NULL texts get the score of one empty sentence."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by max_features
    src = id_text(docs, id_col, text_col).select("_id", F.xxhash64("_text").alias("_key"), "_text")
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches):
        scorer = SentenceScorer(shared.value)
        for b in batches:
            texts = b.column(2).to_pylist()
            for i, j in chunks(texts, 8_000_000):
                scored = [scorer.score(t) for t in texts[i:j]]
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(i, j - i),
                    b.column(1).slice(i, j - i),
                    pa.array([s for s, _ in scored], pa.float64()),
                    pa.array([len(x) for _, x in scored], pa.int32()),
                    pa.array([[{"start": a, "end": e, "p": p} for a, e, p in x if p >= located] for _, x in scored], spans),
                ], names=["_id", "_key", "score", "n_sentences", "offending"])

    kind = dict(src.dtypes)["_id"]
    return src.mapInArrow(run, f"_id {kind}, _key long, score double, n_sentences int, "
                               "offending array<struct<start:int,end:int,p:double>>")


def collect_model(table: DataFrame) -> dict[str, float]:
    """The weights on the driver (at most ``max_features`` rows); an empty table is a bias alone."""
    return {BIAS: -5.0} | {r["feature"]: r["weight"] for r in table.collect()}
