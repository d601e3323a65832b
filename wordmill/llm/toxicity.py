"""Toxicity by multiple-instance learning: documents have labels, sentences get scores.

A document is toxic if any of its sentences is, so its score is the noisy-or of theirs,
1 - prod(1 - s). A sentence's score is a logistic function of the weights of its words, a bias
and the logarithm of how many sentences of the document have a weighted word at all: a sentence
that is no worse than others then adds the less the more of them there are, and a clean document
does not become toxic by its length. Weights and bias are trained from document labels alone, by
the same score documents are judged by. A sentence without a weighted word scores 0.

What a sentence would score as the only one of a document says whether it is an offending one.

A word weighs what it weighs itself and what its beginnings of 3 to 8 letters weigh, so that
forms of a word that the training documents don't have weigh something too.

The weights are fitted in one task on a bounded sample of labelled documents of any length:
``SAMPLE`` of each class and ``SAMPLE_CHARS`` characters of each class in all, some 40 MB of
plain English. All documents are scored where they lie.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.sources.checkpoints import materialise

SAMPLE = 2000  # training documents of each class at most
SAMPLE_CHARS = 40_000_000  # characters of the training documents of each class together at most
FOLDS = 5
MIN_SURPRISE = 24.0  # log-likelihood ratio a feature needs; some one in a million has it by chance
PREFIXES = range(3, 9)
SENTENCE_WORDS = 40  # a longer sentence is cut
ROUNDS = 150
RATE = 0.15
DECAY = 2e-4
BIAS = -5.0
MIN_WEIGHT = 0.02
CACHED_WORDS = 1 << 19

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    """Whether a document's label must not be learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def features(word: str) -> list[str]:
    """What a word is known by: itself and its beginnings."""
    return [f"={word}", *(word[:k] for k in PREFIXES if len(word) >= k)]


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and words of the sentences of a text that have words."""
    for match in _SENTENCE.finditer(text):
        words = _WORD.findall(match.group().lower())
        for k in range(0, len(words), SENTENCE_WORDS):
            yield match.start(), match.end(), words[k : k + SENTENCE_WORDS]


def _surprise(toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int) -> np.ndarray:
    """Log-likelihood ratio of a feature's share of toxic sentences against chance; 0 if it is less."""
    n, share = toxic + clean, all_toxic / (all_toxic + all_clean)
    parts = [x * np.log(np.maximum(x, 1e-12) / (n * chance)) for x, chance in ((toxic, share), (clean, 1 - share))]
    return np.where(toxic > n * share, 2 * (parts[0] + parts[1]), 0.0)


def fit(texts: list[str], toxic: np.ndarray, weights: np.ndarray) -> tuple[dict[str, float], float]:
    """Feature weights and bias from whole documents; ``weights`` is how much each counts."""
    types: dict[str, int] = {}
    tokens, sizes, per_text = [], [], []
    for text in texts:
        before = len(sizes)
        for _, _, words in sentences(text):
            tokens.extend([types.setdefault(word, len(types)) for word in words])
            sizes.append(len(words))
        per_text.append(len(sizes) - before)
    has = np.array(per_text) > 0
    if not tokens or len(set(toxic[has].tolist())) < 2:
        return {}, BIAS
    token, size = np.array(tokens, np.int32), np.array(sizes)
    sentence_of = np.repeat(np.arange(len(size)), size)
    text_of_sentence = np.repeat(np.arange(int(has.sum())), np.array(per_text)[has])
    y, share = toxic[has].astype(float), weights[has] / weights[has].sum() * has.sum()

    # A sentence counts once however many copies of it there are, and as clean if one of them
    # stands in a clean document. Features have to be in far more toxic ones than by chance.
    cut = np.split(token, np.cumsum(size)[:-1])
    clean_ones: dict[bytes, bool] = {}
    for words, is_toxic in zip(cut, (y[text_of_sentence] > 0).tolist()):
        key = np.unique(words).tobytes()
        clean_ones[key] = clean_ones.get(key, False) or not is_toxic
    known = [features(word) for word in types]
    counts = {True: Counter(), False: Counter()}
    for key, clean in clean_ones.items():
        counts[clean].update({f for t in np.frombuffer(key, np.int32).tolist() for f in known[t]})
    total = {clean: sum(value == clean for value in clean_ones.values()) for clean in counts}
    if not total[True] or not total[False]:
        return {}, BIAS
    names = list(counts[False])
    surprise = _surprise(
        np.array([counts[False][f] for f in names], float), np.array([counts[True][f] for f in names], float), total[False], total[True]
    )
    number: dict[str, int] = {f: k for k, f in enumerate(f for f, x in zip(names, surprise.tolist()) if x >= MIN_SURPRISE)}
    pairs = [(t, number[f]) for t, found in enumerate(known) for f in found if f in number]
    type_of, feature_of = (np.array(x, np.int32) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int32),) * 2

    # Sentences without a feature say nothing either way.
    weighs = np.bincount(type_of, minlength=len(types))[token] > 0
    kept, sentence_of = np.unique(sentence_of[weighs], return_inverse=True)
    token, text_of_sentence = token[weighs], text_of_sentence[kept]
    if not token.size:
        return {}, BIAS

    w, bias = np.zeros(len(number)), BIAS
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    starts = np.searchsorted(sentence_of, np.arange(len(kept)))
    others = np.log(np.bincount(text_of_sentence)[text_of_sentence])
    for step in range(1, ROUNDS + 1):
        of_type = np.bincount(type_of, w[feature_of], len(types))
        z = np.clip(np.add.reduceat(of_type[token], starts) + bias - others, -30, 30)
        s = 1 / (1 + np.exp(-z))
        clean = np.exp(-np.bincount(text_of_sentence, np.logaddexp(0, z), len(y)))  # no sentence toxic
        pull = np.where(y > 0, -clean / np.maximum(1 - clean, 1e-9), 1.0) * share
        g = s * pull[text_of_sentence] / len(y)
        by_type = np.bincount(token, g[sentence_of], len(types))
        gw, gb = np.bincount(feature_of, by_type[type_of], len(w)) + DECAY / len(y) * w, g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        own, other = 1 - 0.9**step, 1 - 0.999**step
        w -= RATE * (m / own) / (np.sqrt(v / other) + 1e-8)
        bias -= RATE * (mb / own) / (np.sqrt(vb / other) + 1e-8)
    return {f: float(w[k]) for f, k in number.items() if abs(w[k]) >= MIN_WEIGHT}, float(bias)


def _fit_rows(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["order", "text"], kind="stable")  # the same model however rows arrive
    found, bias = fit(rows["text"].tolist(), rows["toxic"].to_numpy() == 1, rows["weight"].to_numpy())
    # The bias goes by the empty feature, which no word has.
    return pd.DataFrame({"feature": ["", *found], "weight": [bias, *found.values()]})


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Weights by feature, and the bias as that of the empty one, from documents not held out."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    classes = materialise(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "classes")
    order = F.xxhash64("doc_id")
    lengths = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("chars"))
    lengths = lengths.join(classes, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("chars").alias("chars"))
    known = materialise(classes.join(lengths, "doc_id").where(F.col("chars") <= SAMPLE_CHARS), "known")
    sizes = {row["toxic"]: row["n"] for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = None
    for value in sorted(sizes):
        some = known.where(F.col("toxic") == value).orderBy(order, "doc_id").limit(sample)
        # Of a class with long documents fewer are taken: a running sum over the sample's few rows.
        so_far = F.sum("chars").over(Window.partitionBy("toxic").orderBy(order, "doc_id"))
        some = some.withColumn("so_far", so_far).where(F.col("so_far") <= SAMPLE_CHARS).drop("chars", "so_far")
        some = materialise(some, "some")
        some = some.withColumn("weight", F.lit(sizes[value] / some.count()))
        picked = some if picked is None else picked.unionByName(some)
    if picked is None:
        return {"": BIAS}
    picked = materialise(picked.withColumn("order", order), "sample")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Rows that agree in doc_id are one training document.
    rows = materialise(texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(*[F.min(c).alias(c) for c in ("text", "toxic", "weight", "order")]), "training")
    fitted = rows.groupBy().applyInPandas(_fit_rows, "feature string, weight double")
    return {row["feature"]: row["weight"] for row in fitted.collect()} or {"": BIAS}


def noisy_or(sums: np.ndarray, bias: float) -> tuple[float, np.ndarray]:
    """The score of a document from its sentences' sums of weights, and theirs as the only ones."""
    weighs = sums != 0
    z = np.clip(sums[weighs] + bias, -30, 30)
    alone = np.zeros(len(sums))
    alone[weighs] = 1 / (1 + np.exp(-z))
    clean = np.logaddexp(0, z - np.log(max(1, len(z)))).sum()
    return float(-np.expm1(-clean)), alone


def _scores(model):
    """Scores of batches of texts under a broadcast model."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights = model.value
        bias, cache = weights[""], {}

        def weight(word):
            found = cache.get(word)
            if found is None:
                if len(cache) >= CACHED_WORDS:
                    cache.clear()
                found = cache[word] = sum(weights.get(f, 0.0) for f in features(word))
            return found

        for texts in batches:
            scores, located = [], []
            for text in texts:
                spans, z = [], []
                for start, end, words in sentences(text):
                    spans.append((start, end))
                    z.append(sum(map(weight, words)))
                total, alone = noisy_or(np.array(z), bias)
                scores.append(total)
                located.append([{"start": a, "end": b, "score": float(x)} for (a, b), x in zip(spans, alone) if x >= 0.5])
            yield pd.DataFrame({"score": scores, "sentences": located})

    return F.pandas_udf(run, "score double, sentences array<struct<start:int,end:int,score:double>>")


def score(docs: DataFrame, model: dict[str, float]) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, sentences``.

    ``sentences`` are those with a score of 0.5 or more, as start, end (in code points) and
    score. Null and empty texts have no sentence and score 0. Repeated rows come out repeatedly.
    Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = docs.select("doc_id", _scores(shared)(F.coalesce("text", F.lit(""))).alias("s"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("s.score").alias("score"),
        (F.col("s.score") >= 0.5).cast("int").alias("predicted"),
        F.col("s.sentences").alias("sentences"),
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled documents that are not held out, score all; see ``score``."""
    return score(docs, train(docs, labels))
