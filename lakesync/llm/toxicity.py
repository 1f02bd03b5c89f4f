"""Toxicity: a linear-chain conditional random field tags toxic tokens; its marginals make the score.

Labels belong to whole documents, so tokens are labelled first: words and beginnings of words
in a bounded sample of labelled rows whose share of toxic documents is far above the average
are marks, and a token with such a mark is toxic where it stands in a toxic document. A token's
feature is the strongest of its marks. The field has two tags, a weight for each mark at the
token and its neighbours, and weights for tag pairs, fitted by gradient steps on the exact likelihood.
Forward-backward gives each token its marginal; a logistic model on the expected number of
toxic tokens, their share and the highest marginal gives the document's score. Runs of words
that the field has no weights for are one step each (a power of the same matrix), which is
exact, so whole texts of any length are cheap.

Only text is an input of a score. Rows: a null or empty text scores as a text without words.
Rows with a null id or without a label of 0 or 1 teach nothing; nothing learned scores 0.
Repeated rows are scored each; several labels of one document all count. Other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import BARE_WORDS, other_columns, schema_of, sent, text_slices, words

# Labelled rows that the models are fitted on, and the characters of a text that may be one.
SAMPLE_ROWS, SAMPLE_CHARS = 5000, 20_000
# Beginnings of words, in bytes, that may be marks.
PREFIXES = (4, 5, 6, 7, 8, 9)
# Marks: found in so many documents, with so many times the average share of toxic ones; toxic ones have more.
LEAST_DOCS, KNOWN_ODDS, TOXIC_ODDS = 5, 2.0, 3.5
VOCABULARY = 4000
STEPS, RATE, DECAY = 150, 0.3, 1e-3
THRESHOLD = 0.3


class Model(NamedTuple):
    """Marks by hash and how strong they are; scores [mark, offset -1, 0, 1] towards the toxic tag; tag pairs; bias; logistic weights."""

    known: np.ndarray
    strength: np.ndarray
    scores: np.ndarray
    pairs: np.ndarray
    bias: float
    logistic: np.ndarray


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> pa.Table:
    """(text, toxic) of about SAMPLE_ROWS labelled rows outside the held-out quarter, chosen by a hash of doc_id."""
    marked = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out()).select("doc_id", "toxic")
    count = marked.count()
    million = 1_000_000
    few = marked.where(F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(million)) < SAMPLE_ROWS * million / max(1, count))
    texts = docs.where(F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS)).select("doc_id", "text")
    return few.join(texts, "doc_id").select("text", "toxic").orderBy(F.xxhash64("text", "toxic")).toArrow()


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes [word and its beginnings] and rows of the words of all texts."""
    hashes, rows = [np.zeros((0, 1 + len(PREFIXES)), np.uint64)], [np.zeros(0, np.int64)]
    for low, _, data, offsets in text_slices(column):
        h, r, _, _ = words(data, offsets, BARE_WORDS, prefixes=PREFIXES)
        hashes.append(h)
        rows.append(low + r)
    return np.concatenate(hashes), np.concatenate(rows)


def marks(hashes: np.ndarray, rows: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known marks, how strong, which are toxic): words and beginnings whose documents are toxic far above the average."""
    known, strength = [], []
    average = toxic.mean()
    for column in hashes.T:
        some = column != 0
        unique, inverse = np.unique(column[some], return_inverse=True)
        pair = np.unique(inverse.astype(np.int64) * len(toxic) + rows[some])
        mark, row = pair // len(toxic), pair % len(toxic)
        docs = np.bincount(mark, minlength=len(unique))
        bad = np.bincount(mark, toxic[row], len(unique))
        # The lower end of an interval for the share, so that a few documents prove little.
        share = bad / np.maximum(docs, 1)
        low = share - 1.64 * np.sqrt((share * (1 - share) + 0.5 / np.maximum(docs, 1)) / np.maximum(docs, 1))
        odds = np.where(docs >= LEAST_DOCS, low / average, 0)
        known.append(unique[odds >= KNOWN_ODDS])
        strength.append(odds[odds >= KNOWN_ODDS])
    known, strength = np.concatenate(known), np.concatenate(strength)
    order = np.argsort(-strength, kind="stable")[:VOCABULARY]
    order = order[np.argsort(known[order])]
    return known[order], strength[order], strength[order] >= min(TOXIC_ODDS, 0.6 / average)


def numbers(hashes: np.ndarray, known: np.ndarray, strength: np.ndarray) -> np.ndarray:
    """The strongest known mark of each token, -1 without one."""
    out = np.full(len(hashes), -1)
    if not len(known):
        return out
    best = np.zeros(len(hashes))
    taken = np.zeros(1 << 16, bool)
    taken[known >> np.uint64(48)] = True
    for column in hashes.T:
        some = np.flatnonzero(taken[column >> np.uint64(48)])
        place = np.minimum(np.searchsorted(known, column[some]), len(known) - 1)
        better = (known[place] == column[some]) & (strength[place] > best[some])
        some, place = some[better], place[better]
        out[some], best[some] = place, strength[place]
    return out


def messages(unary: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised forward and backward messages [step, sequence, tag] and log sums, of sequences of one length."""
    steps = len(unary)
    ahead, behind = np.empty_like(unary), np.ones_like(unary)
    total = np.zeros(unary.shape[1])
    at = unary[0]
    for t in range(steps):
        if t:
            at = (ahead[t - 1] @ transitions) * unary[t]
        norm = at.sum(axis=1, keepdims=True)
        ahead[t] = at / norm
        total += np.log(norm[:, 0])
    for t in range(steps - 2, -1, -1):
        at = (behind[t + 1] * unary[t + 1]) @ transitions.T
        behind[t] = at / at.sum(axis=1, keepdims=True)
    return ahead, behind, total


def fitted(hashes: np.ndarray, rows: np.ndarray, toxic: np.ndarray, width: int = 32) -> Model:
    """Marks and the weights of the field, by ascent on the likelihood of the token labels.

    The texts are cut into stretches of `width` tokens, which are learned side by side.
    """
    known, strength, bad = marks(hashes, rows, toxic)
    if not bad.any():
        return Model(known[:0], strength[:0], np.zeros((0, 3)), np.ones((2, 2)), 0.0, np.zeros(5))
    word = numbers(hashes, known, strength)
    word[word < 0] = len(known)
    tag = (np.append(bad, False)[word] & (toxic[rows] == 1)).astype(np.int64)
    size = len(word) // width * width
    word, tag = word[:size].reshape(-1, width).T, tag[:size].reshape(-1, width).T
    # Stretches without a mark teach only what the field is like without toxic words; a share of them does.
    told = (word < len(known)).any(axis=0)
    chosen = np.flatnonzero(told)
    others = np.flatnonzero(~told)
    chosen = np.concatenate([chosen, others[: max(200, len(chosen) // 2)]])
    word, tag = word[:, chosen], tag[:, chosen]
    absent = np.full((1, word.shape[1]), len(known))
    views = (np.concatenate([absent, word[:-1]]), word, np.concatenate([word[1:], absent]))
    scores, pairs, bias = np.zeros((len(known) + 1, 3)), np.zeros((2, 2)), -2.0
    moments: dict[str, tuple] = {}
    n = word.size

    def stepped(name: str, value, slope, step: int):
        """One step of gradient ascent with adapted rates."""
        one, two = moments.get(name, (0.0, 0.0))
        one, two = 0.9 * one + 0.1 * slope, 0.99 * two + 0.01 * slope * slope
        moments[name] = one, two
        return value + RATE * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-8)

    for step in range(1, STEPS + 1):
        score = bias + sum(scores[v, k] for k, v in enumerate(views))
        unary = np.stack([np.ones_like(score), np.exp(np.clip(score, -30, 30))], axis=2)
        transitions = np.exp(pairs)
        ahead, behind, _ = messages(unary, transitions)
        both = ahead * behind
        marginal = both[:, :, 1] / both.sum(axis=2)
        error = tag - marginal
        slopes = np.stack([np.bincount(v.ravel(), error.ravel(), len(known) + 1) for v in views], axis=1) / n
        edge = ahead[:-1, :, :, None] * transitions * (behind[1:] * unary[1:])[:, :, None, :]
        edge /= edge.sum(axis=(2, 3), keepdims=True)
        seen = np.zeros((2, 2))
        np.add.at(seen, (tag[:-1].ravel(), tag[1:].ravel()), 1.0)
        scores = stepped("scores", scores, slopes - DECAY * scores / 100, step)
        scores[-1] = 0
        pairs = stepped("pairs", pairs, (seen - edge.sum(axis=(0, 1))) / n - DECAY * pairs / 100, step)
        bias = stepped("bias", bias, error.sum() / n, step)
    return Model(known, strength, scores[:-1], np.exp(pairs), float(bias), np.zeros(5))


def tagged(word: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of the tokens near marks of one text, their places, and the expected toxic tokens of all the others.

    `word` has the number of each token's mark, or -1.
    """
    n = len(word)
    near = np.flatnonzero(word >= 0)
    places = np.unique(np.clip((near[:, None] + np.array([-1, 0, 1])).ravel(), 0, n - 1)) if n else near
    if n:
        places = np.unique(np.concatenate([places, [0, n - 1]]))
    padded = np.concatenate([[-1], word, [-1]])
    score = np.full(len(places), model.bias)
    # A mark's weights at -1, 0 and 1 are for the token after it, itself and the token before it.
    for k in range(3):
        there = padded[places + k]
        score += np.where(there >= 0, model.scores[there, k], 0) if len(model.scores) else 0
    unary = np.stack([np.ones(len(places)), np.exp(np.clip(score, -30, 30))], axis=1)
    plain = np.array([1.0, np.exp(model.bias)])
    # Tokens without weights between two places: powers of one matrix.
    step = model.pairs * plain
    values, left = np.linalg.eig(step)
    right = np.linalg.inv(left)
    scale = np.abs(values).max()

    def power(k: int) -> np.ndarray:
        return ((left * (values / scale) ** k) @ right).real

    ahead, behind = np.empty((len(places), 2)), np.ones((len(places), 2))
    for t in range(len(places)):
        at = unary[t] if t == 0 else (ahead[t - 1] @ power(int(places[t] - places[t - 1]) - 1) @ model.pairs) * unary[t]
        ahead[t] = at / at.sum()
    rest = 0.0
    for t in range(len(places) - 2, -1, -1):
        gap = int(places[t + 1] - places[t]) - 1
        into = model.pairs @ (behind[t + 1] * unary[t + 1])
        at = power(gap) @ into
        if gap:
            # Inside a run the marginals meet the run's own level within a few tokens of its ends.
            inside = np.arange(min(gap, 64))
            weights = left @ ((values[:, None] / scale) ** (gap - 1 - inside) * (right @ into)[:, None])
            begin = (ahead[t] @ left)[:, None] * (values[:, None] / scale) ** (inside + 1)
            share = (right.T @ begin).real * weights.real
            share = share[1] / share.sum(axis=0)
            rest += share.sum() + (gap - len(inside)) * share[len(inside) // 2]
        behind[t] = at / at.sum()
    both = ahead * behind
    return places, both[:, 1] / both.sum(axis=1) if len(places) else np.zeros(0), rest


def measures(hashes: np.ndarray, rows: np.ndarray, count: int, model: Model) -> tuple[np.ndarray, dict]:
    """What the logistic model sees of each text, and (places, marginals) of the texts with marks."""
    n = np.bincount(rows, minlength=count)
    out = np.zeros((count, 4))
    details = {}
    if len(model.known) and len(hashes):
        word = numbers(hashes, model.known, model.strength)
        first = np.searchsorted(rows, np.arange(count + 1))
        for row in np.unique(rows[word >= 0]).tolist():
            places, marginal, _ = tagged(word[first[row] : first[row + 1]], model)
            sums = marginal.sum()
            out[row] = [np.log1p(sums), min(sums, 20.0) / 4, marginal.max(), min(1.0, 25 * sums / n[row])]
            details[row] = places, marginal
    return out, details


def logistic(features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights of a logistic model, the constant last, by Newton steps."""
    x = np.column_stack([features, np.ones(len(features))])
    weights = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (toxic - p) - 0.05 * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(weights))
        weights = weights + np.linalg.solve(curve, slope)
    return weights


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    rows = sample(docs, labels)
    toxic = rows.column("toxic").to_numpy().astype(np.float64)
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    hashes, row = tokens_of(rows.column("text").combine_chunks())
    model = fitted(hashes, row, toxic)
    return model._replace(logistic=logistic(measures(hashes, row, len(toxic), model)[0], toxic))


def scored(docs: DataFrame, model: Model | None, spans: bool = False) -> DataFrame:
    """docs without text, with score, predicted and, on request, the offending stretches.

    `spans` are start:end:marginal of toxic words (marginal of 0.5 or more), offsets in code points.
    """
    shared = sent(docs.sparkSession, model)
    names = ["score", "predicted"] + (["spans"] if spans else [])
    rest = other_columns(docs, ["text", *names])

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = batch.column("text")
            score, found = np.zeros(len(texts)), [""] * len(texts)
            for low, high, data, offsets in text_slices(texts) if model else ():
                hashes, rows, _, _ = words(data, offsets, BARE_WORDS, prefixes=PREFIXES)
                features, details = measures(hashes, rows, high - low, model)
                x = features @ model.logistic[:-1] + model.logistic[-1]
                score[low:high] = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
                if spans:
                    for row, (places, marginal) in details.items():
                        found[low + row] = offending(data[offsets[row] : offsets[row + 1]], places[marginal >= 0.5], marginal[marginal >= 0.5])
            columns = [pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))] + ([pa.array(found)] if spans else [])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *columns], names=[*rest, *names])

    schema = schema_of(docs, rest).add("score", "double").add("predicted", "integer")
    if spans:
        schema.add("spans", "string")
    return docs.select(*rest, F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def offending(raw: np.ndarray, places: np.ndarray, marginal: np.ndarray) -> str:
    """Offsets, in code points, of the words at these places of a text."""
    # Words as `common.words` counts them, but with places in the raw text.
    kind = BARE_WORDS[raw]
    letter = np.flatnonzero(kind == 1)
    if not len(letter) or not len(places):
        return ""
    gaps = np.concatenate([[0], np.cumsum(kind == 0)])
    new = np.concatenate([[True], gaps[letter[1:]] != gaps[letter[:-1] + 1]])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(letter)) - 1
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return ",".join(f"{points[letter[begin[p]]]}:{points[letter[end[p]] + 1]}:{m:.3f}" for p, m in zip(places.tolist(), marginal.tolist(), strict=True))


def document_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and spans of every document."""
    model = learn(docs.select("doc_id", "text"), labels)
    return scored(docs.select("doc_id", held_out().alias("held_out"), "text"), model, spans=True)
