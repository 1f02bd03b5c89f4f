"""Language of a text: unigram models over a fixed public vocabulary, all segmentations summed.

A word's probability in a language is the sum, over every way to cut it into pieces of the
vocabulary, of the product of the pieces' probabilities; a forward pass over the bytes of the
word computes it. Piece probabilities are learned by expectation maximisation from the words
of a bounded sample of labelled texts. Single bytes stand in for what the vocabulary lacks, so
every word has a segmentation. Texts are scored whole: a text's score is the sum over its words.

Rows: a null or empty text, or one without a letter, is `und` with score 0; so is every text
when nothing can be learned. Rows with a null language or id teach nothing. Equal languages
resolve to the first by code point. Repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import BASE, byte_classes, BYTE_VALUES, mixed, other_columns, powers, schema_of, sent, text_slices, words, written
from lakesync.session import bounded_broadcast

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# Texts that a language learns from, and the characters of a text that may be one of them.
SAMPLE_ROWS, SAMPLE_CHARS = 300, 20_000
# Longest piece and longest word in bytes; a longer word is scored in parts.
PIECE_BYTES, WORD_BYTES = 12, 64
ROUNDS = 4
# Added to the expected count of every piece.
SMOOTHING = 0.05
# Keeps products of small probabilities in range; taken out again in the logarithm.
SCALE = 32.0
# Bytes of a word after which its sums are divided by the largest of them.
STRIDE = 8
# Scored words that a task remembers.
REMEMBERED = 400_000
SLOTS = 20
LETTERS = byte_classes([b for b in range(128) if not chr(b).isalpha()])
UNKNOWN = "und"


class Model(NamedTuple):
    """Languages in code point order, hashes of the pieces, probabilities [piece or byte, language]."""

    languages: list[str]
    hashes: np.ndarray
    odds: np.ndarray


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def pieces(path: str) -> list[bytes]:
    """Pieces of letters, with or without the space before a word, that lower-case text can hold."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = set()
    for i in range(model.get_piece_size()):
        text = "" if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) else model.id_to_piece(i).replace("▁", " ")
        if text[:1].strip() + text[1:] and (text[1:] if text[:1] == " " else text).isalpha() and text == text.lower():
            out.add(text.encode())
    return sorted(x for x in out if len(x) <= PIECE_BYTES)


def hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of stretches of bytes, as `common.words` has them."""
    summed = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data)), out=summed[1:])
    return mixed((summed[end] - summed[start]) * powers(pow(BASE, -1, 1 << 64), len(data))[start])


def index(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which slots are taken, and two tables from parts of a hash to the number of its piece."""
    shift, mask = np.uint64(64 - SLOTS), np.uint64((1 << SLOTS) - 1)
    first, second = np.zeros(1 << SLOTS, np.int32), np.zeros(1 << SLOTS, np.int32)
    taken = np.zeros(1 << SLOTS, bool)
    number = np.arange(len(hashes), dtype=np.int32)
    taken[hashes >> shift] = True
    first[hashes >> shift] = number
    hidden = first[hashes >> shift] != number
    second[hashes[hidden] & mask] = number[hidden]
    return taken, first, second


class Lattice:
    """All pieces found in a set of words: edges from node to node, in the order of their first byte."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, tables: tuple):
        """The words data[start:end], each read with a space before it."""
        taken, first, second = tables
        sizes = end - start + 1
        begin = np.concatenate([[0], np.cumsum(sizes)])
        word = np.repeat(np.arange(len(sizes)), sizes)
        inner = np.arange(begin[-1]) - begin[word]
        text = np.where(inner == 0, np.uint8(32), data[np.maximum(start[word] + inner - 1, 0)]) if len(word) else np.zeros(0, np.uint8)
        summed = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[text] * powers(BASE, len(text)), out=summed[1:])
        back = powers(pow(BASE, -1, 1 << 64), len(text))
        room = sizes[word] - inner
        shift, mask = np.uint64(64 - SLOTS), np.uint64((1 << SLOTS) - 1)
        found = []
        at = np.arange(len(text))
        for size in range(1, PIECE_BYTES + 1):
            at = at[room[at] >= size]
            key = mixed((summed[at + size] - summed[at]) * back[at])
            if size == 1:
                piece = first[key >> shift]
                piece = np.where(hashes[piece] == key, piece, second[key & mask]) if len(hashes) else piece
                known = hashes[piece] == key if len(hashes) else np.zeros(len(at), bool)
                found.append((at, np.full(len(at), 1, np.int8), np.where(known, piece, len(hashes) + text[at].astype(np.int32)).astype(np.int32)))
                continue
            some = taken[key >> shift]
            place, key = at[some], key[some]
            piece = first[key >> shift]
            piece = np.where(hashes[piece] == key, piece, second[key & mask]) if len(hashes) else piece
            some = hashes[piece] == key if len(hashes) else np.zeros(0, bool)
            found.append((place[some], np.full(int(some.sum()), size, np.int8), piece[some]))
        place, size, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        group = inner[place].astype(np.uint16) * 16 + size
        order = np.argsort(group, kind="stable")
        self.node = (place + word[place])[order]
        self.size, self.piece = size[order], piece[order]
        group = group[order]
        self.cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])) if len(group) else np.zeros(1, np.int64)
        self.inner = (group[self.cuts[:-1]] // 16).astype(np.int64)
        self.first = begin[:-1] + np.arange(len(sizes))
        self.last = self.first + sizes
        self.sizes = sizes

    def forward(self, odds: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Summed products of the ways from a word's beginning to each node, for each language, and what they were divided by.

        Every STRIDE bytes the sums that are under way in a word are divided by their largest, so a word of any
        pieces stays in range. The divisors are listed by stride as (words, divisor [word, language]).
        """
        sums = np.zeros((int(self.last[-1]) + 1 if len(self.last) else 0, odds.shape[1]))
        sums[self.first] = 1.0
        divisors = []

        def divide(upto: int) -> None:
            while (len(divisors) + 1) * STRIDE <= upto:
                at = (len(divisors) + 1) * STRIDE
                long = np.flatnonzero(self.sizes >= at)
                # An edge from before `at` ends less than PIECE_BYTES after it.
                nodes = np.minimum(self.first[long, None] + at + np.arange(PIECE_BYTES), self.last[long, None])
                under_way = sums[nodes]
                largest = under_way.max(axis=1)
                sums[nodes] = under_way / largest[:, None]
                divisors.append((long, largest))

        for a, b, inner in zip(self.cuts[:-1], self.cuts[1:], self.inner.tolist(), strict=True):
            divide(inner)
            node, size = self.node[a:b], int(self.size[a])
            # Edges of one size from one place: no two end in the same node.
            sums[node + size] += sums[node] * (odds[self.piece[a:b]] * SCALE**size)
        divide(int(self.sizes.max(initial=0)))
        return sums, divisors

    def logs(self, odds: np.ndarray) -> np.ndarray:
        """log probability of each word in each language."""
        sums, divisors = self.forward(odds)
        out = np.log(sums[self.last]) - self.sizes[:, None] * np.log(SCALE)
        for long, largest in divisors:
            out[long] += np.log(largest)
        return out

    def expected(self, odds: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece, over words that come `counts` [word, language] times."""
        ahead, divisors = self.forward(odds)
        behind = np.zeros_like(ahead)
        behind[self.last] = np.divide(counts, ahead[self.last], out=np.zeros_like(counts), where=counts > 0)
        out = np.zeros_like(odds)
        for a, b, inner in reversed(list(zip(self.cuts[:-1], self.cuts[1:], self.inner.tolist(), strict=True))):
            node, size, piece = self.node[a:b], int(self.size[a]), self.piece[a:b]
            step = odds[piece] * SCALE**size * behind[node + size]
            # The sums ahead were divided once more at every stride that the edge crosses.
            for long, largest in divisors[inner // STRIDE : (inner + size) // STRIDE]:
                step /= largest[np.searchsorted(long, np.searchsorted(self.first, node, "right") - 1)]
            behind[node] += step
            used = step * ahead[node]
            for language in range(odds.shape[1]):
                out[:, language] += np.bincount(piece, used[:, language], len(odds))
        return out


def learn(docs: DataFrame, vocabulary: str = VOCABULARY) -> Model:
    """Fit the models on at most about SAMPLE_ROWS texts of each language, chosen by a hash of doc_id; a task does it."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out())
    known = known.where(F.length("text") <= SAMPLE_CHARS)
    million = 1_000_000
    rates = known.groupBy("lang").agg(F.count("*").alias("rows"))
    rates = written(rates.select(F.col("lang").alias("of"), (F.lit(SAMPLE_ROWS * million) / F.col("rows")).alias("rate")), "language-rates")
    sample = (
        # A row for each language, counted first; texts are not shuffled for it.
        known.join(bounded_broadcast(rates), F.col("lang") == F.col("of"))
        .where(F.pmod(F.xxhash64(F.lit(10), "doc_id"), F.lit(million)) < F.col("rate"))
        .select("lang", F.lower("text").alias("text"))
    )
    names = pieces(vocabulary)
    ends = np.cumsum([len(x) for x in names], dtype=np.int64)
    hashes = hashed(np.frombuffer(b"".join(names), np.uint8), ends - np.array([len(x) for x in names], np.int64), ends)

    def train(batches):
        langs, texts = [], []
        for batch in batches:
            langs += batch.column("lang").to_pylist()
            texts.append(batch.column("text"))
        if langs:
            languages, odds = fitted(langs, pa.concat_arrays(texts), hashes)
            yield pa.RecordBatch.from_arrays([pa.array([languages]), pa.array([odds.tobytes()], pa.binary())], names=["languages", "odds"])

    row = sample.repartition(1).mapInArrow(train, "languages array<string>, odds binary").first()
    if row is None:
        return Model([], hashes, np.zeros((len(hashes) + 256, 0)))
    return Model(list(row.languages), hashes, np.frombuffer(bytes(row.odds)).reshape(-1, len(row.languages)))


def fitted(langs: list[str], column: pa.Array, hashes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Languages and probabilities [piece or byte, language] by expectation maximisation over labelled texts."""
    languages = sorted(set(langs), key=str.encode)
    number = {x: i for i, x in enumerate(languages)}
    lang = np.array([number[x] for x in langs])
    keys, owners, chunks = [], [], []
    for low, high, data, offsets in text_slices(column):
        key, row, start, end = words(data, offsets, LETTERS, WORD_BYTES)
        keys.append(key)
        owners.append(lang[low:high][row])
        _, at = np.unique(key, return_index=True)
        chunks += [(k, data[a:b].tobytes()) for k, a, b in zip(key[at].tolist(), start[at], end[at], strict=True)]
    spelled = dict(chunks)
    unique, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.zeros((len(unique), len(languages)))
    np.add.at(counts, (inverse, np.concatenate(owners)), 1.0)
    texts = [spelled[k] for k in unique.tolist()]
    ends = np.cumsum([len(x) for x in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    lattice = Lattice(data, ends - np.array([len(x) for x in texts], np.int64), ends, hashes, index(hashes))
    odds = np.full((len(hashes) + 256, len(languages)), 1.0 / (len(hashes) + 256))
    for _ in range(ROUNDS):
        odds = lattice.expected(odds, counts) + SMOOTHING
        odds /= odds.sum(axis=0)
    return languages, odds


def forgotten(model: Model) -> dict:
    return {"known": np.zeros(0, np.uint64), "logs": np.zeros((0, len(model.languages)))}


def scores(column: pa.Array, model: Model, tables: tuple, memory: dict) -> np.ndarray:
    """log probability [text, language] of whole texts."""
    out = np.zeros((len(column), len(model.languages)))
    for low, high, data, offsets in text_slices(column):
        key, row, start, end = words(data, offsets, LETTERS, WORD_BYTES)
        unique, at, inverse = np.unique(key, return_index=True, return_inverse=True)
        if len(memory["known"]) > REMEMBERED:
            memory |= forgotten(model)
        known, logs = memory["known"], memory["logs"]
        place = np.searchsorted(known, unique)
        new = place == len(known)
        new[~new] = known[place[~new]] != unique[~new]
        if new.any():
            fresh = Lattice(data, start[at[new]], end[at[new]], model.hashes, tables).logs(model.odds)
            known, logs = np.concatenate([known, unique[new]]), np.concatenate([logs, fresh])
            order = np.argsort(known)
            memory["known"], memory["logs"] = known, logs = known[order], logs[order]
        each = logs[np.searchsorted(known, unique)][inverse]
        for language in range(len(model.languages)):
            out[low:high, language] = np.bincount(row, each[:, language], high - low)
    return out


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred and score, the posterior of the predicted language; the text column must be `text`."""
    spark = docs.sparkSession
    shared = sent(spark, model)
    rest = other_columns(docs, ["text", "lang_pred", "score"])
    schema = schema_of(docs, rest).add("lang_pred", "string").add("score", "double")

    def run(batches):
        fitted = shared.value
        tables, memory = index(fitted.hashes), forgotten(fitted)
        names = np.array([*fitted.languages, UNKNOWN], dtype=object)
        for batch in batches:
            lettered = batch.column(len(rest)).to_numpy(zero_copy_only=False)
            if fitted.languages:
                logs = scores(batch.column(len(rest) + 1), fitted, tables, memory)
                best = logs.argmax(axis=1)
                score = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            else:
                best, score = np.zeros(len(lettered), np.int64), np.zeros(len(lettered))
                lettered = np.zeros(len(lettered), bool)
            best, score = np.where(lettered, best, len(names) - 1), np.where(lettered, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(rest))), pa.array(names[best], pa.string()), pa.array(score)], names=[*rest, "lang_pred", "score"]
            )

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    inputs = docs.select(*rest, lettered.alias("_lettered"), F.lower("text").alias("_text"))
    return inputs.mapInArrow(run, schema)


def document_languages(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    model = learn(docs.select("doc_id", "text", "lang"), vocabulary)
    return predicted(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
