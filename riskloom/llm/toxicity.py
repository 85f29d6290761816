"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

The kernel of two words counts common subsequences of three letters, each weighted by
``DECAY`` to the length it spans in either word, spans of up to ``SPAN`` letters: an
insult with inserted or left-out letters still shares most of them. Before that a word
loses everything but letters (digits and signs that stand for letters become those),
accents go, and single letters in a row become one word ("i d i o t"). A word's
feature vector is divided by the length its subsequence weights would have if all
differed, so long words do not win by length.

Only a document's label is known, not its insults, so training is by witnesses: in a
bounded sample of labelled documents (``sample_toxic``, ``sample_clean``, chosen by the
hash of doc_id) those are the words that recur in toxic documents which are no copies of
each other and are rare in clean ones, and their forms with one letter more. Frequent and
highest-scoring words of clean sentences are the negatives, mined anew in each round. The
machine is fitted on Nyström features of the kernel's third power to ``landmarks`` of
these words. A text's margin is the largest of its words'; a logistic curve fitted on the
sample makes it a score from 0 to 1. A table of each triple's largest weight among the
toxic landmarks bounds a word's kernels, so most words need no more than that bound.

Defined results: null, empty or letterless texts get the score of the lowest margin;
rows are scored one by one, so repeated rows score alike; labels that are null, or stand
on a null ``doc_id``, are not used; without toxic or clean labelled rows all scores are 0.
Only ``doc_id`` and ``text`` are read, and only the text is an input of the score.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbytes as tb

SPAN, DECAY = 6, 0.7
LETTERS = 32
#: Below a kernel of NEAR with all toxic landmarks a word gets the margin LOWEST.
NEAR = 0.5
LOWEST = -2.0
_STEPS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
_WEIGHTS = np.array([DECAY ** (j + 1) for _, j in _STEPS], np.float32)

#: Classes of bytes: 1 to 26 letters, 27 to 31 rests of other characters, 0 dropped.
_PLAIN = np.zeros(256, np.uint8)
_PLAIN[97:123] = np.arange(1, 27)
_PLAIN[65:91] = np.arange(1, 27)
for _sign, _letter in zip("013457@$!", "oieastasi"):
    _PLAIN[ord(_sign)] = ord(_letter) - 96
_PLAIN[128:192] = 27 + np.arange(64) % 5
#: Second bytes after 0xC3: accented Latin letters as their base.
_ACCENTED = _PLAIN.copy()
for _first, _last, _letter in ((0x80, 0x85, "a"), (0x87, 0x87, "c"), (0x88, 0x8B, "e"), (0x8C, 0x8F, "i"), (0x91, 0x91, "n"), (0x92, 0x96, "o"), (0x99, 0x9C, "u"), (0x9F, 0x9F, "s")):
    _ACCENTED[_first : _last + 1] = ord(_letter) - 96
    _ACCENTED[_first + 32 : _last + 33] = ord(_letter) - 96


def letter_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter classes of all words, the words' offsets (n + 1), and per text the index of its first word (n + 1)."""
    data, offsets = tb.utf8(column)
    code = _PLAIN[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    code[after] = _ACCENTED[data[after]]
    starts, ends, firsts = tb.spans(data, offsets, tb.SPACES)
    sums = np.concatenate([[0], np.cumsum(code > 0)])
    size = sums[ends] - sums[starts]
    text = np.repeat(np.arange(len(column)), np.diff(firsts))
    keep = size > 0
    size, text, begin = size[keep], text[keep], sums[starts[keep]]
    own = np.ones(len(size), bool)
    own[1:] = (size[1:] > 1) | (size[:-1] > 1) | (text[1:] != text[:-1])
    code = code[code > 0]
    return code, np.append(begin[own], len(code)), np.searchsorted(text[own], np.arange(len(column) + 1))


def _lengths(sizes: np.ndarray) -> np.ndarray:
    total = np.zeros(len(sizes), np.float32)
    for (_, j), w in zip(_STEPS, _WEIGHTS):
        total += w * w * np.maximum(sizes - j, 0)
    return np.sqrt(np.maximum(total, 1e-12))


def _triples(code: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.float32]]:
    """For each shape of a gapped triple: its number at each letter, whether it ends inside the word, its weight."""
    wide = np.concatenate([code, np.zeros(SPAN, np.uint8)]).astype(np.int32)
    left = (np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(code))).astype(np.int32)
    high = wide[: len(code)] << 10
    for (i, j), w in zip(_STEPS, _WEIGHTS):
        yield (high | wide[i : len(code) + i] << 5) | wide[j : len(code) + j], left > j, w


def kernel(code: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Kernel of each word with each landmark; ``marks`` has a row per triple and a column per landmark."""
    total = np.zeros((len(code) + 1, marks.shape[1]), np.float32)
    for triple, inside, w in _triples(code, offsets):
        total[:-1] += marks[triple] * (inside * w)[:, None]
    return np.add.reduceat(total, offsets[:-1], axis=0) / _lengths(np.diff(offsets))[:, None]


def ceiling(code: np.ndarray, offsets: np.ndarray, most: np.ndarray) -> np.ndarray:
    """A bound on each word's kernel with any landmark; ``most`` has each triple's largest weight among them."""
    total = np.zeros(len(code) + 1, np.float32)
    for triple, inside, w in _triples(code, offsets):
        total[:-1] += most[triple] * (inside * w)
    return np.add.reduceat(total, offsets[:-1]) / _lengths(np.diff(offsets))


def spelled(code: np.ndarray) -> str:
    """A word's letter classes as a string."""
    return (code + np.uint8(96)).tobytes().decode("latin-1")


def coded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    code = np.frombuffer("".join(words).encode("latin-1"), np.uint8) - np.uint8(96)
    return code, np.concatenate([[0], np.cumsum([len(w) for w in words])])


def landmark_rows(words: list[str]) -> np.ndarray:
    """Triple weights of each word as a column."""
    out = np.zeros((LETTERS**3, len(words)), np.float32)
    code, offsets = coded(words)
    owner = np.repeat(np.arange(len(words)), np.diff(offsets))
    for triple, inside, w in _triples(code, offsets):
        np.add.at(out, (triple[inside], owner[inside]), w)
    return out / _lengths(np.diff(offsets))


@dataclass
class Model:
    """Landmarks (toxic ones first), their weights in the decision, and the logistic curve."""

    marks: np.ndarray
    toxic: int
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = -30.0

    def word_margins(self, code: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Decision per word; LOWEST where no toxic landmark can have a kernel of ``NEAR`` or more."""
        out = np.full(len(offsets) - 1, LOWEST)
        near = np.flatnonzero(ceiling(code, offsets, self.most) >= NEAR) if len(out) else []
        if not len(near):
            return out
        text = code.tobytes()
        spelt = [text[a:b] for a, b in zip(offsets[near].tolist(), offsets[near + 1].tolist())]
        new = [w for w in dict.fromkeys(spelt) if w not in self.known]
        if len(self.known) > 150_000:  # a memo only: forgotten words are computed again
            self.known, new = {}, list(dict.fromkeys(spelt))
        for i in range(0, len(new), 1000):
            part = new[i : i + 1000]
            cuts = np.concatenate([[0], np.cumsum([len(w) for w in part])])
            letters = np.frombuffer(b"".join(part), np.uint8)
            close = np.flatnonzero(kernel(letters, cuts, self.toxic_marks).max(axis=1) >= NEAR)
            self.known.update(dict.fromkeys(part, LOWEST))
            if len(close):
                words = [part[k] for k in close]
                cuts = np.concatenate([[0], np.cumsum([len(w) for w in words])])
                like = kernel(np.frombuffer(b"".join(words), np.uint8), cuts, self.marks)
                self.known.update(zip(words, np.maximum(sharpened(like) @ self.weights + self.bias, LOWEST).tolist()))
        out[near] = [self.known[w] for w in spelt]
        return out

    def __post_init__(self) -> None:
        self.known: dict[bytes, float] = {}
        self.toxic_marks = np.ascontiguousarray(self.marks[:, : self.toxic])
        self.most = self.marks[:, : self.toxic].max(axis=1) if self.toxic else np.zeros(len(self.marks), np.float32)

    def margins(self, column: pa.Array) -> np.ndarray:
        """The largest decision among each text's words."""
        code, offsets, firsts = letter_words(column)
        out = np.full(len(column), LOWEST)
        filled = np.flatnonzero(np.diff(firsts))
        if len(filled):
            out[filled] = np.maximum.reduceat(self.word_margins(code, offsets), firsts[filled])
        return np.maximum(out, LOWEST)

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


def sharpened(like: np.ndarray) -> np.ndarray:
    """A power of the kernel, a kernel too: it tells apart words that share few subsequences."""
    return like**3


def hashed_fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def _sampled(docs: DataFrame, labels: DataFrame, sample_toxic: int, sample_clean: int) -> DataFrame:
    """Words (doc_id, toxic, word) of the sample: the first of each class by the id's hash."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(hashed_fold(F.col("doc_id")) != 0)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    pick = lambda t, n: known.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    sample = pick(1, sample_toxic).unionByName(pick(0, sample_clean))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(sample), "doc_id")  # at most sample_toxic + sample_clean rows


def _apart(documents: list[set[str]]) -> list[int]:
    """Documents that agree with no earlier one in 9 of 16 MinHashes of their words; the rest are copies."""
    seen: dict[tuple[int, int], list[int]] = {}
    salts, out = tb.seeds(16, 41), []
    for i, words in enumerate(documents):
        if not words:
            continue
        base = np.array([hash_of(w) for w in words], np.uint64)
        keys = [(k, int(tb.mix(base ^ s).min())) for k, s in enumerate(salts)]
        shared = Counter(j for key in keys for j in seen.get(key, ()))
        if max(shared.values(), default=0) < 9:
            out.append(i)
            for key in keys:
                seen.setdefault(key, []).append(i)
    return out


def hash_of(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")


def _witnesses(toxic: list[set[str]], clean: dict[str, int], n_clean: int) -> dict[str, int]:
    """Words that recur in toxic documents that are no copies of each other and are rare in clean ones."""
    kept = _apart(toxic)
    count: dict[str, int] = {}
    for i in kept:
        for w in toxic[i]:
            count[w] = count.get(w, 0) + 1
    rare = {w: n for w, n in count.items() if n >= 3 and len(w) > 2 and clean.get(w, 0) * len(kept) <= 0.05 * n * n_clean}
    # so often that no word would be in toxic documents alone by chance; in a tiny sample the most frequent have to do
    least = np.log(100 * max(1, len(count))) / np.log(1 + n_clean / max(1, len(kept)))
    sure = {w: n for w, n in rare.items() if n >= least}
    return sure or rare


def _varied(word: str) -> list[str]:
    """The word with one letter more, at each inner place."""
    return [word[:i] + chr(97 + hash_of(f"{word}{i}") % 26) + word[i:] for i in range(1, len(word))]


def _spread(words: list[str], most: int, alike: float) -> list[str]:
    """The first words that are less than ``alike`` to all chosen before."""
    chosen: list[str] = []
    marks = np.zeros((LETTERS**3, most), np.float32)
    for word in words:
        if len(chosen) < most and kernel(*coded([word]), marks).max(initial=0) < alike:
            marks[:, len(chosen)] = landmark_rows([word])[:, 0]
            chosen.append(word)
    return chosen


def _machine(positive: dict[str, int], negative: list[str], landmarks: int) -> Model:
    heavy = sorted(positive, key=lambda w: (-positive[w], w))[:600]
    toxic = _spread(heavy, landmarks // 2, 0.7)
    marks = [*toxic, *_spread([w for w in negative if w not in toxic][:600], landmarks - len(toxic), 0.7)]
    rows = landmark_rows(marks)
    values, vectors = np.linalg.eigh(sharpened(kernel(*coded(marks), rows)).astype(np.float64))
    whiten = vectors / np.sqrt(np.maximum(values, 1e-3))
    varied = [v for w in toxic for v in _varied(w) if len(w) > 3]
    words = [*heavy, *varied, *negative]
    z = np.concatenate([sharpened(kernel(*coded(words[i : i + 200]), rows)) for i in range(0, len(words), 200)]) @ whiten
    z = np.hstack([z, np.ones((len(z), 1))])
    y = np.where(np.arange(len(words)) < len(heavy) + len(varied), 1.0, -1.0)
    gain = np.array([*np.sqrt([positive[w] for w in heavy]), *np.full(len(varied), 1.0), *np.full(len(negative), 1.0)])
    gain = np.where(y > 0, gain / gain[y > 0].sum(), gain / gain[y < 0].sum())
    weights, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], 1e-5)
    penalty[-1] = 1e-8
    for _ in range(100):  # damped Newton steps on the squared hinge loss
        inside = y * (z @ weights) < 1
        part = z[inside] * gain[inside, None]
        step = np.linalg.solve(part.T @ z[inside] + np.diag(penalty), part.T @ y[inside])
        if np.abs(step - weights).max() < 1e-6:
            break
        weights = 0.5 * (weights + step)
    return Model(rows, len(toxic), whiten @ weights[:-1], float(weights[-1]))


def fit(docs: DataFrame, labels: DataFrame, sample_toxic: int = 1200, sample_clean: int = 2400, landmarks: int = 128, rounds: int = 3) -> Model:
    """Learns from labelled rows outside the held-out fold; the sample bounds what the driver holds."""
    sample = _sampled(docs, labels, sample_toxic, sample_clean).select("toxic", "text").toArrow()
    texts, label = sample.column("text").combine_chunks(), sample.column("toxic").to_numpy()
    if not (label == 1).any() or not (label == 0).any():
        return Model(np.zeros((LETTERS**3, 1), np.float32), 0, np.zeros(1), LOWEST)
    one: dict[str, str] = {}  # equal words of all texts share one string
    words = []
    for i in range(len(texts)):
        code, offsets, _ = letter_words(texts.slice(i, 1))
        letters = spelled(code)
        words.append({one.setdefault(w, w) for w in (letters[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))})
    clean: dict[str, int] = {}
    for i in np.flatnonzero(label == 0):
        for w in words[i]:
            clean[w] = clean.get(w, 0) + 1
    positive = _witnesses([words[i] for i in np.flatnonzero(label == 1)], clean, int((label == 0).sum()))
    if not positive:
        return Model(np.zeros((LETTERS**3, 1), np.float32), 0, np.zeros(1), LOWEST)
    every = sorted(w for w in clean if w not in positive)
    negative = sorted(every, key=lambda w: (-clean[w], w))[:1000]
    model = _machine(positive, negative, landmarks)
    for _ in range(rounds - 1):
        known = set(negative)
        margin = np.concatenate([model.word_margins(*coded(every[i : i + 5000])) for i in range(0, len(every), 5000)])
        hard = [every[i] for i in np.argsort(-margin, kind="stable")[:1000] if margin[i] > LOWEST]
        negative = [*(w for w in hard if w not in known), *negative]
        model = _machine(positive, negative, landmarks)
    margins = np.concatenate([model.margins(texts.slice(i, 64)) for i in range(0, len(texts), 64)])
    model.known = {}
    model.slope, model.offset = _logistic(margins, label)
    return model


def _logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve from margin to score, slightly shrunk so that it stays finite."""
    x = np.column_stack([margin, np.ones(len(margin))])
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (label - p) - np.array([1e-2, 0]) * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Model = model.value
        for batch in batches:
            for part in tb.steps(batch, "text", 1 << 19):
                scores = fitted.scores(fitted.margins(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
                )

    return run


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted for every row; the model (some 100 KB) is broadcast."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(tb.freeing(_scored(docs.sparkSession.sparkContext.broadcast(model))), "doc_id long, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, whole, whose text the model doesn't predict toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Model = shared.value
        for batch in batches:
            for part in tb.steps(batch, "text", 1 << 19):
                yield part.filter(pa.array(fitted.scores(fitted.margins(part.column("text"))) < 0.5))

    return docs.mapInArrow(tb.freeing(run), docs.schema)
