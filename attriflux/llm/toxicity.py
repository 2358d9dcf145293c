"""Toxicity by weak supervision: many voters, a label model over them, a linear classifier on its posteriors.

Voters are words and word beginnings that are more usual in toxic texts, and
patterns over whole texts. Labels are used for the choice of words and as a
first estimate of the voters. The label model is a mixture of two classes, in
each of which blocks of correlated voters are independent; expectation
maximisation over the votes of all documents estimates how often each state of
a block stands in each class. A logistic regression then learns the posteriors
from more words than vote.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attriflux.llm.compression_quality import held_out
from attriflux.llm.shared import stored, text_column, totals

SAMPLE_DOCS = 2000          # labelled documents of each label that words are chosen from, those with the smallest id hashes
TRAIN_DOCS = 20000          # documents the classifier is fitted on, drawn by hash, about; twice as many at most
WORDS = 256                 # words and beginnings the classifier knows, those that tell the labels best
VOTERS = 44                 # of them that vote
LEAST_GAIN = 15.0           # likelihood ratio (G2) from which a word is more than chance
LEAST_DOCS = 4              # toxic sample documents that must hold a word
BEGINNINGS = (4, 5, 6, 7, 8)
BLOCK_VOTERS = 5            # voters of a block of correlated ones, at most
CORRELATED = 0.1            # correlation within the classes from which two voters share a block
ROUNDS = 12
THRESHOLD = 0.5

WORD = re.compile(r"[^\W\d_]+")
DISGUISED = re.compile(r"[^\W\d_][013457@$][^\W\d_]")
UNDISGUISED = str.maketrans("013457@$", "oieastas")
PATTERNS = ["two different words", "a word repeated", "a word in 100", "a word in 1000", "a disguised word",
            "mostly capitals", "calls out twice", "long and without words", "no letters"]


def tokens_of(word: str) -> list[str]:
    """A lower-case word as it may stand in the lexicon: whole, marked by $, and its beginnings."""
    return [word + "$", *(word[:n] for n in BEGINNINGS if len(word) >= n)]


def gain(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """G2 of a word that so many toxic and clean documents hold. Negative where clean ones hold it more often."""
    total, held = n_toxic + n_clean, toxic + clean
    cells = ((toxic, held * n_toxic), (clean, held * n_clean), (n_toxic - toxic, (total - held) * n_toxic),
             (n_clean - clean, (total - held) * n_clean))
    value = 2 * sum(seen * math.log(seen * total / expected) for seen, expected in cells if seen)
    return value if toxic * n_clean > clean * n_toxic else -value


def choose(found: list[tuple[str, int, int]], n_toxic: int, n_clean: int, words: int = WORDS) -> list[str]:
    """The words with the highest gains. Of a word and its beginnings held by the same documents one is enough."""
    ranked = sorted(((-gain(t, c, n_toxic, n_clean), -len(w), w, t, c) for w, t, c in found if t >= LEAST_DOCS))
    out, known = [], {}
    for negative, _, word, toxic, clean in ranked:
        if -negative < LEAST_GAIN or len(out) == words:
            break
        stem = word.rstrip("$")
        same = known.setdefault((toxic, clean, stem[:4]), [])
        if not any(s.startswith(stem) or stem.startswith(s) for s in same):
            same.append(stem)
            out.append(word)
    return out


class Reader:
    """What a text holds of the lexicon: numbers of its words, patterns as bits, occurrences, words in all."""

    def __init__(self, words: tuple[str, ...], voters: int):
        self.number = {w: i for i, w in enumerate(words)}
        self.heads = {w.rstrip("$")[:4] for w in words}
        self.voters = voters

    def _hits(self, words: list[str]) -> tuple[set[int], Counter]:
        heads, number = self.heads, self.number
        held, times = set(), Counter(w for w in words if w[:4] in heads)
        for word in list(times):
            ids = [number[t] for t in tokens_of(word) if t in number]
            held.update(ids)
            if not ids or min(ids) >= self.voters:          # words that do not vote are no hits of the patterns
                del times[word]
        return held, times

    def __call__(self, raw: bytes) -> tuple[list[int], int, int, int]:
        low = raw.decode("utf-8", "replace").lower()
        words = WORD.findall(low)
        held, times = self._hits(words)
        hits = sum(times.values())
        disguised = False
        if DISGUISED.search(low):
            plain = [w for part in low.split() if DISGUISED.search(part) for w in WORD.findall(part.translate(UNDISGUISED))]
            more, extra = self._hits(plain)
            disguised = bool(extra)
            held |= more
        data = np.frombuffer(raw, np.uint8)
        capitals, small = int(((data >= 65) & (data <= 90)).sum()), int(((data >= 97) & (data <= 122)).sum())
        n = len(words)
        flags = (len(times) > 1, any(k > 1 for k in times.values()), 100 * hits >= n > 0, 1000 * hits >= n > 0, disguised,
                 capitals > small, low.count("!!") > 1, n >= 50 and not hits, not n)
        return sorted(held), sum(1 << i for i, f in enumerate(flags) if f), hits, n


def read_texts(docs: DataFrame, words: tuple[str, ...], voters: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, draw (a hash of the row), votes (bits: words, then patterns), words, hits and n_words of every text."""
    value = text_column(text)
    kept = docs.select(F.col(id_column).alias("doc_id"), held_out(F.col(id_column)).alias("held_out"),
                       F.xxhash64(F.col(id_column), value).alias("draw"), value.cast("binary").alias("text"))
    names = kept.columns[:-1]
    own = [f"{c} {kept.schema[c].dataType.simpleString()}" for c in names]
    schema = ", ".join([*own, "votes bigint", "words array<int>", "hits bigint", "n_words bigint"])

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(words, voters)
        for batch in batches:
            rows = [reader(t.as_py()) for t in batch.column("text")]
            votes = [(sum(1 << i for i in held if i < voters)) | (flags << voters) for held, flags, _, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(votes, pa.int64()), pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                 pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())],
                [*names, "votes", "words", "hits", "n_words"])

    return kept.mapInArrow(described, schema)


# ---- lexicon ----

def labelled_sample(labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id and toxic of up to ``sample_docs`` documents of each label, none of them held out."""
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    return known.filter("toxic > 0").orderBy(*order).limit(sample_docs).unionByName(
        known.filter("toxic <= 0").orderBy(*order).limit(sample_docs))


def count_words(docs: DataFrame, sample: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """word, toxic, clean: how many sampled documents of each label hold it. Row '' counts the documents."""
    rows = docs.select(F.col(id_column).alias("doc_id"), text_column(text).alias("text"))
    rows = rows.join(F.broadcast(sample), "doc_id")         # at most twice sample_docs ids
    rows = rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.min("toxic").alias("toxic"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())                      # of the words of a bounded sample
        for batch in batches:
            for value, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                words = set(WORD.findall(value.as_py().lower()))
                found[toxic <= 0].update({t for w in words for t in tokens_of(w)} | {""})
        both = sorted(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_pydict({
            "word": pa.array(both, pa.string()), "toxic": pa.array([found[0][w] for w in both], pa.int64()),
            "clean": pa.array([found[1][w] for w in both], pa.int64())})

    counts = rows.select("text", "toxic").mapInArrow(counted, "word string, toxic bigint, clean bigint")
    return counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


# ---- label model ----

@dataclass(frozen=True)
class LabelModel:
    """Share of toxic documents, blocks of voters, and the logarithm of every state's share in both classes."""

    share: float
    blocks: tuple[tuple[int, ...], ...]
    tables: tuple[np.ndarray, ...]          # per block: (2, states), clean first

    def states(self, votes: np.ndarray) -> np.ndarray:
        """Each block's state in every row: the block's votes as a number."""
        out = np.zeros((len(votes), len(self.blocks)), np.int64)
        for b, block in enumerate(self.blocks):
            for at, voter in enumerate(block):
                out[:, b] |= (votes >> voter & 1) << at
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """How likely the rows are toxic."""
        states = self.states(votes)
        odds = np.full(len(votes), math.log(self.share / (1 - self.share)))
        for b, table in enumerate(self.tables):
            odds += (table[1] - table[0])[states[:, b]]
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def accuracy(self, voters: int) -> np.ndarray:
        """Share of toxic documents among those for which a voter fires, as the model estimates it."""
        out = np.zeros(voters)
        for block, table in zip(self.blocks, self.tables):
            for at, voter in enumerate(block):
                fires = np.exp(table)[:, np.arange(table.shape[1]) >> at & 1 == 1].sum(axis=1)
                out[voter] = fires[1] * self.share / (fires[1] * self.share + fires[0] * (1 - self.share))
        return out


def _state_counts(model: LabelModel, votes: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Weights (rows, 2) summed per block, class and state."""
    states = model.states(votes)
    return [np.stack([np.bincount(states[:, b], weights[:, y], minlength=1 << len(block)) for y in (0, 1)])
            for b, block in enumerate(model.blocks)]


def _split(flat: np.ndarray, blocks: tuple[tuple[int, ...], ...]) -> list[np.ndarray]:
    at = np.cumsum([0, *(2 << len(b) for b in blocks)])
    return [flat[i:j].reshape(2, -1) for i, j in zip(at, at[1:])]


def _shares(counts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Logarithms of the states' shares, each state having been seen half a time more, spread over the states."""
    smooth = [c + 0.5 / c.shape[1] for c in counts]
    return tuple(np.log(c / c.sum(axis=1, keepdims=True)) for c in smooth)


def estimate(patterns: DataFrame, known_votes: np.ndarray, known_toxic: np.ndarray, blocks: tuple[tuple[int, ...], ...],
             labelled_share: float, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over all documents' votes (votes, n).

    Labelled rows and all documents weigh alike in each class, whatever the
    number of documents: the labels keep the classes to their meaning, the documents correct
    what a small sample misses.
    """
    known = np.stack([known_toxic <= 0, known_toxic > 0], axis=1).astype(float)
    model = LabelModel(labelled_share, blocks, ())
    sample = _state_counts(model, known_votes, known)
    sample = [c + 0.5 / c.shape[1] for c in sample]
    model = LabelModel(labelled_share, blocks, _shares(sample))
    size = sum(2 << len(b) for b in blocks)
    for _ in range(rounds):
        now = model

        def expected(batch: pa.RecordBatch) -> np.ndarray:
            votes, n = batch.column("votes").to_numpy(), batch.column("n").to_numpy()
            p = now.posterior(votes)
            return np.concatenate([c.reshape(-1) for c in _state_counts(now, votes, np.stack([1 - p, p], axis=1) * n[:, None])])

        counts = _split(totals(patterns.select("votes", "n"), size, expected), blocks)
        of = counts[0].sum(axis=1)
        merged = [s + c * (s.sum(axis=1) / np.maximum(of, 1e-9))[:, None] for s, c in zip(sample, counts)]
        share = float(np.clip((labelled_share + of[1] / max(of.sum(), 1e-9)) / 2, 1e-4, 1 - 1e-4))
        model = LabelModel(share, blocks, _shares(merged))
        if abs(share - now.share) < 1e-5 and max(np.abs(np.exp(a) - np.exp(b)).max() for a, b in zip(model.tables, now.tables)) < 1e-4:
            break
    return model


def correlated_blocks(patterns: DataFrame, model: LabelModel, voters: int) -> tuple[tuple[int, ...], ...]:
    """Voters that fire together more, or less, often than two classes explain, the closest first."""
    def joint(batch: pa.RecordBatch) -> np.ndarray:
        votes, n = batch.column("votes").to_numpy(), batch.column("n").to_numpy()
        p = model.posterior(votes)
        bits = (votes[:, None] >> np.arange(voters) & 1).astype(float)
        return np.concatenate([np.append((bits.T @ (bits * w[:, None])).reshape(-1), w.sum()) for w in ((1 - p) * n, p * n)])

    found = totals(patterns.select("votes", "n"), 2 * (voters * voters + 1), joint).reshape(2, -1)
    within = np.zeros((voters, voters))
    for row in found:
        if row[-1] > 0:
            both = row[:-1].reshape(voters, voters) / row[-1]
            within += row[-1] / found[:, -1].sum() * (both - np.outer(np.diag(both), np.diag(both)))
    spread = np.sqrt(np.maximum(np.diag(within), 1e-12))
    strength = np.abs(within / np.outer(spread, spread))
    strength[np.diag(within) < 1e-9] = 0
    block_of = {v: (v,) for v in range(voters)}
    for i, j in sorted(zip(*np.triu_indices(voters, 1)), key=lambda p: (-strength[p], p)):
        one, two = block_of[int(i)], block_of[int(j)]
        if strength[i, j] < CORRELATED:
            break
        if one != two and len(one) + len(two) <= BLOCK_VOTERS:
            for v in one + two:
                block_of[v] = tuple(sorted(one + two))
    return tuple(sorted(set(block_of.values())))


# ---- classifier ----

@dataclass(frozen=True)
class ToxicityModel:
    words: tuple[str, ...]
    voters: int                 # of the words, the first ones
    label_model: LabelModel
    weights: np.ndarray         # words, patterns, hits, hits by words, offset

    def features(self, words: pa.Array, votes: np.ndarray, hits: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        return _features(words, votes, hits, n_words, len(self.words), self.voters)


def _features(words: pa.Array, votes: np.ndarray, hits: np.ndarray, n_words: np.ndarray, size: int, voters: int) -> np.ndarray:
    x = np.zeros((len(votes), size + len(PATTERNS) + 3))
    counts = np.diff(words.offsets.to_numpy())
    x[np.repeat(np.arange(len(votes)), counts), words.flatten().to_numpy()] = 1
    x[:, size:size + len(PATTERNS)] = votes[:, None] >> (voters + np.arange(len(PATTERNS))) & 1
    x[:, -3] = np.log1p(hits)
    x[:, -2] = 10 * hits / np.maximum(n_words, 10)
    x[:, -1] = 1
    return x


def fit_logistic(x: np.ndarray, target: np.ndarray, rounds: int = 40, shrink: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on targets between 0 and 1 (Newton steps; the last feature is not shrunk)."""
    w, ridge = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, shrink), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (target - p) - ridge * w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return w


def described(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, id_column: str = "doc_id",
              text: str = "text") -> tuple[DataFrame, ToxicityModel | None]:
    """What the texts hold of a lexicon learnt from the labels (a written table), and the model fitted to it.

    The lexicon and the first estimate of the voters come from up to
    ``sample_docs`` documents of each label, none of them held out, the label model from the votes of all
    documents, the classifier from the posteriors of about ``TRAIN_DOCS``. No
    model if a label is missing; then the texts are read without a lexicon.
    """
    sample = stored(labelled_sample(labels, sample_docs), "toxic-sample")
    usable = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    share = usable.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
    counts = stored(count_words(docs, sample, id_column, text), "toxic-words")
    size = counts.filter("word = ''").first()
    if size is None or not size.toxic or not size.clean:
        return stored(read_texts(docs, (), 0, id_column, text), "toxic-votes"), None
    often = counts.filter(f"word <> '' AND toxic >= {LEAST_DOCS}").filter(F.col("toxic") * size.clean > F.col("clean") * size.toxic)
    ranked = often.orderBy((F.col("toxic") / size.toxic - F.col("clean") / size.clean).desc(), "word").limit(16 * WORDS)
    words = tuple(choose([tuple(r) for r in ranked.collect()], size.toxic, size.clean))
    voters = min(VOTERS, len(words))
    all_voters = voters + len(PATTERNS)
    rows = stored(read_texts(docs, words, voters, id_column, text), "toxic-votes")
    patterns = stored(rows.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "toxic-patterns")
    seen = rows.filter("NOT held_out").select("doc_id", "votes", "draw").join(F.broadcast(sample), "doc_id")
    seen = seen.groupBy("doc_id").agg(F.min_by("votes", "draw").alias("votes"), F.min("toxic").alias("toxic")).toArrow()
    known_votes, known_toxic = seen["votes"].to_numpy(), seen["toxic"].to_numpy()
    share = float(np.clip(share, 1e-4, 1 - 1e-4))
    alone = estimate(patterns, known_votes, known_toxic, tuple((v,) for v in range(all_voters)), share)
    model = estimate(patterns, known_votes, known_toxic, correlated_blocks(patterns, alone, all_voters), share)
    n = patterns.agg(F.sum("n")).first()[0]
    drawn = rows.filter("NOT held_out").filter(F.pmod("draw", F.lit(1 << 20)) < F.lit(max(1, min(1 << 20, (TRAIN_DOCS << 20) // n))))
    train = drawn.select("words", "votes", "hits", "n_words").limit(2 * TRAIN_DOCS).toArrow().combine_chunks()
    votes, hits, n_words = (train[c].to_numpy() for c in ("votes", "hits", "n_words"))
    held = train["words"].combine_chunks() if train.num_rows else pa.array([], pa.list_(pa.int32()))
    held = held.chunk(0) if isinstance(held, pa.ChunkedArray) else held
    x = _features(held, votes, hits, n_words, len(words), voters)
    return rows, ToxicityModel(words, voters, model, fit_logistic(x, model.posterior(votes)))


def score_toxicity(rows: DataFrame, model: ToxicityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, and posterior (the label model's opinion) of every row of ``described``."""
    kept = rows.select("doc_id", "held_out", "words", "votes", "hits", "n_words")
    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int, posterior double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = posterior = np.zeros(batch.num_rows)
            if model and batch.num_rows:
                votes, hits, n_words = (batch.column(c).to_numpy() for c in ("votes", "hits", "n_words"))
                x = model.features(batch.column("words"), votes, hits, n_words)
                scores = 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))
                posterior = model.label_model.posterior(votes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32)),
                 pa.array(posterior)], ["doc_id", "held_out", "score", "predicted", "posterior"])

    return kept.mapInArrow(score, schema)


def find_toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, threshold: float = THRESHOLD,
                  id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """A score of every document's toxicity from its whole text.

    doc_id, held_out (every fifth id by its checksum, whose labels are never
    learnt), score, predicted, and the label model's posterior. Null texts score like empty
    ones. Without labels of both kinds nothing is learnt and every score is 0.
    Repeated rows and null ids give a row each; equal texts score alike. Only
    the id and the text are read, so further columns cannot clash. An empty
    table gives no rows.
    """
    rows, model = described(docs, labels, sample_docs, id_column, text)
    return score_toxicity(rows, model, threshold)
