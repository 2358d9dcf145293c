"""Quality rules: a linear-chain CRF marks lines as content or boilerplate; the share of content decides."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attriflux.llm.shared import RangeHashes, row_of, sums, text_chunks, text_column, word_bounds

LEAST_WORDS = 20            # base rule: fewer words fail
MOST_REPEATED = 30          # base rule: more per cent of repeated words fail
WINDOW = 8                  # words of a window whose repetition counts
LEAST_CONTENT = 0.5         # share of a document's words in content lines
SAMPLE_DOCS = 2000          # labelled documents the CRF is fitted on, those with the smallest id hashes
CHAIN_LINES = 64            # longer documents are fitted as several chains of so many lines each
SYMBOLS = b"#*$%&|<>"
FEATURES = ("bias", "symbols", "upper", "bars", "shouts", "stutter", "digits", "no_end", "short", "repeated")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that stand at two places or more, the first one included."""
    seen: dict[tuple, int] = {}
    marked = bytearray(max(0, len(words) - window + 1))
    for i in range(len(marked)):
        first = seen.setdefault(tuple(words[i:i + window]), i)
        if first != i:
            marked[first] = marked[i] = 1
    covered, end = 0, 0
    for i, mark in enumerate(marked):
        if mark:
            covered += i + window - max(i, end)
            end = i + window
    return covered


@dataclass
class LineTable:
    """Counts per document and feature rows per line of a run of documents."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    line_doc: np.ndarray
    line_words: np.ndarray
    features: np.ndarray


def _possible_repeats(word_hash: np.ndarray, word_doc: np.ndarray, docs: int) -> np.ndarray:
    """Documents in which two windows of words have equal hashes (all with repeated windows are among them)."""
    flagged = np.zeros(docs, bool)
    if len(word_hash) < WINDOW:
        return flagged
    h = word_hash
    for step, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (4, 0x165667B19E3779F9)):
        h = h[:-step] * np.uint64(factor) + h[step:]
    inside = word_doc[:len(h)] == word_doc[WINDOW - 1:]
    docs_of = word_doc[:len(h)][inside]
    keys = (h[inside] ^ (docs_of.astype(np.uint64) << np.uint64(40))) * np.uint64(0xD6E8FEB86659FD93)
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(twice):
        flagged[docs_of[np.isin(keys, twice)]] = True
    return flagged


def line_table(data: np.ndarray, borders: np.ndarray) -> LineTable:
    """Exact counts of every document, and the features of its lines."""
    docs = len(borders) - 1
    raw = data.tobytes()
    starts, ends = word_bounds(data, borders)
    word_doc = row_of(starts, borders)
    n_words = np.bincount(word_doc, minlength=docs)
    word_hash = RangeHashes(data)(starts, ends)
    solid = np.zeros(len(data) + 1, np.int8)
    solid[starts] += 1
    solid[ends] -= 1
    symbol = _SYMBOL[data]
    in_word = np.cumsum(solid[:-1]).astype(bool)
    word_chars = sums(in_word & ((data & 0xC0) != 0x80), borders)

    repeats = np.zeros(docs, np.int64)
    for doc in np.flatnonzero(_possible_repeats(word_hash, word_doc, docs)):
        repeats[doc] = repeated_words(raw[borders[doc]:borders[doc + 1]].split())

    breaks = np.flatnonzero(data == 10)
    begin = np.concatenate([borders[:-1], breaks + 1])
    doc = np.concatenate([np.arange(docs), row_of(breaks, borders)])
    order = np.lexsort((begin, doc))
    begin, doc = begin[order], doc[order]
    end = np.empty_like(begin)
    last = np.append(doc[1:] != doc[:-1], True)[:len(doc)]
    end[:-1] = begin[1:] - 1
    end[last] = borders[1:]
    lines = np.stack([begin, end])

    def within(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[lines[1]] - total[lines[0]]

    first_word, end_word = np.searchsorted(starts, begin), np.searchsorted(starts, end)
    words = end_word - first_word
    again = np.zeros(len(starts) + 1, np.int64)
    if len(starts) > 1:
        again[2:] = np.cumsum(word_hash[1:] == word_hash[:-1])
    stutter = np.where(words > 1, again[end_word] - again[np.minimum(first_word + 1, end_word)], 0)
    dup = np.zeros(len(begin), bool)
    n_dup = np.zeros(docs, np.int64)
    seen: set[bytes] = set()
    now = -1
    for i, (d, b, e, w) in enumerate(zip(doc.tolist(), begin.tolist(), end.tolist(), words.tolist())):
        if d != now:
            now, seen = d, set()
        if w:
            line = raw[b:e]
            if line in seen:
                dup[i] = True
                n_dup[d] += 1
            else:
                seen.add(line)
    some = np.maximum(words, 1)
    letters = np.maximum(within(((data | 0x20) >= 97) & ((data | 0x20) <= 122)), 1)
    closing = np.zeros(len(begin), bool)
    if len(starts):
        tail = data[ends[np.maximum(end_word - 1, 0)] - 1]
        closing = (words > 0) & np.isin(tail, np.frombuffer(b".!?:;\"')", np.uint8))
    share = lambda count, of, most=1.0: np.minimum(count / of, most)
    features = np.stack([
        np.ones(len(begin)), share(within(symbol), some, 3.0) / 3, share(within((data >= 65) & (data <= 90)), letters),
        share(within(data == 124), some), share(within(data == 33), some, 2.0) / 2, share(stutter, some),
        share(within((data >= 48) & (data <= 57)), some, 4.0) / 4, (words > 0) & ~closing, words < 4, dup], axis=1)
    return LineTable(n_words, word_chars, sums(symbol, borders), n_dup, repeats, doc, words,
                     features.astype(np.float64))


@dataclass(frozen=True)
class LineModel:
    """Weights of content against boilerplate per feature, and scores of neighbouring labels."""

    weights: tuple[float, ...]
    moves: tuple[tuple[float, float], tuple[float, float]]


ALL_CONTENT = LineModel((1.0, *[0.0] * (len(FEATURES) - 1)), ((0.0, 0.0), (0.0, 0.0)))


def viterbi(scores: list[float], moves) -> list[int]:
    """The best sequence of labels (1: content); ties go to content."""
    (stay0, up), (down, stay1) = moves
    bad, good, back = 0.0, scores[0], []
    for score in scores[1:]:
        b0, b1 = bad + stay0, good + down
        g0, g1 = bad + up, good + stay1
        back.append((b1 >= b0, g1 >= g0))
        bad, good = max(b0, b1), max(g0, g1) + score
    label = int(good >= bad)
    out = [label]
    for from_bad, from_good in reversed(back):
        label = int(from_good if label else from_bad)
        out.append(label)
    return out[::-1]


def fit_crf(chains: list[np.ndarray], labels: list[int], rounds: int = 200, penalty: float = 1e-3) -> LineModel:
    """Fit on documents whose label is known, their lines' labels are not.

    Lines of good documents are content. Which lines of a bad document are
    boilerplate is first guessed by a logistic model of single lines; then the
    chain's conditional likelihood is climbed with forward and backward sums.
    """
    if len(set(labels)) < 2:
        return ALL_CONTENT
    size = max(map(len, chains))
    x = np.zeros((len(chains), size, len(FEATURES)))
    real = np.zeros((len(chains), size), bool)
    for i, chain in enumerate(chains):
        x[i, :len(chain)], real[i, :len(chain)] = chain, True
    good = np.repeat(np.asarray(labels, float)[:, None], size, 1)
    balance = np.where(good == 1, 0.5 / max(good[real].mean(), 1e-9), 0.5 / max(1 - good[real].mean(), 1e-9)) * real

    def climb(start: np.ndarray, gradient) -> np.ndarray:
        at, mean, square = start, np.zeros_like(start), np.zeros_like(start)
        for step in range(1, rounds + 1):
            g = gradient(at) - penalty * at
            mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
            at = at + 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        return at

    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    total = balance.sum()
    line = climb(np.zeros(len(FEATURES)), lambda w: np.einsum("dl,dlk->k", balance * (good - sigmoid(x @ w)), x) / total)
    y = np.where(good == 1, 1, (x @ line >= 0)).astype(int)
    chain = balance.max(axis=1)                 # documents of both labels weigh the same in all
    pair = real[:, 1:] * chain[:, None]
    seen = np.array([[(pair * (y[:, :-1] == a) * (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    count = (real * chain[:, None]).sum()

    def gradient(theta: np.ndarray) -> np.ndarray:
        w, moves = theta[:-4], theta[-4:].reshape(2, 2)
        emit = np.stack([np.zeros(real.shape), x @ w], axis=2)
        ahead, behind = np.zeros(emit.shape), np.zeros(emit.shape)
        ahead[:, 0] = emit[:, 0]
        for t in range(1, size):
            step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + emit[:, t]
            ahead[:, t] = np.where(real[:, t, None], step, ahead[:, t - 1])
        for t in range(size - 2, -1, -1):
            step = np.logaddexp.reduce(moves + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(real[:, t + 1, None], step, behind[:, t + 1])
        log_z = np.logaddexp.reduce(ahead[:, -1], axis=1)
        p = np.exp(ahead[..., 1] + behind[..., 1] - log_z[:, None])
        both = (ahead[:, :-1, :, None] + moves + (emit + behind)[:, 1:, None, :] - log_z[:, None, None, None])
        expected = (np.exp(np.minimum(both, 0)) * pair[..., None, None]).sum((0, 1))
        return np.concatenate([np.einsum("dl,dlk->k", (y - p) * real * chain[:, None], x), (seen - expected).ravel()]) / count

    theta = climb(np.concatenate([line, np.zeros(4)]), gradient)
    return LineModel(tuple(theta[:-4]), tuple(map(tuple, theta[-4:].reshape(2, 2))))


def train_line_model(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS,
                     id_column: str = "doc_id", text: str = "text") -> LineModel:
    """Fit the CRF on the ``sample_docs`` labelled documents with the smallest id hashes, all their lines.

    The sample is bounded by its number of documents, one row of each id, so it
    may come to the driver as feature rows. Without labels of both kinds every line counts as content.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    value = text_column(text)
    texts = docs.select(F.col(id_column).alias("doc_id"), value.alias("text"))
    texts = texts.join(F.broadcast(sample), "doc_id")           # at most sample_docs ids
    texts = texts.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.min("quality").alias("quality"))
    texts = texts.select(F.xxhash64("doc_id").alias("draw"), F.col("doc_id").cast("string").alias("name"), "quality", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, borders in text_chunks(batch.column("text")):
                table = line_table(data, borders)
                cuts = np.searchsorted(table.line_doc, np.arange(end - first + 1))
                found = [table.features[a:b].astype("<f8").tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, end - first) for c in ("draw", "name", "quality")), pa.array(found, pa.binary())],
                    ["draw", "name", "quality", "features"])

    found = texts.mapInArrow(rows, f"draw long, name string, quality {texts.schema['quality'].dataType.simpleString()}, features binary")
    chains, marks = [], []
    for r in sorted(found.collect()):                           # at most sample_docs rows
        lines = np.frombuffer(r.features).reshape(-1, len(FEATURES))
        for at in range(0, len(lines), CHAIN_LINES):
            chains.append(lines[at:at + CHAIN_LINES])
            marks.append(int(r.quality > 0))
    return fit_crf(chains, marks)


def verdicts(table: LineTable, model: LineModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base rule, final verdict and share of words in content lines, per document."""
    docs = len(table.n_words)
    failed = (table.n_words < LEAST_WORDS) | (100 * table.n_repeat_words > MOST_REPEATED * table.n_words)
    scores = (table.features @ np.asarray(model.weights)).tolist()
    content = np.zeros(docs, np.int64)
    first = np.searchsorted(table.line_doc, np.arange(docs + 1)).tolist()
    label = np.zeros(len(scores), np.int64)
    for doc in range(docs):
        label[first[doc]:first[doc + 1]] = viterbi(scores[first[doc]:first[doc + 1]], model.moves)
    np.add.at(content, table.line_doc, label * table.line_words)
    share = content / np.maximum(table.n_words, 1)
    return failed, ~failed & (share >= LEAST_CONTENT), share


def line_quality(docs: DataFrame, model: LineModel, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, base rule and verdict of every document, from its whole text.

    A null or empty text has no words and fails the base rule. Repeated rows and null
    ids give a row each; very long texts are read whole, each by itself. Only the id and the text are read, so further
    columns cannot clash. An empty table gives no rows.
    """
    kept = docs.select(F.col(id_column).alias("doc_id"), text_column(text).alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "base_failed boolean, kept boolean, content_share double")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, borders in text_chunks(batch.column("text")):
                table = line_table(data, borders)
                failed, keep, share = verdicts(table, model)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, end - first), *map(pa.array, (
                        table.n_words, table.word_chars, table.n_symbols, table.n_dup_lines, table.n_repeat_words,
                        failed, keep, share))],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                     "kept", "content_share"])

    return kept.mapInArrow(judge, schema)


def keep_content(docs: DataFrame, model: LineModel, text: str = "text") -> DataFrame:
    """The rows, all columns unchanged, whose text passes the base rule and the CRF.

    Rows with null or empty texts go, repeated rows stay or go together, and
    an empty table stays empty.
    """
    both = docs.select(F.struct(*docs.columns).alias("row"), text_column(text).alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            keep = np.zeros(len(column), bool)
            for first, end, data, borders in text_chunks(column):
                keep[first:end] = verdicts(line_table(data, borders), model)[1]
            yield pa.RecordBatch.from_arrays([batch.column("row").filter(pa.array(keep))], ["row"])

    return both.mapInArrow(judge, both.select("row").schema).select("row.*")
