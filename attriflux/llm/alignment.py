"""Alignment of two tokenizers' tokens, by divide and conquer at the ends they share.

Both tokenizers cover the same bytes. Where a token of each ends at the same
byte, the text can be cut; between neighbouring cuts lie the smallest groups of
tokens that cover the same bytes. The middle end of an interval is looked up
among the other side's ends by bisection, and both halves are searched on with
what the bisection left of the other side; an interval without ends on one side
has no cut and is a leaf. All intervals of a round are handled together.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attriflux.llm.shared import stored, sums

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_BYTES = 4 << 20       # texts whose links are counted together before they are shuffled (or one longer text)
CACHED_UNITS = 400_000      # units that are remembered; beyond them those met least often are forgotten
STEP_BYTES = 1 << 20        # texts that are aligned together (or one longer text)
RUN_CHARS = 1 << 15         # units that are new are encoded together up to this size (or one longer unit)
SMALL_GROUP = 1024          # links of a group that are listed one by one; larger groups by their distinct ids
# Fixed value: how byte-level vocabularies split a text into words before they merge.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A space between a visible character and anything: both tokenizers end a token before it, whatever stands around.
UNIT_BORDER = re.compile(r"(?<=[!-~¡-ᙿ]) (?=.)", re.DOTALL)


def byte_level_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte: itself, or the next one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteLevelTokens:
    """A byte-level BPE of the tokenizers library. Encodes a space and the text."""

    def __init__(self, model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model.decode())
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_level_alphabet()
        size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.entries = [bytes(alphabet[c] for c in t) if t and all(c in alphabet for c in t) else (t or "").encode()
                        for t in map(self.tokenizer.id_to_token, range(size))]
        known = json.loads(model)
        pre = known.get("pre_tokenizer") or {}
        self.divisible = known.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
        self.fast = self._ranked(known, alphabet) if self.divisible else None

    @staticmethod
    def _ranked(known: dict, alphabet: dict[str, int]):
        """The same vocabulary in tiktoken, which is faster, if its ids are the ranks of its merges."""
        import tiktoken

        added = {t["content"] for t in known.get("added_tokens", [])}
        ranks = {bytes(alphabet[c] for c in t): i for t, i in known["model"]["vocab"].items() if t not in added}
        merged = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in known["model"]["merges"]]
        by_rank = [known["model"]["vocab"]["".join(m)] for m in merged]
        if by_rank != sorted(by_rank) or len(ranks) != 256 + len(merged):
            return None
        return tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        """tiktoken where its letters and digits are the same for certain, else the tokenizers library."""
        if self.fast and all(t.isascii() or max(t) < "\u0250" for t in texts):
            return [self.fast.encode_ordinary(" " + t) for t in texts]
        return [e.ids for e in self.tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)]


class PieceTokens:
    """A BPE with byte fallback of the sentencepiece library, which adds the space itself."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_proto=model)
        pieces = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        self.entries = [bytes([int(p[3:-1], 16)]) if self.processor.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.divisible = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


@dataclass
class Tokens:
    """Token ids of a list of units on both sides, and their numbers per unit. Units that cannot be aligned have none."""

    a: np.ndarray
    b: np.ndarray
    a_counts: np.ndarray
    b_counts: np.ndarray
    aligned: np.ndarray


def _ends_visible(unit: str) -> bool:
    return "!" <= unit[-1] <= "~" or "\u00a1" <= unit[-1] <= "\u167f"


class PairEncoder:
    """Both tokenizers. Units are parts of texts before whose space both end a token; a text may be one unit."""

    def __init__(self, a_model: bytes, b_model: bytes):
        self.sides = ByteLevelTokens(a_model), PieceTokens(b_model)
        self.lengths = [np.array([len(e) for e in s.entries], np.int64) for s in self.sides]
        self.divisible = all(s.divisible for s in self.sides)

    def units(self, raw: bytes | None) -> list[str]:
        """The text's units, each to be read with a space before it. No text and no UTF-8: none."""
        try:
            text = raw.decode() if raw else ""
        except UnicodeDecodeError:
            return []
        return (UNIT_BORDER.split(text) if self.divisible else [text]) if text else []

    def _together(self, units: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids and their numbers per unit on both sides from one run over all units; None if it does not come out even."""
        joined = " ".join(units)
        data = b" " + joined.encode()
        borders = np.cumsum([len(u.encode()) + 1 for u in units])
        out = []
        for side, lengths in zip(self.sides, self.lengths):
            ids = side.encode([joined])[0]
            if b"".join([side.entries[i] for i in ids]) != data:
                return None
            ids = np.array(ids, np.int64)
            ends = np.cumsum(lengths[ids])
            last = np.searchsorted(ends, borders)
            if (ends[last] != borders).any():
                return None
            out.append((ids, np.diff(last, prepend=-1)))
        return out

    def _apart(self, unit: str) -> list[tuple[np.ndarray, np.ndarray]] | None:
        data, out = b" " + unit.encode(), []
        for side in self.sides:
            ids = side.encode([unit])[0]
            if b"".join([side.entries[i] for i in ids]) != data:
                return None
            out.append((np.array(ids, np.int64), np.array([len(ids)])))
        return out

    def __call__(self, units: list[str]) -> Tokens:
        runs, run, size = [], [], 0
        for unit in units:
            run.append(unit)
            size += len(unit)
            if size >= RUN_CHARS or not _ends_visible(unit):
                runs.append(run)
                run, size = [], 0
        if run:
            runs.append(run)
        parts, aligned = [], []
        for run in runs:
            found = self._together(run)
            for unit in ([None] if found else run):
                one = found or self._apart(unit)
                parts.append(one or [(np.zeros(0, np.int64), np.zeros(1, np.int64))] * 2)
                aligned += [one is not None] * (len(run) if unit is None else 1)
        joined = lambda side, what: np.concatenate([p[side][what] for p in parts]) if parts else np.zeros(0, np.int64)
        return Tokens(joined(0, 0), joined(1, 0), joined(0, 1), joined(1, 1), np.array(aligned, bool))


def shared_ends(a: np.ndarray, b: np.ndarray, a_borders: np.ndarray, b_borders: np.ndarray) -> np.ndarray:
    """Places in ``a`` (ascending) of the ends that ``b`` has too; the borders name the first intervals of both."""
    a_from, a_to, b_from, b_to = a_borders[:-1], a_borders[1:], b_borders[:-1], b_borders[1:]
    found = []
    while True:
        some = (a_from < a_to) & (b_from < b_to)        # the others have no end in common
        a_from, a_to, b_from, b_to = a_from[some], a_to[some], b_from[some], b_to[some]
        if not len(a_from):
            return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        middle = (a_from + a_to) >> 1
        at = np.minimum(np.searchsorted(b, a[middle]), b_to)
        cut = at < b_to
        cut[cut] = b[at[cut]] == a[middle[cut]]
        found.append(middle[cut])
        halves = (a_from, middle + 1), (middle, a_to), (b_from, at + cut), (at, b_to)
        a_from, a_to, b_from, b_to = (np.stack(h, axis=1).reshape(-1) for h in halves)


def _linked(a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray, row: np.ndarray,
            width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, pair (a * width + b) and number of links of all pairs of ids that share a group; pairs may repeat."""
    a_first, b_first = np.append(0, a_last[:-1] + 1), np.append(0, b_last[:-1] + 1)
    na, nb = a_last - a_first + 1, b_last - b_first + 1
    links = na * nb
    small = links <= SMALL_GROUP
    n, wide = links[small], nb[small]
    start = np.cumsum(n) - n
    step = np.arange(n.sum()) - np.repeat(start, n)
    wide = np.repeat(wide, n)
    pair = a[np.repeat(a_first[small], n) + step // wide] * width + b[np.repeat(b_first[small], n) + step % wide]
    rows, pairs, times = [np.repeat(row[small], n)], [pair], [np.ones(len(pair), np.int64)]
    for g in np.flatnonzero(~small):
        of_a, ka = np.unique(a[a_first[g]:a_last[g] + 1], return_counts=True)
        of_b, kb = np.unique(b[b_first[g]:b_last[g] + 1], return_counts=True)
        pairs.append((of_a[:, None] * width + of_b[None, :]).reshape(-1))
        times.append((ka[:, None] * kb[None, :]).reshape(-1))
        rows.append(np.full(len(pairs[-1]), row[g]))
    return np.concatenate(rows), np.concatenate(pairs), np.concatenate(times)


class Digits:
    """Writes groups as ``a1,a2|b1;a3|b2,b3``: each id with the sign before it, from one table of bytes."""

    def __init__(self, size: int):
        width = len(str(size)) + 1
        self.size = size
        text = [[(sign + str(i)).encode().ljust(width, b"\0") for i in range(size)] for sign in ("", ",", "|", ";")]
        self.table = np.frombuffer(b"".join(b"".join(t) for t in text), np.uint8).reshape(-1, width)

    def __call__(self, t: Tokens, a_last: np.ndarray, b_last: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The groups of all units as bytes, ``;`` after each unit, and the borders of the units; ``rows`` tells each group's unit."""
        na, nb = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
        place_a = np.arange(len(t.a)) + np.repeat(np.cumsum(nb) - nb, na)
        place_b = np.arange(len(t.b)) + np.repeat(a_last + 1, nb)
        new_unit = np.append(True, rows[1:] != rows[:-1])[:len(rows)]
        first_a, first_b = a_last - na + 1, b_last - nb + 1
        code = np.empty(len(t.a) + len(t.b), np.int64)
        code[place_a] = t.a + self.size
        code[place_b] = t.b + self.size
        code[place_a[first_a]] = t.a[first_a] + self.size * np.where(new_unit & (rows == rows[:1]), 0, 3)
        code[place_b[first_b]] = t.b[first_b] + self.size * 2
        written = self.table[code]
        used = written != 0
        sizes = np.concatenate([[0], np.cumsum(used.sum(axis=1))])
        borders = sizes[np.concatenate([[0], np.cumsum(t.a_counts + t.b_counts)])]
        # a unit's first sign is the ';' after the unit before it, so all borders but the first are one byte on
        borders[borders > 0] += 1
        return np.append(written[used], np.uint8(ord(";"))), borders


class _Codes(dict):
    """Numbers of units in the order in which they were first met."""

    def __missing__(self, unit: str) -> int:
        code = self[unit] = len(self)
        return code


@dataclass
class Table:
    """Values of several units, one after the other, and where each unit's begin and end."""

    values: np.ndarray
    borders: np.ndarray

    @classmethod
    def empty(cls, kind: type) -> Table:
        return cls(np.zeros(0, kind), np.zeros(1, np.int64))

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the units in this order, and how many each has."""
        sizes = self.borders[codes + 1] - self.borders[codes]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.borders[codes] - (ends - sizes), sizes)
        return self.values[shift + np.arange(len(shift))], sizes

    def add(self, values: np.ndarray, borders: np.ndarray) -> None:
        self.borders = np.concatenate([self.borders, borders[1:] + len(self.values)])
        self.values = np.concatenate([self.values, values.astype(self.values.dtype)])

    def keep(self, codes: np.ndarray) -> None:
        values, sizes = self.of(codes)
        self.values, self.borders = values, np.concatenate([[0], np.cumsum(sizes)])


_ID_COLUMNS = {"a_ids": 0, "b_ids": 1, "a_sizes": 2, "b_sizes": 2}      # and which of the three numbers counts their entries


@dataclass
class Step:
    """What is known of a few texts: tokens of both sides and groups, then links by text, and what was asked for."""

    totals: np.ndarray
    rows: np.ndarray
    pairs: np.ndarray
    times: np.ndarray
    digests: list[str]
    ids: dict[str, np.ndarray]


class Aligner:
    """Aligns units by divide and conquer and remembers them, so that a word that repeats is aligned once."""

    def __init__(self, a_model: bytes, b_model: bytes, ids: bool = True, digest: bool = True):
        self.encoder = PairEncoder(a_model, b_model)
        self.width = len(self.encoder.lengths[1])
        self.digits = Digits(max(len(n) for n in self.encoder.lengths)) if digest else None
        self.codes = _Codes()
        self.met = np.zeros(0, np.int64)
        self.numbers = np.zeros((0, 3), np.int64)
        self.aligned = np.zeros(0, bool)
        self.tables = {"pairs": Table.empty(np.int64), "times": Table.empty(np.int64), "digits": Table.empty(np.uint8)}
        self.tables |= {c: Table.empty(np.int32) for c in _ID_COLUMNS} if ids else {}

    def _align(self, units: list[str]) -> None:
        t = self.encoder(units)
        a_borders, b_borders = (np.concatenate([[0], np.cumsum(c)]) for c in (t.a_counts, t.b_counts))
        a_ends, b_ends = np.cumsum(self.encoder.lengths[0][t.a]), np.cumsum(self.encoder.lengths[1][t.b])
        a_last = shared_ends(a_ends, b_ends, a_borders, b_borders)
        b_last = np.searchsorted(b_ends, a_ends[a_last])
        rows = np.searchsorted(a_borders, a_last, "right") - 1
        row, pair, times = _linked(t.a, t.b, a_last, b_last, rows, self.width)
        order = np.argsort(row, kind="stable")
        units_at = np.arange(len(units) + 1)
        groups, pairs = np.searchsorted(rows, units_at), np.searchsorted(row[order], units_at)
        self.numbers = np.concatenate([self.numbers, np.stack([t.a_counts, t.b_counts, np.diff(groups)], axis=1)])
        self.aligned = np.concatenate([self.aligned, t.aligned])
        self.tables["pairs"].add(pair[order], pairs)
        self.tables["times"].add(times[order], pairs)
        if self.digits:
            self.tables["digits"].add(*self.digits(t, a_last, b_last, rows))
        if "a_ids" in self.tables:
            self.tables["a_ids"].add(t.a, a_borders)
            self.tables["b_ids"].add(t.b, b_borders)
            self.tables["a_sizes"].add(np.diff(a_last, prepend=-1), groups)
            self.tables["b_sizes"].add(np.diff(b_last, prepend=-1), groups)

    def _forget(self) -> None:
        """Keep the units met most often, at most half of what may be held."""
        kept = np.sort(np.argsort(-self.met, kind="stable")[:CACHED_UNITS // 2])
        names = list(self.codes)
        self.codes = _Codes((names[i], at) for at, i in enumerate(kept.tolist()))
        self.met, self.numbers, self.aligned = self.met[kept] // 2, self.numbers[kept], self.aligned[kept]
        for name, table in self.tables.items():
            if name != "digits" or self.digits:
                table.keep(kept)

    def __call__(self, texts: list[bytes | None]) -> Step:
        if len(self.codes) > CACHED_UNITS:
            self._forget()
        units, known = [self.encoder.units(t) for t in texts], len(self.codes)
        count = np.array([len(u) for u in units], np.int64)
        codes = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(units)), np.int64, int(count.sum()))
        new = list(islice(reversed(self.codes), len(self.codes) - known))[::-1]
        self._align(new)
        met = np.bincount(codes, minlength=len(self.codes))
        met[:known] += self.met
        self.met = met
        row = np.repeat(np.arange(len(texts)), count)
        if not self.aligned.all():
            whole = np.bincount(row[~self.aligned[codes]], minlength=len(texts)) == 0
            codes, row = codes[whole[row]], row[whole[row]]
            count = np.where(whole, count, 0)
        borders = np.concatenate([[0], np.cumsum(count)])
        totals = np.stack([sums(self.numbers[codes, i], borders) for i in range(3)], axis=1) if len(texts) else np.zeros((0, 3), np.int64)
        pairs, sizes = self.tables["pairs"].of(codes)
        times = self.tables["times"].of(codes)[0] if (self.tables["times"].values != 1).any() else np.ones(len(pairs), np.int64)
        digests = []
        if self.digits:
            data, written = self.tables["digits"].of(codes)
            at = np.concatenate([[0], np.cumsum(written)])[borders].tolist()
            data = data.tobytes()
            digests = [hashlib.sha256(data[i:j - 1]).hexdigest() if j > i else "" for i, j in zip(at, at[1:])]
        ids = {c: self.tables[c].of(codes)[0] for c in _ID_COLUMNS if c in self.tables}
        return Step(totals, np.repeat(row, sizes), pairs, times, digests, ids)


def _align_chunk(aligner: Aligner, texts: list):
    """Columns of the texts, and the chunk's pairs of ids with the number of texts that hold each."""
    steps, part, size, before = [], [], 0, 0
    for text in [*texts, None]:
        part.append(text)
        size += len(text or b"")
        if size >= STEP_BYTES:
            steps.append(aligner(part))
            steps[-1].rows += before
            before, part, size = before + len(part), [], 0
    steps.append(aligner(part[:-1]))                # the last one stands for the end
    steps[-1].rows += before
    n = len(texts)
    joined = lambda name: np.concatenate([getattr(s, name) for s in steps])
    totals, row, pair, times = (joined(c) for c in ("totals", "rows", "pairs", "times"))
    key = pair * n + row                            # below 2^63: vocabularies and chunks are small
    if (times == 1).all():
        key = np.sort(key)
    else:
        order = np.argsort(key)
        key, times = key[order], times[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    times = np.add.reduceat(times, first) if len(first) else times
    pair, row = np.divmod(key[first], max(n, 1))
    new = np.append(True, pair[1:] != pair[:-1])[:len(pair)]
    place, pairs = np.cumsum(new) - 1, pair[new]
    texts_with = np.diff(np.append(np.flatnonzero(new), len(new)))
    order = np.argsort(row.astype(np.uint16) if n < 1 << 16 else row, kind="stable")
    place, times, row = place[order], times[order], row[order]
    borders = np.searchsorted(row, np.arange(n + 1))
    lists = lambda values, cuts: pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values))
    named = {"n_a": pa.array(totals[:, 0]), "n_b": pa.array(totals[:, 1]), "n_groups": pa.array(totals[:, 2]),
             "n_links": pa.array(sums(times, borders)), "place": lists(place.astype(np.int32), borders), "times": lists(times, borders)}
    if aligner.digits:
        named["groups_sha256"] = pa.array([d for s in steps for d in s.digests], pa.string())
    for name in steps[0].ids:
        values = np.concatenate([s.ids[name] for s in steps])
        named[name] = lists(values, np.concatenate([[0], np.cumsum(totals[:, _ID_COLUMNS[name]])]))
    return named, pairs, texts_with


def _file(path: str) -> bytes:
    """A vocabulary file, read where the driver is. Its size does not depend on the documents."""
    with open(path, "rb") as file:
        return file.read()


def align_tokenizers(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE, ids: bool = True, digest: bool = False,
                     id_column: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: how its tokens of both vocabularies line up, and how usual its links are.

    doc_id, n_a, n_b, n_groups, n_links, n_best and count_sum; with ``ids`` also
    the token ids and the number of tokens of every group on both sides
    (``a_ids``, ``b_ids``, ``a_sizes``, ``b_sizes``), with ``digest`` the SHA-256
    of the groups written as ``a1,a2|b1;a3|b2,b3``. A link is a pair of tokens in
    one group. A pair of ids counts the documents (rows) that hold it linked;
    n_best counts links whose count is the highest of their first id, all of
    equals, and count_sum adds the counts of all links.

    Texts that are null, empty, no UTF-8, or whose tokens do not give back a
    space and the text have no tokens: zeros, empty lists, an empty digest.
    Null ids and repeated rows are rows like others. Only the id and the text
    are read, so further columns cannot clash. An empty table gives no rows.

    Texts are encoded once. Links are counted per chunk of texts first, so the
    shuffles hold a pair of ids once per chunk. What is broadcast has a row per
    id of the first vocabulary at most.
    """
    spark = docs.sparkSession
    # the files, and in every Python worker the aligner that it made of them
    models = spark.sparkContext.broadcast({"files": (_file(a_path), _file(b_path))})
    kept = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    own = ["n_a bigint", "n_b bigint", "n_groups bigint", "n_links bigint", "place array<int>", "times array<bigint>"]
    own += ["groups_sha256 string"] if digest else []
    own += [f"{c} array<int>" for c in _ID_COLUMNS] if ids else []
    schema = ", ".join([f"doc_id {kept.schema['doc_id'].dataType.simpleString()}", "chunk bigint", *own, "pairs array<bigint>", "texts_with array<bigint>"])

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = models.value
        if "aligner" not in held:
            held["aligner"] = Aligner(*held["files"], ids, digest)
        chunk = TaskContext.get().partitionId() << 32

        def finished(id_parts: list[pa.Array], texts: list):
            nonlocal chunk
            columns, pairs, texts_with = _align_chunk(held["aligner"], texts)
            n = len(texts)
            named = {"doc_id": pa.concat_arrays(id_parts), "chunk": pa.array(np.full(n, chunk)), **columns}
            empty = pa.nulls(n, pa.list_(pa.int64()))
            rows = pa.RecordBatch.from_pydict({**named, "pairs": empty, "texts_with": empty})
            yield rows
            if len(pairs):
                one = {c: pa.nulls(1, v.type) for c, v in named.items()} | {"chunk": pa.array([chunk])}
                cut = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v.astype(np.int64)))
                yield pa.RecordBatch.from_pydict({**one, "pairs": cut(pairs), "texts_with": cut(texts_with)})
            chunk += 1

        id_parts, texts, size = [], [], 0
        for batch in batches:
            first = 0
            for at, value in enumerate(batch.column("text")):
                raw = value.as_py()
                texts.append(raw)
                size += len(raw or b"")
                if size >= chunk_bytes:
                    id_parts.append(batch.column("doc_id").slice(first, at + 1 - first))
                    yield from finished(id_parts, texts)
                    id_parts, texts, size, first = [], [], 0, at + 1
            if first < batch.num_rows:
                id_parts.append(batch.column("doc_id").slice(first))
        if texts:
            yield from finished(id_parts, texts)

    rows = stored(kept.mapInArrow(aligned, schema), "token-groups")
    width = len(PieceTokens(models.value["files"][1]).entries)
    return _with_counts(rows, width)


def _with_counts(rows: DataFrame, width: int) -> DataFrame:
    """Adds what the counts of all documents tell, and leaves out what only served to find it."""
    listed = rows.filter(F.col("pairs").isNotNull()).select("chunk", F.posexplode(F.arrays_zip("pairs", "texts_with")).alias("at", "p"))
    listed = listed.select("chunk", "at", F.col("p.pairs").alias("pair"), F.col("p.texts_with").alias("texts_with"))
    counts = listed.groupBy("pair").agg(F.sum("texts_with").alias("count"))
    counts = counts.withColumn("a", F.floor(F.col("pair") / F.lit(width)))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))      # a row per id of the first vocabulary
    known = counts.join(F.broadcast(highest), "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    marked = listed.select(F.col("chunk").alias("of"), "at", "pair").join(known, "pair").select("of", "at", "count", "best")
    texts = rows.filter(F.col("place").isNotNull()).drop("pairs", "texts_with")
    names = [c for c in texts.columns if c not in ("chunk", "place", "times")]
    extra = [f"{f.name} {f.dataType.simpleString()}" for f in texts.schema.fields if f.name in names]
    schema = ", ".join([*extra, "n_best bigint", "count_sum bigint"])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        order = np.argsort(right["at"].to_numpy())
        count, best = right["count"].to_numpy()[order], right["best"].to_numpy()[order].astype(np.int64)
        one = lambda name: (left[name].chunk(0) if left[name].num_chunks else left[name].combine_chunks())
        place, times = one("place"), one("times")
        borders = place.offsets.to_numpy().astype(np.int64)
        borders = borders - borders[0]
        where, n = place.flatten().to_numpy(), times.flatten().to_numpy()
        out = left.select(names)
        out = out.append_column("n_best", pa.array(sums(n * best[where], borders)))
        return out.append_column("count_sum", pa.array(sums(n * count[where], borders)))

    return texts.groupBy("chunk").cogroup(marked.groupBy("of")).applyInArrow(finish, schema)
