"""Verdicts and scores worked out again from their definitions, a text at a time."""

import math
import re

import numpy as np
import pytest
import zstandard

from attriflux.llm import compression_quality, line_quality

MODEL = line_quality.LineModel((0.4, -2.5, -1.0, -3.0, -2.0, -2.0, -0.5, -1.5, 0.2, -2.0), ((0.9, -0.3), (-0.8, 0.4)))


def plain_line_features(line: bytes, seen: set) -> list[float]:
    words = line.split()
    n = max(len(words), 1)
    letters = max(len(re.findall(rb"[A-Za-z]", line)), 1)
    dup = bool(words) and line in seen
    if words:
        seen.add(line)
    return [1, min(len(re.findall(rb"[#*$%&|<>]", line)) / n, 3) / 3, min(len(re.findall(rb"[A-Z]", line)) / letters, 1),
            min(line.count(b"|") / n, 1), min(line.count(b"!") / n, 2) / 2, min(sum(a == b for a, b in zip(words, words[1:])) / n, 1),
            min(len(re.findall(rb"[0-9]", line)) / n, 4) / 4, bool(words) and words[-1][-1:] not in b".!?:;\"')", len(words) < 4, dup]


def plain_verdict(text: str) -> tuple[bool, float]:
    """Best labels of all lines by exhaustive dynamic programming over pairs, then the share of words in content lines."""
    lines, seen = text.encode().split(b"\n"), set()
    scores = [float(np.dot(plain_line_features(x, seen), MODEL.weights)) for x in lines]
    best = [{0: (0.0, [0]), 1: (scores[0], [1])}]
    for score in scores[1:]:
        now = {}
        for label in (0, 1):
            options = [(best[-1][before][0] + MODEL.moves[before][label], before) for before in (1, 0)]     # ties: content first
            value, before = max(options, key=lambda o: o[0])
            now[label] = (value + (score if label else 0.0), best[-1][before][1] + [label])
        best.append(now)
    labels = best[-1][1 if best[-1][1][0] >= best[-1][0][0] else 0][1]
    words = [len(x.split()) for x in lines]
    total = sum(words)
    share = sum(w for w, l in zip(words, labels) if l) / max(total, 1)
    all_words = text.encode().split()
    failed = total < 20 or 100 * line_quality.repeated_words(all_words) > 30 * total
    return not failed and share >= 0.5, share


def test_kept_follows_from_the_definition(small_docs, texts):
    rows = {r.doc_id: r for r in line_quality.line_quality(small_docs, MODEL).collect()}
    kept = 0
    for doc, text in texts.items():
        wanted, share = plain_verdict(text)
        assert rows[doc].content_share == pytest.approx(share) and rows[doc].kept == wanted, doc
        kept += wanted
    assert 0.1 * len(texts) < kept < len(texts)


def test_long_labelled_texts_teach_with_all_lines(spark):
    """What is boilerplate stands after the hundredth line only."""
    prose = "\n".join(f"This is a sentence number {i} of a good text." for i in range(120))
    menu = "\n".join(f"| {i} | ## | %% |" for i in range(400))
    rows = [(f"g{i}", prose + f"\nText {i} ends here.") for i in range(40)]
    rows += [(f"b{i}", prose + "\n" + menu + f"\n{i} | |") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    labels = spark.createDataFrame([(d, int(d[0] == "g")) for d, _ in rows], "doc_id string, quality int")
    model = line_quality.train_line_model(docs, labels)
    first, tail = prose.split("\n")[0], menu.split("\n")[0]
    score = lambda line: float(np.dot(plain_line_features(line.encode(), set()), model.weights))
    assert score(first) > 0 > score(tail)
    out = {r.doc_id: r for r in line_quality.line_quality(docs, model).collect()}
    assert all(out[d].content_share < 0.9 for d, _ in rows if d[0] == "b") and all(out[d].content_share > 0.99 for d, _ in rows if d[0] == "g")


def test_compression_score_follows_from_sizes(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = compression_quality.train_compression_model(docs, labels)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}

    def sizes(text: bytes, data: bytes) -> int:
        packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(data), write_checksum=False,
                                          write_content_size=False, write_dict_id=False)
        return sum(len(packer.compress(text[i:i + 1024])) for i in range(0, len(text), 1024))

    for r in compression_quality.score_quality(docs, model).collect()[:150]:
        text = texts[r.doc_id]
        good, bad = sizes(text, model.good), sizes(text, model.bad)
        values = ((bad - good) / (bad + good), min(good, bad) / len(text), math.log(min(good, bad) / len(text))) if text else (0.0, 1.0, 0.0)
        z = sum(w * (v - c) / s for w, v, c, s in zip(model.weights, values, model.center, model.scale)) + model.weights[-1]
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-9) and r.predicted == (r.score >= 0.3)


def test_dictionaries_take_blocks_of_all_of_a_text():
    text = b"".join(bytes([65 + i % 26]) * 1024 for i in range(160))
    picked = []

    def trained(size, blocks, level):
        picked.extend(blocks)
        raise zstandard.ZstdError("not trained here")

    original, zstandard.train_dictionary = zstandard.train_dictionary, trained
    try:
        compression_quality.dictionary([text, b"short"])
    finally:
        zstandard.train_dictionary = original
    assert len(picked) == compression_quality.SAMPLE_BLOCKS + 1 and picked[0] == text[:1024] and picked[-2] == text[-1024:]
