"""Toxicity, tokenizer alignment and whitening against brute force, planted structure or held-out rows."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from attriflux.llm import alignment, queries, toxicity, whitening

N = 11      # rows of edge_docs


# ---- 11: toxicity ----

def test_held_out_rows_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.find_toxicity(docs, labels)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    toxic = [r.predicted for r in rows if r.toxic == 1]
    flagged = [r.toxic for r in rows if r.predicted == 1]
    assert len(rows) > 700 and sum(toxic) > 0.9 * len(toxic) and sum(flagged) > 0.93 * len(flagged)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_labels_of_held_out_rows_do_not_matter(spark, folder):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = ({r.doc_id: r.score for r in toxicity.find_toxicity(docs, x).collect()} for x in (labels, turned))
    assert one.keys() == two.keys() and all(abs(one[d] - two[d]) < 1e-9 for d in one)


def test_label_model_finds_accuracies_and_correlations(spark):
    """Voters of known accuracy, two of which copy a third, without a label for most rows."""
    draws = np.random.default_rng(4)
    toxic = draws.random(30000) < 0.2
    rates = [(0.6, 0.02), (0.5, 0.05), (0.4, 0.01), (0.3, 0.2)]
    fires = [np.where(toxic, draws.random(30000) < a, draws.random(30000) < b) for a, b in rates]
    fires += [fires[3] ^ (draws.random(30000) < 0.02), fires[3] ^ (draws.random(30000) < 0.02)]
    votes = sum(f.astype(np.int64) << i for i, f in enumerate(fires))
    counts = sorted(Counter(votes.tolist()).items())
    patterns = spark.createDataFrame(counts, "votes long, n long")
    known = slice(0, 400)
    alone = toxicity.estimate(patterns, votes[known], toxic[known].astype(int), tuple((i,) for i in range(6)), 0.2)
    blocks = toxicity.correlated_blocks(patterns, alone, 6)
    assert any({3, 4, 5} <= set(b) for b in blocks)
    model = toxicity.estimate(patterns, votes[known], toxic[known].astype(int), blocks, 0.2)
    real = [toxic[f].mean() for f in fires]
    assert np.abs(model.accuracy(6) - real).max() < 0.06
    loss = lambda m: -np.mean(np.log(np.where(toxic, m.posterior(votes), 1 - m.posterior(votes))))
    assert loss(model) < loss(alone)


def test_posterior_is_bayes_rule():
    tables = (np.log([[0.9, 0.1], [0.4, 0.6]]), np.log([[0.7, 0.1, 0.1, 0.1], [0.2, 0.2, 0.2, 0.4]]))
    model = toxicity.LabelModel(0.25, ((1,), (0, 2)), tables)
    for votes in range(8):
        one, two = votes >> 1 & 1, (votes & 1) | (votes >> 2 & 1) << 1
        clean, bad = (np.exp(tables[0][y][one] + tables[1][y][two]) * s for y, s in ((0, 0.75), (1, 0.25)))
        assert model.posterior(np.array([votes]))[0] == pytest.approx(bad / (clean + bad))


def test_reader_of_texts():
    reader = toxicity.Reader(("idiot$", "stup", "wort"), 2)
    held, flags, hits, n = reader("You IDIOT, you 1d10t: stupid, stupid worthy man!! Ha!!".encode())
    assert held == [0, 1, 2] and hits == 3 and n == 10
    named = {p for i, p in enumerate(toxicity.PATTERNS) if flags >> i & 1}
    assert named == {"two different words", "a word repeated", "a word in 100", "a word in 1000", "calls out twice"}
    disguised = toxicity.Reader(("idiot$",), 1)("an idi0t".encode())
    assert disguised[0] == [0] and disguised[1] >> toxicity.PATTERNS.index("a disguised word") & 1
    assert reader(b"")[1] == 1 << toxicity.PATTERNS.index("no letters")


def test_toxicity_edges(edge_docs, spark):
    none = spark.createDataFrame([(5, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.find_toxicity(edge_docs, none).collect()
    assert len(out) == N and {(r.score, r.predicted) for r in out} == {(0.0, 0)}
    rows = [(i, ("a nasty word here " if i % 2 else "a pleasant word here ") + f"x{i}" * (i % 5)) for i in range(200)]
    docs = spark.createDataFrame([*rows, (None, "nasty"), (3, None), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)] + [(1, 1), (None, 1)], "doc_id long, toxic int")
    found = toxicity.find_toxicity(docs, labels).collect()
    assert len(found) == 203
    assert all(r.predicted == r.doc_id % 2 for r in found if r.doc_id not in (None, 3))
    assert sorted(r.predicted for r in found if r.doc_id == 3) == [0, 0, 1] and {r.predicted for r in found if r.doc_id is None} == {1}
    text_ids = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    text_labels = labels.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert toxicity.find_toxicity(text_ids, text_labels).filter("predicted = 1").count() > 90
    assert toxicity.find_toxicity(edge_docs.limit(0), labels).count() == 0
    assert toxicity.find_toxicity(edge_docs, labels.limit(0)).count() == N


# ---- 12: alignment of tokenizers ----

@pytest.fixture(scope="module")
def tokenizers():
    return (alignment.ByteLevelTokens(open(alignment.BYTE_BPE, "rb").read()),
            alignment.PieceTokens(open(alignment.PIECE_BPE, "rb").read()))


def whole_tokens(tokenizers, text):
    """Ids of the whole text at once, by the tokenizers' own libraries."""
    if not text:
        return [], []
    one = [e.ids for e in tokenizers[0].tokenizer.encode_batch([" " + text], add_special_tokens=False)][0]
    two = tokenizers[1].processor.encode(text)
    same = all(b"".join(t.entries[i] for i in ids) == (" " + text).encode() for t, ids in zip(tokenizers, (one, two)))
    return (one, two) if same else ([], [])


def groups_by_ends(tokenizers, one, two):
    """Groups by a walk over all bytes' ends."""
    cuts = []
    for t, ids in zip(tokenizers, (one, two)):
        cuts.append(np.cumsum([len(t.entries[i]) for i in ids]).tolist())
    shared = set(cuts[0]) & set(cuts[1])
    out = []
    for ids, ends in zip((one, two), cuts):
        side, part = [], []
        for i, end in zip(ids, ends):
            part.append(i)
            if end in shared:
                side.append(part)
                part = []
        out.append(side)
    return list(zip(*out))


def brute_force(tokenizers, texts):
    """Per text: the columns of op12."""
    groups = [groups_by_ends(tokenizers, *whole_tokens(tokenizers, t)) for t in texts]
    links = [Counter((a, b) for x, y in g for a in x for b in y) for g in groups]
    count = Counter(p for l in links for p in l)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for g, l in zip(groups, links):
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(l.values()),
                    sum(n for p, n in l.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in l.items()),
                    hashlib.sha256(written.encode()).hexdigest() if g else ""))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
STRANGE = ["<|endoftext|> <s> </s> <unk> <0x41>", "a  b   c\n\n d \t e\r\n", " ", "  ", "\n", "x " * 7, "日本語のテキスト と 漢字", "👩‍👩‍👧‍👦 emoji 🙂",
           "non breaking spaces here", "▁ already a piece", "a\u0000b", "ﬁ ligature É é", "'s 't don't we'll I'm",
           "=" * 5000, "=-" * 3000, "aB1" * 900, "\u0085next line", "tab\tand  　 space", "Ω≈ç√∫ ˜µ≤≥÷", "٠١٢ अआइ ١", "trailing space "]


def test_alignment_equals_brute_force(spark, tokenizers, texts):
    rows = sorted(texts.items()) + [(1000 + i, t) for i, t in enumerate(STRANGE)] + [(2000, None), (2001, ""), (2002, texts[0])]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, n_links string").repartition(3)
    found = {r.doc_id: r for r in alignment.align_tokenizers(docs, ids=False, digest=True, chunk_bytes=50_000).collect()}
    expected = brute_force(tokenizers, [t for _, t in rows])
    assert len(found) == len(rows)
    for (doc, text), wanted in zip(rows, expected):
        assert tuple(found[doc][c] for c in COLUMNS) == wanted, (doc, text and text[:60])


def test_random_texts_divide_like_whole_ones(tokenizers):
    """Units encoded apart, by the faster library, give the tokens of whole texts."""
    draws = random.Random(5)
    pool = [*"abcdefghijklmnop ABC 0123456789.,;:!?'\"()-_#$%&*\n\t ", "é", "ñ", "ß", " ", "­", "́", "​", "я", "中", "🙂", "▁",
            " the", " don't", "  ", "\r\n", "'ll", "http://", " ", "ª", "²", "٠"]
    made = ["".join(draws.choice(pool) for _ in range(draws.randint(1, 300))) for _ in range(400)]
    aligner = alignment.Aligner(open(alignment.BYTE_BPE, "rb").read(), open(alignment.PIECE_BPE, "rb").read())
    step = aligner([t.encode() for t in made])
    at = np.concatenate([[0], np.cumsum(step.totals[:, 0])]), np.concatenate([[0], np.cumsum(step.totals[:, 1])])
    for i, text in enumerate(made):
        one, two = whole_tokens(tokenizers, text)
        assert step.ids["a_ids"][at[0][i]:at[0][i + 1]].tolist() == one, text
        assert step.ids["b_ids"][at[1][i]:at[1][i + 1]].tolist() == two, text


def test_shared_ends_against_sets():
    draws = random.Random(6)
    for _ in range(200):
        a, b = (np.array(sorted(draws.sample(range(1, 60), draws.randint(0, 40)))) for _ in range(2))
        a, b = (np.append(x, 60).astype(np.int64) for x in (a, b))
        got = alignment.shared_ends(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
        assert a[got].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_forgotten_units_are_aligned_anew(monkeypatch, tokenizers, texts):
    monkeypatch.setattr(alignment, "CACHED_UNITS", 50)
    models = [open(p, "rb").read() for p in (alignment.BYTE_BPE, alignment.PIECE_BPE)]
    some = [t.encode() for t in list(texts.values())[:40]]
    small, large = alignment.Aligner(*models), alignment.Aligner(*models)
    parts = [small([t]) for t in some]
    whole = large(some)
    assert [d for p in parts for d in p.digests] == whole.digests
    assert np.concatenate([p.pairs for p in parts]).tolist() == whole.pairs.tolist()
    assert np.concatenate([p.ids["b_sizes"] for p in parts]).tolist() == whole.ids["b_sizes"].tolist()


def test_ids_and_sizes_give_back_the_groups(spark, tokenizers, edge_docs):
    rows = alignment.align_tokenizers(edge_docs).collect()
    assert len(rows) == N and {r.n_a for r in rows if r.doc_id in (1, 2)} == {0}
    for r in rows:
        a, b = iter(r.a_ids), iter(r.b_ids)
        groups = [([next(a) for _ in range(m)], [next(b) for _ in range(n)]) for m, n in zip(r.a_sizes, r.b_sizes)]
        assert next(a, None) is None and next(b, None) is None and len(groups) == r.n_groups
        for one, two in groups:
            assert b"".join(tokenizers[0].entries[i] for i in one) == b"".join(tokenizers[1].entries[i] for i in two)
    assert alignment.align_tokenizers(edge_docs.limit(0)).count() == 0
    nothing = alignment.align_tokenizers(edge_docs.filter("doc_id < 3"), ids=False, digest=True).collect()
    assert [(r.n_a, r.count_sum, r.groups_sha256) for r in nothing] == [(0, 0, "")] * 2


# ---- 13: whitening ----

def components_by_eigenvectors(vectors):
    x = np.floor(256 * np.array(vectors, float))
    distinct = np.unique(x, axis=0)
    centred = distinct - distinct.mean(axis=0)
    e, w = np.linalg.eigh(centred.T @ centred / len(distinct))
    return x, distinct, e[::-1], w[:, ::-1]


def check_whitened(rows, vectors, most=4):
    """Rows (vec_id is the vector's place) against eigenvectors; either sign. Returns the number of components."""
    x, distinct, e, w = components_by_eigenvectors(vectors)
    k = max((r.component for r in rows), default=0)
    real = int((e > 1e-12 * max(e[0], 1e-300)).sum()) if e[0] > 0 else 0
    assert k == min(most, real) and len(rows) == k * len(vectors)
    sums = [int(v) for v in distinct.sum(axis=0)]
    for j in range(k):
        mine = {r.vec_id: r for r in rows if r.component == j + 1}
        wanted = (x - distinct.mean(axis=0)) @ w[:, j] / np.sqrt(e[j])
        got = np.array([mine[i].whitened for i in range(len(vectors))])
        assert min(np.abs(got - wanted).max(), np.abs(got + wanted).max()) < 1e-8
        for i, r in mine.items():
            assert r.n == len(distinct) and abs(r.explained - e[j] / e.sum()) < 1e-10 and r.identity_error < 1e-8
            assert r.deviation == sum((len(distinct) * int(v) - s) ** 2 for v, s in zip(x[i], sums))
    return k


def whitened(spark, vectors):
    table = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    return whitening.whiten(table.repartition(3)).collect()


def test_given_embeddings(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in table.collect()}
    assert sorted(vectors) == list(range(len(vectors)))
    assert check_whitened(queries.QUERIES["op13_embedding_whitening"](spark, folder).collect(), [vectors[i] for i in range(len(vectors))]) == 4


@pytest.mark.parametrize("shape", [(60, 3), (4, 12), (300, 24), (7, 1), (2, 5)])
def test_random_vectors(spark, shape):
    draws = np.random.default_rng(shape[0])
    vectors = draws.normal(size=shape) * draws.uniform(0.2, 5, size=shape[1])
    check_whitened(whitened(spark, [*vectors.tolist(), vectors[0].tolist()]), [*vectors.tolist(), vectors[0].tolist()])


def test_equal_variances_are_all_found(spark):
    """Four directions of equal variance above a floor: one start alone sees one of them."""
    draws = np.random.default_rng(3)
    corners = np.vstack([np.eye(40)[:4] * s for s in (9.0, -9.0)])
    noise = np.vstack([np.diag(draws.uniform(0.25, 1, 40))[4:] * s for s in (1.0, -1.0)])
    rows = whitened(spark, [*corners.tolist(), *noise.tolist()])
    x, distinct, e, _ = components_by_eigenvectors([*corners.tolist(), *noise.tolist()])
    assert e[3] > 5 * e[4] and {round(r.explained / (e[0] / e.sum()), 8) for r in rows} == {1.0}
    assert max(r.component for r in rows) == 4 and max(r.identity_error for r in rows) < 1e-8


def test_left_vectors_stay_orthogonal(spark):
    draws = np.random.default_rng(8)
    vectors = np.floor(draws.normal(size=(200, 12)) * np.logspace(0, 4, 12))
    fit = spark.createDataFrame([(v,) for v in vectors.astype(int).tolist()], "x array<long>").repartition(4)
    rows = whitening.Rows(fit, whitening._column_sums(fit, 12))
    s, v = whitening.bidiagonalise(rows, 6)
    real = np.linalg.svd(vectors - vectors.mean(axis=0), compute_uv=False)
    assert np.abs(s / real[:6] - 1).max() < 1e-12 and np.abs(v.T @ v - np.eye(6)).max() < 1e-12


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0], 9), (1, [0.5, 1.0], 9), (None, [1.0, -2.0], 9), (2, None, 9), (3, [None, 1.0], 9), (4, [nan, 1.0], 9),
            (5, [inf, 1.0], 9), (6, [0.25], 9), (7, [-0.0, 0.001], 9), (8, [], 9)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int").withColumn("component", F.lit("clash"))
    out = whitening.whiten(table).collect()
    kept = [[0.5, 1.0], [0.5, 1.0], [1.0, -2.0], [0.25, 0.0], [0.0, 0.0], [0.0, 0.0]]
    assert Counter(r.vec_id for r in out) == {1: 4, None: 2, 6: 2, 7: 2, 8: 2}
    x, distinct, e, w = components_by_eigenvectors(kept)
    assert {r.n for r in out} == {len(distinct)} == {4}
    first = (np.array([256, -512]) - distinct.mean(axis=0)) @ w[:, 0] / np.sqrt(e[0])
    assert [abs(r.whitened) for r in out if r.vec_id is None and r.component == 1] == [pytest.approx(abs(first))]
    assert whitening.whiten(table.limit(0)).count() == 0 and whitening.whiten(table.filter("vec_id = 1")).count() == 0
    assert whitening.whiten(table.filter("vec_id = 8")).count() == 0
    huge = whitened(spark, [[1e300, 1.0], [-1e300, 2.0], [0.0, 3.0], [5e14, 1.0]])
    assert {r.deviation for r in huge if r.vec_id == 0} == {None} and all(np.isfinite(r.whitened) for r in huge)
