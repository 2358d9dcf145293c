"""Personal data: exact base rules, and contextual extraction bootstrapped from what they find."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attriflux.llm.shared import row_keys, stored, text_column

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3                  # rounds of scoring patterns by instances and instances by patterns, at least
LEAST_SCORE = 0.8           # a pattern at or above is trusted, an instance accepted
LEAST_SEEDS = 3             # distinct seeds or accepted instances a trusted pattern was seen with
SMOOTHING = 2.0             # occurrences without evidence that every pattern is taken to have
LEAST_DIGITS = 6            # digits of a word that may be an identifier

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_EDGES = "\"'`()[]{}<>|,;.!?*#$%&"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail rule. All starts between two @ share what follows, so the first one decides."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield start, domain.end()
        at = text.find("@", max(free, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base rules, sorted."""
    found = [(start, 0, end) for start, end in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def patterns(text: str, start: int) -> list[str]:
    """Lexical patterns of a place: the word before it, and the two words before it."""
    words = []
    for word in text[max(0, start - 200):start].split()[-2:]:
        word = "#" if _DIGIT.search(word) else word.lower().strip(_EDGES) or word[:1]
        words.append(word[-40:])
    before = words[-1] if words else "^"
    return [before, f"{words[-2] if len(words) > 1 else '^'} {before}"]


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Words outside the base spans that have an @ or digits enough for an identifier, without their edges."""
    out = []
    if "@" not in text and not _DIGIT.search(text):
        return out
    at = 0
    for m in _WORD.finditer(text):
        word = m.group()
        if "@" not in word and sum(c in "0123456789" for c in word) < LEAST_DIGITS:
            continue
        start = m.start() + len(word) - len(word.lstrip(_EDGES))
        end = start + len(word.strip(_EDGES))
        while at < len(base) and base[at][0] < start and base[at][2] <= start:
            at += 1
        if end > start and not any(s < end and e > start for s, _, e in base[at:at + 8]):
            out.append((start, end))
    return out


def may_be(word: str) -> list[bool]:
    """Whether a word has the build of each kind."""
    digits = sum(c in "0123456789" for c in word)
    plain = all(c in "0123456789 .-+()/" for c in word)
    return ["@" in word[1:-1], plain and word.count(".") == 3, plain and 12 <= digits <= 19, plain and 7 <= digits <= 15]


_ITEM = "struct<start:int,kind:int,end:int>"
_PLACE = "struct<start:int,end:int,kind:int,fits:array<boolean>,instance:string,patterns:array<string>>"


def extract(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, k1, k2, base spans, counts per kind, base_sha256, and the places (seeds and candidates) of every text."""
    kept = docs.select(F.col(id_column).alias("doc_id"), *[c.alias(n) for n, c in row_keys(id_column, text).items()],
                       text_column(text).alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, k1 long, k2 long, base array<{_ITEM}>, n_email long, n_ip long, n_card long, n_phone long, "
              f"base_sha256 string, places array<{_PLACE}>")
    item = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    place = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()),
                                ("fits", pa.list_(pa.bool_())), ("instance", pa.string()),
                                ("patterns", pa.list_(pa.string()))]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases, counts, hashes, places = [], [[], [], [], []], [], []
            for value in batch.column("text"):
                value = value.as_py()
                base = base_spans(value)
                joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base)
                bases.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                hashes.append(hashlib.sha256(joined.encode()).hexdigest())
                for k in range(4):
                    counts[k].append(sum(1 for b in base if b[1] == k))
                seen = [(s, e, k, [j == k for j in range(4)]) for s, k, e in base]
                seen += [(s, e, None, may_be(value[s:e])) for s, e in candidates(value, base)]
                places.append([{"start": s, "end": e, "kind": k, "fits": fits,
                                "instance": hashlib.md5(value[s:e].lower().encode()).hexdigest()[:16],
                                "patterns": patterns(value, s)} for s, e, k, fits in seen])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("k1"), batch.column("k2"), pa.array(bases, item),
                 *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array(places, place)],
                ["doc_id", "k1", "k2", "base", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "places"])

    return kept.mapInArrow(find, schema)


def bootstrapped(places: DataFrame, rounds: int = ROUNDS, least_score: float = LEAST_SCORE,
                 least_seeds: int = LEAST_SEEDS) -> tuple[DataFrame, DataFrame]:
    """(pattern, kind, score) of patterns that can be trusted and (instance, kind) of known instances, from their graph.

    ``places`` has a row per pattern of a place: pattern, instance, kind (of
    seeds, else null), fits. A pattern's score for a kind is the mean score of the
    instances it stands with, an instance's is the mean over its patterns;
    seeds keep 1. An instance with the build of the kind is accepted when the
    patterns that have enough seeds give it the least score; from the next round on it is a seed.
    Rounds go on until one adds none. Scores are rounded, so they do not depend on the order of sums.
    """
    edges = stored(places.groupBy("pattern", "instance", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.first("fits").alias("fits")), "pii-edges")
    known = stored(edges.filter("kind IS NOT NULL").select("instance", "kind").distinct(), "pii-known")
    links = edges.groupBy("pattern", "instance").agg(F.sum("n").alias("n"))
    of_pattern = links.groupBy("pattern").agg(F.sum("n").alias("total"))
    of_instance = links.groupBy("instance").agg(F.sum("n").alias("total"))
    builds = edges.filter("kind IS NULL").groupBy("instance").agg(F.first("fits").alias("fits"))
    sure = lambda: known.withColumn("score", F.lit(1.0))
    scores, number, done = sure().withColumn("seed", F.lit(1)), known.count(), 0
    while True:
        reached = links.join(scores, "instance").groupBy("pattern", "kind").agg(
            F.sum(F.col("n") * F.col("score")).alias("s"), F.sum("seed").alias("seeds"))
        scored = stored(reached.join(of_pattern, "pattern").select(
            "pattern", "kind", F.round(F.col("s") / (F.col("total") + SMOOTHING), 6).alias("score"), "seeds"), "pii-patterns")
        back = links.join(scored, "pattern").groupBy("instance", "kind").agg(
            F.sum(F.col("n") * F.col("score")).alias("s"),
            F.sum(F.when(F.col("seeds") >= least_seeds, F.col("n") * F.col("score")).otherwise(0.0)).alias("t"))
        back = back.join(of_instance, "instance").join(known.select("instance").distinct(), "instance", "left_anti")
        back = stored(back.select("instance", "kind", F.round(F.col("s") / F.col("total"), 6).alias("score"),
                                  F.round(F.col("t") / F.col("total"), 6).alias("trusted")), "pii-instances")
        new = back.filter(F.col("trusted") >= least_score).join(builds, "instance").filter("element_at(fits, kind + 1)")
        known, before, done = stored(known.unionByName(new.select("instance", "kind")), "pii-known"), number, done + 1
        number = known.count()
        if number == before and done >= rounds:
            break
        back = back.join(known.select("instance").distinct(), "instance", "left_anti").select("instance", "kind", "score")
        scores = sure().withColumn("seed", F.lit(1)).unionByName(back.withColumn("seed", F.lit(0)))
    trusted = scored.filter((F.col("score") >= least_score) & (F.col("seeds") >= least_seeds))
    return trusted.select("pattern", "kind", "score"), known


def discovered(extracted: DataFrame, **options) -> DataFrame:
    """k1, k2 and the spans outside the base spans that trusted patterns find, or whose instances are known."""
    place = extracted.select("k1", "k2", F.explode("places").alias("p")).select("k1", "k2", "p.*")
    each = place.withColumn("pattern", F.explode("patterns"))
    trusted, known = bootstrapped(each.select("pattern", "instance", "kind", "fits"), **options)
    fields = ["k1", "k2", "start", "end", "kind", "score"]
    open_places = lambda rows: rows.filter("kind IS NULL").drop("kind")
    hits = open_places(each).join(trusted, "pattern").filter("element_at(fits, kind + 1)").select(*fields)
    own = open_places(place).join(known, "instance").filter("element_at(fits, kind + 1)").withColumn("score", F.lit(1.0))
    hits = hits.unionByName(own.select(*fields))
    best = hits.groupBy("k1", "k2", "start", "end").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"))
    return best.groupBy("k1", "k2").agg(F.collect_list(F.struct(
        F.col("start"), F.col("kind"), F.col("end"))).cast(f"array<{_ITEM}>").alias("more"))


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Base counts and hash, and all spans (start, kind number, end) of every row.

    Entities of the base rules are seeds. The words before them are lexical
    patterns; Spark scores the graph of patterns and instances in rounds, and
    patterns that are trusted then mark identifiers outside the base spans that
    have the build of their kind. Identifiers that are seeds elsewhere, or were
    accepted in a round, are marked wherever they stand. Null texts count as empty. Rows that repeat
    give a row each; further columns are not read. An empty table gives no rows.
    """
    rows = stored(extract(docs, id_column, text), "pii-rows")
    found = discovered(rows, **options)
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(f"array<{_ITEM}>"))))
    return rows.join(found, ["k1", "k2"], "left").select(
        "doc_id", "k1", "k2", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans.alias("spans"))


def span_text(spans) -> F.Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: str, spans: list[dict]) -> str:
    """The text with each span replaced by its kind; spans that overlap are one, named after the first."""
    out, at, until = [], 0, -1
    for span in spans:
        if span["start"] >= until:
            out += [text[max(at, 0):span["start"]], f"<{KINDS[span['kind']].upper()}>"]
        at = until = max(until, span["end"])
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                       length_column: str | None = None, **options) -> DataFrame:
    """The rows with personal data replaced by their kinds; no row goes, all other columns are unchanged.

    ``length_column``, if named, gets the new length of texts that changed.
    """
    found = find_personal_data(docs, id_column, text, **options).filter(F.size("spans") > 0)
    found = found.groupBy("k1", "k2").agg(F.first("spans").alias("spans"))       # equal rows have equal spans
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"),
                       *[c.alias(n) for n, c in row_keys(id_column, text).items()])
    rows = rows.join(found, ["k1", "k2"], "left").select("row", "text", "spans")
    schema = rows.select("row", F.col("text").cast("string").alias("text")).schema

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [masked(t, s) if s else t for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, schema_type)], ["row", "text"])

    schema_type = pa.string()
    out = rows.mapInArrow(mask, schema)
    columns = [F.col("text").alias(c) if c == text else
               F.when(F.col("text").isNull() | (F.col("text") == F.col("row")[text]), F.col("row")[c])
               .otherwise(F.length("text")).cast(docs.schema[c].dataType).alias(c) if c == length_column else
               F.col("row")[c].alias(c) for c in docs.columns]
    return out.select(*columns)
