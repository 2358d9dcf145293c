"""Best-fit packing of documents into sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attriflux.llm.shared import numbered_copies, sized, stored

LENGTHS = (256, 512, 1024, 2048, 4096)
GROUP_PIECES = 2048         # pieces that are packed together
OVERHEAD = 32               # cost of a sequence as such, in tokens
ATTENTION = 16384           # length at which attention costs as much as all that is linear in the length


def bin_costs(lengths: tuple[int, ...], overhead: float = OVERHEAD, attention: float = ATTENTION) -> dict[int, float]:
    """Cost of training on a sequence of each length: a fixed, a linear and a quadratic part."""
    return {length: overhead + length + length * length / attention for length in lengths}


def least_cost_length(size: int, costs: dict[int, float], left: list[int], counts: dict[int, int]) -> int:
    """The length to open for a piece: least cost per token, if what is left fills the rest greedily.

    ``left`` holds the sizes that still wait (ascending), ``counts`` how many
    pieces of each there are. Ties go to the shorter length.
    """
    best, best_rate = 0, float("inf")
    for length in sorted(costs):
        if length < size:
            continue
        room, filled, at = length - size, size, len(left)
        while room and at:
            at = bisect_left(left, room + 1, 0, at)
            if at == 0:
                break
            piece = left[at - 1]
            n = min(counts[piece], room // piece)
            room, filled, at = room - n * piece, filled + n * piece, at - 1
        rate = costs[length] / filled
        if rate < best_rate:
            best, best_rate = length, rate
    return best


def pack(sizes: list[int], costs: dict[int, float]) -> tuple[list[int], list[int], list[int]]:
    """Bin, offset and final length of every piece; the sizes come in falling order.

    A piece goes to the open bin with the least room that takes it. If there
    is none, the least-cost length is opened. At the end every bin shrinks to
    the cheapest length that holds its contents.
    """
    counts: dict[int, int] = {}
    for size in sizes:
        counts[size] = counts.get(size, 0) + 1
    left = sorted(counts)
    rooms: list[int] = []                     # distinct rooms of open bins, ascending
    by_room: dict[int, list[int]] = {}
    opened, used, bins, offsets = [], [], [], []
    for size in sizes:
        counts[size] -= 1
        if not counts[size]:
            left.pop(bisect_left(left, size))
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            chosen = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
        else:
            chosen, room = len(opened), least_cost_length(size, costs, left, counts)
            opened.append(room)
            used.append(0)
        bins.append(chosen)
        offsets.append(used[chosen])
        used[chosen] += size
        room -= size
        if room:
            if room not in by_room:
                by_room[room] = []
                insort(rooms, room)
            by_room[room].append(chosen)
    final = [min((c, n) for n, c in costs.items() if n >= filled)[1] for filled in used]
    return bins, offsets, [final[b] for b in bins]


def pack_documents(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, costs: dict[int, float] | None = None,
                   group_pieces: int = GROUP_PIECES, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Place all words of all documents into sequences of the permitted lengths.

    A document's size is its number of words. One that is longer than the
    longest length is cut into pieces of that length and a rest; the pieces
    follow each other in ``piece``. Pieces are dealt by hash into groups of
    about ``group_pieces``, each packed on its own, so no task depends on the
    number of documents and no key can be hot: equal rows are numbered first, and their numbers deal them like others. What a group wastes is one or
    two sequences that are not full. Returns doc_id, piece, first_word,
    n_words, sequence_id, seq_length and seq_offset.

    Documents without words (also null texts) get one row with piece 0, no
    words and null in the sequence columns. Null ids and repeated rows are
    packed as they are; equal sizes are placed in order of hash, id and piece.
    Only the id and the text are read, so further columns cannot clash. An
    empty table gives no rows.
    """
    costs = costs or bin_costs(lengths)
    longest = max(costs)
    sizes = stored(numbered_copies(stored(sized(docs, {"doc_id": F.col(id_column)}, text), "packing-sizes")), "packing-copies")
    piece = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("size") / longest) - 1).cast("int")))
    pieces = sizes.select("doc_id", "size", "copy", piece.alias("piece")).select(
        "doc_id", "copy", "piece", (F.col("piece").cast("long") * longest).alias("first_word"),
        F.least(F.lit(longest), F.col("size") - F.col("piece").cast("long") * longest).cast("int").alias("n_words"))
    total = sizes.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.col("size") / longest)))).first()[0] or 0
    groups = max(1, -(-int(total) // group_pieces))
    mixed = F.xxhash64("doc_id", "piece", "n_words")
    mixed = F.when(F.col("copy") > 0, F.xxhash64(mixed, "copy")).otherwise(mixed)
    pieces = pieces.withColumns({"_group": F.pmod(mixed, F.lit(groups)), "_mixed": mixed})
    schema = ("doc_id {}, piece int, first_word long, n_words int, sequence_id long, seq_length int, seq_offset int"
              .format(docs.schema[id_column].dataType.simpleString()))

    def place(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, sort_keys=[
            ("n_words", "descending"), ("_mixed", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")]))
        sizes = table["n_words"].to_pylist()
        full = sum(size > 0 for size in sizes)
        bins, offsets, finals = pack(sizes[:full], costs)
        rest = [None] * (len(sizes) - full)
        first = table["_group"][0].as_py() << 24
        out = table.select(["doc_id", "piece", "first_word", "n_words"])
        for name, values, kind in (("sequence_id", [first + b for b in bins], pa.int64()),
                                   ("seq_length", finals, pa.int32()), ("seq_offset", offsets, pa.int32())):
            out = out.append_column(name, pa.array([*values, *rest], kind))
        return out

    return pieces.groupBy("_group").applyInArrow(place, schema)
