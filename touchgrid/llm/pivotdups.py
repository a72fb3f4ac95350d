"""SimHash near-duplicates by pivot distance tables.

A fingerprint has 64 bits, each the majority of that bit over the hashes of all word shingles.
Equal fingerprints collapse to one first. Two fingerprints that differ in at most r of 64 bits,
cut into r + 3 slices, agree in 3 whole slices, so every choice of 3 slices deals the fingerprints
into rooms, and each link lies in some room. Inside a room the pivot table does the work: the
Hamming distances of every member to many reference fingerprints are computed once, members stand
in the order of the first distance, and because each distance can differ by no more than the
fingerprints themselves do, a member is only held against those that follow within r; a pair whose
greatest coordinate difference is more than r is discarded, and the survivors are verified bit by
bit.

Rooms are cut by range partitioning on (room, first distance, fingerprint), so a room of any size
spreads over many tasks, as runs of bounded size. A run is compared within itself on the spot; only
rooms of several runs are met again, run against run. What leaves a task is not pairs but each
member's representative, so large groups of copies make few rows.

Defined results: words are runs of anything but ASCII white space, with A-Z lower-cased; a text
with fewer words than a shingle has its whole word sequence as its only one; a null text or one
without words has the fingerprint zero, which links like any other; a row with a null doc_id is left out;
rows that repeat a doc_id each come out with their own fingerprint, and as one document they hold
their fingerprints' links together; a component is named by its smallest doc_id; an empty table
gives no rows; columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import re
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchgrid.llm.common import block_batches, stage_table, table
from touchgrid.operators.components import connected_components

SHINGLE = 3
RADIUS = 3
HASH_SEED = 42
PIVOTS = 24
PIVOT_SEED = 5
BITS = 64
#: Members of a run: the most that are compared with each other at a time.
RUN_ROWS = 4096
#: Bytes of text whose shingles are held at a time.
SEGMENT_BYTES = 1 << 20
SPACE = re.compile(rb"[ \t-\r]")


def shingle_bits(text: str | None, size: int = SHINGLE):
    """(counts, n): how many of the text's n shingle hashes have each bit, the highest first."""
    import numpy as np
    import xxhash

    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    counts, n, carried, at = np.zeros(BITS, np.int64), 0, [], 0
    while at < len(raw):
        end = min(at + SEGMENT_BYTES, len(raw))
        if end < len(raw):
            found = SPACE.search(raw, end)
            end = found.start() if found else len(raw)
        words = carried + raw[at:end].split()
        at = end
        if len(words) >= size:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
        elif at == len(raw) and n == 0 and words:
            shingles = [b" ".join(words)]
        else:
            shingles = []
        carried = words[-(size - 1):] if size > 1 else []
        hashes = np.array([xxhash.xxh64_intdigest(s, HASH_SEED) for s in shingles], ">u8")
        if len(hashes):
            counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            n += len(hashes)
    return counts, n


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of documents (doc_id, text); fp is the fingerprint as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            prints = []
            for text in batch.column("text"):
                counts, n = shingle_bits(text.as_py(), size)
                prints.append(np.packbits(2 * counts > n).view(">i8")[0])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def slice_masks(radius: int = RADIUS, agreeing: int = 3) -> list[int]:
    """The bits of every choice of `agreeing` slices out of radius + agreeing; signed like a long."""
    slices = radius + agreeing
    edges = [i * BITS // slices for i in range(slices + 1)]
    bits = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(slices)]
    masks = [sum(bits[i] for i in chosen) for chosen in combinations(range(slices), agreeing)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def references(count: int = PIVOTS):
    """The reference fingerprints, the same in every task."""
    import numpy as np

    return np.random.default_rng(PIVOT_SEED).integers(0, 1 << 64, count, dtype=np.uint64)


def distance_table(fps, pivots):
    """Hamming distances, one row for each reference."""
    import numpy as np

    return np.bitwise_count(fps[None, :] ^ pivots[:, None]).astype(np.int8)


class Groups:
    """Representatives of numbered members: the smallest member that links lead to."""

    def __init__(self, n: int):
        import numpy as np

        self.top = np.arange(n)

    def merge(self, left, right) -> None:
        import numpy as np

        while True:
            a, b = self.top[left], self.top[right]
            apart = a != b
            if not apart.any():
                return
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(self.top, np.maximum(a, b), np.minimum(a, b))
            while True:
                further = self.top[self.top]
                if (further == self.top).all():
                    break
                self.top = further


def survivors(fps, table, left, right, radius: int):
    """The pairs (left, right) of members within the radius: pivot coordinates first, then the bits."""
    import numpy as np

    for row in table:
        if not len(left):
            break
        near = np.abs(row[left] - row[right]) <= radius
        left, right = left[near], right[near]
    near = np.bitwise_count(fps[left] ^ fps[right]) <= radius
    return left[near], right[near]


def link_inside(rooms, fps, table, radius: int):
    """Groups of members sorted by (room, first distance): links only inside a room."""
    import numpy as np

    groups, at, step = Groups(len(fps)), np.arange(len(fps)), 1
    first = table[0]
    while len(at):
        at = at[at + step < len(fps)]
        other = at + step
        # In a room's order the first coordinate only grows, so who is too far now stays so.
        near = (rooms[at] == rooms[other]) & (first[other] - first[at] <= radius)
        at, other = at[near], other[near]
        apart = groups.top[at] != groups.top[other]
        groups.merge(*survivors(fps, table, at[apart], other[apart], radius))
        step += 1
    return groups.top


def link_across(fps_a, fps_b, pivots, radius: int):
    """Groups over the members of two runs of a room, a's first, by links from one to the other."""
    import numpy as np

    fps = np.concatenate([fps_a, fps_b])
    table, groups, n = distance_table(fps, pivots), Groups(len(fps_a) + len(fps_b)), len(fps_a)
    order = n + np.argsort(table[0][n:], kind="stable")
    ranked = table[0][order].astype(np.int64)
    low = np.searchsorted(ranked, table[0][:n].astype(np.int64) - radius, "left")
    high = np.searchsorted(ranked, table[0][:n].astype(np.int64) + radius, "right")
    for i in range(n):
        others = order[low[i]:high[i]]
        others = others[groups.top[others] != groups.top[i]]
        groups.merge(*survivors(fps, table, np.full(len(others), i), others, radius))
    return groups.top


FOUND = "room int, part long, member long, top long, run long, low int, high int, fps binary, members binary"


def _rooms(prints: DataFrame, radius: int) -> DataFrame:
    """(room, part, first, fp, member) of (fp, member): each fingerprint once for each choice of slices."""
    first = F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(references().view("int64")[0])))).cast("int")
    masks = F.posexplode(F.array(*[F.lit(m).cast("long") for m in slice_masks(radius)]))
    dealt = prints.select("fp", "member", first.alias("first"), masks.alias("room", "mask"))
    return dealt.select("room", F.col("fp").bitwiseAND(F.col("mask")).alias("part"), "first", "fp", "member")


def _met_inside(rooms: DataFrame, radius: int, run_rows: int) -> DataFrame:
    """Rows of links (member, top) of a run, and the runs of rooms that may go on in another."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        pivots = references()
        schema = pa.schema([
            ("room", pa.int32()), ("part", pa.int64()), ("member", pa.int64()), ("top", pa.int64()), ("run", pa.int64()),
            ("low", pa.int32()), ("high", pa.int32()), ("fps", pa.binary()), ("members", pa.binary()),
        ])

        def taken(room, part, first, fp, member, whole):
            """The links of complete stretches of rooms; `whole` if the stretch is one run to meet others."""
            starts = np.ones(len(room), bool)
            starts[1:] = (room[1:] != room[:-1]) | (part[1:] != part[:-1])
            top = link_inside(np.cumsum(starts), fp.view(np.uint64), distance_table(fp.view(np.uint64), pivots), radius)
            moved = top != np.arange(len(top))
            links = {"member": pa.array(member[moved]), "top": pa.array(member[top[moved]])}
            yield pa.RecordBatch.from_arrays(
                [links.get(f.name, pa.nulls(int(moved.sum()), f.type)) for f in schema], schema=schema
            )
            if whole:
                yield pa.RecordBatch.from_pylist([{
                    "room": int(room[0]), "part": int(part[0]), "run": int(fp[0]), "low": int(first[0]), "high": int(first[-1]),
                    "fps": fp.tobytes(), "members": member.tobytes(),
                }], schema=schema)

        # A partition's first room may have begun in another, as its last may go on there.
        held, going_on = None, True
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("room", "part", "first", "fp", "member")]
            held = columns if held is None else [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
            while len(held[0]):
                room, part = held[:2]
                ends = np.flatnonzero((room[1:] != room[:-1]) | (part[1:] != part[:-1])) + 1
                whole = going_on or not len(ends)
                if len(ends):
                    cut = int(ends[0] if going_on else ends[-1])
                elif len(room) >= run_rows:
                    cut = run_rows
                else:
                    break
                yield from taken(*(c[:cut] for c in held), whole)
                going_on = not len(ends)
                held = [c[cut:] for c in held]
        if held is not None and len(held[0]):
            yield from taken(*held, True)

    return rooms.mapInArrow(run, FOUND)


def _met_across(runs: DataFrame, radius: int) -> DataFrame:
    """(member, top) of links between two runs of a room.

    The pairs of runs are found by name, those whose first distances lie apart are discarded, and
    only then the runs themselves travel, dealt by pair.
    """
    key = ["room", "part"]
    a = runs.select(*key, F.col("run").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"))
    b = runs.select(*key, F.col("run").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    apart = F.greatest(F.col("low_b") - F.col("high_a"), F.col("low_a") - F.col("high_b")) > radius
    pairs = a.join(b, key).where((F.col("a") < F.col("b")) & ~apart).select(*key, "a", "b")
    left = runs.select(*key, F.col("run").alias("a"), F.col("fps").alias("fps_a"), F.col("members").alias("of_a"))
    right = runs.select(*key, F.col("run").alias("b"), F.col("fps").alias("fps_b"), F.col("members").alias("of_b"))
    met = pairs.join(left, [*key, "a"]).join(right, [*key, "b"]).select("fps_a", "of_a", "fps_b", "of_b")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        pivots = references()
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                fps = [np.frombuffer(row[c], np.uint64) for c in ("fps_a", "fps_b")]
                members = np.concatenate([np.frombuffer(row[c], np.int64) for c in ("of_a", "of_b")])
                top = link_across(*fps, pivots, radius)
                moved = top != np.arange(len(top))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(members[moved]), pa.array(members[top[moved]])], ["member", "top"]
                )

    return block_batches(met).mapInArrow(run, "member long, top long")


def _tied(marked: DataFrame, prints: DataFrame) -> DataFrame:
    """(member, top): the fingerprints of a repeated doc_id hold together."""
    several = marked.groupBy("doc_id").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least <> most")
    each = marked.join(several.select("doc_id"), "doc_id").join(prints, "fp").select("doc_id", "member")
    tops = each.groupBy("doc_id").agg(F.min("member").alias("top"))
    return each.join(tops, "doc_id").where("member <> top").select("member", "top")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS, run_rows: int = RUN_ROWS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document (doc_id, text)."""
    marked = stage_table(fingerprints(docs.where("doc_id IS NOT NULL"), size), "fingerprints")
    prints = stage_table(marked.groupBy("fp").agg(F.min("doc_id").cast("long").alias("member")), "distinct-fingerprints")
    # With the fingerprint in the key, even one room's rows go to as many partitions as they fill.
    rooms = _rooms(prints, radius)
    dealt = rooms.repartitionByRange("room", "part", "first", "fp").sortWithinPartitions("room", "part", "first", "fp")
    found = stage_table(_met_inside(dealt, radius, run_rows), "runs")
    runs = found.where("fps IS NOT NULL").select("room", "part", "run", "low", "high", "fps", "members")
    links = found.where("fps IS NULL").select("member", "top").unionByName(_met_across(runs, radius))
    links = links.unionByName(_tied(marked, prints))
    whole = connected_components(links.distinct(), "member", "top")
    named = prints.join(whole, F.col("member") == F.col("node"), "left")
    named = named.select(F.col("fp").alias("own"), F.coalesce("component", "member").alias("component_id"))
    return marked.join(named, F.col("fp") == F.col("own")).select(
        "doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op12_simhash": op12_simhash}
ORACLES: dict[str, str] = {}
