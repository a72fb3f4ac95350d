"""SentencePiece encoding by a relational lattice, and decoding.

A piece never spans a pair of characters that no piece holds side by side, so a text falls
into independent words at such pairs, and each distinct word is segmented once for the whole
corpus: its substrings of bounded length are exploded and equi-joined with the piece table,
the edges are grouped by word, and a Spark higher-order `aggregate` folds Viterbi over them.
A second fold walks the best path back.

A word of more than `LONG` characters is first cut into blocks of positions, each with the
characters before it that a piece can reach. The lattice rows of a block carry a digest in
place of the word and are spread over all tasks; the blocks then pass in order by a fold that
holds the costs of the last positions and, for each character, the step back.

Texts travel as packed chunks: a chunk holds its documents as streams of word numbers. Its words
travel apart, packed by buckets of their crc32: a bucket gives the distinct words to the lattice,
meets their segmentations, and packs those for each chunk, which a last co-grouping brings to it.
Nothing but the piece table, whose size the model fixes, is broadcast.

The segmentation is the exact best one under the table's scores (equal ones go to the longer
last piece); characters without a piece become their UTF-8 bytes, or the unknown piece if
the model has no byte pieces. Costs are integers, so no result depends on rounding.

Defined results: as in SentencePiece itself a text gets a space in front, spaces are the
character U+2581, and decoding turns both back; other white space is kept as it is; a null
or empty text has no pieces and decodes to an empty text; repeated rows are all kept; an
empty table gives no rows; columns beside id and text are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchgrid.llm.common import block_batches, stage_table, table

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Positions of a word that one inner fold covers; longer words are folded block by block.
BLOCK = 64
#: Characters of the longest word whose lattice rows carry the word itself.
LONG = 256
LEN_BITS, COST_BITS, ID_BITS = 5, 30, 21
UNREACHED = 1 << 60
UNKNOWN_PENALTY = 10
#: Characters of text in one packed chunk.
CHUNK_CHARS = 4 << 20
#: Words of texts that are turned into ids at a time.
SLICE_WORDS = 200_000
WORD = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
#: Buckets of words, at least; there are more where each would stand for more bytes of text than this.
BUCKETS, BUCKET_BYTES = 256, 1 << 28
PACKED = "chunk long, bucket int, blob binary"


class PieceTable:
    """The pieces of a model with integer costs, and what encoding needs to know of them."""

    def __init__(self, pieces: list[tuple[str, int, float]], byte_ids: dict[int, int], unknown: int, size: int):
        """pieces: (text, id, score) of the ordinary pieces; byte_ids: id of each byte piece."""
        scores = [s for _, _, s in pieces] or [0.0]
        scale = 1 if all(s == int(s) for s in scores) else 1000
        top = max(scores)
        self.costs = [(p, i, round((top - s) * scale)) for p, i, s in pieces]
        self.unknown_cost = round((top - min(scores) + UNKNOWN_PENALTY) * scale)
        self.longest = max((len(p) for p, _, _ in pieces), default=1)
        if self.unknown_cost >= 1 << COST_BITS or self.longest >= 1 << LEN_BITS or size + 0x110000 >= 1 << ID_BITS:
            raise ValueError("the model's scores, piece lengths or vocabulary exceed the packed edge format")
        self.byte_ids, self.unknown, self.size = byte_ids, unknown, size
        self.text = {i: p for p, i, _ in pieces}
        self.pairs = {p[j:j + 2] for p, _, _ in pieces for j in range(len(p) - 1)}

    @classmethod
    def load(cls, path: str = MODEL_PATH) -> PieceTable:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i) for i in range(size)]
        pieces = [(sp.id_to_piece(i), i, sp.get_score(i)) for i in range(size) if not special[i]]
        byte_ids = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        return cls(pieces, byte_ids, sp.unk_id(), size)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.costs, "piece string, id int, cost long")

    def words_of(self, chunk: str) -> list[str]:
        """The independent words of a run of characters without a space or line break inside."""
        out, start, pairs = [], 0, self.pairs
        for i in range(1, len(chunk)):
            if chunk[i - 1:i + 1] not in pairs:
                out.append(chunk[start:i])
                start = i
        out.append(chunk[start:])
        return out

    def ids_of_unknown(self, code: int) -> list[int]:
        """A character without a piece, given as vocabulary size + code point."""
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in chr(code - self.size).encode("utf-8", "replace")]


def _planes(numbers) -> bytes:
    """32-bit numbers, their lowest bytes first, then the next: so they compress better."""
    import numpy as np

    return np.ascontiguousarray(np.asarray(numbers, "<i4").view("u1").reshape(-1, 4).T).tobytes()


def _numbers(planes: bytes):
    import numpy as np

    return np.ascontiguousarray(np.frombuffer(planes, "u1").reshape(4, -1).T).view("<i4").ravel()


def _boxed(*columns, text: bytes = b"") -> bytes:
    """Columns of 32-bit numbers and a text as one compressed value."""
    import numpy as np
    import zstandard

    head = np.array([len(c) for c in columns], "<i4").tobytes()
    return zstandard.ZstdCompressor(3).compress(b"".join([head, *map(_planes, columns), text]))


def _unboxed(blob: bytes, n: int) -> list:
    """The n columns and the text of `_boxed`."""
    import numpy as np
    import zstandard

    raw, out, at = zstandard.ZstdDecompressor().decompress(blob), [], 4 * n
    for size in np.frombuffer(raw, "<i4", n).tolist():
        out.append(_numbers(raw[at:at + 4 * size]))
        at += 4 * size
    return [*out, raw[at:]]


def _cut(text: bytes, lengths) -> list[bytes]:
    """The words of a text, by their lengths in bytes."""
    ends = lengths.cumsum().tolist()
    return [text[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def pack(docs: DataFrame, pieces: PieceTable, chunk_chars: int = CHUNK_CHARS, buckets: int = BUCKETS) -> DataFrame:
    """Documents (doc_id, text) -> packed chunks: one row (bucket -1) and one for each bucket of its distinct words.

    A chunk's number is a hash of its contents, its words, and its place (partition and ordinal):
    equal chunks stay apart, a task that runs again gives the same, and where the rows of a
    partition are not repeatable the words do not find the chunk, which is an error.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        from zlib import crc32

        import numpy as np
        import pyarrow as pa
        import xxhash
        import zstandard
        from pyspark import TaskContext

        table = shared.value
        partition, ordinal = TaskContext.get().partitionId(), 0
        whole: dict[str, int] = {}
        parts: list[list[int]] = []
        words: dict[str, int] = {}
        streams, ids, chars, id_type = [], [], 0, None

        def emit():
            lengths = np.array([len(s) for s in streams], "<i4")
            streamed = np.concatenate([np.empty(0, "<i4"), *streams])
            flat = np.array([w for p in parts for w in p], "<i4")
            sizes = np.array([len(p) for p in parts], "<i4")
            named = {"lengths": lengths, "stream": streamed, "sizes": sizes, "parts": flat}
            own = {"doc_id": pa.array([ids], pa.list_(id_type))} | {n: pa.array([_planes(v)], pa.binary()) for n, v in named.items()}
            one, sink = pa.table(own), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, one.schema) as writer:
                writer.write_table(one)
            raw = sink.getvalue().to_pybytes()
            names = list(words)
            key = xxhash.xxh64(raw)
            key.update("\0".join(names).encode())
            key.update(f"\0{partition} {ordinal}")
            chunk = key.intdigest() - (1 << 63)
            boxes = {-1: zstandard.ZstdCompressor(3).compress(raw)}
            coded = [w.encode() for w in names]
            bucket = np.array([crc32(w) % buckets for w in coded], dtype=np.int64)
            order, count = np.argsort(bucket, kind="stable"), np.bincount(bucket, minlength=buckets)
            ends = np.cumsum(count)
            for b in np.flatnonzero(count).tolist():
                own = order[ends[b] - count[b]:ends[b]]
                text = [coded[i] for i in own.tolist()]
                boxes[b] = _boxed(np.diff(own, prepend=0), [len(w) for w in text], text=b"".join(text))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(boxes), chunk)), pa.array(list(boxes), pa.int32()), pa.array(list(boxes.values()), pa.binary()),
            ], ["chunk", "bucket", "blob"])

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []
                stream = []
                for w in found:
                    n = whole.get(w)
                    if n is None:
                        n = whole[w] = len(parts)
                        parts.append([words.setdefault(u, len(words)) for u in table.words_of(w)])
                    stream.append(n)
                streams.append(np.array(stream, "<i4"))
                ids.append(doc_id)
                chars += len(text or "")
                if chars >= chunk_chars:
                    yield from emit()
                    whole, parts, words, streams, ids, chars = {}, [], {}, [], [], 0
                    ordinal += 1
        if ids:
            yield from emit()

    return docs.select("doc_id", "text").mapInArrow(run, PACKED)


def _edges(cut: DataFrame, pieces: PieceTable) -> tuple[DataFrame, Column]:
    """The rows (end, len, part) of `cut` whose part is a piece or one character, and their packed edge."""
    met = cut.join(F.broadcast(pieces.frame(cut.sparkSession)), F.col("part") == F.col("piece"), "left")
    met = met.where(F.col("id").isNotNull() | (F.col("len") == 1))
    number = F.coalesce(F.col("id"), F.ascii("part") + pieces.size).cast("long")
    cost = F.coalesce("cost", F.lit(pieces.unknown_cost)).cast("long")
    place = ((F.col("end") - 1) % BLOCK).cast("long")
    edge = F.shiftleft(place, LEN_BITS + COST_BITS + ID_BITS)
    return met, edge + F.shiftleft(F.col("len").cast("long"), COST_BITS + ID_BITS) + F.shiftleft(cost, ID_BITS) + number


def lattice(words: DataFrame, pieces: PieceTable) -> DataFrame:
    """(word, edges) of distinct words (word): its edges, packed and sorted, in blocks of positions.

    An edge holds its end inside the block, its length, its cost and its piece id.
    """
    ends = words.select("word", F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("end"))
    spans = ends.select("word", "end", F.explode(F.sequence(F.lit(1), F.least(F.col("end"), F.lit(pieces.longest)))).alias("len"))
    cut = spans.select("word", "end", "len", F.substring("word", F.col("end") - F.col("len") + 1, F.col("len")).alias("part"))
    met, edge = _edges(cut, pieces)
    block = ((F.col("end") - 1) / BLOCK).cast("int")
    inner = met.select("word", block.alias("block"), edge.alias("edge")).groupBy("word", "block").agg(
        F.sort_array(F.collect_list("edge")).alias("edges")
    )
    return inner.groupBy("word").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("block", "edges"))), lambda b: b["edges"]).alias("blocks")
    )


def _digest(word: Column) -> Column:
    """Never null, so that a join on it puts no filter below the shuffle of the words."""
    return F.coalesce(F.sha2(word.cast("binary"), 256), F.lit(""))


def long_edges(words: DataFrame, pieces: PieceTable) -> DataFrame:
    """(digest, block, edges) of long distinct words (word): the lattice's edges, block by block."""
    # A list of blocks, as reaching far into a string is not free.
    blocks = F.regexp_extract_all("word", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def reach(own: Column, i: Column) -> Column:
        before = F.when(i > 0, F.right(F.get(blocks_here, i - 1), F.lit(pieces.longest - 1))).otherwise("")
        return F.struct(before.alias("before"), own.alias("own"))

    blocks_here = F.col("blocks")
    listed = words.select(_digest(F.col("word")).alias("digest"), blocks.alias("blocks"))
    taken = listed.select("digest", F.posexplode(F.transform("blocks", reach)).alias("block", "b")).repartition("digest", "block")
    ends = taken.select(
        "digest", "block", F.concat("b.before", "b.own").alias("text"), F.char_length("b.before").alias("lead"),
        F.explode(F.sequence(F.lit(1), F.char_length("b.own"))).alias("end"),
    )
    # Only the first block has nothing before it, so `most` is cut short there alone.
    most = F.least(F.col("end") + F.col("lead"), F.lit(pieces.longest))
    spans = ends.select("digest", "block", "text", "lead", "end", F.explode(F.sequence(F.lit(1), most)).alias("len"))
    part = F.substring("text", F.col("lead") + F.col("end") - F.col("len") + 1, F.col("len"))
    met, edge = _edges(spans.select("digest", "block", "end", "len", part.alias("part")), pieces)
    return met.select("digest", "block", edge.alias("edge")).groupBy("digest", "block").agg(
        F.sort_array(F.collect_list("edge")).alias("edges")
    )


def long_segmented(words: DataFrame, pieces: PieceTable) -> DataFrame:
    """(word, ids) of long distinct words (word): the same best path, folded as the blocks come in order."""
    longest = pieces.longest
    words = words.select("word").repartition("word")

    def run(batches):
        from array import array

        import numpy as np
        import pyarrow as pa

        def walked(back, piece):
            out, at = array("i"), len(back) - 1
            while at >= 0:
                out.append(piece[at])
                at -= back[at]
            return np.array(out, "<i4")[::-1]

        def row(digest, back, piece):
            ids = walked(back, piece)
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids, pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array([digest], pa.string()), lists], ["digest", "ids"])

        now, costs, back, piece = None, [], array("b"), array("i")
        low, high = (1 << ID_BITS) - 1, (1 << COST_BITS) - 1
        for batch in batches:
            for digest, edges in zip(batch.column("digest").to_pylist(), batch.column("edges"), strict=True):
                if digest != now:
                    if now is not None:
                        yield row(now, back, piece)
                    now, costs, back, piece = digest, [UNREACHED] * (longest - 1) + [0], array("b"), array("i")
                packed = edges.values.to_numpy()
                columns = (packed >> s & m for s, m in (
                    (LEN_BITS + COST_BITS + ID_BITS, BLOCK - 1), (COST_BITS + ID_BITS, (1 << LEN_BITS) - 1), (ID_BITS, high), (0, low)))
                place, best = 0, None
                # Edges come by place, then length; of equal costs the longer piece stays.
                for where, length, cost, number in zip(*(c.tolist() for c in columns), strict=True):
                    if where != place:
                        costs.append(best[0])
                        back.append(best[1])
                        piece.append(best[2])
                        place, best = where, None
                    reached = costs[-length] + cost
                    if best is None or reached <= best[0]:
                        best = reached, length, number
                costs.append(best[0])
                back.append(best[1])
                piece.append(best[2])
                del costs[:-longest]
        if now is not None:
            yield row(now, back, piece)

    blocks = long_edges(words, pieces).repartition("digest").sortWithinPartitions("digest", "block")
    solved = blocks.select("digest", "edges").mapInArrow(run, "digest string, ids array<int>")
    named = words.select("word", _digest(F.col("word")).alias("of"))
    return named.join(solved.hint("shuffle_merge"), F.col("of") == F.col("digest")).select("word", "ids")


def _bits(edge: Column, shift: int, bits: int) -> Column:
    return F.shiftright(edge, shift).bitwiseAND(F.lit((1 << bits) - 1))


def best_path(blocks: Column, longest: int) -> Column:
    """Viterbi over a word's edges: the ids of the best segmentation, in order.

    The fold keeps, for each position, the edge that reaches it best with the cost so far; a
    block starts with the last `longest` positions of the one before. A second fold walks
    the kept edges back from the end. What a step makes is asked for once, as steps nest.
    """
    taken_type = "array<struct<cost: bigint, back: int, id: int>>"
    seed = F.array(*[
        F.struct(F.lit(UNREACHED if i else 0).cast("long").alias("cost"), F.lit(0).alias("back"), F.lit(0).alias("id"))
        for i in range(longest - 1, -1, -1)
    ]).cast(taken_type)

    def place(edge: Column) -> Column:
        return F.shiftright(edge, LEN_BITS + COST_BITS + ID_BITS)

    def arrive(taken: Column, edges: Column) -> Column:
        def arrival(edge: Column) -> Column:
            length = _bits(edge, COST_BITS + ID_BITS, LEN_BITS).cast("int")
            return F.struct(
                (F.element_at(taken, -length)["cost"] + _bits(edge, ID_BITS, COST_BITS)).alias("cost"),
                (-length).alias("back"), _bits(edge, 0, ID_BITS).cast("int").alias("id"),
            )

        return F.concat(taken, F.array(F.array_min(F.transform(edges, arrival))))

    def fold_block(done: Column, edges: Column) -> Column:
        last = place(F.element_at(edges, -1))
        ends = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda p: F.filter(edges, lambda e: place(e) == p))
        own = F.aggregate(ends, F.element_at(done, -1)["tail"], arrive, lambda taken: F.struct(
            F.slice(taken, -longest, longest).alias("tail"), F.slice(taken, longest + 1, F.size(taken)).alias("taken")
        ))
        return F.concat(done, F.array(own))

    begin = F.array(F.struct(seed.alias("tail"), F.array().cast(taken_type).alias("taken")))
    folded = F.aggregate(blocks, begin, fold_block)

    def step(state: Column, edge: Column) -> Column:
        here = state["skip"] == 0
        return F.struct(
            F.when(here, -edge["back"] - 1).otherwise(state["skip"] - 1).alias("skip"),
            F.when(here, F.concat(state["ids"], F.array(edge["id"]))).otherwise(state["ids"]).alias("ids"),
        )

    def walk(done: Column, block: Column) -> Column:
        start = F.struct(F.element_at(done, -1)["skip"].alias("skip"), F.array().cast("array<int>").alias("ids"))
        return F.concat(done, F.array(F.aggregate(F.reverse(block["taken"]), start, step)))

    first = F.array(F.struct(F.lit(0).alias("skip"), F.array().cast("array<int>").alias("ids")))
    walked = F.aggregate(F.reverse(folded), first, walk)
    return F.reverse(F.flatten(F.transform(walked, lambda w: w["ids"])))


def segmented(words: DataFrame, pieces: PieceTable) -> DataFrame:
    """(word, ids) of distinct words (word), with n_chars if it is known."""
    if "n_chars" not in words.columns:
        words = words.select("word", F.char_length("word").alias("n_chars"))
    is_long = F.col("n_chars") > LONG
    short = lattice(words.where(~is_long), pieces).select("word", best_path(F.col("blocks"), pieces.longest).alias("ids"))
    return short.unionByName(long_segmented(words.where(is_long), pieces))


def encode(docs: DataFrame, pieces: PieceTable, chunk_chars: int = CHUNK_CHARS, staged: bool = False) -> DataFrame:
    """(doc_id, ids) of documents (doc_id, text).

    The packed chunks are read twice. With `staged` they are packed once, into a written table,
    which costs disk; otherwise they are packed for each reading, which costs time and memory.
    """
    spark = docs.sparkSession
    # Words come one after another, so the edges of many words fit into a hash map.
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "300000")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(BUCKETS, size // BUCKET_BYTES)
    packed = pack(docs, pieces, chunk_chars, buckets)
    if staged:
        packed = block_batches(stage_table(packed, "chunks"))
    # Shuffles of their own, so that partitions count alike here and below.
    blobs = packed.where("bucket < 0").select("chunk", "blob").repartition("chunk")
    wanted = packed.where("bucket >= 0").repartition("bucket")

    def distinct(boxes):
        import pyarrow as pa

        words = {}
        for blob in boxes.column("blob").to_pylist():
            _, lengths, text = _unboxed(blob, 2)
            words.update(dict.fromkeys(_cut(text, lengths)))
        return pa.table({"word": pa.array([w.decode() for w in words], pa.string())})

    words = wanted.groupBy("bucket").applyInArrow(distinct, "word string")
    # No filter on this column can pass below its shuffle, so that short and long words share it.
    words = words.groupBy("word").agg(F.max(F.char_length("word")).alias("n_chars"))
    bucket = F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(buckets)).cast("int")
    solved = segmented(words, pieces).select(bucket.alias("bucket"), "word", "ids")

    def answer(boxes, found):
        import numpy as np
        import pyarrow as pa

        index = {w.encode(): i for i, w in enumerate(found.column("word").to_pylist())}
        lists = found.column("ids").combine_chunks()
        flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
        offsets = offsets - (offsets[0] if len(offsets) else 0)
        out = []
        for blob in boxes.column("blob").to_pylist():
            steps, lengths, text = _unboxed(blob, 2)
            own = np.array([index[w] for w in _cut(text, lengths)], dtype=np.int64)
            ids, count = _taken(flat, offsets[:-1][own], np.diff(offsets)[own])
            out.append(_boxed(steps, count, ids))
        return pa.table({"of": boxes.column("chunk"), "blob": pa.array(out, pa.binary())})

    answers = wanted.groupBy("bucket").cogroup(solved.groupBy("bucket")).applyInArrow(answer, "of long, blob binary")
    shared = spark.sparkContext.broadcast(pieces)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def assemble(blob, found):
        import numpy as np
        import pyarrow as pa
        import zstandard

        if blob.num_rows == 0:
            raise ValueError("a chunk's words came without the chunk")
        if blob.num_rows > 1:
            raise ValueError("two chunks have the same number")
        table = shared.value
        raw = zstandard.ZstdDecompressor().decompress(blob.column("blob")[0].as_py())
        one = pa.ipc.open_stream(raw).read_all()
        lengths, stream, sizes, parts = (_numbers(one.column(c)[0].as_py()) for c in ("lengths", "stream", "sizes", "parts"))
        told = [_unboxed(x, 3) for x in found.column("blob").to_pylist()]
        none = np.empty(0, "<i4")
        number = np.concatenate([none, *[steps.cumsum() for steps, *_ in told]])
        count, flat = (np.concatenate([none, *[x[c] for x in told]]).astype(np.int64) for c in (1, 2))
        del told
        order = np.argsort(number, kind="stable")
        if len(order) != (int(parts.max()) + 1 if len(parts) else 0):
            raise ValueError("a chunk's words are not complete")
        flat, count = _taken(flat, (np.cumsum(count) - count)[order], count[order])
        if len(flat) and flat.max() >= table.size:
            flat, count = _spelled(flat, count, table)
        # Word ids -> ids of the runs between spaces, which are few.
        flat, count = _joined(flat.astype(np.int32), count, parts, sizes)
        # Runs -> texts, some texts at a time, so that only their ids are held twice.
        begin, ends = np.cumsum(count) - count, np.cumsum(lengths)
        lists, counts, at = [], [], 0
        while at < len(lengths):
            first = int(ends[at] - lengths[at])
            upto = max(at + 1, int(np.searchsorted(ends, first + SLICE_WORDS, "right")))
            ids, each = _joined(flat, count, stream[first:int(ends[upto - 1])], lengths[at:upto], begin)
            lists.append(ids)
            counts.append(each)
            at = upto
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists)))
        return pa.table({"doc_id": one.column("doc_id")[0].values, "ids": lists})

    return blobs.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(assemble, f"doc_id {kind}, ids array<int>")


def _taken(flat, begin, count):
    """The stretches (begin, count) of `flat`, laid end to end, with their counts."""
    import numpy as np

    at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    return flat[at], count


def _joined(flat, count, pick, size, begin=None):
    """Rows of `flat` (with their counts), picked and laid together by `size`: the ids, and how many each has."""
    import numpy as np

    begin = np.cumsum(count) - count if begin is None else begin
    ids, each = _taken(flat, begin[pick], count[pick])
    sums = np.concatenate([[0], np.cumsum(each)])
    ends = np.cumsum(size)
    return ids, sums[ends] - sums[ends - size]


def _spelled(flat, count, table: PieceTable):
    """Unknown characters replaced by their byte pieces."""
    import numpy as np

    lists = np.split(flat, np.cumsum(count)[:-1])
    done = [
        ids if not len(ids) or ids.max() < table.size
        else np.array([j for i in ids.tolist() for j in ([i] if i < table.size else table.ids_of_unknown(i))])
        for ids in lists
    ]
    return np.concatenate(done), np.array([len(d) for d in done])


def decode(tokens: DataFrame, pieces: PieceTable) -> DataFrame:
    """`tokens` (doc_id, ids) with `text`."""
    shared = tokens.sparkSession.sparkContext.broadcast(pieces)
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        table = shared.value
        text = {i: p.encode() for i, p in table.text.items()} | {i: bytes((b,)) for b, i in table.byte_ids.items()}
        unknown = " ⁇ ".encode()
        for batch in batches:
            out = []
            for ids in batch.column("ids").to_pylist():
                whole = b"".join([text.get(i, unknown) for i in ids or ()]).decode("utf-8", "replace").replace(SPACE, " ")
                out.append(whole[1:] if whole.startswith(" ") else whole)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(out, pa.string())], ["doc_id", "ids", "text"]
            )

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def encoded_and_decoded(
    docs: DataFrame, pieces: PieceTable, chunk_chars: int = CHUNK_CHARS, staged: bool = False
) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): the tokens, and the digest of what they decode to."""
    return decode(encode(docs, pieces, chunk_chars, staged), pieces).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_and_decoded(table(spark, sf_dir, "documents").select("doc_id", "text"), PieceTable.load())


QUERIES = {"op5_pieces": op5_pieces}
ORACLES: dict[str, str] = {}
