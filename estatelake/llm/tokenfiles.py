"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are replaced by their rank by corpus frequency (ties: smaller id first), so that frequent ones
fit one byte. Four ids share a control byte with two bits each for their lengths (1 to 4 bytes);
data bytes stand apart from control bytes, and numpy decodes a block by table lookup.

A file holds rows that are blocks of whole documents: shard, block, doc_ids, named (a bit for each document, 0 where
its doc_id is null), lengths, n_ids, control, data. Shards are ranges of doc_id in ascending order, nulls first. Beside the
blocks lies the rank table (one row for each id of the vocabulary).

Steps: tokenise once into a staged table; count ids in each task, then sum by id; one range shuffle
by doc_id; encode and write the shards. What is gathered on the driver is bounded by the
vocabulary (the rank table) and by the number of shards (their sizes).

Defined cases: null counts as empty, and an empty text is one end id; null doc_ids stay null and come first; repeated doc_ids
and rows stay as they are, by a hash of their ids among themselves, and may be dealt out over several shards, so that one id
with a third of all rows is no single task; a document of any length is one block; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from estatelake.llm.common import Remembered, drop_staged, lean, slices, stage_path, staged

# -- ids of texts ---------------------------------------------------------------------------------


#: Character classes of the byte-level pre-tokeniser.
LETTER, DIGIT, OTHER, SPACE, WHITE, END, RARE = range(7)
MARKS = "–—‘’“”…«»¿¡"


def _class_table() -> np.ndarray:
    """Class by code point below 0x2100; what is not listed is RARE. 0 ends a text."""
    table = np.full(0x2101, RARE, np.uint8)
    table[32:127] = OTHER
    table[[9, 10, 13]] = WHITE
    table[0] = END
    table[32] = SPACE
    table[48:58] = DIGIT
    for low, high in (("A", "Z"), ("a", "z"), ("À", "Ö"), ("Ø", "ö"), ("ø", "ɏ")):
        table[ord(low) : ord(high) + 1] = LETTER
    table[[ord(c) for c in MARKS]] = OTHER
    return table


CLASSES = _class_table()


def cut_words(points: np.ndarray) -> np.ndarray:
    """Places where pre-tokens start, in texts of usual characters that are each followed by 0.

    As the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` cuts:
    runs of one class, with the last space of a white run joined to what follows.
    """
    kind = CLASSES[points]
    white = (kind == SPACE) | (kind == WHITE)
    run = np.where(white, SPACE, kind)
    starts = np.ones(len(points), bool)
    starts[1:] = (run[1:] != run[:-1]) | (kind[1:] == END)
    solid = ~white & (kind != END)
    # the last of a white run before something solid stands alone or with it
    last = np.zeros(len(points), bool)
    last[:-1] = white[:-1] & solid[1:]
    starts |= last
    attached = np.zeros(len(points), bool)
    attached[1:] = solid[1:] & (kind[:-1] == SPACE)
    starts &= ~attached
    # an apostrophe that starts a pre-token takes s, t, m, d, re, ve or ll along
    p = np.flatnonzero((points == 39) & starts)
    p = p[kind[np.minimum(p + 1, len(points) - 1)] == LETTER]
    if len(p):
        one, two = points[p + 1], points[np.minimum(p + 2, len(points) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l")))
        for which, n in ((short, 1), (long, 2)):
            q = p[which]
            starts[q + 1] = False
            after = q + 1 + n
            starts[after] |= kind[after] == LETTER
    return np.flatnonzero(starts)


class ByteLevelEncoder:
    """Whole texts to ids by the tokenizers library, which is asked once for each distinct pre-token.

    Texts of the usual characters are cut by the byte-level pre-tokeniser's own pattern, many at a time; the
    library encodes each pre-token on its own anyway, so that a bounded table can remember them. Other texts,
    and those that hold an added token, go to the library whole.
    """

    REMEMBERED = 300_000

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer") and not spec["model"].get("ignore_merges")
        added = [re.escape(t["content"]) for t in spec.get("added_tokens") or []]
        usual = f"[^\\t\\n\\r -~À-ÖØ-öø-ɏ{MARKS}]" + "".join(f"|{a}" for a in added)
        self.unusual = re.compile(usual if plain else "").search
        self.known = Remembered(self.REMEMBERED)

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct pre-tokens."""
        found = list(map(self.known.get, words))
        for i, x in enumerate(found):
            if x is None:
                found[i] = self.known.older(words[i])
        new = [i for i, x in enumerate(found) if x is None]
        self.known.make_room()
        for i, e in zip(new, self.library.encode_batch_fast([words[i] for i in new], add_special_tokens=False), strict=True):
            found[i] = self._bytes(e.ids)
            if len(words[i]) <= 40:
                self.known[words[i]] = found[i]
        return found

    def _encode_usual(self, texts: list[str]) -> list[np.ndarray]:
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = cut_words(points)
        ends = np.flatnonzero(points[starts] == 0)  # the word that ends each text
        width = 1 + (points >= 0x80).astype(np.int32) + (points >= 0x800)
        before = np.zeros(len(points) + 1, np.int32)
        np.cumsum(width, out=before[1:])
        offsets = before[np.append(starts, len(points))]
        words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined.encode("utf-8"))]).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        index = words.indices.to_numpy()
        ids = self._ids_of([w if w != "\0" else "" for w in distinct])
        flat = np.frombuffer(b"".join(ids), np.uint32)
        length = np.array([len(x) // 4 for x in ids], np.int64)
        first = np.cumsum(length) - length
        n = length[index]
        upto = np.cumsum(n)
        out = flat[np.arange(int(upto[-1])) + np.repeat(first[index] - (upto - n), n)]
        return np.split(out, upto[ends][:-1])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        usual = []
        for i, text in enumerate(texts):
            if self.unusual(text):
                out[i] = np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                usual.append(i)
        if usual:
            for i, ids in zip(usual, self._encode_usual([texts[i] for i in usual]), strict=True):
                out[i] = ids
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteLevelEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
    return ByteLevelEncoder(path)


def _tokenise(path: str, end_id: int, width: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], width).tobytes()
        for whole in batches:
            for batch in slices(whole, "text", 6 << 20):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                ids = encoder(path).encode(texts)
                # the cutting into pre-tokens is ours: the first text of each slice is held against the library's
                if ids[0].tolist() != encoder(path).library.encode(texts[0], add_special_tokens=False).ids:
                    raise ValueError("ids of a text differ from the library's")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.astype(width).tobytes() + end for x in ids], pa.binary())], names=["doc_id", "ids"])

    return task


def _count(n: int, width: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for batch in batches:
            for x in batch.column("ids"):
                total += np.bincount(np.frombuffer(x.as_buffer(), width), minlength=n)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    return task


# -- the coding -----------------------------------------------------------------------------------

#: By control byte: the lengths of its four ids.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.int64)
#: By length less one: which of four bytes count.
KEEP = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit numbers."""
    r = np.ascontiguousarray(ranks, dtype="<u4")
    code = (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    data = r.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    four = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    four[: len(r)] = code
    four = four.reshape(-1, 4)
    return (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n numbers that pack() took."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(lengths) - lengths
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    four = padded[starts[:, None] + np.arange(4)]
    return np.ascontiguousarray(four).view("<u4").reshape(-1) & KEEP[lengths - 1]


BLOCK_IDS = 1 << 20
BLOCKS = "shard int, block int, start long, doc_ids binary, named binary, lengths binary, n_ids long, control binary, data binary"


def _write_blocks(rank: np.ndarray, width: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        held: list[np.ndarray] = []
        waiting = 0

        def flush() -> pa.RecordBatch:
            control, data = pack(rank[np.concatenate(held)])
            named = np.packbits([d is not None for d in docs]).tobytes()
            columns = [shard], [block], [start], [np.array([d or 0 for d in docs], "<i8").tobytes()], [named], [np.array([len(x) for x in held], "<i8").tobytes()], [waiting], [control], [data]
            kinds = pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in BLOCKS.split(", ")])

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                x = np.frombuffer(ids.as_py(), width)
                docs.append(doc)
                held.append(x)
                waiting += len(x)
                if waiting >= BLOCK_IDS:
                    yield flush()
                    block, start, docs, held, waiting = block + 1, start + waiting, [], [], 0
        if docs:
            yield flush()

    return task


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Tokenise all texts and write the files below ``path``: ``blocks`` and ``ranks``. Returns path."""
    spark = docs.sparkSession
    n = max(encoder(tokenizer_path).library.get_vocab_size(with_added_tokens=True), end_id + 1)
    width = np.uint16 if n <= 1 << 16 else np.uint32
    made = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(lean(_tokenise(tokenizer_path, end_id, width)), "doc_id long, ids binary")
    # the number of a row is stored with it: equal rows of a hot id can then lie in different ranges
    tokens = staged(made.withColumns({"digest": F.xxhash64("ids"), "row": F.monotonically_increasing_id()}), "tokens")
    counts = tokens.select("ids").mapInArrow(lean(_count(n, width)), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    seen = {r.id: r.n for r in counts.collect()}  # at most the vocabulary
    order = sorted(range(n), key=lambda i: (-seen.get(i, 0), i))
    rank = np.empty(n, np.uint32)
    rank[order] = np.arange(n, dtype=np.uint32)
    spark.createDataFrame([(i, int(rank[i]), seen.get(i, 0)) for i in range(n)], "id int, rank int, n long").coalesce(1).write.parquet(f"{path}/ranks")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = "doc_id", "digest", "row"
    (tokens.repartitionByRange(shards, *place).sortWithinPartitions(*place).select("doc_id", "ids")
     .mapInArrow(lean(_write_blocks(rank, width)), BLOCKS)
     .write.option("compression", "zstd").parquet(f"{path}/blocks"))
    drop_staged(tokens)
    return path


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _read_blocks(ids_by_rank: np.ndarray, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                ids = ids_by_rank[unpack(b["control"], b["data"], b["n_ids"])].astype("<u4")
                lengths = np.frombuffer(b["lengths"], "<i8")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crc = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                unnamed = np.unpackbits(np.frombuffer(b["named"], np.uint8), count=len(lengths)) == 0
                columns = [pa.array(np.frombuffer(b["doc_ids"], "<i8"), pa.int64(), mask=unnamed), pa.array(starts + b["first"] + b["start"], pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([ids[s:e].tolist() for s, e in zip(starts, ends, strict=True)], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return task


def read_token_files(spark, path: str, with_ids: bool = False) -> DataFrame:
    """One row for each document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    ids = [r.id for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").collect()]
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # a row for each shard
    first = sizes.select("shard", F.coalesce(F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    schema = READ + (", ids array<long>" if with_ids else "")
    return blocks.join(F.broadcast(first), "shard").mapInArrow(lean(_read_blocks(np.array(ids, np.uint32), with_ids)), schema)


def token_files_report(docs: DataFrame, tokenizer_path: str, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    path = write_token_files(docs, tokenizer_path, stage_path(docs.sparkSession, "token-files"), end_id)
    return read_token_files(docs.sparkSession, path, with_ids)
