"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on good and one on bad labelled text. A text is
compressed in blocks with each; normalised differences of the sizes (bad against good dictionary,
and good dictionary against the plain size) go through a logistic calibration fitted on labelled
texts that the dictionaries have not seen. Language, source, id and labels are no inputs of a score.

Fitting takes a bounded sample: at most ``FIT_DOCS`` labelled ids of each label for the
dictionaries and as many for the calibration, chosen by a hash of the id, with texts of any length. All distinct
blocks of the first go into the dictionaries: where a label has more than ``GROUP_BLOCKS``, tasks train a dictionary for
each group of blocks, and the blocks of these dictionaries are what the next one is trained on, until one group is left.
Texts stay on the executors: the driver gets this last group (4 MB a label) and seven numbers for each calibration text.
Scoring reads every whole text, needs no shuffle and sends each task the two dictionaries and the
weights (under 0.3 MB).

Defined cases: null counts as empty, and an empty text gets a score like any other; labels that are
null, or no row of one of the labels, leave that side's sample empty, and with no sample at all
every score is 0.5; an id that is labelled both ways counts as bad, and of a sampled id that stands for several texts the one of
least hash is taken, so that fits are repeatable; ids that repeat are scored each; a document without an id is scored and is not held out; an empty table gives an empty result; extra
columns are ignored by ``score_quality`` and kept by ``keep_good``, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import drop_staged, lean, slices, staged

#: Labelled rows of each label at most, for the dictionaries and again for the calibration.
FIT_DOCS = 1500
#: Bytes of a block, blocks that are trained on at once, bytes of a dictionary, level of compression.
BLOCK, GROUP_BLOCKS, DICTIONARY, LEVEL = 1024, 4096, 112_640, 3
THRESHOLD = 0.3


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, mod 5; 0 is held out."""
    return F.crc32(id_col.cast("string")) % 5


def blocks(text: str) -> list[bytes]:
    data = text.encode("utf-8")
    return [data[i : i + BLOCK] for i in range(0, max(1, len(data)), BLOCK)]


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    weights: list[float]

    def __getstate__(self) -> tuple:
        return self.good, self.bad, self.weights

    def __setstate__(self, state: tuple) -> None:
        self.good, self.bad, self.weights = state

    def _compressor(self, dictionary: bytes):
        import zstandard

        d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)

    def features(self, texts: list[str]) -> np.ndarray:
        with_good, with_bad = (self._compressor(d).compress for d in (self.good, self.bad))
        rows = []
        for text in texts:
            parts = blocks(text)
            g = sum(len(with_good(p)) for p in parts)
            b = sum(len(with_bad(p)) for p in parts)
            n = sum(map(len, parts)) + 8 * len(parts)
            saved = (n - g) / n
            short = 100 / (100 + n)
            rows.append((1.0, 10 * (b - g) / (b + g), saved, saved * saved, 10 * (b - g) / n, short, short * saved))
        return np.array(rows).reshape(-1, 7)

    def score(self, texts: list[str]) -> np.ndarray:
        x = self.features(texts)
        z = x @ np.array(self.weights) if self.weights else np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _dictionary(parts: list[bytes]) -> bytes:
    """Trained on blocks in their order; too few for training give a raw one."""
    import zstandard

    try:
        return zstandard.train_dictionary(min(DICTIONARY, sum(map(len, parts)) // 8 + 256), parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY:]


def _group_dictionary(group: pa.Table) -> pa.Table:
    """The blocks of the dictionary of a group of blocks."""
    data = _dictionary(sorted(group.column("_block").to_pylist(), key=lambda b: (zlib.crc32(b), b)))
    return pa.table({"_block": pa.array([data[i : i + BLOCK] for i in range(0, len(data), BLOCK)], pa.binary())})


def train_dictionary(parts: DataFrame) -> bytes:
    """A dictionary from all rows of _block: of groups of them, then of what these dictionaries hold, down to one group. A group of
    half of GROUP_BLOCKS gives a dictionary of at most an eighth of its bytes, so that each round leaves far fewer blocks."""
    made = []
    while (n := parts.count()) > GROUP_BLOCKS:
        group = F.pmod(F.xxhash64("_block"), F.lit(-(-2 * n // GROUP_BLOCKS))).alias("_group")
        parts = staged(parts.groupBy(group).applyInArrow(_group_dictionary, "_block binary").distinct(), "fit-dictionaries")
        made.append(parts)
    last = [bytes(r[0]) for r in parts.orderBy(F.crc32("_block"), "_block").collect()]
    drop_staged(*made)
    return _dictionary(last)


def _calibrate(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Logistic regression by Newton's method with a small ridge."""
    w, ridge = np.zeros(x.shape[1]), 1e-3 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "_text"):
            cut = [[b for b in blocks(t) if b] for t in batch.column("_text").to_pylist()]
            label = np.repeat(batch.column("_label").to_numpy(), [len(c) for c in cut])
            yield pa.RecordBatch.from_arrays([pa.array(label), pa.array([b for c in cut for b in c], pa.binary())], names=["_label", "_block"])


def _feature_task(model: CompressionModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                x = model.features(batch.column("_text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_label"), pa.array(list(x), pa.list_(pa.float64()))], names=["_id", "_label", "_x"])

    return task


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> CompressionModel:
    """Fit on rows outside the held-out fold. One join of the sampled ids with the texts; the ids of the
    sample are bounded, so that they can be broadcast."""
    spark = docs.sparkSession
    order = F.xxhash64(F.col("_id").cast("string"), F.lit("fit"))
    known = labels.select(labels[id_col].alias("_id"), labels[label_col].cast("int").alias("_label")).where(F.col("_label").isin(0, 1) & (fold(F.col("_id")) != 0))
    usable = known.groupBy("_id").agg(F.min("_label").alias("_label"))
    picked = [[r[0] for r in usable.where(F.col("_label") == q).orderBy(order, "_id").limit(2 * FIT_DOCS).select("_id").collect()] for q in (0, 1)]
    rows = [(k, q, i % 2) for q, ids in enumerate(picked) for i, k in enumerate(ids)]
    if not rows:
        return CompressionModel(b"", b"", [])
    chosen = spark.createDataFrame(rows, f"_id {labels.schema[id_col].dataType.simpleString()}, _label int, _part int")
    text = F.coalesce(docs[text_col], F.lit(""))
    held = docs.select(docs[id_col].alias("_id"), text.alias("_text")).join(F.broadcast(chosen), "_id")
    one = held.groupBy("_id", "_label", "_part").agg(F.min(F.struct(F.xxhash64("_text"), "_text"))["_text"].alias("_text"))
    texts = staged(one, "fit-texts")
    cut = texts.where("_part = 0").select("_label", "_text").mapInArrow(lean(_cut_blocks), "_label int, _block binary").distinct()
    parts = staged(cut, "fit-blocks")
    model = CompressionModel(*(train_dictionary(parts.where(F.col("_label") == q).select("_block")) for q in (1, 0)), [])
    seen = texts.where("_part = 1").select(F.col("_id").cast("string").alias("_id"), "_label", "_text").mapInArrow(lean(_feature_task(model)), "_id string, _label int, _x array<double>")
    fitted = sorted(seen.collect())  # FIT_DOCS rows of each label at most
    drop_staged(texts, parts)
    if fitted:
        # each label counts as often as it is among the labelled rows
        y = np.array([float(r[1]) for r in fitted])
        counts = dict(usable.groupBy("_label").count().collect())
        model.weights = _calibrate(np.array([r[2] for r in fitted]), y)
        shift = np.log(max(counts.get(1, 0), 1) / max(counts.get(0, 0), 1)) - np.log(max(y.sum(), 1) / max((1 - y).sum(), 1))
        model.weights[0] += float(shift)
    return model


def _score_task(model: CompressionModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                score = model.score([t or "" for t in batch.column("_text").to_pylist()])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], names=[*batch.schema.names, "_score"])

    return task


def with_score(docs: DataFrame, model: CompressionModel, text_col: str = "text") -> DataFrame:
    """docs with columns _c0, _c1, ... (those of docs in order, the text as _text) and _score."""
    held = docs.select(*(docs[c].alias("_text" if c == text_col else f"_c{i}") for i, c in enumerate(docs.columns)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema) + ", _score double"
    return held.mapInArrow(lean(_score_task(model)), schema)


def score_quality(docs: DataFrame, model: CompressionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for each document."""
    scored = with_score(docs.select(docs[id_col], docs[text_col]), model, text_col)
    return scored.select(F.col("_c0").alias("doc_id"), F.coalesce(fold(F.col("_c0")) == 0, F.lit(False)).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: CompressionModel, text_col: str = "text") -> DataFrame:
    """The documents that the model does not reject, with their columns."""
    scored = with_score(docs, model, text_col).where(F.col("_score") >= THRESHOLD)
    return scored.select(*(F.col("_text" if c == text_col else f"_c{i}").alias(c) for i, c in enumerate(docs.columns)))
