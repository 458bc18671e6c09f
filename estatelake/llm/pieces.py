"""SentencePiece encoding for merge-type (BPE) vocabularies, and decoding.

Encoding is a score-ordered agenda: the adjacent symbol pairs that form a piece wait in a heap,
the best-scored one (leftmost among equals) is merged first, and its new neighbours join the
agenda. Before that a text is cut where no piece of the vocabulary can reach across, which is
read off the vocabulary itself; the agenda's result is the same with or without the cuts, and a
bounded table remembers the ids of short segments. The short segments of a slice of texts that the table does not have are worked off
together, an agenda for each as a row of arrays. Every ``check_every``-th text of each Arrow
batch is also encoded by the sentencepiece library, and any difference stops the job.

Defined cases: null counts as empty and gives the begin and end ids only; long runs without a cut
cost n log n; characters outside the vocabulary become byte pieces; repeated rows give repeated
results, an empty table an empty one; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from estatelake.llm.common import Remembered, lean, slices

SPACE = "▁"
LETTERS = "a-zA-ZÀ-ÖØ-öø-ɏ"
NEVER = float("inf")
LAST = np.iinfo(np.int32).max


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol-buffer message: (number, integer or bytes)."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + n]
            at += n


class PieceModel:
    """Vocabulary, agenda and segment table of one model file."""

    #: Segments up to so many characters are remembered, and so many of them.
    SHORT, REMEMBERED = 40, 120_000

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = {}
        for f, v in wire_fields(self.library.serialized_model_proto()):
            if f in (2, 3):
                spec[f] = dict(wire_fields(v))
        if spec[2].get(3, 1) != 2 or spec[3].get(2, b""):
            raise ValueError("a merge-type model without character normalisation is needed")
        self.prefix = bool(spec[3].get(3, 1))
        if spec[3].get(4, 1):
            raise ValueError("models that drop extra white space are not supported")
        lib, n = self.library, self.library.vocab_size()
        self.bos, self.eos, self.unk = lib.bos_id(), lib.eos_id(), lib.unk_id()
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        for i in range(n):
            if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i)):
                piece = lib.id_to_piece(i)
                self.ids[piece] = i
                self.score[piece] = -lib.get_score(i)
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if spec[2].get(35, 0) else None
        self.cut = re.compile(self._segments()).findall
        self.known = Remembered(self.REMEMBERED)
        self.found: dict[str, bytes] = {}
        self._pairs()

    def _pairs(self) -> None:
        """The vocabulary in numbers: a symbol is a piece or a character of one, by its place in a list; keys are pairs of symbols that form a piece."""
        symbols = [*self.ids, *sorted({c for piece in self.ids for c in piece} - self.ids.keys())]
        place = {s: i for i, s in enumerate(symbols)}
        plain = [c for c in map(chr, range(128)) if c not in place] if self.bytes else []  # one byte each, hence one id
        place |= {c: len(symbols) + i for i, c in enumerate(plain)}
        self.outside = len(place)  # stands for all other characters
        pairs = {place[a] * (self.outside + 1) + place[b]: place[p] for p in self.ids for i in range(1, len(p)) if (a := p[:i]) in place and (b := p[i:]) in place}
        self.keys = np.array(sorted(pairs), np.int64)
        self.formed = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        _, rank = np.unique([self.score[s] for s in self.ids], return_inverse=True)
        self.rank = rank.astype(np.int32)
        self.id_of = np.array([self.ids.get(s, self.bytes[ord(s)] if self.bytes and len(s) == 1 and s < "\x80" else -1) for s in place] + [-1], np.int64)
        self.symbol = np.full(0x110000, self.outside, np.int32)
        for s, i in place.items():
            if len(s) == 1:
                self.symbol[ord(s)] = i

    def _segments(self) -> str:
        """A pattern whose matches, one after another, are the segments of a text.

        A cut is safe between two characters that stand next to each other in no piece: before a
        space mark that follows another character, and between a Latin letter and those ASCII marks
        that follow a letter in no piece.
        """
        before: dict[str, set[str]] = {}
        for piece in self.ids:
            for a, b in zip(piece, piece[1:], strict=False):
                before.setdefault(b, set()).add(a)
        if before.get(SPACE, set()) - {SPACE}:
            return r"(?s:.+)"
        is_letter = re.compile(f"[{LETTERS}]").match
        marks = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and not any(map(is_letter, before.get(c, ()))))
        rest = f"[^{SPACE}{LETTERS}]*[{LETTERS}]*"
        return f"{SPACE}*{rest}(?:[^{SPACE}{LETTERS}{re.escape(marks)}]{rest})*"

    def agenda(self, text: str) -> list[int]:
        """Ids of a segment, by merging the best-scored adjacent pair until none is left."""
        symbols = self._short_agenda(text) if len(text) <= self.SHORT else self._long_agenda(text)
        out: list[int] = []
        for s in symbols:
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out.extend(self.bytes[b] for b in s.encode("utf-8"))
            else:
                out.append(self.unk)
        return out

    def _short_agenda(self, text: str) -> list[str]:
        """The agenda as a list of scores by place: for a few symbols its minimum is found faster than a heap is kept."""
        symbols, score = list(text), self.score.get
        waiting = [score(a + b, NEVER) for a, b in zip(text, text[1:], strict=False)]
        while waiting and (best := min(waiting)) < NEVER:
            i = waiting.index(best)
            piece = symbols[i] = symbols[i] + symbols.pop(i + 1)
            del waiting[i]
            if i < len(waiting):
                waiting[i] = score(piece + symbols[i + 1], NEVER)
            if i:
                waiting[i - 1] = score(symbols[i - 1] + piece, NEVER)
        return symbols

    def _long_agenda(self, text: str) -> list[str]:
        """The agenda as a heap; entries of merged symbols are left in it and skipped."""
        symbols: list[str] = list(text)
        n = len(symbols)
        score = self.score.get
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        waiting = []
        for i in range(n - 1):
            s = score(symbols[i] + symbols[i + 1])
            if s is not None:
                waiting.append((s, i, i + 1, symbols[i] + symbols[i + 1]))
        heapq.heapify(waiting)
        while waiting:
            _, i, j, piece = heapq.heappop(waiting)
            if not symbols[i] or not symbols[j] or right[i] != j or symbols[i] + symbols[j] != piece:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = piece, ""
            k = right[i] = right[j]
            if k >= 0:
                left[k] = i
                if (s := score(piece + symbols[k])) is not None:
                    heapq.heappush(waiting, (s, i, k, piece + symbols[k]))
            h = left[i]
            if h >= 0 and (s := score(symbols[h] + piece)) is not None:
                heapq.heappush(waiting, (s, h, i, symbols[h] + piece))
        return [s for s in symbols if s]

    def _form(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces that pairs of symbols form, and their ranks; LAST where there is none."""
        key = left.astype(np.int64) * (self.outside + 1) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        piece = self.formed[at]
        return piece, np.where(self.keys[at] == key, self.rank[piece], LAST)

    def agendas(self, texts: list[str]) -> list[bytes]:
        """Ids of many segments: each is a row of symbols and of what each forms with the next one; in every round each row merges its best-ranked pair,
        the leftmost among equals, until no row has one."""
        if not texts or not len(self.keys):
            return [array("I", self.agenda(t)).tobytes() for t in texts]
        size = np.array(list(map(len, texts)))
        n, width = len(texts), int(size.max())
        filled = np.arange(width) < size[:, None]
        symbol = np.full((n, width + 1), self.outside, np.int32)
        symbol[:, :width][filled] = self.symbol[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
        piece, rank = np.zeros((n, width), np.int32), np.full((n, width), LAST, np.int32)
        paired = np.arange(1, width + 1) < size[:, None]
        piece[paired], rank[paired] = self._form(symbol[:, :width][paired], symbol[:, 1:][paired])
        after = np.tile(np.arange(1, width + 1), (n, 1))  # the place of the next symbol; width: none
        before = np.tile(np.arange(-1, width), (n, 1))
        alive, rows = filled, np.arange(n)
        after[rows, size - 1] = width
        while True:
            at = rank[rows].argmin(axis=1) if len(rows) < n else rank.argmin(axis=1)
            more = rank[rows, at] < LAST
            rows, at = rows[more], at[more]
            if not len(rows):
                break
            gone = after[rows, at]
            symbol[rows, at] = piece[rows, at]
            alive[rows, gone], rank[rows, gone] = False, LAST
            follows = after[rows, at] = after[rows, gone]
            before[rows, follows] = at
            piece[rows, at], rank[rows, at] = self._form(symbol[rows, at], symbol[rows, follows])
            inner = before[rows, at] >= 0
            i, b, a = rows[inner], before[rows, at][inner], at[inner]
            piece[i, b], rank[i, b] = self._form(symbol[i, b], symbol[i, a])
        ids = self.id_of[symbol[:, :width]]
        ends = np.cumsum(alive.sum(axis=1)) * 4
        data = ids[alive].astype("<u4").tobytes()
        out = [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        for i in np.flatnonzero((alive & (ids < 0)).any(axis=1)).tolist():
            out[i] = array("I", self.agenda(texts[i])).tobytes()
        return out

    def learn(self, texts: list[str]) -> None:
        """Find the ids of all segments of texts, those that are not remembered in one go, for encode() to take."""
        known, found = self.known, {}
        known.make_room()
        asked, places = [], []
        for text in texts:
            marked = text.replace(" ", SPACE)
            if self.prefix and marked:
                marked = SPACE + marked
            parts = self.cut(marked)
            found[text] = ids = list(map(known.get, parts))
            if None in ids:
                at = [i for i, x in enumerate(ids) if x is None]
                asked += [parts[i] for i in at]
                places.append((ids, at))
        fill = {part: known.older(part) for part in asked} | {"": b""}
        new = [part for part, x in fill.items() if x is None]
        short = sorted((part for part in new if len(part) <= self.SHORT), key=len)
        for start in range(0, len(short), 2048):
            some = short[start : start + 2048]
            made = dict(zip(some, self.agendas(some), strict=True))
            fill |= made
            known.update(made)
        for part in new:
            if fill[part] is None:
                fill[part] = array("I", self.agenda(part)).tobytes()
        answers = map(fill.__getitem__, asked)
        for ids, at in places:
            for i, x in zip(at, answers):  # noqa: B905  answers go on with the next text
                ids[i] = x
        self.found = {text: b"".join(ids) for text, ids in found.items()}

    def encode(self, text: str) -> bytes:
        """Ids of a text with begin and end ids, as little-endian unsigned 32-bit integers."""
        if text not in self.found:
            self.learn([text])
        found = self.found[text]
        if not self.bytes and self.unk >= 0:
            return self._joined_unknown(found)
        return array("I", [self.bos]).tobytes() + found + array("I", [self.eos]).tobytes()

    def _joined_unknown(self, ids: bytes) -> bytes:
        """Without byte pieces the library gives one unknown id for neighbouring unknown characters."""
        out = array("I", [self.bos])
        for i in array("I", ids):
            if i != self.unk or out[-1] != self.unk:
                out.append(i)
        out.append(self.eos)
        return out.tobytes()


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", check_every: int = 1, with_ids: bool = False) -> DataFrame:
    """One row for each document: number of ids, digests of the ids and of the text decoded from them;
    ``with_ids`` adds the ids themselves. No shuffle."""
    schema = SCHEMA + (", ids array<int>, decoded string" if with_ids else "")
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(lean(_encode_task(model_path, check_every, with_ids)), schema)


def _encode_task(path: str, check_every: int, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for whole in batches:
            for batch in slices(whole, "text", 256 << 10):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                model.learn(texts)
                ids = [model.encode(t) for t in texts]
                if check_every:
                    wanted = model.library.encode(texts[::check_every], add_bos=True, add_eos=True, num_threads=1)
                    for doc, got, want in zip(batch.column("doc_id").to_pylist()[::check_every], ids[::check_every], wanted, strict=True):
                        if array("I", want).tobytes() != got:
                            raise ValueError(f"document {doc}: the agenda's ids differ from the library's")
                lists = [array("I", x).tolist() for x in ids]
                decoded = model.library.decode(lists, num_threads=1)
                sha = lambda values: pa.array([hashlib.sha256(v).hexdigest() for v in values], pa.string())
                columns = [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), sha(ids), sha(t.encode("utf-8") for t in decoded)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns += [pa.array(lists, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return task
