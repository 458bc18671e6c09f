"""Operators that work text by text, against libraries, regular expressions or exact round trips."""

import hashlib
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from estatelake.llm import media, pieces, quality, secrets, tokenfiles
from estatelake.llm.common import documents as table
from estatelake.llm.queries import tokenizer_file
from tests.conftest import SMALL
from tests.llm.fixtures import DOCS, documents

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def scanned(text):
    data = text.encode()
    spans = secrets.scanner(secrets.BASE + secrets.MORE).spans(data)
    at = secrets.code_points(data, sorted({p for a, _, b in spans for p in (a, b)}))
    return [(at[a], k, at[b]) for a, k, b in spans]


PARTS = ["token", "Secret", "=", ":", " ", "'", '"', "api_key", "APIKEY", "AKIA", "ABCDEFGHIJKLMNOP01", "0123456789abcdef01234567", "ab", "passwd", "é", "aaaaaaa", "/+", "\n"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_automaton_finds_what_the_expressions_find(parts):
    text = "".join(parts)
    assert [s for s in scanned(text) if s[1] < 3] == base_spans(text)


def test_further_rules():
    assert [(k, b - a) for a, k, b in scanned("x ghp_" + "a1B2" * 9 + " y")] == [(3, 40)]
    assert scanned("-----BEGIN RSA PRIVATE KEY-----")[0][1] == 5


def test_any_number_of_rules():
    words = [f"{a}{b}k" for a in "abcdefghij" for b in "abcdefghij"]
    many = secrets.BASE + tuple(secrets.Rule(w, f"{w}[0-9]+", least=5) for w in words)
    scan = secrets.scanner(many)
    data = b"xx " + b" ".join(f"{w}{i:03d}".encode() for i, w in enumerate(words)) + b" aak1 jjk1 token=abcdef"
    found = {many[k].name: data[a:b] for a, k, b in scan.spans(data)}
    assert found == {w: f"{w}{i:03d}".encode() for i, w in enumerate(words)} | {"assign": b"token=abcdef"}
    # more sets of accepting rules than a byte holds
    scan.union.sets = scan.union.sets + list(range(10**6, 10**6 + 300))
    scan.accepting = [np.append(x, np.zeros(300, bool)) for x in scan.accepting]
    assert {many[k].name for _, k, _ in scan.spans(data)} == {*words, "assign"}


def test_scan_query(spark):
    got = {r.doc_id: r for r in secrets.scan_secrets(documents(spark)).collect()}
    for doc, text, *_ in DOCS:
        spans = base_spans(text or "")
        names = [f"{secrets.BASE[k].name}:{a}:{b}" for a, k, b in spans]
        assert got[doc].base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [got[doc].n_assign, got[doc].n_access, got[doc].n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]


CHARS = ["a", "b", "th", "the", " ", "  ", ".", "...", "²", "“", "s", "'s", "É", "ж", "日", "😀", "1", "23", "\n", "▁", "_", "é", "ing", "\x00", "<s>", "<0x41>", "<|endoftext|>", "'ll", "ﬁ", " ", "\r", "x" * 60]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(CHARS), max_size=25).map("".join))
def test_agenda_is_the_library(text):
    model = pieces.piece_model(tokenizer_file("piece_bpe_32k.model"))
    want = model.library.encode(text, add_bos=True, add_eos=True)
    assert array("I", model.encode(text)).tolist() == want
    assert "".join(model._long_agenda(text)) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*CHARS, "Elle", "treç", "ß", "▁▁▁", "ungkeit", "aaaa"]), min_size=1, max_size=12).map("".join), max_size=12))
def test_agendas_side_by_side_are_each_segments_agenda(parts):
    model = pieces.piece_model(tokenizer_file("piece_bpe_32k.model"))
    assert model.agendas(parts) == [array("I", model.agenda(p)).tobytes() for p in parts]


def test_short_segments_of_a_slice_are_worked_off_together(monkeypatch):
    model, alone = pieces.PieceModel(tokenizer_file("piece_bpe_32k.model")), []
    right = pieces.PieceModel.agenda
    monkeypatch.setattr(pieces.PieceModel, "agenda", lambda self, text: alone.append(text) or right(self, text))
    monkeypatch.setattr(model.known, "size", 50)  # the table is renewed between slices
    slices = [[f"word{i} Elletreç{j}.\nungkeit{i * j} tab\t" for i in range(20)] + ["", "same", "same"] for j in range(6)]
    for texts in slices:
        model.learn(texts)
        assert [array("I", model.encode(t)).tolist() for t in texts] == model.library.encode(texts, add_bos=True, add_eos=True)
    assert not alone
    assert array("I", model.encode("😀ж" + "x" * 60)).tolist() == model.library.encode("😀ж" + "x" * 60, add_bos=True, add_eos=True)


def test_pieces_query(spark):
    path = tokenizer_file("piece_bpe_32k.model")
    lib = pieces.piece_model(path).library
    for r in pieces.encode_pieces(documents(spark), path, check_every=1).collect():
        text = dict((d[0], d[1]) for d in DOCS)[r.doc_id] or ""
        ids = lib.encode(text, add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_every_text_is_checked_unless_asked_otherwise(spark, monkeypatch):
    path, task, asked = tokenizer_file("piece_bpe_32k.model"), pieces._encode_task, []
    monkeypatch.setattr(pieces, "_encode_task", lambda path, check_every, with_ids: asked.append(check_every) or task(path, check_every, with_ids))
    pieces.encode_pieces(documents(spark), path)
    right = pieces.PieceModel.encode
    monkeypatch.setattr(pieces.PieceModel, "encode", lambda self, text: right(self, text) + (bytes(4) if text == "wrong" else b""))
    batch = pa.RecordBatch.from_pydict({"doc_id": [0, 1], "text": ["right", "wrong"]})
    with pytest.raises(ValueError, match="document 1"):
        list(task(path, asked[0], False)(iter([batch])))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(CHARS), max_size=25).map("".join))
def test_pretokens_are_the_library(text):
    e = tokenfiles.encoder(tokenizer_file("byte_bpe_50k.json"))
    assert e.encode([text, "", text])[2].tolist() == e.library.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**32 - 1), max_size=40))
def test_coding_round_trip(numbers):
    x = np.array(numbers, np.uint32)
    assert tokenfiles.unpack(*tokenfiles.pack(x), len(x)).tolist() == numbers


def test_token_files(spark):
    docs = documents(spark).dropDuplicates(["doc_id"])
    rows = sorted(tokenfiles.token_files_report(docs, tokenizer_file("byte_bpe_50k.json"), with_ids=True).collect(), key=lambda r: r.doc_id)
    lib = tokenfiles.encoder(tokenizer_file("byte_bpe_50k.json")).library
    start = 0
    for r in rows:
        ids = [*lib.encode(dict((d[0], d[1]) for d in DOCS)[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids, r.ids_crc32) == (start, len(ids), ids, zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(rows) == 16


def test_token_files_keep_null_and_repeated_ids(spark, monkeypatch):
    rows = [(None, "no id"), (None, "no id"), (None, "other"), (-1, "minus one"), (-5, "minus five"), *[(7, "hot")] * 40, *[(7, f"hot {i}") for i in range(20)], (8, "last")]
    monkeypatch.setattr(tokenfiles, "BLOCK_IDS", 8)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = tokenfiles.token_files_report(df, tokenizer_file("byte_bpe_50k.json")).collect()
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))
    lib = tokenfiles.encoder(tokenizer_file("byte_bpe_50k.json")).library
    want = sorted(zlib.crc32(np.array([*lib.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()) for _, t in rows)
    assert sorted(r.ids_crc32 for r in got) == want
    # a hot id, even of one text, is dealt out
    path = tokenfiles.write_token_files(df, tokenizer_file("byte_bpe_50k.json"), tokenfiles.stage_path(spark, "hot"), 2)
    assert spark.read.parquet(f"{path}/blocks").groupBy("shard").sum("n_ids").count() > 2


@pytest.mark.parametrize("text", ["", "a", "é" * 1000, "x" * 192, "y" * 192 * 64, "z" * 192 * 65, "w" * 100_000])
def test_media_round_trip(text):
    n, payload = media.padded(text)
    data = media.write_media(payload)
    (track,) = media.tables(data)
    assert media.payload(data, track) == payload
    assert payload[:n].decode() == text
    assert (track.codec, track.width, track.height, track.timescale, track.duration) == ("raw", 16, 12, 25, len(payload) // 192)
    for a, b in track.keyframes().tolist():
        assert (a - track.chunks[0]) % (24 * 192) == 0
        assert b - a == 192


def sample_file(stbl, rest=b"", samples=b"s" * 200):
    head = media.box(b"ftyp", b"isom")
    body = media.box(b"mdia", media.box(b"minf", media.box(b"stbl", *stbl)))
    moov = np.array([1], ">u4").tobytes() + b"moov" + np.array([16 + 8 + len(body) + len(rest)], ">u8").tobytes() + media.box(b"trak", body) + rest
    return head + moov + media.box(b"mdat", samples)


def u32(*x):
    return np.array(x, ">u4").tobytes()


def test_media_reader_on_other_files():
    assert media.read_tables(b"") == []
    assert media.read_tables(b"not a media file at all") == []
    stsz = media.full_box(b"stsz", u32(0, 2, 10, 20))
    co64 = media.full_box(b"co64", u32(1), np.array([100], ">u8").tobytes())
    stsc = media.full_box(b"stsc", u32(1, 1, 2, 1))
    (track,) = media.read_tables(sample_file([stsz, co64, stsc]))
    assert track.keyframes().tolist() == [[100, 110], [110, 130]]


def test_media_fragments():
    tkhd = media.full_box(b"tkhd", u32(0, 0, 7, 0, 0))
    trex = media.full_box(b"trex", u32(7, 1, 40, 11, 0x10000))
    moov = media.box(b"moov", media.box(b"trak", tkhd, media.box(b"mdia", media.full_box(b"mdhd", u32(0, 0, 1000, 0)))), media.box(b"mvex", trex))
    head = media.box(b"ftyp", b"isom") + moov

    def moof(offset):
        first = media.full_box(b"trun", u32(2), np.array([offset], ">i4").tobytes(), u32(0), flags=5)
        second = media.full_box(b"trun", u32(2, 5, 6), flags=0x200)
        return media.box(b"moof", media.box(b"traf", media.full_box(b"tfhd", u32(7)), first, second))

    fragment = moof(len(moof(0)) + 8)
    data = head + fragment + media.box(b"mdat", bytes(33))
    (track,) = media.read_tables(data)
    at = len(head) + len(fragment) + 8
    offset, size, sync = track.samples
    assert (offset - at).tolist() == [0, 11, 22, 27]
    assert (size.tolist(), sync.tolist(), track.duration) == ([11, 11, 5, 6], [True, False, False, False], 160)


def test_hostile_media_cost_no_more_than_their_length(spark):
    deep = b""
    for _ in range(3000):
        deep = media.box(b"moov", deep)
    claims = sample_file([media.full_box(b"stsz", u32(1, 20_000_000)), media.full_box(b"stco", u32(4_000_000_000, 0)), media.full_box(b"stsc", u32(4_000_000_000, 1, 20_000_000, 1))], samples=b"")
    short = sample_file([media.full_box(b"stsz", u32(0, 4_000_000_000, 5))])
    files = [deep, claims, short, b"", None, b"\0" * 64, media.box(b"trak", media.full_box(b"mdhd"))[:-2], claims[:-9]]
    assert media.read_tables(deep) == []
    for data in files[1:3]:
        (track,) = media.read_tables(data)
        assert track.keyframes().tolist() == []
    got = media.probe_media(spark.createDataFrame(list(enumerate(files)), "doc_id long, media binary")).collect()
    assert [r.keyframes for r in got] == [[]] * len(files)


def test_media_query(spark):
    rows = [*DOCS, (21, "x" * 192, "en", "s"), (22, "é" * 97, "en", "s"), (23, "long " * 400_000, "en", "s")]
    text = {d[0]: d[1] or "" for d in rows}
    for r in media.media_report(documents(spark, rows)).collect():
        data = text[r.doc_id].encode()
        payload = data + b" " * ((-len(data)) % 192 if data else 192)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        # the stored form, read without our reader: the payload is its end, behind the boxes
        frames, stored = len(payload) // 192, media.write_media(payload)
        assert stored.endswith(payload)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        at = len(stored) - len(payload)
        keys = [(at + 192 * i, at + 192 * i + 192) for i in range(0, frames, 24)]
        told = dict(x.split("=") for x in r.feature.split(";"))
        assert (told["codec"], told["size"], told["samples"], told["duration_ms"], told["keyframes"]) == ("raw", "16x12", str(frames), str(frames * 40), str(len(keys)))
        assert (told["first"], told["last"]) == ("{}-{}".format(*keys[0]), "{}-{}".format(*keys[-1]))
    assert media.probe_media(media.to_media(documents(spark))).where("codec = 'raw' AND size(keyframes) > 0").count() == len(DOCS)


@pytest.mark.parametrize("group", [quality.GROUP_BLOCKS, 64])
def test_quality_held_out(spark, monkeypatch, group):
    """Dictionaries of one group of blocks, and of many groups whose dictionaries are put together."""
    monkeypatch.setattr(quality, "GROUP_BLOCKS", group)
    folder = SMALL.replace("0.001", "0.01")
    docs, labels = table(spark, folder), table(spark, folder, "labels")
    rows = quality.score_quality(docs, quality.fit_quality(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.9
    assert all(r.predicted == 1 for r in rows if r.quality == 1)


def test_quality_without_labels(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score_quality(docs, quality.fit_quality(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(0, 1), (2, None), (6, 0)], "doc_id long, quality int")
    kept = quality.keep_good(docs, quality.fit_quality(docs, one))
    assert kept.columns == docs.columns
    assert all(0 <= r.score <= 1 for r in quality.score_quality(docs, quality.fit_quality(docs, one)).collect())


def test_quality_fits_are_repeatable_and_take_all_lengths(spark):
    rows, labels = [], []
    for i in range(120):
        good = i % 2
        text = (f"A calm and well written sentence about the number {i}. " if good else f"BUY!!! xx {i} $$$ click click ") * (1 + i % 7)
        rows.append((i, text, "en", "s"))
        labels.append((i, good))
    rows += [(0, None, "en", "s"), (1, "another text of the same id", "en", "s"), (2, "z " * 300_000, "en", "s"), (500, "", "en", "s"), (501, None, None, None)]
    labels += [(0, 1), (3, 0), (None, 1), (4, None)]  # labelled both ways, no id, no label
    table_of = lambda n: (documents(spark, rows).repartition(n), spark.createDataFrame(labels, "doc_id long, quality int").repartition(n))
    models = [quality.fit_quality(*table_of(n)) for n in (1, 5)]
    assert models[0].__getstate__() == models[1].__getstate__()
    assert models[0].good and models[0].bad and len(models[0].weights) == 7
    got = quality.score_quality(table_of(3)[0], models[0]).collect()
    assert len(got) == len(rows)
    # brute force: the score of each text alone, in this process
    alone = {(i, round(float(models[0].score([t or ""])[0]), 12)) for i, t, *_ in rows}
    assert {(r.doc_id, round(r.score, 12)) for r in got} == alone
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in got)
    none = documents(spark, rows).limit(0)
    assert quality.score_quality(none, models[0]).count() == 0
    assert quality.score_quality(none, quality.fit_quality(none, table_of(1)[1])).count() == 0
    clash = documents(spark, rows[:4]).withColumnsRenamed({"size": "_score", "token": "_c0"})
    assert quality.keep_good(clash, models[0]).columns == clash.columns


def test_a_document_without_an_id_is_not_held_out(spark):
    docs = spark.createDataFrame([(None, "some text"), (5, None)], "doc_id long, text string")
    got = quality.score_quality(docs, quality.fit_quality(docs, spark.createDataFrame([], "doc_id long, quality int"))).collect()
    assert {(r.doc_id, r.held_out, r.score) for r in got} == {(None, False, 0.5), (5, zlib.crc32(b"5") % 5 == 0, 0.5)}


def test_every_block_of_the_sample_can_reach_its_dictionary(spark, monkeypatch):
    """Far more blocks than one group has: a line that many of them share is in the dictionary, while the driver sees one group."""
    monkeypatch.setattr(quality, "GROUP_BLOCKS", 128)
    line = "a line that every block of the sample holds somewhere in it"
    blocks = [f"{i * 7919 % 10007} {line} {'%x' % (i * 104729)}".encode() for i in range(1500)]
    seen = []
    train = quality._dictionary
    monkeypatch.setattr(quality, "_dictionary", lambda parts: seen.append(parts) or train(parts))
    got = quality.train_dictionary(spark.createDataFrame([(b,) for b in blocks], "_block binary"))
    assert line.encode() in got
    assert len(seen) == 1 and 0 < len(seen[0]) <= 128
    few = spark.createDataFrame([(b,) for b in blocks[:100]], "_block binary")
    assert quality.train_dictionary(few) == train(sorted(blocks[:100], key=lambda b: (zlib.crc32(b), b)))
    assert quality.train_dictionary(few.limit(0)) == b""
