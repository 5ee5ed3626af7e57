"""Pieces, token files and packing: exact round trips."""

import json
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sensorstream.llm import packing, tokenfile
from sensorstream.llm.entries import (
    END_ID,
    PIECE_BPE,
    WORD_BPE,
    WORD_BPE_IDS,
    op2_sentencepiece,
    op5_token_binary,
    op10_packing,
)
from sensorstream.llm.packing import hilbert_key, pack_along_curve, piece_lengths
from sensorstream.llm.pieces import Encoder, PieceModel, StreamingViterbi, decode_documents, encode_documents
from sensorstream.llm.tokenfile import TokenFile, documents_of, file_bytes, pack, unpack, write_token_files
from sensorstream.llm.tokenizing import BatchTokenizer, public_path, splits_words
from sensorstream.session import new_folder

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_path(WORD_BPE))


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PieceModel(public_path(PIECE_BPE)))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def wanted_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [END_ID]


ODD = [
    "it's DON'T we'll 3.5x a.b-c",
    "<|endoftext|>x<|startoftext|> <|STARTOFTEXT|>",
    "İstanbul ΣΑΣ é ́x Á.́b",
    "a\x0bb\x1cc\x85d e　f",
    "ﬁ ½ 😀‍ 漢字 \x00",
]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40) | st.sampled_from(ODD), max_size=5))
def test_batches_encode_as_the_library_does(texts):
    encoder = BatchTokenizer.of_worker(public_path(WORD_BPE), END_ID)
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    assert got == [wanted_ids(encoder.library, t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40) | st.sampled_from([*ODD, None, "Mixed Case  and spaces\n", ""]), max_size=5))
def test_vocabularies_that_keep_case_and_space_get_whole_texts(texts):
    encoder = BatchTokenizer.of_worker(public_path("byte_bpe_50k.json"), END_ID)
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    assert not encoder.by_words and ids.dtype == np.uint32
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [wanted_ids(encoder.library, t) for t in texts]


@pytest.mark.parametrize("change", ["normalizer", "pre_tokenizer", "end_of_word_suffix", "added_tokens"])
def test_how_a_vocabulary_splits_is_read_from_its_file(change):
    description = json.loads(Tokenizer.from_file(public_path(WORD_BPE)).to_str())
    assert splits_words(description)
    if change == "normalizer":
        description["normalizer"]["normalizers"].pop()  # no lower case
    elif change == "pre_tokenizer":
        description["pre_tokenizer"] = {"type": "Whitespace"}
    elif change == "end_of_word_suffix":
        description["model"][change] = None
    else:
        description[change].append({"content": "two words"})
    assert not splits_words(description)


def test_a_full_memory_of_words_starts_afresh(library):
    small = BatchTokenizer(public_path(WORD_BPE), END_ID, kept_words=5)
    for texts in (["a b c", None], ["d e f g h i j k"], ["a z"]):
        ids, bounds = small.encode(pa.array(texts, pa.string()))
        got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        assert got == [wanted_ids(library, t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60) | st.text("ab ▁the.", max_size=60) | st.sampled_from(ODD))
def test_pieces_are_the_librarys(text):
    encoder = _encoder()
    ids = encoder.encode(text).tolist()
    assert ids == encoder.model.library.encode(text)
    assert encoder.decode(ids) == encoder.model.library.decode(ids)
    if "▁" not in text and "\x00" not in text:
        assert encoder.decode(ids) == text


_made = []


def _encoder():
    if not _made:
        _made.append(Encoder(PieceModel(public_path(PIECE_BPE))))
    return _made[0]


def test_the_window_does_not_follow_the_text(encoder):
    text = "thequickbrownfox" * 2000 + "日本語" * 500 + "x" * 3000
    search = StreamingViterbi(encoder.model)
    ids = search.feed(" " + text) + search.close()
    assert ids == encoder.model.library.encode(text)
    assert search.widest <= 8 * encoder.model.longest


def test_a_unigram_model_gets_the_best_sum():
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = sentencepiece.SentencePieceProcessor(model_file=public_path(PIECE_BPE))
    proto = pb.ModelProto()
    proto.ParseFromString(model.serialized_model_proto())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        if piece.type == 1:
            piece.score = -8 - (zlib.crc32(piece.piece.encode()) % 997) / 256  # exact in single precision
    found = Encoder(PieceModel(None, "unigram", proto.SerializeToString()))
    total = lambda ids: sum(found.model.score.get(found.model.pieces[i], found.model.worst) for i in ids)
    for text in ("Hello there, general", "thethethe " * 9, "naïve 😀 text", "a" * 100):
        mine, theirs = found.encode(text).tolist(), found.model.library.encode(text)
        assert total(mine) == pytest.approx(total(theirs)) and found.decode(mine) == text


def test_pieces_of_odd_documents(spark, documents, odd_rows, encoder):
    model = public_path(PIECE_BPE)
    got = decode_documents(encode_documents(documents(odd_rows), model), model).collect()
    wanted = []
    for doc, text in odd_rows:
        ids = encoder.model.library.encode(text or "")
        wanted.append((doc, len(ids), crc(ids), text or ""))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(wanted, key=key)
    assert encode_documents(documents([]), model).count() == 0


def test_piece_query_against_the_library(spark, encoder):
    got = {r.doc_id: tuple(r) for r in op2_sentencepiece(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = encoder.model.library.encode(r.text)
        assert got[r.doc_id] == (r.doc_id, len(ids), crc(ids), zlib.crc32(r.text.encode()))


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.data())
def test_packing_bits_round_trip(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=50)), np.uint32)
    packed = pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    assert unpack(packed, len(ids), bits).tolist() == ids.tolist()


def test_ids_that_do_not_fit_are_refused():
    with pytest.raises(ValueError):
        pack(np.array([8], np.uint32), 3)


@pytest.mark.parametrize("bits", [13, 16, 17])
def test_any_range_of_a_file(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 3 * tokenfile.BLOCK_IDS + 77).astype(np.uint32)
    starts = [0, 5, 5, 9000, len(ids)]
    file = TokenFile(file_bytes([7, None, 8, 9], ids, np.array(starts), bits, 2, 100) + tokenfile.END.encode())
    assert (file.part, file.first, file.n_ids) == (2, 100, len(ids))
    for k, (a, b) in enumerate(zip(starts, starts[1:])):
        assert file.document(k).tolist() == ids[a:b].tolist()
    for a, b in [(0, 0), (0, 1), (4095, 4097), (4096, 8192), (len(ids) - 1, len(ids)), (10, len(ids))]:
        assert file.ids(a, b).tolist() == ids[a:b].tolist()
    with pytest.raises(ValueError):
        TokenFile(file.data[:-1])


def check_files(rows, texts, library):
    """rows: (doc_id, start, n_tokens, ids_crc32); texts: (doc_id, text)"""
    wanted = defaultdict(list)
    for doc, text in texts:
        ids = wanted_ids(library, text)
        wanted[doc].append((len(ids), crc(ids)))
    got, at = defaultdict(list), 0
    for doc, start, n, checksum in sorted(rows, key=lambda r: r[1]):
        assert start == at
        at += n
        got[doc].append((n, checksum))
    assert {d: sorted(v) for d, v in got.items()} == {d: sorted(v) for d, v in wanted.items()}
    order = [-1 if r[0] is None else r[0] for r in sorted(rows, key=lambda r: r[1])]
    assert order == sorted(order)


@pytest.mark.parametrize("file_ids", [8_000_000, 300])
def test_files_of_odd_documents(spark, documents, odd_rows, library, monkeypatch, file_ids):
    monkeypatch.setattr(tokenfile, "FILE_IDS", file_ids)
    path = new_folder(spark, "ids")
    write_token_files(documents(odd_rows), path, public_path(WORD_BPE), vocabulary=WORD_BPE_IDS)
    found = documents_of(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
    check_files([tuple(r) for r in found.collect()], odd_rows, library)


def test_no_documents_to_write(spark, documents):
    path = new_folder(spark, "ids")
    write_token_files(documents([]), path, public_path(WORD_BPE), vocabulary=WORD_BPE_IDS)
    assert documents_of(spark, path).count() == 0


def test_file_query_against_the_library(spark, library):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_files([tuple(r) for r in op5_token_binary(spark, SF).collect()], texts, library)


def test_the_curve_visits_every_cell_by_single_steps():
    for dimensions, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), axis=-1).reshape(-1, dimensions)
        keys = hilbert_key(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        along = cells[np.argsort(keys)]
        assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_ends_are_cut_without_padding():
    assert list(piece_lengths(2 * 2048 + 1300)) == [2048, 2048, 1024, 256, 16, 4]
    assert list(piece_lengths(0)) == []


def check_packed(pieces, texts, library, length=2048):
    """pieces: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)"""
    ids_of = defaultdict(list)
    for doc, text in texts:
        ids_of[doc].append(wanted_ids(library, text))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, n, checksum, total, sequence, offset in pieces:
        assert 0 < n
        assert any(len(ids) == total and crc(ids[start : start + n]) == checksum for ids in ids_of[doc])
        by_doc[doc, total].append((start, n))
        by_sequence[sequence].append((offset, n))
    for doc, lists in ids_of.items():
        for total in {len(ids) for ids in lists}:
            copies = sum(len(ids) == total for ids in lists)
            covered = np.zeros(total, int)
            for start, n in by_doc.pop((doc, total)):
                covered[start : start + n] += 1
            assert (covered == copies).all()
    assert not by_doc
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length and (at == length or at & (at - 1) == 0)  # no padding


def packed_rows(frame):
    columns = ("doc_id", "start", "length", F.crc32("ids"), "doc_tokens", "sequence_id", "offset")
    return [tuple(r) for r in frame.select(*columns).collect()]


@pytest.mark.parametrize("length", [2048, 16])
def test_packing_odd_documents(spark, documents, odd_rows, library, length):
    packed = pack_along_curve(documents(odd_rows), public_path(WORD_BPE), vocabulary=WORD_BPE_IDS, length=length)
    check_packed(packed_rows(packed), odd_rows, library, length)


def test_ranges_grow_with_the_ids(spark, documents, library, monkeypatch):
    rows = [(k, f"word{k} " * (k % 90)) for k in range(200)]
    monkeypatch.setattr(packing, "RANGE_BYTES", 2_000)
    packed = pack_along_curve(documents(rows), public_path(WORD_BPE), vocabulary=WORD_BPE_IDS, length=64)
    ids = sum(len(wanted_ids(library, text)) for _, text in rows)
    assert packed.rdd.getNumPartitions() == -(-ids * 2 // 2_000) > 4
    check_packed(packed_rows(packed), rows, library, 64)


def test_no_documents_to_pack(spark, documents):
    assert packed_rows(pack_along_curve(documents([]), public_path(WORD_BPE), vocabulary=WORD_BPE_IDS)) == []


def test_packing_query_against_the_library(spark, library):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_packed([tuple(r) for r in op10_packing(spark, SF).collect()], texts, library)


def test_neighbours_share_sequences(spark, documents):
    """Documents of two vocabularies meet in few sequences."""
    rows = [(k, " ".join(("river lake water boat" if k % 2 else "code loop array type").split()[(k + j) % 4] for j in range(60))) for k in range(300)]
    pieces = packed_rows(pack_along_curve(documents(rows).repartition(7), public_path(WORD_BPE), vocabulary=WORD_BPE_IDS))
    kinds = defaultdict(set)
    for p in pieces:
        kinds[p[5]].add(p[0] % 2)
    assert sum(len(k) > 1 for k in kinds.values()) <= 0.2 * len(kinds)
