"""Encoding against the sentencepiece library."""

import hashlib
import random

import pytest
import sentencepiece

from ledgerspark.llm import pieces
from ledgerspark.llm.queries import PIECE_MODEL, QUERIES

PATH = pieces.tokenizer_path(PIECE_MODEL)
ODD = [None, "", " ", "  ", "a", " a", "a  b ", "\n\n", "a\nb", "▁", "▁▁ x▁", "①ﬁ　½ \u0000 ​", "日本語 テキスト",
       "𝄞" * 5, "<s> </s> <unk> <0x41>", "\t x\r\n", "aaaa" * 500, "x" * 60_000, "é é", "   "]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(open(PATH, "rb").read())


def texts(seed=1):
    rng = random.Random(seed)
    alphabet = " abcdeE.,\n\tßé▁中🙂́ﬁ'\"<>0129"
    return [t or "" for t in ODD] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80)))
                                     for _ in range(500)]


def test_ids_spans_and_text(library, model):
    for text in texts():
        coded = model.encode(text)
        want = library.encode(text)
        assert coded.ids.tolist() == want, text
        assert coded.written == ",".join(map(str, want))
        assert coded.decoded == library.decode(want) == model.decode(want), repr(text)
        raw = text.encode()
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(coded.begin.tolist(), coded.end.tolist())) == spans, repr(text)
        assert b"".join(raw[a:b] for a, b in spans) == raw


def test_decode_of_any_ids(library, model):
    rng = random.Random(2)
    for _ in range(400):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(259, 32000)]) for _ in range(rng.randrange(1, 12))]
        assert model.decode(ids) == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_compiled_maps_against_the_library(rule, squeeze):
    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    spec = dict(pieces._fields(library.serialized_model_proto()))[3]
    own = pieces.PieceModel.__new__(pieces.PieceModel)
    fields = dict(pieces._fields(spec))
    own.charsmap = pieces.CharsMap(fields[2]) if fields.get(2) else None
    own.dummy, own.squeeze = True, squeeze
    for text in texts(4):
        want = library.normalize(text)
        normal = own.normalise(text)
        assert normal.text == want, repr(text)
        if want:
            assert len(normal.source) == len(want.encode()) + 1
            offsets = library.normalize(text, with_offsets=True)[1]
            chars = [len(text[:o].encode()) for o in offsets]
            at, starts = 0, []
            for c in want:
                starts.append(int(normal.source[at]))
                at += len(c.encode())
            assert starts == chars[:len(starts)], repr(text)


def test_query_against_the_library(spark, library):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op4_piece_encoding"](spark, folder).collect()}
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "")
        mine = got[r.doc_id]
        assert mine.n_tokens == len(ids)
        assert mine.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert mine.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert mine.covered_bytes == len((r.text or "").encode())


def test_odd_rows(spark, library):
    docs = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(ODD)] + [(None, "x", None), (1, "", None)],
                                 "doc_id long, text string, ids array<int>")
    got = pieces.encode_documents(docs, PATH).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        if r.doc_id not in (None, 1):
            assert r.ids == library.encode(ODD[r.doc_id] or "")
            assert len(r.begins) == len(r.ends) == len(r.ids)
    assert pieces.encode_documents(docs.limit(0), PATH).collect() == []
    assert pieces.encoding_digests(docs.limit(0), PATH).collect() == []
