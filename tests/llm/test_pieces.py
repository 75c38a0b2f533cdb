import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fxlake.llm import pieces
from tests.llm.conftest import make, prose

ODD = ["", " ", "   ", "a   b", "  x", "▁a ▁", "Hello  world\n\t é𝄞 ", "\n\n  \n é", "x" * 300, "日本語のテキスト", "tab\tand\rreturn"]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


CHUNK = re.compile(r"\n| *[^ \n]+| +")


def encoded(encoder, texts, docs):
    ids, offsets, _ = encoder.encode(pa.array(texts, pa.string()), np.array(docs, np.int64))
    return [ids[a:z].tolist() for a, z in zip(offsets[:-1], offsets[1:])]


def test_without_dropout_equals_the_library(vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [t for t in ODD if t and "▁" not in t] + [prose(k, 60) for k in range(20)]
    got = encoded(pieces.Encoder(vocabulary, dropout=0.0), texts, range(len(texts)))
    assert got == [model.encode(t) for t in texts]


@pytest.mark.parametrize("dropout", [0.1, 0.4])
def test_arrays_equal_the_agenda(vocabulary, dropout):
    """Chunk by chunk, with the key of its document and place; long chunks, bytes and blanks included."""
    encoder = pieces.Encoder(vocabulary, dropout=dropout)
    texts = [prose(k, 60) + " Wordsofmanyletters, tiontiontion " + "international" * k for k in range(12)] + ODD + [None]
    docs = [7 * k for k in range(len(texts))]
    want = []
    for text, doc in zip(texts, docs):
        chunks = CHUNK.findall(" " + text) if text is not None else []
        keys = encoder.keys(np.full(len(chunks), doc), np.arange(len(chunks))).tolist()
        want.append([i for c, k in zip(chunks, keys) for i in pieces.encode_chunk(c, vocabulary, k, encoder.threshold)])
    assert encoded(encoder, texts, docs) == want


def test_every_occurrence_is_segmented_on_its_own(vocabulary):
    encoder = pieces.Encoder(vocabulary)
    word = " internationalization"
    texts = [word * 50] * 200
    ids, offsets, _ = encoder.encode(pa.array(texts), np.arange(200))
    data, bounds = encoder.decode(ids, offsets)
    assert data.tobytes() == ("".join(" " + t for t in texts)).encode() and bounds[-1] == len(data)
    forms = set()
    start = np.flatnonzero([x.startswith(b" ") for x in (vocabulary.surface[k] for k in ids.tolist())])
    for a, z in zip(start, np.append(start[1:], len(ids))):
        forms.add(tuple(ids[a:z].tolist()))
    assert len(forms) > 300


def test_round_trip_and_seed(spark, awkward):
    frame = make(spark, awkward + [(50 + k, t) for k, t in enumerate(ODD)])
    out = pieces.decode(pieces.encode(frame))
    assert out.where(~F.col("decoded").eqNullSafe(F.col("row.text"))).count() == 0
    assert out.where("row.text is null").where("ids is null").count() == 2
    whole = {(r.doc_id, r.n_pieces, None if r.ids is None else tuple(r.ids)) for r in pieces.round_trip(frame).where("lossless").collect()}
    assert whole == {(r["row"].doc_id, len(r.ids or []), None if r.ids is None else tuple(r.ids)) for r in out.collect()}
    text = make(spark, [(1, prose(1, 300)), (2, prose(1, 300)), (1, prose(1, 300))])

    def ids(**options):
        return [tuple(r.ids) for r in pieces.encode(text, **options).collect()]

    one = ids()
    assert one == ids() and one[0] == one[2]
    assert one[0] != one[1]
    assert one != ids(seed=18)
    assert len(one[0]) > len(ids(dropout=0.0)[0])


def test_empty_table(spark):
    assert pieces.decode(pieces.encode(make(spark, []))).collect() == []
