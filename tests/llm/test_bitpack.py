import io
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from support import HAVE_TABLES, SF, clashing, documents, rows
from tokenizers import Tokenizer

from marquee.llm import bitpack, codec

from marquee.llm.queries import QUERIES
from marquee.sources.files import shared_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


def by_hand(docs):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=str)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.data())
def test_every_width(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=50)), np.uint32)
    packed = bitpack.pack(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    assert bitpack.unpack(packed, len(ids), bits).tolist() == ids.tolist()


def test_least_width():
    assert [bitpack.bits_for(n) for n in (1, 2, 3, 256, 257, 32_000, 49_408, 65_536, 65_537)] == [1, 1, 2, 8, 9, 15, 16, 16, 17]


def test_random_access():
    random = np.random.default_rng(3)
    docs = [(i if i else None, random.integers(0, 5_000, n).astype("<u4").tobytes()) for i, n in enumerate([0, 5, 1_000, 0, 77])]
    ids = np.frombuffer(b"".join(x for _, x in docs), "<u4")
    file = bitpack.TokenFile(io.BytesIO(bitpack.to_file(docs, 13, block=64)))
    assert file.bits == 13 and file.n_ids == len(ids) and file.counts.tolist() == [0, 5, 1_000, 0, 77]
    assert file.nulls.tolist() == [True, False, False, False, False]
    for first, last in ((0, 1), (63, 65), (100, 100), (500, 1_082), (0, 1_082), (1_000, 9_999)):
        assert file.read_ids(first, last).tolist() == ids[first:last].tolist()


def test_an_id_that_does_not_fit():
    with pytest.raises(ValueError):
        bitpack.to_file([(1, np.array([8], "<u4").tobytes())], 3)
    with pytest.raises(ValueError):
        bitpack.TokenFile(io.BytesIO(b"something else"))


DOCS = [(5, "five five"), (1, None), (2, ""), (9, "Nine, ten."), (None, "no id"), (3, "same"), (3, "same"), (4, "long text. " * 30_000)]


def test_rows(spark):
    spec = codec.read_spec(PATH)
    for docs in (documents(spark, DOCS), clashing(spark, DOCS)):
        assert rows(bitpack.digest(docs, shared_dir(spark, "tokens"), spec)) == by_hand(DOCS)


def test_files_are_whole(spark):
    spec, folder = codec.read_spec(PATH), shared_dir(spark, "tokens")
    docs = [(i, f"document {i} " * (i % 7)) for i in range(300)]
    manifest = bitpack.write_tokens(documents(spark, docs), folder, spec, file_ids=200)
    names = sorted(os.listdir(folder))
    assert names == sorted(r.path for r in manifest.collect()) and len(names) > 5
    assert rows(bitpack.read_tokens(manifest, folder)) == by_hand(docs)
    with open(os.path.join(folder, names[0]), "rb") as stream:
        file = bitpack.TokenFile(stream)
        assert file.bits == 16 and file.doc_ids.tolist() == sorted(file.doc_ids.tolist())
        ids = file.read_ids(int(file.counts[0]), int(file.counts[0] + file.counts[1]))
    assert ids.tolist() == [*Tokenizer.from_file(PATH).encode(docs[1][1], add_special_tokens=False).ids, 2]


def test_empty_table(spark):
    assert bitpack.digest(documents(spark, []), shared_dir(spark, "tokens"), codec.read_spec(PATH)).collect() == []


@pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")
def test_registered_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op2_token_files"](spark, SF)) == by_hand(docs)
