"""BPE against the tokenizers library."""

import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cases import EDGE, edge_docs, no_docs, texts
from conftest import SF_SMALL
from shiftline.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _same(library, text):
    own = bpe.load(PATH)
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode(text), "<u4").tolist() == ids
    assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_random_and_awkward_texts(library):
    rnd = random.Random(4)
    pool = [*range(0x20, 0x250)] * 3 + [*range(0x250, 0x3400), 0x1C89, 0x10D40, 0x1F600, 9, 10, 13, 0x1C, 0xA0, 0x2028]
    for text in texts() + ["aaaa" * 500, " " * 99, "it's don't 'll", "<|endoftext|><|endoftext|> a", "ab" * 999 + "c"]:
        _same(library, text)
    for _ in range(800):
        _same(library, "".join(chr(rnd.choice(pool)) for _ in range(rnd.randrange(50))))


def test_every_code_point_is_split_alike(library):
    for cp in range(0, sys.maxunicode + 1, 3):
        if not 0xD800 <= cp < 0xE000:
            s = f"a{chr(cp)}a1{chr(cp)}1.{chr(cp)}.{chr(cp)}"
            assert bpe.pre_tokens(s) == [s[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(s)], hex(cp)


def test_query_has_the_librarys_digests(spark, library):
    rows = queries.op1_bpe(spark, SF_SMALL).collect()
    source = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(rows) == len(source)
    for r in rows:
        ids = library.encode(source[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_edge_rows_and_round_trip(spark):
    encoded = bpe.encode(edge_docs(spark), PATH)
    back = bpe.decode(encoded, PATH)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([tuple(r) for r in back.collect()], key=key) == sorted([(r[0], r[1] or "") for r in EDGE], key=key)
    assert bpe.digests(edge_docs(spark), PATH).count() == len(EDGE)
    assert bpe.digests(no_docs(spark), PATH).collect() == []
