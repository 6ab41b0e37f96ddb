import base64
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import pairs_of
from wardstat.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = byte_bpe.Encoder(byte_bpe.read_ranks(PATH), public_tokenizers.PATTERN)


def check(texts):
    got = list(ENCODER.encode(pa.array(texts, pa.string())))
    assert [[int(i) for i in ids.split(b",") if i] for ids, _ in got] == [LIBRARY.encode_ordinary(t) for t in texts]
    assert [decoded for _, decoded in got] == [t.encode() for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'a1éß  \x1c\x85."), st.characters(codec="utf-8")), max_size=40), max_size=8))
def test_ids_equal_the_library(texts):
    check(texts)


def test_edges_of_units_and_long_pieces():
    check(["x y", " ", "y ", " z", "a  b", "it's  we'll 12 345 ", "a" * 9000, "ab" * 3000, "　 a", "a 　", "<|endoftext|> x", ""])


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    for text in ("one two three four five", "six two seven one", "one two three"):
        check([text, text[::-1]])


def test_documents_of_all_kinds(docs, empty):
    found = byte_bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN, with_ids=True)
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found.collect())
    want = Counter()
    for key, text in pairs_of(docs):
        ids = LIBRARY.encode_ordinary(text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (text or "").encode())]
        want[(key, len(ids), *sha)] += 1
    assert got == want
    row = found.where("doc_id = 20").first()
    assert len(np.frombuffer(row["ids"], "<u4")) == row["n_tokens"]
    assert byte_bpe.encode_documents(empty, PATH, public_tokenizers.PATTERN).count() == 0
