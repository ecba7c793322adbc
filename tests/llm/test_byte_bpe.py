import base64
import hashlib
import random

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from netsift.llm import byte_bpe
from netsift.llm.common import table
from netsift.llm.pretokens import PreTokenEncoder

RANKS = byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
REF = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
BPE = byte_bpe.ByteBPE(RANKS)
SMALL = PreTokenEncoder(P.PATTERN, BPE.encode_many, bound=50)

HARD = ["", " ", "a", "  a", "a \n b", "a\n \nb", "a  \t b ", "it's we'll 'S", "  x\xa0 y", "x" * 3000 + " " * 700,
        "ab" * 600, "<|endoftext|>", "日本語 ñandú 😀😀", "\r\n\r\n", "aaaa" * 200 + "b", "\x00\x01 \x1c z"]


def ids(b):
    return [int.from_bytes(b[i : i + 4], "little") for i in range(0, len(b), 4)]


def test_hard_texts():
    for t, got in zip(HARD, SMALL.encode(HARD)):
        assert ids(got) == REF.encode_ordinary(t), t[:40]
        assert BPE.decode(got) == t.encode()


def test_matrix_and_heap_agree():
    rng = random.Random(3)
    words = ["".join(rng.choice("aeinrst ") for _ in range(rng.randint(2, 250))) for _ in range(300)]
    assert [ids(x) for x in BPE.encode_many(words)] == [
        [RANKS[w.encode()]] if w.encode() in RANKS else BPE._long(w.encode()) for w in words
    ]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n\t\xa0ab'sé1.,日"), max_size=30), max_size=6))
def test_any_text(texts):
    assert [ids(x) for x in SMALL.encode(texts)] == [REF.encode_ordinary(t) for t in texts]


def test_table_digests(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = {}
    for r in docs.collect():
        x = REF.encode_ordinary(r.text)
        raw = b"".join(i.to_bytes(4, "little") for i in x)
        want[r.doc_id] = (len(x), hashlib.sha256(raw).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())
    assert {r[0]: tuple(r)[1:] for r in byte_bpe.encode_digests(docs).collect()} == want


def test_nulls_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, "q"), (None, "hi", None), (1, "", "w"), (2, "w " * 300000, "w")], "doc_id long, text string, ids string")
    got = byte_bpe.encode_documents(df).collect()
    assert [r.doc_id for r in got] == [1, None, 1, 2] and got[0].ids == [] and bytes(got[1].decoded) == b"hi"
    assert got[3].ids == REF.encode_ordinary("w " * 300000)
    assert byte_bpe.encode_digests(df.limit(0)).collect() == []
    assert base64  # the rank file's encoding
