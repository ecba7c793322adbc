import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import AddedToken, Tokenizer

from netsift.llm import packing as pk
from netsift.llm.common import table


def exact(lengths, capacity):
    """Fewest sequences, by trying every place for every piece."""
    best = [len(lengths)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[i] and rooms[k] not in rooms[:k]:
                rooms[k] -= lengths[i]
                go(i + 1, rooms)
                rooms[k] += lengths[i]
        go(i + 1, rooms + [capacity - lengths[i]])

    go(0, [])
    return best[0]


def test_reduction_never_costs_a_sequence():
    rng = random.Random(5)
    for _ in range(150):
        cap = rng.choice([10, 16, 25])
        lens = sorted((rng.randint(1, cap) for _ in range(rng.randint(1, 11))), reverse=True)
        counts = [0] * (cap + 1)
        for x in lens:
            counts[x] += 1
        left = list(counts)
        fixed = pk.reduce_instance(left, cap)
        rest = [x for x in range(cap, 0, -1) for _ in range(left[x])]
        assert sum(t for t, _ in fixed) + exact(rest, cap) == exact(lens, cap), lens
        packed = pk.pack_lengths(counts, cap)
        assert Counter(x for t, h in packed for x in h for _ in range(t)) == Counter(lens)
        assert all(sum(h) <= cap for _, h in packed)


def test_large_counts_reach_the_lower_bound():
    rng = random.Random(1)
    counts = [0] + [rng.randint(0, 10**9) for _ in range(1024)]
    packed = pk.pack_lengths(counts, 1024)
    assert sum(t for t, _ in packed) <= 1.005 * pk.lower_bound(counts, 1024)
    assert len(packed) < 20_000


def check_rows(rows, texts):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    seqs, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for s in seqs.values():
        end = 0
        for off, n in sorted(s):
            assert off == end
            end += n
        assert end <= 1024
    for i, t in texts.items():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        at = 0
        for k, (piece, start, n, crc) in enumerate(sorted(pieces[i])):
            assert (piece, start) == (k, at) and (n == 1024 or k == 0)
            assert crc == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[at : at + n]))
            at += n
        assert at == len(ids)
    return len(seqs)


def test_ids_equal_the_tokenizers_library():
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    texts = ["", " a  b\n\n c's", "<|endoftext|> x", "日本語 ñandú 😀😀 ", "x" * 5000, "\r\n \xa0\u2003 7½", "ÀÉ of the of"]
    for t, got in zip(texts, pk.token_encoder().encode(texts)):
        want = tok.encode(t, add_special_tokens=False).ids
        assert got == b"".join(i.to_bytes(4, "little") for i in want)


ADDED = ["end of page <|endoftext|> next", "<|endoftext|>", "<|endoftext|><|endoftext|> ", "a  <|endoftext|>\n\n b", "<|endoftext| >", "<|endoftext|>" * 3000]


def test_added_tokens_in_texts(spark):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    encoder = pk.token_encoder(added=True)
    assert encoder.encode(ADDED[:1]) == [b"".join(i.to_bytes(4, "little") for i in (437, 286, 2443, 220, 50256, 1306))]
    for t, got in zip(ADDED, encoder.encode(ADDED)):
        assert got == b"".join(i.to_bytes(4, "little") for i in tok.encode(t, add_special_tokens=False).ids)
    df = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")
    check_rows(pk.pack_documents(df).collect(), dict(enumerate(ADDED)))


def test_added_tokens_with_rules_of_their_own(tmp_path):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.add_special_tokens([AddedToken("<|end", single_word=True), AddedToken("[x]", rstrip=True)])
    tok.save(str(tmp_path / "more.json"))
    texts = [*ADDED, "a [x]  b", "<|end of", "<|ends"]
    for t, got in zip(texts, pk.TokenEncoder(str(tmp_path / "more.json"), P.path("byte_bpe_50k.tiktoken"), added=True).encode(texts)):
        assert got == b"".join(i.to_bytes(4, "little") for i in tok.encode(t, add_special_tokens=False).ids)


def test_very_long_white_space(spark):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["x" + " " * 1_000_000 + "y", "\n" * 1_200_000 + "<|endoftext|>z", "short"]
    for t, got in zip(texts, pk.token_encoder(added=True).encode(texts)):
        assert got == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_rows(pk.pack_documents(df).collect(), dict(enumerate(texts)))


def test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = pk.pack_documents(docs).collect()
    n = check_rows(rows, {r.doc_id: r.text for r in docs.collect()})
    assert n <= 1.02 * sum(r.length for r in rows) / 1024 + 1


def test_nulls_repeats_salts_and_empty(spark, monkeypatch):
    monkeypatch.setattr(pk, "GROUP_ROWS", 7)
    rows = [(i, "same text here", "x") for i in range(50)] + [(60, None, None), (61, "", "y"), (62, "long " * 5000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string")
    check_rows(pk.pack_documents(df).collect(), {i: t for i, t, _ in rows})
    twice = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, "c", "x")], df.schema)
    assert {r.sequence_id for r in pk.pack_documents(twice, with_ids=True).collect()} == {0}
    assert pk.pack_documents(twice).count() == 3
    assert pk.pack_documents(df.limit(0)).collect() == []


def test_witness_is_any_text_of_moderate_length():
    long = "y" * (pk.WITNESS + 5)
    assert pk.TokenEncoder.witness(["", long]) == 1 and pk.TokenEncoder.witness([long + "z", long, ""]) == 1
    assert pk.TokenEncoder.witness([""]) == 0 and pk.TokenEncoder.witness([long, "", "a"]) == 2
    texts = [f"text {i} " * (i + 1) for i in range(50)]
    seen = {pk.TokenEncoder.witness(texts[k:k + 10]) for k in range(40)}
    assert len(seen) > 4  # not the shortest, the first of its ten, alone
    with_empty = ["", *texts]
    assert with_empty[pk.TokenEncoder.witness(with_empty)] == texts[pk.TokenEncoder.witness(texts)]
