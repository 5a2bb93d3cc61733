import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowferry.llm.packing import best_fit, cut_pieces, pack_documents, place
from rowferry.llm.tokens import Encoder, pack_ids, read_tokens, unpack_ids, write_tokens

SF = "/root/testdata/sf0.01"
whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
encoder = Encoder(limit=50)


def ids_of(text):
    return whole.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(".,'_² \n\t\r\x0b\x1c\x85  '<|>stred́İΣA1")), max_size=40), max_size=6))
def test_encoder_equals_library(texts):
    texts = texts + ["Word, next. No.\n3. x., a' . É. It'S. <|ENDOFTEXT|> ², _, .", "it's <|endoftext|> á ́b <|startoftext|>x"]
    ids, bounds = encoder(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ids_of(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=50) | st.lists(st.integers(0, 5), max_size=50))
def test_codes_round_trip(ids):
    ids = np.array(ids, np.uint32)
    assert unpack_ids(*pack_ids(ids), len(ids)).tolist() == ids.tolist()


def test_codes_of_many_kinds():
    ids = np.concatenate([np.arange(70_000), np.arange(300), [7] * 5]).astype(np.uint32)
    ranks, control, data = pack_ids(ids)
    assert unpack_ids(ranks, control, data, len(ids)).tolist() == ids.tolist()
    assert np.frombuffer(ranks, "<u4")[0] == 7 and len(control) == -(-len(ids) // 4)


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


ODD = [(5, None), (2, ""), (2, "again"), (None, "no id"), (None, "no id"), (9, "x " * 30_000), (-1, "é A"), (3, "same"), (4, "same")]


@pytest.mark.parametrize("block_ids", [1 << 20, 500])
def test_files(spark, table, tmp_path, block_ids):
    for name, docs in (("t", table), ("odd", spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)), ("none", table.limit(0))):
        write_tokens(docs, f"{tmp_path}/{name}{block_ids}", block_ids=block_ids)
        out = read_tokens(spark, f"{tmp_path}/{name}{block_ids}", with_ids=True).collect()
        out.sort(key=lambda r: r.start)
        assert [r.doc_id for r in out] == sorted((r.doc_id for r in docs.collect()), key=lambda d: (d is not None, d))
        start = 0
        for r in out:
            assert r.start == start and r.n_tokens == len(r.ids) and r.ids[-1] == 1
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            start += r.n_tokens
        want = sorted((str(d), [*ids_of(t), 1]) for d, t in docs.collect())
        assert sorted((str(r.doc_id), r.ids) for r in out) == want


def check_packing(docs, out, capacity):
    got = {}
    for r in out:
        got.setdefault(r.doc_id, []).append(r)
    for doc_id, text in docs:
        ids = [*ids_of(text), 0]
        rows = sorted(got.pop(doc_id), key=lambda r: r.piece)
        assert [r.start for r in rows] == list(range(0, len(ids), capacity))
        for r in rows:
            own = ids[r.start : r.start + capacity]
            assert r.length == len(own) and r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
    assert not got
    bins = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(r.length for r in out)


def test_packing(spark, table):
    bins, total = check_packing([tuple(r) for r in table.collect()], pack_documents(table).collect(), 2048)
    assert bins <= 1.01 * total / 2048 + 1


def test_packing_edges(spark):
    docs = [(1, None), (2, ""), (3, "x " * 5000), (4, "same"), (5, "same"), (None, "no id")]
    out = pack_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    check_packing(docs, out, 2048)
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tree_of_groups(spark, table, tmp_path):
    """Many small groups and a small capacity, so that bins move up several levels."""
    path = f"{tmp_path}/pieces"
    cut_pieces(table, 128).write.parquet(path)
    pieces = spark.read.parquet(path)
    out = place(pieces, 128, group_pieces=30, carry=16).collect()
    bins, total = check_packing([tuple(r) for r in table.collect()], out, 128)
    assert bins <= 1.03 * total / 128 + 1


def test_best_fit_prefers_the_fullest():
    bins, offsets, fills = best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8] and fills.tolist() == [10, 10]
