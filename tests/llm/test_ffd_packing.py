"""Operator 13: first-fit decreasing with a tournament tree."""

import public_tokenizers
import pytest
from conftest_llm import ODD, crc, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import ffd_packing as ffd

WORD = public_tokenizers.path("word_bpe_49k.json")


def plain_first_fit(lengths, room):
    """First fit by looking at every bin in turn."""
    free, bins = [], []
    for piece, need in enumerate(lengths):
        k = next((k for k, f in enumerate(free) if f >= need), None)
        if k is None:
            free.append(room)
            bins.append([])
            k = len(free) - 1
        free[k] -= need
        bins[k].append((piece, 0, need))
    return bins


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=60))
def test_tree_equals_plain_first_fit_and_closing_leaves_no_padding(lengths):
    lengths = sorted(lengths, reverse=True)
    bins = ffd.first_fit(lengths, 64)
    assert bins == plain_first_fit(lengths, 64)
    closed = ffd.close(bins, 64)
    seen = {}
    for parts in closed:
        n = sum(b - a for _, a, b in parts)
        assert 0 < n <= 64 and ffd.padded_length(n, 64) == n
        for piece, a, b in parts:
            assert a < b
            seen.setdefault(piece, []).append((a, b))
    for piece, spans in seen.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == lengths[piece]
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))
    assert len(seen) == len(lengths)


def check(rows, docs, room, end=2):
    library = Tokenizer.from_file(WORD)
    ids = {}
    for r in docs.select("doc_id", "text").distinct().collect():
        ids[r.doc_id] = library.encode(r.text or "", add_special_tokens=False).ids + [end]
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
        want = ids[r.doc_id]
        assert r.doc_tokens == len(want) and r.ids_crc32 == crc(want[r.start : r.start + r.length])
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= room and all(r.padded == (at if at & (at - 1) == 0 else room) for r in pieces)
    return ids, by


def test_packing(make):
    rows = [r for r in ODD if r[0] != 8] + [(100 + i, " ".join(words(i, 20 + 37 * i % 900))) for i in range(150)]
    docs = make(rows).withColumns({c: F.lit(7) for c in ("grp", "ids", "length", "start")})
    got = ffd.pack_documents(docs, WORD, group_tokens=20_000, with_ids=True).collect()
    ids, by = check(got, docs, ffd.ROOM)
    for doc, want in ids.items():
        pieces = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        assert sum(r.length for r in pieces) == len(want)
        assert b"".join(bytes(r.ids) for r in pieces) == b"".join(i.to_bytes(4, "little") for i in want)
    total = sum(map(len, ids.values()))
    assert sum({r.sequence_id: r.padded for r in got}.values()) == total  # nothing is padded
    assert len({k >> 32 for k in by}) > 1  # several groups


def test_repeated_rows_and_one_hot_document(make):
    docs = make([(5, "the same text here")] * 3000 + [(None, None)] * 50, partitions=4)
    got = ffd.pack_documents(docs, WORD, group_tokens=2000).collect()
    check(got, docs, ffd.ROOM)
    n = len(Tokenizer.from_file(WORD).encode("the same text here", add_special_tokens=False).ids) + 1
    assert sum(r.length for r in got if r.doc_id == 5) == 3000 * n
    assert sum(r.length for r in got if r.doc_id is None) == 50
    sizes = {}
    for r in got:
        sizes[r.sequence_id >> 32] = sizes.get(r.sequence_id >> 32, 0) + r.length
    assert max(sizes.values()) < 4 * 2000  # equal rows are spread over the groups


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_small_tables(make, rows):
    docs = make(rows) if rows else make([]).limit(0)
    got = ffd.pack_documents(docs, WORD).collect()
    assert [(r.doc_id, r.length, r.padded, r.offset) for r in got] == [(1, 1, 1, 0)] * len(rows)


def test_ids_are_not_shuffled(make):
    """Only the ids of cut pieces leave the tasks that read them; all checksums hold."""
    docs = make([(i, " ".join(words(i, 30 + 41 * i % 700))) for i in range(120)])
    pieces = ffd.materialise(ffd.encode(docs, WORD, 2, ffd.ROOM), "ffd-test")
    tokens = pieces.agg(F.sum("length")).first()[0]
    packed = ffd.pack(pieces, tokens, group_tokens=10_000)
    check(packed.collect(), docs, ffd.ROOM)
    cut = packed.groupBy("doc_id").count().where("count > 1").count()
    assert 0 < cut < 60
    some = pieces.where("doc_id < 3")
    assert {r.piece for r in ffd.ids_of(pieces, some).collect()} == {r.piece for r in some.collect()}
