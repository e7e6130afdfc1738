"""Operators 1 and 7 against the tokenizers library alone."""

import random

import public_tokenizers
import pyarrow.orc as orc
import pytest
from conftest_llm import ODD, crc, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import packing, token_files
from ledgerline.llm.tokens import Encoder
from ledgerline.session import scratch_path

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "a  b", "\n\na b", " ", "a \n b", "x y Zß ÀÉ", "İstanbul Σας x", "a\x1cb c", "it's don't 'tis", "§ a § b", "|a| ~ b ~~ c",
    "  lead", "trail ", "12 34 5,6 a,b .. ... x", "日本語 テキスト b", "é a ́b", "\r\n x\ty\x0b z", "word. word, word! word?.", "  q \x85 w",
    "Don't STOP naïve café's", "<|endoftext|> a <|startoftext|>", " ".join(words(3, 500)),
]


@pytest.mark.parametrize("file", [WORD, BYTE])
def test_encoder_equals_the_library(file):
    library, encoder = Tokenizer.from_file(file), Encoder.of(file)
    for text in TEXTS * 2:
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(memoryview(encoder.encode(text)).cast("I")) == ids, text


#: Parts that meet in real text: capitals beside curly quotes, ellipses, signs and other scripts.
PARTS = [
    "The", "cat", "DON'T", "Café", "…", "’", "“quoted”", "€", "Dvořák", "İ", "ΣΑΣ", "ﬁ", "日本", "e\u0301", "\u0301", "A\u030a", "\u2003", "\xa0", "\x85",
    "\x1c", "\n", "\t", " ", "  ", ".", ",", "!?", "12", "'s", "'LL", "§", "|", "¶", "~", "Straße", "ẞ", "ÀÉÎ", "µ", "ª", "ǅ", "\U0001f600", "ſ", "\u2126",
    "\u212b", "\u200b", "\ufeff", "\xad", "<|endoftext|>",
]
RANGES = [(32, 126), (0, 255), (0, 0x24F), (0x250, 0xD7FF), (0x1F300, 0x1F6FF), (32, 32)]


def random_text(rnd: random.Random) -> str:
    if rnd.random() < 0.5:
        return "".join(rnd.choice(PARTS) + rnd.choice(["", " ", " "]) for _ in range(rnd.randint(1, 12)))
    return "".join(chr(rnd.randint(*rnd.choice(RANGES))) for _ in range(rnd.randint(1, 25)))


@pytest.mark.parametrize("file", [WORD, BYTE])
def test_encoder_equals_the_library_on_random_text(file):
    library, encoder, rnd = Tokenizer.from_file(file), Encoder.of(file), random.Random(11)
    for _ in range(20_000):
        text = random_text(rnd)
        assert list(memoryview(encoder.encode(text)).cast("I")) == library.encode(text, add_special_tokens=False).ids, text


def ids_of(file, text, end):
    return Tokenizer.from_file(file).encode(text or "", add_special_tokens=False).ids + [end]


def test_token_files_round_trip(spark, make):
    docs = make([r for r in ODD if r[0] != 7] + [(20 + i, t) for i, t in enumerate(TEXTS)]).withColumn("part", F.lit("clash"))
    path = scratch_path(spark, "tok")
    token_files.write_tokens(docs, path, WORD, files=3)
    stored = token_files.read_tokens(spark, path)
    rows = token_files.with_start(token_files.id_checksums(stored), stored).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, token_files.with_start(token_files.id_checksums(stored)).collect()), key=repr)
    texts = {}
    for d, t in [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]:
        texts.setdefault(d, t)
    assert len(rows) == docs.count()
    rows.sort(key=lambda r: r.start)
    at = 0
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    for r in rows:
        want = ids_of(WORD, texts[r.doc_id], 1)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(want), crc(want))
        at += len(want)


def test_lookup_prunes_and_finds(spark, make):
    docs = make([(i, f"text number {i}") for i in range(4000)])
    path = scratch_path(spark, "tok")
    token_files.write_tokens(docs, path, WORD, files=4)
    rows = token_files.read_tokens(spark, path, F.col("doc_id") == 1234)
    assert [list(r.ids) for r in rows.collect()] == [ids_of(WORD, "text number 1234", 1)]
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,1234)]" in rows._jdf.queryExecution().toString()
    files = [f for f in spark.read.orc(path).inputFiles()]
    assert len(files) == 4
    assert orc.ORCFile(files[0].removeprefix("file:")).nstripes >= 1
    # a missing id inside the range of a file is rejected by the Bloom filter or the index
    assert token_files.read_tokens(spark, path, F.col("doc_id") == 10**9).count() == 0


def test_empty_table(spark, make):
    docs = make([]).limit(0)
    path = scratch_path(spark, "tok")
    token_files.write_tokens(docs, path, WORD)
    assert token_files.with_start(token_files.id_checksums(token_files.read_tokens(spark, path))).count() == 0
    assert packing.pack_documents(docs, BYTE).count() == 0


def check_packed(rows, most):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= most
    return by


def test_packing(make):
    docs = make([r for r in ODD if r[0] != 8] + [(100 + i, " ".join(words(i, 20 + 37 * i % 900))) for i in range(150)])
    rows = packing.pack_documents(docs, BYTE).collect()
    by = check_packed(rows, 2048)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for doc, text in texts.items():
        ids, at = ids_of(BYTE, text, 0), 0
        for r in sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece):
            assert (r.start, r.ids_crc32) == (at, crc(ids[at : at + r.length]))
            assert r.piece == 0 or r.length == 2048
            at += r.length
        assert at == len(ids)
    total = sum(r.length for r in rows)
    assert len(by) <= total / 2048 * 1.02 + 2


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_every_capacity_holds(score):
    room = packing.Room(tokens=100, documents=4, cost=3000, weights=(1.0, 0.5, 0.5), score=score)
    bins = packing.Bins(room)
    sizes = sorted((7 * i % 53 + 1 for i in range(400)), reverse=True)
    held = {}
    for s in sizes:
        b, offset = bins.place(s)
        assert offset == sum(held.get(b, []))
        held.setdefault(b, []).append(s)
    for pieces in held.values():
        assert sum(pieces) <= 100 and len(pieces) <= 4 and sum(p * p for p in pieces) <= 3000
    bound = max(sum(sizes) / 100, len(sizes) / 4, sum(s * s for s in sizes) / 3000)
    assert len(held) <= 1.25 * bound + 2


def test_many_equal_pieces_share_a_state():
    bins = packing.Bins(packing.Room(tokens=2048))
    for _ in range(20_000):
        bins.place(300)
    assert bins.count == -(-20_000 // 6)
    assert sum(len(v) for v in bins.states.values()) <= 2
