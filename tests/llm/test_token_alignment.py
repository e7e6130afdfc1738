"""Operator 11 against both libraries and a loop over all intervals."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest_llm import ODD, words
from pyspark.sql import functions as F
from test_tokens_and_packing import TEXTS, random_text
from tokenizers import Tokenizer, pre_tokenizers

from ledgerline.llm import token_alignment as ta

A_FILE = public_tokenizers.path("byte_bpe_50k.json")
B_FILE = public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """Whole texts, one interval after another."""

    def __init__(self):
        self.a = Tokenizer.from_file(A_FILE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
        self.byte_of = {}
        for c in sorted(pre_tokenizers.ByteLevel.alphabet()):
            self.byte_of[c] = ord(c)
        hidden = [x for x in range(256) if chr(x) not in self.byte_of]
        for i, x in enumerate(hidden):
            self.byte_of[chr(256 + i)] = x

    def tokens(self, text):
        if not text:
            return None
        want = (" " + text).encode()
        a = [(i, bytes(self.byte_of[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            return None
        spans = []
        for tokens in (a, b):
            at, out = 0, []
            for i, x in tokens:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        return spans

    def row(self, text):
        """n_a, n_b, the groups written out, and the links."""
        got = self.tokens(text)
        if got is None:
            return 0, 0, [], []
        a, b = got
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for e in ends:
            inside = [[str(i) for i, s, t in side if s >= low and t <= e] for side in (a, b)]
            groups.append(",".join(inside[0]) + "|" + ",".join(inside[1]))
            low = e
        links = [(i, j) for i, s, t in a for j, u, v in b if s < v and u < t]
        return len(a), len(b), groups, links


def expected(rows):
    plain = Plain()
    got = [(d, *plain.row(t)) for d, t in rows]
    counts = Counter(x for r in got for x in r[4])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return [
        (
            d, na, nb, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for d, na, nb, groups, links in got
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def random_rows(seed, n):
    rnd = random.Random(seed)
    return [(100 + i, random_text(rnd)) for i in range(n)]


@pytest.mark.parametrize("head", [ta.HEAD_PAIRS, 40, 0])
def test_rows(make, head):
    """The same result wherever the border between frequent and other pairs lies."""
    rows = [r for r in ODD if r[0] != 7] + [(20 + i, t) for i, t in enumerate(TEXTS)] + random_rows(5, 200)
    rows += [(900, "has ▁ inside"), (901, "<unk> <s> </s> <0x41>"), (902, "a\x00b"), (903, " lead"), (904, "two  spaces"), (905, "tail ")]
    rows += [(1000 + i, " ".join(words(i, 40, 30))) for i in range(20)]
    docs = make(rows).withColumns({c: F.lit(1) for c in ("row", "pair", "n", "best", "rare")})
    got = ta.align_documents(docs, A_FILE, B_FILE, head)
    assert got.columns == COLUMNS
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected(rows)))


def test_words_equal_whole_texts():
    aligner, rnd, cut = ta.Aligner.of(A_FILE, B_FILE), random.Random(2), 0
    latin = ["The", "cat", "don't", "'s", "Dvořák", "é", "12", "3.5,", "a\nb", "x\n", "\n\ny", "t\tu", "!?", "(x)", "<|endoftext|>", "<s>", "<0x41>", "_", "ĳ"]
    for k in range(6000):
        text = random_text(rnd) if k % 2 else " ".join(rnd.choice(latin) + rnd.choice(["", *latin]) for _ in range(rnd.randint(1, 9)))
        parts = aligner.words(text)
        if parts is None:
            continue
        cut += 1
        joint, whole = aligner.joint(parts), aligner.whole(text)
        assert joint.pairs.tolist() == whole.pairs.tolist(), text
        assert ";".join(joint.groups()[1]) == whole.groups()[1][0], text
    assert cut > 500


def test_small_caches_give_the_same_rows(make, monkeypatch):
    rows = [(i, " ".join(words(i, 60, 400))) for i in range(40)] + random_rows(8, 40)
    monkeypatch.setattr(ta, "JOINT_WORDS", 7)
    aligner = ta.Aligner.of(A_FILE, B_FILE)
    import numpy as np

    documents = ta.Documents(aligner, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
    monkeypatch.setattr(ta, "CACHE_WORDS", 50)
    got = [documents.rows([t]) for _, t in rows]
    want = expected(rows)
    assert [(g[0][0].as_py(), g[2][0].as_py(), g[3][0].as_py(), g[6][0].as_py()) for g in got] == [(w[1], w[3], w[4], w[7]) for w in want]


def test_links_are_stored_with_one_tokenizing(make):
    """Counts and sums need no tokenizer: every document's pairs are stored, with how often each occurs."""
    rows = [(1, None), (2, ""), (3, "a b a b"), (4, "\u4e2d\u6587 x"), (5, "a a"), *random_rows(3, 40)]
    plain, got = Plain(), ta.linked(make(rows), A_FILE, B_FILE).localCheckpoint()
    pieces = plain.b.get_piece_size()
    want = {d: Counter(i * pieces + j for i, j in plain.row(t)[3]) for d, t in rows}
    stored = {r["doc_id"]: (np.frombuffer(r["pairs"], "<i8"), np.frombuffer(r["times"], "<i4")) for r in got.collect()}
    assert {d: Counter(dict(zip(*map(np.ndarray.tolist, x), strict=True))) for d, x in stored.items()} == want
    counts = {r["pair"]: r["n"] for r in ta.count_pairs(got, B_FILE).collect()}
    assert counts == sum(want.values(), Counter())
    for head in (ta.HEAD_PAIRS, 3, 0):
        sums = {r["doc_id"]: r["count_sum"] for r in ta.align(got, ta.count_pairs(got, B_FILE), head).collect()}
        assert sums == {d: sum(counts[p] * n for p, n in c.items()) for d, c in want.items()}


def test_empty_table(make):
    assert ta.align_documents(make([]).limit(0), A_FILE, B_FILE).collect() == []
    assert [tuple(r) for r in ta.align_documents(make([(1, None), (2, "")]), A_FILE, B_FILE).orderBy("doc_id").collect()] == [
        (1, 0, 0, 0, 0, 0, 0, ""),
        (2, 0, 0, 0, 0, 0, 0, ""),
    ]
