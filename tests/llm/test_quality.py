"""Operator 8 against plain Python."""

import re

from conftest_llm import ODD, words

from ledgerline.llm import quality

W = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = W.findall(text or "")
    grams, covered = {}, set()
    for i in range(len(w) - 4):
        grams.setdefault(tuple(w[i : i + 5]), []).append(i)
    for at in grams.values():
        if len(at) > 1:
            covered.update(i + k for i in at for k in range(5))
    lines = [x for x in (text or "").split("\n") if W.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def fields(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_base_statistics(make):
    rows = [r for r in ODD if r[0] is not None and r[0] != 8]
    rows += [
        (20, "a b c d e a b c d e a b"), (21, "x x x x x x x"), (22, " ".join(words(1, 40)) + "\nl\nl\n \n\nl \n" + " ".join(words(1, 40))),
        (23, "#*$ %&|<> é\U0001f600 ok\ttab\x0bvt\x0cff\rcr"), (24, " ".join(words(2, 300, 6))), (25, " ".join(words(3, 30) + words(4, 9) + words(3, 30)[3:11])),
    ]
    got = {r.doc_id: fields(r) for r in quality.judge(make(rows)).collect()}
    assert got == {d: base(t) for d, t in rows}


def test_frequent_lines_deplete(make):
    limits = quality.Limits(documents=5)
    line = "Menu home about contact search login help terms privacy"
    rows = [(i, line + "\n" + " ".join(words(i, 40)), "s") for i in range(20)]
    rows += [(100 + i, f"{line}\n  MENU home\tabout contact search login help terms privacy \ntwo words", "s") for i in range(4)]
    rows += [(200, line + "\nand a few more words of its own here", "other")]
    rows += [(300, "solo line of ten words which nobody else has here\n" * 1, "s")]
    got = {r.doc_id: (r.n_removed_words, r.kept) for r in quality.judge(make(rows), limits=limits).collect()}
    assert all(got[i] == (9, True) for i in range(20))
    assert all(got[100 + i] == (18, False) for i in range(4))
    assert got[200] == (0, True) and got[300] == (0, True)


def test_repeated_rows_count_once_and_stay(make):
    rows = [(1, "same line of words that repeats in every row here now")] * 30 + [(2, "same line of words that repeats in every row here now")]
    got = quality.judge(make(rows), limits=quality.Limits(documents=5)).collect()
    assert len(got) == 31 and all(r.n_removed_words == 0 and r.kept for r in got)


def test_odd_and_empty(make):
    docs = make(ODD)
    assert quality.judge(docs).count() == len(ODD)
    assert quality.judge(docs.limit(0)).count() == 0


def test_native_plan(make):
    plan = quality.profile(make(ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_verdict_does_not_depend_on_the_host_size(make):
    line = "Menu home about contact search login help terms privacy"
    rows = [(i, f"{line}\n{line}\nend", "large") for i in range(21)] + [(100 + i, " ".join(words(i, 12)), "large") for i in range(2200)]
    rows += [(5000 + i, f"{line}\n{line}\nend", "small") for i in range(21)]
    got = {r.doc_id: (r.n_removed_words, r.kept) for r in quality.judge(make(rows)).where("doc_id < 100 or doc_id >= 5000").collect()}
    assert set(got.values()) == {(19, False)} and len(got) == 42


def test_text_without_frequent_lines(make):
    line = "Menu home about contact search login help terms privacy"
    rows = [(i, f" {line.upper()}\t\n own {i} stays \n\n{line}\nend{i}", "s") for i in range(8)] + [(50, line, None), (51, None, "s"), (52, "", "s")]
    limits = quality.Limits(documents=5)
    docs = make(rows)
    out = quality.without_frequent_lines(docs, limits=limits)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts == {**{i: f" own {i} stays \n\nend{i}" for i in range(8)}, 50: line, 51: None, 52: ""}
    removed = {r.doc_id: r.n_removed_words for r in quality.judge(docs, limits=limits).collect()}
    assert removed == {d: len((t or "").split()) - len((texts[d] or "").split()) for d, t, _ in rows}


def test_sql_and_code_have_one_line_limit(make):
    """A host of 2,500 documents with lines in 19 to 24 of them: the limit is a number, not a share."""
    import duckdb

    from ledgerline.llm.oracle import QUALITY

    rows = []
    for i in range(2500):
        lines = [f"document {i} speaks of {i * 7 % 1009} things in its own words and says little else about it"]
        lines += [f"shared line number {k} of this host" for k in range(19, 25) if i < k]
        rows.append((i, "\n".join(lines), "hot"))
    docs = make(rows)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(QUALITY).df()
    got = quality.judge(docs).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    plain = lambda df: sorted(map(repr, df[columns].astype(object).itertuples(index=False, name=None)))
    assert plain(got) == plain(want)
    assert {r.doc_id: r.n_removed_words for r in got.itertuples()}[0] == 4 * 7
