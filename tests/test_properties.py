"""Property tests: the Spark rules and upsert against plain-Python models."""

from decimal import Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators import merge as M
from ledgerline.operators import rules as R

UUID = "123e4567-e89b-12d3-a456-426614174000"


def model_amount(text: str) -> str:
    """The contract's amount rule: Decimal text, at most 18 digits, 2 decimals and 16 whole
    digits once normalised, finite and not zero. 'F' when Decimal cannot parse it."""
    try:
        d = Decimal(text)
    except InvalidOperation:
        return "F"
    if not d.is_finite():
        return "D"
    n = d.normalize()
    _, digits, exp = n.as_tuple()
    if exp >= 0:
        ndig, dec = len(digits) + exp, 0
    else:
        dec = -exp
        ndig = max(len(digits), dec)
    if ndig > 18 or dec > 2 or ndig - dec > 16 or d == 0:
        return "D"
    return "ok"


number = st.builds(
    lambda sign, whole, frac, exp: f"{sign}{whole}{frac}{exp}",
    st.sampled_from(["", "-", "+"]),
    st.text("0123456789", min_size=1, max_size=19),
    st.one_of(st.just(""), st.text("0123456789", max_size=4).map(lambda f: "." + f)),
    st.one_of(st.just(""), st.integers(-20, 20).map(lambda e: f"E{e:+d}")),
)
word = st.sampled_from(["NaN", "Infinity", "-inf", "abc", "1.2.3", "", "e5"])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(number, word), min_size=50, max_size=200))
def test_amount_rule_matches_model(spark, values):
    rows = [(str(i + 1), UUID, "1", v, "USD", "debit", "pending", None, "2024-01-01", "2024-01-01") for i, v in enumerate(values)]
    cols = "transaction_id string, account_id string, category_id string, amount string, currency string, " \
           "transaction_type string, status string, description string, created_at string, updated_at string"
    got = R.evaluate(spark.createDataFrame(rows, cols), R.TRANSACTION_CONTRACT).select("transaction_id", "errors", "fatal").collect()
    for r in got:
        v = values[int(r["transaction_id"]) - 1]
        ours = "F" if r["fatal"] else ("D" if r["errors"] else "ok")
        assert ours == model_amount(v), (v, r["errors"], r["fatal"])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.dictionaries(st.integers(0, 40), st.integers(0, 9), max_size=30),
       changes=st.lists(st.tuples(st.integers(0, 40), st.integers(0, 9)), max_size=60))
def test_upsert_matches_model(spark, target, changes):
    model = dict(target)
    for key, value in changes:  # later arrival wins (T13)
        model[key] = value
    t = spark.createDataFrame(list(target.items()), "k int, v int")
    c = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(changes)], "k int, v int, arrival int")
    got = {r["k"]: r["v"] for r in M.upsert(t, c, ["k"], ["arrival"]).collect()}
    assert got == model


WHITE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
UNICODE_WHITE_SPACE = {chr(x) for x in WHITE}
# test alphabet: Unicode white space, the four separators only Python strips, and two
# characters that are no white space to either (zero-width space, BOM)
WS = "".join(chr(x) for x in WHITE + [0x1C, 0x1D, 0x1E, 0x1F, 0x200B, 0xFEFF])


def model_currency(v: str):
    """Python strip (isspace set), exactly 3 characters, then upper case (still 3)."""
    t = v.strip()
    if len(t) != 3:
        return None
    u = t.upper()
    return u if len(u) == 3 else None


def model_description(v: str):
    """Strip of Unicode White_Space (not U+001C-U+001F), at most 255 characters."""
    i, j = 0, len(v)
    while i < j and v[i] in UNICODE_WHITE_SPACE:
        i += 1
    while j > i and v[j - 1] in UNICODE_WHITE_SPACE:
        j -= 1
    t = v[i:j]
    return t if len(t) <= 255 else None


text = st.text(alphabet="abcUSDßéﬁ$1" + WS, max_size=8)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(text, min_size=50, max_size=150), longs=st.lists(st.integers(250, 260), min_size=5, max_size=10))
def test_text_rules_match_model(spark, values, longs):
    descs = values + [" " * (i % 3) + "d" * n + chr(0x3000) for i, n in enumerate(longs)]
    rows = [(str(i + 1), UUID, "1", "1.00", values[i % len(values)], "debit", "pending", d, "2024-01-01", "2024-01-01")
            for i, d in enumerate(descs)]
    cols = "transaction_id string, account_id string, category_id string, amount string, currency string, " \
           "transaction_type string, status string, description string, created_at string, updated_at string"
    got = R.evaluate(spark.createDataFrame(rows, cols), R.TRANSACTION_CONTRACT).select(
        "transaction_id", "n_currency", "n_description", "errors").collect()
    for r in got:
        i = int(r["transaction_id"]) - 1
        cur, desc = values[i % len(values)], descs[i]
        want_c = model_currency(cur)
        assert ("currency" not in r["errors"]) == (want_c is not None), (cur, r["errors"])
        if want_c is not None:
            assert r["n_currency"] == want_c
        want_d = model_description(desc)
        assert ("description" not in r["errors"]) == (want_d is not None), (desc, r["errors"])
        if want_d is not None:
            assert r["n_description"] == want_d
