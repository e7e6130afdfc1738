"""Row contracts as data: fields with Column checks, evaluated in one projection.

A contract field turns an input column (of whatever type the source has, found from the
schema at plan time) into its normalised value and two codes: a *fatal* code (class F,
the run must stop: the value cannot even be normalised) and a *dead-letter* code (class D,
the row goes to the dead-letter table). Per field the first failing check wins, and the
codes of all fields are collected in declaration order. Nothing runs in Python per row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import numeric as N
from ..functions.temporal import parse_iso
from ..functions.text import canonical_uuid, is_canonical_uuid, normalise_currency, py_strip, strip, uuid_hex

INT_MAX = 2**31 - 1
LONG_TEXT = r"^[+-]?[0-9]+$"
INT_TEXT = r"^[+-]?[0-9]+(\.0*)?$"


@dataclass(frozen=True)
class FieldResult:
    value: Column
    dead: Column  # first dead-letter code, or null
    fatal: Column  # first fatal code, or null


Builder = Callable[[Column, T.DataType], FieldResult]


@dataclass(frozen=True)
class Field:
    name: str
    build: Builder
    out_type: T.DataType
    default: object = None  # B10: value when the column is absent (a Python literal)
    has_default: bool = False


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]


def first(*pairs: tuple[Column, str]) -> Column:
    """The code of the first failing check (null-safe: a null test does not fail)."""
    expr = None
    for test, code in pairs:
        t = F.coalesce(test, F.lit(False))
        expr = F.when(t, F.lit(code)) if expr is None else expr.when(t, F.lit(code))
    return expr if expr is not None else F.lit(None).cast("string")


def _null_str() -> Column:
    return F.lit(None).cast("string")


# ---------------------------------------------------------------- field builders


def key_id(name: str, fatal_parse: bool = True) -> Builder:
    """V1 + V2: an integer key ``>= 1``. Null and non-integer text are fatal; a
    fractional number is cut to its whole part."""

    def build(c: Column, dt: T.DataType) -> FieldResult:
        if N.is_text(dt):
            s = strip(c)
            # any BIGINT, however many zeros stand in front; beyond BIGINT no value fits
            value = F.when(s.rlike(LONG_TEXT), s.try_cast("long"))
            bad = value.isNull()
        elif N.is_number(dt):
            wide = N.number_value(c, dt)
            whole = F.when(wide < 0, F.ceil(wide)).otherwise(F.floor(wide))
            value = whole.try_cast("long")
            bad = value.isNull()
        else:
            value = F.lit(None).cast("long")
            bad = F.lit(True)
        fatal = first((bad, f"{name}_type")) if fatal_parse else _null_str()
        dead = first((bad, name), (value < 1, name)) if not fatal_parse else first((value < 1, name))
        return FieldResult(value, dead, fatal)

    return build


def int_min1(name: str) -> Builder:
    """A whole number ``>= 1`` (``'5'``, ``' 5 '``, ``'5.0'``, ``5.0`` pass)."""

    def build(c: Column, dt: T.DataType) -> FieldResult:
        if N.is_text(dt):
            s = strip(c)
            # integer text: digits, optionally a fraction of zeros ('5.0'); no exponent
            wide = F.when(s.rlike(INT_TEXT), N.number_value(c, dt, s))
        elif N.is_number(dt):
            wide = N.number_value(c, dt)
        else:
            wide = F.lit(None).cast(N.WIDE)
        whole = wide.isNotNull() & (wide == F.floor(wide)) & (wide >= 1) & (wide <= INT_MAX)
        value = F.when(wide == F.floor(wide), wide.try_cast("int"))
        return FieldResult(value, first((~whole | wide.isNull(), name)), _null_str())

    return build


def uuid_field(name: str, fatal_parse: bool) -> Builder:
    """V3 / V4: lenient UUID text to canonical form. Unparsable text is fatal in the
    transaction pipeline (it is normalised before the checks) and dead-letter elsewhere."""

    def build(c: Column, dt: T.DataType) -> FieldResult:
        if N.is_text(dt):
            value = canonical_uuid(c)
            unparsable = c.isNotNull() & ~is_canonical_uuid(c) & uuid_hex(c).isNull()
            fatal = first((unparsable, f"{name}_format")) if fatal_parse else _null_str()
            dead = first((c.isNull(), name)) if fatal_parse else first((c.isNull() | unparsable, name))
            return FieldResult(value, dead, fatal)
        return FieldResult(_null_str(), first((F.lit(True), name)), _null_str())

    return build


def money(name: str, allow_zero: bool, fatal_parse: bool) -> Builder:
    """V6 / V7: DECIMAL(18,2) — at most 16 whole and 2 fraction digits (trailing zeros
    free), finite, and not zero unless allowed."""

    def build(c: Column, dt: T.DataType) -> FieldResult:
        if N.is_text(dt):
            s = strip(c)
            not_finite = s.rlike(N.NOT_FINITE_TEXT)
            syntax_ok = s.rlike(N.NUMBER_TEXT)
            wide = N.number_value(c, dt, s)
            places = N.two_places(c, dt, wide, s)
            unparsable = c.isNull() | (~not_finite & ~syntax_ok)
        elif N.is_number(dt):
            not_finite = F.isnan(c) if isinstance(dt, (T.FloatType, T.DoubleType)) else F.lit(False)
            if isinstance(dt, (T.FloatType, T.DoubleType)):
                not_finite = not_finite | (F.abs(c) == F.lit(float("inf")))
            wide = N.number_value(c, dt)
            places = N.two_places(c, dt, wide)
            unparsable = c.isNull()
        else:
            not_finite = F.lit(False)
            wide = F.lit(None).cast(N.WIDE)
            places = F.lit(False)
            unparsable = F.lit(True)
        digits_bad = wide.isNull() | ~N.whole_digits_ok(wide)
        checks = [(not_finite, f"{name}_not_finite")]
        if not fatal_parse:
            checks.append((unparsable, name))
        checks += [(digits_bad, f"{name}_digits"), (~places, f"{name}_scale")]
        if not allow_zero:
            checks.append((wide == 0, f"{name}_zero"))
        value = wide
        fatal = first((unparsable, f"{name}_type")) if fatal_parse else _null_str()
        return FieldResult(value, first(*checks), fatal)

    return build


def currency(name: str = "currency") -> Builder:
    """V8 / V9: text, stripped to exactly 3 characters, then upper-cased (still 3).
    A non-text or null value is fatal (the normaliser raises a TypeError)."""

    def build(c: Column, dt: T.DataType) -> FieldResult:
        if not N.is_text(dt):
            return FieldResult(_null_str(), _null_str(), first((F.lit(True), f"{name}_type")))
        s = py_strip(c)
        value = normalise_currency(c)
        dead = first((F.char_length(s) != 3, name), (F.char_length(value) != 3, name))
        return FieldResult(value, dead, first((c.isNull(), f"{name}_type")))

    return build


def enum(name: str, allowed: Sequence[str]) -> Builder:
    """Exact member of a fixed set (case and spaces matter); null fails."""

    def build(c: Column, dt: T.DataType) -> FieldResult:
        if not N.is_text(dt):
            return FieldResult(_null_str(), first((F.lit(True), name)), _null_str())
        ok = c.isin(*allowed)
        return FieldResult(c, first((~F.coalesce(ok, F.lit(False)), name)), _null_str())

    return build


def text(name: str, max_len: int, nullable: bool) -> Builder:
    """V12 and the name fields: stripped text of at most ``max_len`` code points."""

    def build(c: Column, dt: T.DataType) -> FieldResult:
        if not N.is_text(dt):
            if isinstance(dt, T.NullType):
                return FieldResult(_null_str(), first((F.lit(not nullable), name)), _null_str())
            return FieldResult(_null_str(), first((c.isNotNull() | F.lit(not nullable), name)), _null_str())
        s = strip(c)
        too_long = F.char_length(s) > max_len
        missing = c.isNull() & F.lit(not nullable)
        return FieldResult(s, first((missing, name), (too_long, name)), _null_str())

    return build


def timestamp(name: str, fatal_parse: bool) -> Builder:
    """ISO text (with or without ``Z``) or a typed time; null fails."""

    def build(c: Column, dt: T.DataType) -> FieldResult:
        value = parse_iso(c, dt)
        unparsable = c.isNotNull() & value.isNull()
        fatal = first((unparsable, f"{name}_format")) if fatal_parse else _null_str()
        dead = first((c.isNull(), name)) if fatal_parse else first((c.isNull() | unparsable, name))
        return FieldResult(value, dead, fatal)

    return build


# The lenient boolean words (compared lower-case).
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")


def boolean(name: str) -> Builder:
    """Lenient boolean: the words above, 0 / 1 numbers; anything else fails."""

    def build(c: Column, dt: T.DataType) -> FieldResult:
        if isinstance(dt, T.BooleanType):
            value = c
        elif N.is_text(dt):
            low = F.lower(c)
            value = F.when(low.isin(*TRUE_WORDS), True).when(low.isin(*FALSE_WORDS), False)
        elif N.is_number(dt):
            value = F.when(c == 1, True).when(c == 0, False)
        else:
            value = F.lit(None).cast("boolean")
        return FieldResult(value, first((value.isNull(), name)), _null_str())

    return build


# ---------------------------------------------------------------- contracts

# The enumerations of the source schema.
TRANSACTION_TYPES = ("debit", "credit")
TRANSACTION_STATUSES = ("pending", "completed", "failed")
ACCOUNT_TYPES = ("savings", "checking", "investment")

TRANSACTION_CONTRACT = Contract(
    "transaction",
    (
        Field("transaction_id", key_id("transaction_id"), T.LongType()),
        Field("account_id", uuid_field("account_id", fatal_parse=True), T.StringType()),
        Field("category_id", int_min1("category_id"), T.IntegerType()),
        Field("amount", money("amount", allow_zero=False, fatal_parse=True), T.DecimalType(18, 2)),
        Field("currency", currency(), T.StringType(), "USD", True),
        Field("transaction_type", enum("transaction_type", TRANSACTION_TYPES), T.StringType()),
        Field("status", enum("status", TRANSACTION_STATUSES), T.StringType()),
        Field("description", text("description", 255, nullable=True), T.StringType(), None, True),
        Field("created_at", timestamp("created_at", fatal_parse=True), T.TimestampNTZType()),
        Field("updated_at", timestamp("updated_at", fatal_parse=True), T.TimestampNTZType()),
    ),
    key=("transaction_id",),
)

ACCOUNT_CONTRACT = Contract(
    "account",
    (
        Field("account_id", uuid_field("account_id", fatal_parse=False), T.StringType()),
        Field("account_name", text("account_name", 100, nullable=False), T.StringType()),
        Field("account_type", enum("account_type", ACCOUNT_TYPES), T.StringType()),
        Field("owner_name", text("owner_name", 100, nullable=False), T.StringType()),
        Field("currency", currency(), T.StringType(), "USD", True),
        Field("balance", money("balance", allow_zero=True, fatal_parse=False), T.DecimalType(18, 2),
              "0.00", True),
        Field("is_active", boolean("is_active"), T.BooleanType(), True, True),
        Field("created_at", timestamp("created_at", fatal_parse=False), T.TimestampNTZType()),
        Field("updated_at", timestamp("updated_at", fatal_parse=False), T.TimestampNTZType()),
    ),
    key=("account_id",),
)

CATEGORY_CONTRACT = Contract(
    "category",
    (
        Field("category_id", int_min1("category_id"), T.IntegerType()),
        Field("name", text("name", 50, nullable=False), T.StringType()),
        Field("description", text("description", 200, nullable=True), T.StringType(), None, True),
        Field("updated_at", timestamp("updated_at", fatal_parse=False), T.TimestampNTZType()),
    ),
    key=("category_id",),
)

def evaluate(df: DataFrame, contract: Contract, keep: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """One projection: the input columns, ``n_<field>`` normalised values, the arrays
    ``errors`` (class D codes) and ``fatal`` (class F codes), and ``is_valid_row``.

    Columns that are neither contract fields nor in ``keep`` are unknown keys (V15);
    absent fields without a default are missing keys (V16).

    ``partitions`` deals the rows round-robin to so many partitions first. It is for a caller
    who knows that the input is a single small file; by default nothing is reshuffled.
    """
    if partitions is not None:
        df = df.repartition(partitions)
    schema = {f.name: f.dataType for f in df.schema.fields}
    known = set(contract.columns) | set(keep)
    unknown = sorted(c for c in schema if c not in known)
    dead_codes: list[Column] = []
    fatal_codes: list[Column] = []
    values: list[Column] = []
    for fld in contract.fields:
        if fld.name in schema:
            res = fld.build(F.col(f"`{fld.name}`"), schema[fld.name])
            values.append(res.value.try_cast(fld.out_type).alias(f"n_{fld.name}"))
            dead_codes.append(res.dead)
            fatal_codes.append(res.fatal)
        elif fld.has_default:
            values.append(F.lit(fld.default).cast(fld.out_type).alias(f"n_{fld.name}"))
        else:
            values.append(F.lit(None).cast(fld.out_type).alias(f"n_{fld.name}"))
            dead_codes.append(F.lit(f"missing:{fld.name}"))
    dead_codes += [F.lit(f"unknown:{c}") for c in unknown]
    # array_except(..., [null]) drops the nulls and stays in generated code (a lambda
    # ``filter`` would force the whole projection or predicate to run interpreted). The
    # codes of one row are distinct, so its de-duplication changes nothing.
    no_null = F.array(F.lit(None).cast("string"))
    errors = F.array_except(F.array(*dead_codes), no_null) if dead_codes else F.array().cast("array<string>")
    fatal = F.array_except(F.array(*fatal_codes), no_null) if fatal_codes else F.array().cast("array<string>")
    # from the arrays, not the codes again: the generated method would grow too long to be compiled
    valid = (F.size(errors) == 0) & (F.size(fatal) == 0)
    return df.select("*", *values, errors.alias("errors"), fatal.alias("fatal"), valid.alias("is_valid_row"))


def normalised(evaluated: DataFrame, contract: Contract, keep: Sequence[str] = ()) -> DataFrame:
    """The typed contract columns of an evaluated frame, under their own names."""
    return evaluated.select(*keep, *[F.col(f"n_{c}").alias(c) for c in contract.columns])


def json_key_errors(json_col: Column, allowed: Sequence[str], required: Sequence[str]) -> Column:
    """V15 / V16 on JSON input: codes for unknown keys and missing required keys."""
    keys = F.coalesce(F.json_object_keys(json_col), F.array().cast("array<string>"))
    unknown = F.transform(F.array_sort(F.array_except(keys, F.array(*[F.lit(k) for k in allowed]))),
                          lambda k: F.concat(F.lit("unknown:"), k))
    missing = F.transform(F.array_except(F.array(*[F.lit(k) for k in required]), keys),
                          lambda k: F.concat(F.lit("missing:"), k))
    return F.concat(missing, unknown)
