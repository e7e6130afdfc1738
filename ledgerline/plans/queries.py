"""The query catalogue: one function per operator group, each ``(spark, sf_dir) -> DataFrame``.

Every query reads whole given tables (through the derived views of ``sources.fixtures``)
and returns a lazy DataFrame. Parameters below are fixed so that the DuckDB oracle of
``plans.oracle`` computes the same result.
"""

from __future__ import annotations

import datetime as _dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonrows as J
from ..functions.temporal import extract_since, ntz, parse_iso
from ..operators import change_set as C
from ..operators import constraints as K
from ..operators import extract as X
from ..operators import merge as M
from ..operators.json_paths import json_paths
from ..operators.load import load_projection as _load_projection
from ..operators.reconcile import reconcile
from ..operators import rules as R
from ..operators import validate as V
from ..plans import ledger as L
from ..plans import report as P
from ..sources.fixtures import Fixtures, event_props, event_transactions, md5_uuid

# Fixed parameters of the catalogue.
DEMO_WATERMARK = _dt.datetime(2000, 1, 1)  # last completed watermark of the extract demos
OVERLAP_MINUTES = 5
DEMO_CHUNK = 500


def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows above the watermark minus the overlap, 10 columns."""
    fx = Fixtures(spark, sf_dir)
    return X.incremental_extract(fx.transactions(), extract_since(ntz(DEMO_WATERMARK), OVERLAP_MINUTES))


def resume_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resume point over a ledger of 1 run per event."""
    return L.resume_point(Fixtures(spark, sf_dir).ledger_rows(), OVERLAP_MINUTES)


def resume_point_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: every run still running, so no completed run: epoch minus the overlap."""
    started = Fixtures(spark, sf_dir).ledger_rows().withColumn("status", F.lit("running"))
    return L.resume_point(started, OVERLAP_MINUTES)


def _demo_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_extract(spark, sf_dir)


def chunk_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global position by (updated_at, transaction_id) and chunk of 500."""
    chunked = X.assign_chunks(_demo_extract(spark, sf_dir).select("transaction_id", "updated_at"), DEMO_CHUNK)
    return chunked.select("transaction_id", "updated_at", "position", "chunk_index")


def chunk_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per chunk rows, high watermark, running watermark, completed count."""
    chunked = X.assign_chunks(_demo_extract(spark, sf_dir).select("transaction_id", "updated_at"), DEMO_CHUNK)
    stats = X.chunk_stats(chunked)
    return L.progress(stats, DEMO_WATERMARK).select(
        "chunk_index", "row_count", "chunk_high_watermark", "last_watermark", "chunks_completed"
    )


def extract_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bound, row count and chunk count of one extract."""
    chunked = X.assign_chunks(_demo_extract(spark, sf_dir).select("transaction_id", "updated_at"), DEMO_CHUNK)
    bound = DEMO_WATERMARK - _dt.timedelta(minutes=OVERLAP_MINUTES)
    return X.extract_summary(chunked, bound)


FIXTURE_RUN = "fixture-run"
FIXTURE_ATTEMPT = "1"
FIXTURE_TIME = _dt.datetime(2024, 2, 1)
# The allowed and required keys of an event's props document.
PROPS_ALLOWED = ("k",)
PROPS_REQUIRED = ("k",)


def _tasks(spark: SparkSession) -> int:
    """The given tables are single files: their rows are dealt to the cores before the rules."""
    return spark.sparkContext.defaultParallelism


def _evaluated_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.evaluate(Fixtures(spark, sf_dir).transactions_raw(), R.TRANSACTION_CONTRACT, partitions=_tasks(spark))


def normalise_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed, normalised contract columns of every raw row."""
    return R.normalised(_evaluated_raw(spark, sf_dir), R.TRANSACTION_CONTRACT)


def rule_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count per set of dead-letter codes."""
    ev = _evaluated_raw(spark, sf_dir)
    return ev.groupBy(F.concat_ws(",", "errors").alias("errors")).agg(F.count(F.lit(1)).alias("row_count"))


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised valid rows."""
    return V.valid_rows(_evaluated_raw(spark, sf_dir))


def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of one run over the whole raw extract, chunk 500; the
    payload is shown by its parsed fields."""
    raw = Fixtures(spark, sf_dir).transactions_raw()
    chunked = X.assign_chunks(raw, DEMO_CHUNK)
    ev = R.evaluate(chunked, R.TRANSACTION_CONTRACT, keep=("position", "chunk_index"))
    dl = V.dead_letters(ev, FIXTURE_RUN, FIXTURE_ATTEMPT, FIXTURE_TIME, list(raw.columns))
    p = F.from_json("payload", raw.schema, V.PAYLOAD_JSON_OPTIONS)
    return dl.select(
        "pipeline_run_id",
        "chunk_index",
        p["transaction_id"].alias("transaction_id"),
        "error_message",
        p["amount"].alias("payload_amount"),
        p["currency"].alias("payload_currency"),
        p["transaction_type"].alias("payload_transaction_type"),
        p["status"].alias("payload_status"),
        p["description"].alias("payload_description"),
        p["updated_at"].alias("payload_updated_at"),
    )


def fatal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the all-text view that cannot be normalised."""
    ev = R.evaluate(Fixtures(spark, sf_dir).transactions_text(), R.TRANSACTION_CONTRACT, partitions=_tasks(spark))
    return V.fatal_rows(ev)


def text_time_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract of the all-text view, whose times carry mixed offsets;
    rows whose time does not parse are kept for the rules."""
    rows = X.incremental_extract(Fixtures(spark, sf_dir).transactions_text(), extract_since(ntz(DEMO_WATERMARK), OVERLAP_MINUTES))
    return rows.select("transaction_id", "updated_at", parse_iso(F.col("updated_at"), rows.schema["updated_at"].dataType).alias("utc"))


def extra_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of ``events.props`` against the allowed and required lists."""
    ev = event_props(Fixtures(spark, sf_dir).table("events"))
    codes = R.json_key_errors(F.col("props"), PROPS_ALLOWED, PROPS_REQUIRED)
    flagged = ev.select("event_type", codes.alias("codes"))
    has = lambda prefix: F.exists("codes", lambda c: c.startswith(prefix))
    return flagged.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(has("unknown:")).alias("unknown_key_rows"),
        F.count_if(has("missing:")).alias("missing_key_rows"),
    )


def account_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account contract over the derived accounts."""
    ev = V.validate(Fixtures(spark, sf_dir).accounts_raw(), R.ACCOUNT_CONTRACT)
    return ev.select(
        "account_id",
        F.col("n_account_name").alias("account_name"),
        F.col("n_currency").alias("currency"),
        F.col("n_balance").alias("balance"),
        F.col("n_is_active").alias("is_active"),
        F.concat_ws(",", F.concat("fatal", "errors")).alias("errors"),
    )


def category_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category contract over the derived categories."""
    ev = V.validate(Fixtures(spark, sf_dir).categories_raw(), R.CATEGORY_CONTRACT)
    return ev.select(
        "category_id", F.col("n_name").alias("name"), F.concat_ws(",", F.concat("fatal", "errors")).alias("errors")
    )


def pack_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events packed 500 per chunk into JSON arrays and read back."""
    events = Fixtures(spark, sf_dir).table("events")
    chunked = X.assign_chunks(events, DEMO_CHUNK, order=("ts", "event_id"))
    cols = events.columns
    packed = J.pack(chunked, ["chunk_index"], cols, "position")
    return J.unpack(packed, ["chunk_index"], events.schema).select(*cols)


# Fixed parameters of the change-feed queries over ``events`` (key ``user_id``).
EVENT_KEY = ["user_id"]
EVENT_ORDER = ["ts", "event_id"]
CUTS = (_dt.datetime(2024, 1, 1, 1), _dt.datetime(2024, 1, 2), _dt.datetime(2024, 1, 30, 12))
UPSERT_CUT = CUTS[1]
REPLAY_CUT = CUTS[2]
NOW = _dt.datetime(2024, 2, 1)  # the NOW() of the change set and of the loads
PENDING_K = 200
TRANSFER_LIMIT = 1000
LATE_CUT = _dt.datetime(2000, 6, 1)  # time of the first run in the late-row scenario


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Fixtures(spark, sf_dir).table("events")


def _base_and_changes(events: DataFrame, cut: _dt.datetime) -> tuple[DataFrame, DataFrame]:
    base = M.latest_per_key(events.where(F.col("ts") <= ntz(cut)), EVENT_KEY, EVENT_ORDER)
    changes = events.where(F.col("ts") > ntz(cut))
    return base, changes


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest event per user (by ts, then event_id)."""
    return M.latest_per_key(_events(spark, sf_dir), EVENT_KEY, EVENT_ORDER)


def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base (newest per user up to the cut) upserted with all later events."""
    base, changes = _base_and_changes(_events(spark, sf_dir), UPSERT_CUT)
    return M.upsert(base, changes, EVENT_KEY, EVENT_ORDER)


def upsert_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: insert / update / keep counts of the upsert at three cuts."""
    events = _events(spark, sf_dir)
    parts = []
    for cut in CUTS:
        base, changes = _base_and_changes(events, cut)
        out = M.upsert_outcome(base, changes, EVENT_KEY)
        parts.append(out.groupBy("outcome").agg(F.count(F.lit(1)).alias("row_count")).select(
            ntz(cut).alias("cut"), "outcome", "row_count"))
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


def upsert_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same change set applied twice gives the state of one application."""
    base, changes = _base_and_changes(_events(spark, sf_dir), REPLAY_CUT)
    once = M.upsert(base, changes, EVENT_KEY, EVENT_ORDER)
    return M.upsert(once, changes, EVENT_KEY, EVENT_ORDER)


def upsert_stale_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older change overwrites a newer row (no guard by default); the guarded
    upsert keeps the newer row, shown next to it."""
    events = _events(spark, sf_dir)
    newest = M.latest_per_key(events, EVENT_KEY, EVENT_ORDER)
    oldest = M.latest_per_key(events, EVENT_KEY, EVENT_ORDER, earliest=True)
    plain = M.upsert(newest, oldest, EVENT_KEY, EVENT_ORDER)
    guarded = M.upsert(newest, oldest, EVENT_KEY, EVENT_ORDER, guard="ts")
    return plain.select("user_id", "event_id", "ts").join(
        guarded.select("user_id", F.col("event_id").alias("guarded_event_id")), "user_id")


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nations offered as categories to a table that holds those up to id 10;
    inserted only when the name is new."""
    fx = Fixtures(spark, sf_dir)
    offered = fx.table("nation").select(
        (F.col("n_nationkey") + 1).cast("int").alias("category_id"),
        F.lower("n_name").alias("name"),
        F.lit(None).cast("string").alias("description"),
        ntz(NOW).alias("updated_at"),
    )
    held = fx.categories().where(F.col("category_id") <= 10)
    return M.insert_if_absent(held, offered, ["name"]).select("category_id", "name", "updated_at")


def unique_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated (l_orderkey, l_linenumber) pairs of lineitem."""
    return K.duplicate_keys(Fixtures(spark, sf_dir).table("lineitem"), ["l_orderkey", "l_linenumber"])


def foreign_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans of both references of transactions, some of which point nowhere."""
    fx = Fixtures(spark, sf_dir)
    lost = F.col("transaction_id") % 50 == 0
    txn = fx.transactions().withColumn("category_id", F.col("category_id") * 3).withColumn(
        "account_id", F.when(lost, md5_uuid(-F.col("transaction_id"))).otherwise(F.col("account_id")))
    cat = K.orphans(txn, ["category_id"], fx.categories(), ["category_id"]).select(
        F.lit("category_fk").alias("constraint_name"), "transaction_id", F.col("category_id").cast("string").alias("missing_key"))
    acc = K.orphans_of_large(txn, ["account_id"], fx.accounts(), ["account_id"]).select(
        F.lit("account_fk").alias("constraint_name"), "transaction_id", F.col("account_id").alias("missing_key"))
    return cat.unionByName(acc)


def check_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations per constraint of the five tables' DDL over dirty rows."""
    fx = Fixtures(spark, sf_dir)
    raw = fx.transactions_raw()
    reporting = _load_projection(R.normalised(_evaluated_raw(spark, sf_dir), R.TRANSACTION_CONTRACT), NOW)
    parts = [
        K.violation_counts(raw, K.transaction_constraints(F.col("amount").try_cast("decimal(38,18)"))),
        K.violation_counts(fx.accounts_raw(), K.account_constraints()),
        K.violation_counts(fx.categories_raw(), K.category_constraints()),
        K.violation_counts(reporting, K.reporting_constraints()),
        K.violation_counts(fx.ledger_rows(), K.ledger_constraints()),
    ]
    names = ["transactions", "accounts", "categories", "financial_records", "etl_checkpoints"]
    out = [p.select(F.lit(n).alias("table_name"), "constraint_name", "violations") for n, p in zip(names, parts, strict=True)]
    return functools.reduce(DataFrame.unionByName, out)


def oldest_pending_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 200 oldest pending transactions become completed."""
    return C.oldest_pending_to_completed(Fixtures(spark, sf_dir).transactions(), NOW, PENDING_K)


def apply_change_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One new transaction per event (round-robin accounts) plus M5."""
    fx = Fixtures(spark, sf_dir)
    txn = fx.transactions()
    first_id = txn.agg(F.max("transaction_id")).first()[0] or 0
    seq = fx.table("events").select((F.col("event_id") + 1).alias("seq"), "event_type", "value")
    numbered = C.with_round_robin(seq, "seq", fx.accounts().select("account_id"), "account_id")
    inserts = event_transactions(numbered, first_id, ntz(NOW))
    return C.apply_change_set(txn, inserts, NOW, PENDING_K)


def newest_n_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 1000 rows, strict validation, load projection."""
    from ..plans.pipeline import newest_valid_rows

    return _load_projection(newest_valid_rows(Fixtures(spark, sf_dir).transactions(), R.TRANSACTION_CONTRACT, TRANSFER_LIMIT), NOW)


def newest_n_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the strict gate refuses among the newest 1000 dirty rows."""
    raw = Fixtures(spark, sf_dir).transactions_raw()
    top = raw.orderBy(F.col("updated_at").desc_nulls_last(), F.col("transaction_id").desc()).limit(TRANSFER_LIMIT)
    return V.strict_rejects(R.evaluate(top, R.TRANSACTION_CONTRACT))


def load_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 12 target columns of the valid raw rows, fixed ``loaded_at``."""
    return _load_projection(V.valid_rows(_evaluated_raw(spark, sf_dir)), NOW)


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post-load counts after the change set: recent and total rows."""
    fx = Fixtures(spark, sf_dir)
    changed = apply_change_set(spark, sf_dir)
    return P.labelled_counts([
        ("accounts", fx.accounts()),
        ("categories", fx.categories()),
        ("transactions", changed),
        ("recent_transactions", P.recent(changed, NOW, 1)),
    ])


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty rows that commit days after their ``updated_at`` (arrival = updated_at +
    key mod 7 days). A first run at the cut loads or rejects what had arrived; every 11th key
    had then an older version, whose update committed late. The next run's bound is the
    first run's watermark minus the overlap."""
    raw = Fixtures(spark, sf_dir).transactions_raw()
    key = F.col("transaction_id")
    seen = raw.where(F.col("updated_at") + F.make_dt_interval(F.pmod(key, F.lit(7))) <= ntz(LATE_CUT))
    wm = seen.agg(F.max("updated_at")).first()[0]
    older = F.when(F.pmod(key, F.lit(11)) == 3, F.col("updated_at") - F.make_dt_interval(F.lit(1))).otherwise(F.col("updated_at"))
    ev = R.evaluate(seen, R.TRANSACTION_CONTRACT, partitions=_tasks(spark))
    target = V.valid_rows(ev).withColumn("updated_at", older)
    rejected = V.invalid_rows(ev).select("transaction_id", "updated_at")
    bound = extract_since(ntz(wm), OVERLAP_MINUTES)
    return P.late_rows(raw, target, bound, ["transaction_id"], rejected=rejected).select("transaction_id", "updated_at")


# Fixed parameters of the end-to-end scenario: run 1 sees the source as it was at T1,
# run 2 sees all of it; run 2 is left unfinished so that its buffers show in the report.
E2E_T1 = _dt.datetime(2000, 1, 1)
E2E_L1 = _dt.datetime(2024, 2, 1)
E2E_L2 = _dt.datetime(2024, 2, 2)
E2E_CHUNK = 500
E2E_RUNS = ["run-1", "run-2", "run-unknown"]


def _two_runs(spark: SparkSession, sf_dir: str):
    from ..plans.pipeline import LedgerPipeline, PipelineConfig
    from ..session import scratch_path

    raw = Fixtures(spark, sf_dir).transactions_raw()
    pipe = LedgerPipeline(spark, scratch_path(spark, "e2e"), PipelineConfig(chunk_size=E2E_CHUNK))
    pipe.run_pipeline("run-1", raw.where(F.col("updated_at") <= ntz(E2E_T1)), E2E_L1)
    pipe.run_pipeline("run-2", raw, E2E_L2, finalize=False)
    return pipe


def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reporting table after two runs; overlap rows carry the second load time."""
    return _two_runs(spark, sf_dir).table()


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six metrics for a finished run, a running run and an unknown run."""
    return _two_runs(spark, sf_dir).run_metrics(E2E_RUNS)


def ledger_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger events from ``events`` (one run per user; signup
    starts, view sets the total, click advances, purchase / error finish), folded to the
    current row per run. Events before a run's first start change nothing."""
    ev = Fixtures(spark, sf_dir).table("events")
    et = F.col("event_type")
    events = ev.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("pipeline_run_id"),
        F.when(et == "signup", "start").when(et == "view", "total").when(et == "click", "advance").otherwise(
            "finish").alias("event"),
        F.when(et.isin("signup", "click"), F.col("ts")).alias("last_watermark"),
        F.when(et == "click", F.lit(1)).alias("chunks_delta"),
        F.when(et == "view", F.floor("value").cast("int")).alias("total_chunks"),
        F.when(et == "purchase", "completed").when(et == "error", "failed").alias("status"),
        F.lit(None).cast("string").alias("attempt"),
        F.col("ts").alias("at"),
    )
    return L.fold(events).select("pipeline_run_id", "last_watermark", "chunks_completed", "total_chunks", "status",
                                 "started_at", "updated_at")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ``availableNow`` stream over the orders file, one pipeline run per
    micro-batch; the table equals the batch load of the same rows."""
    from ..plans.pipeline import LedgerPipeline, PipelineConfig
    from ..session import scratch_path
    from ..sources import fixtures as FX
    from ..streaming.stream import file_glob, read_stream, start_upsert_stream

    root = scratch_path(spark, "stream")
    orders_path = f"{sf_dir.rstrip('/')}/orders.parquet"
    schema = spark.read.parquet(orders_path).schema
    stream = FX.transactions_raw(FX.transactions(read_stream(spark, file_glob(orders_path), schema)))
    pipe = LedgerPipeline(spark, root, PipelineConfig(chunk_size=E2E_CHUNK))
    q = start_upsert_stream(spark, stream, pipe, "orders", f"{root}/_stream_checkpoint", now=lambda: NOW)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return pipe.table()


def reconcile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source transactions against a target that lost every 101st key, holds another
    amount for every 103rd, lacks a text at every 107th and has 3 keys in 1,000 of its own."""
    source = Fixtures(spark, sf_dir).transactions()
    k = F.col("transaction_id")
    every = lambda n: F.pmod(k, F.lit(n)) == 0
    changed = source.where(~every(101)).withColumns({
        "amount": F.when(every(103), F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,2)"),
        "description": F.when(~every(107), F.col("description")),
    })
    extra = source.where(F.pmod(k, F.lit(1000)) < 3).withColumn("transaction_id", -k)
    return reconcile(source, changed.unionByName(extra), "transaction_id", [c for c in source.columns if c != "transaction_id"])


def props_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths, types and counts of ``events.props``, some of them nested or broken."""
    r = F.col("event_id") % 50
    nested = '{"k": "7", "tags": ["a", 1, {"z": null}], "at": {"x": 1.5, "y": {"w": true}}}'
    props = F.when(r == 4, nested).when(r == 5, '{"k": true}').when(r == 6, '{"k":').when(r == 7, F.lit(None).cast("string")).otherwise(F.col("props"))
    return json_paths(event_props(Fixtures(spark, sf_dir).table("events")).withColumn("props", props), "props", 4)


#: Arrival of the out-of-order stream: every 9th key comes 700 days after its time, every 8th comes
#: twice, 400 days apart; one landed file per 400 days, watermark one year behind.
LANDED_DAYS = 400
LATE_DELAY = "365 days"


def event_time_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over files that land out of order, drained file by file; every row
    with the watermark's verdict on it."""
    from ..session import scratch_path
    from ..streaming.event_time import mark_late, streaming_session
    from ..streaming.stream import read_stream

    own = streaming_session(spark)
    root = scratch_path(spark, "event-time")
    txn = Fixtures(own, sf_dir).transactions().select("transaction_id", "updated_at")
    k = F.col("transaction_id")
    day = F.datediff("updated_at", F.lit("1992-01-01")) + F.when(F.pmod(k, F.lit(9)) == 0, 700).otherwise(0)
    days = F.when(F.pmod(k, F.lit(8)) == 0, F.array(day, day + LANDED_DAYS)).otherwise(F.array(day))
    arrived = txn.select("*", F.explode(days).alias("day")).select("transaction_id", "updated_at", F.floor(F.col("day") / LANDED_DAYS).alias("file"))
    arrived.repartition("file").write.partitionBy("file").parquet(f"{root}/arrived")
    landed = own.read.parquet(f"{root}/arrived")
    for row in landed.select("file").distinct().orderBy("file").collect():  # a handful: 400 days each
        landed.where(F.col("file") == row["file"]).drop("file").coalesce(1).write.parquet(f"{root}/landing/file-{row['file']:05d}")
    stream = read_stream(own, f"{root}/landing/*", txn.schema, max_files=1)
    query = (
        mark_late(stream, ["transaction_id"], "updated_at", LATE_DELAY)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/_stream_checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/marked")
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return spark.read.schema(txn.schema.add("late", "boolean")).parquet(f"{root}/marked")


CATALOGUE = {
    "incremental_extract": incremental_extract,
    "resume_point": resume_point,
    "resume_point_empty": resume_point_empty,
    "chunk_assign": chunk_assign,
    "chunk_ledger": chunk_ledger,
    "extract_summary": extract_summary,
    "pack_unpack": pack_unpack,
    "normalise_rows": normalise_rows,
    "rule_errors": rule_errors,
    "valid_rows": valid_rows,
    "dead_letter": dead_letter,
    "fatal_rows": fatal_rows,
    "text_time_extract": text_time_extract,
    "extra_keys": extra_keys,
    "account_contract": account_contract,
    "category_contract": category_contract,
    "latest_per_key": latest_per_key,
    "upsert_table": upsert_table,
    "upsert_outcome": upsert_outcome,
    "upsert_replay": upsert_replay,
    "upsert_stale_row": upsert_stale_row,
    "insert_if_absent": insert_if_absent,
    "unique_check": unique_check,
    "foreign_key_check": foreign_key_check,
    "check_constraints": check_constraints,
    "oldest_pending_update": oldest_pending_update,
    "apply_change_set": apply_change_set,
    "newest_n_transfer": newest_n_transfer,
    "newest_n_rejects": newest_n_rejects,
    "load_projection": load_projection,
    "table_counts": table_counts,
    "late_rows": late_rows,
    "pipeline_end_to_end": pipeline_end_to_end,
    "run_metrics": run_metrics,
    "ledger_state": ledger_state,
    "stream_upsert": stream_upsert,
    "event_time_stream": event_time_stream,
    "reconcile_tables": reconcile_tables,
    "props_paths": props_paths,
}
