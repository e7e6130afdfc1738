"""ledgerline: incremental ledger ETL as Spark DataFrame jobs.

Extract above a watermark, chunk by global position, validate against row contracts with
a dead-letter output, upsert into a bucketed reporting table, and keep a ledger of run
state for resume, replay and reports. See README.md.

The main entry points::

    from ledgerline import LedgerPipeline, PipelineConfig
    pipe = LedgerPipeline(spark, root, PipelineConfig(chunk_size=5000))
    pipe.run_pipeline(run_id, source_df, now)
"""

from .operators.extract import assign_chunks, incremental_extract
from .operators.merge import latest_per_key, upsert, upsert_outcome
from .operators.ranking import global_position
from .operators.rules import ACCOUNT_CONTRACT, CATEGORY_CONTRACT, TRANSACTION_CONTRACT, evaluate
from .operators.validate import dead_letters, fatal_gate, strict_gate, valid_rows
from .plans.ledger import fold, resume_point
from .plans.pipeline import LedgerPipeline, LedgerStore, PipelineConfig
from .sources.store import RangeTable
from .sources.tables import read_source
from .streaming.stream import start_upsert_stream

__version__ = "0.1.0"

__all__ = [
    "ACCOUNT_CONTRACT",
    "CATEGORY_CONTRACT",
    "LedgerPipeline",
    "LedgerStore",
    "PipelineConfig",
    "RangeTable",
    "TRANSACTION_CONTRACT",
    "assign_chunks",
    "dead_letters",
    "evaluate",
    "fatal_gate",
    "fold",
    "global_position",
    "incremental_extract",
    "latest_per_key",
    "read_source",
    "resume_point",
    "start_upsert_stream",
    "strict_gate",
    "upsert",
    "upsert_outcome",
    "valid_rows",
]
