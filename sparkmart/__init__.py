"""sparkmart: incremental warehouse loading as Spark DataFrame operators.

The main entry points, re-exported::

    from sparkmart import (pack_batches, flatten, latest_per_key, latest_batch, top_k, upsert,
                           assign_keys, load_dimension_scd1, load_fact, advance_watermark,
                           resolve_since, filter_incremental, run_outcome, Warehouse, run)
"""

__version__ = "0.1.0"

from .operators.dedup import latest_batch, latest_per_key, top_k  # noqa: E402
from .operators.incremental import (advance_watermark, cap_oldest, compute_marks,  # noqa: E402
                                    filter_incremental, resolve_since, select_entities)
from .operators.keys import assign_keys  # noqa: E402
from .operators.loads import (load_dimension_scd1, load_fact, load_fact_left_lookup,  # noqa: E402
                              stage_all_batches, stage_latest_batch)
from .operators.quality import (dq_foreign_key, dq_not_null, dq_recent_raw_has_effect,  # noqa: E402
                                dq_watermark_not_ahead, gate, run_checks, watermark_violations)
from .operators.runlog import run_end, run_outcome, run_start  # noqa: E402
from .operators.upsert import update_by_key, upsert  # noqa: E402
from .plans.pipeline import Feeds, run  # noqa: E402
from .sources.paging import keep_fetched_pages, number_pages, pages_of  # noqa: E402
from .sources.payload import explode_payload, flatten  # noqa: E402
from .sources.raw import batch_stats, pack_batches  # noqa: E402
from .sources.warehouse import Warehouse  # noqa: E402
from .streaming.incremental import stream_commits, stream_marks  # noqa: E402
