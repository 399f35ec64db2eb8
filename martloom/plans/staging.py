"""Incremental staging: documents by update time, ranks by id.

One run takes the next batch after the stored cursor and publishes it together with the load state.
An empty batch changes nothing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from martloom.functions.documents import document_text
from martloom.operators.clean import conform, keep_first
from martloom.operators.incremental import (
    DOCUMENT_LIMIT,
    FIRST_ID,
    FIRST_TS,
    batch_cursor,
    empty_state,
    get_setting,
    incremental_extract,
    save_setting,
)
from martloom.schemas import RANKS, RANKS_RULES, STAGED_DOCUMENT, STAGED_DOCUMENT_RULES, empty_table
from martloom.session import materialize
from martloom.sources.releases import Releases

STATE = "srv_wf_settings"
#: Batches of documents that are staged before they are rewritten as one.
COMPACT_AFTER = 96
LAST_ID, LAST_TS = "last_loaded_id", "last_loaded_ts"


def stage_documents(
    collection: DataFrame,
    store: Releases,
    table: str,
    id_column: str = "_id",
    cursor: str = "update_ts",
    limit: int | None = DOCUMENT_LIMIT,
    with_ties: bool = True,
) -> int:
    """Next documents of a collection as (object_id, object_value, update_ts); returns their number.

    The batch is added to the staged ones, so a run costs what the batch costs, however much is
    staged, but for one run in COMPACT_AFTER that rewrites them as one; :func:`staged_documents` shows the newest version of each. ``with_ties`` keeps documents
    that share the update time at the cut in one batch; without it they would be skipped for good.
    """
    state = store.read(STATE, empty_state(store.spark))
    setting = get_setting(state, table) or {LAST_TS: FIRST_TS.isoformat()}
    after = datetime.fromisoformat(setting[LAST_TS])
    batch = materialize(incremental_extract(collection, cursor, after, limit, with_ties), "batch")
    last = batch_cursor(batch, cursor)
    if last is None:
        return 0
    documents = batch.select(
        F.col(id_column).cast("string").alias("object_id"),
        document_text("*").alias("object_value"),
        F.col(cursor).alias("update_ts"),
    )
    store.publish({STATE: save_setting(state, table, {LAST_TS: last})}, added={table: documents})
    if store.additions(table) > COMPACT_AFTER:
        compact_documents(store, table)
    return batch.count()


def staged_documents(store: Releases, table: str) -> DataFrame:
    """Newest staged version of each document."""
    staged = store.read(table, empty_table(store.spark, STAGED_DOCUMENT))
    return keep_first(staged, ["object_id"], [F.desc("update_ts"), F.desc("object_value")])


def compact_documents(store: Releases, table: str) -> None:
    """Rewrite the staged batches as one, without replaced versions."""
    newest = staged_documents(store, table)
    store.publish({table: newest}, rules={table: STAGED_DOCUMENT_RULES})


def stage_ranks(ranks: DataFrame, store: Releases, table: str = "bonussystem_ranks", limit: int | None = 1) -> int:
    """Next rows of the ranks table by id; returns their number. They are added to the staged ones; an id
    past the cursor is new, so the batch alone is checked."""
    state = store.read(STATE, empty_state(store.spark))
    setting = get_setting(state, table) or {LAST_ID: FIRST_ID}
    batch = materialize(incremental_extract(ranks, "id", int(setting[LAST_ID]), limit), "batch")
    last = batch_cursor(batch, "id")
    if last is None:
        return 0
    store.publish(
        {STATE: save_setting(state, table, {LAST_ID: last})}, added={table: conform(batch, RANKS)}, rules={table: RANKS_RULES}
    )
    return batch.count()
