"""Composite jobs: Bronze, Silver, Gold, the whole run, the message path.

Layers hand over through Parquet: each step reads the previous layer back,
which both cuts the lineage (a lost executor recomputes from the last layer,
not from the source) and lets each step run as its own scheduled task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.operators.commits import Audit, commit_layer
from strata.operators.layers import (LayerResult, append_manifest, layer_path, read_layer,
                                     write_layer, write_text_layer)
from strata.operators.marts import DEFAULT_BROADCAST_ROWS, build_gold
from strata.operators.quality import gold_rules
from strata.operators.refine import refine
from strata.sources.files import read_csv, read_reference
from strata.sources.messages import FileTopic, KafkaTopic, add_missing_columns, replay_topic
from strata.spec import GOLD_CONTRACT, SURVEY, SURVEY_MART, MartSpec, RefineSpec
from strata.streaming.ingest import ingest_evolving, ingest_incremental
from strata.streaming.layers import GOLD_STATE_PARTITIONS, run_layers_incremental


def layer_audit(layer: str) -> Audit:
    """What audited runs ask of a layer: rows in Bronze, and the contract's rules and columns of Gold."""
    if layer == "gold":
        return Audit(rules=tuple(gold_rules()), contract=tuple(GOLD_CONTRACT))
    return Audit(min_rows=1 if layer == "bronze" else 0)


def _write(df: DataFrame, output_dir: str, layer: str, run_id: str | None, audited: bool) -> LayerResult:
    """A layer of a run. Audited, it is a version of the layer's one folder (the run id goes to its log),
    published only if its audit holds; else it overwrites the run's own folder."""
    if audited:
        return commit_layer(df, layer_path(output_dir, layer), layer_audit(layer), run_id or "", layer)
    return write_layer(df, layer_path(output_dir, layer, run_id), layer)


def run_bronze_frame(df: DataFrame, output_dir: str, run_id: str | None = None, audited: bool = False) -> LayerResult:
    """Bronze from any frame: every column, unchanged."""
    return _write(df, output_dir, "bronze", run_id, audited)


def run_bronze(spark: SparkSession, input_csv: str, output_dir: str, run_id: str | None = None,
               infer: bool = True, types: dict[str, str] | None = None,
               null_value: str | None = None, validate_header: bool = False, audited: bool = False,
               one_pass: bool = False) -> LayerResult:
    """CSV -> Bronze Parquet, all columns kept. ``null_value`` names a
    missing-value token (e.g. ``NA``) so such columns stay numeric. With
    ``infer=False`` and ``types`` the source is read once; so it is with
    ``one_pass``, which finds the types while it writes (``write_text_layer``;
    read that Bronze with ``read_layer``)."""
    if one_pass:
        if audited or types:
            raise ValueError("one_pass finds the types of a plain Bronze")
        text = read_csv(spark, input_csv, infer=False, null_value=null_value, validate_header=validate_header)
        return write_text_layer(text, layer_path(output_dir, "bronze", run_id), "bronze")
    df = read_csv(spark, input_csv, infer=infer, types=types, null_value=null_value,
                  validate_header=validate_header)
    return run_bronze_frame(df, output_dir, run_id, audited)


def run_silver(spark: SparkSession, bronze_path: str, output_dir: str, spec: RefineSpec = SURVEY,
               run_id: str | None = None, safe_cast: bool = False, audited: bool = False) -> LayerResult:
    """Bronze -> Silver (labels, decimal measure, valid rows).
    ``safe_cast`` turns an out-of-range measure into NULL instead of failing."""
    silver = refine(read_layer(spark, bronze_path), spec, safe_cast=safe_cast)
    return _write(silver, output_dir, "silver", run_id, audited)


def run_gold(spark: SparkSession, silver_path: str, output_dir: str,
             reference: str | DataFrame, mart: MartSpec = SURVEY_MART, run_id: str | None = None,
             max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, audited: bool = False) -> LayerResult:
    """Silver -> Gold (count, mean, reference name, ordered by key).

    ``reference`` is a CSV path (``state_code,state_name``) or a frame. ``audited``: a Gold that breaks
    the contract is not published (RejectedLayer), and readers keep the one before.
    """
    ref = reference if isinstance(reference, DataFrame) else read_reference(
        spark, reference, mart.ref_key, mart.ref_value)
    gold = build_gold(read_layer(spark, silver_path), ref, mart, max_broadcast_rows)
    return _write(gold, output_dir, "gold", run_id, audited)


def run_layers(spark: SparkSession, bronze: LayerResult, output_dir: str,
               reference: str | DataFrame, spec: RefineSpec = SURVEY, mart: MartSpec = SURVEY_MART,
               run_id: str | None = None, manifest: str | None = None,
               dropped_at: dt.datetime | None = None, safe_cast: bool = False, audited: bool = False
               ) -> dict[str, LayerResult]:
    """Silver and Gold from a written Bronze; optionally record the run in a
    manifest (``manifest`` path, ``dropped_at`` = source delivery time)."""
    silver = run_silver(spark, bronze.path, output_dir, spec, run_id, safe_cast, audited)
    gold = run_gold(spark, silver.path, output_dir, reference, mart, run_id, audited=audited)
    layers = {"bronze": bronze, "silver": silver, "gold": gold}
    if manifest is not None:
        if dropped_at is None:
            raise ValueError("a manifest entry needs the source drop time")
        append_manifest(spark, manifest, run_id or "", layers, dropped_at)
    return layers


def run_pipeline(spark: SparkSession, input_csv: str, output_dir: str, reference: str | DataFrame,
                 run_id: str | None = None, spec: RefineSpec = SURVEY,
                 mart: MartSpec = SURVEY_MART, manifest: str | None = None,
                 dropped_at: dt.datetime | None = None, null_value: str | None = None,
                 safe_cast: bool = False, infer: bool = True, types: dict[str, str] | None = None,
                 audited: bool = False) -> dict[str, LayerResult]:
    """C4: the whole CSV run in the given session (which it never stops). ``audited``: each layer is a
    version that is published only if its audit (``layer_audit``) holds, and a run stops at the first that does not."""
    bronze = run_bronze(spark, input_csv, output_dir, run_id, infer, types, null_value, audited=audited)
    return run_layers(spark, bronze, output_dir, reference, spec, mart, run_id, manifest,
                      dropped_at, safe_cast, audited)


def run_bronze_messages(spark: SparkSession, source: KafkaTopic | FileTopic, output_dir: str,
                        schema: StructType | None = None, run_id: str | None = None, normalize: bool = True,
                        required: tuple[str, ...] = SURVEY.source_columns(),
                        quarantine_path: str | None = None, audited: bool = False) -> LayerResult:
    """Topic -> Bronze alone, by bounded replay, so that Silver and Gold can be scheduled and retried
    apart. Without ``schema`` it is inferred; ``required`` fields that no message carried are NULL. An
    empty topic raises before anything is written; ``audited``, the write itself finds that it has no row,
    the version is not published, and the Bronze before stays."""
    rows = replay_topic(spark, source, schema, normalize, quarantine_path, guard=not audited)
    if schema is None:
        rows = add_missing_columns(rows, required)
    return run_bronze_frame(rows, output_dir, run_id, audited)


def run_message_path(spark: SparkSession, source: KafkaTopic | FileTopic, output_dir: str,
                     reference: str | DataFrame, schema: StructType | None = None,
                     incremental: bool = False, checkpoint: str | None = None,
                     run_id: str | None = None, normalize: bool = True,
                     spec: RefineSpec = SURVEY, mart: MartSpec = SURVEY_MART,
                     manifest: str | None = None, dropped_at: dt.datetime | None = None,
                     safe_cast: bool = False, max_per_batch: int | None = None,
                     quarantine_path: str | None = None, state_partitions: int = GOLD_STATE_PARTITIONS,
                     audited: bool = False, merged: bool = False) -> dict[str, LayerResult]:
    """Topic -> Bronze -> Silver -> Gold.

    Bounded replay (default) rewrites Bronze from the whole topic and is
    repeatable. ``incremental=True`` (needs a ``checkpoint`` folder) appends
    only new messages to Bronze, appends their refined rows to Silver and
    folds them into Gold's per-key streaming state, so a run costs what
    arrived since the last one; Gold is named with the current reference on
    every run. Without ``schema`` the payload schema follows the messages
    (see ``ingest_evolving``). These layers are one maintained set under
    ``output_dir`` (no run id in their paths; the run id goes to the
    manifest), apart from those of bounded runs. Row counts reported for
    Bronze and Silver are the rows added by this run. ``max_per_batch``
    bounds each micro-batch of all streams (offsets for Kafka, files for
    folders), so a large backlog is drained in committed steps.
    ``quarantine_path`` takes malformed messages, which else stop the run.
    ``audited`` (bounded replay) publishes each layer only if its audit holds.
    ``merged`` (incremental) keeps Gold's state in buckets whose rows can be
    corrected later (``strata.operators.state``).
    """
    if not incremental:
        bronze = run_bronze_messages(spark, source, output_dir, schema, run_id, normalize, spec.source_columns(),
                                     quarantine_path, audited)
        return run_layers(spark, bronze, output_dir, reference, spec, mart, run_id, manifest, dropped_at,
                          safe_cast, audited)
    if audited:
        raise ValueError("audited versions are for bounded runs; incremental layers are one maintained set")
    if checkpoint is None:
        raise ValueError("incremental ingest needs a checkpoint folder")
    if manifest is not None and dropped_at is None:
        raise ValueError("a manifest entry needs the source drop time")
    if schema is not None and quarantine_path is not None:
        raise ValueError("an incremental quarantine needs an inferred schema")
    path = layer_path(output_dir, "bronze")
    if schema is not None:
        result = ingest_incremental(spark, source, schema, path, f"{checkpoint}/bronze", normalize, max_per_batch)
    else:
        result, found = ingest_evolving(spark, source, path, checkpoint, spec.source_columns(), normalize,
                                        max_per_batch, quarantine_path)
        if found is None:  # no message yet: nothing to refine
            return {layer: LayerResult(layer_path(output_dir, layer), 0) for layer in ("bronze", "silver", "gold")}
    ref = reference if isinstance(reference, DataFrame) else read_reference(
        spark, reference, mart.ref_key, mart.ref_value)
    layers = run_layers_incremental(spark, LayerResult(path=path, rows=result.rows), schema, output_dir, ref,
                                    checkpoint, spec, mart, safe_cast, max_per_batch, state_partitions, merged)
    if manifest is not None:
        append_manifest(spark, manifest, run_id or "", layers, dropped_at)
    return layers
